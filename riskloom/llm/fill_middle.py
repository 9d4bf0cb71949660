"""Fill-in-the-middle rewriting over seekable compressed frames.

``framed`` stores every text as independent zstandard frames of about ``FRAME`` bytes. Beside each frame stand the
units (runs of A-Z letters, or one other code point) and the code points up to its end. A cut is named by a
number of units: the cumulative counts tell which frame holds it, and only that frame is decompressed to find the
place (``Frames.place``). Whole texts are never put together for that: prefix, middle and suffix are streams of
decompressed pieces, the output is those streams in their order between marks, and digests read the stream.
``restored`` goes the other way, from output and form alone: it finds the marks again wherever pieces border and
keeps the parts as frames of their own until they can be read in the order of the text.

One row per document all the way, no shuffle; the store is written to the shared folder and read by the rewriting.

Defined results: a null text counts as empty, an empty one is plain; a text that holds a mark is plain; a null
doc_id is drawn as the empty string; rows are independent, so repeated rows and equal doc_ids give equal rows; an
empty table gives an empty one; very long texts are held compressed, with a few frames open at once (Arrow
hands over and takes back the whole text of a row); other columns are not looked at.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored, text_bytes

#: Bytes of text in a frame, and the compression level.
FRAME, LEVEL = 1 << 16, 3
#: Seed of the draws; of a hundred documents so many are rewritten, and of a hundred of those so many suffix first.
SEED, REWRITTEN, SUFFIX_FIRST = 1, 90, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Order of marks and parts (0 prefix, 1 middle, 2 suffix) in the output.
FORMS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

FRAMES = "doc_id long, units long, chars long, marked boolean, unit_ends array<long>, char_ends array<long>, goes_on array<boolean>, frames array<binary>"
REWRITES = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _heads(data: bytes) -> np.ndarray:
    """Where code points begin in UTF-8."""
    return (np.frombuffer(data, np.uint8) & 0xC0) != 0x80


def _starts(data: bytes, goes_on: bool) -> np.ndarray:
    """Where units begin; ``goes_on`` says that the byte before was a letter."""
    letter = _LETTER[np.frombuffer(data, np.uint8)]
    return _heads(data) & ~(letter & np.concatenate([[goes_on], letter[:-1]]))


def _pieces(data: bytes, size: int) -> Iterator[bytes]:
    """Consecutive pieces of about ``size`` bytes, cut between code points."""
    at = 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        yield data[at:end]
        at = end


class Frames:
    """A text as compressed frames with the units and code points up to the end of each."""

    def __init__(self, unit_ends: list[int], char_ends: list[int], goes_on: list[bool], frames: list[bytes]):
        self.unit_ends, self.char_ends, self.goes_on, self.frames = unit_ends, char_ends, goes_on, frames
        self._open = zstandard.ZstdDecompressor()

    @classmethod
    def of(cls, data: bytes, size: int = FRAME, level: int = LEVEL) -> "Frames":
        press = zstandard.ZstdCompressor(level=level, write_content_size=True)
        made, units, chars, goes_on = cls([], [], [], []), 0, 0, False
        for piece in _pieces(data, size):
            units += int(np.count_nonzero(_starts(piece, goes_on)))
            chars += int(np.count_nonzero(_heads(piece)))
            made.unit_ends.append(units)
            made.char_ends.append(chars)
            made.goes_on.append(goes_on)
            made.frames.append(press.compress(piece))
            goes_on = bool(_LETTER[piece[-1]])
        return made

    @property
    def units(self) -> int:
        return self.unit_ends[-1] if self.unit_ends else 0

    def read(self, k: int) -> bytes:
        return self._open.decompress(self.frames[k])

    def place(self, unit: int) -> tuple[int, int, int]:
        """Frame, byte in it and code points before the given number of units; opens one frame at most."""
        if unit >= self.units:
            return len(self.frames), 0, self.char_ends[-1] if self.char_ends else 0
        k = bisect_left(self.unit_ends, unit + 1)
        data = self.read(k)
        at = int(np.flatnonzero(_starts(data, self.goes_on[k]))[unit - (self.unit_ends[k - 1] if k else 0)])
        return k, at, (self.char_ends[k - 1] if k else 0) + int(np.count_nonzero(_heads(data[:at])))

    def between(self, a: tuple[int, int, int], b: tuple[int, int, int]) -> Iterator[bytes]:
        """The text between two places, frame by frame."""
        for k in range(a[0], min(b[0] + 1, len(self.frames))):
            if k == b[0] and not b[1]:
                return
            data = self.read(k)
            yield data[a[1] if k == a[0] else 0 : b[1] if k == b[0] else len(data)]


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four whole numbers below 2^32 for a document."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]


def output(text: Frames, form: str, parts: list[tuple[tuple, tuple]]) -> Iterator[bytes]:
    """The rewritten text as a stream; ``parts`` has where prefix, middle and suffix begin and end."""
    if form == "plain":
        yield from text.between((0, 0, 0), (len(text.frames), 0, 0))
        return
    for mark, part in FORMS[form]:
        yield mark
        yield from text.between(*parts[part])


def restored(stream: Iterable[bytes], form: str, size: int = FRAME) -> Iterator[bytes]:
    """The text from its rewritten form, in bounded memory: parts are kept compressed until their turn comes."""
    if form == "plain":
        yield from stream
        return
    press, opened = zstandard.ZstdCompressor(level=1, write_content_size=True), zstandard.ZstdDecompressor()
    parts: list[list[bytes]] = [[], [], []]
    held: list[bytes] = []
    marks, waiting = list(FORMS[form]), b""
    part = None  # the one being read; before the first mark there is nothing

    def keep(data: bytes, last: bool = False) -> None:
        if data and part is None:
            raise ValueError("text before the first mark")
        held.append(data)
        if (last or sum(map(len, held)) >= size) and part is not None:
            parts[part].append(press.compress(b"".join(held)))
            held.clear()

    for piece in stream:
        waiting += piece
        while marks and (at := waiting.find(marks[0][0])) >= 0:
            keep(waiting[:at], last=True)
            waiting = waiting[at + len(marks[0][0]) :]
            part = marks.pop(0)[1]
        sure = len(waiting) - 2 if marks else len(waiting)  # the last two bytes may begin a mark
        if sure > 0:
            keep(waiting[:sure])
            waiting = waiting[sure:]
    keep(waiting, last=True)
    if marks:
        raise ValueError(f"no {marks[0][0].decode()} in the output")
    for kept in parts:
        for frame in kept:
            yield opened.decompress(frame)


def digest(stream: Iterable[bytes]) -> str:
    made = hashlib.sha256()
    for piece in stream:
        made.update(piece)
    return made.hexdigest()


def chosen(text: Frames, marked: bool, doc_id: int | None, seed: int = SEED) -> tuple[str, list[tuple[tuple, tuple]]]:
    """The form of a document and its three parts; a plain one has none."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    n = text.units
    if not n or marked or h3 % 100 >= REWRITTEN:
        return "plain", []
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = map(text.place, cuts)
    begin, end = (0, 0, 0), (len(text.frames), 0, text.char_ends[-1])
    return "spm" if h4 % 100 < SUFFIX_FIRST else "psm", [(begin, a), (a, b), (b, end)]


def framed(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """(``FRAMES``): one row per document with its text as frames, written to the shared folder."""

    def run(batches):
        schema = _arrow(FRAMES)
        for batch in batches:
            found: list[list] = [[] for _ in schema]
            for doc_id, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = Frames.of(data, size)
                row = (doc_id, text.units, text.char_ends[-1] if text.char_ends else 0, any(m in data for m in (PREFIX, SUFFIX, MIDDLE)),
                       text.unit_ends, text.char_ends, text.goes_on, text.frames)
                for column, value in zip(found, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, schema, strict=True)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    return stored(rows.mapInArrow(run, FRAMES), "frames")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    kinds |= {f"array<{name}>": pa.list_(kind) for name, kind in kinds.items()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _each(store: DataFrame, ddl: str, row: Callable[[int | None, bool, Frames], tuple]) -> DataFrame:
    def run(batches):
        schema = _arrow(ddl)
        for batch in batches:
            found: list[list] = [[] for _ in schema]
            columns = [batch.column(name) for name in ("doc_id", "marked", "unit_ends", "char_ends", "goes_on", "frames")]
            for k in range(batch.num_rows):
                doc_id, marked, *parts = (c[k].as_py() for c in columns)
                for column, value in zip(found, row(doc_id, marked, Frames(*parts)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, schema, strict=True)], schema=schema)

    return store.mapInArrow(run, ddl)


def rewrites(store: DataFrame, seed: int = SEED) -> DataFrame:
    """(``REWRITES``): form, sizes and the digests of the output and of the text rebuilt from it."""

    def row(doc_id: int | None, marked: bool, text: Frames) -> tuple:
        form, parts = chosen(text, marked, doc_id, seed)
        chars = [b[2] - a[2] for a, b in parts[:2]] or [None, None]
        return (doc_id, text.units, form, *chars, digest(output(text, form, parts)), digest(restored(output(text, form, parts), form)))

    return _each(store, REWRITES, row)


def texts(store: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, form, text): the rewritten texts themselves, for training."""

    def row(doc_id: int | None, marked: bool, text: Frames) -> tuple:
        form, parts = chosen(text, marked, doc_id, seed)
        return doc_id, form, b"".join(output(text, form, parts)).decode()

    return _each(store, "doc_id long, form string, text string", row)
