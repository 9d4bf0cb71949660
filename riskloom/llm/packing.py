"""Packing of tokenised documents into sequences of bounded length.

Texts are tokenised with a public tokenizer and end with one extra id. Pieces of exactly one sequence length are
cut off; what is left over is packed by first-fit decreasing. The bin that takes a piece is the first with room,
found in a tournament tree whose inner nodes hold the largest room below them. Documents are dealt into random
groups of bounded size, and each group is packed on its own.

Defined results: a null text counts as empty, and an empty text still has its one end id; repeated rows and rows
with equal doc_ids are packed as documents of their own; a null doc_id is kept as null; an empty table gives an
empty one; other columns of the input are not looked at.
"""

import json
import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import give_back, stored, whole_text

LENGTH, END_ID = 2048, 1
#: Pieces in a group, on average. Bytes of words and units whose ids a worker remembers, and what each costs besides its own.
GROUP, REMEMBERED, OVERHEAD = 8192, 96 << 20, 200
#: Bits of a sequence id that number the sequences of a group.
SEQUENCE_BITS = 32

PIECES = "row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

# Space beyond ASCII, and the four separators that only Python counts as space: such texts are tokenised whole.
# So are those with control characters, and with what may be a special token, which lower-casing must not make.
_WHOLE = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# Texts of Latin letters can be lower-cased beforehand, and their parts cut into the tokenizer's own units here.
_BEYOND_LATIN = re.compile(r"[\u0130\u0180-\U0010ffff]")
_LETTERS, _NUMBERS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", r"0-9\xb2\xb3\xb9\xbc-\xbe"
_UNITS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
#: The way of splitting and normalising that this fits; other tokenizers see every part whole.
_KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers.

    The tokenizer drops white space, so ids of a text are those of its space-separated parts in a row. The ids of
    frequent parts, and of the units of parts, are remembered; new units go straight to the tokenizer's model.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
        split = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        self.by_unit = steps == ["NFC", "Replace", "Lowercase"] and split == _KNOWN_SPLIT
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.room = REMEMBERED

    def _ids(self, texts: list[str]):
        for at in range(0, len(texts), 4096):
            for x in self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False):
                yield array("I", x.ids).tobytes()

    def _unit(self, unit: str) -> bytes:
        found = self.units.get(unit)
        if found is None:
            spelled = unit if unit.isascii() and unit.isprintable() else unit.encode().decode("latin-1").translate(self.letters)
            found = array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if (cost := len(unit) + len(found) + OVERHEAD) <= self.room:
                self.units[unit] = found
                self.room -= cost
        return found

    def _fresh(self, parts: list[str]) -> dict[str, bytes]:
        out, other = {}, []
        for p in parts:
            if self.by_unit and p == p.lower() and not _BEYOND_LATIN.search(p) and "<|" not in p:
                out[p] = b"".join([self._unit(u) for u in _UNITS.findall(p)])
            else:
                other.append(p)
        out.update(zip(other, self._ids(other), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of some texts; all their parts are held at once, so give a few at a time."""
        lower = [t if _BEYOND_LATIN.search(t) else t.lower() for t in texts] if self.by_unit else texts
        parts = [None if _WHOLE.search(t) or "<|" in t else t.split() for t in lower]
        known, new = self.known, set()
        for words in parts:
            new.update(words or ())
        fresh = self._fresh([w for w in new if w not in known])
        known.update(fresh)
        found = [next(self._ids([t])) if words is None else b"".join(map(known.__getitem__, words))
                 for t, words in zip(texts, parts, strict=True)]
        self.room -= sum(len(w) + len(ids) + OVERHEAD for w, ids in fresh.items())
        if self.room < 0:  # full: what is new is not kept
            for w, ids in fresh.items():
                del known[w]
                self.room += len(w) + len(ids) + OVERHEAD
        return found


_encoders: dict[str, Encoder] = {}


def _few(texts: list[str], most: int = 1 << 21):
    """Cut a list so that the parts have about ``most`` characters, and at least one text."""
    at = size = 0
    for i, text in enumerate(texts):
        if i > at and size + len(text) > most:
            yield at, i
            at, size = i, 0
        size += len(text)
    if texts:
        yield at, len(texts)


def pieces(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Consecutive pieces of every document's ids, at most ``length`` long; only the last may be shorter."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        give_back()
        encoder = _encoders.setdefault(path, None) or Encoder(path)
        _encoders[path] = encoder
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            found: list[list] = [[], [], [], [], [], []]
            for at in range(0, batch.num_rows, 512):
                rows, docs, texts = (c.to_pylist() for c in batch.slice(at, 512).columns)
                for lo, hi in _few(texts):
                    for row, doc, ids in zip(rows[lo:hi], docs[lo:hi], encoder.encode(texts[lo:hi]), strict=True):
                        ids = memoryview(ids + end)
                        total = len(ids) // 4
                        for start in range(0, total, length):
                            piece = ids[4 * start : 4 * (start + length)]
                            for column, value in zip(found, (row, doc, start, len(piece) // 4, zlib.crc32(piece), total), strict=True):
                                column.append(value)
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, PIECES)


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every piece; ``lengths`` must fall. A full piece opens a bin and never enters the tree."""
    full = sum(1 for n in lengths if n == capacity)
    rest = lengths[full:]
    leaves = 1 << max(0, len(rest) - 1).bit_length()
    room = [capacity] * (2 * leaves)  # room[1] is the root, room[leaves + b] the room of bin b
    placed = [(b, 0) for b in range(full)]
    for n in rest:
        node = 1
        while node < leaves:
            node = 2 * node if room[2 * node] >= n else 2 * node + 1
        placed.append((full + node - leaves, capacity - room[node]))
        room[node] -= n
        while node > 1:
            node >>= 1
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return placed


def pack(cut: DataFrame, length: int = LENGTH, group: int = GROUP, seed: int = 7) -> DataFrame:
    """``cut`` (columns ``PIECES``, unique in row_id and start) with sequence_id and offset."""
    groups = max(1, -(-cut.count() // group))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row_id", "start"], ascending=[False, True, True])
        placed = first_fit_decreasing(rows["length"].tolist(), length)
        bins, offsets = zip(*placed, strict=True)
        first = key[0] << SEQUENCE_BITS
        return rows.assign(sequence_id=[first + b for b in bins], offset=list(offsets))[
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]].astype({"doc_id": "Int64"})

    dealt = cut.withColumn("deal", F.pmod(F.xxhash64(F.lit(seed), "row_id"), F.lit(groups).cast("long")))
    return dealt.groupBy("deal").applyInPandas(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, length: int = LENGTH, group: int = GROUP, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: which ids of which document lie where in which sequence.

    Tokenising is done once: the cut pieces (a few numbers each, no ids) are written to the shared folder.
    """
    return pack(stored(pieces(docs, length, tokenizer=tokenizer), "pieces"), length, group)
