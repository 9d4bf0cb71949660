"""Personal data in texts, disguised or not, at its place in the source.

Plain identifiers are found in the source itself. A transducer then rewrites disguises (look-alike letters and
digits, invisible characters, spelled digits, words and brackets for "at" and "dot") into a normalised text and
keeps for every rewritten piece the source characters it came from. The same detectors run on the normalised
text; what they find there with a rewritten piece in it is mapped back to source characters and added, unless it
overlaps a plain find of its kind. Plain finds always stay. A second, wider reading also takes a bare "at" before a plain
domain and single spelled digits of a number; the finds of both readings are added, and may overlap each other.

Defined results: null and empty texts have no spans; spans are in code points, the end exclusive, ordered by kind
(email, ip, card, phone) and start; repeated rows are searched each; a null doc_id is kept; an empty table gives
an empty one; other columns are not looked at.
"""

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import whole_text

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# --- plain identifiers -------------------------------------------------------------------------------

# An address is found from its "@": what stands before it cannot fail, so no start is tried twice.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Starting inside a run of digits finds nothing that its first digit would not.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _byte(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def plain_spans(text: str) -> list[Span]:
    """Leftmost finds that do not overlap within a kind; a find that fails its test is dropped, not retried."""
    out: list[Span] = []
    if "@" in text:
        free = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append(("email", start, m.end()))
                free = m.end()
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(_byte(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


# --- the transducer ----------------------------------------------------------------------------------

# Letters that look like Latin ones, and the Latin ones they look like.
_CYRILLIC = dict(zip("АВЕЅІЈКМНОРСТУХаесіјорѕухԁ", "ABESIJKMHOPCTYXaecijopsyxd", strict=True))
_GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορ", "ABEZHIKMNOPTYXavop", strict=True))
# Full-width forms lie at a fixed distance from their plain ones; the mathematical digits repeat five times.
_WIDE = {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
_MATH = {chr(0x1D7CE + i): str(i % 10) for i in range(50)}
_CIRCLED = {chr(0x2460 + i): str(i + 1) for i in range(9)} | {"⓪": "0"}
GLYPHS = _CYRILLIC | _GREEK | _WIDE | _MATH | _CIRCLED

DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}

_WORD = f"(?:{'|'.join(DIGIT_WORDS)})"
_GLYPH = re.compile(f"[{re.escape(''.join(GLYPHS))}]")
_HIDDEN = "­​‌‍⁠﻿"
_OPEN, _CLOSE = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_SPELT_DOT = r"\s{0,3}[\[({<\s]\s{0,3}(?:dot|\.)[\])}>\s]"
# Beside a digit, however it is set off: a single spelled digit of a number.
_BESIDE = "|".join(rf"(?<=[0-9][\s().-]{{{n}}})" for n in (1, 2, 3))


def _edits(domain: str, more: str = "") -> re.Pattern:
    """What is rewritten; ``domain`` follows the first label after a bare "at"."""
    return re.compile(
        rf"(?P<hidden>[{_HIDDEN}]+)"
        rf"|(?P<at>{_OPEN}(?:at|@){_CLOSE}|(?<=[A-Za-z0-9])\s{{1,3}}at\s{{1,3}}(?=[A-Za-z0-9-]+(?:{domain})))"
        rf"|(?P<dot>{_OPEN}(?:dot|\.){_CLOSE}|(?<=[A-Za-z0-9])\s{{1,3}}dot\s{{1,3}}(?=[A-Za-z0-9]))"
        rf"|(?P<plus>\bplus[\s-]{{1,3}}(?=[0-9]|{_WORD}\b))"
        rf"|(?P<digits>\b{_WORD}(?:[\s-]{{1,3}}(?:{_WORD}|[0-9]))+\b)"
        rf"|(?P<one>(?<=dot\s){_WORD}\b|\b{_WORD}(?=\s{{1,3}}dot\s){more})"
        rf"|(?P<glyph>{_GLYPH.pattern})",
        re.IGNORECASE,
    )


_EDIT = _edits(_SPELT_DOT)
#: Plain domains behind a bare "at" and single spelled digits too. A reading of its own: it may break a find of the other.
_WIDER = _edits(rf"{_SPELT_DOT}|\.[A-Za-z0-9]", rf"|(?:{_BESIDE}){_WORD}\b|\b{_WORD}(?=[\s().-]{{1,3}}[0-9])")
_PART = re.compile(rf"{_WORD}|[0-9]")


class Normalised:
    """A rewritten text and, for every piece of it, the source characters it stands for."""

    def __init__(self, text: str, edits: re.Pattern = _EDIT):
        parts, self.starts, self.sources, self.edited = [], [], [], []
        at = made = 0
        for m in edits.finditer(text):
            new = self._rewrite(m)
            if new is None:
                continue
            for piece, source, edited in ((text[at : m.start()], (at, m.start()), False), (new, m.span(), True)):
                if piece or edited:
                    parts.append(piece)
                    self.starts.append(made)
                    self.sources.append(source)
                    self.edited.append(edited)
                    made += len(piece)
            at = m.end()
        if at < len(text) or not parts:
            parts.append(text[at:])
            self.starts.append(made)
            self.sources.append((at, len(text)))
            self.edited.append(False)
        self.text = "".join(parts)

    @staticmethod
    def _rewrite(m: re.Match) -> str | None:
        kind = m.lastgroup
        if kind in ("digits", "one"):
            return "".join(DIGIT_WORDS.get(p, p) for p in _PART.findall(m.group().lower()))
        if kind == "glyph":
            return GLYPHS.get(m.group())
        return {"hidden": "", "at": "@", "dot": ".", "plus": "+"}[kind]

    def source(self, start: int, end: int) -> tuple[int, int] | None:
        """Source characters of a span of the rewritten text; None if nothing in it was rewritten."""
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        if not any(self.edited[first : last + 1]):
            return None
        (a, _), (c, d) = self.sources[first], self.sources[last]
        begin = a if self.edited[first] else a + start - self.starts[first]
        return begin, d if self.edited[last] else c + end - self.starts[last]


# What every disguise has in it, looked for in lower-cased text with patterns that pass over prose quickly. Characters that
# are a disguise by themselves, or an ASCII letter when case is ignored, are looked for first.
_ODD = re.compile(f"[{_HIDDEN}{re.escape(''.join(GLYPHS))}]", re.IGNORECASE)
_ODD_LETTERS = re.compile("[\u0130\u0131\u017f\u212a]")
_BRACKETED = re.compile(r"[\[({<]\s{0,3}(?:at|@|dot|\.)")
_DOT = re.compile(r"dot\s")
_AT = re.compile(rf"at(?=\s{{1,3}}[a-z0-9-]+(?:{_SPELT_DOT}|\.[a-z0-9]))")
_PLUS = re.compile(rf"plus[\s-]{{1,3}}(?:[0-9]|{_WORD})")
_NUMBER = re.compile(rf"{_WORD}(?=[\s().-]{{1,3}}(?:{_WORD}|[0-9]))")
_NUMBERED = re.compile(rf"[0-9][\s().-]{{1,3}}{_WORD}")


def _hinted(text: str) -> bool:
    """False only where no disguise can be: the patterns ask for less than those of the transducer."""
    if not text.isascii() and (_ODD_LETTERS.search(text) or _ODD.search(text)):
        return True
    low = text.lower()
    return bool(
        _BRACKETED.search(low) or ("dot" in low and _DOT.search(low)) or ("plus" in low and _PLUS.search(low))
        or any(low[m.start() - 1 : m.start()].isspace() for m in _AT.finditer(low)) or _NUMBERED.search(low)
        or any(not low[max(m.start() - 1, 0) : m.start()].isalnum() for m in _NUMBER.finditer(low)))


def disguised(text: str) -> bool:
    """Whether the transducer rewrites anything."""
    return _hinted(text) and bool(_WIDER.search(text))


def added_spans(text: str, plain: list[Span]) -> list[Span]:
    """What only shows in a normalised text, at its place in the source."""
    if not disguised(text):
        return []
    first, second = Normalised(text), Normalised(text, _WIDER)
    out: list[Span] = []
    for normal in [first] if first.text == second.text else [first, second]:
        for kind, start, end in plain_spans(normal.text):
            place = normal.source(start, end)
            if place and (kind, *place) not in out and not any(k == kind and a < place[1] and place[0] < b for k, a, b in plain):
                out.append((kind, *place))
    return out


# --- Spark -------------------------------------------------------------------------------------------


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end, added) for every row."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.bool_())]))

    def run(batches):
        order = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                plain = plain_spans(text)
                both = [(*s, False) for s in plain] + [(*s, True) for s in added_spans(text, plain)]
                both.sort(key=lambda s: (order[s[0]], s[1], s[2]))
                rows.append([dict(zip(("kind", "start", "end", "added"), s, strict=True)) for s in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,added:boolean>>")


def listed(spans):
    """``kind:start:end`` of every span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
