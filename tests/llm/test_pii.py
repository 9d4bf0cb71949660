import hashlib
import random
import re

import pytest
from helpers import edge_docs, no_docs

from riskloom.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def by_hand(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text or "", re.ASCII) if passes(k, m.group())]


TEXTS = [
    "", "a@b.c@d.e", "x.y+z%1@host-1.example.com, @no.pe a@b a@.c a@b..c", "a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 0255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 12 4111  1111", "+1 (136) 555-7479 + 1 +12345678 +4912345678901234567 +1-2",
    "é@ä.com é1@x.com日 +1 (555) 555-5657é", "1.1.1.1@2.2.2.2 and a@1.2.3.4", "9" * 3000 + "." + "+" * 50, "@" * 400 + "a" * 400 + "@b.c",
]


@pytest.mark.parametrize("text", TEXTS)
def test_plain_spans_equal_the_patterns(text):
    assert pii.plain_spans(text) == by_hand(text)


def test_plain_spans_of_all_small_documents(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert all(pii.plain_spans(r.text) == by_hand(r.text) for r in rows)


@pytest.mark.parametrize(("text", "kind", "found"), [
    ("write to jo.81 [at] mail7 [dot] example [dot] com now", "email", "jo.81 [at] mail7 [dot] example [dot] com"),
    ("write jo at mail dot example dot com, please", "email", "jo at mail dot example dot com"),
    ("jo(AT)mail(DOT)com", "email", "jo(AT)mail(DOT)com"),
    ("jо@mаil.com", "email", "jо@mаil.com"),
    ("jo＠ｍail．com", "email", "jo＠ｍail．com"),
    ("jo​@ma​il.com!", "email", "jo​@ma​il.com"),
    ("call plus one five five five five five five one two one two today", "phone", "plus one five five five five five five one two one two"),
    ("call +1 (555) five five five 1234 ok", "phone", "+1 (555) five five five 1234"),
    ("card four one one one 1111 1111 1111!", "card", "four one one one 1111 1111 1111"),
    ("host one dot two dot 3[.]4 x", "ip", "one dot two dot 3[.]4"),
    ("at 10[.]0[.]0[.]7 there", "ip", "10[.]0[.]0[.]7"),
    ("from one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
    ("１２７.0.0.１ ", "ip", "１２７.0.0.１"),
    ("we met at noon, dot the i and look at one two things", None, None),
])
def test_disguises_are_found_at_their_place(text, kind, found):
    for before in ("", "é日 x ", "a@b.cd 4111111111111111, "):
        plain = pii.plain_spans(before + text)
        added = [(k, (before + text)[a:b]) for k, a, b in pii.added_spans(before + text, plain)]
        assert (kind, found) in added if kind else not added


def test_plain_spans_stay_and_nothing_overlaps_them(spark, small):
    for text in [*TEXTS, "a@b.cd [at] e [dot] f", "jo at a@b.cd dot com"]:
        plain = pii.plain_spans(text)
        for k, a, b in pii.added_spans(text, plain):
            assert not any(x == k and y < b and a < z for x, y, z in plain)


@pytest.mark.parametrize("clashing", [False, True])
def test_rows(spark, clashing):
    docs = edge_docs(spark, clashing)
    got = pii.find(docs).collect()
    assert len(got) == docs.count()
    assert pii.find(no_docs(spark)).count() == 0


def test_query_digests(spark, small):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op4_pii(spark, small).collect()
    assert len(rows) == len(text)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 10
    for r in rows:
        want = by_hand(text[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[0] for s in want) for k in pii.KINDS]
        assert r.n_added or r.spans == joined


@pytest.mark.parametrize(("text", "kind", "found"), [
    ("call plus 49 30 1234567 now", "phone", "plus 49 30 1234567"),
    ("write jo at example.com, please", "email", "jo at example.com"),
    ("write jo at mail.example dot com, please", "email", "jo at mail.example dot com"),
    ("card 4111 1111 1111 111 one ok", "card", "4111 1111 1111 111 one"),
    ("card 4111 one 111 1111 1111 ok", "card", "4111 one 111 1111 1111"),
    ("card four 111 1111 1111 1111 ok", "card", "four 111 1111 1111 1111"),
    ("host 10.0.0.seven x", "ip", "10.0.0.seven"),
    ("card four one one one 1111 1111 1111 one time", "card", "four one one one 1111 1111 1111"),
])
def test_every_edit_passes_the_gate(text, kind, found):
    for before in ("", "é日 x ", "a@b.cd 4111111111111111, "):
        plain = pii.plain_spans(before + text)
        assert (kind, found) in [(k, (before + text)[a:b]) for k, a, b in pii.added_spans(before + text, plain)]


def test_the_gate_loses_nothing(spark, small):
    for r in spark.read.parquet(f"{small}/documents.parquet").limit(300).collect():
        for edits in (pii._EDIT, pii._WIDER):
            assert pii.disguised(r.text) or not any(pii.Normalised(r.text, edits).edited)


def test_hints_miss_no_disguise():
    pick = random.Random(7)
    parts = ["at", "AT", "that", "dot", "Dot", "plus", "one", "phone", "Seven", "\u017feven", "n\u0131ne", "oh", "2", "55", "x", "mail", "[", ")", "(", ">", "{",
             "@", ".", "-", " ", "  ", "\n", "\u00a0", "\u200b", "\u0430", "\u043c", "\uff11", "\u2460", "\u00e9", "_", "\u0130", "\u212a", "+", ","]
    found = 0
    for _ in range(60000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(1, 9)))
        expected = bool(pii._WIDER.search(text))
        found += expected
        assert pii.disguised(text) == expected, repr(text)
    assert found > 5000


def test_prose_is_passed_over_without_the_transducer(monkeypatch):
    class Refused:
        def search(self, text):
            raise AssertionError(text[:40])

    monkeypatch.setattr(pii, "_WIDER", Refused())
    prose = "That one phone was at home, at 7 in the morning. No one sat at the dotted line; a plus for all of us (and one more)!\n"
    assert not pii.disguised(prose * 50) and not pii.disguised("d\u00e9j\u00e0 vu, \u00e0 la fin " * 50)
