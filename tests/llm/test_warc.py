import gzip
import hashlib
import json
from pathlib import Path

import pytest
from pyspark.sql.types import StructType

from riskloom.llm import warc

PAGES = "page_id long, url string, html string"


def by_hand(pages):
    out = []
    for page, html in pages:
        data = (html or "").encode()
        same = [p for p, h in pages if (h or "").encode() == data and p is not None]
        first = min(same) if len(data) >= 100 and same else page
        again = first != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark, small):
    long = "<p>" + "ü" * 60
    rows = [(5, "u", long), (3, "u\nv", long), (9, None, long), (9, None, long), (3, "w", long), (1, "u", "short"), (2, "u", "short"),
            (4, "u", None), (6, "u", ""), (None, "u", long), (None, "x", "z" * 200), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 30),
            (8, "u", "日" * 400_000), (-1, "u", "x" * 99), (-2, "u", "x" * 100), (-3, "u", "x" * 100)]
    for pages in (spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS payload", "'x' AS record_type").repartition(3),
                  spark.read.parquet(f"{small}/pages.parquet"), spark.createDataFrame([], PAGES)):
        want = by_hand([(r.page_id, r.html) for r in pages.collect()])
        assert sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str) == want


@pytest.fixture
def archive(spark, folder):
    rows = [(i, f"http://x/{i}", f"<p>{i % 4}</p>" * (40 * (i % 4) + 1)) for i in range(50)]
    path = f"{folder}/a"
    warc.write(warc.page_records(spark.createDataFrame(rows, PAGES).repartition(5)), path)
    return path, {r[0]: r[2] for r in rows}


def test_archives_are_gzip_members_and_valid_records(archive):
    path, html = archive
    seen = 0
    for name, size in json.loads(Path(path, warc.MANIFEST).read_text()):
        data = Path(path, name).read_bytes()
        assert len(data) == size
        plain = gzip.decompress(data)
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            length = int(dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])["Content-Length"])
            assert rest[length : length + 4] == b"\r\n\r\n"
            plain, seen = rest[length + 4 :], seen + 1
    assert seen == len(html)


@pytest.mark.parametrize("kind", ["members", "plain", "foreign"])
def test_files_of_any_form_give_the_same(archive, folder, kind):
    path, html = archive
    for name, _ in warc.archives(path):
        data = Path(name).read_bytes()
        other = Path(folder, f"{kind}.warc")
        if kind == "plain":
            other.write_bytes(gzip.decompress(data))
        elif kind == "foreign":  # members without a length
            rows = [gzip.compress(warc.record_bytes(r)) for r in warc.read_file(name)]
            other.write_bytes(b"".join(rows))
        else:
            other.write_bytes(data)
        want = list(warc.read_file(name))
        assert list(warc.read_file(str(other))) == want
        assert all(r["payload"].decode() == html[r["page_id"]] for r in want if r["record_type"] == "response")
        some = list(warc.read_file(str(other), lambda row: row["page_id"] % 7 == 0, False))
        assert [r["page_id"] for r in some] == [r["page_id"] for r in want if r["page_id"] % 7 == 0]
        assert not any("payload" in r for r in some)


def test_unwanted_payloads_are_not_inflated(archive, monkeypatch):
    path, _ = archive
    name = max(warc.archives(path), key=lambda f: f[1])[0]
    read = []
    real = warc.Window.peek
    monkeypatch.setattr(warc, "CHUNK", 256)
    monkeypatch.setattr(warc.Window, "peek", lambda self, n: read.append(n) or real(self, n))
    assert list(warc.read_file(name, lambda row: False)) == []
    assert max(read) < 4096


def test_wanted_values_reach_the_reader_without_a_setting(spark, archive):
    path, _ = archive
    everything = {(r.record_type, r.page_id) for r in warc.read(spark, path, ["record_type", "page_id"]).collect()}
    for wanted in ({"record_type": ["revisit"]}, {"record_type": ["response"], "page_id": [4, 5]}, {"page_id": []}, {}):
        got = {(r.record_type, r.page_id) for r in warc.read(spark, path, ["record_type", "page_id"], wanted).collect()}
        assert got == {r for r in everything if all({"record_type": r[0], "page_id": r[1]}[c] in v for c, v in wanted.items())}
    # chosen by a header that is not asked for, with the payload
    both = [warc.read(spark, path, ["page_id", "payload"], {"record_type": [kind]}).count() for kind in ("response", "revisit")]
    assert sum(both) == len([r for r in warc.read(spark, path, ["record_type"]).collect() if r.record_type in ("response", "revisit")])
    with pytest.raises(Exception, match="cannot be chosen"):
        warc.read(spark, path, ["page_id"], {"payload": ["x"]}).collect()


def test_the_reader_tests_headers(tmp_path):
    source = warc.WarcDataSource({"path": str(tmp_path), "where": '{"record_type": ["response"]}'})
    reader = source.reader(StructType.fromDDL("page_id long, payload binary"))
    assert reader.wanted({"record_type": "response"}) and not reader.wanted({"record_type": "revisit"})


def test_predicates_are_pushed(spark, archive):
    path, _ = archive
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "true")
        df = warc.read(spark, path).where("record_type = 'revisit' AND page_id IN (4, 5, 9) AND payload_length > 1")
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert sorted(r.page_id for r in rows) == [5, 9]
    above = plan.split("BatchScan")[0]
    assert "payload_length" in above and "revisit" not in above
    assert warc.read(spark, path, ["page_id"]).where("page_id = 4").count() == 1


def test_only_committed_files_are_read(spark, archive):
    path, html = archive
    Path(path, "left-over.warc.gz").write_bytes(b"cut short")
    assert warc.read(spark, path, ["page_id"]).count() == len(html)


def test_damage_is_reported(archive, folder):
    path, _ = archive
    data = Path(warc.archives(path)[0][0]).read_bytes()
    for name, bad in (("cut.warc.gz", data[:-40]), ("other.warc", b"hello\r\n\r\nworld"), ("open.warc", b"WARC/1.1\r\nA: b")):
        Path(folder, name).write_bytes(bad)
        with pytest.raises((ValueError, OSError)):
            list(warc.read_file(f"{folder}/{name}"))


def test_files_are_planned_by_size():
    planned = warc.plan([("a", 10), ("b", 70), ("c", 30), ("d", 25), ("e", 0)], 64)
    assert sorted(p for part in planned for p in part) == list("abcde")
    assert all(len(part) == 1 or sum({"a": 10, "b": 70, "c": 30, "d": 25, "e": 0}[p] for p in part) <= 70 for part in planned)


def test_no_folder_is_an_empty_table(spark, folder):
    assert warc.read(spark, f"{folder}/none").count() == 0
