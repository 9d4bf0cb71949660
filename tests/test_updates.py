"""Late days, rejected messages and batches that are published as one."""

import os
import random

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import ingest
from riskloom.plans import layers
from riskloom.sources import readers, writers
from riskloom.streaming import jobs, manifest

RAW = "transaction_id string, customer_id string, timestamp string, amount double, device_id string"


def raw_rows(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    days = ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02", "2024-03-05"]
    rows = [(f"t{rng.randrange(60)}", f"c{rng.randrange(5)}", f"{rng.choice(days)} {rng.randrange(24):02}:00:00", float(k), f"d{k}") for k in range(150)]
    return [*rows, ("t1", "c", "no time", 1.0, "d"), ("once", "c", "2024-02-01 05:00:00", 2.0, "d"), (None, "c", "2024-02-01 06:00:00", 3.0, "d")]


def raw(spark, rows):
    """Rows with all fields of the feed, most of them null."""
    df = spark.createDataFrame(rows, RAW)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schemas.TRANSACTION.fields if f.name not in df.columns})


def files(path: str) -> dict[str, set[str]]:
    return {folder.removeprefix(path): {n for n in names if n.endswith(".parquet")} for folder, _, names in os.walk(path) if any(n.endswith(".parquet") for n in names)}


def table(spark, path: str) -> list[str]:
    columns = ["transaction_id", "customer_id", "timestamp", "amount", "device_id"]
    return sorted(str(tuple(r)) for r in readers.table(spark, path).select(*columns).collect())


def test_a_late_day_gives_the_full_run(spark, folder):
    full = raw_rows()
    late = [r for r in full if r[2].startswith("2024-02-01")]
    # Of the day as it was first, half is missing, one row has other values, and one transaction is no longer there.
    first = [r for r in full if r not in late] + late[::2] + [("t2", "c9", "2024-02-01 00:00:00", 99.0, "x"), ("gone", "c", "2024-02-01 00:00:00", 9.0, "x")]
    for name, rows in (("full", full), ("part", first)):
        at = layers.Layers(f"{folder}/{name}")
        layers.write_bronze(raw(spark, rows), at, "parquet")
        layers.write_silver(readers.table(spark, at.bronze), at)
    at, want = layers.Layers(f"{folder}/part"), layers.Layers(f"{folder}/full")
    before = files(at.bronze), files(at.silver)
    undated = [("t1", "c", "other", 5.0, "d")]
    for _ in range(2):  # run again after a failure, say: the same result
        counts = layers.rerun_days(spark, raw(spark, late + undated), at.root)
        assert counts["days"] == 1 and counts["undated"] == 1 and counts["months"] <= 4
        assert table(spark, at.bronze) == table(spark, want.bronze)
        assert table(spark, at.silver) == table(spark, want.silver)
    after = files(at.bronze)
    touched = {f for f in after if before[0].get(f) != after[f]}
    assert touched == {"/year=2024/month=2/day=1"}


def test_untouched_months_keep_their_files(spark, folder):
    rows = [(f"{month}-{k}", "c", f"2024-{month:02}-01 00:00:00", 1.0, "d") for month in (1, 2, 3) for k in range(5)]
    at = layers.Layers(folder)
    layers.write_bronze(raw(spark, rows), at, "parquet")
    layers.write_silver(readers.table(spark, at.bronze), at)
    before = files(at.silver)
    layers.rerun_days(spark, raw(spark, [("new", "c", "2024-02-01 01:00:00", 1.0, "d")]), folder)
    after = files(at.silver)
    assert {f for f in after if after[f] != before.get(f)} == {"/tx_year=2024/tx_month=2"}
    assert [r for r in table(spark, at.silver) if "2024-02" in r] == ["('new', 'c', '2024-02-01 01:00:00', 1.0, 'd')"]
    assert layers.rerun_days(spark, raw(spark, []), folder)["days"] == 0


def test_a_partition_without_rows_is_removed(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, part string")
    writers.write_table(df, folder, ["part"])
    written = readers.table(spark, folder)
    writers.replace_partitions(written.where("n = 2").withColumn("n", F.lit(20)), folder, ["part"], [("a",), ("b",), (None,)])
    assert [tuple(r) for r in readers.table(spark, folder).collect()] == [(20, "b")]


MESSAGES = [
    ("ok", '{"transaction_id": "t1", "amount": 1.5, "is_fraud": true}'), ("null field", '{"transaction_id": "t2", "amount": null}'),
    ("unknown field", '{"transaction_id": "t3", "more": {"a": 1}}'), ("cut", '{"transaction_id": "t4", "amo'), ("no object", "[1, 2"), ("word", "hello"),
    ("no key", '{"amount": 1.5}'), ("null key", '{"transaction_id": null}'), ("type", '{"transaction_id": "t5", "amount": "much", "is_fraud": 7}'),
    ("empty", ""), ("blank", " \t"), ("none", None),
]
REASONS = {"cut": "MALFORMED", "no object": "MALFORMED", "word": "MALFORMED", "no key": "NO_KEY", "null key": "NO_KEY", "type": "WRONG_TYPE",
           "empty": "EMPTY", "none": "EMPTY"}


def test_every_message_is_kept_or_rejected_with_a_reason(spark):
    seen = ingest.examined(spark.createDataFrame(MESSAGES, "key string, value string"))
    got = {r.key: (r.reason, r.fields, r.raw) for r in seen.collect()}
    assert len(got) == len(MESSAGES)
    assert {k: r for k, (r, _, _) in got.items() if r and k != "blank"} == REASONS
    assert got["type"][1] == ["amount", "is_fraud"] and got["cut"][2] == MESSAGES[3][1]
    assert sorted(r.transaction_id for r in ingest.kept(seen).collect()) == ["t1", "t2", "t3"]
    assert ingest.rejected(seen, "key").columns == ["reason", "fields", "raw", "key"]
    lenient = ingest.examined(spark.createDataFrame(MESSAGES, "key string, value string"), strict=False)
    rows = {r.transaction_id: r.amount for r in ingest.kept(lenient).collect()}
    assert rows == {"t1": 1.5, "t2": None, "t3": None, "t5": None}
    assert sorted(rows) == sorted(r.transaction_id for r in ingest.parse_json(spark.createDataFrame(MESSAGES, "key string, value string")).collect())


def test_kept_and_rejected_add_up_in_a_stream(spark, folder):
    spark.createDataFrame(MESSAGES, "key string, value string").repartition(3).write.parquet(f"{folder}/in")
    stream = readers.parquet_stream(spark, f"{folder}/in", spark.read.parquet(f"{folder}/in").schema, 1)
    jobs.messages_to_bronze_or_rejects(stream, f"{folder}/out", f"{folder}/check", None, keep=("key",)).awaitTermination()
    kept, rejected = (manifest.read(spark, f"{folder}/out", name) for name in ("bronze", "rejected"))
    assert kept.count() + rejected.count() == len(MESSAGES) and "processed_at" in rejected.columns


def frames(spark, n: int):
    rows = spark.createDataFrame([(n, k) for k in range(3)], "batch int, k int")
    return {"all": rows, "some": rows.where("k = 0")}


def both(spark, root: str):
    at = manifest.snapshot(spark, root)
    return [sorted(r.batch for r in manifest.read(spark, root, name, at).collect()) for name in ("all", "some")]


def test_a_batch_that_fails_between_its_tables_shows_in_neither(spark, folder):
    manifest.publish_batch(frames(spark, 0), folder, 0)
    broken = frames(spark, 1) | {"some": spark.range(1).select(F.raise_error(F.lit("lost")).alias("batch"))}
    with pytest.raises(Exception, match="lost"):
        manifest.publish_batch(broken, folder, 1)
    assert os.path.isdir(f"{folder}/all/batch_id=1") and both(spark, folder) == [[0] * 3, [0]]
    for _ in range(2):  # the batch is repeated, and once more though it was published
        manifest.publish_batch(frames(spark, 1), folder, 1)
    assert both(spark, folder) == [[0] * 3 + [1] * 3, [0, 1]]


def test_compaction_changes_nothing_for_readers(spark, folder):
    with pytest.raises(FileNotFoundError):
        manifest.read(spark, folder, "all")
    for n in range(4):
        manifest.publish_batch(frames(spark, n), folder, n)
    at = manifest.snapshot(spark, folder)
    assert manifest.compact(spark, folder) == 3 and manifest.compact(spark, folder) == 0
    want = [[n for n in range(4) for _ in range(3)], [0, 1, 2, 3]]
    assert both(spark, folder) == want
    assert manifest.read(spark, folder, "all", at).count() == 12  # a reader that began before
    assert len(manifest.snapshot(spark, folder)["all"]) == 2
    manifest.publish_batch(frames(spark, 2), folder, 2)  # long published
    for n in (4, 5):
        manifest.publish_batch(frames(spark, n), folder, n)
    assert manifest.compact(spark, folder) == 2
    assert both(spark, folder) == [[n for n in range(6) for _ in range(3)], list(range(6))]
    assert sorted(os.listdir(f"{folder}/all-merged")) == ["upto=2", "upto=4"] and not os.path.isdir(f"{folder}/all/batch_id=0")
