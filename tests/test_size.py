"""What keeps work even with the size of the input: how it is dealt out, and that nothing is written that no one reads."""

import os
import shutil
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import Row, functions as F
from pyspark.sql.types import StructType

from riskloom import fixtures, session
from riskloom.catalog import base, scoring, sources, streams
from riskloom.operators import detection, history, rules
from riskloom.streaming import jobs, sinks, state


@pytest.fixture
def own(small, folder):
    """A data folder that no other test has derived tables from."""
    for name in ("lineitem", "orders", "part", "customer"):
        shutil.copyfile(f"{small}/{name}.parquet", f"{folder}/{name}.parquet")
    return folder


def files(place: str, ending: str) -> list[str]:
    return [p.name for p in Path(place).rglob(f"*{ending}")]


def test_feed_is_made_in_tasks_by_size(spark, own, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_BYTES", os.path.getsize(f"{own}/lineitem.parquet") // 10)
    assert fixtures.tasks(spark, own) >= 10
    assert base.feed(spark, own).rdd.getNumPartitions() == fixtures.tasks(spark, own)


def test_only_layers_that_are_read_are_written(spark, own):
    rows = base.silver(spark, own).count()
    built = base.tables(spark, own, "silver")
    assert rows > 0 and not os.path.exists(built.detection) and not os.path.exists(built.alerts)
    assert base.gold(spark, own).count() == rows and not os.path.exists(built.alerts)
    assert base.alerts(spark, own).count() > 0 and base.tables(spark, own) == built


def test_a_layout_is_written_alone_and_json_is_compressed(spark, own):
    root = sources._layout(spark, own, "lines")
    assert os.listdir(root) == ["lines"]
    assert files(root, ".json.gz") and not files(root, ".json")


def test_a_micro_batch_reads_many_files(spark, own, folder, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_BYTES", os.path.getsize(f"{own}/lineitem.parquet") // 10)
    feed, seen = streams._split_feed(spark, own, f"{folder}/run"), []
    sinks.each_batch(feed.select("transaction_id"), lambda rows, n: seen.append((rows.count(), rows.rdd.getNumPartitions())), f"{folder}/check", None).awaitTermination()
    assert len(files(f"{folder}/run/feed", ".parquet")) >= 10
    assert len(seen) == streams.PARTS and sum(n for n, _ in seen) == base.feed(spark, own).count()


class Held:
    """State of one customer that counts the calls made on it."""

    def __init__(self, calls, value=None):
        self.calls, self.value = calls, {} if value is None else value

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            if name == "containsKey":
                return given[0] in self.value
            if name == "updateValue":
                self.value[given[0]] = given[1]
            return None
        return call


def test_state_is_asked_once_for_each_value():
    calls: list[str] = []
    carried = StructType.fromDDL("epoch long, transaction_id string, purchase_latitude double, purchase_longitude double, "
                                 "purchase_state string, bank string, _cents long")
    history = state.History("customer_id", carried, {"new_bank": "bank"})
    history.handle = history.last = history.sums = history.hours = Held(calls)
    history.seen = Held(calls, {("new_bank", "old"): (1,)})
    made = Row(*carried.names)
    rows = [made(1_000_000 + 50_000 * k, f"t{k}", 0.0, 0.0, "SP", "old", 100) for k in range(80)]
    out = list(history._closed(("c",), rows))
    assert not any(r.new_bank for r in out) and out[-1].transactions_last_24h == 2
    assert calls.count("containsKey") == 1 and "exists" not in calls and "removeKey" not in calls


def test_columns_that_are_passed_on_come_back_as_they_were(spark, folder):
    schema = """customer_id string, transaction_id string, event_time timestamp, amount double, purchase_latitude double,
        purchase_longitude double, purchase_state string, note string, at timestamp, share float, n int, yes boolean, day date"""
    at = datetime(2024, 1, 1, 10, 0, 0, 123456, tzinfo=timezone.utc)
    rows = [("a", "t1", at, float("nan"), 1.0, 2.0, "SP", 'q"\n,é', at, 0.1, 3, True, at.date()),
            ("a", "t2", at, -0.1 - 0.2, 1.0, None, None, "", None, float("inf"), None, None, None),
            ("b", "t3", datetime(2024, 1, 3, tzinfo=timezone.utc), 1.0, 1.0, 1.0, "SP", None, at, None, 1, False, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/feed")
    feed = spark.readStream.schema(spark.read.parquet(f"{folder}/feed").schema).parquet(f"{folder}/feed")
    with state.rocksdb(spark):
        sinks.append_table(state.with_history(feed), f"{folder}/out", f"{folder}/check", None).awaitTermination()
    names = ["transaction_id", "amount", "purchase_longitude", "note", "at", "share", "n", "yes", "day"]
    text = lambda df: sorted(str(tuple(r)) for r in df.where(F.col("transaction_id") != "t3").select(*names).collect())
    got = spark.read.parquet(f"{folder}/out")
    assert text(got) == text(spark.createDataFrame(rows, schema)) and len(text(got)) == 2
    assert {f.name: f.dataType for f in got.schema if f.name in names} == {f.name: f.dataType for f in feed.schema if f.name in names}


def test_orders_are_met_last_so_that_tasks_stay_by_size(spark, own, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_BYTES", os.path.getsize(f"{own}/lineitem.parquet") // 10)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert base.feed(spark, own).rdd.getNumPartitions() == fixtures.tasks(spark, own)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_are_brought_together_by_month_while_narrow(spark, own):
    rows = sources._feed(spark, own, "date_trunc('MONTH', o_orderdate)")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    wide, narrow = plan.split("REBALANCE", 1)
    assert "merchant_category" in wide and "merchant_category" not in narrow
    assert sorted(rows.collect(), key=str) == sorted(sources._feed(spark, own).collect(), key=str)


def _moves(spark):
    """One customer with most rows, many of them in one second, some without a customer, a time or a place."""
    rows = [("a", "big", 1000 + k // 40, float(k), -float(k), "SP") for k in range(300)]
    rows += [("b", f"c{k % 7}", 1000 + k, None if k % 5 == 0 else float(k), 1.0, None) for k in range(60)]
    rows += [("n", None, 5 + k % 3, 2.0, 2.0, "RJ") for k in range(30)] + [("t", "late", None, 1.0, 1.0, "SP")]
    shaped = [(f"{kind}{k:04d}", *rest) for k, (kind, *rest) in enumerate(rows)]
    return spark.createDataFrame(shaped, "transaction_id string, customer_id string, epoch long, purchase_latitude double, "
                                         "purchase_longitude double, purchase_state string")


@pytest.mark.parametrize("cuts", [1, 2, 7, 40])
def test_previous_rows_are_the_same_along_with_full_rows(spark, cuts):
    rows = _moves(spark)
    found = history.movement(rows, along=True, cuts=cuts)
    other = history.movement(rows)
    assert found.columns == other.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, other.collect()))
    assert found.where("prev_timestamp is not null").count() == 299 + 53 + 29


def test_previous_rows_of_no_rows(spark):
    assert history.movement(_moves(spark).limit(0), along=True).count() == 0


def test_geo_rows_are_shuffled_once(spark, own):
    rows = base.geo_feed(spark, own)
    plan = detection.geo_detection(rows).select("transaction_id", "fraud_score")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") - plan.count("BroadcastExchange") == 1
    assert "device_latitude" not in plan.split("Exchange hashpartitioning")[0]


def test_joins_with_dimensions_carry_no_columns_of_plain_rules(spark, own):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = scoring._enriched(spark, own)
        plan = scored.select("transaction_id", "risk_points")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = plan.split("Exchange hashpartitioning(device_id")[0]
    assert "_plain_points" in above and "cvv_validated" not in above and "_plain_points" not in scored.columns
    whole = sum((r.points() for r in rules.ENRICHED.rules), F.lit(0))
    assert scored.where("risk_points > 0").count() > 0 and scored.where(whole != F.col("risk_points")).count() == 0


def test_whole_rows_are_deduplicated_in_tasks_by_size(spark, own, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_BYTES", os.path.getsize(f"{own}/lineitem.parquet") // 10)
    seen, write = [], base.batch.write_silver
    monkeypatch.setattr(base.batch, "write_silver", lambda *a, **b: seen.append(int(spark.conf.get("spark.sql.shuffle.partitions"))) or write(*a, **b))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        rows = base.silver(spark, own)
        assert seen == [base.partitions(spark, own)] and seen[0] >= 10
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2" and rows.count() == rows.select("transaction_id").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_geo_rows_are_dealt_in_tasks_by_size(spark, own, monkeypatch):
    monkeypatch.setattr(fixtures, "TASK_BYTES", os.path.getsize(f"{own}/lineitem.parquet") // 10)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        plan = scoring.QUERIES["r3_geo_score"](spark, own)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(_cut#" in plan and base.partitions(spark, own) >= 10
        assert plan.count("Exchange hashpartitioning") == 1 and f", {base.partitions(spark, own)}), REPARTITION_BY_NUM" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_registered_queries_keep_methods_small_enough_to_be_compiled(spark):
    """A session that sets nothing of its own, as a driver's, gets the limit; another's own limit stays."""
    name, limit = session.CODEGEN_LIMIT
    for own, kept in ((None, limit), ("5000", "5000")):
        other = spark.newSession()
        other.conf.set(name, own or "65535")
        assert base.query(lambda s, d: s.range(1))(other, "").count() == 1 and other.conf.get(name) == kept


def test_messages_are_kept_once_and_on_disk_while_they_are_written(spark, folder, monkeypatch):
    """Of a message only what its table takes is kept while both tables are written, and nothing of it in memory."""
    seen, kept = [], jobs.ingest.kept

    def looked_at(rows):
        odd = rows.where("(reason IS NULL AND (raw IS NOT NULL OR key IS NOT NULL)) OR (reason IS NOT NULL AND data IS NOT NULL)").count()
        seen.append((rows.count(), odd, "value" in rows.columns, rows.storageLevel.useMemory))
        return kept(rows)

    monkeypatch.setattr(jobs.ingest, "kept", looked_at)
    texts = [("a", '{"transaction_id": "t1", "amount": 2.5}'), ("b", '{"transaction_id": "t2", "amount": "much"}'), ("c", "{"), ("d", None)]
    spark.createDataFrame(texts, "key string, value string").coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("key string, value string").parquet(f"{folder}/in")
    jobs.messages_to_bronze_or_rejects(stream, f"{folder}/out", f"{folder}/check", None, keep=("key",)).awaitTermination()
    assert seen == [(4, 0, False, False)]
    read = lambda name, *c: sorted(map(tuple, jobs.manifest.read(spark, f"{folder}/out", name).select(*c).collect()))
    assert read("bronze", "transaction_id", "amount") == [("t1", 2.5)]
    assert read("rejected", "key", "reason") == [("b", "WRONG_TYPE"), ("c", "MALFORMED"), ("d", "EMPTY")]


def test_joins_with_dimensions_carry_points_and_not_what_rules_read(spark, own):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = scoring._enriched(spark, own)
        plan = scored.select("transaction_id", "risk_points")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_customer, by_device = plan.split("Exchange hashpartitioning(customer_id")[0], plan.split("Exchange hashpartitioning(device_id")[0]
    assert "device_is_rooted" not in by_customer and "device_risk_score" not in by_customer
    assert "merchant_category" not in by_device and not set(rules.OF_ROW) & set(scored.columns)
    names = [r.name for r in rules.ENRICHED.rules]
    assert names == [r.name for r in (*rules.PLAIN.rules, *rules.DEVICE.rules, *rules.AGE.rules)] and len(names) == 16
