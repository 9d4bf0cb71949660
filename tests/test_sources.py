"""Readers, writers and ingestion on files."""

import json
import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.catalog import base
from riskloom.operators import ingest
from riskloom.sources import readers, writers

FIELDS = [f.name for f in schemas.TRANSACTION.fields]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(f"t{i}", f"c{i % 3}", f"2024-0{1 + i % 3}-1{i % 9}T10:00:00", 10.0 + i, "PIX") for i in range(40)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, timestamp string, amount double, type string")
    return schemas.pick(df, FIELDS).cache()


def test_source_resolution_takes_the_first_layout_with_rows(spark, raw, folder):
    flat, dated = f"{folder}/raw/batch", f"{folder}/raw"
    with pytest.raises(FileNotFoundError):
        readers.resolve_source(spark, flat, dated)
    days = ingest.with_date_columns(raw)
    days.write.partitionBy("year", "month", "day").json(f"{folder}/json_days")
    found = readers.resolve_source(spark, f"{folder}/json_days/none", f"{folder}/json_days")
    assert (found.format, found.rows.count()) == ("jsonl", 40)
    assert {"year", "month", "day"} <= set(found.rows.columns)
    raw.write.json(flat)
    found = readers.resolve_source(spark, flat, dated)
    assert (found.format, found.path, found.rows.count()) == ("jsonl", flat, 40)
    raw.coalesce(1).write.parquet(f"{flat}/transactions_1.parquet")
    found = readers.resolve_source(spark, flat, dated)
    assert (found.format, found.rows.count()) == ("parquet", 40)


def test_source_resolution_reads_dated_parquet(spark, folder):
    table = pa.table({"transaction_id": ["a", "b"], "customer_id": ["c", "c"], "amount": [1.0, 2.0]})
    for day in ("01", "02"):
        target = f"{folder}/year=2024/month=01/day={day}"
        os.makedirs(target)
        pq.write_table(table, f"{target}/transactions_x.parquet")
    found = readers.resolve_source(spark, f"{folder}/flat", folder)
    assert (found.format, found.rows.count()) == ("parquet", 4)
    assert {r.day for r in found.rows.select("day").distinct().collect()} == {1, 2}


def test_other_read_errors_are_raised(spark, folder):
    with open(f"{folder}/transactions_bad.parquet", "w") as f:
        f.write("this is no parquet file")
    with pytest.raises(Exception) as error:
        readers.resolve_source(spark, folder, f"{folder}/none")
    assert not isinstance(error.value, FileNotFoundError)


def test_json_readers(spark, raw, folder):
    raw.write.json(f"{folder}/a/b")
    assert readers.json_lines(spark, f"{folder}/a", recursive=True).count() == 40
    assert "transaction_id" in readers.json_inferred(spark, f"{folder}/a/b").columns
    assert readers.json_lines(spark, f"{folder}/a/b", schemas.DEVICE).columns == [f.name for f in schemas.DEVICE.fields]


def test_partition_columns_come_back_only_by_discovery(spark, raw, folder):
    writers.write_table(ingest.with_date_columns(raw), f"{folder}/t", ["year", "month"], rebalance=True)
    assert {"year", "month"} <= set(readers.table(spark, f"{folder}/t").columns)
    lost = readers.all_files(spark, f"{folder}/t")
    assert lost.count() == 40 and "year" not in lost.columns


def test_json_messages(spark):
    texts = ['{"transaction_id": "a", "amount": 5.5, "is_fraud": true}', '{"amount": 1}', "no json at all",
             '{"transaction_id": "b", "amount": "many", "status": "APPROVED"}', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string").withColumn("value", F.col("value").cast("binary"))
    got = [tuple(r) for r in ingest.parse_json(df).select("transaction_id", "amount", "is_fraud", "status").collect()]
    assert got == [("a", 5.5, True, None), ("b", None, None, "APPROVED")]


def test_envelopes(spark, raw):
    topic = spark.createDataFrame(
        [(b"k", b'{"x": 1}', "tx", 3, 42, datetime(2024, 1, 1))],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    wrapped = ingest.envelope_from_topic(topic)
    assert not schemas.schema_gaps(wrapped, schemas.ENVELOPE)
    row = wrapped.first()
    assert (row.kafka_key, row.raw_json, row.kafka_partition, row.kafka_offset) == ("k", '{"x": 1}', 3, 42)
    from_files = ingest.envelope_from_rows(raw)
    assert not schemas.schema_gaps(from_files, schemas.ENVELOPE)
    back = ingest.parse_json(from_files, "raw_json")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in raw.collect()}


def test_drifted_types_are_brought_back(spark):
    df = spark.createDataFrame([("a", 3.0, 7, "12.5"), ("b", None, None, "x")],
                               "transaction_id string, installments double, time_since_last_txn_min int, amount string")
    fixed = schemas.conform(df)
    assert dict(fixed.dtypes) == {"transaction_id": "string", "installments": "int",
                                  "time_since_last_txn_min": "double", "amount": "double"}
    assert [tuple(r) for r in fixed.collect()] == [("a", 3, 7.0, 12.5), ("b", None, None, None)]


def test_malformed_times_give_null_dates(spark):
    df = spark.createDataFrame([("2024-02-30T00:00:00",), ("nonsense",), ("2024-02-03T04:05:06",), (None,)], "timestamp string")
    got = [tuple(r) for r in ingest.with_date_columns(df).select("year", "month", "day").collect()]
    assert got == [(None,) * 3, (None,) * 3, (2024, 2, 3), (None,) * 3]
    assert ingest.with_date_columns(df.withColumnRenamed("timestamp", "other")).columns == ["other"]


def test_portuguese_feed_becomes_the_main_feed(spark):
    names = {v: k for k, v in schemas.PT_TRANSACTION_NAMES.items()}
    assert len(names) == 23
    pt = spark.createDataFrame([], schemas.TRANSACTION).withColumnsRenamed(names)
    assert "valor" in pt.columns and not schemas.schema_gaps(ingest.from_portuguese(pt), schemas.TRANSACTION)
    people = ingest.customers_from_portuguese(spark.createDataFrame([], schemas.CUSTOMER))
    assert {"tax_id", "full_name", "birth_date", "monthly_income"} <= set(people.columns)


def test_nanosecond_files(spark, folder):
    nanos = [1_700_000_000_123_456_000, None, -1_000]
    table = pa.table({"id": [1, 2, 3], "at": pa.array(nanos, pa.timestamp("ns"))})
    pq.write_table(table, f"{folder}/n.parquet", version="2.6")
    fixed = ingest.read_nanosecond_parquet(spark, f"{folder}/n.parquet", ["at"])
    assert dict(fixed.dtypes)["at"] == "timestamp"
    writers.write_table(fixed, f"{folder}/out")
    got = [r[0] for r in spark.read.parquet(f"{folder}/out").orderBy("id").select(F.unix_micros("at")).collect()]
    assert got == [1_700_000_000_123_456, None, -1]


def test_counts_come_from_the_write(spark, raw, folder):
    metrics = writers.write_counted(raw, f"{folder}/t", {"rows": F.count(F.lit(1)), "amount": F.sum("amount")})
    assert metrics == {"rows": 40, "amount": sum(10.0 + i for i in range(40))}
    assert writers.verify_count(spark, f"{folder}/t", 40) and not writers.verify_count(spark, f"{folder}/t", 41)


def test_copy_keeps_partitioning(spark, raw, folder):
    writers.write_table(raw, f"{folder}/a", ["type"], stamp_as="_written")
    assert writers.copy_table(spark, f"{folder}/a", f"{folder}/b", ["type"]) == 40
    copied = spark.read.parquet(f"{folder}/b")
    assert copied.columns[-1] == "type" and "_written" in copied.columns


def test_source_file_of_each_row(spark, raw, folder):
    raw.write.json(f"{folder}/j")
    named = ingest.with_source_file(readers.json_lines(spark, f"{folder}/j"))
    assert named.where(F.col("_source_file").contains("/j/part-")).count() == 40


def test_option_sets():
    batch = readers.topic_batch_options("host:1", "tx")
    assert (batch["startingOffsets"], batch["endingOffsets"]) == ("earliest", "latest")
    stream = readers.topic_stream_options("host:1", "tx")
    assert "maxOffsetsPerTrigger" not in stream
    assert (stream["failOnDataLoss"], stream["startingOffsets"]) == ("false", "latest")
    assert readers.topic_stream_options("host:1", "tx", per_trigger=10_000)["maxOffsetsPerTrigger"] == "10000"
    assert "maxOffsetsPerTrigger" not in readers.topic_stream_options("host:1", "tx", per_trigger=None)
    load = writers.jdbc_options("jdbc:x", "t", {"user": "u"})
    assert (load["batchsize"], load["rewriteBatchedInserts"], load["numPartitions"], load["truncate"], load["user"]) == (
        "10000", "true", "8", "true", "u")
    assert writers.jdbc_options("jdbc:x", "t", truncate=False)["truncate"] == "false"


def test_schema_gaps(spark):
    df = spark.createDataFrame([(1, "x")], "transaction_id long, customer_id string")
    gaps = schemas.schema_gaps(df, schemas.TRANSACTION)
    assert gaps[0] == ("transaction_id", "string", "bigint") and len(gaps) == 37


def test_whole_batch_run(spark, small, folder):
    from riskloom.plans import layers
    raw = base.feed(spark, small)
    counts = layers.run_batch(spark, raw, folder)
    total, unique = raw.count(), raw.select("transaction_id").distinct().count()
    assert counts == {"bronze": total, "silver": unique, "gold": unique}
    at = layers.Layers(folder)
    scored = spark.read.parquet(at.detection)
    assert set(scored.columns) == {*schemas.GOLD_COLUMNS, "_gold_timestamp"}
    assert spark.read.parquet(at.alerts).columns == [*schemas.ALERT_COLUMNS, "created_at"]
    metrics = spark.read.parquet(at.path("gold/fraud_metrics")).agg(
        F.sum("total_transactions"), F.sum(F.expr("critical_count + high_count + medium_count + low_count"))).first()
    assert tuple(metrics) == (unique, unique)
    again = {tuple(r) for r in base.gold(spark, small).select("transaction_id", "risk_points").collect()}
    assert again == {tuple(r) for r in scored.select("transaction_id", "risk_points").collect()}


def test_enriched_run(spark, small, folder):
    from riskloom.plans import layers
    raw = base.feed(spark, small)
    layers.run_enriched(raw, base.raw_devices(spark, small), base.raw_customers(spark, small), folder, base.as_of_date())
    at = layers.Layers(folder)
    unique = raw.select("transaction_id").distinct().count()
    assert spark.read.parquet(at.detection).count() == unique
    summary = spark.read.parquet(at.path("gold/customer_summary"))
    assert summary.count() == raw.select("customer_id").distinct().count()
    assert {"customer_risk_level", "income_band", "full_name"} <= set(summary.columns)


def geo_rows(n=60):
    return [{
        "transaction_id": f"g{i}", "customer_id": f"c{i % 4}", "amount": 100.0 * (i % 30), "merchant": f"m{i % 3}",
        "category": ["electronics", "food"][i % 2], "transaction_hour": float(i % 24), "customer_home_state": "SP",
        "purchase_state": ["SP", "AM"][i % 2], "purchase_latitude": -23.0 + i % 7, "purchase_longitude": -46.0,
        "device_latitude": -23.0 + (i % 50), "device_longitude": -46.0, "installments": i % 13,
        "had_travel_purchase_last_12m": i % 3 == 0, "is_first_purchase_in_state": i % 5 == 0,
        "transactions_last_24h": float(i % 18), "avg_transaction_amount_30d": 90.0, "is_international": i % 8 == 0,
        "is_online": i % 2 == 0, "is_fraud": i % 9 == 0, "timestamp": 1_700_000_000 + 600 * i,
    } for i in range(n)]


def test_geo_run_from_message_text(spark, folder):
    from riskloom.operators import detection, history
    from riskloom.plans import layers
    texts = spark.createDataFrame([(json.dumps(r),) for r in geo_rows()], "raw_json string")
    layers.run_geo(texts, folder)
    at = layers.Layers(folder)
    scored = spark.read.parquet(at.detection)
    assert scored.count() == 60 and scored.select("risk_level").distinct().count() > 2
    parsed = history.with_epoch(ingest.parse_json(texts, "raw_json", schemas.GEO), "timestamp", "seconds")
    direct = {tuple(r) for r in detection.geo_detection(parsed).select("transaction_id", "fraud_score").collect()}
    assert direct == {tuple(r) for r in scored.select("transaction_id", "fraud_score").collect()}
    alerts = spark.read.parquet(at.path("gold/fraud_alerts"))
    assert dict(alerts.dtypes)["fraud_score"] == "int"
    assert alerts.count() == scored.where(F.col("risk_level").isin("HIGH", "CRITICAL")).count() > 0
    assert spark.read.parquet(at.path("gold/metrics_by_level")).agg(F.sum("total")).first()[0] == 60


def test_sensitive_run(spark, folder):
    from riskloom.plans import layers
    texts = spark.createDataFrame([(json.dumps(r),) for r in geo_rows()], "value string")
    layers.run_sensitive(ingest.parse_json(texts, schema=schemas.GEO), folder, amount="amount")
    at = layers.Layers(folder)
    assert spark.read.parquet(at.path("gold/transactions")).count() == 60
    assert spark.read.parquet(at.path("gold/metrics_by_category")).agg(F.sum("count")).first()[0] == 60


def test_simple_run(spark, small, folder):
    from riskloom.plans import layers
    layers.run_simple(base.feed(spark, small), base.raw_customers(spark, small), folder)
    at = layers.Layers(folder)
    cleaned = spark.read.parquet(at.silver)
    assert cleaned.where("amount <= 0 OR amount IS NULL").isEmpty()
    assert spark.read.parquet(at.path("gold/fraud_summary")).first()["total_transactions"] == cleaned.count()
    assert spark.read.parquet(at.path("gold/customer_summary")).agg(F.sum("transactions")).first()[0] == cleaned.count()


def test_layers_meet_their_contracts(spark, small):
    from riskloom.plans import quality
    wanted = schemas.contract("transaction_id string, tx_year integer, risk_points integer, missing string")
    assert quality.schema_report({"detection": base.gold(spark, small)}, {"detection": wanted}) == {
        "detection": [("missing", "string", None)]}


def test_work_folder_is_the_one_the_session_names(spark):
    from riskloom.session import work_folder

    class Session:
        sparkContext = spark.sparkContext

        def __init__(self, named):
            self.conf = {"spark.checkpoint.dir": named} if named else {}

    assert work_folder(Session("hdfs://shared/check/")) == "hdfs://shared/check"
    own = work_folder(Session(None))
    assert own.startswith("/tmp/run-") and work_folder(Session(None)) == own
