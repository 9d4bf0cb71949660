"""Streams in several micro-batches against the same work on tables."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import detection, marts
from riskloom.sources import readers
from riskloom.streaming import jobs, sinks

START = datetime(2024, 1, 1)


def message(i):
    fields = {
        "transaction_id": f"t{i}", "customer_id": f"c{i % 7}", "type": ["PIX", "CREDIT_CARD"][i % 2],
        "timestamp": (START + timedelta(seconds=(i * 37) % 600)).isoformat(), "amount": round((i % 13) * 900.5 - 500, 2),
        "channel": ["WEB_BANKING", "ATM"][i % 2], "merchant_name": f"m{i % 4}", "merchant_category": f"k{i % 3}",
        "fraud_score": float((i * 11) % 90), "is_fraud": [True, False, None][i % 3], "new_beneficiary": i % 5 == 0,
        "transactions_last_24h": i % 20, "distance_from_last_txn_km": float(i % 200), "auth_3ds": i % 4 == 0,
        "card_brand": "Visa" if i % 2 else None, "card_type": "CREDIT" if i % 2 else None, "installments": i % 6,
        "card_entry": "MANUAL" if i % 9 == 0 else "CHIP", "mcc_risk_level": ["high", "medium", "low", None][i % 4],
        "accumulated_amount_24h": i * 100.0, "unusual_time": i % 6 == 0, "status": "APPROVED",
    }
    return json.dumps(fields)


@pytest.fixture
def topic(folder):
    """Four files, read one per micro-batch; every minute is spread over all of them."""
    for part in range(4):
        with open(f"{folder}/in-{part}.txt", "w") as f:
            f.write("\n".join([message(i) for i in range(part, 200, 4)] + ["broken", '{"amount": 1}']) + "\n")
    return folder


@pytest.fixture
def table(spark, topic):
    from riskloom.operators import ingest
    return ingest.parse_json(spark.read.text(f"{topic}/in-*.txt")).cache()


def transactions(spark, topic):
    from riskloom.operators import ingest
    return ingest.parse_json(readers.text_stream(spark, f"{topic}/in-*.txt", 1))


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_three_hops(spark, topic, table):
    messages = readers.text_stream(spark, f"{topic}/in-*.txt", 1)
    at = jobs.three_hops(spark, messages, f"{topic}/out")
    silver = detection.stream_silver(table)
    assert spark.read.parquet(at["bronze"]).count() == 200
    written = spark.read.parquet(at["silver"])
    assert written.columns == [*schemas.STREAM_SILVER_COLUMNS, "silver_processed_at"]
    assert rows(written.drop("silver_processed_at")) == rows(silver)
    assert rows(spark.read.parquet(at["alerts"]).drop("silver_processed_at")) == rows(detection.stream_alerts(silver))
    for name, build in marts.RUNNING.items():
        assert rows(sinks.read_newest(spark, f"{at['metrics']}/{name}")) == rows(build(silver))


def test_three_hops_keep_running(spark, topic):
    messages = readers.text_stream(spark, f"{topic}/in-*.txt", 1)
    at = jobs.three_hops(spark, messages, f"{topic}/out", every="1 second")
    running = spark.streams.active
    try:
        assert len(running) == 7
        for _ in range(3):
            for query in running:
                query.processAllAvailable()
    finally:
        for query in running:
            query.stop()
    metrics = sinks.read_newest(spark, f"{at['metrics']}/metrics_by_type")
    assert metrics.agg(F.sum("total_transactions")).first()[0] == 200


def test_live_windows_merge_to_the_batch_result(spark, topic, table):
    write = sinks.batch_folder_writer(f"{topic}/live")
    jobs.live_dashboard(transactions(spark, topic), write, f"{topic}/check", None).awaitTermination()
    timed = jobs.with_event_time(table)
    before = [jobs.read_live(spark, f"{topic}/live", n).collect() for n in (*jobs.LIVE_GROUPS, jobs.RECENT)]
    partials = sinks.read_batches(spark, f"{topic}/live", "streaming_metrics")
    assert partials.count() > partials.select("window_start").distinct().count()
    for name, group in jobs.LIVE_GROUPS.items():
        got = jobs.read_live(spark, f"{topic}/live", name)
        assert rows(got) == rows(marts.minute_metrics(marts.minute_partials(timed, group), group))
        kind = schemas.LIVE_GROUP_FIELDS.format(key=group) if group else schemas.LIVE_METRICS_FIELDS
        assert schemas.as_contract(got, kind).count() == got.count()
    frauds = jobs.read_live(spark, f"{topic}/live", jobs.RECENT)
    assert frauds.count() == table.where("is_fraud").count()
    jobs.compact_live(spark, f"{topic}/live")
    assert sinks.numbered(spark, f"{topic}/live/streaming_metrics", "batch_id") == [3]
    after = [jobs.read_live(spark, f"{topic}/live", n).collect() for n in (*jobs.LIVE_GROUPS, jobs.RECENT)]
    assert [sorted(map(str, x)) for x in after] == [sorted(map(str, x)) for x in before]
    reports = {}
    jobs.publish_live(spark, f"{topic}/live", lambda df, name: reports.update({name: dict(df.dtypes)}))
    assert reports["streaming_metrics"]["fraud_rate"] == "decimal(5,4)"
    assert all(kinds["processed_at"] == "timestamp" for kinds in reports.values())


def test_latest_frauds_of_all_batches(spark, folder):
    """Three batches of 150 frauds each: the latest hundred of all, whichever batch they came in."""
    for part in range(3):
        lines = [json.dumps({"transaction_id": f"t{i:03d}", "timestamp": (START + timedelta(seconds=i)).isoformat(),
                             "is_fraud": True, "amount": 1.0}) for i in range(part, 450, 3)]
        with open(f"{folder}/in-{part}.txt", "w") as f:
            f.write("\n".join(lines))
    write = sinks.batch_folder_writer(f"{folder}/live")
    jobs.live_dashboard(transactions(spark, folder), write, f"{folder}/check", None).awaitTermination()
    got = jobs.read_live(spark, f"{folder}/live", jobs.RECENT).collect()
    assert [r.transaction_id for r in got] == [f"t{i:03d}" for i in range(449, 349, -1)]


def test_odd_amounts_never_stop_a_job(spark, folder):
    amounts = ["NaN", "1e18", "-1e300", "Infinity", "10.004", "10.004", '"x"', "null", "7"]
    with open(f"{folder}/in-0.txt", "w") as f:
        f.write("\n".join(f'{{"transaction_id": "t{i}", "timestamp": "2024-01-01T00:00:00", "is_fraud": true, "amount": {a}}}'
                          for i, a in enumerate(amounts)))
    write = sinks.batch_folder_writer(f"{folder}/live")
    jobs.live_dashboard(transactions(spark, folder), write, f"{folder}/check", None).awaitTermination()
    row = jobs.read_live(spark, f"{folder}/live", "streaming_metrics").first()
    assert (row.total_transactions, row.total_amount, row.avg_amount) == (9, 27.0, 9.0)
    table = transactions_table(spark, folder)
    assert marts.totals(table).first().total_amount == 27.0
    assert marts.fraud_summary(table).first().fraud_amount == 27.0
    silver = detection.stream_silver(table)
    assert sorted(r.amount_clean for r in silver.collect() if r.amount_clean is not None)[:3] == [7.0, 10.0, 10.0]


def transactions_table(spark, folder):
    from riskloom.operators import ingest
    return ingest.parse_json(spark.read.text(f"{folder}/in-*.txt"))


def test_a_failed_version_leaves_the_one_before(spark, folder):
    spark.range(3).write.parquet(f"{folder}/t/version=0")
    spark.range(5).write.parquet(f"{folder}/t/version=1")
    import os
    os.makedirs(f"{folder}/t/version=2/_temporary")
    assert sinks.read_newest(spark, f"{folder}/t").count() == 5
    with pytest.raises(FileNotFoundError):
        sinks.read_newest(spark, f"{folder}/none")


def test_fan_out_is_repeatable(spark, topic, table):
    write = sinks.batch_folder_writer(f"{topic}/loaded")

    def twice(df, name, batch_id):
        write(df, name, batch_id)
        write(df, name, batch_id)

    jobs.score_and_fan_out(transactions(spark, topic), twice, f"{topic}/check", None).awaitTermination()
    loaded = sinks.read_batches(spark, f"{topic}/loaded", "transactions")
    assert loaded.columns == schemas.STREAM_LOAD_COLUMNS
    assert rows(loaded) == rows(detection.load_columns(detection.stream_load(table), schemas.STREAM_LOAD_COLUMNS))
    alerts = sinks.read_batches(spark, f"{topic}/loaded", "fraud_alerts")
    assert alerts.columns == schemas.STREAM_LOAD_ALERT_COLUMNS
    assert alerts.count() == loaded.where(F.col("risk_level").isin("HIGH", "CRITICAL")).count() > 0
    # Starting again from the same checkpoint finds nothing new.
    jobs.score_and_fan_out(transactions(spark, topic), twice, f"{topic}/check", None).awaitTermination()
    assert sinks.read_batches(spark, f"{topic}/loaded", "transactions").count() == 200


def test_empty_batches_are_skipped(spark, topic):
    seen = []
    nothing = transactions(spark, topic).where("amount > 1e12")
    sinks.each_batch(nothing, lambda df, n: seen.append(n), f"{topic}/check", None).awaitTermination()
    assert seen == []


def stream_of(spark, folder, batches):
    import os
    os.makedirs(f"{folder}/ev")
    for n, batch in enumerate(batches):
        path = f"{folder}/ev/{n}.json"
        with open(path, "w") as f:
            f.writelines(json.dumps({"transaction_id": i, "event_time": t, "amount": 1.0, "is_fraud": False}) + "\n" for i, t in batch)
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    schema = "transaction_id string, event_time timestamp, amount double, is_fraud boolean"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/ev")


BATCHES = [
    [("a", "2024-01-01T00:00:10"), ("b", "2024-01-01T00:05:00")],
    [("a", "2024-01-01T00:01:00"), ("c", "2024-01-01T00:00:50")],  # late, inside the 10 minutes
    [("d", "2024-01-01T00:30:00")],
    [("g", "2024-01-01T00:30:10")],  # Spark judges lateness by the watermark of the batch before
    [("e", "2024-01-01T00:00:20")],  # too late
    [("f", "2024-01-01T01:00:00")],
]


def test_event_time_windows_take_late_rows_until_the_watermark(spark, folder):
    windows = jobs.event_time_windows(stream_of(spark, folder, BATCHES))
    sinks.append_table(windows, f"{folder}/out", f"{folder}/check", None).awaitTermination()
    got = {r.window_start.strftime("%H:%M"): r.total_transactions for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {"00:00": 2, "00:01": 1, "00:05": 1, "00:30": 2}  # 01:00 is still open


def test_stream_deduplication(spark, folder):
    unique = jobs.unique_within(stream_of(spark, folder, BATCHES)).select("transaction_id")
    sinks.append_table(unique, f"{folder}/out", f"{folder}/check", None).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "b", "c", "d", "f", "g"]


def test_registered_streams_read_tables_kept_as_folders(spark, small, folder):
    from riskloom.catalog import streams
    for name in ("lineitem", "orders", "part", "events"):
        spark.read.parquet(f"{small}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    for name in ("t4_metrics_by_channel", "t_event_time_windows"):
        whole, parts = streams.QUERIES[name](spark, small), streams.QUERIES[name](spark, folder)
        assert rows(whole) == rows(parts) and whole.count() > 0
