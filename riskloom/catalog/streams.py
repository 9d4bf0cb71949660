"""Streaming jobs (T), drained over everything the tables hold and then read back.

Line items arrive as a file stream and meet the other tables as static sides, so the stream carries the
whole transaction feed. Streams are not de-duplicated.
"""

import threading
import uuid

from pyspark.sql import functions as F

from riskloom import fixtures
from riskloom.catalog.aggregates import RECENT_SQL, RUNNING_SQL
from riskloom.catalog.base import CTES, check, geo_feed, half_up, input_version, query, text
from riskloom.catalog.cleaning import EXAMINED_SQL, FEED, FEED_SQL, damaged_messages
from riskloom.catalog.histories import MOVEMENT, PAST
from riskloom.operators import detection, ingest, marts
from riskloom.schemas import STREAM_ALERT_COLUMNS, STREAM_LOAD_ALERT_COLUMNS, STREAM_LOAD_COLUMNS, TRANSACTION, pick
from riskloom.session import work_folder
from riskloom.sources import readers
from riskloom.streaming import jobs, manifest, sinks, state


def _folder(spark) -> str:
    return f"{work_folder(spark)}/riskloom-stream-{uuid.uuid4().hex}"


def _file_stream(spark, sf, name):
    # The pattern also matches a folder of files of that name.
    schema = spark.read.parquet(f"{sf}/{name}.parquet").schema
    return readers.parquet_stream(spark, f"{sf}/{name}.parquet*", schema)


def _transactions(spark, sf):
    lines = _file_stream(spark, sf, "lineitem")
    stream = fixtures.fixture(spark, sf, fixtures.FX_TX, lineitem=lines)
    return stream.withColumnRenamed("event_ts", "timestamp")


def _messages(spark, sf):
    """The feed as JSON message values."""
    return ingest.to_json_text(pick(_transactions(spark, sf), [f.name for f in TRANSACTION.fields]), "value")


def _bronze(spark, sf):
    root = _folder(spark)
    jobs.messages_to_bronze(_messages(spark, sf), f"{root}/bronze", f"{root}/check", None).awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select(*FEED)


def _silver(spark, sf):
    root = _folder(spark)
    jobs.bronze_to_silver(_transactions(spark, sf), f"{root}/silver", f"{root}/check", None).awaitTermination()
    return spark.read.parquet(f"{root}/silver")


SILVER = """transaction_id customer_id device_id event_time transaction_hour type amount_clean channel
    is_pix_new_beneficiary is_high_value is_high_velocity is_high_accumulated is_location_jump
    is_manual_card_entry is_no_3ds_online fraud_score fraud_score_additional fraud_score_combined risk_level
    is_fraud""".split()


def _alerts(spark, sf):
    """Messages to Bronze, Silver and alerts, each hop reading the files of the one before."""
    root = _folder(spark)
    jobs.messages_to_bronze(_messages(spark, sf), f"{root}/bronze", f"{root}/check/1", None).awaitTermination()
    bronze = readers.parquet_stream(spark, f"{root}/bronze", jobs.bronze_schema())
    jobs.bronze_to_silver(bronze, f"{root}/silver", f"{root}/check/2", None).awaitTermination()
    silver = readers.parquet_stream(spark, f"{root}/silver", jobs.silver_schema())
    jobs.silver_to_alerts(silver, f"{root}/alerts", f"{root}/check/3", None).awaitTermination()
    return spark.read.parquet(f"{root}/alerts").select(*STREAM_ALERT_COLUMNS)


def _running(name):
    def build(spark, sf):
        root = _folder(spark)
        silver = detection.stream_silver(_split_feed(spark, sf, root))
        started = sinks.replace_table(marts.RUNNING[name](silver), f"{root}/{name}", f"{root}/check", None)
        started.awaitTermination()
        return sinks.read_newest(spark, f"{root}/{name}")
    return query(build)


PARTS = 4


def _in_parts(spark, rows, path):
    """Rows as a stream of ``PARTS`` micro-batches: they are written by the tasks that make them, so there are as many
    files as the data asks for, and a micro-batch reads its share of these."""
    rows.write.parquet(path)
    files = len(spark.read.schema(rows.schema).parquet(path).inputFiles())
    return readers.parquet_stream(spark, path, rows.schema, -(-files // PARTS))


def _split_feed(spark, sf, root):
    rows = fixtures.fixture(spark, sf, fixtures.FX_TX).withColumnRenamed("event_ts", "timestamp")
    return _in_parts(spark, rows, f"{root}/feed")


_drained: dict[tuple, str] = {}
_lock = threading.Lock()


def _live_root(spark, sf) -> str:
    """One drained run of the live job in several micro-batches, older ones compacted, shared by its four tables."""
    key = input_version(spark, sf)
    with _lock:
        if key not in _drained:
            root = _folder(spark)
            write = sinks.batch_folder_writer(f"{root}/live")
            jobs.live_dashboard(_split_feed(spark, sf, root), write, f"{root}/check", None).awaitTermination()
            jobs.compact_live(spark, f"{root}/live")
            _drained[key] = root
        return _drained[key]


def _live(name):
    return query(lambda spark, sf: jobs.read_live(spark, f"{_live_root(spark, sf)}/live", name))


def _fan_out(name):
    def build(spark, sf):
        root = _folder(spark)
        write = sinks.batch_folder_writer(f"{root}/loaded")
        jobs.score_and_fan_out(_transactions(spark, sf), write, f"{root}/check", None).awaitTermination()
        return sinks.read_batches(spark, f"{root}/loaded", name)
    return query(build)


def _event_windows(spark, sf):
    """Watermarked minutes over the events table, completed by the minutes that the watermark has not closed."""

    def shaped(events):
        return events.select(
            F.col("ts").cast("timestamp").alias("event_time"), F.col("value").alias("amount"),
            F.col("event_type").alias("channel"), (F.col("event_type") == "error").alias("is_fraud"))

    root = _folder(spark)
    windows = jobs.event_time_windows(shaped(_file_stream(spark, sf, "events")), "channel")
    sinks.append_table(windows, f"{root}/windows", f"{root}/check", None).awaitTermination()
    table = shaped(spark.read.parquet(f"{sf}/events.parquet"))
    return jobs.with_open_windows(spark.read.parquet(f"{root}/windows"), table, "channel")


def _bronze_or_rejects(spark, sf):
    """Damaged messages in several files: what was kept and what was rejected, read as of one moment."""
    root = _folder(spark)
    messages = damaged_messages(spark, sf)
    stream = _in_parts(spark, messages, f"{root}/messages")
    jobs.messages_to_bronze_or_rejects(stream, f"{root}/out", f"{root}/check", None, keep=("key",)).awaitTermination()
    at = manifest.snapshot(spark, f"{root}/out")
    kept = manifest.read(spark, f"{root}/out", "bronze", at).select(
        F.col("transaction_id").alias("message_key"), F.lit(None).cast("string").alias("reason"), F.lit("").alias("fields"), "amount")
    rejected = manifest.read(spark, f"{root}/out", "rejected", at).select(
        F.col("key").alias("message_key"), "reason", F.array_join("fields", ",").alias("fields"), F.lit(None).cast("double").alias("amount"))
    return kept.unionByName(rejected)


def _published(name):
    """Scored batches, published table by table together and compacted in between."""
    def build(spark, sf):
        root = _folder(spark)
        jobs.score_and_publish(_split_feed(spark, sf, root), f"{root}/loaded", f"{root}/check", None, 2).awaitTermination()
        return manifest.read(spark, f"{root}/loaded", name)
    return query(build)


#: Runs in which the ordered feed is drained, each going on from the checkpoint of the one before.
RUNS, LATENESS = 3, 600


def _in_runs(spark, sf, root, start):
    """Drain transactions in the order of time: write a slice of the feed, let ``start`` read it to its end, and so on."""
    rows = geo_feed(spark, sf)
    steps = [k / RUNS for k in range(1, RUNS)]
    ends = rows.select(F.percentile_approx("epoch", steps).alias("ends")).first().ends or []
    part = sum((F.when(F.col("epoch") > end, 1).otherwise(0) for end in ends), F.lit(0))
    fed = rows.drop("epoch", "tx_year", "tx_month")
    for k in range(RUNS):
        rows.where(part == k).select(*fed.columns).write.mode("append").parquet(f"{root}/feed")
        start(readers.parquet_stream(spark, f"{root}/feed", fed.schema)).awaitTermination()


FIRSTS = {"is_new_bank": "destination_bank", "is_new_state": "purchase_state"}


def _history_root(spark, sf) -> str:
    """One drained run of the stateful features, shared by the queries on them."""
    key = ("history", *input_version(spark, sf))

    def start(feed):
        timed = feed.withColumn("event_time", F.col("timestamp_dt"))
        kept = ["transaction_id", "purchase_latitude", "purchase_longitude", "purchase_state"]
        found = state.with_movement(state.with_history(timed, FIRSTS, f"{LATENESS} seconds", keep=kept, groups=state.GROUPS))
        with state.rocksdb(spark):
            return sinks.append_table(found, f"{_drained[key]}/history", f"{_drained[key]}/check", None)

    with _lock:
        if key not in _drained:
            _drained[key] = _folder(spark)
            try:
                _in_runs(spark, sf, _drained[key], start)
            except BaseException:
                del _drained[key]
                raise
        return _drained[key]


def _history(*columns):
    return query(lambda spark, sf: spark.read.parquet(f"{_history_root(spark, sf)}/history").select("transaction_id", *columns))


def _silver_with_history(spark, sf):
    root = _folder(spark)
    _in_runs(spark, sf, root, lambda feed: jobs.bronze_to_silver_with_history(
        feed, f"{root}/silver", f"{root}/check", f"{LATENESS} seconds", None))
    return spark.read.parquet(f"{root}/silver").select(*SILVER, "transactions_last_24h", "accumulated_amount_24h")


QUERIES = {
    "e1_stream_last_day": _history("transactions_last_24h", "accumulated_amount_24h"),
    "e2_stream_month_average": _history("avg_transaction_amount_30d"),
    "e4_stream_first_use": _history(*FIRSTS),
    "w1_stream_previous": _history(*MOVEMENT),
    "t2_silver_with_history": query(_silver_with_history),
    "t1_bronze": query(_bronze),
    "t2_silver": query(lambda s, d: _silver(s, d).select(*SILVER)),
    "t3_t13_alerts": query(_alerts),
    "t4_metrics_by_type": _running("metrics_by_type"),
    "t4_metrics_by_channel": _running("metrics_by_channel"),
    "t4_metrics_by_category": _running("metrics_by_category"),
    "t4_metrics_by_card_brand": _running("metrics_by_card_brand"),
    "t5_minutes": _live("streaming_metrics"),
    "t6_minutes_by_category": _live("streaming_metrics_by_category"),
    "t7_minutes_by_channel": _live("streaming_metrics_by_channel"),
    "t8_recent_frauds": _live("streaming_recent_frauds"),
    "t9_transactions": _fan_out("transactions"),
    "t9_alerts": _fan_out("fraud_alerts"),
    "t9_published_transactions": _published("transactions"),
    "t9_published_alerts": _published("fraud_alerts"),
    "t1_bronze_or_rejects": query(_bronze_or_rejects),
    "t_event_time_windows": query(_event_windows),
}

_MINUTE = """CAST(date_trunc('minute', {time}) AS VARCHAR) AS window_start,
    CAST(date_trunc('minute', {time}) + INTERVAL 1 MINUTE AS VARCHAR) AS window_end"""
_CENTS = "CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100"
_FRAUD_RATE = half_up("CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) / count(*)", 4)


def _minutes(group: str, table: str = "stream_fx", time: str = "event_time", having: str = "") -> str:
    return f"""SELECT {_MINUTE.format(time=time)}, {group}, count(*) AS transaction_count, {_CENTS} AS total_amount,
        count(*) FILTER (WHERE is_fraud) AS fraud_count, {_FRAUD_RATE} AS fraud_rate FROM {table}
        GROUP BY date_trunc('minute', {time}), {group} {having}"""


def _load_sql(columns: list[str]) -> str:
    names = {
        "event_time": text("event_time"), "transaction_type": "type AS transaction_type",
        "amount": "amount_clean AS amount", "merchant": "merchant_name AS merchant",
        "category": "merchant_category AS category", "fraud_score": "CAST(trunc(fraud_score) AS INTEGER) AS fraud_score",
        "fraud_score_total": "CAST(trunc(load_combined) AS INTEGER) AS fraud_score_total",
        "risk_level": "load_level AS risk_level",
    }
    return ", ".join(names.get(c, c) for c in columns)


_CLOSED = f"epoch < (SELECT max(epoch) FROM silver) - {LATENESS}"
_SCORING = {name: CTES[name] for name in ("stream_points", "stream_combined", "stream_silver")}

ORACLE = {
    "e1_stream_last_day": check("silver", f"""SELECT transaction_id, transactions_last_24h, accumulated_amount_24h FROM (
        SELECT transaction_id, epoch, count(*) OVER w AS transactions_last_24h,
        CAST(sum(CAST(round(amount * 100) AS BIGINT)) OVER w AS DOUBLE) / 100 AS accumulated_amount_24h FROM silver
        WINDOW w AS (PARTITION BY customer_id ORDER BY epoch RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)) WHERE {_CLOSED}"""),
    "e2_stream_month_average": check("silver", f"""SELECT transaction_id,
        {half_up("CAST(c AS DOUBLE) / 100 / nullif(n, 0)", 2)} AS avg_transaction_amount_30d FROM (
        SELECT transaction_id, epoch, sum(CAST(round(amount * 100) AS BIGINT)) OVER w AS c, count(amount) OVER w AS n FROM silver
        WINDOW w AS (PARTITION BY customer_id ORDER BY epoch RANGE BETWEEN 2592000 PRECEDING AND 1 PRECEDING)) WHERE {_CLOSED}"""),
    "e4_stream_first_use": check("silver", f"""SELECT transaction_id, is_new_bank, is_new_state FROM (
        SELECT transaction_id, epoch, destination_bank IS NOT NULL AND row_number() OVER (
          PARTITION BY customer_id, destination_bank ORDER BY epoch, transaction_id) = 1 AS is_new_bank,
        purchase_state IS NOT NULL AND row_number() OVER (
          PARTITION BY customer_id, purchase_state ORDER BY epoch, transaction_id) = 1 AS is_new_state
        FROM silver) WHERE {_CLOSED}"""),
    "w1_stream_previous": check("movement", f"SELECT transaction_id, {', '.join(MOVEMENT)} FROM lagged WHERE {_CLOSED}"),
    "t2_silver_with_history": check("movement", "SELECT " + ", ".join(
        text(c) if c == "event_time" else c for c in [*SILVER, "transactions_last_24h", "accumulated_amount_24h"])
        + f" FROM stream_silver WHERE {_CLOSED}", past=PAST, stream_fx=CTES["stream_fx"].replace("FROM fx_tx", "FROM past"), **_SCORING),
    "t1_bronze": check("fx_tx", f"SELECT {FEED_SQL} FROM fx_tx"),
    "t2_silver": check("stream", "SELECT " + ", ".join(
        text(c) if c == "event_time" else c for c in SILVER) + " FROM stream_silver"),
    "t3_t13_alerts": check("stream", "SELECT " + ", ".join(
        text(c) if c == "event_time" else c for c in STREAM_ALERT_COLUMNS)
        + " FROM stream_silver WHERE fraud_score_combined >= 60"),
    **{f"t4_{name}": sql for name, sql in RUNNING_SQL.items()},
    "t5_minutes": check("stream", f"""SELECT {_MINUTE.format(time="event_time")}, count(*) AS total_transactions,
        {_CENTS} AS total_amount, count(*) FILTER (WHERE is_fraud) AS fraud_count,
        CAST(sum(CASE WHEN is_fraud THEN CAST(round(amount * 100) AS BIGINT) ELSE 0 END) AS DOUBLE) / 100 AS fraud_amount,
        {_FRAUD_RATE} AS fraud_rate,
        {half_up("CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / (100.0::DOUBLE * nullif(count(amount), 0))", 2)} AS avg_amount,
        max(amount) AS max_amount FROM stream_fx GROUP BY date_trunc('minute', event_time)"""),
    "t6_minutes_by_category": check("stream", _minutes("merchant_category")),
    "t7_minutes_by_channel": check("stream", _minutes("channel")),
    "t8_recent_frauds": check("stream", RECENT_SQL.format(table="stream_fx", time="event_time")),
    "t9_transactions": check("stream", f"SELECT {_load_sql(STREAM_LOAD_COLUMNS)} FROM stream_silver"),
    "t9_alerts": check("stream", f"""SELECT {_load_sql(STREAM_LOAD_ALERT_COLUMNS)} FROM stream_silver
        WHERE load_combined >= 60"""),
    "t9_published_transactions": check("stream", f"SELECT {_load_sql(STREAM_LOAD_COLUMNS)} FROM stream_silver"),
    "t9_published_alerts": check("stream", f"SELECT {_load_sql(STREAM_LOAD_ALERT_COLUMNS)} FROM stream_silver WHERE load_combined >= 60"),
    "t1_bronze_or_rejects": check("fx_tx", EXAMINED_SQL),
    "t_event_time_windows": f"""WITH e AS (SELECT ts, value AS amount, event_type AS channel, event_type = 'error' AS is_fraud
        FROM events) {_minutes("channel", "e", "ts")}""",
}
