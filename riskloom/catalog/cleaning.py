"""Ingestion and cleaning (P, C)."""

import uuid

from pyspark.sql import functions as F

from riskloom.catalog.base import (
    alerts, as_of_time, check, customers, devices, feed, gold, half_up, query, raw_customers, raw_devices, silver,
    text,
)
from riskloom.functions import ladders
from riskloom.functions import text as words
from riskloom.operators import clean, detection, ingest
from riskloom.plans import layers
from riskloom.session import work_folder
from riskloom.sources import readers

FEED = """transaction_id customer_id device_id timestamp type amount currency channel merchant_name
    merchant_category mcc_risk_level card_brand card_type card_entry cvv_validated auth_3ds pix_key_type
    destination_bank distance_from_last_txn_km transactions_last_24h accumulated_amount_24h unusual_time
    new_beneficiary status fraud_score is_fraud fraud_type installments""".split()
FEED_SQL = ", ".join(f'event_ts AS "{c}"' if c == "timestamp" else c for c in FEED)

GOLD_SQL = """transaction_id, customer_id, CAST(NULL AS VARCHAR) AS session_id, device_id,
    CAST(timestamp_dt AS VARCHAR) AS timestamp_dt, CAST(tx_date AS VARCHAR) AS tx_date, tx_year, tx_month, tx_hour,
    type, amount, currency, channel, CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS DOUBLE) AS geolocation_lat,
    CAST(NULL AS DOUBLE) AS geolocation_lon, CAST(NULL AS VARCHAR) AS merchant_id, merchant_name, merchant_category,
    CAST(NULL AS VARCHAR) AS mcc_code, mcc_risk_level, CAST(NULL AS VARCHAR) AS card_number_hash, card_brand,
    card_type, installments, card_entry, cvv_validated, auth_3ds, pix_key_type,
    CAST(NULL AS VARCHAR) AS pix_key_destination, destination_bank, distance_from_last_txn_km,
    CAST(NULL AS DOUBLE) AS time_since_last_txn_min, transactions_last_24h, accumulated_amount_24h, unusual_time,
    new_beneficiary, status, CAST(NULL AS VARCHAR) AS refusal_reason, fraud_score, fraud_score_category, is_fraud,
    fraud_type, is_high_risk_mcc, period_of_day, amount_range, is_weekend, risk_points, risk_level, requires_review"""

REPORTING_SQL = """transaction_id, customer_id, CAST(timestamp_dt AS VARCHAR) AS timestamp_dt,
    CAST(tx_date AS VARCHAR) AS tx_date, tx_year, tx_month, tx_hour, type, amount, currency, channel, merchant_name,
    merchant_category, CAST(NULL AS VARCHAR) AS mcc_code, mcc_risk_level, card_brand, card_entry, status,
    CAST(NULL AS VARCHAR) AS refusal_reason, fraud_score, fraud_score_category, is_fraud, fraud_type, risk_points,
    risk_level, requires_review, period_of_day, amount_range, is_weekend"""

ALERT_SQL = """transaction_id, customer_id, CAST(timestamp_dt AS VARCHAR) AS timestamp_dt, type, amount,
    merchant_name, merchant_category, risk_points, risk_level, fraud_score, is_fraud, fraud_type, status,
    distance_from_last_txn_km, transactions_last_24h, accumulated_amount_24h, flag_time, flag_beneficiary, flag_mcc,
    flag_location, investigation_status, analyst_id, investigation_notes"""


def _json_round_trip(spark, sf):
    sent = ingest.to_json_text(feed(spark, sf).select(*FEED), "value")
    return ingest.parse_json(sent).select(*FEED)


def damaged_messages(spark, sf):
    """(key, value): the feed as JSON messages, of which some are cut short, lack the key, hold text for the amount or are empty."""
    rows = feed(spark, sf).select(*FEED)

    def message(**changed):
        return F.to_json(F.struct(*[(changed[c] if c in changed else F.col(c)).alias(c) for c in FEED]))

    whole, kind = message(), F.col("transactions_last_24h")
    value = (
        F.when(kind == 1, F.substring(whole, F.lit(1), F.length(whole) - 5))
        .when(kind == 2, message(transaction_id=F.lit(None).cast("string")))
        .when(kind == 3, message(amount=F.lit("much"))).when(kind == 4, F.lit("  ")).otherwise(whole))
    return rows.select(F.col("transaction_id").alias("key"), value.alias("value"))


def _examined(spark, sf):
    seen = ingest.examined(damaged_messages(spark, sf))
    return seen.select(
        F.col("key").alias("message_key"), "reason", F.array_join("fields", ",").alias("fields"),
        F.when(F.col("reason").isNull(), F.col("data.amount")).alias("amount"))


def _envelope(spark, sf):
    wrapped = ingest.envelope_from_rows(feed(spark, sf).select(*FEED))
    return wrapped.groupBy("topic", "kafka_partition").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("kafka_offset").alias("offsets"),
        F.count("kafka_key").alias("keys"),
    )


def _metadata(spark, sf):
    stamped = ingest.with_metadata(feed(spark, sf), "raw", "parquet", as_of_time())
    return stamped.groupBy("source_layer", "source_format", "processing_date", "ingestion_timestamp").count()


LATE = "transaction_id customer_id amount tx_year tx_month tx_hour amount_range fraud_score_category is_weekend".split()


def _late_day(spark, sf):
    """Bronze and Silver of a feed that lacks half of the rows of its middle day, brought up to date by that day."""
    rows = feed(spark, sf)
    at = F.to_date(F.try_to_timestamp(F.col("timestamp")))
    middle = rows.select(F.percentile_approx(F.unix_date(at), 0.5).alias("day")).first().day
    late = F.coalesce(F.unix_date(at) == middle, F.lit(False))
    built = layers.Layers(f"{work_folder(spark)}/riskloom-late-{uuid.uuid4().hex}")
    layers.write_bronze(rows.where(~late | (F.col("transactions_last_24h") % 2 == 1)), built, "parquet")
    layers.write_silver(readers.table(spark, built.bronze), built)
    layers.rerun_days(spark, rows.where(late), built.root)
    return readers.table(spark, built.silver).select(*LATE)


def _date_columns(spark, sf):
    dated = ingest.with_date_columns(feed(spark, sf).select("transaction_id", "timestamp"))
    return dated.groupBy("year", "month", "day").count()


def _source_file(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    named = ingest.with_source_file(lines, "file").select(
        F.regexp_extract("file", r"([a-z]+)\.parquet", 1).alias("source")
    )
    return named.groupBy("source").count()


def _feed_column(*columns):
    def build(spark, sf):
        return feed(spark, sf).select("transaction_id", *[c() if callable(c) else c for c in columns])
    return query(build)


def _silver_columns(*columns):
    return query(lambda spark, sf: silver(spark, sf).select("transaction_id", *columns))


def _text(spark, sf):
    return feed(spark, sf).select(
        "transaction_id", words.upper_trimmed(F.col("channel")).alias("channel_upper"),
        words.upper_trimmed(F.col("type")).alias("type_upper"),
        words.upper_trimmed(F.col("card_brand")).alias("card_brand_upper"),
    )


def _required(spark, sf):
    return clean.require(raw_customers(spark, sf), "customer_id", "email").select("customer_id", "email")


CUSTOMER_SILVER = """customer_id full_name tax_id email birth_date state monthly_income credit_score is_premium
    pep segment tax_id_digits birth_date_dt state_upper name_upper email_lower income_band credit_band""".split()
DEVICE_SILVER = """device_id customer_id os_name os_version is_rooted is_emulator is_trusted risk_score os_full
    device_risk_category""".split()
SILVER = """timestamp_dt tx_date tx_year tx_month tx_hour tx_dayofweek is_weekend period_of_day amount
    amount_range is_high_risk_mcc fraud_score_category channel_upper type_upper card_brand_upper""".split()

EXAMINED_SQL = """SELECT transaction_id AS message_key,
    CASE transactions_last_24h WHEN 1 THEN 'MALFORMED' WHEN 2 THEN 'NO_KEY' WHEN 3 THEN 'WRONG_TYPE' WHEN 4 THEN 'EMPTY' END AS reason,
    CASE WHEN transactions_last_24h = 3 THEN 'amount' ELSE '' END AS fields,
    CASE WHEN transactions_last_24h NOT IN (1, 2, 3, 4) THEN amount END AS amount FROM fx_tx"""

QUERIES = {
    "p01_p05_examined": query(_examined),
    "s15_late_day": query(_late_day),
    "p02_json_round_trip": query(_json_round_trip),
    "p04_envelope": query(_envelope),
    "p04_envelope_text": query(lambda s, d: ingest.parse_json(
        ingest.envelope_from_rows(feed(s, d).select(*FEED)), "raw_json").select(*FEED)),
    "p06_metadata": query(_metadata),
    "p07_source_file": query(_source_file),
    "p08_date_columns": query(_date_columns),
    "p09_gold_columns": query(gold),
    "p09_reporting_columns": query(lambda s, d: detection.reporting_table(gold(s, d))),
    "p12_alert_columns": query(alerts),
    "c01_dedup": query(lambda s, d: clean.keep_first(
        feed(s, d), "transaction_id", clean.TRANSACTION_ORDER).select(*FEED)),
    "c01_dedup_any": query(lambda s, d: clean.keep_any(feed(s, d).select("transaction_id"), "transaction_id")),
    "c02_required": query(_required),
    "c03_absolute_amount": _feed_column(lambda: clean.clean_amount().alias("amount_clean")),
    "c04_positive_amount": query(lambda s, d: clean.positive_amounts(feed(s, d)).select("transaction_id", "amount")),
    "c05_text": query(_text),
    "c06_digits": query(lambda s, d: raw_customers(s, d).select(
        "customer_id", words.digits_only(F.col("tax_id")).alias("tax_id_digits"))),
    "c07_event_time": _feed_column(lambda: F.try_to_timestamp("timestamp").alias("timestamp_dt")),
    "c08_money": _feed_column(lambda: F.round(F.col("amount") / 3, 2).alias("third")),
    "c09_calendar": _silver_columns(*SILVER[:7]),
    "c10_os_name": query(lambda s, d: raw_devices(s, d).select(
        "device_id", words.joined(F.col("os_name"), F.col("os_version")).alias("os_full"))),
    "c11_period": query(lambda s, d: silver(s, d).select(
        "transaction_id", "period_of_day", ladders.relabel(F.col("period_of_day")).alias("period_pt"))),
    "c12_amount_range": query(lambda s, d: silver(s, d).select(
        "transaction_id", "amount_range", ladders.relabel(F.col("amount_range")).alias("range_pt"))),
    "c13_score_category": _silver_columns("fraud_score_category"),
    "c14_income_band": query(lambda s, d: customers(s, d).select("customer_id", "income_band")),
    "c15_credit_band": query(lambda s, d: customers(s, d).select("customer_id", "credit_band")),
    "c16_device_risk": query(lambda s, d: devices(s, d).select("device_id", "device_risk_category")),
    "c17_customers": query(lambda s, d: customers(s, d).select(*CUSTOMER_SILVER)),
    "c17_devices": query(lambda s, d: devices(s, d).select(*DEVICE_SILVER)),
    "c17_transactions": _silver_columns(*SILVER),
    "c17_simple_customers": query(lambda s, d: clean.simple_customers(raw_customers(s, d)).select(
        "customer_id", "full_name", "email")),
    "c17_simple_transactions": query(lambda s, d: clean.simple_transactions(feed(s, d)).select(
        "transaction_id", "customer_id", "amount", "merchant_name")),
}

_PERIOD_PT = """CASE period_of_day WHEN 'MORNING' THEN 'MANHA' WHEN 'AFTERNOON' THEN 'TARDE'
    WHEN 'EVENING' THEN 'NOITE' ELSE 'MADRUGADA' END"""
_RANGE_PT = """CASE amount_range WHEN 'MICRO' THEN 'MICRO' WHEN 'SMALL' THEN 'PEQUENO' WHEN 'MEDIUM' THEN 'MEDIO'
    WHEN 'LARGE' THEN 'GRANDE' ELSE 'MUITO_GRANDE' END"""

ORACLE = {
    "p01_p05_examined": check("fx_tx", EXAMINED_SQL),
    "s15_late_day": check("silver", f"SELECT {', '.join(LATE)} FROM silver"),
    "p02_json_round_trip": check("fx_tx", f"SELECT {FEED_SQL} FROM fx_tx"),
    "p04_envelope": check("fx_tx", """SELECT 'transactions' AS topic, 0 AS kafka_partition, count(*) AS messages,
        count(*) AS offsets, CAST(0 AS BIGINT) AS keys FROM fx_tx"""),
    "p04_envelope_text": check("fx_tx", f"SELECT {FEED_SQL} FROM fx_tx"),
    "p06_metadata": check("fx_tx", """SELECT 'raw' AS source_layer, 'parquet' AS source_format,
        '2001-08-01' AS processing_date, '2001-08-01 00:00:00' AS ingestion_timestamp, count(*) AS count FROM fx_tx"""),
    "p07_source_file": "SELECT 'lineitem' AS source, count(*) AS count FROM lineitem",
    "p08_date_columns": check("fx_tx", """SELECT CAST(year(CAST(event_ts AS TIMESTAMP)) AS INTEGER) AS year,
        CAST(month(CAST(event_ts AS TIMESTAMP)) AS INTEGER) AS month,
        CAST(day(CAST(event_ts AS TIMESTAMP)) AS INTEGER) AS day, count(*) AS count FROM fx_tx GROUP BY 1, 2, 3"""),
    "p09_gold_columns": check("gold", f"SELECT {GOLD_SQL} FROM gold"),
    "p09_reporting_columns": check("gold", f"SELECT {REPORTING_SQL} FROM gold"),
    "p12_alert_columns": check("alerts", f"SELECT {ALERT_SQL} FROM alerts"),
    "c01_dedup": check("first_tx", f"SELECT {FEED_SQL} FROM first_tx"),
    "c01_dedup_any": check("fx_tx", "SELECT DISTINCT transaction_id FROM fx_tx"),
    "c02_required": check("customers", "SELECT customer_id, email FROM fx_customers WHERE email IS NOT NULL"),
    "c03_absolute_amount": check("fx_tx", """SELECT transaction_id,
        CASE WHEN amount < 0 THEN -amount ELSE amount END AS amount_clean FROM fx_tx"""),
    "c04_positive_amount": check("fx_tx", "SELECT transaction_id, amount FROM fx_tx WHERE amount > 0"),
    "c05_text": check("fx_tx", """SELECT transaction_id, upper(trim(channel)) AS channel_upper,
        upper(trim(type)) AS type_upper, upper(trim(card_brand)) AS card_brand_upper FROM fx_tx"""),
    "c06_digits": check("customers", """SELECT customer_id,
        replace(replace(tax_id, '.', ''), '-', '') AS tax_id_digits FROM fx_customers"""),
    "c07_event_time": check("fx_tx", "SELECT transaction_id, replace(event_ts, 'T', ' ') AS timestamp_dt FROM fx_tx"),
    "c08_money": check("fx_tx", f"SELECT transaction_id, {half_up('amount / 3', 2)} AS third FROM fx_tx"),
    "c09_calendar": check("silver", f"""SELECT transaction_id, {text("timestamp_dt")}, {text("tx_date")}, tx_year,
        tx_month, tx_hour, tx_dayofweek, is_weekend FROM silver"""),
    "c10_os_name": check("devices", """SELECT device_id, CASE WHEN os_version IS NULL THEN os_name
        ELSE os_name || ' ' || os_version END AS os_full FROM fx_devices"""),
    "c11_period": check("silver", f"SELECT transaction_id, period_of_day, {_PERIOD_PT} AS period_pt FROM silver"),
    "c12_amount_range": check("silver", f"SELECT transaction_id, amount_range, {_RANGE_PT} AS range_pt FROM silver"),
    "c13_score_category": check("silver", "SELECT transaction_id, fraud_score_category FROM silver"),
    "c14_income_band": check("customers", "SELECT customer_id, income_band FROM customers"),
    "c15_credit_band": check("customers", "SELECT customer_id, credit_band FROM customers"),
    "c16_device_risk": check("devices", "SELECT device_id, device_risk_category FROM devices"),
    "c17_customers": check("customers", "SELECT " + ", ".join(
        text(c) if c == "birth_date_dt" else c for c in CUSTOMER_SILVER) + " FROM customers"),
    "c17_devices": check("devices", f"SELECT {', '.join(DEVICE_SILVER)} FROM devices"),
    "c17_transactions": check("silver", "SELECT transaction_id, " + ", ".join(
        text(c) if c in ("timestamp_dt", "tx_date") else c for c in SILVER) + " FROM silver"),
    "c17_simple_customers": check("customers", """SELECT customer_id, trim(full_name) AS full_name,
        lower(trim(email)) AS email FROM fx_customers WHERE email IS NOT NULL"""),
    "c17_simple_transactions": check("first_tx", """SELECT transaction_id, customer_id, amount,
        trim(merchant_name) AS merchant_name FROM first_tx WHERE amount > 0"""),
}
