"""Dashboard questions (Q, U)."""

from pyspark.sql import functions as F

from riskloom.catalog.aggregates import monthly_sql
from riskloom.catalog.base import (
    alerts, as_of_time, check, count_where, feed, gold, half_up, mean, percent, placed, query, volume,
)
from riskloom.functions import ladders
from riskloom.operators import detection, marts
from riskloom.plans import dashboard

DAY_START, DAY_END = "2000-01-01 00:00:00", "2000-06-30 23:59:59"
# Points in time whose last minutes and last day have rows in the fixtures.
LIVE_AS_OF = "2000-02-23 00:00:00"
RAPID_AS_OF = "1999-10-18 00:00:00"


def _on_gold(question, *args):
    return query(lambda s, d: question(gold(s, d), *args))


def _on_alerts(question, *args):
    return query(lambda s, d: question(alerts(s, d), *args))


def _live(spark, sf):
    """The scored stream table, here over the whole feed."""
    scored = detection.stream_silver(feed(spark, sf))
    return scored.withColumnRenamed("amount_clean", "amount")


def _latest(spark, sf):
    found = dashboard.latest_transactions(_live(spark, sf), as_of_time(LIVE_AS_OF))
    return found.select("transaction_id", "event_time", "type", "amount", "risk_level", "is_fraud")


def _in_order(question):
    return query(lambda spark, sf: placed(question(gold(spark, sf))))


QUERIES = {
    "q01_total_transactions": _on_gold(dashboard.total_transactions),
    "q02_total_volume": _on_gold(dashboard.total_volume),
    "q03_fraud_count": _on_gold(dashboard.fraud_count),
    "q04_fraud_rate": _on_gold(dashboard.fraud_rate),
    "q05_protected_value": _on_gold(dashboard.protected_value),
    "q06_critical_alerts": _on_alerts(dashboard.critical_alerts),
    "q07_monthly_counts": _on_gold(dashboard.monthly_counts),
    "q08_monthly_volume": _on_gold(dashboard.monthly_volume),
    "q09_monthly_fraud_rate": _on_gold(dashboard.monthly_fraud_rate),
    "q10_by_hour": _on_gold(dashboard.by_hour),
    "q11_risk_distribution": _on_gold(dashboard.risk_distribution),
    "q12_by_channel": _on_gold(dashboard.count_by, "channel"),
    "q13_by_type": _on_gold(dashboard.count_by, "type"),
    "q14_by_status": _on_gold(dashboard.count_by, "status"),
    "q15_top_categories": _on_gold(dashboard.top_by_fraud, "merchant_category"),
    "q16_frauds_by_period": _on_gold(dashboard.frauds_by_period),
    "q17_frauds_by_range": _on_gold(dashboard.frauds_by_range),
    "q18_top_merchants": _on_gold(dashboard.top_by_fraud, "merchant_name"),
    "q19_latest_alerts": _on_alerts(dashboard.latest_alerts),
    "q20_customers_with_most_alerts": _on_alerts(dashboard.customers_with_most_alerts),
    "q21_monthly_table": query(lambda s, d: dashboard.monthly_table(marts.monthly(gold(s, d)))),
    "q22_channel_type_matrix": _on_gold(dashboard.channel_type_matrix),
    "q23_weekend_hour": _on_gold(dashboard.weekend_hour_pattern),
    "q24_score_precision": _on_gold(dashboard.score_precision),
    "q25_rapid_customers": query(lambda s, d: dashboard.rapid_customers(
        alerts(s, d), as_of_time(RAPID_AS_OF))),
    "q26_location_flags": _on_alerts(dashboard.location_flags),
    "q27_months": _on_gold(dashboard.months),
    "q28_channels": _on_gold(dashboard.choices, "channel"),
    "q29_types": _on_gold(dashboard.choices, "type"),
    "q30_levels": _on_gold(dashboard.choices, "risk_level"),
    "q31_daily_counts": query(lambda s, d: dashboard.daily_counts(
        gold(s, d), as_of_time(DAY_START), as_of_time(DAY_END))),
    "q32_types_of_channel": _on_gold(dashboard.types_of_channel, "WEB_BANKING"),
    "q33_latest_transactions": query(_latest),
    "q34_latest_fraud_value": query(lambda s, d: dashboard.latest_fraud_value(
        _live(s, d), as_of_time(LIVE_AS_OF))),
    "q35_level_precision": _on_gold(dashboard.level_precision),
    "q36_overall_detection": _on_gold(dashboard.overall_detection),
    "q37_levels_with_score": _on_gold(dashboard.levels_with_score),
    "q37_top_frauds": _on_gold(dashboard.top_frauds),
    "o1_order_of_months": _in_order(dashboard.monthly_counts),
    "o1_order_of_types": _in_order(lambda tx: dashboard.count_by(tx, "type")),
    "o5_order_of_categories": _in_order(lambda tx: dashboard.top_by_fraud(tx, "merchant_category")),
    "o6_order_of_levels": _in_order(dashboard.risk_distribution),
    "o6_order_of_periods": _in_order(dashboard.frauds_by_period),
    "o6_order_of_ranges": _in_order(dashboard.frauds_by_range),
    "o7_order_of_matrix": _in_order(lambda tx: dashboard.channel_type_matrix(
        tx.withColumn("is_fraud", F.when(F.col("type") != "PIX", F.col("is_fraud"))))),
}

PERIOD = "CAST(tx_year AS VARCHAR) || '-' || lpad(CAST(tx_month AS VARCHAR), 2, '0') AS period"
FRAUDS = f"{count_where('is_fraud')} AS frauds"
RATE = percent(count_where("is_fraud"), "count(*)", 2)


def money_text(value: str) -> str:
    return f"'R$ ' || format('{{:,.2f}}', {value})"


def number_text(value: str) -> str:
    return f"format('{{:,}}', {value})"


def _gold(select: str) -> str:
    return check("gold", select)


def _alerts(select: str) -> str:
    return check("alerts", select)


def _group(key: str, table: str = "gold", where: str = "") -> str:
    return f"SELECT {key}, count(*) AS total FROM {table} {where} GROUP BY {key}"


def _frauds_by(key: str) -> str:
    return f"""SELECT {key}, count(*) AS frauds, {volume()} AS value FROM gold WHERE is_fraud GROUP BY {key}
        ORDER BY frauds DESC, {key} LIMIT 10"""


ORACLE = {
    "q01_total_transactions": _gold(f"SELECT count(*) AS total, {number_text('count(*)')} AS total_text FROM gold"),
    "q02_total_volume": _gold(f"SELECT {volume()} AS volume, {money_text(volume())} AS volume_text FROM gold"),
    "q03_fraud_count": _gold(f"""SELECT count(*) AS frauds, {number_text('count(*)')} AS frauds_text FROM gold
        WHERE is_fraud"""),
    "q04_fraud_rate": _gold(f"""SELECT {RATE} AS fraud_rate, format('{{:.2f}}', {RATE}) || '%' AS fraud_rate_text
        FROM gold"""),
    "q05_protected_value": _gold(f"""SELECT {volume()} AS protected, {money_text(volume())} AS protected_text FROM gold
        WHERE is_fraud AND status = 'DECLINED'"""),
    "q06_critical_alerts": _alerts(f"""SELECT count(*) AS critical_alerts, {number_text('count(*)')} AS critical_alerts_text
        FROM alerts WHERE risk_level = 'CRITICAL'"""),
    "q07_monthly_counts": _gold(f"SELECT {PERIOD}, count(*) AS transactions, {FRAUDS} FROM gold GROUP BY tx_year, tx_month"),
    "q08_monthly_volume": _gold(f"""SELECT {PERIOD}, {volume()} AS total_volume, {volume(where="is_fraud")} AS fraud_volume
        FROM gold GROUP BY tx_year, tx_month"""),
    "q09_monthly_fraud_rate": _gold(f"SELECT {PERIOD}, {RATE} AS fraud_rate FROM gold GROUP BY tx_year, tx_month"),
    "q10_by_hour": _gold(f"SELECT tx_hour, count(*) AS total, {FRAUDS} FROM gold GROUP BY tx_hour"),
    "q11_risk_distribution": _gold(_group("risk_level")),
    "q12_by_channel": _gold(_group("channel")),
    "q13_by_type": _gold(_group("type")),
    "q14_by_status": _gold(_group("status")),
    "q15_top_categories": _gold(_frauds_by("merchant_category")),
    "q16_frauds_by_period": _gold(f"""SELECT period_of_day, count(*) AS frauds, {percent(
        "count(*)", "(SELECT count(*) FROM gold WHERE is_fraud)", 1)} AS percent_of_total
        FROM gold WHERE is_fraud GROUP BY period_of_day"""),
    "q17_frauds_by_range": _gold("SELECT amount_range, count(*) AS frauds FROM gold WHERE is_fraud GROUP BY amount_range"),
    "q18_top_merchants": _gold(_frauds_by("merchant_name")),
    "q19_latest_alerts": _alerts(f"""SELECT transaction_id, CAST(timestamp_dt AS VARCHAR) AS timestamp_dt, customer_id, type,
        {money_text("amount")} AS amount_text, merchant_name, risk_level, fraud_score, investigation_status
        FROM alerts ORDER BY alerts.timestamp_dt DESC, transaction_id LIMIT 50"""),
    "q20_customers_with_most_alerts": _alerts(f"""SELECT customer_id, count(*) AS alerts,
        {count_where("risk_level = 'CRITICAL'")} AS critical, {count_where("risk_level = 'HIGH'")} AS high,
        {volume()} AS value, {money_text(volume())} AS value_text FROM alerts GROUP BY customer_id
        ORDER BY count(*) DESC, customer_id LIMIT 20"""),
    "q21_monthly_table": check("gold", f"""SELECT {PERIOD}, {number_text("total_transactions")} AS transactions_text,
        {money_text("total_volume")} AS volume_text, {number_text("fraud_count")} AS frauds_text,
        format('{{:.2f}}', {half_up("fraud_rate", 2)}) || '%' AS fraud_rate_text, critical_count, high_count
        FROM metrics""", metrics=monthly_sql("gold")),
    "q22_channel_type_matrix": _gold(f"""SELECT channel, type, count(*) AS total, {FRAUDS}, {RATE} AS fraud_rate
        FROM gold GROUP BY channel, type"""),
    "q23_weekend_hour": _gold(f"""SELECT CASE WHEN is_weekend THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type, tx_hour,
        count(*) AS total, {FRAUDS}, {RATE} AS fraud_rate FROM gold GROUP BY is_weekend, tx_hour"""),
    "q24_score_precision": _gold(f"""SELECT fraud_score_category, count(*) AS total, {FRAUDS}, {RATE} AS "precision"
        FROM gold WHERE fraud_score_category IS NOT NULL GROUP BY fraud_score_category"""),
    "q25_rapid_customers": _alerts(f"""SELECT customer_id, count(*) AS transactions, {volume()} AS total_amount,
        max(distance_from_last_txn_km) AS max_distance_km,
        CASE min(CASE risk_level WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END)
          WHEN 1 THEN 'CRITICAL' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' ELSE 'LOW' END AS max_risk,
        max(risk_level) AS max_risk_text FROM alerts
        WHERE timestamp_dt BETWEEN TIMESTAMP '{RAPID_AS_OF}' - INTERVAL 24 HOUR AND TIMESTAMP '{RAPID_AS_OF}'
        GROUP BY customer_id HAVING count(*) > 3 ORDER BY count(*) DESC, customer_id LIMIT 20"""),
    "q26_location_flags": _alerts(f"""SELECT flag_location, count(*) AS alerts,
        {mean("distance_from_last_txn_km")} AS avg_distance_km FROM alerts WHERE flag_location IS NOT NULL
        GROUP BY flag_location"""),
    "q27_months": _gold(f"SELECT DISTINCT {PERIOD} FROM gold"),
    "q28_channels": _gold("SELECT DISTINCT channel FROM gold WHERE channel IS NOT NULL"),
    "q29_types": _gold("SELECT DISTINCT type FROM gold WHERE type IS NOT NULL"),
    "q30_levels": _gold("SELECT DISTINCT risk_level FROM gold WHERE risk_level IS NOT NULL"),
    "q31_daily_counts": _gold(f"""SELECT CAST(CAST(timestamp_dt AS DATE) AS VARCHAR) AS day, count(*) AS transactions,
        {FRAUDS} FROM gold WHERE timestamp_dt BETWEEN TIMESTAMP '{DAY_START}' AND TIMESTAMP '{DAY_END}' GROUP BY 1"""),
    "q32_types_of_channel": _gold(f"""SELECT type, count(*) AS total, {FRAUDS} FROM gold WHERE channel = 'WEB_BANKING'
        GROUP BY type"""),
    "q33_latest_transactions": check("stream", f"""SELECT transaction_id, CAST(event_time AS VARCHAR) AS event_time, type,
        amount_clean AS amount, risk_level, is_fraud FROM stream_silver
        WHERE stream_silver.event_time BETWEEN TIMESTAMP '{LIVE_AS_OF}' - INTERVAL 5 MINUTE AND TIMESTAMP '{LIVE_AS_OF}'
        ORDER BY stream_silver.event_time DESC, transaction_id LIMIT 100"""),
    "q34_latest_fraud_value": check("stream", f"""SELECT count(*) AS frauds, {volume("amount_clean")} AS value
        FROM stream_silver WHERE is_fraud
          AND event_time BETWEEN TIMESTAMP '{LIVE_AS_OF}' - INTERVAL 5 MINUTE AND TIMESTAMP '{LIVE_AS_OF}'"""),
    "q35_level_precision": _gold(f"""SELECT risk_level, count(*) AS total, {count_where("is_fraud")} AS true_positives,
        {count_where("NOT is_fraud")} AS false_positives, {RATE} AS "precision" FROM gold
        WHERE risk_level IN ('CRITICAL', 'HIGH', 'MEDIUM') GROUP BY risk_level"""),
    "q36_overall_detection": _gold("""SELECT (SELECT count(*) FROM gold WHERE is_fraud) AS actual_frauds,
        (SELECT count(*) FROM gold WHERE risk_level IN ('CRITICAL', 'HIGH', 'MEDIUM')) AS alerted,
        (SELECT count(*) FROM gold WHERE is_fraud AND risk_level IN ('CRITICAL', 'HIGH', 'MEDIUM')) AS true_positives,
        (SELECT count(*) FROM gold WHERE is_fraud AND risk_level NOT IN ('CRITICAL', 'HIGH', 'MEDIUM')) AS false_negatives"""),
    "q37_levels_with_score": _gold(f"""SELECT risk_level, count(*) AS total, {mean("fraud_score", 0)} AS avg_score
        FROM gold GROUP BY risk_level"""),
    "q37_top_frauds": _gold("""SELECT transaction_id, amount, merchant_name AS merchant, fraud_score FROM gold
        WHERE risk_level = 'CRITICAL' ORDER BY fraud_score DESC NULLS LAST, transaction_id LIMIT 10"""),
}


def _placed(answer: str, order: str) -> str:
    return check("gold", f"SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS place FROM answer", answer=answer)


def _rank(column: str, labels: list[str]) -> str:
    return f"list_position([{', '.join(repr(x) for x in labels)}], {column})"


_MATRIX_RATE = percent(count_where("type <> 'PIX' AND is_fraud"), "count(*)", 2)

ORACLE |= {
    "o1_order_of_months": _placed(f"SELECT {PERIOD}, count(*) AS transactions, {FRAUDS} FROM gold GROUP BY tx_year, tx_month", "period"),
    "o1_order_of_types": _placed(_group("type"), "total DESC, type"),
    "o5_order_of_categories": _placed(_frauds_by("merchant_category"), "frauds DESC, merchant_category"),
    "o6_order_of_levels": _placed(_group("risk_level"), _rank("risk_level", ladders.LEVEL_ORDER)),
    "o6_order_of_periods": _placed(f"""SELECT period_of_day, count(*) AS frauds, {percent(
        "count(*)", "(SELECT count(*) FROM gold WHERE is_fraud)", 1)} AS percent_of_total
        FROM gold WHERE is_fraud GROUP BY period_of_day""", _rank("period_of_day", ladders.PERIOD_ORDER)),
    "o6_order_of_ranges": _placed("SELECT amount_range, count(*) AS frauds FROM gold WHERE is_fraud GROUP BY amount_range",
                                  _rank("amount_range", ladders.RANGE_ORDER)),
    "o7_order_of_matrix": _placed(f"""SELECT channel, type, count(*) AS total, {count_where("type <> 'PIX' AND is_fraud")} AS frauds,
        {_MATRIX_RATE} AS fraud_rate FROM gold GROUP BY channel, type""", "fraud_rate DESC NULLS LAST, channel, type"),
}
