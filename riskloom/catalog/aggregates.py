"""Aggregate tables (A) and the customer summary."""

from riskloom.catalog.base import (
    CTES, as_of_date, check, count_where, customers, devices, feed, geo_feed, geo_scored, gold, half_up, mean, mean_amount,
    percent, query, silver, volume,
)
from riskloom.catalog.scoring import ENRICHED_CTE, ENRICHED_LEVEL, GEO_CTES, SENSITIVE_SQL, sensitive_score
from riskloom.operators import detection, enrich, marts


def _enriched_monthly(spark, sf):
    scored = enrich.enriched_detection(silver(spark, sf), devices(spark, sf), customers(spark, sf), as_of_date())
    return marts.monthly(scored, by_type=False)


def _geo(spark, sf):
    return geo_scored(spark, sf)


def _stream(spark, sf):
    return detection.stream_silver(feed(spark, sf))


QUERIES = {
    "a01_monthly": query(lambda s, d: marts.monthly(gold(s, d))),
    "a02_monthly_enriched": query(_enriched_monthly),
    "a03_by_type": query(lambda s, d: marts.by_group(gold(s, d), "type")),
    "a04_by_channel": query(lambda s, d: marts.by_group(gold(s, d), "channel")),
    "a05_by_customer": query(lambda s, d: marts.customer_measures(gold(s, d))),
    "a06_customer_short": query(lambda s, d: marts.customer_short(silver(s, d))),
    "a07_by_level": query(lambda s, d: marts.by_level(_geo(s, d))),
    "a08_types": query(lambda s, d: marts.value_counts(silver(s, d), "type")),
    "a08_amount_ranges": query(lambda s, d: marts.value_counts(silver(s, d), "amount_range")),
    "a08_score_categories": query(lambda s, d: marts.value_counts(silver(s, d), "fraud_score_category")),
    "a08_risk_levels": query(lambda s, d: marts.value_counts(gold(s, d), "risk_level")),
    "a09_category_by_level": query(lambda s, d: marts.category_by_level(
        detection.sensitive_detection(geo_feed(s, d)))),
    "a10_type_by_level": query(lambda s, d: marts.running_by_type(_stream(s, d))),
    "a11_channel_by_level": query(lambda s, d: marts.running_by_channel(_stream(s, d))),
    "a12_category_by_mcc": query(lambda s, d: marts.running_by_category(_stream(s, d))),
    "a13_brand_by_card": query(lambda s, d: marts.running_by_brand(_stream(s, d))),
    "a14_totals": query(lambda s, d: marts.totals(feed(s, d))),
    "a16_fraud_summary": query(lambda s, d: marts.fraud_summary(silver(s, d))),
    "o2_top_alert_categories": query(lambda s, d: marts.top_alert_categories(_geo(s, d))),
    "o3_recent_frauds": query(lambda s, d: marts.recent_frauds(silver(s, d), time="timestamp_dt")),
}

_COUNTS = {
    "critical_count": "risk_level = 'CRITICAL'", "high_count": "risk_level = 'HIGH'",
    "medium_count": "risk_level = 'MEDIUM'", "low_count": "risk_level = 'LOW'",
    "approved_count": "status = 'APPROVED'", "declined_count": "status = 'DECLINED'",
    "blocked_count": "status = 'BLOCKED'",
}
_TYPES = {
    "pix_count": "type = 'PIX'", "credit_card_count": "type = 'CREDIT_CARD'", "debit_card_count": "type = 'DEBIT_CARD'",
    "ted_count": "type = 'TED'", "boleto_count": "type = 'BOLETO'",
}


def _counts(names: dict[str, str]) -> str:
    return ", ".join(f"{count_where(c)} AS {n}" for n, c in names.items())


def monthly_sql(table: str, extra: str = "") -> str:
    return f"""SELECT tx_year, tx_month, count(*) AS total_transactions, {volume()} AS total_volume,
        {mean_amount()} AS avg_transaction_value, {count_where("is_fraud")} AS fraud_count,
        {volume(where="is_fraud")} AS fraud_volume, {_counts(_COUNTS)},
        count(DISTINCT customer_id) AS unique_customers, {mean("fraud_score")} AS avg_fraud_score,{extra}
        {percent(count_where("is_fraud"), "count(*)", 4)} AS fraud_rate,
        {percent(count_where("status = 'APPROVED'"), "count(*)", 2)} AS approval_rate
        FROM {table} GROUP BY tx_year, tx_month"""


def _group_sql(key: str) -> str:
    return f"""SELECT {key}, count(*) AS total_transactions, {volume()} AS total_volume, {mean_amount()} AS avg_amount,
        {count_where("is_fraud")} AS fraud_count, {mean("fraud_score")} AS avg_fraud_score,
        count(DISTINCT customer_id) AS unique_customers,
        {percent(count_where("is_fraud"), "count(*)", 4)} AS fraud_rate FROM gold GROUP BY {key}"""


def _value_counts(table: str, key: str) -> str:
    return f"SELECT {key}, count(*) AS count FROM {table} GROUP BY {key}"


CUSTOMER_SQL = f"""SELECT customer_id, count(*) AS total_transactions, {volume()} AS total_amount,
    {mean_amount()} AS avg_amount, max(amount) AS max_amount, min(amount) AS min_amount,
    count(DISTINCT merchant_category) AS unique_categories, count(DISTINCT destination_bank) AS unique_banks,
    {count_where("is_fraud")} AS fraud_transactions, {count_where("risk_level = 'CRITICAL'")} AS critical_risk_count,
    {count_where("risk_level = 'HIGH'")} AS high_risk_count, {count_where("status = 'APPROVED'")} AS approved_count,
    {count_where("status = 'DECLINED'")} AS declined_count, {count_where("unusual_time")} AS unusual_time_count,
    {count_where("new_beneficiary")} AS new_beneficiary_count, {mean("fraud_score")} AS avg_fraud_score,
    max(fraud_score) AS max_fraud_score, CAST(min(timestamp_dt) AS VARCHAR) AS first_transaction,
    CAST(max(timestamp_dt) AS VARCHAR) AS last_transaction FROM gold GROUP BY customer_id"""
_RATE = percent("m.fraud_transactions", "m.total_transactions", 2)
_LEVEL = f"""CASE WHEN {_RATE} > 5 THEN 'VERY_HIGH' WHEN {_RATE} > 2 THEN 'HIGH'
    WHEN m.critical_risk_count + m.high_risk_count > 5 THEN 'MEDIUM' ELSE 'LOW' END"""


def _summary_check(select: str) -> str:
    people = {name: CTES[name] for name in ("fx_customers", "customers")}
    return check("gold", select, measures=CUSTOMER_SQL, **people)


def _running(key: str, *columns: str, where: str = "") -> str:
    parts = {
        "total_transactions": "count(*)", "total_amount": volume("amount_clean"),
        "avg_amount": mean_amount("amount_clean"), "avg_fraud_score": mean("fraud_score_combined"),
        "fraud_count": count_where("is_fraud"),
        "pix_new_beneficiary_count": count_where("is_pix_new_beneficiary"),
        "avg_installments": mean("installments", 1), "manual_entry_count": count_where("is_manual_card_entry"),
    }
    chosen = ", ".join(f"{parts[c]} AS {c}" for c in ("total_transactions", "total_amount", "fraud_count", *columns))
    return check("stream", f"SELECT {key}, {chosen} FROM stream_silver {where} GROUP BY {key}")


RUNNING_SQL = {
    "metrics_by_type": _running("type, risk_level", "avg_amount", "avg_fraud_score"),
    "metrics_by_channel": _running("channel, risk_level", "avg_fraud_score"),
    "metrics_by_category": _running("merchant_category, mcc_risk_level", "avg_amount", "pix_new_beneficiary_count"),
    "metrics_by_card_brand": _running("card_brand, card_type", "avg_installments", "manual_entry_count",
                                      where="WHERE card_brand IS NOT NULL"),
}

RECENT_SQL = """SELECT CAST({time} AS VARCHAR) AS detected_at, transaction_id, customer_id, amount, merchant_name AS merchant, merchant_category AS category,
    channel, type AS transaction_type, card_brand FROM {table} WHERE is_fraud
    ORDER BY {table}.{time} DESC, transaction_id LIMIT 100"""

ORACLE = {
    "a01_monthly": check("gold", monthly_sql("gold", _counts(_TYPES) + ",")),
    "a02_monthly_enriched": check("enriched", monthly_sql("leveled"), enriched=ENRICHED_CTE, leveled=ENRICHED_LEVEL),
    "a03_by_type": check("gold", _group_sql("type")),
    "a04_by_channel": check("gold", _group_sql("channel")),
    "a05_by_customer": check("gold", CUSTOMER_SQL),
    "a06_customer_short": check("silver", f"""SELECT customer_id, {volume()} AS total_spent, count(*) AS transactions,
        {mean_amount()} AS avg_spent, CAST(sum(CAST(is_fraud AS INTEGER)) AS BIGINT) AS frauds
        FROM silver GROUP BY customer_id"""),
    "a07_by_level": check("movement", f"""SELECT risk_level, count(*) AS total, {mean_amount("amount_clean")} AS avg_amount,
        {mean("fraud_score", 1)} AS avg_score FROM geo_scored GROUP BY risk_level""", **GEO_CTES),
    "a08_types": check("silver", _value_counts("silver", "type")),
    "a08_amount_ranges": check("silver", _value_counts("silver", "amount_range")),
    "a08_score_categories": check("silver", _value_counts("silver", "fraud_score_category")),
    "a08_risk_levels": check("gold", _value_counts("gold", "risk_level")),
    "a09_category_by_level": check("silver", """SELECT category, risk_level, count(*) AS count FROM silver
        JOIN sensitive_scored USING (transaction_id) GROUP BY category, risk_level""",
                                   sensitive=SENSITIVE_SQL, sensitive_scored=sensitive_score("is_high_value")),
    "a10_type_by_level": RUNNING_SQL["metrics_by_type"],
    "a11_channel_by_level": RUNNING_SQL["metrics_by_channel"],
    "a12_category_by_mcc": RUNNING_SQL["metrics_by_category"],
    "a13_brand_by_card": RUNNING_SQL["metrics_by_card_brand"],
    "a14_totals": check("fx_tx", f"""SELECT count(*) AS transactions, {volume()} AS total_amount,
        {count_where("is_fraud")} AS frauds FROM fx_tx"""),
    "a16_fraud_summary": check("silver", f"""SELECT count(*) AS total_transactions, {count_where("is_fraud")} AS total_frauds,
        CAST(sum(CAST(round(amount * 100) AS BIGINT)) FILTER (WHERE is_fraud) AS DOUBLE) / 100 AS fraud_amount,
        {percent(count_where("is_fraud"), "count(*)", 2)} AS fraud_percent FROM silver"""),
    "o2_top_alert_categories": check("movement", """SELECT category, count(*) AS count FROM geo_scored
        WHERE fraud_score >= 30 GROUP BY category ORDER BY 2 DESC, 1 LIMIT 5""", **GEO_CTES),
    "o3_recent_frauds": check("silver", RECENT_SQL.format(table="silver", time="timestamp_dt")),
    "j3_customer_summary": _summary_check(f"""SELECT m.*, c.full_name, c.tax_id_digits, c.state_upper,
        {half_up("c.monthly_income", 2)} AS monthly_income, c.income_band, c.credit_score, c.credit_band, c.is_premium,
        c.pep, {_RATE} AS fraud_rate, {_LEVEL} AS customer_risk_level
        FROM measures m LEFT JOIN customers c ON m.customer_id = c.customer_id"""),
    "r9_customer_level": _summary_check(
        f"SELECT m.customer_id, {_RATE} AS fraud_rate, {_LEVEL} AS customer_risk_level FROM measures m"),
}
