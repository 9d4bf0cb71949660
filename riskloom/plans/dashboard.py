"""Dashboard questions over the scored transactions and the alerts.

Each takes the table(s) it reads and returns a small result. Numbers come as numbers; where a report
shows them formatted, a ``_text`` column is added. Rates are percentages. Ties in rankings go by key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import ladders, text
from riskloom.functions.measures import mean, percent, rows, rows_where, volume, volume_where

FRAUD = "is_fraud"


def _fraud() -> Column:
    return F.col(FRAUD)


def _fraud_rate(total: str = "total", frauds: str = "frauds", digits: int = 2) -> Column:
    return percent(F.col(frauds), F.col(total), digits)


def _with_frauds(grouped, total: str = "total", frauds: str = "frauds") -> DataFrame:
    return grouped.agg(rows().alias(total), rows_where(_fraud()).alias(frauds))


def _period() -> Column:
    return text.year_month(F.col("tx_year"), F.col("tx_month")).alias("period")


# --- single figures ----------------------------------------------------------------------------------


def total_transactions(tx: DataFrame) -> DataFrame:
    return tx.agg(rows().alias("total")).withColumn("total_text", text.grouped_number(F.col("total")))


def total_volume(tx: DataFrame) -> DataFrame:
    return tx.agg(volume("amount").alias("volume")).withColumn("volume_text", text.money_text(F.col("volume")))


def fraud_count(tx: DataFrame) -> DataFrame:
    found = tx.where(_fraud()).agg(rows().alias("frauds"))
    return found.withColumn("frauds_text", text.grouped_number(F.col("frauds")))


def fraud_rate(tx: DataFrame) -> DataFrame:
    rate = tx.agg(rows().alias("total"), rows_where(_fraud()).alias("frauds")).select(
        _fraud_rate().alias("fraud_rate")
    )
    return rate.withColumn("fraud_rate_text", F.concat(text.grouped_number(F.col("fraud_rate"), 2), F.lit("%")))


def protected_value(tx: DataFrame) -> DataFrame:
    """Value of frauds that were declined."""
    blocked = tx.where(_fraud() & (F.col("status") == "DECLINED")).agg(volume("amount").alias("protected"))
    return blocked.withColumn("protected_text", text.money_text(F.col("protected")))


def critical_alerts(alerts: DataFrame) -> DataFrame:
    found = alerts.where(F.col("risk_level") == "CRITICAL").agg(rows().alias("critical_alerts"))
    return found.withColumn("critical_alerts_text", text.grouped_number(F.col("critical_alerts")))


# --- trends ------------------------------------------------------------------------------------------


def monthly_counts(tx: DataFrame) -> DataFrame:
    by_month = _with_frauds(tx.groupBy("tx_year", "tx_month"), "transactions")
    return by_month.orderBy("tx_year", "tx_month").select(_period(), "transactions", "frauds")


def monthly_volume(tx: DataFrame) -> DataFrame:
    by_month = tx.groupBy("tx_year", "tx_month").agg(
        volume("amount").alias("total_volume"), volume_where(_fraud(), "amount").alias("fraud_volume")
    )
    return by_month.orderBy("tx_year", "tx_month").select(_period(), "total_volume", "fraud_volume")


def monthly_fraud_rate(tx: DataFrame) -> DataFrame:
    by_month = _with_frauds(tx.groupBy("tx_year", "tx_month"))
    return by_month.orderBy("tx_year", "tx_month").select(_period(), _fraud_rate().alias("fraud_rate"))


def by_hour(tx: DataFrame) -> DataFrame:
    return _with_frauds(tx.groupBy("tx_hour")).orderBy("tx_hour")


# --- shares ------------------------------------------------------------------------------------------


def risk_distribution(tx: DataFrame) -> DataFrame:
    known = tx.where(F.col("risk_level").isNotNull()).groupBy("risk_level").agg(rows().alias("total"))
    return known.orderBy(ladders.rank_of(F.col("risk_level"), ladders.LEVEL_ORDER))


def count_by(tx: DataFrame, column: str) -> DataFrame:
    return tx.groupBy(column).agg(rows().alias("total")).orderBy(F.desc("total"), column)


# --- frauds by group ---------------------------------------------------------------------------------


def top_by_fraud(tx: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Categories or merchants with most frauds."""
    frauds = tx.where(_fraud()).groupBy(column).agg(rows().alias("frauds"), volume("amount").alias("value"))
    return frauds.orderBy(F.desc("frauds"), column).limit(k)


def frauds_by_period(tx: DataFrame) -> DataFrame:
    """With each period's share of all frauds; the total comes from the few grouped rows."""
    frauds = tx.where(_fraud()).groupBy("period_of_day").agg(rows().alias("frauds"))
    total = frauds.agg(F.sum("frauds")).scalar()
    return frauds.withColumn("percent_of_total", percent(F.col("frauds"), total, 1)).orderBy(
        ladders.rank_of(F.col("period_of_day"), ladders.PERIOD_ORDER)
    )


def frauds_by_range(tx: DataFrame) -> DataFrame:
    frauds = tx.where(_fraud()).groupBy("amount_range").agg(rows().alias("frauds"))
    return frauds.orderBy(ladders.rank_of(F.col("amount_range"), ladders.RANGE_ORDER))


# --- detail tables -----------------------------------------------------------------------------------


def latest_alerts(alerts: DataFrame, k: int = 50) -> DataFrame:
    latest = alerts.orderBy(F.desc("timestamp_dt"), "transaction_id").limit(k)
    return latest.select(
        "transaction_id", "timestamp_dt", "customer_id", "type",
        text.money_text(F.col("amount")).alias("amount_text"), "merchant_name", "risk_level", "fraud_score",
        "investigation_status",
    )


def customers_with_most_alerts(alerts: DataFrame, k: int = 20) -> DataFrame:
    per_customer = alerts.groupBy("customer_id").agg(
        rows().alias("alerts"),
        rows_where(F.col("risk_level") == "CRITICAL").alias("critical"),
        rows_where(F.col("risk_level") == "HIGH").alias("high"),
        volume("amount").alias("value"),
    )
    top = per_customer.orderBy(F.desc("alerts"), "customer_id").limit(k)
    return top.withColumn("value_text", text.money_text(F.col("value")))


def monthly_table(metrics: DataFrame) -> DataFrame:
    """Monthly metrics as shown, newest month first."""
    rate = F.round("fraud_rate", 2)
    return metrics.orderBy(F.desc("tx_year"), F.desc("tx_month")).select(
        _period(),
        text.grouped_number(F.col("total_transactions")).alias("transactions_text"),
        text.money_text(F.col("total_volume")).alias("volume_text"),
        text.grouped_number(F.col("fraud_count")).alias("frauds_text"),
        F.concat(text.grouped_number(rate, 2), F.lit("%")).alias("fraud_rate_text"),
        "critical_count", "high_count",
    )


# --- analyses ----------------------------------------------------------------------------------------


def channel_type_matrix(tx: DataFrame) -> DataFrame:
    matrix = _with_frauds(tx.groupBy("channel", "type")).withColumn("fraud_rate", _fraud_rate())
    return matrix.orderBy(F.desc_nulls_last("fraud_rate"), "channel", "type")


def weekend_hour_pattern(tx: DataFrame) -> DataFrame:
    pattern = _with_frauds(tx.groupBy("is_weekend", "tx_hour")).orderBy("is_weekend", "tx_hour")
    day = F.when(F.col("is_weekend"), "WEEKEND").otherwise("WEEKDAY")
    return pattern.select(
        day.alias("day_type"), "tx_hour", "total", "frauds", _fraud_rate().alias("fraud_rate")
    )


def score_precision(tx: DataFrame) -> DataFrame:
    known = tx.where(F.col("fraud_score_category").isNotNull())
    per_category = _with_frauds(known.groupBy("fraud_score_category"))
    return per_category.withColumn("precision", _fraud_rate()).orderBy(
        ladders.rank_of(F.col("fraud_score_category"), ladders.LEVEL_ORDER)
    )


def rapid_customers(
    alerts: DataFrame, as_of: Column, hours: int = 24, more_than: int = 3, k: int = 20
) -> DataFrame:
    """Customers with many alerts in the hours up to ``as_of``. ``max_risk`` is the gravest level; the alphabetical
    maximum that a plain text maximum gives is kept next to it for comparison."""
    recent = alerts.where(F.col("timestamp_dt").between(as_of - F.make_dt_interval(hours=F.lit(hours)), as_of))
    gravity = ladders.rank_of(F.col("risk_level"), ladders.LEVEL_ORDER)
    per_customer = recent.groupBy("customer_id").agg(
        rows().alias("transactions"),
        volume("amount").alias("total_amount"),
        F.max("distance_from_last_txn_km").alias("max_distance_km"),
        F.min_by("risk_level", gravity).alias("max_risk"),
        F.max("risk_level").alias("max_risk_text"),
    )
    return per_customer.where(F.col("transactions") > more_than).orderBy(
        F.desc("transactions"), "customer_id"
    ).limit(k)


def location_flags(alerts: DataFrame) -> DataFrame:
    flagged = alerts.where(F.col("flag_location").isNotNull()).groupBy("flag_location")
    return flagged.agg(
        rows().alias("alerts"), mean("distance_from_last_txn_km").alias("avg_distance_km")
    ).orderBy(F.desc("alerts"), "flag_location")


# --- filter lists ------------------------------------------------------------------------------------


def months(tx: DataFrame) -> DataFrame:
    return tx.select(_period()).distinct().orderBy("period")


def choices(tx: DataFrame, column: str) -> DataFrame:
    """Known values of a column."""
    return tx.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


# --- questions with parameters -----------------------------------------------------------------------


def daily_counts(tx: DataFrame, start: Column, end: Column) -> DataFrame:
    """Per day between two points in time, both inclusive."""
    chosen = tx.where(F.col("timestamp_dt").between(start, end))
    per_day = _with_frauds(chosen.groupBy(F.to_date("timestamp_dt").alias("day")), "transactions")
    return per_day.orderBy("day")


def types_of_channel(tx: DataFrame, channel: str) -> DataFrame:
    per_type = _with_frauds(tx.where(F.col("channel") == channel).groupBy("type"))
    return per_type.orderBy(F.desc("total"), "type")


def _last_minutes(tx: DataFrame, as_of: Column, minutes: int, time: str) -> DataFrame:
    """Rows of the span that ends at ``as_of``, both ends included; what came later is not known yet."""
    return tx.where(F.col(time).between(as_of - F.make_dt_interval(mins=F.lit(minutes)), as_of))


def latest_transactions(
    tx: DataFrame, as_of: Column, minutes: int = 5, k: int = 100, time: str = "event_time"
) -> DataFrame:
    recent = _last_minutes(tx, as_of, minutes, time)
    return recent.orderBy(F.desc(time), "transaction_id").limit(k)


def latest_fraud_value(tx: DataFrame, as_of: Column, minutes: int = 5, time: str = "event_time") -> DataFrame:
    recent = _last_minutes(tx.where(_fraud()), as_of, minutes, time)
    return recent.agg(rows().alias("frauds"), volume("amount").alias("value"))


# --- quality of detection ----------------------------------------------------------------------------

ALERTED = ["CRITICAL", "HIGH", "MEDIUM"]


def level_precision(tx: DataFrame) -> DataFrame:
    per_level = tx.where(F.col("risk_level").isin(ALERTED)).groupBy("risk_level").agg(
        rows().alias("total"),
        rows_where(_fraud()).alias("true_positives"),
        rows_where(~_fraud()).alias("false_positives"),
    )
    return per_level.withColumn("precision", _fraud_rate("total", "true_positives")).orderBy(
        ladders.rank_of(F.col("risk_level"), ladders.LEVEL_ORDER)
    )


def overall_detection(tx: DataFrame) -> DataFrame:
    """Four counts in one pass."""
    alerted = F.col("risk_level").isin(ALERTED)
    return tx.agg(
        rows_where(_fraud()).alias("actual_frauds"),
        rows_where(alerted).alias("alerted"),
        rows_where(_fraud() & alerted).alias("true_positives"),
        rows_where(_fraud() & ~alerted).alias("false_negatives"),
    )


def levels_with_score(tx: DataFrame, score: str = "fraud_score") -> DataFrame:
    return tx.groupBy("risk_level").agg(
        rows().alias("total"), mean(score, 0).alias("avg_score")
    ).orderBy(F.desc("total"), "risk_level")


def top_frauds(tx: DataFrame, level: str = "CRITICAL", k: int = 10) -> DataFrame:
    chosen = tx.where(F.col("risk_level") == level)
    return chosen.orderBy(F.desc("fraud_score"), "transaction_id").limit(k).select(
        "transaction_id", "amount", F.col("merchant_name").alias("merchant"), "fraud_score"
    )
