"""Aggregate tables. Every aggregate is combined on the map side, so a group holding most of the rows
costs no more than any other. Distinct counts are exact."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.measures import (
    cents, finite, fraction, mean, mean_amount, percent, rows, rows_where, volume, volume_where,
)
from riskloom.operators import rules

# Fixed values
STATUS_COUNTS = {"approved_count": "APPROVED", "declined_count": "DECLINED", "blocked_count": "BLOCKED"}
LEVEL_COUNTS = {
    "critical_count": "CRITICAL", "high_count": "HIGH", "medium_count": "MEDIUM", "low_count": "LOW",
}
TYPE_COUNTS = {
    "pix_count": "PIX", "credit_card_count": "CREDIT_CARD", "debit_card_count": "DEBIT_CARD",
    "ted_count": "TED", "boleto_count": "BOLETO",
}


def _counts(column: str, names: dict[str, str]) -> list[Column]:
    return [rows_where(F.col(column) == value).alias(name) for name, value in names.items()]


def monthly(scored: DataFrame, by_type: bool = True) -> DataFrame:
    """Measures per year and month, with rates in percent; ``by_type`` adds a count per type."""
    measures = [
        rows().alias("total_transactions"),
        volume("amount").alias("total_volume"),
        mean_amount("amount").alias("avg_transaction_value"),
        rows_where(F.col("is_fraud")).alias("fraud_count"),
        volume_where(F.col("is_fraud"), "amount").alias("fraud_volume"),
        *_counts("risk_level", LEVEL_COUNTS),
        *_counts("status", STATUS_COUNTS),
        F.countDistinct("customer_id").alias("unique_customers"),
        mean("fraud_score").alias("avg_fraud_score"),
        *(_counts("type", TYPE_COUNTS) if by_type else []),
    ]
    total = F.col("total_transactions")
    return scored.groupBy("tx_year", "tx_month").agg(*measures).withColumns({
        "fraud_rate": percent(F.col("fraud_count"), total, 4),
        "approval_rate": percent(F.col("approved_count"), total, 2),
    }).orderBy("tx_year", "tx_month")


def by_group(scored: DataFrame, group: str) -> DataFrame:
    """Measures per type, channel or any other column."""
    return scored.groupBy(group).agg(
        rows().alias("total_transactions"),
        volume("amount").alias("total_volume"),
        mean_amount("amount").alias("avg_amount"),
        rows_where(F.col("is_fraud")).alias("fraud_count"),
        mean("fraud_score").alias("avg_fraud_score"),
        F.countDistinct("customer_id").alias("unique_customers"),
    ).withColumn("fraud_rate", percent(F.col("fraud_count"), F.col("total_transactions"), 4))


def customer_measures(scored: DataFrame) -> DataFrame:
    """One pass by customer, category and bank with measures that add up, then by customer: categories and banks are
    few for each customer, so counting the different ones needs no copy of the rows."""
    counts = {
        "total_transactions": F.lit(True),
        "fraud_transactions": F.col("is_fraud"),
        "critical_risk_count": F.col("risk_level") == "CRITICAL",
        "high_risk_count": F.col("risk_level") == "HIGH",
        "approved_count": F.col("status") == "APPROVED",
        "declined_count": F.col("status") == "DECLINED",
        "unusual_time_count": F.col("unusual_time"),
        "new_beneficiary_count": F.col("new_beneficiary"),
    }
    parts = scored.groupBy("customer_id", "merchant_category", "destination_bank").agg(
        *[rows_where(condition).alias(name) for name, condition in counts.items()],
        F.try_sum(cents("amount")).alias("_cents"), F.count(cents("amount")).alias("_amounts"),
        F.max("amount").alias("max_amount"), F.min("amount").alias("min_amount"),
        F.sum("fraud_score").alias("_score"), F.count("fraud_score").alias("_scores"),
        F.max("fraud_score").alias("max_fraud_score"),
        F.min("timestamp_dt").alias("first_transaction"), F.max("timestamp_dt").alias("last_transaction"),
    )
    whole, amounts = F.try_sum("_cents"), F.sum("_amounts")
    return parts.groupBy("customer_id").agg(
        *[F.sum(name).alias(name) for name in counts],
        (whole / F.lit(100.0)).alias("total_amount"),
        F.round(F.try_divide(whole.cast("double"), 100.0 * amounts), 2).alias("avg_amount"),
        F.max("max_amount").alias("max_amount"), F.min("min_amount").alias("min_amount"),
        F.size(F.collect_set("merchant_category")).cast("long").alias("unique_categories"),
        F.size(F.collect_set("destination_bank")).cast("long").alias("unique_banks"),
        F.round(F.try_divide(F.sum("_score"), F.sum("_scores")), 2).alias("avg_fraud_score"),
        F.max("max_fraud_score").alias("max_fraud_score"),
        F.min("first_transaction").alias("first_transaction"), F.max("last_transaction").alias("last_transaction"),
    )


def customer_summary(scored: DataFrame, customers: DataFrame, attributes: list[str]) -> DataFrame:
    """One row per customer: measures, attributes, fraud rate in percent and risk level."""
    facts = customers.select("customer_id", *attributes)
    joined = customer_measures(scored).join(facts, "customer_id", "left")
    rate = percent(F.col("fraud_transactions"), F.col("total_transactions"), 2)
    return joined.withColumn("fraud_rate", rate).withColumn("customer_risk_level", rules.customer_level())


def customer_short(df: DataFrame) -> DataFrame:
    """Short summary; the fraud count is null for a customer whose labels are all unknown."""
    return df.groupBy("customer_id").agg(
        volume("amount").alias("total_spent"),
        rows().alias("transactions"),
        mean_amount("amount").alias("avg_spent"),
        F.sum(F.col("is_fraud").cast("int")).alias("frauds"),
    )


def by_level(scored: DataFrame, amount: str = "amount_clean", score: str = "fraud_score") -> DataFrame:
    return scored.groupBy("risk_level").agg(
        rows().alias("total"), mean_amount(amount).alias("avg_amount"), mean(score, 1).alias("avg_score")
    ).orderBy(F.desc("total"), "risk_level")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(rows().alias("count")).orderBy(F.desc("count"), column)


def category_by_level(scored: DataFrame) -> DataFrame:
    return scored.groupBy("category", "risk_level").agg(rows().alias("count")).orderBy("category", "risk_level")


def top_alert_categories(scored: DataFrame, k: int = 5) -> DataFrame:
    """Categories with most high-risk transactions; ties go by name."""
    high = scored.where(F.col("risk_level").isin("HIGH", "CRITICAL"))
    return high.groupBy("category").agg(rows().alias("count")).orderBy(F.desc("count"), "category").limit(k)


def totals(df: DataFrame) -> DataFrame:
    """Row count, volume and fraud count in one pass."""
    return df.agg(
        rows().alias("transactions"), volume("amount").alias("total_amount"),
        rows_where(F.col("is_fraud")).alias("frauds"),
    )


def fraud_summary(df: DataFrame) -> DataFrame:
    """One row: transactions, frauds, their value and share in percent."""
    return df.agg(
        rows().alias("total_transactions"),
        rows_where(F.col("is_fraud")).alias("total_frauds"),
        F.try_sum(F.when(F.col("is_fraud"), cents("amount"))).alias("_cents"),
    ).select(
        "total_transactions", "total_frauds", (F.col("_cents") / F.lit(100.0)).alias("fraud_amount"),
        percent(F.col("total_frauds"), F.col("total_transactions"), 2).alias("fraud_percent"),
    )


# --- running aggregates of the stream; also usable on a table ----------------------------------------


def _running(extra: list[Column], mean_score: bool = True, mean_value: bool = True) -> list[Column]:
    out = [rows().alias("total_transactions"), volume("amount_clean").alias("total_amount")]
    if mean_value:
        out.append(mean_amount("amount_clean").alias("avg_amount"))
    if mean_score:
        out.append(mean("fraud_score_combined").alias("avg_fraud_score"))
    return [*out, rows_where(F.col("is_fraud")).alias("fraud_count"), *extra]


def running_by_type(silver: DataFrame) -> DataFrame:
    return silver.groupBy("type", "risk_level").agg(*_running([]))


def running_by_channel(silver: DataFrame) -> DataFrame:
    return silver.groupBy("channel", "risk_level").agg(*_running([], mean_value=False))


def running_by_category(silver: DataFrame) -> DataFrame:
    pix = rows_where(F.col("is_pix_new_beneficiary")).alias("pix_new_beneficiary_count")
    return silver.groupBy("merchant_category", "mcc_risk_level").agg(*_running([pix], mean_score=False))


def running_by_brand(silver: DataFrame) -> DataFrame:
    extra = [
        mean("installments", 1).alias("avg_installments"),
        rows_where(F.col("is_manual_card_entry")).alias("manual_entry_count"),
    ]
    cards = silver.where(F.col("card_brand").isNotNull()).groupBy("card_brand", "card_type")
    return cards.agg(*_running(extra, mean_score=False, mean_value=False))


RUNNING = {
    "metrics_by_type": running_by_type,
    "metrics_by_channel": running_by_channel,
    "metrics_by_category": running_by_category,
    "metrics_by_card_brand": running_by_brand,
}


# --- one-minute windows ------------------------------------------------------------------------------


def minute_partials(df: DataFrame, group: str | None = None, time: str = "event_time") -> DataFrame:
    """Mergeable parts of the one-minute measures: counts, sums in cents, maximum; no rates yet."""
    fraud = F.col("is_fraud")
    amount_cents = cents("amount")
    keys = [F.window(F.col(time), "1 minute").alias("window"), *([F.col(group)] if group else [])]
    return df.groupBy(*keys).agg(
        rows().alias("n"),
        F.count(amount_cents).alias("n_amounts"),
        F.try_sum(amount_cents).alias("cents"),
        rows_where(fraud).alias("n_fraud"),
        F.try_sum(F.when(fraud, amount_cents).otherwise(F.lit(0))).alias("fraud_cents"),
        F.max(finite("amount")).alias("max_amount"),
    ).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *([group] if group else []), "n", "n_amounts", "cents", "n_fraud", "fraud_cents", "max_amount",
    )


def merge_partials(partials: DataFrame, group: str | None = None) -> DataFrame:
    """Add up the parts of each window, so that every window is one row however many batches it took."""
    keys = ["window_start", "window_end", *([group] if group else [])]
    return partials.groupBy(*keys).agg(
        *[F.try_sum(c).alias(c) for c in ("n", "n_amounts", "cents", "n_fraud", "fraud_cents")],
        F.max("max_amount").alias("max_amount"),
    )


def minute_metrics(partials: DataFrame, group: str | None = None) -> DataFrame:
    """The reported measures. The fraud rate is a fraction here, not a percentage."""
    n, whole = F.col("n"), F.col("cents")
    total = (whole / F.lit(100.0)).alias("total_amount")
    rate = fraction(F.col("n_fraud"), n).alias("fraud_rate")
    if group:
        return partials.select(
            "window_start", "window_end", group, n.alias("transaction_count"), total,
            F.col("n_fraud").alias("fraud_count"), rate,
        )
    return partials.select(
        "window_start", "window_end", n.alias("total_transactions"), total,
        F.col("n_fraud").alias("fraud_count"), (F.col("fraud_cents") / F.lit(100.0)).alias("fraud_amount"),
        rate, F.round(F.try_divide(whole.cast("double"), 100.0 * F.col("n_amounts")), 2).alias("avg_amount"),
        F.round("max_amount", 2).alias("max_amount"),
    )


def recent_frauds(df: DataFrame, k: int = 100, time: str = "event_time") -> DataFrame:
    """Latest frauds with the time they happened; newest first, ties by transaction."""
    return df.where("is_fraud").orderBy(F.desc(time), "transaction_id").limit(k).select(
        F.col(time).alias("detected_at"), "transaction_id", "customer_id", "amount", F.col("merchant_name").alias("merchant"),
        F.col("merchant_category").alias("category"), "channel", F.col("type").alias("transaction_type"),
        "card_brand",
    )
