"""Scored transactions and the alerts drawn from them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import flags, geo
from riskloom.operators import clean, history, rules

# State of a case that nobody has looked at.
NEW_CASE = {"investigation_status": "PENDING", "analyst_id": "", "investigation_notes": ""}


def score_batch(silver: DataFrame) -> DataFrame:
    """Batch rule pack and review flag over Silver; a projection without shuffle."""
    return rules.BATCH.apply(silver).withColumn("requires_review", rules.needs_review())


def gold_table(scored: DataFrame) -> DataFrame:
    return schemas.pick(scored, schemas.GOLD_COLUMNS)


def reporting_table(gold: DataFrame) -> DataFrame:
    return schemas.pick(gold, schemas.REPORTING_COLUMNS)


def alerts(scored: DataFrame) -> DataFrame:
    """Transactions to review, with reason tags and an open case. An unknown review flag drops the row."""
    opened = scored.where("requires_review").withColumns({
        **flags.alert_tags(), **{name: F.lit(value) for name, value in NEW_CASE.items()},
    })
    return schemas.pick(opened, schemas.ALERT_COLUMNS)


def geo_silver(df: DataFrame, **options) -> DataFrame:
    """Geo feed with movement features and flags. ``df`` needs ``epoch`` and ``transaction_hour``."""
    added = {"amount_clean": clean.clean_amount(), "distance_gps": geo.gps_gap()}
    # flags of the row itself come first: what only they read is not shuffled
    flagged = df.withColumns(added).withColumns(flags.geo_flags())
    moved = history.movement(flagged, **{"along": True, **options})
    last = [*added, *flags.geo_flags()]
    return moved.select(*[c for c in moved.columns if c not in last], *last)


def geo_detection(df: DataFrame, **options) -> DataFrame:
    """Geo rule pack. The pack's own score replaces any score that came with the feed."""
    return rules.GEO.apply(geo_silver(df, **options))


def sensitive_silver(df: DataFrame, amount: str = "amount_clean") -> DataFrame:
    cleaned = df.withColumns({"amount_clean": clean.clean_amount(), "distance_gps": geo.gps_gap()})
    return cleaned.withColumns(flags.sensitive_flags(amount))


def sensitive_detection(df: DataFrame, amount: str = "amount_clean") -> DataFrame:
    """Sensitive geo pack; ``amount`` names the amount its high-value flag looks at."""
    return rules.SENSITIVE.apply(sensitive_silver(df, amount))


def geo_reporting(scored: DataFrame, score: str = "fraud_score", merchant: str = "merchant") -> DataFrame:
    """Narrow transaction table for reporting; the score becomes a whole number."""
    return scored.select(
        "transaction_id", "customer_id", F.col("amount_clean").alias("amount"),
        F.col(merchant).alias("merchant"), "category", F.col(score).cast("int").alias("fraud_score"),
        "risk_level", "is_fraud",
    )


def geo_alerts(scored: DataFrame, score: str = "fraud_score", merchant: str = "merchant") -> DataFrame:
    return scored.where(F.col("risk_level").isin("HIGH", "CRITICAL")).select(
        "transaction_id", "customer_id", F.col("amount_clean").alias("amount"),
        F.col(merchant).alias("merchant"), F.col(score).cast("int").alias("fraud_score"), "risk_level",
        "is_fraud", "customer_home_state", "purchase_state",
    )


def stream_silver(df: DataFrame) -> DataFrame:
    """Stateless cleaning, flags and combined score; the same for a stream and for a table."""
    time = F.try_to_timestamp(F.col("timestamp"))
    cleaned = df.withColumns({
        "event_time": time, "transaction_hour": F.hour(time), "amount_clean": clean.clean_amount(),
    })
    scored = rules.combine_scores(cleaned.withColumns(flags.stream_flags()), rules.STREAM)
    return schemas.pick(scored, schemas.STREAM_SILVER_COLUMNS)


def stream_alerts(silver: DataFrame, *more: str) -> DataFrame:
    high = silver.where(F.col("risk_level").isin("HIGH", "CRITICAL"))
    return schemas.pick(high, [*schemas.STREAM_ALERT_COLUMNS, *more])


def stream_load(df: DataFrame) -> DataFrame:
    """The scoring stream's own variant: high value on the raw amount, and the shorter rule pack."""
    time = F.try_to_timestamp(F.col("timestamp"))
    cleaned = df.withColumns({
        "event_time": time, "transaction_hour": F.hour(time), "amount_clean": clean.clean_amount(),
    })
    return rules.combine_scores(cleaned.withColumns(flags.stream_flags("amount")), rules.STREAM_LOAD)


def load_columns(scored: DataFrame, columns: list[str]) -> DataFrame:
    """Rename for loading and narrow the two scores to whole numbers (truncated)."""
    names = schemas.STREAM_LOAD_NAMES
    unrenamed = {target: source for source, target in names.items()}
    sources = [unrenamed.get(c, c) for c in columns]
    narrow = {"fraud_score", "fraud_score_total"}
    return schemas.pick(scored, sources).withColumnsRenamed(names).withColumns({
        c: F.col(c).cast("int") for c in columns if c in narrow
    })
