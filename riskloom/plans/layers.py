"""The batch run: raw rows to Bronze, Silver and Gold tables, each written once and read by the next.

Writing the layers is what cuts the lineage: a lost executor costs tasks of one layer, never a re-run
from the raw rows, and all later readers share one de-duplication and one scoring.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import clean, detection, enrich, history, ingest, marts, rules
from riskloom.session import work_folder
from riskloom.sources import readers, writers

# Customer attributes joined to the customer summary.
SUMMARY_ATTRIBUTES = """
    full_name tax_id_digits state_upper city_clean bank_name monthly_income income_band credit_score
    credit_band status is_premium pep
""".split()

# History fields that the batch rules read.
SCORED_HISTORY = ["transactions_last_24h", "accumulated_amount_24h", "distance_from_last_txn_km"]


@dataclass(frozen=True)
class Layers:
    """Table places below one root folder."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def bronze(self) -> str:
        return self.path("bronze/transactions")

    @property
    def silver(self) -> str:
        return self.path("silver/transactions")

    @property
    def detection(self) -> str:
        return self.path("gold/fraud_detection")

    @property
    def alerts(self) -> str:
        return self.path("gold/fraud_alerts")


def write_bronze(raw: DataFrame, layers: Layers, source_format: str, rebalance: bool = True) -> dict:
    """``rebalance`` can be left out where each input file holds few days, which saves the shuffle."""
    rows = ingest.bronze(raw, source_format)
    return writers.write_counted(
        rows, layers.bronze, partition_by=["year", "month", "day"], rebalance=rebalance
    )


def write_silver(bronze: DataFrame, layers: Layers, rebalance: bool = True) -> dict:
    """``rebalance`` can be left out where more files in a month's folder matter less than a second shuffle."""
    return writers.write_counted(
        clean.silver_transactions(bronze), layers.silver,
        partition_by=["tx_year", "tx_month"], rebalance=rebalance, stamp_as="_silver_timestamp",
    )


def write_detection(spark: SparkSession, layers: Layers, computed: list[str] | None = None) -> dict:
    """Scoring does not shuffle and there are only four levels, so rows are written where they are. ``computed`` names
    history fields that the feed lacks; they are computed from Silver first (``history.with_computed``)."""
    rows = readers.table(spark, layers.silver)
    scored = detection.gold_table(detection.score_batch(history.with_computed(rows, computed) if computed else rows))
    return writers.write_counted(
        scored, layers.detection, partition_by=["risk_level"], stamp_as="_gold_timestamp"
    )


def write_alerts(spark: SparkSession, layers: Layers) -> None:
    scored = readers.table(spark, layers.detection)
    writers.write_table(detection.alerts(scored), layers.alerts, stamp_as="created_at")


def write_reports(spark: SparkSession, layers: Layers) -> None:
    """Aggregate tables from the written detection table."""
    scored = readers.table(spark, layers.detection)
    reports = {
        "fraud_metrics": marts.monthly(scored),
        "metrics_by_type": marts.by_group(scored, "type"),
        "metrics_by_channel": marts.by_group(scored, "channel"),
    }
    for name, report in reports.items():
        writers.write_table(report, layers.path(f"gold/{name}"), stamp_as="_gold_timestamp")


def run_batch(
    spark: SparkSession, raw: DataFrame, root: str, source_format: str = "parquet", computed: list[str] | None = None
) -> dict:
    """All layers in order; returns the rows written per layer. ``computed`` as in ``write_detection``; by default the
    history fields that the rules read and ``raw`` does not have."""
    if computed is None:
        computed = [c for c in SCORED_HISTORY if c not in raw.columns and set(history.PREVIOUS[1:]) <= set(raw.columns)]
    layers = Layers(root)
    counts = {
        "bronze": write_bronze(raw, layers, source_format)["rows"],
        "silver": write_silver(readers.table(spark, layers.bronze), layers)["rows"],
        "gold": write_detection(spark, layers, computed)["rows"],
    }
    write_alerts(spark, layers)
    write_reports(spark, layers)
    return counts


DAY, MONTH = ["year", "month", "day"], ["tx_year", "tx_month"]


def rerun_days(spark: SparkSession, raw: DataFrame, root: str, source_format: str = "parquet") -> dict:
    """Bring Bronze and Silver up to date after ``raw``, all raw rows of some days, has come again or late.

    The days are found in ``raw`` and replaced in Bronze; rows without a day belong to none and are counted, not written.
    In Silver, a transaction that is or was in these days may have its first row in another month, so the months of all
    its rows are written anew: their other rows as they are, these transactions from all their rows. No other folder is
    touched. Silver is written before Bronze and the days last, so a run that failed anywhere is simply run again.

    Both tables are replaced folder by folder through dynamic overwrite; the days and months are few and known to the driver.
    """
    layers, work = Layers(root), f"{work_folder(spark)}/riskloom-rerun-{uuid.uuid4().hex}"
    rows = ingest.bronze(raw, source_format)
    writers.write_table(rows, f"{work}/days")
    new = readers.table(spark, f"{work}/days")
    undated = new.where(F.col("day").isNull()).count()
    new = new.where(F.col("day").isNotNull())
    days = [tuple(r) for r in new.select(*DAY).distinct().collect()]
    if not days:
        return {"days": 0, "months": 0, "undated": undated}
    old = readers.table(spark, layers.bronze)
    in_days = _among(DAY, days)
    ids = old.where(in_days).select("transaction_id").unionByName(new.select("transaction_id")).distinct()
    writers.write_table(ids, f"{work}/ids")
    ids = readers.table(spark, f"{work}/ids")
    columns = [c for c in new.columns if c in old.columns]
    others = old.where(~in_days | F.col("day").isNull()).join(ids, "transaction_id", "left_semi")
    candidates = others.select(*columns).unionByName(new.select(*columns))
    writers.write_table(clean.silver_transactions(candidates), f"{work}/first")
    first = readers.table(spark, f"{work}/first")
    silver = readers.table(spark, layers.silver).drop("_silver_timestamp")
    was = silver.join(ids, "transaction_id", "left_semi").select(*MONTH)
    months = [tuple(r) for r in was.unionByName(first.select(*MONTH)).distinct().collect()]
    stay = silver.where(_among(MONTH, months)).join(ids, "transaction_id", "left_anti")
    writers.replace_partitions(stay.unionByName(first.select(*stay.columns)), layers.silver, MONTH, months, "_silver_timestamp")
    writers.replace_partitions(new, layers.bronze, DAY, days)
    return {"days": len(days), "months": len(months), "undated": undated}


def _among(names: list[str], values: list[tuple]) -> Column:
    """The partition columns have one of the given values; null is one like any other. Spark prunes folders by it."""
    found = F.lit(False)
    for value in values:
        same = F.lit(True)
        for name, v in zip(names, value, strict=True):
            same = same & (F.col(name).isNull() if v is None else F.coalesce(F.col(name) == v, F.lit(False)))
        found = found | same
    return found


def run_enriched(
    transactions: DataFrame, devices: DataFrame, customers: DataFrame, root: str, as_of: Column
) -> None:
    """The variant with dimensions: enriched detection, its alerts, customer summary and metrics."""
    spark = transactions.sparkSession
    layers = Layers(root)
    device_table, customer_table = layers.path("silver/devices"), layers.path("silver/customers")
    writers.write_table(clean.silver_devices(devices), device_table)
    writers.write_table(clean.silver_customers(customers), customer_table)
    people = readers.table(spark, customer_table)
    scored = enrich.enriched_detection(
        clean.silver_transactions(transactions), readers.table(spark, device_table), people, as_of
    )
    writers.write_table(scored, layers.detection, partition_by=["risk_level"], stamp_as="_gold_timestamp")
    written = readers.table(spark, layers.detection)
    attributes = [a for a in SUMMARY_ATTRIBUTES if a in people.columns and a != "status"]
    writers.write_table(detection.alerts(written), layers.alerts, stamp_as="created_at")
    writers.write_table(
        marts.customer_summary(written, people, attributes), layers.path("gold/customer_summary"),
        stamp_as="_gold_timestamp",
    )
    writers.write_table(
        marts.monthly(written, by_type=False), layers.path("gold/fraud_metrics"), stamp_as="_gold_timestamp"
    )


def run_geo(envelopes: DataFrame, root: str, unit: str = "seconds") -> None:
    """Geo feed from raw message text: movement features, flags, geo pack, alerts and aggregates. ``unit``
    says how the feed stores its event time."""
    spark = envelopes.sparkSession
    layers = Layers(root)
    parsed = ingest.parse_json(envelopes, "raw_json", schemas.GEO)
    silver = detection.geo_silver(history.with_epoch(parsed, "timestamp", unit))
    writers.write_table(silver, layers.silver, stamp_as="silver_timestamp")
    scored = rules.GEO.apply(readers.table(spark, layers.silver))
    writers.write_table(scored, layers.detection, partition_by=["risk_level"], stamp_as="gold_timestamp")
    _write_geo_reports(readers.table(spark, layers.detection), layers, "fraud_score")


def run_sensitive(parsed: DataFrame, root: str, amount: str = "amount_clean") -> None:
    """The sensitive geo pack over parsed geo rows, from files or from a topic read as a batch."""
    layers = Layers(root)
    scored = detection.sensitive_detection(parsed, amount)
    writers.write_table(scored, layers.detection, partition_by=["risk_level"], stamp_as="processed_at")
    _write_geo_reports(readers.table(parsed.sparkSession, layers.detection), layers, "fraud_score_calculated")


def _write_geo_reports(scored: DataFrame, layers: Layers, score: str) -> None:
    reports = {
        "transactions": detection.geo_reporting(scored, score),
        "fraud_alerts": detection.geo_alerts(scored, score),
        "metrics_by_level": marts.by_level(scored, score=score),
        "metrics_by_category": marts.category_by_level(scored),
        "top_alert_categories": marts.top_alert_categories(scored),
    }
    for name, report in reports.items():
        writers.write_table(report, layers.path(f"gold/{name}"))


def run_simple(transactions: DataFrame, customers: DataFrame, root: str) -> None:
    """The short run: basic cleaning, two-rule levels, customer and fraud summaries."""
    spark = transactions.sparkSession
    layers = Layers(root)
    writers.write_table(clean.simple_customers(customers), layers.path("silver/customers"), stamp_as="processed_at")
    writers.write_table(clean.simple_transactions(transactions), layers.silver, stamp_as="_silver_timestamp")
    cleaned = readers.table(spark, layers.silver)
    writers.write_table(rules.two_rule_level(cleaned), layers.detection, partition_by=["risk_level"])
    writers.write_table(marts.customer_short(cleaned), layers.path("gold/customer_summary"))
    writers.write_table(marts.fraud_summary(cleaned), layers.path("gold/fraud_summary"))


def load_reports(
    spark: SparkSession, root: str, url: str, properties: dict[str, str], connections: int | None = None
) -> None:
    """Gold tables into a database: the two large ones over several connections, the aggregates as they are."""
    parallel = connections or writers.CONNECTIONS
    layers = Layers(root)
    scored = schemas.pick(
        readers.table(spark, layers.detection), [*schemas.REPORTING_COLUMNS, "_gold_timestamp"]
    )
    writers.jdbc_overwrite(scored, url, "batch_transactions", properties, parallel)
    writers.jdbc_overwrite(readers.table(spark, layers.alerts), url, "batch_fraud_alerts", properties, parallel)
    for name in ("fraud_metrics", "metrics_by_type", "metrics_by_channel"):
        report = readers.table(spark, layers.path(f"gold/{name}"))
        writers.jdbc_overwrite_small(report, url, f"batch_{name}", properties)
