"""Quality and evaluation (M), percentiles (A15), sampling (O4)."""

from pyspark.sql import functions as F

from riskloom.catalog.base import (
    alerts, as_of_time, check, count_where, feed, geo_feed, gold, half_up, percent, query, silver,
)
from riskloom.catalog.scoring import GAP, GEO_FLAG_SQL, HAVERSINE, RAW_GAP
from riskloom.functions import flags, geo
from riskloom.plans import quality

EVENTS_AS_OF = "2024-02-01 00:00:00"


def _flagged(spark, sf):
    return geo_feed(spark, sf).withColumn("distance_gps", geo.gps_gap()).withColumns(flags.geo_flags())


def _distances(spark, sf):
    gaps = silver(spark, sf).select(geo.gps_gap().alias("distance_gps"))
    return quality.distance_distribution(gaps)


def _spoilt(spark, sf):
    """Distances of which some are NaN, infinite or beyond any long."""
    kind, gap = F.col("tx_hour") % 6, geo.gps_gap()
    spoilt = F.when(kind == 1, F.lit(float("nan"))).when(kind == 2, F.lit(float("-inf"))).when(kind == 3, F.lit(1e300)).otherwise(gap)
    return silver(spark, sf).select(spoilt.alias("distance_gps"), F.when(kind < 3, F.lit(1e18)).alias("large"))


def _events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet")


def _sampled(spark, sf):
    """Number of sampled rows, and of those that are rows of the feed."""
    keys = ["transaction_id", "customer_id", "device_id", "timestamp"]
    rows = feed(spark, sf).select(*keys)
    chosen = quality.sample_rows(rows, 1000)
    known = rows.distinct().withColumn("known", F.lit(1))
    return chosen.join(known, keys, "left").agg(F.count(F.lit(1)).alias("sampled"), F.count("known").alias("members"))


QUERIES = {
    "a15_m3_distances": query(_distances),
    "m3_spoilt_distances": query(lambda s, d: quality.distance_distribution(_spoilt(s, d))),
    "m3_unusable_values": query(lambda s, d: quality.unusable(_spoilt(s, d), ["distance_gps", "large"])),
    "m1_flag_prevalence": query(lambda s, d: quality.flag_prevalence(_flagged(s, d))),
    "m2_flag_combinations": query(lambda s, d: quality.flag_combinations(_flagged(s, d))),
    "m4_row_counts": query(lambda s, d: quality.row_counts(
        {"raw": feed(s, d), "silver": silver(s, d), "detection": gold(s, d), "alerts": alerts(s, d)})),
    "m5_confusion_matrix": query(lambda s, d: quality.confusion_matrix(gold(s, d))),
    "m5_detection_quality": query(lambda s, d: quality.detection_quality(gold(s, d))),
    "m5_detection_quality_medium": query(lambda s, d: quality.detection_quality(
        gold(s, d), ("CRITICAL", "HIGH", "MEDIUM"))),
    "m6_freshness": query(lambda s, d: quality.freshness(
        gold(s, d), as_of_time(), "timestamp_dt", limit_minutes=60 * 24 * 365)),
    "m6_events_freshness": query(lambda s, d: quality.freshness(
        _events(s, d), as_of_time(EVENTS_AS_OF), "ts").drop("newest")),
    "m7_reconciliation": query(lambda s, d: quality.reconcile(feed(s, d), silver(s, d))),
    "m8_distance_error": query(lambda s, d: quality.distance_error(silver(s, d))),
    "o4_sample_size": query(_sampled),
}

_FLAG_SUMS = " UNION ALL ".join(
    f"SELECT '{f}' AS flag, {count_where(f)} AS count, {percent(count_where(f), 'count(*)', 1)} AS percent FROM flagged"
    for f in quality.FLAGS
)
_COMBOS = {
    "gps_high_night": "is_gps_mismatch AND is_high_value AND is_night_transaction",
    "gps_cross_no_travel": "is_gps_mismatch AND is_cross_state AND NOT had_travel_purchase_last_12m",
    "velocity_gps_high": "is_high_velocity AND is_gps_mismatch AND is_high_value",
}
_COMBO_SUMS = " UNION ALL ".join(
    f"SELECT '{n}' AS combination, {count_where(c)} AS count, {percent(count_where(c), 'count(*)', 2)} AS percent FROM flagged"
    for n, c in _COMBOS.items()
)


def _quality(levels: str) -> str:
    cells = f"""SELECT {count_where(f"risk_level IN ({levels}) AND is_fraud")} AS tp,
        {count_where(f"risk_level IN ({levels}) AND NOT is_fraud")} AS fp,
        {count_where(f"risk_level NOT IN ({levels}) AND is_fraud")} AS fn,
        {count_where(f"risk_level NOT IN ({levels}) AND NOT is_fraud")} AS tn,
        coalesce(CAST(sum(CAST(round(amount * 100) AS BIGINT)) FILTER (WHERE risk_level IN ({levels}) AND is_fraud) AS DOUBLE), 0) / 100 AS protected_value,
        coalesce(CAST(sum(CAST(round(amount * 100) AS BIGINT)) FILTER (WHERE risk_level NOT IN ({levels}) AND is_fraud) AS DOUBLE), 0) / 100 AS lost_value,
        coalesce(CAST(sum(CAST(round(amount * 100) AS BIGINT)) FILTER (WHERE risk_level IN ({levels}) AND NOT is_fraud) AS DOUBLE), 0) / 100 AS wrongly_blocked_value
        FROM gold"""
    return check("gold", f"""SELECT *, {percent("tp", "tp + fn", 2)} AS recall, {percent("tp", "tp + fp", 2)} AS "precision",
        {percent("2 * tp", "2 * tp + fp + fn", 2)} AS f1, {percent("tp + tn", "tp + fp + fn + tn", 2)} AS accuracy
        FROM cells""", cells=cells)


_PLANAR = f"({RAW_GAP}) * 111"
_METRES = f"CAST(round_even(abs({_PLANAR} - {HAVERSINE}) * 1000, 0) AS BIGINT)"

_SPREAD = """SELECT min(g) AS min, quantile_disc(g, 0.25) AS p25, quantile_disc(g, 0.5) AS p50,
    quantile_disc(g, 0.75) AS p75, quantile_disc(g, 0.9) AS p90, quantile_disc(g, 0.95) AS p95,
    quantile_disc(g, 0.99) AS p99, max(g) AS max FROM gaps"""

ORACLE = {
    "m3_spoilt_distances": check("silver", _SPREAD, gaps=f"""SELECT CAST(round_even({GAP} * 1000000, 0) AS DOUBLE) / 1000000 AS g FROM silver
        WHERE coalesce(tx_hour % 6, 0) NOT IN (1, 2, 3)"""),
    "m3_unusable_values": check("silver", f"""SELECT 'distance_gps' AS measure, count({GAP}) FILTER (WHERE coalesce(tx_hour % 6, 0) NOT IN (1, 2, 3))
          + count(*) FILTER (WHERE tx_hour % 6 IN (1, 2, 3)) AS present,
        count(*) FILTER (WHERE tx_hour % 6 IN (1, 2)) AS not_finite, count(*) FILTER (WHERE tx_hour % 6 = 3) AS too_large FROM silver
        UNION ALL SELECT 'large', count(*) FILTER (WHERE tx_hour % 6 < 3), 0, count(*) FILTER (WHERE tx_hour % 6 < 3) FROM silver"""),
    "a15_m3_distances": check("silver", """SELECT min(g) AS min, quantile_disc(g, 0.25) AS p25, quantile_disc(g, 0.5) AS p50,
        quantile_disc(g, 0.75) AS p75, quantile_disc(g, 0.9) AS p90, quantile_disc(g, 0.95) AS p95,
        quantile_disc(g, 0.99) AS p99, max(g) AS max FROM gaps""", gaps=f"SELECT CAST(round_even({GAP} * 1000000, 0) AS DOUBLE) / 1000000 AS g FROM silver"),
    "m1_flag_prevalence": check("silver", _FLAG_SUMS, flagged=GEO_FLAG_SQL + " FROM silver"),
    "m2_flag_combinations": check("silver", _COMBO_SUMS, flagged=GEO_FLAG_SQL + " FROM silver"),
    "m4_row_counts": check("alerts", " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, count(*) AS rows FROM {table}" for layer, table in {
            "raw": "fx_tx", "silver": "first_tx", "detection": "gold", "alerts": "alerts"}.items())),
    "m5_confusion_matrix": check("gold", f"""SELECT risk_level, {count_where("is_fraud")} AS fraud,
        {count_where("NOT is_fraud")} AS legitimate, count(*) AS total FROM gold GROUP BY risk_level"""),
    "m5_detection_quality": _quality("'CRITICAL', 'HIGH'"),
    "m5_detection_quality_medium": _quality("'CRITICAL', 'HIGH', 'MEDIUM'"),
    "m6_freshness": check("gold", f"""SELECT CAST(newest AS VARCHAR) AS newest, {half_up("m", 2)} AS minutes_since,
        {half_up("m", 2)} < 525600 AS healthy FROM (SELECT max(timestamp_dt) AS newest,
        CAST(epoch_us(TIMESTAMP '2001-08-01 00:00:00') - epoch_us(max(timestamp_dt)) AS DOUBLE) / 6e7 AS m FROM gold)"""),
    "m6_events_freshness": f"""SELECT {half_up("m", 2)} AS minutes_since, {half_up("m", 2)} < 10 AS healthy FROM (
        SELECT CAST(epoch_us(TIMESTAMP '{EVENTS_AS_OF}') - epoch_us(max(ts)) AS DOUBLE) / 6e7 AS m FROM events)""",
    "m7_reconciliation": check("first_tx", f"""SELECT rows_in, rows_out,
        {percent("(rows_in - rows_out)", "rows_in", 2)} AS removed_percent FROM (
        SELECT (SELECT count(*) FROM fx_tx) AS rows_in, (SELECT count(*) FROM first_tx) AS rows_out)"""),
    "m8_distance_error": check("silver", f"""SELECT count(*) AS rows,
        {half_up("CAST(sum(m) AS DOUBLE) / (1000.0::DOUBLE * count(m))", 3)} AS mean_error_km,
        {half_up("max(gap)", 3)} AS max_error_km, {half_up("CAST(sum(m) AS DOUBLE) / sum(h)", 4)} AS relative_error FROM (
        SELECT abs({_PLANAR} - {HAVERSINE}) AS gap, {_METRES} AS m,
        CAST(round_even({HAVERSINE} * 1000, 0) AS BIGINT) AS h FROM silver)"""),
    "o4_sample_size": "SELECT least(count(*), 1000) AS sampled, least(count(*), 1000) AS members FROM lineitem",
}
