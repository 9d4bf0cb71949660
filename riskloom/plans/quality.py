"""Profiles of the data and of the detection, each in a single pass."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom import schemas
from riskloom.functions.measures import cents, finite, fraction, percent, rows, rows_where
from riskloom.operators import enrich

# Fixed values
FLAGS = [
    "is_cross_state", "is_night_transaction", "is_high_value", "is_high_velocity", "is_gps_mismatch",
    "is_first_purchase_in_state", "is_international", "had_travel_purchase_last_12m",
]
COMBINATIONS = {
    "gps_high_night": ["is_gps_mismatch", "is_high_value", "is_night_transaction"],
    "gps_cross_no_travel": ["is_gps_mismatch", "is_cross_state", "!had_travel_purchase_last_12m"],
    "velocity_gps_high": ["is_high_velocity", "is_gps_mismatch", "is_high_value"],
}
PERCENTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def _shares(df: DataFrame, conditions: dict[str, Column], name: str, digits: int) -> DataFrame:
    """Count and percent of rows per condition, one row each, from one aggregate."""
    counted = df.agg(rows().alias("_total"), *[rows_where(c).alias(n) for n, c in conditions.items()])
    return counted.unpivot("_total", list(conditions), name, "count").select(
        name, "count", percent(F.col("count"), F.col("_total"), digits).alias("percent")
    )


def flag_prevalence(df: DataFrame, flags: list[str] = FLAGS) -> DataFrame:
    return _shares(df, {f: F.col(f) for f in flags}, "flag", 1)


def flag_combinations(df: DataFrame, combinations: dict[str, list[str]] = COMBINATIONS) -> DataFrame:
    def holds(flag: str) -> Column:
        return ~F.col(flag[1:]) if flag.startswith("!") else F.col(flag)

    conditions = {n: reduce(Column.__and__, map(holds, fs)) for n, fs in combinations.items()}
    return _shares(df, conditions, "combination", 2)


def _whole(value: Column, unit: Column | float) -> Column:
    """The value in whole parts of ``1 / unit``; null where it is none that a long can hold."""
    return F.rint(finite(value) * unit).try_cast("long")


def unusable(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """(measure, present, not_finite, too_large): what a distribution of each measure counts, and what it leaves out."""
    unit = F.lit(10.0**digits)
    found = F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in columns])).alias("m")
    return df.select(found).select("m.*").groupBy("measure").agg(
        rows_where(F.col("value").isNotNull()).alias("present"),
        rows_where(F.col("value").isNotNull() & finite("value").isNull()).alias("not_finite"),
        rows_where(finite("value").isNotNull() & _whole(F.col("value"), unit).isNull()).alias("too_large"))


def distance_distribution(df: DataFrame, column: str = "distance_gps", digits: int = 6) -> DataFrame:
    """Minimum, percentiles and maximum of a measure rounded to ``digits``, exact at any size. Values that are NaN,
    infinite or too large for a long at that precision are left out; ``unusable`` counts them.

    Values are counted first, which tasks combine before the shuffle; the percentile of a share p is the least value
    whose running count reaches ``ceil(p * n)``. Running counts are added up by ranges of values, so that no task sees
    all of them: within a range row by row, over the ranges from one total each.
    """
    unit = F.lit(10.0**digits)
    counts = df.select(_whole(F.col(column), unit).alias("_v")).where(F.col("_v").isNotNull()).groupBy("_v").agg(rows().alias("_n"))
    ranged = counts.withColumn("_range", F.floor(F.col("_v") / F.lit(10**digits)))
    totals = ranged.groupBy("_range").agg(F.sum("_n").alias("_t"))
    before = totals.select("_range", (F.sum("_t").over(Window.orderBy("_range")) - F.col("_t")).alias("_before"))
    running = F.sum("_n").over(Window.partitionBy("_range").orderBy("_v")) + F.col("_before")
    ranked = ranged.join(before, "_range").withColumn("_upto", running)
    size = counts.agg(F.sum("_n").alias("_total"))
    least = [
        F.min(F.when(F.col("_upto") >= F.ceil(F.lit(share) * F.col("_total")), F.col("_v"))).alias(name)
        for name, share in PERCENTILES.items()
    ]
    found = ranked.join(F.broadcast(size)).agg(F.min("_v").alias("min"), *least, F.max("_v").alias("max"))
    return found.select(*[(F.col(c) / unit).alias(c) for c in ("min", *PERCENTILES, "max")])


def schema_report(layers: dict[str, DataFrame], contracts: dict[str, StructType]) -> dict[str, list]:
    """Fields of each layer that are missing or of another type than its contract says."""
    return {name: schemas.schema_gaps(df, contracts[name]) for name, df in layers.items()}


def row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer."""
    counted = [df.agg(rows().alias("rows")).select(F.lit(name).alias("layer"), "rows") for name, df in layers.items()]
    return reduce(DataFrame.unionAll, counted)


def confusion_matrix(tx: DataFrame) -> DataFrame:
    """Frauds and legitimate transactions per level; unlabelled rows are in neither column."""
    return tx.groupBy("risk_level").agg(
        rows_where(F.col("is_fraud")).alias("fraud"), rows_where(~F.col("is_fraud")).alias("legitimate"),
        rows().alias("total"),
    )


def detection_quality(tx: DataFrame, positives: tuple[str, ...] = ("CRITICAL", "HIGH")) -> DataFrame:
    """Recall, precision, F1 and accuracy in percent over labelled rows, and the money protected (found
    frauds), lost (missed frauds) and blocked wrongly. ``positives`` names the alarming levels."""
    alarm, fraud = F.col("risk_level").isin(*positives), F.col("is_fraud")
    amount_cents = cents("amount")

    def money(condition: Column) -> Column:
        return F.coalesce(F.try_sum(F.when(condition, amount_cents)), F.lit(0)) / F.lit(100.0)

    cells = {"tp": alarm & fraud, "fp": alarm & ~fraud, "fn": ~alarm & fraud, "tn": ~alarm & ~fraud}
    counted = tx.agg(
        *[rows_where(c).alias(n) for n, c in cells.items()],
        money(cells["tp"]).alias("protected_value"), money(cells["fn"]).alias("lost_value"),
        money(cells["fp"]).alias("wrongly_blocked_value"),
    )
    tp, fp, fn, tn = (F.col(n) for n in cells)
    return counted.withColumns({
        "recall": percent(tp, tp + fn, 2),
        "precision": percent(tp, tp + fp, 2),
        "f1": percent(2 * tp, 2 * tp + fp + fn, 2),
        "accuracy": percent(tp + tn, tp + fp + fn + tn, 2),
    })


def freshness(df: DataFrame, as_of: Column, time: str = "event_time", limit_minutes: int = 10) -> DataFrame:
    """Minutes since the newest event, and whether that is less than the limit."""
    newest = df.agg(F.max(time).alias("newest"))
    minutes = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 6e7
    return newest.select("newest", F.round(minutes, 2).alias("minutes_since")).withColumn(
        "healthy", F.col("minutes_since") < limit_minutes
    )


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, rows out, and the percentage removed."""
    tagged = before.agg(rows().alias("n")).select(F.col("n").alias("rows_in"), F.lit(0).alias("rows_out"))
    kept = after.agg(rows().alias("n")).select(F.lit(0).alias("rows_in"), F.col("n").alias("rows_out"))
    both = tagged.unionByName(kept).agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
    return both.withColumn(
        "removed_percent", percent(F.col("rows_in") - F.col("rows_out"), F.col("rows_in"), 2)
    )


def distance_error(df: DataFrame) -> DataFrame:
    """How far the planar distance lies from the haversine one, in kilometres and relative. Pairs of places of which
    a distance is not finite are left out."""
    distances = df.select(*[finite(d).alias(n) for n, d in enrich.distance_methods().items()])
    both = distances.select("haversine_km", F.when(F.col("haversine_km").isNotNull(), F.col("planar_km")).alias("planar_km"))
    gap = F.abs(F.col("planar_km") - F.col("haversine_km"))
    # Summed as whole metres, so that the order of rows does not matter.
    metres = _whole(gap, 1000)
    return both.agg(
        F.count("planar_km").alias("rows"),
        F.round(F.try_divide(F.sum(metres).cast("double"), 1000.0 * F.count(metres)), 3).alias("mean_error_km"),
        F.round(F.max(gap), 3).alias("max_error_km"),
        fraction(F.sum(metres).cast("double"),
                 F.sum(_whole(F.col("haversine_km"), 1000)), 4).alias("relative_error"),
    )


def table_digest(df: DataFrame, sets: dict[str, list[str]] | None = None) -> DataFrame:
    """(columns, rows, first, second): for each set of columns a digest that does not depend on the order of rows or
    on how they are spread, and counts repeated rows as often as they occur: the sums of two 64-bit hashes of every row.

    By default one set of all columns and one of each, so that two digests tell which columns differ. Columns go by
    name, nulls are part of what is hashed, maps are hashed as text. One pass, combined before the only shuffle.
    """
    names = sorted(df.columns)
    sets = sets or {"*": names} | {n: [n] for n in names}
    maps = {n for n, kind in df.dtypes if "map<" in kind}

    def hashed(columns: list[str], seed: int) -> Column:
        values = [F.to_json(F.struct(c)) if c in maps else F.col(f"`{c}`") for c in columns]
        return F.xxhash64(F.lit(seed), *values, *[F.col(f"`{c}`").isNull() for c in columns]).cast("decimal(38,0)")

    sums = [F.sum(hashed(columns, seed)).alias(f"_{k}_{seed}") for k, columns in enumerate(sets.values()) for seed in (1, 2)]
    one = df.agg(rows().alias("rows"), *sums)
    found = F.array(*[
        F.struct(F.lit(name).alias("columns"), F.col("rows"), F.col(f"_{k}_1").alias("first"), F.col(f"_{k}_2").alias("second"))
        for k, name in enumerate(sets)])
    return one.select(F.explode(found).alias("d")).select("d.*")


def compare_tables(left: DataFrame, right: DataFrame, sets: dict[str, list[str]] | None = None) -> DataFrame:
    """(columns, rows_left, rows_right, same) for each set of columns; a column that one table lacks is not the same."""
    a, b = (table_digest(df, sets).select("columns", F.col("rows").alias(f"rows_{side}"), F.struct("rows", "first", "second").alias(side))
            for df, side in ((left, "left"), (right, "right")))
    # as many rows as sets of columns on either side
    return a.join(b, "columns", "full").select("columns", "rows_left", "rows_right", F.coalesce(F.col("left").eqNullSafe(F.col("right")), F.lit(False)).alias("same"))


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Some ``n`` rows for a trial; which ones is not defined."""
    return df.limit(n)
