"""Features from a customer's earlier transactions.

They need a customer's rows in order. The order is found on narrow rows that are cut evenly wherever a customer, an
hour or a second is large (see ``ordered``), and the result is joined to the full rows, which are read once.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import flags, geo
from riskloom.functions.measures import cents
from riskloom.operators import ordered

DAY = 86_400
PREVIOUS = ["epoch", "purchase_latitude", "purchase_longitude", "purchase_state"]


def with_epoch(df: DataFrame, time: str = "timestamp_dt", unit: str = "timestamp") -> DataFrame:
    """Event time as whole seconds. ``unit`` names how ``time`` is stored; it is never guessed."""
    stored = F.col(time)
    ways = {
        "timestamp": lambda: F.unix_seconds(stored.cast("timestamp")),
        "seconds": lambda: stored.cast("long"),
        "milliseconds": lambda: F.floor(stored / 1000).cast("long"),
    }
    return df.withColumn("epoch", ways[unit]())


# --- previous transaction ---------------------------------------------------------------------------


def previous_values(
    df: DataFrame, columns: list[str], key: str = "customer_id", order: list[str] | None = None,
    cuts: int | None = None, along: bool = False,
) -> DataFrame:
    """Add ``_prev``: the given columns of the row before, per key in the given order. Rows must be unique in key and
    order; null is a value like any other, and comes first. ``along`` deals the full rows out, which costs less than a join where
    few of their columns are read later on (``ordered.previous_along``)."""
    order = order or ["epoch", "transaction_id"]
    if along:
        held = [key, *order]
        # what the place holds goes along once
        placed = df.withColumns({"_place": F.struct(*held), "_row": F.struct(*columns)}).drop(*held)
        found = ordered.previous_along(placed, f"_place.{key}", "_place", "_row", cuts)
        return found.select(*[F.col(f"_place.{c}") if c in held else F.col(c) for c in df.columns], F.col("_before").alias("_prev"))
    place = F.struct(key, *order)
    narrow = df.select(place.alias("_place"), F.struct(*columns).alias("_row"))
    earlier = ordered.previous(narrow, f"_place.{key}", "_place", "_row", cuts).select("_place", F.col("_before").alias("_prev"))
    return df.withColumn("_place", place).join(earlier, "_place").drop("_place")


def _group(key: str) -> Column:
    """The key as a one-field struct: null is then a value that equals itself, and windows, aggregates
    and joins on it share one partitioning, where a null-safe join on the bare key would shuffle again."""
    return F.struct(key)


def movement(df: DataFrame, distance=geo.planar_km, **options) -> DataFrame:
    """Time, distance and speed since the customer's previous transaction, and the two flags on them.

    ``df`` needs ``epoch``, the purchase place and ``transaction_id``, unique per customer and second.
    """
    names = ["prev_timestamp", "prev_latitude", "prev_longitude", "prev_state"]
    earlier = previous_values(df, PREVIOUS, **options)
    return moved(earlier.withColumns({n: F.col("_prev")[c] for n, c in zip(names, PREVIOUS, strict=True)}).drop("_prev"), distance)


def moved(df: DataFrame, distance=geo.planar_km) -> DataFrame:
    """Time, distance and speed, and the two flags on them, from the columns of the previous transaction."""
    km = distance(F.col("purchase_latitude"), F.col("purchase_longitude"), F.col("prev_latitude"), F.col("prev_longitude"))
    features = df.withColumns({"time_since_last_tx": (F.col("epoch") - F.col("prev_timestamp")) / 60, "distance_km_from_prev": km})
    speed = F.col("distance_km_from_prev") / (F.col("time_since_last_tx") / 60)
    return features.withColumn(
        "velocity_kmh", F.when(F.col("time_since_last_tx") > 0, speed)
    ).withColumns({
        "is_cloning_suspect": flags.cloning_suspect(),
        "is_impossible_velocity": flags.impossible_velocity(),
    })


# --- rolling sums -----------------------------------------------------------------------------------


def _together(df: DataFrame, key: str, cuts: int | None, light: Callable[[DataFrame], DataFrame], large: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``light`` on the rows of most customers, dealt out by customer, ``large`` on those of customers with a large share of
    all rows. With ``cuts`` there are as many tasks for the first, whatever the session's number of partitions."""
    found = ordered.large_keys(df, key, cuts)
    many = ordered.among(F.col(key), found)
    rows = df.where(~many) if found else df
    done = light(rows.repartition(cuts, key) if cuts else rows)
    return done.unionByName(large(df.where(many))) if found else done


def _span(key: str, seconds: int, include_now: bool) -> Callable[[str], Column]:
    """The sum of a column over the ``seconds`` before a row, from two running sums: neither frame has a begin, so a row is added
    once to each. Rows without a time have no span; give them zero, they come first and are in both."""
    rows = Window.partitionBy(key).orderBy("epoch")

    def total(column: str) -> Column:
        entered, left = (F.sum(column).over(rows.rangeBetween(Window.unboundedPreceding, upto)) for upto in (0 if include_now else -1, -seconds - 1))
        nothing = F.lit(0).cast("long")
        return F.when(F.col("epoch").isNull(), nothing).otherwise(F.coalesce(entered, nothing) - F.coalesce(left, nothing))

    return total


def rolling(
    df: DataFrame, seconds: int, include_now: bool, prefix: str, amount: str = "amount",
    key: str = "customer_id", cuts: int | None = None, along: bool = False,
) -> DataFrame:
    """Add ``<prefix>_count``, ``<prefix>_amounts`` and ``<prefix>_sum`` over the ``seconds`` before each row.

    The span reaches from ``seconds`` earlier, inclusive, to the row's own second when ``include_now``
    is set and to the second before it otherwise. ``_count`` counts rows, ``_amounts`` rows with an
    amount. Rows without a time count nothing and are counted nowhere.

    A sliding frame would add up its rows anew for every row. Instead the rows of a second are added up first, and
    every second comes back ``seconds`` later as what then leaves the span: the result is what has entered less what
    has left, two running sums over seconds. The sums are of whole numbers, so the difference is exact.

    ``along`` deals the full rows out by customer, with those of their columns that are read later on, and does this for
    customers with a large share of all rows only (``_together``).
    """
    whole, nothing = cents(amount), F.lit(0).cast("long")
    measures = {"n": F.lit(1).cast("long"), "a": whole.isNotNull().cast("long"), "c": F.coalesce(whole, nothing)}
    if along:
        def together(rows: DataFrame) -> DataFrame:
            span = _span(key, seconds, include_now)
            return rows.withColumns({f"_{n}": F.when(F.col("epoch").isNotNull(), v).otherwise(nothing) for n, v in measures.items()}).withColumns({
                f"{prefix}_count": span("_n"), f"{prefix}_amounts": span("_a"), f"{prefix}_sum": F.when(span("_a") > 0, span("_c") / F.lit(100.0)),
            }).drop(*[f"_{n}" for n in measures])

        return _together(df, key, cuts, together, lambda rows: rolling(rows, seconds, include_now, prefix, amount, key, cuts))
    timed = df.where(F.col("epoch").isNotNull()).select(key, "epoch", *[v.alias(f"_{n}") for n, v in measures.items()])

    def event(at: Column, way: str) -> Column:
        values = [(F.col(f"_{n}") if way == w else nothing).alias(f"_{w}_{n}") for w in ("in", "out") for n in measures]
        return F.struct(at.alias("_at"), *values)

    both = timed.select(key, F.explode(F.array(
        event(F.col("epoch"), "in"), event(F.col("epoch") + seconds, "out"))).alias("_e"))
    sums = [f"_{way}_{n}" for way in ("in", "out") for n in measures]
    per_second = both.groupBy(F.struct(key, F.col("_e._at").alias("epoch")).alias("_place")).agg(
        *[F.sum(f"_e.{c}").alias(c) for c in sums])
    running = ordered.running_sums(per_second, f"_place.{key}", "_place", sums, cuts)

    def value(n: str) -> Column:
        entered = F.col(f"_in_{n}_upto") if include_now else F.col(f"_in_{n}_upto") - F.col(f"_in_{n}")
        return (entered - (F.col(f"_out_{n}_upto") - F.col(f"_out_{n}"))).alias(f"_{n}")

    spans = running.where("_in_n > 0").select("_place", *map(value, measures))
    joined = df.withColumn("_place", F.struct(key, "epoch")).join(spans, "_place", "left").withColumns({
        f"_{n}": F.coalesce(f"_{n}", nothing) for n in measures})
    return joined.withColumns({
        f"{prefix}_count": F.col("_n"),
        f"{prefix}_amounts": F.col("_a"),
        f"{prefix}_sum": F.when(F.col("_a") > 0, F.col("_c") / F.lit(100.0)),
    }).drop("_place", *[f"_{n}" for n in measures])


def last_day(df: DataFrame, **options) -> DataFrame:
    """Transactions and amount of the customer over the last 24 hours, the row's own included."""
    rolled = rolling(df, DAY, True, "_day", **options)
    return rolled.withColumnsRenamed(
        {"_day_count": "transactions_last_24h", "_day_sum": "accumulated_amount_24h"}
    ).drop("_day_amounts")


def month_average(df: DataFrame, **options) -> DataFrame:
    """Average amount of the customer over the 30 days before the row's own second."""
    rolled = rolling(df, 30 * DAY, False, "_month", **options)
    average = F.round(F.try_divide(F.col("_month_sum"), F.col("_month_amounts")), 2)
    return rolled.withColumn("avg_transaction_amount_30d", average).drop(
        "_month_count", "_month_amounts", "_month_sum"
    )


def histories(
    df: DataFrame, distance=geo.planar_km, amount: str = "amount", key: str = "customer_id", cuts: int | None = None,
    along: bool = False,
) -> DataFrame:
    """What ``movement``, ``last_day`` and ``month_average`` add, from one pass in order and one join with the full rows.

    One cut table holds the rows, and per second and customer a line with what enters and leaves the two spans there:
    an amount enters the day at its own second and leaves it a second after 24 hours; it enters the month one second
    later, so that a row's own second is not in it. These lines come before the rows of their second, so running sums
    over them are a row's values at its place, and rows are joined by that place, which is theirs alone.
    ``transaction_id`` must be unique per customer and second. Rows without a time come first and count nowhere. The cut
    table is written when this is called.

    ``along`` deals the full rows out by customer, with those of their columns that are read later on, and does this for
    customers with a large share of all rows only (``_together``): there is no join and no cut table for the others.
    """
    whole, nothing = cents(amount), F.lit(0).cast("long")
    measures = {"n": F.lit(1).cast("long"), "a": whole.isNotNull().cast("long"), "c": F.coalesce(whole, nothing)}
    month = 30 * DAY
    if along:
        return _together(df, key, cuts, lambda rows: _histories_together(rows, distance, measures, key),
                         lambda rows: histories(rows, distance, amount, key, cuts))
    #: name of a sum: how many seconds after the row it counts, and its sign
    ways = {"day": [(0, 1), (DAY + 1, -1)], "month": [(1, 1), (month + 1, -1)]}
    names = [f"_{span}_{n}" for span in ways for n in measures if (span, n) != ("month", "n")]
    timed = df.where(F.col("epoch").isNotNull()).select(key, "epoch", *[v.alias(f"_{n}") for n, v in measures.items()])
    changes = [(delay, span, sign) for span, steps in ways.items() for delay, sign in steps]

    def change(delay: int, span: str, sign: int) -> Column:
        values = [(F.col(f"_{c.split('_')[-1]}") * sign if c.startswith(f"_{span}_") else nothing).alias(c) for c in names]
        return F.struct((F.col("epoch") + delay).alias("at"), *values)

    lines = timed.select(key, F.explode(F.array(*[change(*c) for c in changes])).alias("e")).groupBy(key, F.col("e.at").alias("epoch")).agg(
        *[F.sum(f"e.{c}").alias(c) for c in names])

    def placed(rows: DataFrame, transaction: Column, row: Column, sums: list[Column]) -> DataFrame:
        place = F.struct(F.col(key).alias("key"), F.col("epoch").alias("epoch"), transaction.isNotNull().alias("is_row"), transaction.alias("id"))
        return rows.select(place.alias("_place"), row.alias("_row"), *sums)

    kind = dict(df.dtypes)
    previous = F.struct(*PREVIOUS)
    shape = "struct<" + ",".join(f"{c}:{kind[c]}" for c in PREVIOUS) + ">"
    own = F.struct(F.col("transaction_id").alias("id"))
    none = F.lit(None).cast(f"struct<id:{kind['transaction_id']}>")
    narrow = placed(df, own, previous, [nothing.alias(c) for c in names]).unionByName(
        placed(lines, none, F.lit(None).cast(shape), [F.col(c) for c in names]))
    found = ordered.scan(narrow, "_place.key", "_place", names, ["_row"], cuts).where("_place.is_row").select(
        "_place", F.col("_row_before").alias("_prev"), *[F.col(f"{c}_upto").alias(c) for c in names])
    place = F.struct(F.col(key).alias("key"), F.col("epoch").alias("epoch"), F.lit(True).alias("is_row"), own.alias("id"))
    joined = df.withColumn("_place", place).join(found, "_place").drop("_place")
    return _with_histories(joined, distance).drop("_prev", *names)


def _histories_together(rows: DataFrame, distance, measures: dict[str, Column], key: str) -> DataFrame:
    """``histories`` for customers whose rows fit a task beside others: windows over the rows themselves."""
    counted = rows.withColumns({f"_{n}": F.when(F.col("epoch").isNotNull(), v).otherwise(F.lit(0).cast("long")) for n, v in measures.items()})
    day, month = _span(key, DAY, True), _span(key, 30 * DAY, False)
    found = counted.withColumns({
        "_prev": F.lag(F.struct(*PREVIOUS)).over(Window.partitionBy(key).orderBy("epoch", "transaction_id")),
        "_day_n": day("_n"), "_day_a": day("_a"), "_day_c": day("_c"), "_month_a": month("_a"), "_month_c": month("_c")})
    return _with_histories(found, distance).drop("_prev", "_day_n", "_day_a", "_day_c", "_month_a", "_month_c", *[f"_{n}" for n in measures])


def _with_histories(found: DataFrame, distance) -> DataFrame:
    average = F.round(F.try_divide(F.col("_month_c") / F.lit(100.0), F.col("_month_a")), 2)
    prior = ["prev_timestamp", "prev_latitude", "prev_longitude", "prev_state"]
    return moved(found.withColumns({
        "transactions_last_24h": F.col("_day_n"),
        "accumulated_amount_24h": F.when(F.col("_day_a") > 0, F.col("_day_c") / F.lit(100.0)),
        "avg_transaction_amount_30d": F.when(F.col("_month_a") > 0, average),
        **{n: F.col("_prev")[c] for n, c in zip(prior, PREVIOUS, strict=True)},
    }), distance)


#: Feed fields that ``histories`` can compute, and where it puts them.
COMPUTED = {
    "transactions_last_24h": ("transactions_last_24h", None), "accumulated_amount_24h": ("accumulated_amount_24h", None),
    "avg_transaction_amount_30d": ("avg_transaction_amount_30d", None),
    "distance_from_last_txn_km": ("distance_km_from_prev", 3), "time_since_last_txn_min": ("time_since_last_tx", 4),
}


def with_computed(df: DataFrame, fields: list[str], time: str = "timestamp_dt", **options) -> DataFrame:
    """``df`` with the given fields of ``COMPUTED`` from its own history in place of those that came with the feed, for
    feeds that lack them. Distances are great-circle ones."""
    timed = df if "epoch" in df.columns else with_epoch(df, time)
    found = histories(timed.drop(*[c for c in COMPUTED if c in fields]), geo.haversine_km, **options)
    values = {}
    for name in fields:
        source, digits = COMPUTED[name]
        values[name] = F.col(source) if digits is None else F.round(source, digits)
    return found.withColumns(values).select(*df.columns, *[c for c in fields if c not in df.columns])


def first_use(df: DataFrame, value: str, name: str, key: str = "customer_id") -> DataFrame:
    """Flag the customer's first transaction with a value (beneficiary, state); false where it is null.

    The first transaction of each pair comes from an aggregate, which is combined before the shuffle,
    and is joined back; a pair holding very many rows is then split by adaptive execution.
    """
    order = ["epoch", "transaction_id"]
    keyed = df.withColumns({"_key": _group(key), "_value": F.col(value)})
    first = keyed.where(F.col(value).isNotNull()).groupBy("_key", "_value").agg(F.min(F.struct(*order)).alias("_first"))
    return keyed.join(first, ["_key", "_value"], "left").withColumn(
        name, flags.flag(F.struct(*order) == F.col("_first"))
    ).drop("_key", "_value", "_first")
