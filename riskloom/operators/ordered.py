"""Values that need the rows of a key in order, however unevenly rows are spread over keys and times.

A window over a key puts all its rows into one task. Here the whole table is cut into ranges of its order instead, of
about equal size and regardless of keys: a key with a third of all rows, or a single second of it, spans many cuts.
Each cut is worked on by itself, and what a cut needs from those before it is carried over through a table with one
row per cut. The cuts are written down once, because a second dealing out could cut elsewhere. Give narrow rows, but to
``previous_along``, whose cuts are an expression: there only keys with a large share of the rows (``large_keys``) are cut, and
the rows of all others stay together by key.
"""

import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.session import work_folder


def in_cuts(df: DataFrame, place: str, cuts: int | None = None) -> DataFrame:
    """``df`` with the number ``_cut`` of the range of ``place`` that a row lies in; later cuts have larger places.

    ``cuts`` fixes their number; else it is the session's number of shuffle partitions, less where these are small.
    """
    dealt = df.repartitionByRange(cuts, place) if cuts else df.repartitionByRange(place)
    return _written(dealt.withColumn("_cut", F.spark_partition_id()))


def _written(df: DataFrame) -> DataFrame:
    path = f"{work_folder(df.sparkSession)}/riskloom-cuts-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that are looked at for each cut to find where it begins, and which keys need cuts.
LOOKED_AT = 32
#: A key that has more than this share of a cut's rows is cut into ranges; the rows of all others stay together by key.
SHARE = 4
#: Numbers into which keys whose rows stay together are dealt, for each cut, so that cuts come out even.
SPREAD = 16


def _cuts(df: DataFrame, cuts: int | None) -> int:
    return cuts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _drawn(df: DataFrame, place: Column, cuts: int) -> list:
    """Places of some rows, in order. What is drawn decides how even the work is and nothing else."""
    return [row.p for row in df.select(place.alias("p")).orderBy(F.rand(7)).limit(LOOKED_AT * cuts).orderBy("p").collect()]


def _large(keys: list, cuts: int) -> list:
    """Keys that are many among those drawn: fewer than ``SHARE`` for each cut, however many keys there are."""
    return [k for k, n in Counter(keys).items() if n >= LOOKED_AT // SHARE and n * SHARE * cuts > len(keys)]


def large_keys(df: DataFrame, key: str, cuts: int | None = None) -> list:
    """Keys whose rows are too many for one task beside others. One pass over the key finds them, from rows drawn at random; one
    that is missed or found too often costs time and changes no result."""
    n = _cuts(df, cuts)
    return _large(_drawn(df, F.col(key), n), n)


def among(key: Column, keys: list) -> Column:
    """Whether a key, which may be null, is one of ``keys``; never null."""
    known = [k for k in keys if k is not None]
    return F.when(key.isNull(), F.lit(None in keys)).otherwise(key.isin(known) if known else F.lit(False))


def _range(kind: StructType, begins: list, place: Column) -> Column:
    """How many of ``begins``, which are in order, are at or before the place: a binary search."""
    most, step, steps = len(begins), 1, []
    while step <= most:
        steps.insert(0, step)
        step *= 2
    if not steps:
        return F.lit(0)
    values = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(at, kind.fields, strict=True)]) for at in begins])
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, more: F.when(
        (low + more <= most) & (F.element_at(values, F.least(low + more, F.lit(most))) <= place), low + more).otherwise(low))


def dealt(df: DataFrame, key: str, place: str, cuts: int | None = None) -> tuple[Column, int | None]:
    """The number of the cut that a row lies in, as an expression, and the number from which on cuts are ranges of ``place`` (a
    struct with ``key`` in it), None if there are no such. Rows of a key lie in one cut, by a hash; only keys with a large share of
    all rows are cut into ranges, of about equal size. Both are fixed when this is called; nothing is written or moved."""
    n = _cuts(df, cuts)
    found = _drawn(df, F.col(place), n)
    field = key.removeprefix(f"{place}.")
    large = _large([row[field] for row in found], n)
    together = F.pmod(F.xxhash64(key), F.lit(SPREAD * n)).cast("int")
    if not large:
        return together, None
    inside, names = [row for row in found if row[field] in set(large)], SPREAD * n
    parts = -(-len(inside) // LOOKED_AT)
    begins = list(dict.fromkeys(inside[k * len(inside) // parts] for k in range(1, parts)))
    ranges = F.lit(names) + _range(df.schema[place].dataType, begins, F.col(place))
    return F.when(among(F.col(key), large), ranges).otherwise(together), names


def previous_along(df: DataFrame, key: str, place: str, row: str, cuts: int | None = None) -> DataFrame:
    """As ``previous``, for full rows: they are shuffled once, with those of their columns that are read later on, where narrow
    rows would be shuffled twice, written, and joined to them. Only keys with a large share of the rows are cut; for these one row
    per cut is written when this is called. With ``cuts`` there are as many tasks, whatever the session's number of partitions:
    give as many as the size of the rows asks for."""
    number, ranges = dealt(df, key, place, cuts)
    cut = df.withColumn("_cut", number)
    held = F.struct(F.col(key).alias("k"), F.col(row).alias("r"))
    inside = Window.partitionBy("_cut").orderBy(place)
    found = (cut.repartition(cuts, "_cut") if cuts else cut).withColumn("_before", F.lag(held).over(inside))
    if ranges is not None:
        last = cut.where(F.col("_cut") >= ranges).groupBy("_cut").agg(F.max_by(held, place).alias("_last"))
        # one row per cut, so this window, what is written and the broadcast are as small as the number of cuts
        carried = _written(last.select("_cut", F.lag("_last").over(Window.orderBy("_cut")).alias("_carried")))
        found = found.join(F.broadcast(carried), "_cut", "left").withColumn("_before", F.coalesce("_before", "_carried")).drop("_carried")
    before = F.col("_before")
    return found.withColumn("_before", F.when(before["k"].eqNullSafe(F.col(key)), before["r"])).drop("_cut")


def previous(df: DataFrame, key: str, place: str, row: str, cuts: int | None = None) -> DataFrame:
    """Add ``_before``: ``row`` of the row before in the order of ``place``, if it has the same ``key``."""
    cut = in_cuts(df, place, cuts)
    held = F.struct(F.col(key).alias("k"), F.col(row).alias("r"))
    inside = Window.partitionBy("_cut").orderBy(place)
    last = cut.groupBy("_cut").agg(F.max_by(held, place).alias("_last"))
    # one row per cut, so this window and the broadcast are as small as the number of cuts
    carried = last.select("_cut", F.lag("_last").over(Window.orderBy("_cut")).alias("_carried"))
    found = cut.withColumn("_held", F.lag(held).over(inside)).join(F.broadcast(carried), "_cut")
    before = F.coalesce("_held", "_carried")
    return found.withColumn("_before", F.when(before["k"].eqNullSafe(F.col(key)), before["r"])).drop("_held", "_carried", "_cut")


def running_sums(df: DataFrame, key: str, place: str, sums: list[str], cuts: int | None = None) -> DataFrame:
    """Add ``<name>_upto`` for each of ``sums``: the sum over the key's rows up to and with this one."""
    cut = in_cuts(df, place, cuts).withColumn("_key", F.struct(F.col(key).alias("k")))
    inside = Window.partitionBy("_cut", "_key").orderBy(place)
    # only the last key of a cut can go on in the next one; its totals add up while it does
    last = cut.groupBy("_cut").agg(F.max_by("_key", place).alias("_key"))
    totals = cut.join(F.broadcast(last), ["_cut", "_key"]).groupBy("_cut", "_key").agg(*[F.sum(c).alias(c) for c in sums])
    so_far = Window.partitionBy("_key").orderBy("_cut")
    summed = totals.select("_cut", F.struct("_key", *[F.sum(c).over(so_far).alias(c) for c in sums]).alias("_total"))
    carried = summed.select("_cut", F.lag("_total").over(Window.orderBy("_cut")).alias("_carried"))
    found = cut.withColumns({f"{c}_upto": F.sum(c).over(inside) for c in sums}).join(F.broadcast(carried), "_cut")
    goes_on = F.col("_carried._key").eqNullSafe(F.col("_key"))
    added = {f"{c}_upto": F.col(f"{c}_upto") + F.when(goes_on, F.col(f"_carried.{c}")).otherwise(F.lit(0)) for c in sums}
    return found.withColumns(added).drop("_carried", "_cut", "_key")


def scan(df: DataFrame, key: str, place: str, sums: list[str], lasts: list[str], cuts: int | None = None) -> DataFrame:
    """Several features in one pass over one cut table: add ``<name>_upto`` for each of ``sums``, the sum over the key's
    rows up to and with this one, and ``<name>_before`` for each of ``lasts``, the value of the latest earlier row of the
    key that has one.

    What is carried from cut to cut is a state that merges: sums add up, and of two last values the later holds. Null
    stands for no value, so give values that may be null inside a struct.
    """
    cut = in_cuts(df, place, cuts).withColumn("_key", F.struct(F.col(key).alias("k")))
    inside = Window.partitionBy("_cut", "_key").orderBy(place)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    # only the last key of a cut can go on in the next one
    last = cut.groupBy("_cut").agg(F.max_by("_key", place).alias("_key"))
    state = [F.sum(c).alias(c) for c in sums] + [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(place))).alias(c) for c in lasts]
    states = cut.join(F.broadcast(last), ["_cut", "_key"]).groupBy("_cut", "_key").agg(*state)
    so_far = Window.partitionBy("_key").orderBy("_cut")
    merged = [F.sum(c).over(so_far).alias(c) for c in sums] + [F.last(c, True).over(so_far).alias(c) for c in lasts]
    carried = states.select("_cut", F.struct("_key", *merged).alias("_state")).select(
        "_cut", F.lag("_state").over(Window.orderBy("_cut")).alias("_carried"))
    found = cut.withColumns(
        {f"{c}_upto": F.sum(c).over(inside) for c in sums} | {f"{c}_before": F.last(c, True).over(earlier) for c in lasts}
    ).join(F.broadcast(carried), "_cut")
    goes_on = F.col("_carried._key").eqNullSafe(F.col("_key"))
    added = {f"{c}_upto": F.col(f"{c}_upto") + F.when(goes_on, F.col(f"_carried.{c}")).otherwise(F.lit(0)) for c in sums}
    added |= {f"{c}_before": F.coalesce(f"{c}_before", F.when(goes_on, F.col(f"_carried.{c}"))) for c in lasts}
    return found.withColumns(added).drop("_carried", "_cut", "_key")
