"""Profiles that must survive bad values, and digests of tables."""

import pytest
from pyspark.sql import functions as F

from riskloom.plans import quality

BAD = [float("nan"), float("inf"), float("-inf"), 1e300, -1e300, None]


def test_bad_distances_are_left_out_and_counted(spark):
    good = [0.25, 0.5, -3.0, 7.125, 7.125]
    df = spark.createDataFrame([(v,) for v in good + BAD], "distance_gps double")
    (row,) = quality.distance_distribution(df).collect()
    assert (row.min, row.p25, row.p50, row["max"]) == (-3.0, 0.25, 0.5, 7.125)
    (left,) = quality.unusable(df, ["distance_gps"]).collect()
    assert tuple(left) == ("distance_gps", len(good) + 5, 3, 2)
    assert quality.distance_distribution(df.where("false")).collect()[0].min is None


def test_bad_places_do_not_end_the_distance_report(spark):
    places = [(0.0, 0.0, 0.0, 1.0)] + [(0.0, b, 0.0, 1.0) for b in BAD]
    names = ["purchase_latitude", "purchase_longitude", "device_latitude", "device_longitude"]
    schema = ", ".join(f"{n} double" for n in names)
    (all_,), (one,) = (quality.distance_error(spark.createDataFrame(p, schema)).collect() for p in (places, places[:1]))
    assert all_.mean_error_km is not None and one.rows == 1 and all_.rows >= 1


ROWS = [(1, "a", None, {"k": 1}), (2, None, 0.5, {}), (2, None, 0.5, {}), (3, "c", None, None)]
KINDS = "id int, name string, amount double, more map<string,int>"


def digests(df):
    return {r.columns: tuple(r) for r in quality.table_digest(df).collect()}


def test_digest_does_not_depend_on_order_or_spread(spark):
    df = spark.createDataFrame(ROWS, KINDS)
    shuffled = spark.createDataFrame(ROWS[::-1], KINDS).repartition(5).select("more", "amount", "name", "id")
    assert digests(df) == digests(shuffled) and set(digests(df)) == {"*", "id", "name", "amount", "more"}
    assert digests(df.limit(0))["*"][1] == 0


@pytest.mark.parametrize("place,column,value", [(0, "name", "b"), (0, "amount", 0.0), (1, "name", ""), (3, "more", {"k": 2}), (2, "id", 3)])
def test_one_other_cell_shows_in_its_column(spark, place, column, value):
    changed = [list(r) for r in ROWS]
    changed[place][["id", "name", "amount", "more"].index(column)] = value
    found = quality.compare_tables(spark.createDataFrame(ROWS, KINDS), spark.createDataFrame(changed, KINDS))
    assert {r.columns for r in found.collect() if not r.same} == {"*", column}


def test_swapped_cells_and_lost_repeats_show(spark):
    df = spark.createDataFrame(ROWS, KINDS)
    swapped = df.withColumn("name", F.when(F.col("id") == 3, "a").when(F.col("id") == 1, "c").otherwise(F.col("name")))
    assert {r.columns for r in quality.compare_tables(df, swapped).collect() if not r.same} == {"*"}
    once = quality.compare_tables(df, df.dropDuplicates(["id"]))
    assert not any(r.same for r in once.collect())
    lacking = {r.columns: r.same for r in quality.compare_tables(df, df.drop("name")).collect()}
    assert lacking == {"*": False, "name": False, "id": True, "amount": True, "more": True}
