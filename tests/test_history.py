"""Features from earlier transactions against brute force, with one customer holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.functions import geo
from riskloom.operators import history, ordered

DAY = 86_400
FIELDS = """transaction_id string, customer_id string, epoch long, amount double, purchase_latitude double,
    purchase_longitude double, purchase_state string, destination_bank string"""


def make_rows(n=700, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        who = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", "c", None])
        at = 1_700_000_000 + rnd.choice([rnd.randrange(0, 4 * DAY), 40 * DAY + rnd.randrange(0, 1800), 7200 * rnd.randrange(30)])
        amount = None if rnd.random() < 0.05 else round(rnd.uniform(-50, 900), 2)
        rows.append((f"t{i:04d}", who, at, amount, rnd.uniform(-30, 5), rnd.uniform(-60, -35),
                     rnd.choice("SP RJ MG".split()), rnd.choice(["B1", "B2", None])))
    return rows


ROWS = make_rows()
CUTS = [{"cuts": 9}, {"cuts": 60}, {}]


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(ROWS, FIELDS).repartition(5).cache()


def of_customer(row):
    return [r for r in ROWS if r[1] == row[1]]


def test_a_hot_second_spans_many_cuts(spark):
    """A third of all rows in one hour of one customer, half of them in one second: no cut gets much more than others."""
    rows = spark.range(3000).selectExpr(
        "concat('t', id) AS transaction_id", "IF(id % 3 = 0, 'hot', concat('c', id % 500)) AS customer_id",
        "1700000000 + IF(id % 3 = 0, IF(id % 2 = 0, 7, id % 3600), id * 50) AS epoch", "CAST(1 AS double) AS amount",
        "CAST(id AS double) AS purchase_latitude", "CAST(0 AS double) AS purchase_longitude", "'SP' AS purchase_state")
    cut = ordered.in_cuts(rows.select(F.struct("customer_id", "epoch", "transaction_id").alias("place")), "place", 20)
    sizes = [r["count"] for r in cut.groupBy("_cut").count().collect()]
    hot = cut.where("place.customer_id = 'hot' AND place.epoch = 1700000007").select("_cut").distinct().count()
    assert hot > 2 and max(sizes) < 3 * 3000 / 20
    plain = history.movement(rows, cuts=1).select("transaction_id", "prev_timestamp", "prev_latitude")
    assert sorted(history.movement(rows, cuts=20).select(plain.columns).collect()) == sorted(plain.collect())
    one = history.last_day(rows, cuts=1).select("transaction_id", "transactions_last_24h")
    assert sorted(history.last_day(rows, cuts=20).select(one.columns).collect()) == sorted(one.collect())


def test_full_rows_are_read_once(spark, folder, feed):
    feed.write.parquet(f"{folder}/feed")
    for build in (history.movement, history.last_day):
        plan = build(spark.read.parquet(f"{folder}/feed"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"{folder}/feed") == 1


@pytest.mark.parametrize("limits", CUTS)
def test_previous_row(feed, limits):
    got = {r.transaction_id: r for r in history.movement(feed, **limits).collect()}
    assert len(got) == len(ROWS)
    for row in ROWS:
        earlier = [r for r in of_customer(row) if (r[2], r[0]) < (row[2], row[0])]
        out = got[row[0]]
        if not earlier:
            assert (out.prev_timestamp, out.time_since_last_tx, out.distance_km_from_prev, out.velocity_kmh) == (None,) * 4
            assert (out.is_cloning_suspect, out.is_impossible_velocity) == (False, False)
            continue
        last = max(earlier, key=lambda r: (r[2], r[0]))
        assert (out.prev_timestamp, out.prev_latitude, out.prev_longitude, out.prev_state) == (last[2], *last[4:7])
        minutes = (row[2] - last[2]) / 60
        km = ((row[4] - last[4]) ** 2 + (row[5] - last[5]) ** 2) ** 0.5 * 111
        assert out.time_since_last_tx == pytest.approx(minutes)
        assert out.distance_km_from_prev == pytest.approx(km)
        assert out.velocity_kmh == (pytest.approx(km / (minutes / 60)) if minutes else None)
        assert out.is_impossible_velocity == (minutes > 0 and km / (minutes / 60) > 900)
        assert out.is_cloning_suspect == (minutes < 60 and km > 555 and last[6] != row[6])


@pytest.mark.parametrize("limits", CUTS)
def test_last_day(feed, limits):
    got = {r.transaction_id: r for r in history.last_day(feed, **limits).collect()}
    assert len(got) == len(ROWS)
    for row in ROWS:
        span = [r for r in of_customer(row) if row[2] - DAY <= r[2] <= row[2]]
        amounts = [r[3] for r in span if r[3] is not None]
        out = got[row[0]]
        assert out.transactions_last_24h == len(span)
        assert out.accumulated_amount_24h == (pytest.approx(sum(amounts), abs=1e-6) if amounts else None)


@pytest.mark.parametrize("limits", CUTS)
def test_month_average(feed, limits):
    got = {r.transaction_id: r.avg_transaction_amount_30d for r in history.month_average(feed, **limits).collect()}
    for row in ROWS:
        amounts = [r[3] for r in of_customer(row) if row[2] - 30 * DAY <= r[2] < row[2] and r[3] is not None]
        want = pytest.approx(sum(amounts) / len(amounts), abs=0.00501) if amounts else None
        assert got[row[0]] == want


def test_unknown_times_agree(spark, feed):
    extra = spark.createDataFrame([("x1", "hot", None, 1.0, 0.0, 0.0, "SP", None), ("x2", "hot", None, 2.0, 1.0, 1.0, "RJ", None)], FIELDS)
    rows = feed.unionByName(extra)
    for build in (history.movement, history.last_day, history.month_average):
        plain = {tuple(r) for r in build(rows, cuts=1).collect()}
        sliced = {tuple(r) for r in build(rows, cuts=40).collect()}
        assert plain == sliced


def test_first_use(feed):
    got = {r.transaction_id: r.new for r in history.first_use(feed, "destination_bank", "new").collect()}
    assert len(got) == len(ROWS)
    for row in ROWS:
        same = [r for r in of_customer(row) if r[7] == row[7]]
        want = row[7] is not None and min(same, key=lambda r: (r[2], r[0])) is row
        assert got[row[0]] == want


def test_strict_limits(spark):
    km555 = 555 / 111
    rows = [("1", "k", 0, 1.0, 0.0, 0.0, "SP", None), ("2", "k", 3599, 1.0, km555, 0.0, "RJ", None),
            ("3", "k", 7199, 1.0, 0.0, 10.0, "SP", None), ("4", "k", 7199, 1.0, 0.0, 0.0, "RJ", None)]
    out = {r.transaction_id: r for r in history.movement(spark.createDataFrame(rows, FIELDS)).collect()}
    assert out["2"].is_cloning_suspect is False  # exactly 555 km
    assert out["3"].is_cloning_suspect is False  # exactly 60 minutes
    assert out["4"].velocity_kmh is None and out["4"].is_impossible_velocity is False  # same second


def test_epoch_units(spark):
    df = spark.createDataFrame([(1_700_000_000_123,)], "at long")
    assert history.with_epoch(df, "at", "milliseconds").first()["epoch"] == 1_700_000_000
    assert history.with_epoch(df, "at", "seconds").first()["epoch"] == 1_700_000_000_123
    with pytest.raises(KeyError):
        history.with_epoch(df, "at", "days")


def test_distances(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    points = [F.col(c) for c in "abcd"]
    native = [r[0] for r in df.select(geo.haversine_km(*points)).collect()]
    batched = [r[0] for r in df.select(geo.haversine_pandas()(*points)).collect()]
    assert native[0] == pytest.approx(111.19, abs=0.01) and native[1] is None
    assert batched[0] == pytest.approx(native[0]) and batched[1] is None
    assert df.select(geo.planar_km(*points)).first()[0] == 111.0


def _mixed_rows(spark, n: int = 600):
    rng = random.Random(12)
    rows = []
    for k in range(n):
        customer = rng.choice(["hot"] * 4 + ["a", "b", None])
        at = rng.choice([None, 5000, 5000, 5000, 5001, 5000 + rng.randrange(3 * 86_400), rng.randrange(70 * 86_400)])
        amount = rng.choice([None, float("nan"), round(rng.random() * 900 - 200, 2), round(rng.random() * 900, 2)])
        rows.append((customer, f"t{k:04}", at, amount, rng.random(), rng.choice([None, rng.random()]), rng.choice(["SP", None])))
    return spark.createDataFrame(rows, """customer_id string, transaction_id string, epoch long, amount double,
        purchase_latitude double, purchase_longitude double, purchase_state string""").repartition(3)


@pytest.mark.parametrize("cuts", [None, 1, 23])
def test_one_pass_equals_the_single_features(spark, cuts):
    rows = _mixed_rows(spark)
    one_by_one = history.month_average(history.last_day(history.movement(rows)))
    at_once = history.histories(rows, cuts=cuts)
    assert set(at_once.columns) == set(one_by_one.columns)
    text = lambda df: sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    assert text(at_once) == text(one_by_one)
    assert history.histories(rows.limit(0), cuts=cuts).collect() == []


def test_computed_fields_replace_given_ones(spark):
    rows = _mixed_rows(spark, 60).withColumn("transactions_last_24h", F.lit(-1)).withColumn("extra", F.lit("x"))
    fields = ["transactions_last_24h", "distance_from_last_txn_km", "time_since_last_txn_min"]
    found = history.with_computed(rows, fields)
    assert found.columns == [*rows.columns, *fields[1:]]
    want = history.histories(rows.drop("transactions_last_24h"), geo.haversine_km).select(
        "transaction_id", "transactions_last_24h", F.round("distance_km_from_prev", 3), F.round("time_since_last_tx", 4))
    assert sorted(map(str, found.select("transaction_id", *fields).collect())) == sorted(
        str(r) for r in want.toDF("transaction_id", *fields).collect())


@pytest.mark.parametrize("cuts", [1, 5, 40])
def test_scan_equals_brute_force(spark, cuts):
    rng = random.Random(cuts)
    rows = [(rng.choice(["k", "k", "l", None]), k, rng.choice([None, k]), rng.randrange(-3, 9)) for k in range(200)]
    df = spark.createDataFrame(rows, "key string, at long, seen long, n long").select(
        F.struct("key", "at").alias("place"), F.when(F.col("seen").isNotNull(), F.struct("seen")).alias("last"), "n")
    got = {(r.place.key, r.place.at): (r.n_upto, r.last_before.seen if r.last_before else None)
           for r in ordered.scan(df, "place.key", "place", ["n"], ["last"], cuts).collect()}
    sums, last, want = {}, {}, {}
    for key, at, seen, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        sums[key] = sums.get(key, 0) + n
        want[key, at] = (sums[key], last.get(key))
        last[key] = last.get(key) if seen is None else seen
    assert got == want


def _text(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("cuts", [None, 1, 4, 23])
def test_features_are_the_same_along_with_full_rows(spark, cuts):
    """Customers whose rows stay together, and one with most rows, which is cut into ranges."""
    rows = _mixed_rows(spark)
    assert ordered.large_keys(rows, "customer_id", 23) and not ordered.large_keys(rows.where("customer_id is null").limit(7), "customer_id", 23)
    assert _text(history.histories(rows, cuts=cuts, along=True)) == _text(history.histories(rows))
    for build in (history.last_day, history.month_average, history.movement):
        found, plain = build(rows, cuts=cuts, along=True), build(rows)
        assert set(found.columns) == set(plain.columns) and _text(found) == _text(plain)
        assert build(rows.limit(0), cuts=cuts, along=True).collect() == []


def test_keys_with_a_large_share_are_few_and_may_be_null(spark):
    rows = spark.range(4000).selectExpr("CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN 'hot' ELSE concat('c', id) END AS k", "id")
    found = ordered.large_keys(rows, "k", 10)
    assert set(found) == {None, "hot"}
    assert rows.where(ordered.among(F.col("k"), found)).count() == 2000
    assert rows.where(~ordered.among(F.col("k"), ["hot"])).count() == 3000 and rows.where(~ordered.among(F.col("k"), [None])).count() == 3000


@pytest.mark.parametrize("build", [history.last_day, history.histories])
def test_customers_without_a_large_share_cost_one_shuffle(spark, build, monkeypatch):
    """No cut table and no join, whatever the size; rows without a time among them."""
    written = []
    monkeypatch.setattr(ordered, "_written", lambda df: written.append(df) or df)
    rows = spark.range(4000).selectExpr(
        "concat('t', id) AS transaction_id", "concat('c', id % 900) AS customer_id", "IF(id % 50 = 0, NULL, 1700000000 + id * 50) AS epoch",
        "CAST(id AS double) AS amount", "CAST(id AS double) AS purchase_latitude", "CAST(0 AS double) AS purchase_longitude", "'SP' AS purchase_state")
    found = build(rows, along=True, cuts=6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Python" not in plan and written == []
    assert _text(found) == _text(build(rows))


def test_only_large_customers_are_cut_along_with_full_rows(spark):
    rows = spark.range(3000).selectExpr(
        "concat('t', id) AS transaction_id", "IF(id % 3 = 0, 'hot', concat('c', id % 500)) AS customer_id", "1700000000 + id % 7 AS epoch")
    placed = rows.withColumn("place", F.struct("customer_id", "epoch", "transaction_id"))
    number, ranges = ordered.dealt(placed, "place.customer_id", "place", 20)
    sizes = {r["_cut"]: r["count"] for r in placed.withColumn("_cut", number).groupBy("_cut").count().collect()}
    hot = {n: c for n, c in sizes.items() if n >= ranges}
    assert sum(hot.values()) == 1000 and len(hot) > 3 and max(sizes.values()) < 3 * 3000 / 20
    number, ranges = ordered.dealt(placed.where("customer_id != 'hot'"), "place.customer_id", "place", 20)
    assert ranges is None and "aggregate" not in str(number)
