"""History features on a stream against brute force and against the batch operators."""

import random
from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.sql import Row, functions as F
from pyspark.sql.types import StructType

from riskloom.operators import history
from riskloom.streaming import grouped, sinks, state

SCHEMA = """customer_id string, transaction_id string, event_time timestamp, amount double, purchase_latitude double,
    purchase_longitude double, purchase_state string, beneficiary string"""
FIRSTS = {"is_new_beneficiary": "beneficiary"}


def rows(seed: int, n: int, start: int, span: int) -> list[tuple]:
    rng = random.Random(seed)
    made = []
    for k in range(n):
        at = start + rng.randrange(span) if rng.random() < 0.9 else start + rng.randrange(3)
        made.append((
            rng.choice(["hot", "hot", "a", "b", None]), f"{seed}-{k:05}", datetime.fromtimestamp(at, timezone.utc),
            rng.choice([None, float("nan"), round(rng.random() * 500, 2)]), rng.random(), rng.choice([None, rng.random()]),
            rng.choice(["SP", "RJ", None]), rng.choice(["x", "y", "z", None])))
    return made


@pytest.mark.parametrize("spans", [[(10, True), (30, False)], [(7200, True), (20_000, False)]])
def test_spans_equal_brute_force(spans):
    rng = random.Random(4)
    second, stored, kept, totals, log = 1_000_000, {}, [], [], []
    for _ in range(400):
        second += rng.choice([1, 1, 2, 9, 31, 3600, 50_000] if rng.random() < 0.2 else [1, 7, 400])
        own = [rng.randrange(1, 4), rng.randrange(3), rng.randrange(-500, 500)]
        held = state.Spans(spans, kept, totals, lambda hour: stored[hour])
        got = held.add(second, own)
        for (span, now), value in zip(spans, got, strict=True):
            inside = [s for at, s in [*log, (second, own)] if second - span <= at <= second - (not now)]
            assert value == [sum(s[k] for s in inside) for k in range(3)]
        log.append((second, own))
        stored.update({h: held.hours[h] for h in held.changed})
        for hour in held.gone:
            stored.pop(hour, None)
        kept, totals = held.kept, held.totals
        assert set(stored) == set(kept) and len(kept) <= max(s for s, _ in spans) // state.HOUR + 2


def drained(spark, folder, slices, lateness="5 seconds"):
    """One run of the stream to its end for each slice, all with one checkpoint."""
    for k, part in enumerate(slices):
        spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(f"{folder}/feed")
        feed = spark.readStream.schema(SCHEMA).parquet(f"{folder}/feed")
        found = state.with_movement(state.with_history(feed, FIRSTS, lateness))
        with state.rocksdb(spark):
            query = sinks.append_table(found, f"{folder}/out", f"{folder}/check", None)
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), query


def test_stream_equals_batch_on_closed_seconds(spark, folder):
    day = 86_400
    slices = [rows(1, 60, 10 * day, 90), rows(2, 60, 10 * day + 100, 3 * 3600), rows(3, 60, 12 * day, 60), rows(4, 40, 60 * day, 3000)]
    before = spark.conf.get(state.STORE[0], None)
    got, _ = drained(spark, folder, slices)
    assert spark.conf.get(state.STORE[0], None) == before
    everything = spark.createDataFrame([r for s in slices for r in s], SCHEMA).withColumn("epoch", F.unix_seconds("event_time"))
    want = history.first_use(history.month_average(history.last_day(history.movement(everything))), "beneficiary", "is_new_beneficiary")
    closed = max(r[2] for s in slices for r in s).timestamp() - 5
    columns = ["transaction_id", "transactions_last_24h", "accumulated_amount_24h", "avg_transaction_amount_30d", "prev_timestamp",
               "prev_latitude", "prev_longitude", "prev_state", "time_since_last_tx", "velocity_kmh", "is_cloning_suspect", "is_new_beneficiary", "customer_id"]
    text = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    assert text(got) == text(want.where(F.col("epoch") < closed))
    assert got.count() > 150


def test_state_is_bounded(spark, folder):
    """A month after a customer's last row only the last row and the values seen are left."""
    day = 86_400
    one = [("a", f"t{k}", datetime.fromtimestamp(10 * day + 1000 * k, timezone.utc), 1.0, 0.0, 0.0, "SP", "x") for k in range(200)]
    far = [("b", "u", datetime.fromtimestamp(100 * day, timezone.utc), 1.0, 0.0, 0.0, "SP", "x")]
    sizes = []
    for slices in ([one], [far], [[(*far[0][:2], datetime.fromtimestamp(200 * day, timezone.utc), *far[0][3:])]]):
        _, query = drained(spark, folder, slices)
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal if query.lastProgress.stateOperators else None)
    # 200,000 seconds span 56 hours; of these 56 entries, their sums and timers nothing is left
    assert sizes[0] > 50 and sizes[-1] < 12


def test_rows_without_a_time_are_handed_on(spark, folder):
    known = [("a", "t1", datetime.fromtimestamp(1000, timezone.utc), 2.0, 0.0, 0.0, "SP", "x")]
    got, _ = drained(spark, folder, [[("a", "t0", None, 5.0, 0.0, 0.0, "SP", "x"), *known], [("a", "t9", datetime.fromtimestamp(9000, timezone.utc), 2.0, 0.0, 0.0, "SP", "x")]])
    found = {r.transaction_id: (r.transactions_last_24h, r.accumulated_amount_24h, r.prev_timestamp, r.is_new_beneficiary) for r in got.collect()}
    assert found == {"t0": (0, None, None, False), "t1": (1, 2.0, None, True)}


def test_whole_state_gives_the_same_rows(spark, folder):
    """One value for each customer: the same features, null times, open seconds and late slices as state kept in parts."""
    day = 86_400
    slices = [rows(1, 60, 10 * day, 90), rows(2, 60, 10 * day + 100, 3 * 3600), rows(3, 60, 12 * day, 60), rows(4, 40, 60 * day, 3000)]
    slices[1] += [("a", "untimed", None, 5.0, 0.0, 0.0, "SP", "x"), (None, "too late", datetime.fromtimestamp(5 * day, timezone.utc), 1.0, 0.0, 0.0, "SP", "x")]
    found = {}
    for whole in (False, True):
        root = f"{folder}/{whole}"
        for part in slices:
            spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(f"{root}/feed")
            feed = spark.readStream.schema(SCHEMA).parquet(f"{root}/feed")
            made = state.with_history(feed, FIRSTS, "5 seconds", whole=whole)
            with state.rocksdb(spark):
                query = sinks.append_table(made, f"{root}/out", f"{root}/check", None)
            query.awaitTermination()
        out = spark.read.parquet(f"{root}/out")
        found[whole] = (out.dtypes, sorted(map(str, out.collect())))
    assert found[True] == found[False] and len(found[True][1]) > 150
    # all that is kept of a customer is one value, read and written once in a micro-batch
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 4


def test_whole_state_forgets_what_no_span_reaches(spark):
    day = 86_400
    carried = StructType.fromDDL("epoch long, transaction_id string, purchase_latitude double, purchase_longitude double, purchase_state string, "
                                 "bank string, _cents long")
    held, made = state.WholeHistory("customer_id", carried, {"new_bank": "bank"}), Row(*carried.names)
    held.restore(None)
    assert list(held.added(("c",), [made(day + 1000 * k, f"t{k}", 0.0, 0.0, "SP", "b", None if k else 2**60 + 1) for k in range(200)])) == []
    out = list(held.advanced(("c",), (day + 300_000) * 1000))
    assert len(out) == 200 and out[1]["_month_cents"] == 2**60 + 1 and [r.new_bank for r in out].count(True) == 1
    large = held.kept()
    held.restore(large)
    assert held.kept() == large and held.next_time() == (day + 199_000 + 30 * day + 2) * 1000 - 1
    assert list(held.advanced(("c",), held.next_time() + 1)) == [] and len(held.kept()) < 200 < len(large)
    assert held.next_time() is None and held.seen.containsKey(("new_bank", "b"))


def test_state_in_groups_gives_the_same_rows(spark, folder):
    """Customers dealt into groups: the same features, null times, open seconds and late slices as state kept in parts."""
    day = 86_400
    slices = [rows(1, 60, 10 * day, 90), rows(2, 60, 10 * day + 100, 3 * 3600), rows(3, 60, 12 * day, 60), rows(4, 40, 60 * day, 3000)]
    slices[1] += [("a", "untimed", None, 5.0, 0.0, 0.0, "SP", "x"), (None, "too late", datetime.fromtimestamp(5 * day, timezone.utc), 1.0, 0.0, 0.0, "SP", "x")]
    slices[2] += [("hot", "3-twice", datetime.fromtimestamp(12 * day + 1, timezone.utc), 5.0, x, None, "SP", "x") for x in (2.0, None, 1.0)]
    found = {}
    for groups in (None, 1, 7):
        root = f"{folder}/{groups}"
        for part in slices:
            spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(f"{root}/feed")
            feed = spark.readStream.schema(SCHEMA).parquet(f"{root}/feed")
            made = state.with_history(feed, FIRSTS, "5 seconds", groups=groups)
            with state.rocksdb(spark):
                query = sinks.append_table(made, f"{root}/out", f"{root}/check", None)
            query.awaitTermination()
        out = spark.read.parquet(f"{root}/out")
        found[groups] = (sorted(out.dtypes), sorted(map(str, out.select(sorted(out.columns)).collect())))
        # one value for each group that has customers, however many these are
        assert groups is None or query.lastProgress.stateOperators[0].numRowsTotal <= min(groups, 4)
    assert found[1] == found[None] == found[7] and len(found[None][1]) > 150


def test_a_group_is_called_once_for_all_its_customers(spark, folder):
    """A micro-batch calls Python once for a group and not for a customer, and hands over the rows as columns."""
    at = datetime.fromtimestamp(86_400, timezone.utc)
    many = [(f"c{k}", f"t{k}", at, 1.0, 0.0, 0.0, "SP", "x") for k in range(300)]
    spark.createDataFrame(many, SCHEMA).write.parquet(f"{folder}/feed")
    feed = spark.readStream.schema(SCHEMA).parquet(f"{folder}/feed")
    with state.rocksdb(spark):
        query = sinks.append_table(state.with_history(feed, FIRSTS, "5 seconds", groups=3), f"{folder}/out", f"{folder}/check", None)
    query.awaitTermination()
    assert query.lastProgress.stateOperators[0].numRowsTotal == 3


def _group(rows):
    """Rows (customer, second, place, cents) as a group receives them."""
    return pd.DataFrame([{
        "_timed": second is not None, "_at": second or 0, "_key": key, "_own": f'{{"transaction_id":"{n:06d}"}}', "_place": place, "_has": cents is not None,
        "_cents": cents or 0, "_first_0": place} for n, (key, second, place, cents) in enumerate(rows)])


def test_sums_of_a_group_are_exact_and_forgotten():
    work = grouped.GroupHistory(["transaction_id"], ["is_new"], [(86_400, True), (30 * 86_400, False)], 5)
    day, huge = 86_400, 2**62 + 1
    rows = [("a", day, "p", huge), ("a", day + 1, "q", huge), ("b", day + 2, "p", None), ("a", day + 3, "p", -huge), ("a", 9_000_000_000_000, "r", 7)]
    held = work.restore(None)
    first, = work.advanced(held, _group(rows), (day + 10) * 1000)
    by = dict(zip(first["_own"].str.slice(19, 25), first.itertuples(index=False), strict=True))
    assert [by[f"{n:06d}"].accumulated_amount_24h for n in (0, 1, 3)] == [huge / 100.0, 2 * huge / 100.0, huge / 100.0]
    assert by["000003"]._5 == 2 * huge / 100.0 and [by[f"{n:06d}"].is_new for n in range(4)] == [True, True, True, False]
    assert [by[f"{n:06d}"]._1 for n in range(4)] == [None, "p", None, "q"]
    # the state is taken up as it was written, sums beyond a long included
    again = work.restore(work.kept(held))
    assert work.kept(again) == work.kept(held) and list(again.c) == [huge, huge, -huge, 0] and len(again.open) == 1
    later, = work.advanced(again, _group([("a", day + 20, "p", 1)]), (day + 30) * 1000)
    assert later["accumulated_amount_24h"].tolist() == [(huge + 1) / 100.0] and later["is_new"].tolist() == [False]
    # a month later sums are gone, the last row and the values seen are not
    assert work.next_time(work.restore(work.kept(again))) == (9_000_000_000_000 + 1) * 1000 - 1
    last, = work.advanced(again, None, (9_000_000_000_000 + 10) * 1000)
    assert last["_before"].tolist() == ["p"] and last["transactions_last_24h"].tolist() == [1] and len(again.second) == 1
    assert list(work.advanced(again, None, (9_000_000_000_000 + 31 * day) * 1000)) == [] and len(again.second) == 0 and work.next_time(again) is None
    with pytest.raises(ValueError, match="5 groups"):
        grouped.GroupHistory(["transaction_id"], ["is_new"], [(day, True)], 6).restore(work.kept(again))


def test_a_group_equals_brute_force():
    rng, day = random.Random(7), 86_400
    spans = [(50, True), (400, False)]
    work, held, log, out = grouped.GroupHistory(["transaction_id"], [], spans, 1), None, [], {}
    kept = None
    for step in range(12):
        start = day + 150 * step
        rows = [(rng.choice("abcd"), start + rng.randrange(150), "p", rng.choice([None, rng.randrange(-90, 90)])) for _ in range(rng.randrange(40))]
        frame = _group(rows)
        if len(frame):
            frame["_own"] = [f'{{"transaction_id":"{step:02d}-{n:04d}"}}' for n in range(len(rows))]
        log += [(row, f"{step:02d}-{n:04d}") for n, row in enumerate(rows)]
        held = work.restore(kept)
        for made in work.advanced(held, frame, (start + 100) * 1000):
            out |= {own[19:-2]: (day, amounts, total) for own, day, amounts, total in zip(made["_own"], made["transactions_last_24h"], made["_month_amounts"], made["_month_sum"], strict=True)}
        kept = work.kept(held)
    for (key, second, _, _), name in log:
        if name in out:
            near = [r for r, _ in log if r[0] == key and second - 50 <= r[1] <= second]
            far = [r[3] for r, _ in log if r[0] == key and second - 400 <= r[1] < second and r[3] is not None]
            assert out[name] == (len(near), len(far), sum(far) / 100.0)
    assert len(out) > 100
