"""Edges of buckets, flags and rule packs on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import flags, ladders
from riskloom.operators import clean, detection, rules


def one(spark, schema, row):
    return spark.createDataFrame([row], schema)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_amount_edges(spark):
    amounts = [None, -1.0, 0.0, 49.99, 50.0, 199.99, 200.0, 999.0, 1000.0, 4999.99, 5000.0, 10000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    got = [r[0] for r in df.select(ladders.bucket(F.col("amount"), ladders.AMOUNT_RANGE)).collect()]
    assert got == ["VERY_LARGE", "MICRO", "MICRO", "MICRO", "SMALL", "SMALL", "MEDIUM", "MEDIUM", "LARGE", "LARGE",
                   "VERY_LARGE", "VERY_LARGE"]


def test_score_category_edges(spark):
    df = spark.createDataFrame([(s,) for s in (None, 29.9, 30.0, 59.9, 60.0, 79.9, 80.0)], "s double")
    got = [r[0] for r in df.select(ladders.bucket(F.col("s"), ladders.SCORE_CATEGORY)).collect()]
    assert got == ["CRITICAL", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_period_of_every_hour(spark):
    df = spark.createDataFrame([(h,) for h in [*range(24), None]], "h int")
    got = [r[0] for r in df.select(ladders.period_of_day(F.col("h"))).collect()]
    assert got == (["NIGHT"] * 6 + ["MORNING"] * 6 + ["AFTERNOON"] * 6 + ["EVENING"] * 5 + ["NIGHT"] * 2)


def test_income_and_credit_edges(spark):
    df = spark.createDataFrame([(1999.99, 399), (2000.0, 400), (5000.0, 500), (10000.0, 650), (20000.0, 750),
                                (None, None)], "m double, c int")
    got = values(df, ladders.bucket(F.col("m"), ladders.INCOME_BAND), ladders.bucket(F.col("c"), ladders.CREDIT_BAND))
    assert got == [("UP_TO_2K", "VERY_LOW"), ("2K_TO_5K", "LOW"), ("5K_TO_10K", "MEDIUM"), ("10K_TO_20K", "GOOD"),
                   ("ABOVE_20K", "EXCELLENT"), ("ABOVE_20K", "EXCELLENT")]


def test_portuguese_labels(spark):
    df = spark.createDataFrame([("NIGHT",), ("VERY_LARGE",), ("other",), (None,)], "x string")
    assert [r[0] for r in df.select(ladders.relabel(F.col("x"))).collect()] == ["MADRUGADA", "MUITO_GRANDE", "other", None]


def test_unknown_mcc_stays_unknown(spark):
    df = spark.createDataFrame([("high",), ("HIGH",), ("High",), (None,)], "mcc_risk_level string")
    assert [r[0] for r in df.select(flags.high_risk_mcc()).collect()] == [True, True, False, None]


@pytest.mark.parametrize("level,fraud,want", [
    ("HIGH", None, True), ("CRITICAL", False, True), ("LOW", True, True), ("LOW", False, False), ("LOW", None, None),
    ("MEDIUM", None, None),
])
def test_review_is_three_valued(spark, level, fraud, want):
    df = one(spark, "risk_level string, is_fraud boolean", (level, fraud))
    assert df.select(rules.needs_review()).first()[0] is want
    assert df.where(rules.needs_review()).count() == (1 if want else 0)


BATCH_ROW = """unusual_time boolean, new_beneficiary boolean, is_high_risk_mcc boolean, amount double, type string,
    auth_3ds boolean, cvv_validated boolean, period_of_day string, fraud_score double,
    distance_from_last_txn_km double, transactions_last_24h int, accumulated_amount_24h double, card_entry string"""
QUIET = (False, False, False, 10.0, "TED", True, True, "MORNING", 0.0, 0.0, 0, 0.0, "CHIP")
NAMES = [part.split()[0] for part in BATCH_ROW.split(",")]


@pytest.mark.parametrize("change,points", [
    ({}, 0), ({"unusual_time": True}, 15), ({"new_beneficiary": True}, 10), ({"is_high_risk_mcc": True}, 20),
    ({"amount": 5000.0}, 0), ({"amount": 5000.01}, 15), ({"amount": 10000.0}, 15), ({"amount": 10000.01}, 30),
    ({"type": "PIX"}, 5), ({"auth_3ds": False}, 10), ({"cvv_validated": False}, 10), ({"period_of_day": "NIGHT"}, 10),
    ({"fraud_score": 50.0}, 0), ({"fraud_score": 50.5}, 10), ({"fraud_score": 70.0}, 10), ({"fraud_score": 70.5}, 20),
    ({"distance_from_last_txn_km": 100.0}, 0), ({"distance_from_last_txn_km": 101.0}, 10),
    ({"distance_from_last_txn_km": 501.0}, 20), ({"transactions_last_24h": 11}, 8), ({"transactions_last_24h": 21}, 15),
    ({"accumulated_amount_24h": 20001.0}, 10), ({"accumulated_amount_24h": 50001.0}, 20), ({"card_entry": "MANUAL"}, 15),
    (dict.fromkeys(NAMES), 0),
])
def test_batch_points(spark, change, points):
    row = tuple(change.get(n, q) for n, q in zip(NAMES, QUIET))
    assert rules.BATCH.apply(one(spark, BATCH_ROW, row)).first()["risk_points"] == points


def test_levels_rise_with_the_score(spark):
    df = spark.range(0, 130).withColumn("s", F.col("id").cast("int"))
    for pack in (rules.BATCH, rules.GEO, rules.SENSITIVE, rules.STREAM):
        order = ladders.LEVEL_ORDER
        got = [order.index(r[0]) for r in df.orderBy("s").select(pack.level(F.col("s"))).collect()]
        assert got == sorted(got, reverse=True)


def test_reasons_name_the_rules_that_gave_points(spark):
    row = tuple({"unusual_time": True, "fraud_score": 60.0}.get(n, q) for n, q in zip(NAMES, QUIET))
    assert one(spark, BATCH_ROW, row).select(rules.BATCH.reasons()).first()[0] == ["unusual_time", "feed_score"]


def test_combined_score_of_unknown_feed_score(spark):
    schema = """fraud_score double, is_pix_new_beneficiary boolean, is_high_value boolean, is_high_velocity boolean,
        is_high_accumulated boolean, is_location_jump boolean, is_manual_card_entry boolean,
        is_no_3ds_online boolean, unusual_time boolean, mcc_risk_level string"""
    flags_on = (True,) * 8
    rows = [(None, *flags_on, "high"), (12.5, *flags_on, "medium")]
    got = values(rules.combine_scores(spark.createDataFrame(rows, schema)), "fraud_score_additional",
                 "fraud_score_combined", "risk_level")
    assert got == [(155, None, "NORMAL"), (145, 85.0, "CRITICAL")]


def test_customer_level(spark):
    schema = "fraud_rate double, critical_risk_count long, high_risk_count long"
    rows = [(5.01, 0, 0), (5.0, 0, 0), (2.0, 3, 3), (2.0, 3, 2), (None, 9, 9)]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(rules.customer_level()).collect()]
    assert got == ["VERY_HIGH", "HIGH", "MEDIUM", "LOW", "MEDIUM"]


def test_account_takeover_and_age(spark):
    schema = "device_is_trusted boolean, amount double, device_is_rooted boolean, device_is_emulator boolean"
    rows = [(False, 501.0, False, False), (False, 500.0, False, False), (None, 900.0, None, None), (None, 1.0, True, None)]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(flags.account_takeover()).collect()]
    assert got == [True, False, None, True]
    ages = [(17, "Joias", 10001.0), (76, "Crypto", 2001.0), (17, "Food", 5001.0), (17, "Joias", 5000.0), (None, "Joias", 1.0)]
    df = spark.createDataFrame(ages, "customer_age long, merchant_category string, amount double")
    assert [r[0] for r in df.select(flags.age_mismatch()).collect()] == [True, True, True, False, False]


def test_device_risk(spark):
    rows = [(None, False, 71), (None, True, 0), (False, False, 70), (False, False, 71), (None, None, None)]
    df = spark.createDataFrame(rows, "is_rooted boolean, is_emulator boolean, risk_score int")
    got = [r[0] for r in df.select(clean.device_risk_category()).collect()]
    assert got == ["MEDIUM_RISK", "HIGH_RISK", "LOW_RISK", "MEDIUM_RISK", "LOW_RISK"]


def test_two_rules_bounds(spark):
    rows = [("2024-01-01T02:00:00", 1000.01), ("2024-01-01T05:59:59", 1000.0), ("2024-01-01T06:00:00", 5.0), ("bad", None)]
    got = values(rules.two_rule_level(spark.createDataFrame(rows, "timestamp string, amount double")),
                 "transaction_hour", "risk_level")
    assert got == [(2, "HIGH"), (5, "MEDIUM"), (6, "LOW"), (None, "LOW")]


def test_keep_first_picks_by_order_not_by_arrival(spark):
    rows = [("a", "2024-02-01", 5.0, "d", "m", "c"), ("a", "2024-01-01", None, "d", "m", "c"),
            ("a", "2024-01-01", 3.0, "d", "m", "c"), ("b", "2024-01-01", 1.0, "d", "m", "c")]
    df = spark.createDataFrame(rows, "transaction_id string, timestamp string, amount double, device_id string, "
                               "merchant_name string, merchant_category string")
    got = {(r.transaction_id, r.amount) for r in clean.keep_first(df, "transaction_id", clean.TRANSACTION_ORDER).collect()}
    assert got == {("a", None), ("b", 1.0)}


def test_alerts_drop_unknown_review(spark, small):
    from riskloom.catalog import base
    scored = base.gold(spark, small)
    assert detection.alerts(scored).count() == scored.where("requires_review = true").count()
