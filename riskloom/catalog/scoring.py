"""Flags, rule packs and joins (F, R, J, V)."""

from pyspark.sql import functions as F

from riskloom.catalog.base import (
    alerts, as_of_date, check, customers, devices, feed, geo_feed, geo_scored, gold, half_up, query, silver,
)
from riskloom.functions import flags, geo
from riskloom.operators import clean, detection, enrich, marts, rules

GEO_FLAGS = """is_cross_state is_night_transaction is_high_value is_high_velocity is_gps_mismatch
    is_risky_category is_online_high_value is_many_installments""".split()
STREAM_FLAGS = """is_pix_new_beneficiary is_high_value is_high_velocity is_high_accumulated is_location_jump
    is_manual_card_entry is_no_3ds_online""".split()


def _geo_flags(spark, sf):
    gapped = geo_feed(spark, sf).withColumn("distance_gps", geo.gps_gap())
    return gapped.withColumns(flags.geo_flags()).select("transaction_id", "distance_gps", *GEO_FLAGS)


def _sensitive_flags(spark, sf):
    return detection.sensitive_silver(geo_feed(spark, sf)).select(
        "transaction_id", "amount_clean", *flags.sensitive_flags()
    )


def _enriched(spark, sf):
    return enrich.enriched_detection(silver(spark, sf), devices(spark, sf), customers(spark, sf), as_of_date())


# Categories that the age rules ask for do not occur in the tables, so this input puts them in.
AGE_CATEGORIES = [*flags.JEWELLERY, *flags.GAMES_AND_CRYPTO]


def _age_rules(spark, sf):
    names = F.array(*map(F.lit, AGE_CATEGORIES))
    rows = silver(spark, sf).select(
        "transaction_id", F.element_at(names, (F.col("tx_hour") % len(AGE_CATEGORIES) + 1).cast("int")).alias("merchant_category"),
        (F.col("tx_dayofweek") * 12).alias("customer_age"), (F.col("amount") * 20).alias("amount"))
    return rows.select(
        "transaction_id", flags.minor_jewellery().alias("minor_jewellery"), flags.senior_games().alias("senior_games"),
        flags.minor_high_value().alias("minor_high_value"), flags.age_mismatch().alias("age_mismatch"))


def _stream_silver(spark, sf):
    return detection.stream_silver(feed(spark, sf))


def _load(spark, sf):
    return detection.stream_load(feed(spark, sf)).select(
        "transaction_id", "fraud_score_additional", "fraud_score_combined", "risk_level"
    )


def _joined_devices(spark, sf):
    return enrich.with_devices(silver(spark, sf).select("transaction_id", "device_id"), devices(spark, sf))


def _joined_customers(spark, sf):
    narrow = silver(spark, sf).select("transaction_id", "customer_id")
    return enrich.with_customers(narrow, customers(spark, sf), as_of_date())


def _summary(spark, sf):
    attributes = ["full_name", "tax_id_digits", "state_upper", "monthly_income", "income_band", "credit_score",
                  "credit_band", "is_premium", "pep"]
    return marts.customer_summary(gold(spark, sf), customers(spark, sf), attributes)


def _levels(spark, sf):
    return _summary(spark, sf).select("customer_id", "fraud_rate", "customer_risk_level")


def _methods(spark, sf):
    joined = enrich.join_distance_methods(silver(spark, sf), enrich.distance_methods())
    return joined.select("transaction_id", *[F.round(c, 3).alias(c) for c in ("planar_km", "haversine_km")])


def _haversine_pandas(spark, sf):
    points = ["purchase_latitude", "purchase_longitude", "device_latitude", "device_longitude"]
    km = geo.haversine_pandas()(*points)
    return silver(spark, sf).select("transaction_id", F.round(km, 3).alias("km"))


def _haversine_sql(spark, sf):
    geo.register_haversine(spark)
    km = "haversine(purchase_latitude, purchase_longitude, device_latitude, device_longitude)"
    return silver(spark, sf).select("transaction_id", F.round(F.expr(km), 3).alias("km"))


QUERIES = {
    "f01_high_risk_mcc": query(lambda s, d: feed(s, d).select(
        "transaction_id", flags.high_risk_mcc().alias("is_high_risk_mcc"))),
    "f_geo_flags": query(_geo_flags),
    "f_sensitive_flags": query(_sensitive_flags),
    "f_stream_flags": query(lambda s, d: _stream_silver(s, d).select("transaction_id", *STREAM_FLAGS)),
    "f24_age_rules": query(_age_rules),
    "f_device_age_flags": query(lambda s, d: _enriched(s, d).select(
        "transaction_id", "customer_age", "is_account_takeover", "is_age_mismatch")),
    "f25_alert_tags": query(lambda s, d: alerts(s, d).select("transaction_id", *flags.alert_tags())),
    "r1_batch_score": query(lambda s, d: rules.BATCH.apply(silver(s, d)).select(
        "transaction_id", "risk_points", "risk_level")),
    "r2_enriched_score": query(lambda s, d: _enriched(s, d).select(
        "transaction_id", "risk_points", "risk_level", "requires_review")),
    "r3_geo_score": query(lambda s, d: geo_scored(s, d).select(
        "transaction_id", "fraud_score", "risk_level")),
    "r3_geo_reporting": query(lambda s, d: detection.geo_reporting(geo_scored(s, d))),
    "r3_geo_alerts": query(lambda s, d: detection.geo_alerts(geo_scored(s, d))),
    "r4_sensitive_score": query(lambda s, d: detection.sensitive_detection(geo_feed(s, d)).select(
        "transaction_id", "fraud_score_calculated", "risk_level")),
    "r4_sensitive_raw_amount": query(lambda s, d: detection.sensitive_detection(geo_feed(s, d), "amount").select(
        "transaction_id", "fraud_score_calculated", "risk_level")),
    "r5_stream_points": query(lambda s, d: _stream_silver(s, d).select("transaction_id", "fraud_score_additional")),
    "r5b_stream_load_points": query(_load),
    "r6_combined_score": query(lambda s, d: _stream_silver(s, d).select(
        "transaction_id", "fraud_score_combined", "risk_level")),
    "r7_two_rules": query(lambda s, d: clean.keep_first(
        feed(s, d), "transaction_id", clean.TRANSACTION_ORDER).transform(rules.two_rule_level).select(
        "transaction_id", "transaction_hour", "high_value", "suspicious_hour", "risk_level")),
    "r8_review": query(lambda s, d: gold(s, d).select("transaction_id", "requires_review")),
    "r9_customer_level": query(_levels),
    "j1_devices": query(_joined_devices),
    "j2_customers": query(_joined_customers),
    "j3_customer_summary": query(_summary),
    "j4_distance_methods": query(_methods),
    "v1_haversine_pandas": query(_haversine_pandas),
    "v2_haversine_sql": query(_haversine_sql),
}

RAW_GAP = """sqrt((device_latitude - purchase_latitude) * (device_latitude - purchase_latitude)
    + (device_longitude - purchase_longitude) * (device_longitude - purchase_longitude))"""
GAP = half_up(RAW_GAP, 4)
HAVERSINE = """asin(sqrt(sin(radians(device_latitude - purchase_latitude) / 2) * sin(radians(device_latitude - purchase_latitude) / 2)
    + cos(radians(purchase_latitude)) * cos(radians(device_latitude))
    * sin(radians(device_longitude - purchase_longitude) / 2) * sin(radians(device_longitude - purchase_longitude) / 2))) * 12742"""

GEO_FLAG_SQL = f"""SELECT *, {GAP} AS distance_gps,
    coalesce(customer_home_state <> purchase_state AND NOT had_travel_purchase_last_12m, false) AS is_cross_state,
    tx_hour IN (2, 3, 4) AS is_night_transaction,
    coalesce(amount > avg_transaction_amount_30d * 5, false) AS is_high_value,
    coalesce(transactions_last_24h > 15, false) AS is_high_velocity,
    coalesce({GAP} > 20, false) AS is_gps_mismatch,
    coalesce(category IN ('electronics', 'airline_ticket'), false) AS is_risky_category,
    coalesce(is_online AND amount > 1000, false) AS is_online_high_value,
    coalesce(installments >= 10 AND amount > 500, false) AS is_many_installments"""
SENSITIVE_SQL = f"""SELECT *, abs(amount) AS amount_clean,
    coalesce(customer_home_state <> purchase_state, false) AS is_cross_state,
    tx_hour < 6 AS is_night_transaction,
    coalesce(abs(amount) > avg_transaction_amount_30d * 3, false) AS is_high_value,
    coalesce(amount > avg_transaction_amount_30d * 3, false) AS is_high_value_raw,
    coalesce(transactions_last_24h > 5, false) AS is_high_velocity,
    coalesce({GAP} > 5, false) AS is_gps_mismatch,
    coalesce(customer_home_state <> purchase_state AND NOT had_travel_purchase_last_12m, false) AS is_cross_state_no_travel
    FROM silver"""
SPEED_FLAGS = """coalesce(time_since_last_tx < 60 AND distance_km_from_prev > 555 AND prev_state <> purchase_state, false)
    AS is_cloning_suspect, coalesce(velocity_kmh > 900, false) AS is_impossible_velocity"""


def _sum(points: dict[str, int]) -> str:
    return " + ".join(f"CASE WHEN {c} THEN {p} ELSE 0 END" for c, p in points.items())


_C, _N, _H, _V, _G = "is_cross_state", "is_night_transaction", "is_high_value", "is_high_velocity", "is_gps_mismatch"
_R, _O, _M, _T = "is_risky_category", "is_online_high_value", "is_many_installments", "NOT had_travel_purchase_last_12m"
GEO_POINTS = {
    _C: 2, _N: 3, _H: 3, _V: 5, _G: 5, "is_first_purchase_in_state": 2, "is_international": 4, _R: 4, _O: 5, _M: 4,
    "is_cloning_suspect": 25, "is_impossible_velocity": 40,
    f"{_G} AND {_H}": 10, f"{_G} AND {_N}": 8, f"{_V} AND {_H}": 8, f"{_C} AND {_T}": 12, f"{_R} AND {_H}": 12,
    f"{_R} AND {_N}": 8, f"{_O} AND {_N}": 10, f"{_O} AND {_R}": 15, f"{_M} AND {_R}": 12,
    f"{_G} AND {_H} AND {_N}": 25, f"{_G} AND {_C} AND {_T}": 30, f"{_V} AND {_G} AND {_H}": 35,
    f"{_N} AND {_V} AND {_C} AND {_T}": 40, f"{_R} AND {_H} AND {_N}": 20, f"{_O} AND {_R} AND {_N}": 25,
    f"{_M} AND {_R} AND {_O}": 30,
}
GEO_CTES = {
    "geo_flagged": GEO_FLAG_SQL + f", {SPEED_FLAGS} FROM speeds",
    "geo_pointed": f"SELECT * EXCLUDE (fraud_score), abs(amount) AS amount_clean, {_sum(GEO_POINTS)} AS fraud_score FROM geo_flagged",
    "geo_scored": """SELECT *, CASE WHEN fraud_score >= 50 THEN 'CRITICAL' WHEN fraud_score >= 30 THEN 'HIGH'
        WHEN fraud_score >= 18 THEN 'MEDIUM' WHEN fraud_score >= 10 THEN 'LOW' ELSE 'NORMAL' END AS risk_level
        FROM geo_pointed""",
}


def sensitive_score(high_value: str) -> str:
    points = _sum({
        _C: 15, _N: 10, high_value: 20, _V: 15, _G: 25, "is_cross_state_no_travel": 30,
        "is_first_purchase_in_state": 10, "is_international": 15,
    })
    return f"""SELECT transaction_id, p AS fraud_score_calculated, CASE WHEN p >= 70 THEN 'CRITICAL'
        WHEN p >= 50 THEN 'HIGH' WHEN p >= 30 THEN 'MEDIUM' WHEN p >= 15 THEN 'LOW' ELSE 'NORMAL' END AS risk_level
        FROM (SELECT transaction_id, {points} AS p FROM sensitive)"""


_MINOR_JEWEL = "age < 18 AND merchant_category IN ('Joias', 'Joalheria', 'Luxury', 'Joias e Relógios') AND amount > 10000"
_SENIOR_GAMES = """age > 75 AND merchant_category IN ('Games', 'Jogos', 'Gaming', 'Criptomoedas', 'Crypto')
    AND amount > 2000"""
_MINOR_HIGH = "age < 18 AND amount > 5000"
ENRICHED_CTE = f"""SELECT p.*, d.is_trusted, d.is_rooted, d.is_emulator, d.risk_score, c.age, common_points
      + CASE WHEN NOT d.is_trusted AND amount > 500 THEN 25 ELSE 0 END
      + CASE WHEN d.is_rooted OR d.is_emulator THEN 30 ELSE 0 END
      + CASE WHEN d.risk_score > 80 THEN 15 WHEN d.risk_score > 60 THEN 8 ELSE 0 END
      + CASE WHEN {_MINOR_JEWEL} THEN 20 ELSE 0 END + CASE WHEN {_SENIOR_GAMES} THEN 15 ELSE 0 END
      + CASE WHEN {_MINOR_HIGH} THEN 15 ELSE 0 END AS risk_points
    FROM pointed p LEFT JOIN devices d ON p.device_id = d.device_id
      LEFT JOIN customers c ON p.customer_id = c.customer_id"""
ENRICHED_LEVEL = """SELECT *, CASE WHEN risk_points >= 50 THEN 'CRITICAL' WHEN risk_points >= 30 THEN 'HIGH'
    WHEN risk_points >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM enriched"""

ORACLE = {
    "f01_high_risk_mcc": check("fx_tx", """SELECT transaction_id,
        CASE WHEN mcc_risk_level IS NULL THEN NULL ELSE mcc_risk_level IN ('high', 'HIGH') END AS is_high_risk_mcc
        FROM fx_tx"""),
    "f_geo_flags": check("silver", f"SELECT transaction_id, distance_gps, {', '.join(GEO_FLAGS)} FROM flagged",
                         flagged=GEO_FLAG_SQL + " FROM silver"),
    "f_sensitive_flags": check("silver", f"""SELECT transaction_id, amount_clean, is_cross_state, is_night_transaction,
        is_high_value, is_high_velocity, is_gps_mismatch, is_cross_state_no_travel FROM sensitive""",
                               sensitive=SENSITIVE_SQL),
    "f_stream_flags": check("stream", f"SELECT transaction_id, {', '.join(STREAM_FLAGS)} FROM stream_silver"),
    "f24_age_rules": check("silver", """SELECT transaction_id, jewellery AS minor_jewellery, games AS senior_games,
        high AS minor_high_value, jewellery OR games OR high AS age_mismatch FROM ruled""",
        aged=f"""SELECT transaction_id, ([{", ".join(repr(c) for c in AGE_CATEGORIES)}])[tx_hour % {len(AGE_CATEGORIES)} + 1] AS category,
          tx_dayofweek * 12 AS age, amount * 20 AS high_amount FROM silver""",
        ruled="""SELECT transaction_id, age < 18 AND category IN ('Joias', 'Joalheria', 'Luxury', 'Joias e Relógios') AND high_amount > 10000 AS jewellery,
          age > 75 AND category IN ('Games', 'Jogos', 'Gaming', 'Criptomoedas', 'Crypto') AND high_amount > 2000 AS games,
          age < 18 AND high_amount > 5000 AS high FROM aged"""),
    "f_device_age_flags": check("enriched", f"""SELECT transaction_id, age AS customer_age,
        (NOT is_trusted AND amount > 500) OR is_rooted OR is_emulator AS is_account_takeover,
        ({_MINOR_JEWEL}) OR ({_SENIOR_GAMES}) OR ({_MINOR_HIGH}) AS is_age_mismatch FROM enriched""",
                                enriched=ENRICHED_CTE),
    "f25_alert_tags": check("alerts", """SELECT transaction_id, flag_time, flag_beneficiary, flag_mcc, flag_location
        FROM alerts"""),
    "r1_batch_score": check("gold", "SELECT transaction_id, risk_points, risk_level FROM gold"),
    "r2_enriched_score": check("enriched", """SELECT transaction_id, risk_points, risk_level,
        risk_level IN ('CRITICAL', 'HIGH') OR is_fraud AS requires_review FROM leveled""",
                               enriched=ENRICHED_CTE, leveled=ENRICHED_LEVEL),
    "r3_geo_score": check("movement", "SELECT transaction_id, fraud_score, risk_level FROM geo_scored", **GEO_CTES),
    "r3_geo_reporting": check("movement", """SELECT transaction_id, customer_id, amount_clean AS amount,
        merchant_name AS merchant, category, fraud_score, risk_level, is_fraud FROM geo_scored""", **GEO_CTES),
    "r3_geo_alerts": check("movement", """SELECT transaction_id, customer_id, amount_clean AS amount,
        merchant_name AS merchant, fraud_score, risk_level, is_fraud, customer_home_state, purchase_state
        FROM geo_scored WHERE fraud_score >= 30""", **GEO_CTES),
    "r4_sensitive_score": check("silver", sensitive_score("is_high_value"), sensitive=SENSITIVE_SQL),
    "r4_sensitive_raw_amount": check("silver", sensitive_score("is_high_value_raw"), sensitive=SENSITIVE_SQL),
    "r5_stream_points": check("stream", "SELECT transaction_id, fraud_score_additional FROM stream_silver"),
    "r5b_stream_load_points": check("stream", """SELECT transaction_id, load_points AS fraud_score_additional,
        load_combined AS fraud_score_combined, load_level AS risk_level FROM stream_silver"""),
    "r6_combined_score": check("stream", "SELECT transaction_id, fraud_score_combined, risk_level FROM stream_silver"),
    "r7_two_rules": check("silver", """SELECT transaction_id, tx_hour AS transaction_hour,
        coalesce(amount > 1000, false) AS high_value, tx_hour BETWEEN 2 AND 5 AS suspicious_hour,
        CASE WHEN amount > 1000 AND tx_hour BETWEEN 2 AND 5 THEN 'HIGH'
          WHEN amount > 1000 OR tx_hour BETWEEN 2 AND 5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM silver"""),
    "r8_review": check("gold", "SELECT transaction_id, requires_review FROM gold"),
    "j1_devices": check("enriched", """SELECT s.transaction_id, s.device_id, d.is_trusted AS device_is_trusted,
        d.is_rooted AS device_is_rooted, d.is_emulator AS device_is_emulator, d.risk_score AS device_risk_score,
        d.device_risk_category FROM silver s LEFT JOIN devices d ON s.device_id = d.device_id"""),
    "j2_customers": check("enriched", """SELECT s.transaction_id, s.customer_id, c.age AS customer_age,
        c.monthly_income AS customer_income, c.income_band AS customer_income_band,
        c.is_premium AS customer_is_premium FROM silver s LEFT JOIN customers c ON s.customer_id = c.customer_id"""),
    "j4_distance_methods": check("silver", f"""SELECT transaction_id, {half_up(RAW_GAP + " * 111", 3)} AS planar_km,
        {half_up(HAVERSINE, 3)} AS haversine_km FROM silver"""),
    "v1_haversine_pandas": check("silver", f"SELECT transaction_id, {half_up(HAVERSINE, 3)} AS km FROM silver"),
    "v2_haversine_sql": check("silver", f"SELECT transaction_id, {half_up(HAVERSINE, 3)} AS km FROM silver"),
}
