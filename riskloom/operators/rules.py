"""Additive rule packs.

A pack is data: named conditions with points, and thresholds that turn the sum into a level. Conditions
are SQL text over the input columns, so a pack can be read, stored and changed without code. Scoring is
one projection; it never shuffles.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import flags, ladders


@dataclass(frozen=True)
class Rule:
    """Points for the first tier whose condition holds; a null condition gives none."""

    name: str
    tiers: tuple[tuple[str, int], ...]

    def points(self) -> Column:
        out = None
        for condition, points in self.tiers:
            hit = F.expr(condition)
            out = F.when(hit, points) if out is None else out.when(hit, points)
        return out.otherwise(0)


def rule(name: str, condition: str, points: int, *lower: tuple[str, int]) -> Rule:
    return Rule(name, ((condition, points), *lower))


@dataclass(frozen=True)
class RulePack:
    rules: tuple[Rule, ...]
    score_name: str
    levels: tuple[tuple[int, str], ...]
    lowest: str
    level_name: str = "risk_level"

    def score(self, known: str | None = None, of: tuple[Rule, ...] = ()) -> Column:
        """Sum of points; a column may be ``known`` to hold those ``of`` some of the rules."""
        parts = [F.col(known)] if known else []
        parts += [r.points() for r in self.rules if r not in of]
        total = parts[0]
        for points in parts[1:]:
            total = total + points
        return total

    def level(self, score: Column) -> Column:
        return ladders.floor_level(score, list(self.levels), self.lowest)

    def reasons(self) -> Column:
        """Names of the rules that gave points."""
        return F.array_compact(F.array(*[F.when(r.points() > 0, F.lit(r.name)) for r in self.rules]))

    def apply(self, df: DataFrame, **known) -> DataFrame:
        scored = df.withColumn(self.score_name, self.score(**known))
        return scored.withColumn(self.level_name, self.level(F.col(self.score_name)))


# All conditions, points and thresholds below.

_COMMON = (
    rule("unusual_time", "unusual_time", 15),
    rule("new_beneficiary", "new_beneficiary", 10),
    rule("high_risk_mcc", "is_high_risk_mcc", 20),
    rule("amount_over_5000", "amount > 5000", 15),
    rule("amount_over_10000", "amount > 10000", 15),
    rule("pix", "type = 'PIX'", 5),
    rule("no_3ds", "NOT auth_3ds", 10),
    rule("cvv_not_validated", "NOT cvv_validated", 10),
    rule("night", "period_of_day = 'NIGHT'", 10),
    rule("feed_score", "fraud_score > 70", 20, ("fraud_score > 50", 10)),
)
_FOUR_LEVELS = ((50, "CRITICAL"), (30, "HIGH"), (15, "MEDIUM"))

BATCH = RulePack(
    rules=_COMMON + (
        rule("distance", "distance_from_last_txn_km > 500", 20, ("distance_from_last_txn_km > 100", 10)),
        rule("transactions_24h", "transactions_last_24h > 20", 15, ("transactions_last_24h > 10", 8)),
        rule("accumulated_24h", "accumulated_amount_24h > 50000", 20, ("accumulated_amount_24h > 20000", 10)),
        rule("manual_entry", "card_entry = 'MANUAL'", 15),
    ),
    score_name="risk_points", levels=_FOUR_LEVELS, lowest="LOW",
)



def _category_in(names: list[str]) -> str:
    return f"merchant_category IN ({', '.join(repr(n) for n in names)})"


#: The rules of the enriched pack that read nothing of devices and customers.
PLAIN = RulePack(rules=_COMMON, score_name="_plain_points", levels=_FOUR_LEVELS, lowest="LOW")

_JEWELLERY, _GAMES = _category_in(flags.JEWELLERY), _category_in(flags.GAMES_AND_CRYPTO)
#: What rules on a customer's age ask of the transaction itself.
OF_ROW = {"_dear_jewellery": f"{_JEWELLERY} AND amount > 10000", "_dear_games": f"{_GAMES} AND amount > 2000"}


def _age_rules(jewellery: str, games: str) -> tuple[Rule, ...]:
    return (
        rule("minor_jewellery", f"customer_age < 18 AND {jewellery}", 20),
        rule("senior_games", f"customer_age > 75 AND {games}", 15),
        rule("minor_high_value", "customer_age < 18 AND amount > 5000", 15),
    )


_DEVICE = (
    rule("untrusted_device", "NOT device_is_trusted AND amount > 500", 25),
    rule("tampered_device", "device_is_rooted OR device_is_emulator", 30),
    rule("device_score", "device_risk_score > 80", 15, ("device_risk_score > 60", 8)),
)
ENRICHED = RulePack(rules=_COMMON + _DEVICE + _age_rules(*OF_ROW.values()), score_name="risk_points", levels=_FOUR_LEVELS, lowest="LOW")
#: The same in the steps of the joins: the rules on devices, and those on age over the columns of ``OF_ROW``.
DEVICE = RulePack(rules=_DEVICE, score_name="_plain_points", levels=_FOUR_LEVELS, lowest="LOW")
AGE = RulePack(rules=_age_rules(*OF_ROW), score_name="risk_points", levels=_FOUR_LEVELS, lowest="LOW")

_NO_TRAVEL = "NOT had_travel_purchase_last_12m"
GEO = RulePack(
    rules=(
        rule("cross_state", "is_cross_state", 2),
        rule("night", "is_night_transaction", 3),
        rule("high_value", "is_high_value", 3),
        rule("high_velocity", "is_high_velocity", 5),
        rule("gps", "is_gps_mismatch", 5),
        rule("first_in_state", "is_first_purchase_in_state", 2),
        rule("international", "is_international", 4),
        rule("risky_category", "is_risky_category", 4),
        rule("online_high", "is_online_high_value", 5),
        rule("installments", "is_many_installments", 4),
        rule("cloning", "is_cloning_suspect", 25),
        rule("impossible_velocity", "is_impossible_velocity", 40),
        rule("gps+high", "is_gps_mismatch AND is_high_value", 10),
        rule("gps+night", "is_gps_mismatch AND is_night_transaction", 8),
        rule("velocity+high", "is_high_velocity AND is_high_value", 8),
        # The batch cross-state flag already requires no travel, so this pair always comes with it.
        rule("cross+no_travel", f"is_cross_state AND {_NO_TRAVEL}", 12),
        rule("risky+high", "is_risky_category AND is_high_value", 12),
        rule("risky+night", "is_risky_category AND is_night_transaction", 8),
        rule("online+night", "is_online_high_value AND is_night_transaction", 10),
        rule("online+risky", "is_online_high_value AND is_risky_category", 15),
        rule("installments+risky", "is_many_installments AND is_risky_category", 12),
        rule("gps+high+night", "is_gps_mismatch AND is_high_value AND is_night_transaction", 25),
        rule("gps+cross+no_travel", f"is_gps_mismatch AND is_cross_state AND {_NO_TRAVEL}", 30),
        rule("velocity+gps+high", "is_high_velocity AND is_gps_mismatch AND is_high_value", 35),
        rule("night+velocity+cross+no_travel",
             f"is_night_transaction AND is_high_velocity AND is_cross_state AND {_NO_TRAVEL}", 40),
        rule("risky+high+night", "is_risky_category AND is_high_value AND is_night_transaction", 20),
        rule("online+risky+night", "is_online_high_value AND is_risky_category AND is_night_transaction", 25),
        rule("installments+risky+online",
             "is_many_installments AND is_risky_category AND is_online_high_value", 30),
    ),
    score_name="fraud_score",
    levels=((50, "CRITICAL"), (30, "HIGH"), (18, "MEDIUM"), (10, "LOW")), lowest="NORMAL",
)

SENSITIVE = RulePack(
    rules=(
        rule("cross_state", "is_cross_state", 15),
        rule("night", "is_night_transaction", 10),
        rule("high_value", "is_high_value", 20),
        rule("high_velocity", "is_high_velocity", 15),
        rule("gps", "is_gps_mismatch", 25),
        rule("cross_no_travel", "is_cross_state_no_travel", 30),
        rule("first_in_state", "is_first_purchase_in_state", 10),
        rule("international", "is_international", 15),
    ),
    score_name="fraud_score_calculated",
    levels=((70, "CRITICAL"), (50, "HIGH"), (30, "MEDIUM"), (15, "LOW")), lowest="NORMAL",
)

_PIX_NEW = rule("pix_new_beneficiary", "is_pix_new_beneficiary", 25)
_HIGH_VALUE = rule("high_value", "is_high_value", 15)
_HIGH_VELOCITY = rule("high_velocity", "is_high_velocity", 20)
_HIGH_ACCUMULATED = rule("high_accumulated", "is_high_accumulated", 15)
_LOCATION_JUMP = rule("location_jump", "is_location_jump", 25)
_MANUAL = rule("manual_entry", "is_manual_card_entry", 10)
_NO_3DS = rule("no_3ds_online", "is_no_3ds_online", 15)
_UNUSUAL = rule("unusual_time", "unusual_time", 10)
_MCC = rule("mcc_level", "mcc_risk_level = 'high'", 20, ("mcc_risk_level = 'medium'", 10))
_COMBINED_LEVELS = ((80, "CRITICAL"), (60, "HIGH"), (40, "MEDIUM"), (20, "LOW"))

STREAM = RulePack(
    rules=(_PIX_NEW, _HIGH_VALUE, _HIGH_VELOCITY, _HIGH_ACCUMULATED, _LOCATION_JUMP, _MANUAL, _NO_3DS,
           _UNUSUAL, _MCC),
    score_name="fraud_score_additional", levels=_COMBINED_LEVELS, lowest="NORMAL",
)
STREAM_LOAD = RulePack(
    rules=(_PIX_NEW, _HIGH_VALUE, _HIGH_VELOCITY, _LOCATION_JUMP, _MANUAL, _UNUSUAL, _MCC),
    score_name="fraud_score_additional", levels=_COMBINED_LEVELS, lowest="NORMAL",
)


def combine_scores(df: DataFrame, pack: RulePack = STREAM, weight: float = 0.5) -> DataFrame:
    """Feed score plus a share of the pack's points, and the level of the combination."""
    scored = df.withColumn(pack.score_name, pack.score())
    combined = F.round(F.col("fraud_score") + F.col(pack.score_name) * weight, 2)
    scored = scored.withColumn("fraud_score_combined", combined)
    return scored.withColumn(pack.level_name, pack.level(F.col("fraud_score_combined")))


def two_rule_level(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """High amount and suspicious hour: both give HIGH, one MEDIUM, none LOW."""
    hour = F.hour(F.try_to_timestamp(F.col(time)))
    flagged = df.withColumns({
        "transaction_hour": hour,
        "high_value": F.coalesce(F.col("amount") > 1000, F.lit(False)),
        "suspicious_hour": F.coalesce(hour.between(2, 5), F.lit(False)),
    })
    hits = F.col("high_value").cast("int") + F.col("suspicious_hour").cast("int")
    return flagged.withColumn("risk_level", ladders.floor_level(hits, [(2, "HIGH"), (1, "MEDIUM")], "LOW"))


def needs_review(level: str = "risk_level") -> Column:
    """Top two levels or known fraud. Null when the level is lower and the label is unknown."""
    return F.col(level).isin("CRITICAL", "HIGH") | F.col("is_fraud")


def customer_level() -> Column:
    """Level of a customer from its fraud rate (percent) and its count of high-risk transactions."""
    return (
        F.when(F.col("fraud_rate") > 5, "VERY_HIGH")
        .when(F.col("fraud_rate") > 2, "HIGH")
        .when(F.col("critical_risk_count") + F.col("high_risk_count") > 5, "MEDIUM")
        .otherwise("LOW")
    )
