"""Behavioural flags.

``flag`` turns a null condition into false. Thresholds that differ between rule packs are arguments.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
RISKY_CATEGORIES = ["electronics", "airline_ticket"]
JEWELLERY = ["Joias", "Joalheria", "Luxury", "Joias e Relógios"]
GAMES_AND_CRYPTO = ["Games", "Jogos", "Gaming", "Criptomoedas", "Crypto"]


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def high_risk_mcc(level: str = "mcc_risk_level") -> Column:
    """Null stays null."""
    return F.col(level).isin("high", "HIGH")


def other_state() -> Column:
    return F.col("customer_home_state") != F.col("purchase_state")


def cross_state() -> Column:
    return flag(other_state())


def cross_state_no_travel() -> Column:
    return flag(other_state() & ~F.col("had_travel_purchase_last_12m"))


def hour_in(first: int, last: int, hour: str = "transaction_hour") -> Column:
    """Hour between ``first`` and ``last``, both inclusive."""
    return flag(F.col(hour).between(first, last))


def night(hour: str = "transaction_hour") -> Column:
    """From 2:00 up to, not including, 5:00; hours may carry a fraction."""
    return flag((F.col(hour) >= 2) & (F.col(hour) < 5))


def before_six(hour: str = "transaction_hour") -> Column:
    return flag(F.col(hour) < 6)


def above_average(times: float, amount: str = "amount") -> Column:
    """Amount beyond ``times`` the 30-day average. Packs differ in using the raw or the cleaned amount."""
    return flag(F.col(amount) > F.col("avg_transaction_amount_30d") * times)


def amount_over(limit: float, amount: str = "amount") -> Column:
    return flag(F.col(amount) > limit)


def busy_day(limit: int) -> Column:
    return flag(F.col("transactions_last_24h") > limit)


def heavy_day(limit: float = 10000) -> Column:
    return flag(F.col("accumulated_amount_24h") > limit)


def location_jump(km: float = 100) -> Column:
    return flag(F.col("distance_from_last_txn_km") > km)


def gps_mismatch(degrees: float, gap: str = "distance_gps") -> Column:
    return flag(F.col(gap) > degrees)


def pix_new_beneficiary() -> Column:
    return flag((F.col("type") == "PIX") & F.col("new_beneficiary"))


def manual_entry() -> Column:
    return flag(F.col("card_entry") == "MANUAL")


def web_without_3ds() -> Column:
    return flag((F.col("channel") == "WEB_BANKING") & ~F.col("auth_3ds"))


def risky_category() -> Column:
    return flag(F.col("category").isin(*RISKY_CATEGORIES))


def online_high_value(limit: float = 1000) -> Column:
    return flag(F.col("is_online") & (F.col("amount") > limit))


def many_installments(count: int = 10, limit: float = 500) -> Column:
    return flag((F.col("installments") >= count) & (F.col("amount") > limit))


def cloning_suspect(minutes: float = 60, km: float = 555) -> Column:
    """Another state, far away, soon after the previous transaction of the customer."""
    return flag(
        (F.col("time_since_last_tx") < minutes)
        & (F.col("distance_km_from_prev") > km)
        & (F.col("prev_state") != F.col("purchase_state"))
    )


def impossible_velocity(kmh: float = 900) -> Column:
    return flag(F.col("velocity_kmh") > kmh)


def account_takeover(limit: float = 500) -> Column:
    """Three-valued: unknown device facts leave the answer unknown unless another part is true."""
    return (
        (~F.col("device_is_trusted") & (F.col("amount") > limit))
        | F.col("device_is_rooted")
        | F.col("device_is_emulator")
    )


def minor_jewellery() -> Column:
    return (F.col("customer_age") < 18) & F.col("merchant_category").isin(*JEWELLERY) & (F.col("amount") > 10000)


def senior_games() -> Column:
    return (
        (F.col("customer_age") > 75)
        & F.col("merchant_category").isin(*GAMES_AND_CRYPTO)
        & (F.col("amount") > 2000)
    )


def minor_high_value() -> Column:
    return (F.col("customer_age") < 18) & (F.col("amount") > 5000)


def age_mismatch() -> Column:
    return minor_jewellery() | senior_games() | minor_high_value()


def alert_tags() -> dict[str, Column]:
    """Reason per alert column; null where the reason does not apply."""
    return {
        "flag_time": F.when(F.col("unusual_time"), "UNUSUAL_TIME"),
        "flag_beneficiary": F.when(F.col("new_beneficiary"), "NEW_BENEFICIARY"),
        "flag_mcc": F.when(F.col("is_high_risk_mcc"), "HIGH_RISK_MCC"),
        "flag_location": F.when(F.col("distance_from_last_txn_km") > 100, "LOCATION_JUMP"),
    }


def geo_flags(average_times: float = 5, per_day: int = 15, degrees: float = 20) -> dict[str, Column]:
    """Flags of the geo feed that need no history; ``distance_gps`` must be present."""
    return {
        "is_cross_state": cross_state_no_travel(),
        "is_night_transaction": night(),
        "is_high_value": above_average(average_times),
        "is_high_velocity": busy_day(per_day),
        "is_gps_mismatch": gps_mismatch(degrees),
        "is_risky_category": risky_category(),
        "is_online_high_value": online_high_value(),
        "is_many_installments": many_installments(),
    }


def sensitive_flags(amount: str = "amount_clean") -> dict[str, Column]:
    """Flags of the more sensitive geo pack."""
    return {
        "is_cross_state": cross_state(),
        "is_night_transaction": before_six(),
        "is_high_value": above_average(3, amount),
        "is_high_velocity": busy_day(5),
        "is_gps_mismatch": gps_mismatch(5),
        "is_cross_state_no_travel": cross_state_no_travel(),
    }


def stream_flags(amount: str = "amount_clean") -> dict[str, Column]:
    return {
        "is_pix_new_beneficiary": pix_new_beneficiary(),
        "is_high_value": amount_over(5000, amount),
        "is_high_velocity": busy_day(10),
        "is_high_accumulated": heavy_day(),
        "is_location_jump": location_jump(),
        "is_manual_card_entry": manual_entry(),
        "is_no_3ds_online": web_without_3ds(),
    }
