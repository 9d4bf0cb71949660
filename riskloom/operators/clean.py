"""Cleaning and standardising: the step from Bronze to Silver."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import flags, ladders, text
from riskloom.functions.measures import finite

# Which copy of a transaction is kept: the earliest, then by content.
TRANSACTION_ORDER = ["timestamp", "amount", "device_id", "merchant_name", "merchant_category"]


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in ``order`` (nulls first).

    Filtering on ``row_number() = 1`` lets Spark drop all but the first row of each key before the
    shuffle as well, so a key with very many copies reaches the final task as one row per map task.
    """
    ranked = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_place", F.row_number().over(ranked)).where("_place = 1").drop("_place")


def keep_any(df: DataFrame, key: str) -> DataFrame:
    """One arbitrary row per key."""
    return df.dropDuplicates([key])


def require(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def positive_amounts(df: DataFrame, amount: str = "amount") -> DataFrame:
    return df.where(F.col(amount) > 0)


def clean_amount(amount: str = "amount") -> Column:
    """Negative amounts count as their absolute value, in whole cents; what is no number is null."""
    return F.round(F.abs(finite(amount)), 2)


def calendar(time: Column) -> dict[str, Column]:
    day = F.dayofweek(time)
    hour = F.hour(time)
    return {
        "timestamp_dt": time,
        "tx_date": F.to_date(time),
        "tx_year": F.year(time),
        "tx_month": F.month(time),
        "tx_hour": hour,
        "tx_dayofweek": day,
        "is_weekend": flags.flag(day.isin(1, 7)),
        "period_of_day": ladders.period_of_day(hour),
    }


def standard_columns(time: str = "timestamp") -> dict[str, Column]:
    """All columns the Silver table adds; malformed times give null calendar fields."""
    amount = F.round(F.col("amount"), 2)
    return {
        **calendar(F.try_to_timestamp(F.col(time))),
        "amount": amount,
        "amount_range": ladders.bucket(amount, ladders.AMOUNT_RANGE),
        "is_high_risk_mcc": flags.high_risk_mcc(),
        "fraud_score_category": ladders.bucket(F.col("fraud_score"), ladders.SCORE_CATEGORY),
        "channel_upper": text.upper_trimmed(F.col("channel")),
        "type_upper": text.upper_trimmed(F.col("type")),
        "card_brand_upper": text.upper_trimmed(F.col("card_brand")),
    }


def silver_transactions(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """De-duplicated, standardised transactions. One shuffle, by transaction."""
    order = [c for c in (order or TRANSACTION_ORDER) if c in df.columns]
    return keep_first(df, "transaction_id", order).withColumns(standard_columns())


def simple_transactions(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Short form: unique, complete, positive, merchant trimmed."""
    order = [c for c in (order or TRANSACTION_ORDER) if c in df.columns]
    unique = keep_first(df, "transaction_id", order)
    kept = positive_amounts(require(unique, "transaction_id", "customer_id", "amount"))
    return kept.withColumn("merchant_name", F.trim("merchant_name"))


def simple_customers(df: DataFrame) -> DataFrame:
    """Short form: unique customers that have an e-mail address, text trimmed."""
    unique = require(keep_first(df, "customer_id", _other_columns(df, "customer_id")), "customer_id", "email")
    tidy = {"email": text.lower_trimmed(F.col("email"))}
    tidy.update({c: F.trim(c) for c in ("full_name", "city") if c in df.columns})
    return unique.withColumns(tidy)


def silver_customers(df: DataFrame) -> DataFrame:
    """Customer dimension; steps whose input column is absent are left out."""
    steps = {
        "tax_id_digits": ("tax_id", lambda c: text.digits_only(c)),
        "mobile_phone_digits": ("mobile_phone", lambda c: text.digits_only(c)),
        "postcode_digits": ("postcode", lambda c: text.digits_only(c)),
        "birth_date_dt": ("birth_date", lambda c: F.to_date(F.try_to_timestamp(c))),
        "registered_dt": ("registered_at", lambda c: F.to_date(F.try_to_timestamp(c))),
        "state_upper": ("state", lambda c: text.upper_trimmed(c)),
        "city_clean": ("city", lambda c: F.trim(c)),
        "name_upper": ("full_name", lambda c: text.upper_trimmed(c)),
        "email_lower": ("email", lambda c: text.lower_trimmed(c)),
        "monthly_income": ("monthly_income", lambda c: F.round(c, 2)),
        "credit_limit": ("credit_limit", lambda c: F.round(c, 2)),
        "income_band": ("monthly_income", lambda c: ladders.bucket(F.round(c, 2), ladders.INCOME_BAND)),
        "credit_band": ("credit_score", lambda c: ladders.bucket(c, ladders.CREDIT_BAND)),
    }
    unique = keep_first(df, "customer_id", _other_columns(df, "customer_id"))
    return unique.withColumns({
        name: build(F.col(source)) for name, (source, build) in steps.items() if source in df.columns
    })


def device_risk_category() -> Column:
    return (
        F.when(F.col("is_rooted") | F.col("is_emulator"), "HIGH_RISK")
        .when(F.col("risk_score") > 70, "MEDIUM_RISK")
        .otherwise("LOW_RISK")
    )


def silver_devices(df: DataFrame) -> DataFrame:
    seen = {f"{c}_ts": F.try_to_timestamp(F.col(c)) for c in ("first_seen", "last_seen") if c in df.columns}
    unique = keep_first(df, "device_id", _other_columns(df, "device_id"))
    return unique.withColumns({
        **seen,
        "os_full": text.joined(F.col("os_name"), F.col("os_version")),
        "device_risk_category": device_risk_category(),
    })


def _other_columns(df: DataFrame, key: str) -> list[str]:
    return [c for c in df.columns if c != key]
