"""Left joins with the customer and device dimensions.

No broadcast is forced: Spark broadcasts a dimension whose measured size is below its threshold and
otherwise shuffles both sides, splitting skewed partitions. Dimensions must be unique per key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import flags, geo
from riskloom.operators import rules


def age_years(birth_date: Column, as_of: Column) -> Column:
    return F.floor(F.datediff(as_of, birth_date) / 365.25)


def with_devices(df: DataFrame, devices: DataFrame) -> DataFrame:
    facts = devices.select(
        "device_id",
        F.col("is_trusted").alias("device_is_trusted"),
        F.col("is_rooted").alias("device_is_rooted"),
        F.col("is_emulator").alias("device_is_emulator"),
        F.col("risk_score").alias("device_risk_score"),
        "device_risk_category",
    )
    return df.join(facts, "device_id", "left")


def with_customers(df: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    facts = customers.select(
        "customer_id",
        age_years(F.col("birth_date_dt"), as_of).alias("customer_age"),
        F.col("monthly_income").alias("customer_income"),
        F.col("income_band").alias("customer_income_band"),
        F.col("is_premium").alias("customer_is_premium"),
    )
    return df.join(facts, "customer_id", "left")


def enriched_detection(df: DataFrame, devices: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """Both joins, the enriched rule pack, the review flag and the two flags on device and age. Points are added up as soon as
    what they need is there, and what rules on age ask of the transaction is found before the joins, so that no join shuffles
    what only rules read."""
    points = rules.PLAIN.score_name
    plain = df.withColumns({points: rules.PLAIN.score(), **{name: F.expr(asked) for name, asked in rules.OF_ROW.items()}})
    met = with_devices(plain, devices).withColumn(points, rules.DEVICE.score(known=points))
    scored = rules.AGE.apply(with_customers(met, customers, as_of), known=points)
    return scored.drop(points, *rules.OF_ROW).withColumns({
        "requires_review": rules.needs_review(),
        "is_account_takeover": flags.account_takeover(),
        "is_age_mismatch": flags.age_mismatch(),
    })


def join_distance_methods(df: DataFrame, methods: dict[str, Column], key: str = "transaction_id") -> DataFrame:
    """One distance column per method, each computed on its own and joined by key.

    The joins meet on the unique transaction key, so no row is multiplied and all of them share one
    partitioning.
    """
    frames = [df.select(key, distance.alias(name)) for name, distance in methods.items()]
    joined = frames[0]
    for frame in frames[1:]:
        joined = joined.join(frame, key, "inner")
    return joined


def distance_methods() -> dict[str, Column]:
    """Planar and haversine kilometres between the device and the place of purchase."""
    points = [F.col(c) for c in (
        "purchase_latitude", "purchase_longitude", "device_latitude", "device_longitude")]
    return {"planar_km": geo.planar_km(*points), "haversine_km": geo.haversine_km(*points)}
