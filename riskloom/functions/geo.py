"""Distances between two points given in degrees."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values
KM_PER_DEGREE = 111
EARTH_RADIUS_KM = 6371


def planar_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = lat1 - lat2, lon1 - lon2
    return F.sqrt(dlat * dlat + dlon * dlon)


def planar_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return planar_degrees(lat1, lon1, lat2, lon2) * KM_PER_DEGREE


def gps_gap(digits: int = 4) -> Column:
    """Degrees between the device and the place of purchase."""
    gap = planar_degrees(
        F.col("device_latitude"), F.col("device_longitude"),
        F.col("purchase_latitude"), F.col("purchase_longitude"),
    )
    return F.round(gap, digits)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


def register_haversine(spark: SparkSession) -> None:
    """SQL function ``haversine(lat1, lon1, lat2, lon2)``; its body is inlined, so it stays in codegen."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION haversine(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
        RETURNS DOUBLE RETURN {2 * EARTH_RADIUS_KM} * asin(sqrt(
            power(sin(radians(lat2 - lat1) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2)))"""
    )


def haversine_pandas():
    """The same distance as an Arrow-batched Python function, for comparing the methods."""

    @F.pandas_udf("double")
    def distance(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
        a, b = np.radians(lat1), np.radians(lat2)
        chord = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
        return 2 * EARTH_RADIUS_KM * np.arcsin(np.sqrt(chord))

    return distance
