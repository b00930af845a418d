"""Date and merchant dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalars import date_key, surrogate_key, weekday
from riskloom.schemas import CALENDAR


def dim_date(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    """One row per calendar day."""
    bounds = F.lit(first).cast("date"), F.lit(last).cast("date")
    days = spark.range(1).select(
        F.explode(F.sequence(*bounds, F.expr("interval 1 day"))).alias("full_date")
    )
    day = F.col("full_date")
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        weekday(day).isin(0, 6).alias("is_weekend"),
    )


def dim_merchant(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("merchant_id").alias("merchant_sk"),
        "merchant_id",
        "merchant_name",
        "category",
        "country",
        F.col("created_at").cast("timestamp").alias("created_at"),
    )
