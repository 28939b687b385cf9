"""The date dimension, generated on executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import date_key

# The default range of the date dimension.
DEFAULT_START = "2025-01-01"
DEFAULT_END = "2026-12-31"

# Sunday and Saturday in Spark's day-of-week numbering.
WEEKEND = (1, 7)


def days_between(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One ``full_date`` row per day of the inclusive range held in a one-row frame."""
    days = F.sequence(F.to_date(start), F.to_date(end))
    return bounds.select(F.explode(days).alias("full_date"))


def date_range(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    return days_between(bounds)


def date_range_of(df: DataFrame, moment: Column) -> DataFrame:
    """The days from the first to the last ``moment`` of a table."""
    return days_between(df.agg(F.min(moment).alias("start_date"), F.max(moment).alias("end_date")))


def calendar_columns(days: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Calendar parts of each ``full_date``, in one projection."""
    day = F.col("full_date")
    stamp = F.current_timestamp() if load_ts is None else load_ts
    return days.select(
        day,
        date_key(day).alias("date_key"),
        day.alias("calendar_date"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofmonth(day).alias("day_number"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter_name"),
        F.year(day).alias("year_number"),
        F.dayofweek(day).isin(*WEEKEND).alias("is_weekend"),
        stamp.alias("created_timestamp"),
        stamp.alias("updated_timestamp"),
    )


def dim_date(
    spark: SparkSession,
    start: str = DEFAULT_START,
    end: str = DEFAULT_END,
    load_ts: Column | None = None,
) -> DataFrame:
    return calendar_columns(date_range(spark, start, end), load_ts)
