"""Date spine with calendar attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyframe.functions.dates import date_key
from tallyframe.operators.asof import date_spine


def calendar(bounds: DataFrame, lo: str, hi: str) -> DataFrame:
    d = F.col("date_day")
    return date_spine(bounds, lo, hi, "date_day").select(
        "date_day", date_key(d).alias("date_key"), F.year(d).alias("year_number"), F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"), F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("iso_week"), F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"), F.date_format(d, "yyyyMM").alias("fiscal_period"))
