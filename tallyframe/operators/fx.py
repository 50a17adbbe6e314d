"""Exchange rates: quotation, daily fill, conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.functions.numbers import converted, safe_divide
from tallyframe.operators.latest import latest_flag


def normalize_quotes(quotes: DataFrame, base: str) -> DataFrame:
    """Direct and inverse rows from (currency, rate_date, quoted, method).

    ``divide`` quotations give currency units per base unit. The newest rate of each
    direction is flagged.
    """
    direct = F.when(F.col("method") == "divide", safe_divide(F.lit(1.0), "quoted")).otherwise(F.col("quoted"))
    q = quotes.withColumn("_d", direct)
    sides = F.array(
        F.struct(F.col("currency").alias("from_currency"), F.lit(base).alias("to_currency"),
                 F.col("_d").alias("exchange_rate"), F.lit(False).alias("is_inverse_rate")),
        F.struct(F.lit(base).alias("from_currency"), F.col("currency").alias("to_currency"),
                 safe_divide(F.lit(1.0), "_d").alias("exchange_rate"), F.lit(True).alias("is_inverse_rate")))
    rows = q.select("rate_date", F.explode(sides).alias("s")).select("rate_date", "s.*")
    return latest_flag(rows, ["from_currency", "to_currency"], ["rate_date"])


def daily_rates(series: DataFrame, base: str, reference: DataFrame | None = None) -> DataFrame:
    """Rate per currency and calendar day, filled forward, plus the base currency at 1.

    ``series`` has one row per (currency, rate_date); ``reference`` is a single row with
    ``max_date`` up to which the calendar must reach. Each quote is spread over the days
    until the next one, so no day grid and no as-of search is needed. Days before the
    first quote of a currency stay without rate.
    """
    ends = series.agg(F.struct(F.min("rate_date").alias("lo"), F.max("rate_date").alias("hi")).alias("b")).scalar()
    lo, hi = ends["lo"], ends["hi"]
    if reference is not None:
        hi = F.greatest(hi, reference.select("max_date").scalar())
    w = Window.partitionBy("currency").orderBy("rate_date")
    quotes = series.select(
        "currency", "rate_date", "exchange_rate", F.lead("rate_date").over(w).alias("_next"),
        F.row_number().over(w).alias("_n"), lo.alias("_lo"), hi.alias("_hi"))
    held = F.sequence("rate_date", F.coalesce(F.date_sub("_next", 1), "_hi"))
    before = F.when((F.col("_n") == 1) & (F.col("_lo") < F.col("rate_date")),
                    F.sequence("_lo", F.date_sub("rate_date", 1))).otherwise(F.array().cast("array<date>"))
    days = F.concat(F.transform(held, lambda d: F.struct(d.alias("day"), F.lit(True).alias("known"))),
                    F.transform(before, lambda d: F.struct(d.alias("day"), F.lit(False).alias("known"))))
    spread = quotes.select("currency", "rate_date", "exchange_rate", F.explode(days).alias("d"))
    known = F.col("d.known")
    market = spread.select(
        "currency", F.col("d.day").alias("calendar_date"), F.when(known, F.col("rate_date")).alias("rate_date"),
        F.when(known, F.col("exchange_rate")).alias("exchange_rate"), F.lit("feed").alias("rate_source"),
        F.lit(False).alias("is_same_currency"), known.alias("has_market_rate"),
        (known & (F.col("rate_date") < F.col("d.day"))).alias("is_rate_filled_forward"))
    own = series.sparkSession.range(1, numPartitions=1).select(lo.alias("_lo"), hi.alias("_hi")).select(
        F.lit(base).alias("currency"), F.explode(F.sequence("_lo", "_hi")).alias("calendar_date")).select(
        "currency", "calendar_date", F.col("calendar_date").alias("rate_date"),
        F.lit(1).cast("decimal(18,6)").alias("exchange_rate"), F.lit("self").alias("rate_source"),
        F.lit(True).alias("is_same_currency"), F.lit(True).alias("has_market_rate"),
        F.lit(False).alias("is_rate_filled_forward"))
    return market.unionByName(own)


def attach_rate(facts: DataFrame, daily: DataFrame, currency: Column, day: Column, out: str) -> DataFrame:
    """Daily rate of the row's currency and day as column ``out``."""
    side = daily.select(F.col("currency").alias("_c"), F.col("calendar_date").alias("_d"), F.col("exchange_rate").alias(out))
    return facts.join(side, (currency == F.col("_c")) & (day == F.col("_d")), "left").drop("_c", "_d")


def group_amount(base_currency: Column, group: str, base_amount: Column, base_rate: Column,
                 document_amount: Column, document_rate: Column) -> Column:
    """Amount in group currency: books amount as is, books amount converted, document
    amount converted, document amount as is - the first that applies. The books amount is
    NULL where nothing was booked."""
    own = F.coalesce(base_currency, F.lit(group)) == group
    books = (F.when(own, base_amount.cast("decimal(20,2)")).otherwise(converted(base_amount, base_rate)))
    return F.coalesce(books, converted(document_amount, document_rate), document_amount.cast("decimal(20,2)"))
