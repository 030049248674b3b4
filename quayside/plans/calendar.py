"""Business calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.dates import cob_of
from quayside.operators.merge import merge_upsert


def calendar(span: DataFrame, holidays: DataFrame) -> DataFrame:
    """``(my_date, is_bank_holiday, next_business_day, cob_id)`` for every day of
    ``span`` (one row: first and last date). ``holidays`` is one date column.

    The next business day is the first later day that is neither on a weekend nor
    a holiday; three days past the end are generated for the last rows. The window
    runs over the days of a calendar, whose number is fixed by its span and does
    not grow with any data.
    """
    first, last = (F.col(c) for c in span.columns)
    days = span.select(
        last.alias("_last"), F.explode(F.sequence(first, F.date_add(last, 3))).alias("my_date")
    )
    off = holidays.select(F.col(holidays.columns[0]).cast("date").alias("my_date")).distinct()
    off = off.withColumn("_off", F.lit(True))
    marked = days.join(off, "my_date", "left").withColumn(
        "is_bank_holiday", F.coalesce("_off", F.lit(False)) & (F.col("my_date") <= F.col("_last"))
    )
    working = ~F.dayofweek("my_date").isin(1, 7) & ~F.col("is_bank_holiday")
    later = Window.orderBy("my_date").rowsBetween(1, Window.unboundedFollowing)
    following = F.first(F.when(working, F.col("my_date")), ignorenulls=True).over(later)
    return (
        marked.withColumn("next_business_day", following)
        .where(F.col("my_date") <= F.col("_last"))
        .select("my_date", "is_bank_holiday", "next_business_day", cob_of("my_date").alias("cob_id"))
    )


def default_span(as_of: DataFrame, years: int = 3) -> DataFrame:
    """January 1 ``years`` back to December 31 ``years`` ahead of a one-row date."""
    year = F.year(F.col(as_of.columns[0]))
    return as_of.select(
        F.make_date(year - years, F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(year + years, F.lit(12), F.lit(31)).alias("last_day"),
    )


def stored_calendar(days: DataFrame) -> DataFrame:
    """Calendar rows with their date parts, as the stored table keeps them."""
    d = F.col("my_date")
    return days.distinct().select(
        "cob_id",
        "my_date",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMM").alias("month_name"),
        F.day(d).alias("day_of_mon"),
        F.date_format(d, "E").alias("day_week_name"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        "is_bank_holiday",
        "next_business_day",
    )


def merge_calendar(stored: DataFrame, days: DataFrame, as_of: Column) -> DataFrame:
    """Update known days, add new ones; days are never removed."""
    return merge_upsert(stored, stored_calendar(days), ["cob_id"], as_of=as_of)
