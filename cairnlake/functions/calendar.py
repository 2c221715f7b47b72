"""The generated calendar dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.functions.keys import date_id

# The calendar's default reach, fiscal year start and unknown member.
DEFAULT_START = "2024-01-01"
DEFAULT_END = "2027-12-31"
FISCAL_START_MONTH = 4
UNKNOWN_DATE_ID = "-1"
UNKNOWN_TEXT = "Unknown"
UNKNOWN_TEXT_COLUMNS = ("day_name", "month_name", "month_year", "quarter_name")


def weekday_from_monday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def fiscal_month(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """Month number counted from the start of the fiscal year."""
    return F.month(F.add_months(day, 1 - start_month))


def fiscal_year(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """Calendar year in which the fiscal year of ``day`` began."""
    return F.year(F.add_months(day, 1 - start_month))


def fiscal_quarter(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.quarter(F.add_months(day, 1 - start_month))


def date_attributes(day: Column, fiscal_start_month: int = FISCAL_START_MONTH) -> dict[str, Column]:
    """The calendar's descriptive columns for one date expression, in table order."""
    quarter = F.concat(F.lit("Q"), F.quarter(day).cast("string"))
    return {
        "full_date": day,
        "date_id": date_id(day),
        "day_of_month": F.day(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_short_name": F.date_format(day, "EEE"),
        "day_of_week": weekday_from_monday(day),
        "is_weekend": weekday_from_monday(day) > 5,
        "week_of_year": F.weekofyear(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_short_name": F.date_format(day, "MMM"),
        "month_year": F.date_format(day, "yyyy-MM"),
        "month_id": F.date_format(day, "yyyyMM"),
        "month_start_date": F.trunc(day, "month"),
        "month_end_date": F.last_day(day),
        "quarter_number": F.quarter(day),
        "quarter_name": quarter,
        "quarter_year": F.concat_ws("-", F.year(day).cast("string"), quarter),
        "calendar_year": F.year(day),
        "fiscal_year": fiscal_year(day, fiscal_start_month),
        "fiscal_month_number": fiscal_month(day, fiscal_start_month),
        "fiscal_quarter_number": fiscal_quarter(day, fiscal_start_month),
    }


def calendar_days(bounds: DataFrame) -> DataFrame:
    """Every day from ``first_day`` to ``last_day`` of a one-row frame."""
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))


def unknown_member(bounds: DataFrame, schema) -> DataFrame:
    """The row facts without a date point at: NULL everywhere but its key and labels."""
    fixed = {name: F.lit(UNKNOWN_TEXT) for name in UNKNOWN_TEXT_COLUMNS}
    fixed["date_id"] = F.lit(UNKNOWN_DATE_ID)
    return bounds.select(
        *[fixed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    )


def calendar(bounds: DataFrame, fiscal_start_month: int = FISCAL_START_MONTH) -> DataFrame:
    """Calendar between the bounds of a one-row frame, plus the unknown member."""
    days = calendar_days(bounds)
    known = days.select(
        *[c.alias(name) for name, c in date_attributes(F.col("full_date"), fiscal_start_month).items()]
    )
    return known.unionByName(unknown_member(bounds, known.schema))


def fixed_bounds(spark, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    """Bounds given as literals."""
    return spark.range(1).select(
        F.to_date(F.lit(start)).alias("first_day"), F.to_date(F.lit(end)).alias("last_day")
    )


def spanning_bounds(*dated: tuple[DataFrame, str]) -> DataFrame:
    """Whole calendar years covering every date in the given (frame, column) pairs.

    Each frame contributes one partially aggregated row, so nothing but the
    outermost dates is shuffled.
    """
    ends = [
        df.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi")) for df, c in dated
    ]
    both = reduce(DataFrame.unionByName, ends).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return both.select(
        F.trunc("lo", "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("last_day"),
    )
