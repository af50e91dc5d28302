"""Calendar parts, federal holidays and forecast horizons."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, SERIES


def parse_dates(df: DataFrame, column: str = DATE, fmt: str | None = None) -> DataFrame:
    """Text or timestamps to dates; what cannot be read becomes null."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "string":
        parsed = F.try_to_date(column, fmt) if fmt else F.col(column).try_cast("date")
    else:
        parsed = F.col(column).cast("date")
    return df.withColumn(column, parsed)


def calendar_parts(df: DataFrame, column: str = DATE) -> DataFrame:
    """Year, month, ISO week, day of week (Monday 0), day of year, quarter."""
    d = F.col(column)
    return df.withColumns({
        "year": F.year(d), "month": F.month(d), "week": F.weekofyear(d),
        "day_of_week": F.weekday(d), "day_of_year": F.dayofyear(d), "quarter": F.quarter(d)})


def calendar_flags(df: DataFrame, column: str = DATE) -> DataFrame:
    d = F.col(column)
    quarter = F.trunc(d, "quarter")
    return df.withColumns({
        "is_weekend": F.weekday(d) >= 5,
        "is_month_start": F.dayofmonth(d) == 1,
        "is_month_end": F.last_day(d) == d,
        "is_quarter_start": quarter == d,
        "is_quarter_end": F.date_sub(F.add_months(quarter, 3), 1) == d})


def cyclical(df: DataFrame) -> DataFrame:
    """Month and week as points on a circle."""
    turn = 2 * math.pi
    return df.withColumns({
        f"{part}_{name}": fn(F.lit(turn) * F.col(part) / F.lit(float(period)))
        for part, period in (("month", 12), ("week", 52)) for name, fn in (("sin", F.sin), ("cos", F.cos))})


def _nth_weekday(year: Column, month: int, weekday: str, nth: int) -> Column:
    before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(before, weekday), 7 * (nth - 1))


# US federal holidays. A day of the month, or the nth weekday of a
# month (-1: the last), and the first year it was observed on that rule.
FIXED_DAYS = (
    ("New Year's Day", 1, 1, None),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, None),
    ("Veterans Day", 11, 11, 1978),
    ("Christmas Day", 12, 25, None),
)
WEEKDAY_RULES = (
    ("Martin Luther King Jr. Day", 1, "MON", 3, 1986),
    ("Washington's Birthday", 2, "MON", 3, 1971),
    ("Memorial Day", 5, "MON", -1, 1971),
    ("Labor Day", 9, "MON", 1, None),
    ("Columbus Day", 10, "MON", 2, 1971),
    ("Thanksgiving Day", 11, "THU", 4, None),
)
HOLIDAY_NAMES = tuple(rule[0] for rule in FIXED_DAYS + WEEKDAY_RULES)


def _holiday_entries(year: Column) -> Column:
    """All holidays of one year, with the substitute day of those on a weekend."""
    entries = []

    def add(name: Column, day: Column, since: int | None, when: Column | None = None) -> None:
        keep = F.lit(True) if when is None else when
        if since is not None:
            keep = keep & (year >= since)
        entries.append(F.when(keep, F.struct(day.alias("Date"), name.alias("holiday_name"))))

    for name, month, day, since in FIXED_DAYS:
        date = F.make_date(year, F.lit(month), F.lit(day))
        add(F.lit(name), date, since)
        observed = F.lit(f"{name} (observed)")
        add(observed, F.date_sub(date, 1), since, F.weekday(date) == 5)
        add(observed, F.date_add(date, 1), since, F.weekday(date) == 6)
    for name, month, weekday, nth, since in WEEKDAY_RULES:
        if nth > 0:
            date = _nth_weekday(year, month, weekday, nth)
        else:
            date = F.next_day(F.date_sub(F.last_day(F.make_date(year, F.lit(month), F.lit(1))), 7), weekday)
        add(F.lit(name), date, since)
    return F.array(*entries)


def holiday_dim(years: DataFrame) -> DataFrame:
    """(Date, holiday_name) of the federal holidays in the years from ``y0`` to
    ``y1``, the columns of the one-row frame ``years``."""
    span = years.select(F.explode(F.sequence(F.col("y0").cast("int"), F.col("y1").cast("int") + 1)).alias("year"), "y0", "y1")
    days = span.select(F.explode(_holiday_entries(F.col("year"))).alias("h"), "y0", "y1").where("h is not null")
    # The year after the last one is there for a New Year's Day observed on 31 December.
    inside = days.where(F.year("h.Date").between(F.col("y0"), F.col("y1")))
    # Two rules can meet on one day; the day keeps one name, so a join adds no rows.
    return inside.groupBy(F.col("h.Date").alias("Date")).agg(F.min("h.holiday_name").alias("holiday_name"))


def years_of(df: DataFrame, column: str = DATE) -> DataFrame:
    return df.agg(F.year(F.min(column)).alias("y0"), F.year(F.max(column)).alias("y1"))


def holidays_of(df: DataFrame, column: str = DATE) -> DataFrame:
    return holiday_dim(years_of(df, column))


def holiday_flags(df: DataFrame, dim: DataFrame | None = None, column: str = DATE) -> DataFrame:
    """is_federal_holiday and holiday_name ('' otherwise) by exact date. The
    dimension has some twelve rows a year, hence the broadcast."""
    dim = holidays_of(df, column) if dim is None else dim
    named = dim.select(F.col("Date").alias(column), "holiday_name")
    return df.join(F.broadcast(named), column, "left").withColumns({
        "is_federal_holiday": F.col("holiday_name").isNotNull(),
        "holiday_name": F.coalesce("holiday_name", F.lit(""))})


def _iso_year(d: Column) -> Column:
    """Year of the Thursday in the date's week."""
    return F.year(F.date_add(F.trunc(d, "week"), 3))


def holiday_week_flag(df: DataFrame, dim: DataFrame | None = None, per_year: bool = False, column: str = DATE) -> DataFrame:
    """is_holiday_week: the ISO week number occurs among the federal holidays that
    are dates of the data, in any year or, with ``per_year``, in the same year.

    The holiday weeks come from the distinct dates, at most 53 numbers a year.
    """
    dim = holidays_of(df, column) if dim is None else dim
    d = F.col(column)
    dates = df.select(F.to_date(column).alias(column)).distinct()  # one row a day, whatever the column's grain
    hit = dates.join(F.broadcast(dim.select(F.col("Date").alias(column))), column, "left_semi")
    parts = {"_week": F.weekofyear(d), **({"_year": _iso_year(d)} if per_year else {})}
    weeks = hit.select(*[c.alias(n) for n, c in parts.items()]).distinct().withColumn("_hit", F.lit(True))
    return (df.withColumns(parts).join(F.broadcast(weeks), list(parts), "left")
            .withColumn("is_holiday_week", F.coalesce("_hit", F.lit(False))).drop("_hit", *parts))


def calendar_features(df: DataFrame, column: str = DATE, dates: DataFrame | None = None) -> DataFrame:
    """Parts, flags, cyclical values and holiday columns together.

    They depend on the date alone, so they are computed once per distinct date and
    broadcast: one row per calendar day. ``dates`` may name a smaller frame that has
    the same dates as ``df``.
    """
    days = (df if dates is None else dates).select(column).distinct()
    dim = holidays_of(days, column)
    known = holiday_week_flag(holiday_flags(
        cyclical(calendar_flags(calendar_parts(days, column), column)), dim, column), dim, column=column)
    return df.join(F.broadcast(known), column, "left")


def _horizon_dates(last: Column, weeks: int, anchor: str) -> Column:
    if anchor == "monday":
        first, until = F.trunc(F.date_add(last, 1), "week"), F.trunc(F.date_add(last, 7 * weeks), "week")
    elif anchor == "same_weekday":
        first, until = F.date_add(last, 7), F.date_add(last, 7 * weeks)
    else:
        raise ValueError(f"unknown anchor: {anchor}")
    return F.sequence(first, until, F.expr("interval 7 days"))


def forecast_horizon(df: DataFrame, weeks: int = 13, anchor: str = "monday", column: str = DATE) -> DataFrame:
    """Dates after the last one. ``monday`` gives the Mondays of all weeks that the
    next ``7 * weeks`` days touch, ``same_weekday`` exactly ``weeks`` dates."""
    last = df.agg(F.max(column).alias("_last"))
    return last.select(F.explode(_horizon_dates(F.col("_last"), weeks, anchor)).alias(column))


def series_horizon(df: DataFrame, weeks: int = 13, anchor: str = "same_weekday", by: Sequence[str] = SERIES,
                   column: str = DATE) -> DataFrame:
    """The same rule for each series, from its own last date."""
    last = df.groupBy(*by).agg(F.max(column).alias("_last"))
    return last.select(*by, F.explode(_horizon_dates(F.col("_last"), weeks, anchor)).alias(column))


def future_features(df: DataFrame, weeks: int = 13, anchor: str = "monday", column: str = DATE) -> DataFrame:
    """Future dates with all calendar features."""
    return calendar_features(forecast_horizon(df, weeks, anchor, column), column)
