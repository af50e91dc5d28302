"""Gap filling, standardisation and outlier capping."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ratio, unpivot, zero_if_null
from ..functions.quantiles import approx_quantiles, exact_quantiles
from ..schema import DATE, DEPT, ECONOMY, MARKDOWNS, STORE, WEATHER, numeric_columns, string_columns
from ..sources.layout import JOINED, dealt
from . import calendar, relational


def fill_markdowns(features: DataFrame, cols: Sequence[str] = MARKDOWNS, limit: int = 8,
                   by: str = STORE, order: str = DATE) -> DataFrame:
    """Promotions last: a missing markdown takes the store's last known one of the
    ``limit`` weeks before, else 0. A store without any positive value of a
    markdown gets 0 throughout.

    Runs on the covariates, one row per store and week, before they are joined to
    the departments' rows: a store has one row per week there.
    """
    cols = [c for c in cols if c in features.columns]
    recent = Window.partitionBy(by).orderBy(order).rowsBetween(-limit, 0)
    store = Window.partitionBy(by)
    return features.withColumns({
        c: F.when(F.max(F.col(c) > 0).over(store), zero_if_null(F.last(c, ignorenulls=True).over(recent))).otherwise(0.0)
        for c in cols})


def markdown_sum(df: DataFrame, cols: Sequence[str] = MARKDOWNS, name: str = "MarkDownSum") -> DataFrame:
    total = F.lit(0.0)
    for c in cols:
        if c in df.columns:
            total = total + zero_if_null(c)
    return df.withColumn(name, total)


def zscore_by(df: DataFrame, cols: Sequence[str] = ECONOMY, by: Sequence[str] = (STORE,), suffix: str = "_std",
              fit_until: str | None = None, date: str = DATE) -> DataFrame:
    """(x - mean) / sample std of the group; null, and constant groups, become 0.

    Mean and deviation are aggregated (partially per task, so a hot group does not
    gather its rows) and joined back. With ``fit_until`` later rows are scaled but
    do not take part in the fit.
    """
    cols, by = [c for c in cols if c in df.columns], list(by)
    base = df if fit_until is None else df.where(F.col(date) <= F.lit(fit_until).cast("date"))
    stats = base.groupBy(*by).agg(*[a for c in cols for a in (
        F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_dev_{c}"))])
    scored = df.join(stats, by, "left").withColumns({
        c + suffix: zero_if_null(ratio(F.col(c) - F.col(f"_mean_{c}"), f"_dev_{c}")) for c in cols})
    return scored.drop(*[f"_{k}_{c}" for c in cols for k in ("mean", "dev")])


def fill_days(days: DataFrame, both: Sequence[str] = (), forward: Sequence[str] = (),
              by: Sequence[str] = (STORE,), order: str = DATE) -> DataFrame:
    """Carry a group's last known value forward, and for ``both`` the next one back
    to the leading gap. ``days`` has one row per group and day, so the rows of a
    window are bounded by the calendar."""
    past = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # The next value is the last one in reverse order: a running frame, linear in the days.
    future = Window.partitionBy(*by).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)

    def known(c: str, window) -> Column:
        return F.last(c, ignorenulls=True).over(window)

    return days.withColumns({
        **{c: F.coalesce(known(c, past), known(c, future)) for c in both},
        **{c: known(c, past) for c in forward}})


def filled_gaps(df: DataFrame, both: Sequence[str] = (), forward: Sequence[str] = (),
                by: Sequence[str] = (STORE,), order: str = DATE, rows: int | None = None) -> DataFrame:
    """The filled values of the groups' days on which a row lacks one, from one row per group and day."""
    by = list(by)
    gap = reduce(or_, [F.col(c).isNull() for c in (*both, *forward)], F.lit(False))
    days = df.groupBy(*by, order).agg(*[F.max(c).alias(c) for c in (*both, *forward)], F.max(gap).alias("_gap"))
    days = days if rows is None else dealt(days, rows, by, JOINED)
    return fill_days(days, both, forward, by, order).where("_gap").drop("_gap")


def fill_over_days(df: DataFrame, both: Sequence[str] = (), forward: Sequence[str] = (),
                   by: Sequence[str] = (STORE,), order: str = DATE, rows: int | None = None) -> DataFrame:
    """The same for rows of several departments a day.

    A covariate has one value per group and day, shared by the departments' rows.
    So the rows are first reduced to one per group and day, filled there, and the
    values of the days with a gap are joined back. With ``rows``, about how many ``df`` has, the
    days are dealt into parts that follow them.
    """
    by = list(by)
    both, forward = [c for c in both if c in df.columns], [c for c in forward if c in df.columns]
    filled = filled_gaps(df, both, forward, by, order, rows).withColumnsRenamed({c: f"_{c}" for c in (*both, *forward)})
    return (df.join(filled, [*by, order], "left")
            .withColumns({c: F.coalesce(c, f"_{c}") for c in (*both, *forward)})
            .drop(*[f"_{c}" for c in (*both, *forward)]))


def ffill_bfill(df: DataFrame, cols: Sequence[str] = WEATHER, by: Sequence[str] = (STORE,), order: str = DATE, rows: int | None = None) -> DataFrame:
    return fill_over_days(df, both=cols, by=by, order=order, rows=rows)


def ffill_static(df: DataFrame, cols: Sequence[str] = ("Size", "Type"), by: Sequence[str] = (STORE,), order: str = DATE, rows: int | None = None) -> DataFrame:
    return fill_over_days(df, forward=cols, by=by, order=order, rows=rows)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Remaining nulls: 0 for numbers, 'Unknown' for text."""
    return df.na.fill(0, numeric_columns(df)).na.fill("Unknown", string_columns(df))


def outlier_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, approximate: bool = False,
                   skip_zero_iqr: bool = False, fit_until: str | None = None, date: str = DATE,
                   weight: str | None = None) -> dict[str, tuple]:
    """(lower, upper) of each column that has values: ``[Q1 - k*IQR, Q3 + k*IQR]``. A row
    counts ``weight`` times, if given; the sketch of ``approximate`` can't weigh rows."""
    base = df if fit_until is None else df.where(F.col(date) <= F.lit(fit_until).cast("date"))
    if approximate and weight is None:
        quartiles = approx_quantiles(base, cols, (0.25, 0.75))
    else:
        quartiles = exact_quantiles(base, cols, (0.25, 0.75), weight)
    bounds = {}
    for c, (q1, q3) in quartiles.items():
        if q1 is not None and not (skip_zero_iqr and q1 == q3):
            bounds[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return bounds


def _measures(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols is not None else numeric_columns(df, exclude=(STORE, DEPT))


def _capped(df: DataFrame, cols: Sequence[str], bounds: dict[str, tuple]) -> DataFrame:
    def capped(c: str) -> Column:
        value = F.col(c).cast("double")
        if c not in bounds:
            return value
        lo, hi = bounds[c]
        # greatest/least skip nulls, a missing value must stay missing.
        return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(hi)), F.lit(lo)))

    return df.withColumns({c: capped(c) for c in cols})


def cap_outliers(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5, **how) -> DataFrame:
    """Clip each column to its outlier bounds; by default every numeric column but
    the keys, the target included. Capped columns become double."""
    cols = _measures(df, cols)
    return _capped(df, cols, outlier_bounds(df, cols, k, **how))


def outlier_counts(df: DataFrame, cols: Sequence[str] | None = None, k: float = 1.5, **how) -> DataFrame:
    """Values outside the bounds, per column."""
    cols = _measures(df, cols)
    bounds = outlier_bounds(df, cols, k, **how)

    def outside(c: str) -> Column:
        if c not in bounds:
            return F.lit(0)
        return F.count_if((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1]))

    totals = df.agg(F.count(F.lit(1)), *[outside(c).cast("long").alias(f"c{i}") for i, c in enumerate(cols)])
    return unpivot(totals, {c: F.col(f"c{i}") for i, c in enumerate(cols)}, "column", "outliers")


def clean_merged(panel: DataFrame, stage: Callable[[DataFrame], DataFrame] | None = None, **cap) -> DataFrame:
    """Calendar, markdown total, standardised economy, fills and capping of a merged
    panel whose markdowns are already filled. ``stage`` may write the panel before the
    quantile passes (see ``session.materialise``)."""
    timed = calendar.calendar_features(calendar.parse_dates(panel))
    marked = markdown_sum(timed.na.fill(0.0, [c for c in MARKDOWNS if c in timed.columns]))
    ready = fill_defaults(fill_over_days(zscore_by(marked), both=WEATHER, forward=("Size", "Type")))
    return relational.cast_keys(cap_outliers(stage(ready) if stage else ready, **cap))


def _zscore_days(days: DataFrame, cols: Sequence[str], weight: str, by: str = STORE) -> DataFrame:
    """``zscore_by`` of the rows that the days stand for, each ``weight`` times."""
    def total(x: Column, c: str) -> Column:
        return F.sum(F.when(F.col(c).isNotNull(), x))

    n = F.col(weight)
    means = days.groupBy(by).agg(*[a for c in cols for a in (
        ratio(total(n * F.col(c), c), total(n, c)).alias(f"_mean_{c}"), total(n, c).alias(f"_n_{c}"),
        (F.min(c) < F.max(c)).alias(f"_varies_{c}"))])
    near = days.join(means, by, "left")
    squares = near.groupBy(by).agg(*[F.sum(n * F.pow(F.col(c) - F.col(f"_mean_{c}"), F.lit(2))).alias(f"_squares_{c}") for c in cols])

    def score(c: str) -> Column:
        deviation = F.when(F.col(f"_varies_{c}"), F.sqrt(ratio(f"_squares_{c}", F.col(f"_n_{c}") - 1)))
        return zero_if_null(ratio(F.col(c) - F.col(f"_mean_{c}"), deviation))

    return near.join(squares, by, "left").withColumns({f"{c}_std": score(c) for c in cols}).select(
        *days.columns, *[f"{c}_std" for c in cols])


def clean_panel(sales: DataFrame, features: DataFrame, stores: DataFrame, k: float = 1.5, approximate: bool = False,
                stage: Callable[[DataFrame], DataFrame] | None = None, **cap) -> DataFrame:
    """The cleaned panel from its three tables.

    Equal to ``clean_merged`` of the merged tables, but everything that a row has by its
    store and day is worked out on one row per store and day of the sales, with the
    number of rows that it stands for: fills, calendar, standardisation, quartiles.
    The quartiles of the calendar columns come from one row per date in the same way.
    The panel itself is read for the quartiles of the sales, and joined with the days
    once. ``stage`` may write the days before the quantile passes read them (see
    ``session.materialise``); the panel is never written. (The sketch of ``approximate`` can't weigh rows and so
    reads the joined panel, once.)
    """
    weight = "_rows"
    days = calendar.parse_dates(sales).groupBy(STORE, DATE).agg(F.count(F.lit(1)).alias(weight))
    covered = fill_days(days.join(fill_markdowns(features).drop("IsHoliday"), [STORE, DATE], "left"), both=WEATHER)
    # A store's attributes come from its one row in the dimension: nothing to carry along.
    timed = calendar.calendar_features(relational.join_stores(covered, stores), dates=days)
    marked = markdown_sum(timed.na.fill(0.0, [c for c in MARKDOWNS if c in timed.columns]))
    economy = [c for c in ECONOMY if c in marked.columns]
    ready = fill_defaults(_zscore_days(marked, economy, weight))
    ready = stage(ready) if stage else ready
    own = fill_defaults(calendar.parse_dates(sales))
    of_dates = [c for c in _measures(timed, None) if c not in covered.columns and c not in stores.columns]
    of_days = [c for c in _measures(ready, None) if c != weight]
    of_sales = [c for c in _measures(own, None) if c not in of_days]
    panel = own.join(ready.drop(weight), [STORE, DATE], "left")
    if approximate:
        bounds = outlier_bounds(panel, [*of_days, *of_sales], k, approximate=True, **cap)
    else:
        dates = ready.groupBy(DATE).agg(F.sum(weight).alias(weight), *[F.max(c).alias(c) for c in of_dates])
        of_stores = [c for c in of_days if c not in of_dates]
        bounds = (outlier_bounds(own, of_sales, k, **cap) | outlier_bounds(ready, of_stores, k, weight=weight, **cap)
                  | outlier_bounds(dates, of_dates, k, weight=weight, **cap))
    return relational.cast_keys(_capped(panel, [*of_days, *of_sales], bounds))
