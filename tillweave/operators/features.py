"""Lag, rolling, trend, seasonality and interaction features.

All series features use one window specification, so a chain of them costs one
shuffle and one sort. ``by`` is the window's partition; see
``functions.windows.in_blocks`` for series too long for one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import one_row, ratio, zero_if_null
from ..functions.windows import series_window
from ..schema import (BAND_DOMAIN, DATE, DEPT, KEY, LAGS, SERIES, TARGET, TYPE_DOMAIN, WINDOWS,
                      numeric_columns)


def _fetch(value: str, first: int, last: int, by: Sequence[str]) -> dict[str, Column]:
    """The values ``first`` to ``last`` rows back as columns ``_back0, _back1, ...``."""
    w = series_window(by)
    return {f"_back{i}": F.lag(value, k).over(w) if k else F.col(value) for i, k in enumerate(range(first, last + 1))}


def _frame(by: Sequence[str], rows: int, shift: int):
    return series_window(by).rowsBetween(-(rows - 1) - shift, -shift)


def lags(df: DataFrame, ks: Sequence[int] = LAGS, fill: float | None = 0.0, by: Sequence[str] = SERIES,
         value: str = TARGET) -> DataFrame:
    """The value ``k`` rows earlier in the series; ``fill=None`` keeps the leading nulls."""
    w = series_window(by)

    def lag(k: int) -> Column:
        earlier = F.lag(value, k).over(w)
        return earlier if fill is None else F.coalesce(earlier, F.lit(fill))

    return df.withColumns({f"sales_lag_{k}": lag(k) for k in ks})


def _means(windows: Sequence[int], shift: int, by: Sequence[str], value: str) -> dict[str, Column]:
    return {f"sales_rolling_mean_{n}": zero_if_null(F.avg(value).over(_frame(by, n, shift))) for n in windows}


def _deviations(windows: Sequence[int], shift: int, by: Sequence[str], value: str, fill: float | None = 0.0) -> dict[str, Column]:
    devs = {f"sales_rolling_std_{n}": F.stddev_samp(value).over(_frame(by, n, shift)) for n in windows}
    return devs if fill is None else {n: F.coalesce(d, F.lit(fill)) for n, d in devs.items()}


def rolling_mean(df: DataFrame, windows: Sequence[int] = WINDOWS, shift: int = 0, by: Sequence[str] = SERIES,
                 value: str = TARGET) -> DataFrame:
    """Mean of the last rows, the current one included; ``shift=1`` leaves it out."""
    return df.withColumns(_means(windows, shift, by, value))


def rolling_std(df: DataFrame, windows: Sequence[int] = WINDOWS, shift: int = 0, by: Sequence[str] = SERIES,
                value: str = TARGET, fill: float | None = 0.0) -> DataFrame:
    """Sample deviation of the last rows; a single row has none and gets ``fill``."""
    return df.withColumns(_deviations(windows, shift, by, value, fill))


def _recent(rows: int) -> dict[str, Column]:
    """The fetched values as one array, missing rows as infinity: without nulls its
    parts sort as primitives."""
    return {"_recent": F.array(*[F.coalesce(f"_back{i}", F.lit(float("inf"))) for i in range(rows)])}


def _known(windows: Sequence[int], shift: int, by: Sequence[str], value: str) -> dict[str, Column]:
    return {f"_known{n}": F.count(value).over(_frame(by, n, shift)).cast("int") for n in windows}


def _sorted(windows: Sequence[int]) -> dict[str, Column]:
    return {f"_sorted{n}": F.sort_array(F.slice("_recent", 1, n)) for n in windows}


def _medians(windows: Sequence[int]) -> dict[str, Column]:
    def median(n: int) -> Column:
        known = F.col(f"_known{n}")
        low, high = F.get(f"_sorted{n}", F.shiftright(known - 1, 1)), F.get(f"_sorted{n}", F.shiftright(known, 1))
        return F.when(known > 0, (low + high) / 2).otherwise(0.0)

    return {f"sales_rolling_median_{n}": median(n) for n in windows}


def rolling_median(df: DataFrame, windows: Sequence[int] = WINDOWS, shift: int = 0, by: Sequence[str] = SERIES,
                   value: str = TARGET) -> DataFrame:
    """Median of the last rows.

    The rows are fetched by ``lag`` and sorted as a short array: that stays in
    generated code, where a framed ``percentile`` builds a map per row. The arrays
    are steps of their own, so each is built once and read several times.
    """
    reach = max(windows)
    back, known = _fetch(value, shift, shift + reach - 1, by), _known(windows, shift, by, value)
    recent, ordered = _recent(reach), _sorted(windows)
    with_arrays = df.withColumns({**back, **known}).withColumns(recent).withColumns(ordered)
    return with_arrays.withColumns(_medians(windows)).drop(*back, *known, *recent, *ordered)


def _positions(by: Sequence[str]) -> dict[str, Column]:
    return {"_pos": F.row_number().over(series_window(by)).cast("double")}


def _slope(rows: int, shift: int, by: Sequence[str], value: str) -> Column:
    return zero_if_null(F.regr_slope(value, "_pos").over(_frame(by, rows, shift)))


def rolling_slope(df: DataFrame, rows: int = 13, shift: int = 0, by: Sequence[str] = SERIES, value: str = TARGET,
                  name: str = "sales_trend") -> DataFrame:
    """Least-squares slope of the last rows against their position; 0 for one row."""
    return df.withColumns(_positions(by)).withColumn(name, _slope(rows, shift, by, value)).drop("_pos")


def onehot(df: DataFrame, column: str, domain: Sequence[str], prefix: str, drop: bool = True) -> DataFrame:
    """0/1 columns for a fixed domain, so the schema does not depend on the data."""
    coded = df.withColumns({f"{prefix}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in domain})
    return coded.drop(column) if drop else coded


def store_encoding(df: DataFrame) -> DataFrame:
    return onehot(df, "Type", TYPE_DOMAIN, "store_type") if "Type" in df.columns else df


def dept_bands(df: DataFrame, labels: Sequence[str] = BAND_DOMAIN, value: str = TARGET, fit_until: str | None = None) -> DataFrame:
    """(Dept, dept_category): mean sales cut into equal-width, right-closed bins. If
    all means are equal they fall into the middle bin."""
    base = df if fit_until is None else df.where(F.col(DATE) <= F.lit(fit_until).cast("date"))
    means = base.groupBy(DEPT).agg(F.avg(value).alias("_mean"))
    ends = means.agg(F.min("_mean").alias("_lo"), F.max("_mean").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / len(labels)
    band = F.when(F.col("_hi") == F.col("_lo"), labels[len(labels) // 2])
    for i, label in enumerate(labels[:-1], start=1):
        band = band.when(F.col("_mean") <= F.col("_lo") + i * step, label)
    return one_row(means, ends).select(
        DEPT, F.when(F.col("_mean").isNotNull(), band.otherwise(labels[-1])).alias("dept_category"))


def dept_band(df: DataFrame, **how) -> DataFrame:
    """Adds the department's band to each row.

    The bands are broadcast, one row a department: a join by department would gather all
    rows in as many tasks as there are departments, and leave them there for what follows.
    """
    return df.join(F.broadcast(dept_bands(df, **how)), DEPT, "left")


def dept_encoding(df: DataFrame, **how) -> DataFrame:
    return onehot(dept_band(df, **how), "dept_category", BAND_DOMAIN, "dept_cat")


def _holiday_lags(ks: Sequence[int], by: Sequence[str]) -> dict[str, Column]:
    w = series_window(by)
    return {f"holiday_week_lag{k}": F.coalesce(F.lag("is_holiday_week", k).over(w), F.lit(False)) for k in ks}


def holiday_lags(df: DataFrame, ks: Sequence[int] = (1, 2, 3), by: Sequence[str] = SERIES) -> DataFrame:
    """Whether the rows before were in a holiday week."""
    return df.withColumns(_holiday_lags(ks, by)) if "is_holiday_week" in df.columns else df


def holiday_interaction(df: DataFrame) -> DataFrame:
    if "IsHoliday" not in df.columns or "is_federal_holiday" not in df.columns:
        return df
    return df.withColumn("holiday_interaction", (F.col("IsHoliday") & F.col("is_federal_holiday")).cast("int"))


def seasonal_index(df: DataFrame, part: str, name: str, by: Sequence[str] = SERIES, value: str = TARGET,
                   fit_until: str | None = None) -> DataFrame:
    """Mean of the series in the row's month or week relative to its overall mean; 1
    where there is none. The series' mean comes first, so that the season's window
    reuses the partitioning by series."""
    x = F.col(value) if fit_until is None else F.when(F.col(DATE) <= F.lit(fit_until).cast("date"), F.col(value))
    season = F.avg(x).over(Window.partitionBy(*by, part))
    whole = df.withColumn("_whole", F.avg(x).over(Window.partitionBy(*by)))
    return whole.withColumn(name, F.coalesce(ratio(season, "_whole"), F.lit(1.0))).drop("_whole")


def seasonal_index_joined(df: DataFrame, part: str, name: str, by: Sequence[str] = SERIES, value: str = TARGET) -> DataFrame:
    """The same from aggregates joined back: for series too long for one task."""
    by = list(by)
    # Sums per season are enough for both means; the second level adds them up.
    season = df.groupBy(*by, part).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    whole = season.groupBy(*by).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    index = season.join(whole, by).select(
        *by, part, F.coalesce(ratio(ratio("_s", "_n"), ratio("_ts", "_tn")), F.lit(1.0)).alias(name))
    return df.join(index, [*by, part], "left").withColumn(name, F.coalesce(name, F.lit(1.0)))


def interactions(df: DataFrame) -> DataFrame:
    """Products of size, markdown and holiday with the weather columns; null gives 0."""
    have = set(df.columns)
    flag = F.col("IsHoliday").cast("int")
    products = {}
    if "Size" in have:
        products["size_temperature"] = F.col("Size") * F.col("Temperature")
        products["size_fuel_price"] = F.col("Size") * F.col("Fuel_Price")
    if "MarkDownSum" in have:
        products["markdown_temperature"] = F.col("MarkDownSum") * F.col("Temperature")
        products["markdown_holiday"] = F.col("MarkDownSum") * flag
    if "IsHoliday" in have:
        products["holiday_temperature"] = flag * F.col("Temperature")
        products["holiday_fuel_price"] = flag * F.col("Fuel_Price")
    return df.withColumns({n: zero_if_null(p) for n, p in products.items()})


def numeric_features(df: DataFrame, keep: Sequence[str] = (*KEY, TARGET)) -> DataFrame:
    """Everything but the kept columns as numbers without nulls: flags 0/1, text read
    as a number where it is one and 0 otherwise."""
    def number(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(field.dataType, T.StringType):
            c = c.try_cast("double")
        return F.coalesce(c, F.lit(0)).alias(field.name)

    return df.select(*[F.col(f.name) if f.name in keep else number(f) for f in df.schema.fields])


# Columns that never are features.
NOT_FEATURES = (*KEY, TARGET, "y_true", "y_pred", "fold")


def feature_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Numeric columns that are neither key, target nor backtest column."""
    return numeric_columns(df, exclude)


def feature_matrix(df: DataFrame, keep: Sequence[str] = KEY) -> DataFrame:
    """Keys and feature columns only."""
    return df.select(*keep, *feature_columns(df))


def aligned(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Columns of exactly the fitted features, in their order; absent ones and nulls are 0."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def feature(c: str) -> Column:
        if c not in kinds:
            return F.lit(0.0)
        raw = F.col(c).cast("int") if isinstance(kinds[c], T.BooleanType) else F.col(c)
        return F.coalesce(raw.try_cast("double"), F.lit(0.0))

    return [feature(c).alias(c) for c in cols]


def align_features(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = KEY) -> DataFrame:
    return df.select(*[c for c in keep if c in df.columns], *aligned(df, cols))


LOOKBACK = max(LAGS)


def lookback_features(df: DataFrame, by: Sequence[str] = SERIES) -> DataFrame:
    """Lags, rolling statistics, slope and holiday lags together. They share the
    fetched rows and one sorted partitioning."""
    back, known = _fetch(TARGET, 0, LOOKBACK, by), _known(WINDOWS, 0, by, TARGET)
    holiday = _holiday_lags((1, 2, 3), by) if "is_holiday_week" in df.columns else {}
    recent, ordered = _recent(max(WINDOWS)), _sorted(WINDOWS)
    fetched = df.withColumns(_positions(by)).withColumns({
        **back, **known, **_means(WINDOWS, 0, by, TARGET), **_deviations(WINDOWS, 0, by, TARGET), **holiday,
        "sales_trend": _slope(13, 0, by, TARGET)})
    derived = fetched.withColumns({**{f"sales_lag_{k}": zero_if_null(f"_back{k}") for k in LAGS}, **recent})
    done = derived.withColumns(ordered).withColumns(_medians(WINDOWS))
    return done.drop("_pos", *back, *known, *recent, *ordered)


def build_features(df: DataFrame) -> DataFrame:
    """All features of a cleaned panel, numeric and without nulls.

    What needs its own order of the rows, the department's band and the seasonal
    indices, comes first, while the rows are narrow.
    """
    df = dept_encoding(df)
    df = seasonal_index(df, "month", "monthly_seasonality")
    df = seasonal_index(df, "week", "weekly_seasonality")
    df = holiday_interaction(store_encoding(lookback_features(df)))
    return numeric_features(interactions(df))
