"""Business exports and dashboard queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..functions.expr import ratio, zero_if_null
from ..schema import DATE, DEPT, MARKDOWNS, SERIES, STORE, TARGET
from .relational import filter_panel, union_forecasts, with_defaults


def forecast_export(*preds: DataFrame) -> DataFrame:
    """All forecasts in one flat table, with a band of ten percent where a model gives none."""
    df = with_defaults(union_forecasts(*preds))
    flag = F.coalesce(F.col("IsHoliday").cast("boolean"), F.lit(False)) if "IsHoliday" in df.columns else F.lit(False)
    df = df.withColumn("IsHoliday", flag)
    return with_defaults(df, {"lower": F.col("y_pred") * 0.9, "upper": F.col("y_pred") * 1.1})


def store_risk(df: DataFrame, by: Sequence[str] = SERIES, value: str = TARGET) -> DataFrame:
    """Distance of each series' last sales from its recent level, largest first.

    Only the last thirteen rows of a series matter beside its totals. The limit on
    the row number is applied within each task before the shuffle, so a long series
    is never gathered.
    """
    by = list(by)
    newest = Window.partitionBy(*by).orderBy(F.col(DATE).desc())
    recent = df.select(*by, DATE, value).withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= 13)
    levels = recent.groupBy(*by).agg(
        F.max_by(value, DATE).alias("last_sales"), F.avg(F.when(F.col("_back") <= 4, F.col(value))).alias("trailing_4_avg"),
        F.avg(value).alias("trailing_13_avg"))
    totals = df.groupBy(*by).agg(
        F.avg(value).alias("avg_sales"), F.stddev_samp(value).alias("std_sales"),
        F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"))
    delta = F.col("last_sales") - F.col("trailing_4_avg")
    measured = totals.join(levels, by).withColumns({
        "abs_delta": F.abs(delta), "pct_delta": ratio(delta, "trailing_4_avg") * 100,
        "next_week_pred": F.col("trailing_4_avg")})
    return measured.na.fill(0.0).orderBy(F.desc("abs_delta"), *by)


def markdown_roi(df: DataFrame, cols: Sequence[str] = MARKDOWNS, min_rows: int = 10, by: Sequence[str] = SERIES,
                 value: str = TARGET) -> DataFrame:
    """Sales with and without markdowns per series, largest uplift first: one
    aggregation, combined before the shuffle."""
    spend = sum((zero_if_null(c) for c in cols if c in df.columns), F.lit(0.0))
    rows = df.select(*by, spend.alias("_md"), F.col(value).alias("_y"))
    with_md, without = F.avg(F.when(F.col("_md") > 0, F.col("_y"))), F.avg(F.when(F.col("_md") == 0, F.col("_y")))
    # A constant side has no correlation; the plain ``corr`` would divide by zero.
    varies = (F.min("_md") < F.max("_md")) & (F.min("_y") < F.max("_y"))
    corr = F.when(varies, ratio(F.covar_samp("_md", "_y"), F.stddev_samp("_md") * F.stddev_samp("_y")))
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        zero_if_null(corr).alias("markdown_sales_correlation"),
        with_md.alias("_with"), without.alias("_without"),
        F.sum("_md").alias("total_markdown_spend"), F.sum("_y").alias("total_sales"),
        F.count_if(F.col("_md") > 0).cast("long").alias("markdown_weeks")).where(F.col("_n") >= min_rows)
    uplift = F.when(F.col("_without") > 0, ratio(F.col("_with") - F.col("_without"), "_without") * 100)
    return out.select(
        *by, "markdown_sales_correlation",
        zero_if_null("_with").alias("avg_sales_with_markdown"),
        zero_if_null("_without").alias("avg_sales_without_markdown"),
        zero_if_null(uplift).alias("uplift_percentage"),
        "total_markdown_spend", "total_sales", "markdown_weeks").orderBy(F.desc("uplift_percentage"), *by)


def dashboard_summary(df: DataFrame) -> DataFrame:
    holidays = F.count_if(F.col("IsHoliday").cast("boolean")).cast("long") if "IsHoliday" in df.columns else F.lit(0).cast("long")
    return df.agg(
        F.count_distinct(STORE).alias("total_stores"), F.count_distinct(DEPT).alias("total_departments"),
        F.count(F.lit(1)).alias("total_observations"), F.min(DATE).alias("start_date"), F.max(DATE).alias("end_date"),
        F.sum(TARGET).alias("total_revenue"), F.avg(TARGET).alias("avg_weekly_sales"),
        holidays.alias("total_holiday_weeks"))


def data_summary(df: DataFrame) -> DataFrame:
    """Size of a feature table; the number of feature columns is known from the plan."""
    width = len([c for c in df.columns if c not in (STORE, DEPT, DATE, TARGET)])
    return df.agg(
        F.count_distinct(STORE).alias("n_stores"), F.count_distinct(DEPT).alias("n_departments"),
        F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"), F.count(F.lit(1)).alias("total_observations"),
    ).withColumn("feature_columns", F.lit(width).cast("long"))


def store_dept_mapping(df: DataFrame) -> DataFrame:
    """Span, level and store attributes of each series, largest total first. Type and
    Size are constant per store, so any aggregate of them serves; ``min`` is stable."""
    out = df.groupBy(STORE, DEPT).agg(
        F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"), F.count(DATE).alias("periods"),
        F.avg(TARGET).alias("avg_sales"), F.stddev_samp(TARGET).alias("std_sales"), F.sum(TARGET).alias("total_sales"),
        F.min("Type").alias("Type"), F.min("Size").alias("Size"))
    return out.withColumns({
        "date_range_days": F.datediff("last_date", "first_date"),
        "avg_weekly_sales": ratio("total_sales", "periods")}).orderBy(F.desc("total_sales"), STORE, DEPT)


def _top(df: DataFrame, by: str, n: int, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(by), *keys).limit(n)


def top_risk(risk: DataFrame, n: int = 10) -> DataFrame:
    return _top(risk, "abs_delta", n, SERIES).select(
        STORE, DEPT, "last_sales", "trailing_4_avg", "abs_delta", "pct_delta")


def top_roi(roi: DataFrame, n: int = 10) -> DataFrame:
    return _top(roi, "uplift_percentage", n, SERIES).select(
        STORE, DEPT, "uplift_percentage", "markdown_sales_correlation", "total_markdown_spend", "total_sales")


def _headline(guard: bool) -> list[Column]:
    return [m.mae().alias("mae"), m.rmse().alias("rmse"), m.mape(guard=guard).alias("mape")]


def model_metrics(forecasts: DataFrame, guard: bool = False) -> DataFrame:
    """MAE, RMSE and MAPE per model over all forecasts. As in the dashboard, a zero
    actual is not left out unless ``guard`` is set."""
    return forecasts.groupBy("model").agg(*_headline(guard))


def series_view(forecasts: DataFrame, store: int, dept: int, model: str) -> DataFrame:
    """Forecasts of one series by one model."""
    return filter_panel(forecasts, store, dept, model)


def series_scores(forecasts: DataFrame, store: int, dept: int, model: str, guard: bool = False) -> DataFrame:
    return series_view(forecasts, store, dept, model).agg(*_headline(guard))


def holiday_rows(forecasts: DataFrame) -> DataFrame:
    return forecasts.where(F.col("IsHoliday").cast("boolean"))


def sales_trend(df: DataFrame, value: str = TARGET) -> DataFrame:
    return df.groupBy(DATE).agg(F.sum(value).alias("total_sales"))


def sales_stats(df: DataFrame, value: str = TARGET) -> DataFrame:
    return df.agg(F.sum(value).alias("total_sales"), F.avg(value).alias("avg_sales"),
                  F.max(value).alias("max_sales"), F.min(value).alias("min_sales"))


def store_top(df: DataFrame, n: int = 10, value: str = TARGET) -> DataFrame:
    return _top(df.groupBy(STORE).agg(F.sum(value).alias("total_sales")), "total_sales", n, [STORE])


def dept_distribution(df: DataFrame, value: str = TARGET) -> DataFrame:
    """Sales per department and its share; the grand total is an aggregate of the
    department totals, attached as one row."""
    totals = df.groupBy(DEPT).agg(F.sum(value).alias("total_sales"))
    grand = totals.agg(F.sum("total_sales").alias("_all"))
    return totals.crossJoin(F.broadcast(grand)).select(
        DEPT, "total_sales", ratio("total_sales", "_all").alias("share")).orderBy(F.desc("total_sales"), DEPT)


def holiday_impact(df: DataFrame, value: str = TARGET) -> DataFrame:
    return df.groupBy("IsHoliday").agg(F.bround(F.avg(value), 2).alias("mean_sales"), F.count(value).alias("weeks"))
