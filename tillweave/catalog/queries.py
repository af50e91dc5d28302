"""One query per operator, over the whole panel derived from a star-schema folder.

``published`` fixes the form in which results are compared: whole numbers as
BIGINT, doubles with six digits (totals of money fewer). The cut lies at 0.47 of
the last digit and not at one half: means of few amounts often end in an exact
half, which the last bit of the sum would tip either way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as sc
from ..functions import metrics as m
from ..functions.expr import is_infinite
from ..functions.windows import in_blocks
from ..models.additive import AdditiveParams, LocalModel, series_info, training_summary
from ..models.boosted import BoostedParams, GlobalModel
from ..operators import (backtest, calendar, cleaning, compare, exports, features, quality, relational, scoring,
                         splits)
from ..session import memo, scratch_path
from ..sources import files, layout, starschema
from .tables import clean, featured, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def published(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    def form(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            scale = F.lit(10.0 ** special.get(f.name, digits))
            raised = c * scale + 0.53
            # a floor that stays a double, at any magnitude; infinite values are their own form
            return F.when(is_infinite(c), c).otherwise((raised - F.pmod(raised, F.lit(1.0))) / scale).alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("long").alias(f.name)
        return c

    return df.select(*[form(f) for f in df.schema.fields])


def query(digits: int = 6, **special: int):
    """Register a function of (spark, root) under its own name."""
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, root: published(fn(spark, root), digits, **special)
        return fn

    return register


def merged(spark: SparkSession, root: str) -> DataFrame:
    """Dealt by store and day, as the joins need it, into parts that follow the rows."""
    t = tables(spark, root)
    return relational.merge_sources(layout.dealt(t.sales, t.sales.count(), [sc.STORE, sc.DATE], layout.JOINED), t.features, t.stores)


def filled(spark: SparkSession, root: str) -> DataFrame:
    t = tables(spark, root)
    return relational.merge_sources(t.sales, cleaning.fill_markdowns(t.features), t.stores)


def forecasts(spark: SparkSession, root: str) -> DataFrame:
    return backtest.baseline_forecast(tables(spark, root).sales)


def scores(spark: SparkSession, root: str) -> DataFrame:
    return compare.compare(forecasts(spark, root))


def timed(spark: SparkSession, root: str) -> DataFrame:
    return calendar.calendar_parts(tables(spark, root).sales)


MEASURES = (sc.TARGET, *sc.WEATHER, *sc.MARKDOWNS, *sc.ECONOMY, "Size")


# --- sources and sinks: written to the shared folder and read back

@query()
def csv_roundtrip(spark, root):
    path = files.write_csv(tables(spark, root).features, scratch_path(spark, "csv"))
    return files.read_csv(spark, path, sc.FEATURES)


@query()
def parquet_roundtrip(spark, root):
    path = files.write_parquet(tables(spark, root).sales, scratch_path(spark, "parquet"), ["Dept"])
    return files.read_parquet(spark, path, sc.SALES)


@query(total_revenue=2)
def json_roundtrip(spark, root):
    summary = exports.dashboard_summary(tables(spark, root).sales)
    return files.read_json(spark, files.write_json(summary, scratch_path(spark, "json")), summary.schema)


@query()
def predictions_roundtrip(spark, root):
    preds = forecasts(spark, root)
    path = files.write_predictions(preds, scratch_path(spark, "predictions"))
    return files.read_predictions(spark, path, preds.schema)


# --- validation and quality

@query()
def missing_columns(spark, root):
    return quality.missing_columns(tables(spark, root).features, sc.SALES)


@query()
def dtype_report(spark, root):
    wrong = tables(spark, root).sales.withColumns({"Store": F.col("Store").cast("string"), "Date": F.col("Date").cast("timestamp_ntz")})
    return quality.dtype_report(wrong, sc.SALES)


@query()
def range_violations(spark, root):
    return quality.range_violations(merged(spark, root))


@query()
def domain_violations(spark, root):
    return quality.domain_violations(tables(spark, root).stores, allowed=("A", "B"))


@query()
def null_counts(spark, root):
    return quality.null_counts(merged(spark, root))


@query()
def duplicate_rows(spark, root):
    return quality.duplicate_rows(starschema.sales_lines(spark, root).drop("cents"))


@query()
def duplicate_keys(spark, root):
    return quality.duplicate_keys(starschema.sales_lines(spark, root), ["Store", "Date"])


@query()
def date_range(spark, root):
    return quality.date_range(tables(spark, root).sales)


@query()
def coverage(spark, root):
    return quality.coverage(tables(spark, root).sales)


@query()
def missing_keys(spark, root):
    t = tables(spark, root)
    return quality.missing_keys(t.sales, t.features, ["Store", "Date"])


@query()
def infinite_counts(spark, root):
    ratio = F.when(F.col("MarkDown1").isNull(), float("inf")).otherwise(F.col("Weekly_Sales"))
    return quality.infinite_counts(merged(spark, root).withColumn("sales_ratio", ratio))


@query()
def negative_count(spark, root):
    return quality.negative_count(tables(spark, root).sales.withColumn("margin", F.col("Weekly_Sales") - 40000), "margin")


@query()
def span_consistency(spark, root):
    return quality.span_consistency(tables(spark, root).sales)


@query()
def time_series_checks(spark, root):
    return quality.time_series_checks(starschema.sales_lines(spark, root))


@query()
def unmatched_counts(spark, root):
    return quality.unmatched_counts(merged(spark, root))


@query()
def series_counts(spark, root):
    return quality.series_counts(tables(spark, root).sales)


@query()
def validate_model_input(spark, root):
    return quality.validate_model_input(tables(spark, root).sales)


@query()
def validate_predictions(spark, root):
    preds = forecasts(spark, root)
    # another number for one department: its rows find no partner on either side
    guess = preds.withColumns({"y_pred": F.col("y_pred") - 30000, "Dept": F.when(F.col("Dept") == 6, 1006).otherwise(F.col("Dept"))})
    return quality.validate_predictions(preds, guess, ("model", "fold", *sc.KEY))


@query()
def quality_report(spark, root):
    t = tables(spark, root)
    return quality.quality_report(t.sales, t.features, t.stores, {"sales": t.sales.count(), "features": t.features.count()})


# --- joins, filters, top-k, unions

@query()
def join_features(spark, root):
    t = tables(spark, root)
    return relational.join_features(t.sales, t.features)


@query()
def join_stores(spark, root):
    t = tables(spark, root)
    return relational.join_stores(t.sales, t.stores)


@query()
def merge_sources(spark, root):
    return merged(spark, root)


@query()
def cast_keys(spark, root):
    text = tables(spark, root).sales.withColumns({c: F.col(c).cast("string") for c in (*sc.KEY, "IsHoliday")})
    return relational.cast_keys(text)


@query()
def canonical_sort(spark, root):
    return relational.canonical_sort(tables(spark, root).sales)


@query()
def filter_panel(spark, root):
    return relational.filter_panel(tables(spark, root).sales, store=3, start="1997-01-01", end="1999-12-31")


@query(total_revenue=2)
def top_series(spark, root):
    return relational.top_series(tables(spark, root).sales)


@query()
def restrict_to_series(spark, root):
    sales = tables(spark, root).sales
    return relational.restrict_to_series(sales, relational.top_series(sales), 100, few=True)


@query()
def union_forecasts(spark, root):
    preds = forecasts(spark, root)
    return relational.union_forecasts(preds.where("fold <= 2"), preds.where("fold > 2").drop("IsHoliday", "Weekly_Sales"))


@query()
def with_defaults(spark, root):
    return relational.with_defaults(tables(spark, root).sales)


@query()
def filter_options(spark, root):
    return relational.filter_options(forecasts(spark, root), store=3)


# --- calendar

@query()
def parse_dates(spark, root):
    orders = starschema.table(spark, root, "orders")
    text = F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    return calendar.parse_dates(orders.select("o_orderkey", text.alias("Date")))


@query()
def calendar_parts(spark, root):
    return timed(spark, root)


@query()
def calendar_flags(spark, root):
    orders = starschema.table(spark, root, "orders")
    return calendar.calendar_flags(orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("Date")))


@query()
def cyclical(spark, root):
    return calendar.cyclical(timed(spark, root))


@query()
def holiday_dim(spark, root):
    return calendar.holidays_of(tables(spark, root).sales)


@query()
def holiday_flags(spark, root):
    return calendar.holiday_flags(tables(spark, root).sales)


@query()
def holiday_week_flag(spark, root):
    return calendar.holiday_week_flag(tables(spark, root).sales)


@query()
def holiday_week_flag_per_year(spark, root):
    return calendar.holiday_week_flag(tables(spark, root).sales, per_year=True)


@query()
def forecast_horizon(spark, root):
    return calendar.forecast_horizon(tables(spark, root).sales)


@query()
def series_horizon(spark, root):
    return calendar.series_horizon(tables(spark, root).sales)


@query()
def future_features(spark, root):
    return calendar.future_features(tables(spark, root).sales, weeks=52)


# --- cleaning

@query()
def fill_markdowns(spark, root):
    return cleaning.fill_markdowns(tables(spark, root).features)


@query()
def markdown_sum(spark, root):
    return cleaning.markdown_sum(tables(spark, root).features)


@query()
def zscore_by(spark, root):
    return cleaning.zscore_by(merged(spark, root))


@query()
def ffill_bfill(spark, root):
    return cleaning.ffill_bfill(merged(spark, root), rows=tables(spark, root).sales.count())


@query()
def ffill_static(spark, root):
    gaps = merged(spark, root).withColumns({
        c: F.when(F.col("Temperature").isNotNull(), F.col(c)) for c in ("Type", "Size")})
    return cleaning.ffill_static(gaps)


@query()
def fill_defaults(spark, root):
    return cleaning.fill_defaults(merged(spark, root))


@query()
def cap_outliers(spark, root):
    return cleaning.cap_outliers(merged(spark, root))


@query()
def outlier_counts(spark, root):
    return cleaning.outlier_counts(merged(spark, root), MEASURES)


@query()
def clean_panel(spark, root):
    return clean(spark, root)


# --- features

@query()
def lags(spark, root):
    return features.lags(tables(spark, root).sales)


@query()
def lags_unfilled(spark, root):
    return features.lags(tables(spark, root).sales, fill=None)


@query()
def rolling_mean(spark, root):
    return features.rolling_mean(tables(spark, root).sales)


@query()
def rolling_std(spark, root):
    return features.rolling_std(tables(spark, root).sales)


@query()
def rolling_median(spark, root):
    return features.rolling_median(tables(spark, root).sales)


@query()
def rolling_slope(spark, root):
    return features.rolling_slope(tables(spark, root).sales)


@query()
def lookback_in_blocks(spark, root):
    def lookback(df, by):
        return features.rolling_mean(features.lags(df, by=by), by=by)

    return in_blocks(tables(spark, root).sales, lookback, features.LOOKBACK, block_days=180)


@query()
def lookback_stored_by_series(spark, root):
    """Look-backs over a table in buckets: written once, then read without an exchange."""
    name = f"panel_{uuid.uuid4().hex}"
    kept = layout.store(tables(spark, root).sales, name, scratch_path(spark, name))
    return features.rolling_mean(features.lags(kept))


@query()
def store_encoding(spark, root):
    return features.store_encoding(cleaning.fill_defaults(merged(spark, root)))


@query()
def dept_band(spark, root):
    return features.dept_band(tables(spark, root).sales)


@query()
def dept_encoding(spark, root):
    return features.dept_encoding(tables(spark, root).sales)


@query()
def holiday_lags(spark, root):
    return features.holiday_lags(calendar.holiday_week_flag(tables(spark, root).sales))


@query()
def holiday_interaction(spark, root):
    return features.holiday_interaction(calendar.holiday_flags(tables(spark, root).sales))


@query()
def monthly_index(spark, root):
    return features.seasonal_index(timed(spark, root), "month", "monthly_seasonality")


@query()
def weekly_index(spark, root):
    return features.seasonal_index(timed(spark, root), "week", "weekly_seasonality")


@query()
def monthly_index_joined(spark, root):
    return features.seasonal_index_joined(timed(spark, root), "month", "monthly_seasonality")


@query(digits=4)
def interactions(spark, root):
    return features.interactions(cleaning.markdown_sum(merged(spark, root)))


@query()
def numeric_features(spark, root):
    return features.numeric_features(merged(spark, root))


@query()
def feature_matrix(spark, root):
    return features.feature_matrix(merged(spark, root))


@query()
def align_features(spark, root):
    return features.align_features(merged(spark, root), ["Size", "Temperature", "IsHoliday", "not_there", "MarkDown1"])


@query(digits=4)
def build_features(spark, root):
    return features.build_features(layout.dealt(clean(spark, root), tables(spark, root).sales.count()))


# --- metrics

def _metric(name):
    def run(spark, root):
        return forecasts(spark, root).agg(getattr(m, name)().alias(name))

    run.__name__ = name
    query()(run)


for _name in sc.METRICS:
    _metric(_name)


@query()
def all_metrics(spark, root):
    return scoring.metrics(forecasts(spark, root))


@query()
def metrics_by(spark, root):
    return scoring.metrics_by(forecasts(spark, root), ["model", "Store"])


@query()
def rolling_metrics(spark, root):
    return scoring.rolling_metrics(forecasts(spark, root).select("model", *sc.KEY, "fold", "y_true", "y_pred"))


@query()
def mape_unguarded(spark, root):
    zeroed = forecasts(spark, root).withColumn("y_true", F.when((F.col("Dept") == 1) & F.col("IsHoliday"), 0.0).otherwise(F.col("y_true")))
    return zeroed.groupBy("Dept").agg(m.mape(guard=False).alias("mape"), m.mape().alias("guarded"))


# --- splits and backtests

@query()
def time_split(spark, root):
    return splits.time_split(tables(spark, root).sales)


@query()
def split_dates(spark, root):
    return splits.split_dates(tables(spark, root).sales)


@query()
def fold_bounds(spark, root):
    return splits.fold_bounds(tables(spark, root).sales)


@query()
def assign_folds(spark, root):
    sales = tables(spark, root).sales
    return splits.assign_folds(sales, splits.fold_bounds(sales))


@query()
def backtest_series_mean(spark, root):
    return backtest.backtest(tables(spark, root).sales, backtest.SeriesMean(4))


@query()
def evaluate_fold(spark, root):
    return backtest.evaluate_fold(forecasts(spark, root), 2)


@query()
def fold_metrics(spark, root):
    return backtest.fold_metrics(forecasts(spark, root))


@query()
def fold_summary(spark, root):
    return backtest.fold_summary(scores(spark, root))


@query()
def expanding_cv(spark, root):
    return splits.expanding_cv(tables(spark, root).sales)


@query()
def baseline_forecast(spark, root):
    return forecasts(spark, root)


# --- models, at their full settings. Predictions have no SQL; the queries publish what must
# hold for them, worked out from the values, for each key or fold that SQL can name.

_FITTED: dict[tuple, object] = memo()


def fitted(spark, root, name: str, fit: Callable):
    """A model that several queries look at, fitted once per session."""
    key = (spark.sparkContext.applicationId, root, name)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def boosted(spark, root) -> GlobalModel:
    return fitted(spark, root, "boosted", lambda: GlobalModel().fit(featured(spark, root)))


def boosted_stopped(spark, root) -> GlobalModel:
    return fitted(spark, root, "stopped", lambda: GlobalModel().fit(featured(spark, root), val=0.2))


def additive(spark, root, top_n: int | None = 50) -> LocalModel:
    return fitted(spark, root, f"additive {top_n}", lambda: LocalModel(top_n=top_n).fit(tables(spark, root).sales))


def sound(c: str = "y_pred"):
    """A number, finite and not negative."""
    return F.coalesce(F.col(c).isNotNull() & ~F.isnan(c) & ~is_infinite(c) & (F.col(c) >= 0), F.lit(False))


def sound_scores(df: DataFrame):
    """Finite errors in their order: the mean absolute one is at most the root of the mean squared one."""
    return df.withColumn("sound", sound("mae") & sound("rmse") & (F.col("mae") <= F.col("rmse") * (1 + 1e-9)))


@query()
def boosted_predict(spark, root):
    return boosted(spark, root).predict(featured(spark, root)).select(*sc.KEY, sound().alias("sound"))


@query()
def boosted_early_stop(spark, root):
    """The 10-round rule, on the last fifth of the dates."""
    return boosted_stopped(spark, root).info(spark).select(
        (F.col("trees_kept") == F.col("best_round")).alias("kept_to_best"),
        (F.col("rounds") == F.least(F.col("trees"), F.col("best_round") + 10)).alias("stopped_by_rule"),
        sound("val_rmse").alias("has_error"), F.col("trees").alias("trees_allowed"))


@query()
def boosted_importance(spark, root):
    return boosted(spark, root).feature_importance(spark).agg(
        F.sum("importance").alias("total"), (F.min("importance") >= 0).alias("none_negative"))


@query()
def boosted_fit_metrics(spark, root):
    """Errors on the dates that the trees were grown on and on those that stopped them; below the target's deviation on both."""
    table, model = featured(spark, root), boosted_stopped(spark, root)
    spread = splits.time_split(table).groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.stddev_samp(sc.TARGET).alias("dev"))
    scores = sound_scores(model.split_metrics(table)).join(spread, "split")
    return scores.select("split", "rows", "sound", (F.col("rmse") < F.col("dev")).alias("learnt"))


@query()
def boosted_cv(spark, root):
    return sound_scores(GlobalModel().cross_validate(featured(spark, root))).select("fold", "rows", "sound")


@query()
def boosted_backtest(spark, root):
    preds = backtest.backtest(featured(spark, root), GlobalModel())
    return preds.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("rows"), F.min(sound()).alias("sound"))


@query()
def boosted_saved(spark, root):
    """A reloaded model predicts the same, row by row."""
    model, table = boosted(spark, root), featured(spark, root)
    again = GlobalModel.load(spark, model.save(spark, scratch_path(spark, "boosted")))
    both = again.predict(model.predict(table).withColumnRenamed("y_pred", "first"))
    return both.select(*sc.KEY, (F.col("first") == F.col("y_pred")).alias("same"))


@query()
def boosted_info(spark, root):
    return boosted(spark, root).info(spark)


#: Few trees on features of few values, for which SQL can follow every split.
SMALL = BoostedParams(trees=6, depth=2, rate=0.5, row_share=1.0, feature_share=1.0)


def small_table(spark, root):
    return tables(spark, root).sales.select(
        *sc.KEY, sc.TARGET, F.col("Dept").cast("double").alias("dept_number"), F.col("IsHoliday").cast("int").alias("holiday"),
        F.month("Date").alias("month"), F.least(F.floor((F.dayofmonth("Date") - 1) / 10), F.lit(2)).alias("third"))


def small(spark, root) -> GlobalModel:
    return fitted(spark, root, "small", lambda: GlobalModel(SMALL).fit(small_table(spark, root)))


def small_stopped(spark, root) -> GlobalModel:
    return fitted(spark, root, "small stopped", lambda: GlobalModel(SMALL).fit(small_table(spark, root), val=0.2, patience=2))


@query(y_pred=3)
def boosted_small_predict(spark, root):
    return small(spark, root).predict(small_table(spark, root)).select(*sc.KEY, "y_pred")


@query(bound=1)
def boosted_small_nodes(spark, root):
    """Every split of the trees, with its gain in millions."""
    return small(spark, root).nodes(spark).where("feature >= 0").select(
        "tree", "node", "name", "bound", F.col("n").alias("rows"), (F.col("gain") / 1e6).alias("gain"))


@query()
def boosted_small_importance(spark, root):
    return small(spark, root).feature_importance(spark)


@query(mse=3)
def boosted_small_rounds(spark, root):
    """Validation error of each round until two rounds brought no lower one, and which rounds are kept."""
    model = small_stopped(spark, root)
    rows = [(k, e, k <= len(model.model.trees)) for k, e in enumerate(model.history, 1)]
    return spark.createDataFrame(rows, "round int, mse double, kept boolean").withColumn("mse", F.col("mse") / 1e6)


@query(mae=3, rmse=3)
def boosted_small_fit_metrics(spark, root):
    return small_stopped(spark, root).split_metrics(small_table(spark, root)).select("split", "mae", "rmse")


@query(mae=3, rmse=3)
def boosted_small_cv(spark, root):
    return GlobalModel(SMALL).cross_validate(small_table(spark, root)).select("fold", "rows", "mae", "rmse")


@query(mae=3, rmse=3)
def boosted_small_backtest(spark, root):
    preds = backtest.backtest(small_table(spark, root), GlobalModel(SMALL))
    return backtest.fold_metrics(preds).select("model", "fold", "mae", "rmse")


def _series_fits(model: LocalModel) -> DataFrame:
    return model.table.select("Store", "Dept", "first_date", "span", "y_scale", "points", "error", sound("sigma").alias("sound"))


@query()
def additive_fit(spark, root):
    return _series_fits(additive(spark, root))


@query()
def additive_fit_all(spark, root):
    return _series_fits(additive(spark, root, None))


def _by_model(model: LocalModel, df: DataFrame) -> DataFrame:
    """Predictions with ``modelled``: whether the series has a model; without one they are 0."""
    have = model.table.where("error is null").select(*sc.SERIES, F.lit(True).alias("_m"))
    return df.join(have, list(sc.SERIES), "left").withColumn("modelled", F.coalesce("_m", F.lit(False))).drop("_m")


def _predicted(spark, root, top_n) -> DataFrame:
    model = additive(spark, root, top_n)
    rows = _by_model(model, model.predict(tables(spark, root).sales))
    return rows.select(*sc.KEY, "modelled", (sound() & (F.col("modelled") | (F.col("y_pred") == 0))).alias("sound"))


@query()
def additive_predict(spark, root):
    return _predicted(spark, root, 50)


@query()
def additive_predict_all(spark, root):
    return _predicted(spark, root, None)


@query()
def additive_learnt(spark, root):
    """Each series' error stays below the deviation of its sales."""
    sales, model = tables(spark, root).sales, additive(spark, root, None)
    error = F.sqrt(F.avg(F.pow(F.col(sc.TARGET) - F.col("y_pred"), F.lit(2))))
    per = _by_model(model, model.predict(sales)).where("modelled").groupBy(*sc.SERIES).agg(
        F.count(F.lit(1)).alias("rows"), (error <= F.stddev_samp(sc.TARGET) * 1.05 + 1e-6).alias("learnt"))
    return per


def _ordered(df: DataFrame) -> DataFrame:
    inside = (F.col("lower") <= F.col("y_pred")) & (F.col("y_pred") <= F.col("upper"))
    return df.select(*sc.KEY, (sound("lower") & sound() & sound("upper") & inside).alias("ordered"))


@query()
def additive_intervals(spark, root):
    return _ordered(additive(spark, root).predict_intervals(tables(spark, root).sales))


@query()
def additive_future(spark, root):
    return _ordered(additive(spark, root, None).predict_intervals(calendar.series_horizon(tables(spark, root).sales)))


@query()
def additive_backtest(spark, root):
    preds = backtest.backtest(tables(spark, root).sales, LocalModel(), parallel=4)
    return preds.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("rows"), F.min(sound()).alias("sound"))


@query()
def additive_saved(spark, root):
    """A reloaded model predicts the same, row by row."""
    sales, model = tables(spark, root).sales, additive(spark, root)
    again = LocalModel.load(spark, model.save(scratch_path(spark, "additive")))
    both = again.predict(model.predict(sales).withColumnRenamed("y_pred", "first"))
    return both.select(*sc.KEY, (F.col("first") == F.col("y_pred")).alias("same"))


#: Level and slope alone, whose posterior SQL can solve.
SMALL_LINE = AdditiveParams(changepoints=0, year_order=0, week_order=0, holidays=False)


def small_line(spark, root) -> LocalModel:
    return fitted(spark, root, "line", lambda: LocalModel(SMALL_LINE, top_n=None).fit(tables(spark, root).sales))


@query(5)
def additive_small_fit(spark, root):
    return small_line(spark, root).table.select("Store", "Dept", "first_date", "span", "points", F.get("beta", F.lit(0)).alias("level"), F.get("beta", F.lit(1)).alias("slope"), "sigma")


@query(2)
def additive_small_intervals(spark, root):
    return small_line(spark, root).predict_intervals(tables(spark, root).sales).select(*sc.KEY, "y_pred", "lower", "upper")


@query(2)
def additive_small_backtest(spark, root):
    preds = backtest.backtest(tables(spark, root).sales, LocalModel(SMALL_LINE, top_n=None))
    return backtest.fold_metrics(preds).select("model", "fold", "mae", "rmse")


@query()
def additive_coverage(spark, root):
    """Share of the last quarter's rows inside intervals calibrated on the quarter before, by width; SQL has nothing to compare."""
    sales = tables(spark, root).sales
    day = F.date_sub(sales.agg(F.max("Date").alias("last")).select("last").scalar(), 91)
    model = LocalModel(top_n=None).calibrated(sales.where(F.col("Date") <= day), 13)
    ahead = sales.where(F.col("Date") > day).join(model.table.where("beta is not null").select(*sc.SERIES), list(sc.SERIES), "left_semi")
    shares = [model.predict_intervals(ahead, w).agg(
        F.lit(w).alias("width"), F.count(F.lit(1)).alias("rows"), F.avg(F.col(sc.TARGET).between(F.col("lower"), F.col("upper")).cast("int")).alias("covered"))
        for w in (0.5, 0.8, 0.95)]
    return reduce(lambda a, b: a.unionByName(b), shares)


@query()
def additive_info(spark, root):
    return additive(spark, root).info(spark)


@query(total_revenue=2)
def additive_series_info(spark, root):
    return series_info(tables(spark, root).sales)


@query(total_revenue_covered=2)
def additive_training_summary(spark, root):
    return training_summary(series_info(tables(spark, root).sales))


# --- comparison

@query()
def compare_models(spark, root):
    return scores(spark, root)


@query()
def backtest_summary(spark, root):
    return compare.backtest_summary(scores(spark, root))


@query()
def overall_metrics(spark, root):
    return compare.overall_metrics(scores(spark, root))


@query()
def fold_stability(spark, root):
    return compare.fold_stability(scores(spark, root))


@query()
def model_ranks(spark, root):
    return compare.model_ranks(scores(spark, root))


@query()
def best_by_metric(spark, root):
    return compare.best_by_metric(scores(spark, root))


@query()
def overall_winner(spark, root):
    return compare.overall_winner(compare.model_ranks(scores(spark, root)))


@query()
def comparison_report(spark, root):
    report = compare.comparison_report(scores(spark, root))
    return report.select("models_evaluated", "total_folds", "overall_winner", F.inline("best_model_by_metric"))


@query()
def comparison_counts(spark, root):
    return compare.comparison_counts(scores(spark, root))


# --- exports and dashboard

@query()
def forecast_export(spark, root):
    return exports.forecast_export(forecasts(spark, root))


@query()
def store_risk(spark, root):
    return exports.store_risk(tables(spark, root).sales)


@query(total_sales=2, total_markdown_spend=4)
def markdown_roi(spark, root):
    return exports.markdown_roi(filled(spark, root))


@query(total_revenue=2)
def dashboard_summary(spark, root):
    return exports.dashboard_summary(tables(spark, root).sales)


@query()
def data_summary(spark, root):
    return exports.data_summary(featured(spark, root))


@query(total_sales=2)
def store_dept_mapping(spark, root):
    return exports.store_dept_mapping(merged(spark, root))


@query()
def top_risk(spark, root):
    return exports.top_risk(exports.store_risk(tables(spark, root).sales))


@query(total_sales=2, total_markdown_spend=4)
def top_roi(spark, root):
    return exports.top_roi(exports.markdown_roi(filled(spark, root)))


@query()
def model_metrics(spark, root):
    return exports.model_metrics(forecasts(spark, root))


@query()
def series_view(spark, root):
    return exports.series_view(forecasts(spark, root), 3, 2, "train_mean")


@query()
def series_scores(spark, root):
    return exports.series_scores(forecasts(spark, root), 3, 2, "train_mean")


@query()
def holiday_rows(spark, root):
    return exports.holiday_rows(forecasts(spark, root))


@query(total_sales=2)
def sales_trend(spark, root):
    return exports.sales_trend(tables(spark, root).sales)


@query(total_sales=2)
def sales_stats(spark, root):
    return exports.sales_stats(tables(spark, root).sales)


@query(total_sales=2)
def store_top(spark, root):
    return exports.store_top(tables(spark, root).sales)


@query(total_sales=2)
def dept_distribution(spark, root):
    return exports.dept_distribution(tables(spark, root).sales)


@query()
def holiday_impact(spark, root):
    return exports.holiday_impact(tables(spark, root).sales)
