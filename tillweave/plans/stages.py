"""The pipeline's stages from tables to exports, each one a composition of operators.

Stages hand over through written tables, so a later stage neither repeats an
earlier one nor depends on the executors that ran it.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators import backtest as bt
from ..operators import cleaning, compare, exports, features, quality, relational
from ..operators.relational import canonical_sort
from ..session import materialise
from ..sources import files, layout


def prepare(sales: DataFrame, covariates: DataFrame, stores: DataFrame, out: str) -> DataFrame:
    """Quality report, merge, clean, features; writes ``quality``, ``cleaned``,
    ``features``, ``mapping`` and ``summary`` below ``out`` and returns the features."""
    spark = sales.sparkSession
    quality.require_unique_keys(sales)
    quality.require_unique_keys(covariates, ("Store", "Date"))
    files.write_json(quality.quality_report(sales, covariates, stores), f"{out}/quality")
    merged = relational.merge_sources(sales, cleaning.fill_markdowns(covariates), stores)
    files.write_parquet(exports.store_dept_mapping(merged), f"{out}/mapping")
    cleaned = cleaning.clean_panel(sales, covariates, stores, stage=partial(materialise, name="days"))
    files.write_parquet(cleaned, f"{out}/cleaned")
    written = files.read_parquet(spark, f"{out}/cleaned")
    table = features.build_features(layout.dealt(written, written.count()))
    files.write_parquet(canonical_sort(table), f"{out}/features")
    done = files.read_parquet(spark, f"{out}/features")
    files.write_json(exports.data_summary(done), f"{out}/summary")
    return done


def run_backtests(panel: DataFrame, models: Sequence[bt.Forecaster], out: str, folds: int = 4, horizon: int = 13,
                  baselines: Sequence[int | str] = (4, 13, "mean")) -> DataFrame:
    """Predictions of the baselines and of ``models`` per fold, written by model and
    fold, with their comparison; returns the predictions."""
    slim = [c for c in ("Store", "Dept", "Date", "Weekly_Sales", "IsHoliday", "MarkDownSum") if c in panel.columns]
    parts = [bt.baseline_forecast(panel.select(*slim), baselines, folds, horizon)]
    for model in models:
        found = bt.backtest(panel, model, folds, horizon).where("error is null")
        parts.append(found.select("model", "fold", *slim, "y_true", "y_pred"))
    preds = relational.union_forecasts(*parts)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in preds.schema.fields])
    files.write_predictions(preds, f"{out}/predictions")
    written = files.read_predictions(panel.sparkSession, f"{out}/predictions", schema)
    scores = compare.compare(written)
    files.write_parquet(scores, f"{out}/comparison")
    files.write_json(compare.backtest_summary(scores), f"{out}/backtest_summary")
    return written


def compare_models(spark: SparkSession, out: str) -> DataFrame:
    """Overall metrics, stability, ranks and report from the written comparison."""
    scores = files.read_parquet(spark, f"{out}/comparison")
    files.write_csv(compare.overall_metrics(scores), f"{out}/overall_metrics")
    files.write_csv(compare.fold_stability(scores), f"{out}/fold_stability")
    files.write_json(compare.model_ranks(scores), f"{out}/rankings")
    report = compare.comparison_report(scores)
    files.write_json(report, f"{out}/report")
    return report


def export_dashboard(panel: DataFrame, preds: DataFrame, out: str) -> None:
    files.write_csv(exports.forecast_export(preds), f"{out}/forecasts_store_dept")
    files.write_csv(exports.store_risk(panel), f"{out}/store_risk")
    files.write_csv(exports.markdown_roi(panel), f"{out}/markdown_roi")
    files.write_json(exports.dashboard_summary(panel), f"{out}/dashboard_summary")
