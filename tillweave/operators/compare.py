"""Comparison of models from their metrics per fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ratio, unpivot
from ..schema import METRICS
from .backtest import fold_metrics, fold_summary


def compare(preds: DataFrame) -> DataFrame:
    """One row per model and fold with all metrics."""
    return fold_metrics(preds)


def backtest_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model").agg(*[fn(m).alias(f"{n}_{m}") for m in METRICS
                                         for n, fn in (("mean", F.avg), ("std", F.stddev_samp))])


def overall_metrics(scores: DataFrame, digits: int = 2) -> DataFrame:
    """The fold summary, rounded half to even."""
    summary = fold_summary(scores)
    return summary.select("model", *[F.bround(c, digits).alias(c) for c in summary.columns if c != "model"])


def fold_stability(scores: DataFrame, metrics: Sequence[str] = ("mae", "rmse", "mape"), digits: int = 2) -> DataFrame:
    """Coefficient of variation over the folds, in percent."""
    return scores.groupBy("model").agg(*[
        F.bround(100 * ratio(F.stddev_samp(m), F.avg(m)), digits).alias(f"{m}_cv") for m in metrics])


def _long(scores: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    return unpivot(scores, {m: F.col(m) for m in metrics if m in scores.columns}, "metric", "score", ("model", "fold"))


def model_ranks(scores: DataFrame) -> DataFrame:
    """Mean rank of each model per metric; within a fold, ties share the mean of their ranks."""
    long = _long(scores).where("score is not null and not isnan(score)")
    fold = Window.partitionBy("fold", "metric").orderBy("score")
    peers = Window.partitionBy("fold", "metric", "score")
    rank = F.rank().over(fold) + (F.count(F.lit(1)).over(peers) - 1) / 2
    return long.withColumn("rank", rank).groupBy("metric", "model").agg(F.avg("rank").alias("avg_rank"))


def best_by_metric(scores: DataFrame, digits: int = 2) -> DataFrame:
    """Model with the least mean score per metric; equal scores go by name."""
    means = _long(scores).groupBy("metric", "model").agg(F.avg("score").alias("score"))
    best = means.groupBy("metric").agg(F.min(F.struct("score", "model")).alias("b"))
    return best.select("metric", "b.model", F.bround("b.score", digits).alias("score"))


def overall_winner(ranks: DataFrame) -> DataFrame:
    """Model with the least mean of its mean ranks."""
    return (ranks.groupBy("model").agg(F.avg("avg_rank").alias("mean_rank"))
            .orderBy("mean_rank", "model").limit(1))


def comparison_counts(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count_distinct("model").alias("models_evaluated"), F.count_distinct("fold").alias("total_folds"))


def comparison_report(scores: DataFrame) -> DataFrame:
    """Counts, winner and best model per metric as one row for the JSON sink."""
    best = best_by_metric(scores).agg(F.sort_array(F.collect_list(F.struct("metric", "model", "score"))).alias("best_model_by_metric"))
    winner = overall_winner(model_ranks(scores)).select(F.col("model").alias("overall_winner"))
    return comparison_counts(scores).crossJoin(best).crossJoin(winner)
