"""Rolling-origin backtests of pluggable forecasters."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import one_row
from ..functions.windows import series_window, trailing
from ..schema import DATE, METRICS, SERIES, TARGET
from .scoring import metrics_by
from .splits import as_array, fold_bounds


class Forecaster(Protocol):
    """What a backtest needs: ``fit`` on training rows gives something whose
    ``predict`` adds a ``y_pred`` column to test rows."""

    name: str

    def fit(self, train: DataFrame): ...


def backtest(df: DataFrame, model: Forecaster, folds: int = 4, horizon: int = 13, date: str = DATE,
             target: str = TARGET, parallel: int = 1) -> DataFrame:
    """Fit and predict fold by fold; the driver loops over the few folds only, of which
    ``parallel`` are fitted at a time.

    A fold whose fit raises gives one row instead, with the fold's number and the
    ``error``, which is null in all others. The bounds are collected, one row per fold,
    so that each fold is a plain date filter on the panel. A model that has ``fit_folds``
    fits all folds side by side; where that fails, they are tried one by one.
    """
    folds_ = fold_bounds(df, folds, horizon, date).orderBy("fold").collect()

    def scored(b, fitted) -> DataFrame:
        test = df.where(F.col(date).between(F.lit(b.test_start), F.lit(b.test_end)))
        return fitted.predict(test).select(
            F.lit(model.name).alias("model"), F.lit(b.fold).alias("fold"), *[F.col(c) for c in df.columns],
            F.col(target).alias("y_true"), "y_pred", F.lit(None).cast("string").alias("error"))

    def run(b) -> DataFrame | tuple:
        train = df.where(F.col(date).between(F.lit(b.train_start), F.lit(b.train_end)))
        try:
            return scored(b, model.fit(train))
        except Exception as error:  # any model may fail; the other folds still count
            return model.name, b.fold, str(error)

    results = None
    if folds_ and hasattr(model, "fit_folds"):
        try:
            results = [scored(b, m) if m is not None else (model.name, b.fold, "no rows to fit") for b, m in zip(folds_, model.fit_folds(df, folds_))]
        except Exception:  # which fold it was shows below
            pass
    if results is None:
        with ThreadPoolExecutor(parallel) as pool:
            results = list(pool.map(inheritable_thread_target(df.sparkSession)(run), folds_))
    done, failed = [x for x in results if isinstance(x, DataFrame)], [x for x in results if isinstance(x, tuple)]
    if not done:
        raise ValueError(f"no fold of {model.name} could be fitted: {[e for _, _, e in failed]}")
    if failed:
        done.append(df.sparkSession.createDataFrame(failed, "model string, fold int, error string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), done)


def _label(kind: str | int) -> str:
    return "train_mean" if kind == "mean" else f"trailing_{kind}_mean"


class SeriesMean:
    """Forecast of a series: the mean of its last ``rows`` training rows, or of all
    of them. Series without training rows, and negative means, give 0. The limit on
    the row number works within each task before the shuffle."""

    def __init__(self, rows: int | None = 4, by: Sequence[str] = SERIES, target: str = TARGET):
        self.rows, self.by, self.target = rows, list(by), target
        self.name = _label("mean" if rows is None else rows)
        self.levels: DataFrame | None = None

    def fit(self, train: DataFrame) -> SeriesMean:
        fitted = SeriesMean(self.rows, self.by, self.target)
        if self.rows is not None:
            last = Window.partitionBy(*self.by).orderBy(F.col(DATE).desc())
            train = train.withColumn("_rd", F.row_number().over(last)).where(F.col("_rd") <= self.rows)
        fitted.levels = train.groupBy(*self.by).agg(F.avg(self.target).alias("_level"))
        return fitted

    def predict(self, df: DataFrame) -> DataFrame:
        if self.levels is None:
            raise ValueError("fit the model first")
        level = F.greatest(F.coalesce("_level", F.lit(0.0)), F.lit(0.0))
        return df.join(self.levels, self.by, "left").withColumn("y_pred", level).drop("_level")


def baseline_forecast(df: DataFrame, kinds: Sequence[int | str] = (4, 13, "mean"), folds: int = 4, horizon: int = 13,
                      by: Sequence[str] = SERIES, target: str = TARGET) -> DataFrame:
    """All folds of several series-mean baselines in one plan.

    ``kinds`` are row counts of trailing means, or "mean" for the training mean.
    The trailing means are running columns of one window pass; per fold and series
    the value at the last training row is kept. The panel is shuffled once, by
    series: the aggregate and the join that follow reuse that partitioning.
    """
    by = list(by)
    bounds = fold_bounds(df, folds, horizon)
    w = series_window(by)
    means = {_label(k): F.avg(target).over(trailing(w, k)) for k in kinds if k != "mean"}
    tracked = one_row(df.withColumns({f"_{n}": c for n, c in means.items()}), as_array(bounds))

    def level(k: int | str, f: int) -> Column:
        b = F.get("_bounds", F.lit(f))
        learnt = F.col(DATE).between(b["train_start"], b["train_end"])
        if k == "mean":
            return F.avg(F.when(learnt, F.col(target)))
        return F.max_by(f"_{_label(k)}", F.when(learnt, F.col(DATE)))

    # one row per series with the levels of all folds: no row is copied
    levels = tracked.groupBy(*by).agg(*[
        F.array(*[level(k, f) for f in range(folds)]).alias(f"_level_{_label(k)}") for k in kinds])
    tested = F.filter("_bounds", lambda b: F.col(DATE).between(b["test_start"], b["test_end"]))
    test = one_row(df, as_array(bounds)).select(F.explode(F.transform(tested, lambda b: b["fold"])).alias("fold"), *df.columns)
    named = F.array(*[F.struct(
        F.lit(_label(k)).alias("model"),
        F.greatest(F.coalesce(F.get(f"_level_{_label(k)}", F.col("fold") - 1), F.lit(0.0)), F.lit(0.0)).alias("y_pred")) for k in kinds])
    return (test.join(levels, by, "left")
            .select(F.explode(named).alias("_f"), "fold", *df.columns)
            .select("_f.model", "fold", *df.columns, F.col(target).alias("y_true"), "_f.y_pred"))


def evaluate_fold(preds: DataFrame, fold: int) -> DataFrame:
    return metrics_by(preds.where(F.col("fold") == fold), ["model", "fold"])


def fold_metrics(preds: DataFrame) -> DataFrame:
    return metrics_by(preds, ["model", "fold"])


def fold_summary(scores: DataFrame) -> DataFrame:
    """Mean, sample deviation, least and greatest value of each metric over the folds."""
    stats = (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    return scores.groupBy("model").agg(*[fn(m).alias(f"{m}_{n}") for m in METRICS for n, fn in stats])
