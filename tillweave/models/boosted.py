"""One boosted-tree model for the whole panel."""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..functions.expr import one_row
from ..operators.features import aligned, feature_columns
from ..operators.quality import require_model_input
from ..operators.scoring import metrics, metrics_by
from ..operators.splits import as_array, expanding_bounds, split_dates, time_split
from ..schema import DATE, TARGET
from ..sources.files import read_json, write_json
from ..sources.versions import current, new_version, publish
from . import trees as tr

_META = "name string, features array<string>, params map<string,double>, history array<double>, val double, base double, edges array<array<double>>, grown int"
_NODES = "tree int, node int, feature int, bin int, value double, gain double, n long"


@dataclass(frozen=True)
class BoostedParams:
    trees: int = 100
    depth: int = 6
    rate: float = 0.1
    row_share: float = 0.8
    feature_share: float = 0.8
    seed: int = 42


@dataclass(frozen=True)
class Prepared:
    """Feature rows binned once: what all folds and splits of one table fit from."""

    columns: list[str]
    edges: list[list[float]]
    blocks: DataFrame


def _day(d: datetime.date) -> int:
    """Days since 1970."""
    return datetime.date(d.year, d.month, d.day).toordinal() - datetime.date(1970, 1, 1).toordinal()


def _score_folds(df: DataFrame, columns: Sequence[str], models: dict[int, tr.Ensemble]) -> Column:
    """The prediction of each row by the model of its ``fold`` alone, never negative; null for a fold without a model."""
    if not models:
        return F.lit(None).cast("double")

    def score(fold: pa.Array, rows: pa.Array) -> pa.Array:
        values = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), len(columns))
        of, out = fold.to_numpy(zero_copy_only=False), np.zeros(len(rows))
        for k, model in models.items():
            mine = np.flatnonzero(of == k)
            if len(mine):
                out[mine] = np.maximum(model.predict(values[mine]), 0.0)
        return pa.array(out, mask=~np.isin(of, list(models)))

    return F.arrow_udf(score, "double")("fold", F.array(*aligned(df, columns)))


@dataclass
class GlobalModel:
    """Estimator: ``fit`` returns a fitted copy and leaves this one as it is."""

    params: BoostedParams = field(default_factory=BoostedParams)
    columns: Sequence[str] = ()
    model: tr.Ensemble | None = None
    name: str = "boosted"
    val: float | None = None

    @property
    def history(self) -> list[float]:
        """Mean squared validation error of the rounds until training stopped."""
        return self.model.history if self.model else []

    @property
    def best_round(self) -> int | None:
        return 1 + self.history.index(min(self.history)) if self.history else None

    def prepare(self, df: DataFrame) -> Prepared:
        """Bounds of the bins from all rows of ``df``, and its binned rows; reads the table once for each of the two."""
        columns = feature_columns(require_model_input(df))
        values = aligned(df, columns)
        edges = tr.edges_of(df, values)
        return Prepared(columns, edges, tr.blocks(df, values, edges))

    def fit_ranges(self, prepared: Prepared, ranges: Sequence[tr.Fit], val: float | None = None, patience: int = 10) -> list[GlobalModel | None]:
        """One model per range of days, all grown side by side from the binned rows; None for a range without rows."""
        p = self.params
        models = tr.grow(prepared.blocks, prepared.edges, ranges, p.trees, p.depth, p.rate, p.row_share, p.feature_share, p.seed, patience)
        return [e and replace(self, columns=prepared.columns, model=e, val=val) for e in models]

    def fit(self, train: DataFrame, val: float | None = None, patience: int = 10) -> GlobalModel:
        """Train on all rows, or with ``val`` on the first dates only, and stop early.

        Then the last share of the dates judges each round: training stops after
        ``patience`` rounds without a lower error, and the trees up to the best round are
        kept. The trees grow on partial histograms, so rows stay where they are.
        """
        days = train.agg(F.min(F.to_date(DATE)).alias("first"), F.max(F.to_date(DATE)).alias("last")).first()
        if days["first"] is None:
            raise ValueError("no rows to fit")
        first, last = _day(days["first"]), _day(days["last"])
        whole = tr.Fit(first, last)
        if val is not None:
            bound = _day(split_dates(train, val).first()["test_start"])  # as in time_split, its last training date
            whole = tr.Fit(first, bound, bound + 1, last)
        return self.fit_ranges(self.prepare(train), [whole], val, patience)[0]

    def fit_folds(self, df: DataFrame, bounds: Sequence) -> list[GlobalModel | None]:
        """A model for each of the folds, grown side by side; ``bounds`` have train_start and train_end."""
        return self.fit_ranges(self.prepare(df), [tr.Fit(_day(b["train_start"]), _day(b["train_end"])) for b in bounds])

    def _fitted(self) -> tr.Ensemble:
        if self.model is None:
            raise ValueError("fit the model first")
        return self.model

    def _score(self, df: DataFrame) -> Column:
        model, width = self._fitted(), len(self.columns)

        def score(rows: pa.Array) -> pa.Array:
            values = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)
            return pa.array(np.maximum(model.predict(values), 0.0))

        return F.arrow_udf(score, "double")(F.array(*aligned(df, self.columns)))

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``y_pred``, never negative; absent features and nulls count as 0."""
        self._fitted()
        require_model_input(df, require_target=False)
        return df.withColumn("y_pred", self._score(df))

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        """Each feature's share in what all splits have gained."""
        rows = [(c, float(w)) for c, w in zip(self.columns, self._fitted().importance())]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The trees: a row for each node, with the bound that its split compares with (``<=`` goes left)."""
        model = self._fitted()
        rows = [(k, node, int(t.feature[node]), int(t.bin[node]), float(t.value[node]), float(t.gain[node]), int(t.rows[node]))
                for k, t in enumerate(model.trees) for node in np.flatnonzero((t.feature >= 0) | (t.rows > 0)).tolist()]
        names = F.array(*[F.lit(c) for c in self.columns])
        bounds = F.array(*[F.array(*[F.lit(v) for v in e]).cast("array<double>") for e in model.edges])
        df = spark.createDataFrame(rows, _NODES)
        split = F.col("feature") >= 0
        return df.withColumn("name", F.when(split, F.get(names, F.greatest("feature", F.lit(0))))).withColumn(
            "bound", F.when(split, F.get(F.get(bounds, F.greatest("feature", F.lit(0))), F.col("bin"))))

    def fit_metrics(self, df: DataFrame) -> DataFrame:
        """All metrics of the predictions for ``df``."""
        return metrics(self.predict(df).withColumn("y_true", F.col(TARGET)))

    def split_metrics(self, df: DataFrame) -> DataFrame:
        """All metrics on the dates that the trees were grown on and on those that stopped them."""
        if self.val is None:
            raise ValueError("fit with val first")
        return metrics_by(time_split(self.predict(df), self.val).withColumn("y_true", F.col(TARGET)), ["split"])

    def cross_validate(self, df: DataFrame, n_splits: int = 5) -> DataFrame:
        """Rows, MAE, RMSE and MAPE of each expanding-window split, and their means in a
        row without a fold. All splits are fitted side by side and scored in one pass."""
        bounds = expanding_bounds(df, n_splits)
        splits = bounds.orderBy("fold").collect()
        schema = "fold int, rows long, mae double, rmse double, mape double"
        if not splits:
            return df.sparkSession.createDataFrame([], schema)
        models = self.fit_folds(df, splits)
        within = F.filter("_bounds", lambda b: F.col(DATE).between(b["test_start"], b["test_end"]))
        tested = one_row(df, as_array(bounds)).withColumn("fold", F.explode(F.transform(within, lambda b: b["fold"]))).drop("_bounds")
        of_folds = {b["fold"]: model._fitted() for b, model in zip(splits, models) if model is not None}
        columns = next((list(model.columns) for model in models if model is not None), [])
        scores = tested.withColumn("y_pred", _score_folds(tested, columns, of_folds)).where("y_pred is not null").groupBy("fold").agg(
            F.count(F.lit(1)).alias("rows"), m.mae(TARGET, "y_pred").alias("mae"), m.rmse(TARGET, "y_pred").alias("rmse"),
            m.mape(TARGET, "y_pred", guard=False).alias("mape"))
        mean = scores.agg(F.lit(None).cast("int").alias("fold"), F.sum("rows").alias("rows"), *[F.avg(c).alias(c) for c in ("mae", "rmse", "mape")])
        return scores.unionByName(mean)

    def info(self, spark: SparkSession) -> DataFrame:
        """Settings, and what a fitted model knows: trees kept, rounds tried, the best
        round and its validation error (RMSE)."""
        fitted = self.model is not None
        row = (self.name, fitted, len(self.columns), TARGET, "BoostedTrees", *asdict(self.params).values(),
               len(self.model.trees) if fitted else None, self.model.grown if fitted else None, self.best_round,
               math.sqrt(min(self.history)) if self.history else None)
        return spark.createDataFrame([row], (
            "model_name string, is_fitted boolean, feature_count int, target_column string, model_type string, "
            "trees int, depth int, rate double, row_share double, feature_share double, seed int, "
            "trees_kept int, rounds int, best_round int, val_rmse double"))

    def save(self, spark: SparkSession, path: str) -> str:
        """A new version below ``path``; it counts once all of it is written."""
        model, at = self._fitted(), new_version(spark, path)
        self.nodes(spark).select(*[c.split()[0] for c in _NODES.split(", ")]).coalesce(1).write.parquet(f"{at}/trees")
        meta = [(self.name, list(self.columns), {k: float(v) for k, v in asdict(self.params).items()}, list(self.history), self.val,
                 float(model.base), [list(map(float, e)) for e in model.edges], model.grown)]
        write_json(spark.createDataFrame(meta, _META), f"{at}/meta")
        publish(spark, at)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> GlobalModel:
        at = current(spark, path)
        meta = read_json(spark, f"{at}/meta", spark.createDataFrame([], _META).schema).first()
        kinds = {k: type(v) for k, v in asdict(BoostedParams()).items()}
        params = BoostedParams(**{k: kinds[k](v) for k, v in meta.params.items()})
        grown: dict[int, tr.Tree] = {}
        for r in spark.read.schema(_NODES).parquet(f"{at}/trees").collect():  # a row per node
            t = grown.setdefault(r["tree"], tr.Tree.empty(params.depth))
            t.feature[r["node"]], t.bin[r["node"]], t.value[r["node"]] = r["feature"], r["bin"], r["value"]
            t.gain[r["node"]], t.rows[r["node"]] = r["gain"], r["n"]
        kept = 1 + max(grown, default=-1)
        trees = [grown.get(k) or tr.Tree.empty(params.depth) for k in range(kept)]
        model = tr.Ensemble([list(e) for e in meta.edges], meta.base, params.rate, params.depth, trees, list(meta.history), meta.grown)
        return cls(params, list(meta.features), model, meta.name, meta.val)
