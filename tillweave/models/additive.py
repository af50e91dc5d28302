"""One additive model per series: trend with changepoints, seasons and holidays.

    y(t) = level + slope * t + sum_j delta_j * max(t - s_j, 0) + Fourier + holidays

after Taylor & Letham, "Forecasting at Scale" (2018): normal priors on level,
slope, seasons and holidays, a Laplace prior on the slope changes, all found as a
posterior mode. Time runs from 0 to 1 over the training span, and y is divided by
its largest absolute value.

The mode depends on the rows only through the products X'X, X'y and y'y. They are added
up for each part of a series, a stretch of the calendar, and only the sums meet: a few
small matrices per series. So a series may be spread over any number of tasks.
"""

from __future__ import annotations

import datetime
import math
import operator
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import one_row
from ..operators.calendar import HOLIDAY_NAMES, holidays_of
from ..operators.quality import require_model_input
from ..operators.relational import restrict_to_series, top_series
from ..schema import DATE, SERIES, TARGET
from ..session import materialise
from ..sources.files import read_json, write_json
from ..sources.versions import current, new_version, publish

YEAR_DAYS = 365.25
WEEK_DAYS = 7.0

PARAMS_SCHEMA = (
    "Store bigint, Dept bigint, first_date date, span int, y_scale double, beta array<double>, sigma double, "
    "points bigint, error string")
_META = "name string, top_n int, params map<string,double>, reach array<double>"


@dataclass(frozen=True)
class AdditiveParams:
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    holiday_scale: float = 10.0
    changepoint_range: float = 0.8
    changepoints: int = 25
    year_order: int = 10
    week_order: int = 3
    holidays: bool = True
    slope_scale: float = 5.0

    def prior(self) -> np.ndarray:
        """Prior deviation of each coefficient, in the order of the design."""
        return np.concatenate([
            np.full(2, self.slope_scale), np.full(self.changepoints, self.changepoint_scale),
            np.full(2 * (self.year_order + self.week_order), self.season_scale),
            np.full(len(HOLIDAY_NAMES) if self.holidays else 0, self.holiday_scale)])

    def breaks(self) -> list[float]:
        """Changepoints, evenly spaced over the first part of the scaled time."""
        return [self.changepoint_range * j / self.changepoints for j in range(1, self.changepoints + 1)]


def _fourier(day: Column, period: float, order: int) -> list[Column]:
    return [fn(F.lit(2 * math.pi * k / period) * day) for k in range(1, order + 1) for fn in (F.sin, F.cos)]


def design(p: AdditiveParams, date: str = DATE) -> list[Column]:
    """The regressors of a row; need first_date, span and holiday_name.

    The same expression serves the fit and the prediction. The week's term is
    periodic in days: for data of one weekday it is constant and the prior takes it
    to zero beside the level.
    """
    t = F.datediff(date, "first_date") / F.greatest(F.col("span"), F.lit(1))
    day = F.datediff(date, F.lit("1970-01-01").cast("date")).cast("double")
    terms = [F.lit(1.0), t, *[F.greatest(t - F.lit(s), F.lit(0.0)) for s in p.breaks()],
             *_fourier(day, YEAR_DAYS, p.year_order), *_fourier(day, WEEK_DAYS, p.week_order)]
    if p.holidays:
        # A substitute day counts as its holiday.
        name = F.regexp_replace(F.coalesce("holiday_name", F.lit("")), r" \(observed\)$", "")
        terms += [(name == h).cast("double") for h in HOLIDAY_NAMES]
    return terms


def _with_holidays(df: DataFrame, p: AdditiveParams, dates: DataFrame) -> DataFrame:
    if not p.holidays:
        return df
    named = holidays_of(dates).select(F.col("Date").alias(DATE), "holiday_name")
    base = df.drop("holiday_name")
    return base.join(F.broadcast(named), DATE, "left")


#: Days of a part of a series: the rows that one partial sum stands for are bounded by it.
PART_DAYS = 3650
#: Series solved at once.
STACK = 64
_EPOCH = datetime.date(1970, 1, 1).toordinal()
_SUMS = "fold int, Store bigint, Dept bigint, xx array<double>, xy array<double>, yy double, n bigint"
_SOLVED = "first int, span int, y_scale double, beta array<double>, sigma double, error string"


def regressors(p: AdditiveParams, day: np.ndarray, first: np.ndarray, span: np.ndarray, holidays: dict[int, int]) -> np.ndarray:
    """``design`` for arrays of days since 1970: a line per row. ``holidays`` has the number of each holiday's day."""
    t = (day - first) / np.maximum(span, 1)
    angles = [2 * math.pi * k / period * day for period, order in ((YEAR_DAYS, p.year_order), (WEEK_DAYS, p.week_order)) for k in range(1, order + 1)]
    x = np.stack([np.ones(len(day)), t, *(np.maximum(t - s, 0.0) for s in p.breaks()), *(fn(a) for a in angles for fn in (np.sin, np.cos))], axis=1)
    if not p.holidays:
        return x
    named = np.zeros((len(day), len(HOLIDAY_NAMES)))
    found = np.array([holidays.get(d, -1) for d in day.tolist()])
    named[np.flatnonzero(found >= 0), found[found >= 0]] = 1.0
    return np.concatenate([x, named], axis=1)


def _sums(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """X'X, X'y, y'y and the row count."""
    return x.T @ x, x.T @ y, float(y @ y), len(y)


def _part_sums(rows: DataFrame, p: AdditiveParams, holidays: dict[int, int], ranges: Sequence[tuple[int, int]], schema: str, given: Callable[..., list]) -> DataFrame:
    """Adds up the rows of each fold and part of a series where they meet; ``given`` makes the
    columns of ``schema`` from the keys (Store, Dept, part, fold), the sums and the frames (first, span, scale, first of all folds)."""
    names, kinds = [c.split()[0] for c in schema.split(", ")], [_KINDS[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        framed: dict[tuple, tuple] = {}

        def out(keys: list[tuple]) -> pa.RecordBatch:
            cols = given(keys, [held.pop(k) for k in keys], [framed.pop(k) for k in keys]) if keys else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        for b in batches:
            if not len(b):
                continue
            store, dept, part, day = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4))
            y, frames = b.column(4).to_numpy(zero_copy_only=False), b.column(5)
            sizes = np.diff(frames.offsets.to_numpy())
            row = np.repeat(np.arange(len(b)), sizes)
            fold, first, span, scale = (c.to_numpy(zero_copy_only=False) for c in frames.flatten().flatten())
            base = np.repeat(np.minimum.reduceat(first, frames.offsets.to_numpy()[:-1] - frames.offsets[0].as_py()), sizes)
            bounds = np.array(ranges)[fold]
            inside = (day[row] >= bounds[:, 0]) & (day[row] <= bounds[:, 1])
            row, fold, first, span, scale, base = row[inside], fold[inside], first[inside], span[inside], scale[inside], base[inside]
            order = np.lexsort((fold, part[row], dept[row], store[row]))
            row, fold, first, span, scale, base = row[order], fold[order], first[order], span[order], scale[order], base[order]
            keys = np.stack([store[row], dept[row], part[row], fold], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(row)] if len(row) else [0]
            x, v = regressors(p, day[row], first, span, holidays), y[row] / scale
            for at, end in zip(cuts, cuts[1:]):
                key, sums = tuple(keys[at].tolist()), _sums(x[at:end], v[at:end])
                held[key] = tuple(map(operator.add, held[key], sums)) if key in held else sums
                framed[key] = (int(first[at]), int(span[at]), float(scale[at]), int(base[at]))
            last = (int(store[-1]), int(dept[-1]), int(part[-1]))  # the next rows may go on with it
            done = [k for k in held if k[:3] != last]
            if done:
                yield out(done)
        yield out(list(held))

    keys = [*SERIES, "part"]
    base = F.array_min(F.col("frames")["first"])  # parts are counted from a series' own first day, so ten years are never cut
    parted = rows.where(F.size("frames") > 0).select(*SERIES, F.floor((F.col("day") - base) / PART_DAYS).alias("part"), "day", "y", "frames")
    return parted.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64()), "string": pa.string()}


def _listed(keys: list[tuple], sums: list[tuple]) -> list:
    upper = np.triu_indices(len(sums[0][1]))
    store, dept, _, fold = zip(*keys)
    xx, xy, yy, n = zip(*sums)
    return [fold, store, dept, [a[upper] for a in xx], xy, yy, n]


def partial_sums(rows: DataFrame, p: AdditiveParams, holidays: dict[int, int], ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """One row of sums for each fold and part of a series, with the upper triangle of X'X.

    ``rows`` has Store, Dept, day, y and frames: (fold, first, span, scale) of the folds
    that the series has a model in. Only these reach the shuffle; the regressors are made
    where the rows of a part meet, one part after another.
    """
    return _part_sums(rows, p, holidays, ranges, _SUMS, lambda keys, sums, _: _listed(keys, sums))


def solved_or_sums(rows: DataFrame, p: AdditiveParams, holidays: dict[int, int], ranges: Sequence[tuple[int, int]]) -> DataFrame:
    """As ``partial_sums``, but a fold's series that lies in one part is solved where its rows
    met: its sums stay there, and its row has the coefficients (or the error) instead."""
    solve = _solver(p)

    def given(keys: list[tuple], sums: list[tuple], frames: list[tuple]) -> list:
        whole = [k for k, (first, span, _, base) in enumerate(frames) if (first - base) // PART_DAYS == (first + span - base) // PART_DAYS]
        found = dict(zip(whole, solve([sums[k] for k in whole])))
        cols = _listed(keys, sums)
        for c in (3, 4):
            cols[c] = [None if k in found else v for k, v in enumerate(cols[c])]
        return [*cols, *list(zip(*frames))[:3], *zip(*(found.get(k, (None, None, None)) for k in range(len(keys))))]

    return _part_sums(rows, p, holidays, ranges, f"{_SUMS}, {_SOLVED}", given)


def solve_mode(xx: np.ndarray, xy: np.ndarray, yy: float, n: int, scale: np.ndarray, laplace: np.ndarray,
               rounds: int = 60) -> tuple[np.ndarray, float]:
    """Posterior mode and noise deviation from the sums.

    The Laplace prior is treated as a normal one whose variance follows the current
    coefficient (a majorising step), the noise as the residual mean square.
    """
    beta, sigma = solve_modes(xx[None], xy[None], np.array([yy]), np.array([n]), scale, laplace, rounds)
    return beta[0], float(sigma[0])


def solve_modes(xx: np.ndarray, xy: np.ndarray, yy: np.ndarray, n: np.ndarray, scale: np.ndarray, laplace: np.ndarray,
                rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """``solve_mode`` for a stack of series; each leaves the stack when it has converged."""
    out, sigma = np.zeros(xy.shape), np.zeros(len(xy))
    seen = np.diagonal(xx, axis1=1, axis2=2).any(axis=0)  # a regressor that is 0 in all rows keeps its prior's mode, which is 0
    xx, xy, scale, laplace = xx[:, seen][:, :, seen], xy[:, seen], scale[seen], laplace[seen]
    left, beta, width = np.arange(len(xy)), np.zeros(xy.shape), len(scale)
    sigma2, spread = np.maximum(yy / np.maximum(n, 1), 1e-8), np.broadcast_to(scale ** 2, xy.shape)
    for _ in range(rounds):
        a = xx / sigma2[:, None, None]
        a[:, range(width), range(width)] += 1 / spread
        new = np.linalg.solve(a, (xy / sigma2[:, None])[:, :, None])[:, :, 0]
        fitted = (xx @ new[:, :, None])[:, :, 0]
        residual = np.maximum(yy - 2 * (new * xy).sum(axis=1) + (new * fitted).sum(axis=1), 0.0)
        sigma2 = np.maximum(residual / n, 1e-10)
        spread = np.where(laplace, np.maximum(scale * np.abs(new), 1e-8), scale ** 2)
        more = ~(np.abs(new - beta).max(axis=1, initial=0.0) < 1e-9)
        beta = new
        sigma[left] = np.sqrt(sigma2)
        out[left[:, None], np.flatnonzero(seen)] = beta
        if not more.any():
            break
        if not more.all():
            left, xx, xy, yy, n, beta, sigma2, spread = (v[more] for v in (left, xx, xy, yy, n, beta, sigma2, spread))
    return out, sigma


def _solver(p: AdditiveParams) -> Callable[[list[tuple]], list[tuple]]:
    """(coefficients, deviation, error) for each of some series' sums; a series that fails keeps its error instead."""
    scale = p.prior()
    laplace = np.zeros(len(scale), dtype=bool)
    laplace[2:2 + p.changepoints] = True

    def stacked(sums: list[tuple]) -> list[tuple]:
        xx, xy, yy, n = (np.array(c) for c in zip(*sums))
        beta, sigma = solve_modes(xx, xy, yy, n, scale, laplace)
        return [(b, s, None) if np.all(np.isfinite(b)) else (None, None, "coefficients are not finite") for b, s in zip(beta, sigma.tolist())]

    def solve(sums: list[tuple]) -> list[tuple]:
        out: list[tuple] = []
        for at in range(0, len(sums), STACK):
            some = sums[at:at + STACK]
            try:
                out += stacked(some)
            except Exception:  # one bad series must not stop the others
                for each in some:
                    try:
                        out += stacked([each])
                    except Exception as problem:
                        out.append((None, None, str(problem)))
        return out

    return solve


def _fit_series(p: AdditiveParams):
    """Adds up a series' partial sums, one row per task, and solves."""
    solve, width = _solver(p), len(p.prior())

    def fit(parts: pd.DataFrame) -> pd.DataFrame:
        n = int(parts["n"].sum())
        xx = np.zeros((width, width))
        xx[np.triu_indices(width)] = np.sum(np.stack(parts["xx"].to_numpy()), axis=0)
        xx += np.triu(xx, 1).T
        xy = np.sum(np.stack(parts["xy"].to_numpy()), axis=0)
        beta, sigma, error = solve([(xx, xy, float(parts["yy"].sum()), n)])[0]
        head = parts.iloc[0]
        return pd.DataFrame({"fold": [head.fold], "Store": [head.Store], "Dept": [head.Dept], "n": [n], "first": [head["first"]], "span": [head.span],
                             "y_scale": [head.y_scale], "beta": [beta], "sigma": [sigma], "error": [error]})

    return fit


@dataclass
class LocalModel:
    """Estimator: ``fit`` returns a fitted copy whose ``table`` has one row per series,
    written once to the shared folder."""

    params: AdditiveParams = field(default_factory=AdditiveParams)
    top_n: int | None = 50
    min_points: int = 10
    table: DataFrame | None = None
    name: str = "additive"
    reach: Sequence[float] = ()  # quantiles 0.01 to 0.99 of held-out errors in deviations

    def _frames(self, rows: DataFrame, ranges: Sequence[tuple[int, int]]) -> DataFrame:
        """(fold, Store, Dept, first, span, y_scale) of the series that get a model in a fold: the largest that have enough rows.

        One aggregate serves all folds.
        """
        def frame(k: int, first: int, last: int) -> Column:
            day = F.when(F.col("day").between(first, last), F.col("day"))
            y = F.when(day.isNotNull(), F.col("y"))
            valued = F.when(y.isNotNull(), day)
            return F.struct(F.lit(k).alias("fold"), F.count(day).alias("rows"), F.sum(y).alias("total"), F.min(valued).alias("first"),
                            (F.max(valued) - F.min(valued)).alias("span"), F.greatest(F.max(F.abs(y)), F.lit(1e-9)).alias("y_scale"))

        each = F.array(*[frame(k, *r) for k, r in enumerate(ranges)])
        frames = rows.groupBy(*SERIES).agg(each.alias("each")).select(*SERIES, F.inline("each")).where("rows > 0")
        if self.top_n is not None:
            frames = materialise(frames, "frames")
            frames = reduce(DataFrame.unionByName, [frames.where(F.col("fold") == k).orderBy(F.desc("total"), *SERIES).limit(self.top_n)
                                                    for k in range(len(ranges))])
        return frames.where((F.col("rows") >= self.min_points) & F.col("first").isNotNull())

    def fit_ranges(self, train: DataFrame, ranges: Sequence[tuple[int, int]]) -> list[LocalModel]:
        """One model per range of days since 1970, all in one job: rows are read and shuffled once for all of them."""
        p = self.params
        rows = require_model_input(train).select(*SERIES, F.unix_date(F.to_date(DATE)).alias("day"), F.col(TARGET).cast("double").alias("y"))
        frames = materialise(self._frames(rows, ranges), "frames")
        named = {}
        if p.holidays:  # some twelve days for each year of the data
            found = holidays_of(train).select("Date", F.regexp_replace("holiday_name", r" \(observed\)$", "").alias("name")).collect()
            named = {r["Date"].toordinal() - _EPOCH: HOLIDAY_NAMES.index(r["name"]) for r in found if r["name"] in HOLIDAY_NAMES}
        packed = frames.groupBy(*SERIES).agg(F.collect_list(F.struct("fold", "first", "span", F.col("y_scale").alias("scale"))).alias("frames"))
        # written once: short series are solved, only series of several parts have sums that must meet
        met = materialise(solved_or_sums(rows.where("y is not null and day is not null").join(packed, list(SERIES)), p, named, ranges), "met")
        kinds = f"fold int, Store bigint, Dept bigint, n bigint, {_SOLVED}"
        fitted = met.where("xx is null").drop("xx", "xy", "yy").unionByName(
            met.where("xx is not null").groupBy("fold", *SERIES).applyInPandas(_fit_series(p), kinds))
        table = materialise(fitted.select(
            "fold", *SERIES, F.date_from_unix_date("first").alias("first_date"), "span", "y_scale", "beta", "sigma",
            F.col("n").alias("points"), "error"), self.name)
        return [replace(self, table=table.where(F.col("fold") == k).drop("fold")) for k in range(len(ranges))]

    def fit(self, train: DataFrame) -> LocalModel:
        return self.fit_ranges(train, [(-(1 << 30), 1 << 30)])[0]

    def fit_folds(self, df: DataFrame, bounds: Sequence) -> list[LocalModel]:
        """A model for each fold; ``bounds`` have train_start and train_end."""
        return self.fit_ranges(df, [tuple(datetime.date(d.year, d.month, d.day).toordinal() - _EPOCH for d in (b["train_start"], b["train_end"])) for b in bounds])

    def calibrated(self, df: DataFrame, horizon: int = 13) -> LocalModel:
        """A fit on all of ``df`` whose intervals are as wide as the errors on its last ``horizon`` dates ask for.

        A first fit, made in the same job, leaves these dates out. How far their rows lie from
        its forecasts, in units of the model's own deviation, gives the quantiles that
        ``predict_intervals`` takes in place of the normal ones.
        """
        days = df.select(F.unix_date(F.to_date(DATE)).alias("day")).where("day is not null").distinct().orderBy(F.desc("day")).limit(horizon + 1).collect()
        if len(days) <= horizon:
            raise ValueError(f"intervals need more than {horizon} dates")
        cut = days[-1]["day"]
        held, whole = self.fit_ranges(df, [(-(1 << 30), cut), (-(1 << 30), 1 << 30)])
        rest = held._valued(df.where(F.unix_date(F.to_date(DATE)) > cut)).where(F.col("_fit").isNotNull() & F.col(TARGET).isNotNull())
        off = F.abs(F.col(TARGET) / F.col("y_scale") - F.col("_fit")) / F.greatest("_dev", F.lit(1e-12))
        found = rest.agg(F.percentile_approx(off, [k / 100 for k in range(1, 100)], 10_000).alias("q")).first()["q"]
        return replace(whole, reach=tuple(found)) if found else whole

    def _fitted(self) -> DataFrame:
        if self.table is None:
            raise ValueError("fit the model first")
        return self.table

    def _valued(self, df: DataFrame) -> DataFrame:
        """The rows with their series' scale, fit and deviation, both in its units; null without a model."""
        p = self.params
        known = self._fitted().where("beta is not null").select(
            *SERIES, "first_date", "span", "y_scale", "beta", "sigma")
        joined = _with_holidays(df.drop("holiday_name").join(known, list(SERIES), "left"), p, df)
        terms = [F.get("beta", F.lit(i)) * x for i, x in enumerate(design(p))]
        # Rows without a model skip the regressors.
        fit = F.when(F.col("beta").isNotNull(), reduce(operator.add, terms))
        t = F.datediff(DATE, "first_date") / F.greatest(F.col("span"), F.lit(1))
        ahead = F.greatest(t - 1, F.lit(0.0))
        trend_var = F.lit(0.0)
        if p.changepoints:
            change = F.aggregate(F.slice("beta", 3, p.changepoints), F.lit(0.0), lambda a, v: a + F.abs(v)) / p.changepoints
            trend_var = 2 * change * change * (p.changepoints / p.changepoint_range) * F.pow(ahead, F.lit(3.0)) / 3
        return joined.withColumns({"_fit": fit, "_dev": F.sqrt(F.col("sigma") * F.col("sigma") + trend_var)})

    def _reach(self, width: float) -> float:
        """Deviations to each side that hold the share ``width``: measured ones if calibrated, else those of a normal distribution."""
        if not self.reach:
            return NormalDist().inv_cdf((1 + width) / 2)
        return float(np.interp(width, np.arange(1, 100) / 100, self.reach))

    def predict_intervals(self, df: DataFrame, width: float = 0.8) -> DataFrame:
        """Adds ``y_pred``, ``lower`` and ``upper``, none negative; 0 for series
        without a model.

        Beyond the training span the trend may change as often and as strongly as
        it did before; its variance grows with the cube of the scaled time ahead.
        """
        require_model_input(df, require_target=False)
        z = self._reach(width)

        def clamp(c: Column) -> Column:
            return F.greatest(F.coalesce(c * F.col("y_scale"), F.lit(0.0)), F.lit(0.0))

        valued = self._valued(df).withColumns({
            "y_pred": clamp(F.col("_fit")), "lower": clamp(F.col("_fit") - z * F.col("_dev")),
            "upper": clamp(F.col("_fit") + z * F.col("_dev"))})
        return valued.select(*df.drop("holiday_name").columns, "y_pred", "lower", "upper")

    def predict(self, df: DataFrame) -> DataFrame:
        return self.predict_intervals(df).drop("lower", "upper")

    def info(self, spark: SparkSession) -> DataFrame:
        fitted = self.table is not None
        head = [(self.name, fitted, TARGET, self.top_n, *[float(v) for v in asdict(self.params).values()])]
        names = ", ".join(f"{k} double" for k in asdict(self.params))
        row = spark.createDataFrame(
            head, f"model_name string, is_fitted boolean, target_column string, top_n int, {names}")
        if not fitted:
            return row.withColumn("n_series", F.lit(0).cast("long"))
        return one_row(row, self.table.agg(F.count_if(F.col("beta").isNotNull()).cast("long").alias("n_series")))

    def save(self, path: str) -> str:
        """A new version below ``path``: parameter table and metadata; it counts once all of it is written."""
        table = self._fitted()
        spark = table.sparkSession
        at = new_version(spark, path)
        table.write.parquet(f"{at}/series")
        meta = [(self.name, self.top_n, {k: float(v) for k, v in asdict(self.params).items()}, list(self.reach))]
        write_json(spark.createDataFrame(meta, _META), f"{at}/meta")
        publish(spark, at)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LocalModel:
        at = current(spark, path)
        meta = read_json(spark, f"{at}/meta", spark.createDataFrame([], _META).schema).first()
        kinds = {k: type(v) for k, v in asdict(AdditiveParams()).items()}
        params = AdditiveParams(**{k: kinds[k](v) for k, v in meta.params.items()})
        table = spark.read.schema(PARAMS_SCHEMA).parquet(f"{at}/series")
        return cls(params, meta.top_n, table=table, name=meta.name, reach=tuple(meta.reach or ()))


def series_info(df: DataFrame, top_n: int = 50, min_points: int = 10, by: Sequence[str] = SERIES) -> DataFrame:
    """Points, dates and revenue of each series that a local model is fitted to."""
    return restrict_to_series(df, top_series(df, top_n), min_points, few=True).groupBy(*by).agg(
        F.count(F.lit(1)).alias("data_points"), F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"),
        F.sum(TARGET).alias("total_revenue"))


def training_summary(info: DataFrame) -> DataFrame:
    return info.agg(
        F.count(F.lit(1)).alias("n_series_trained"), F.sum("total_revenue").alias("total_revenue_covered"),
        F.avg("data_points").alias("avg_data_points"), F.min("first_date").alias("min_date"),
        F.max("last_date").alias("max_date"))
