"""Forecast models: recovered structure, bounds, persistence."""

import os
import pickle
import shutil

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from tillweave.models.additive import AdditiveParams, LocalModel, partial_sums, regressors, solve_mode
from tillweave.models import additive, boosted, trees
from tillweave.models.boosted import BoostedParams, GlobalModel
from tillweave.operators.backtest import backtest
from tillweave.operators.calendar import HOLIDAY_NAMES
from tillweave.operators.splits import expanding_bounds
from tillweave.session import scratch_path
from tillweave.sources import versions


@pytest.fixture(scope="module")
def seasonal(spark, panel):
    """Level, trend and a yearly wave, different for each series; little noise."""
    day = F.datediff("Date", F.lit("2020-01-05"))
    wave = F.sin(2 * np.pi * day / 365.25)
    return panel.withColumn("Weekly_Sales", 20000 * F.col("Store") + 10 * day * F.col("Dept") + 3000 * wave
                            + (F.col("Weekly_Sales") % 100))


def test_fits_trend_and_season(spark, seasonal):
    model = LocalModel(top_n=4).fit(seasonal)
    assert model.table.count() == 4 and model.table.where("error is not null").count() == 0
    got = model.predict_intervals(seasonal)
    assert got.count() == seasonal.count()
    known = got.join(model.table.select("Store", "Dept"), ["Store", "Dept"], "left_semi")
    error = known.agg(F.avg(F.abs(F.col("y_pred") - F.col("Weekly_Sales"))), F.avg("Weekly_Sales")).first()
    assert error[0] / error[1] < 0.01
    assert got.where("lower > y_pred or upper < y_pred or lower < 0").count() == 0
    others = got.join(model.table.select("Store", "Dept"), ["Store", "Dept"], "left_anti")
    assert others.count() == 312 and others.where("y_pred <> 0").count() == 0


def test_forecast_ahead_widens(spark, seasonal):
    train = seasonal.where("Date < '2022-07-01'")
    got = LocalModel(top_n=1).fit(train).predict_intervals(seasonal.where("Date >= '2022-07-01'"))
    ahead = got.where("y_pred > 0").orderBy("Date").toPandas()
    assert len(ahead) > 20
    assert np.mean(np.abs(ahead.y_pred / ahead.Weekly_Sales - 1)) < 0.05
    width = (ahead.upper - ahead.lower).to_numpy()
    assert (np.diff(width) >= -1e-6).all()


def test_partitioning_does_not_change_the_fit(spark, seasonal):
    a, b = (np.array([r.sigma for r in LocalModel(top_n=3).fit(df).table.orderBy("Store", "Dept").collect()])
            for df in (seasonal.coalesce(1), seasonal.repartition(11)))
    assert a == pytest.approx(b, rel=1e-4)


def test_solver_equals_ridge_without_laplace():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(scale=0.1, size=500)
    beta, sigma = solve_mode(x.T @ x, x.T @ y, float(y @ y), 500, np.full(3, 10.0), np.zeros(3, dtype=bool))
    assert beta == pytest.approx([1.0, -2.0, 0.5], abs=0.02) and sigma == pytest.approx(0.1, rel=0.1)


def test_short_series_are_left_out(spark, seasonal):
    few = seasonal.where("Store = 3 and Dept = 1 and Date < '2020-02-20'")
    rest = seasonal.where("Store < 3")
    assert LocalModel(top_n=None).fit(few.unionByName(rest)).table.where("Store = 3").count() == 0


def test_local_save_and_load(spark, seasonal):
    model = LocalModel(AdditiveParams(year_order=5), top_n=2).fit(seasonal)
    again = LocalModel.load(spark, model.save(scratch_path(spark, "local")))
    assert again.params == model.params and again.top_n == 2
    a, b = (sorted(map(tuple, m.predict(seasonal).select("Store", "Dept", "Date", F.round("y_pred", 4)).collect())) for m in (model, again))
    assert a == b
    assert again.info(spark).first().n_series == 2
    with pytest.raises(ValueError, match="fit"):
        LocalModel().predict(seasonal)


@pytest.fixture(scope="module")
def table(seasonal):
    return seasonal.withColumns({"week": F.weekofyear("Date"), "shop": F.col("Store"), "flag": F.col("IsHoliday").cast("int"),
                                 "day": F.datediff("Date", F.lit("2020-01-05"))}).drop("IsHoliday")


def test_boosted(spark, table):
    model = GlobalModel(BoostedParams(trees=10, depth=4)).fit(table)
    scores = model.fit_metrics(table).first()
    assert scores.mape < 25
    importance = model.feature_importance(spark).collect()
    assert {r.feature for r in importance} == {"week", "shop", "flag", "day"} and importance[0].feature == "shop"
    assert sum(r.importance for r in importance) == pytest.approx(1)
    assert model.predict(table).where("y_pred < 0").count() == 0
    assert model.predict(table.drop("flag")).count() == table.count()
    again = GlobalModel.load(spark, model.save(spark, scratch_path(spark, "boosted")))
    assert again.params == model.params
    assert again.fit_metrics(table).first() == pytest.approx(scores)


def noisy(table):
    """Nothing to learn beyond the shop: later rounds only fit the noise."""
    return table.withColumn("Weekly_Sales", 20000 * F.col("Store") + F.pmod(F.xxhash64("Store", "Dept", "Date"), F.lit(30000)))


def test_boosted_stops_early(spark, table, monkeypatch):
    """Training stops, no round is run beyond the patience, and the tail is cut."""
    rounds, level = set(), trees._level
    monkeypatch.setattr(trees, "_level", lambda *a: (rounds.add(a[8]), level(*a))[1])
    data = noisy(table)
    model = GlobalModel(BoostedParams(trees=40, depth=5, rate=0.5)).fit(data, val=0.2, patience=5)
    info = model.info(spark).first()
    assert info.rounds < 40 and info.best_round == info.rounds - 5 == info.trees_kept == len(model.model.trees)
    assert max(rounds) == info.rounds + 1  # the last one only judged what was grown before
    assert info.val_rmse ** 2 == pytest.approx(min(model.history))
    scores = {r.split: r for r in model.split_metrics(data).collect()}
    assert scores["test"].rmse == pytest.approx(info.val_rmse, rel=1e-6) and scores["train"].rmse > 0
    assert sum(r.importance for r in model.feature_importance(spark).collect()) == pytest.approx(1)
    again = GlobalModel.load(spark, model.save(spark, scratch_path(spark, "stopped")))
    assert again.info(spark).first() == info
    with pytest.raises(ValueError, match="val"):
        GlobalModel(BoostedParams(trees=1)).fit(table).split_metrics(table)


def test_boosted_history_is_that_of_the_trees(spark, table):
    """The error of a round equals that of the model cut after it."""
    data = noisy(table)
    model = GlobalModel(BoostedParams(trees=6, depth=3, rate=0.3)).fit(data, val=0.2, patience=6)
    rows = data.orderBy("Store", "Dept", "Date").toPandas()
    bound = sorted(rows.Date.unique())[int(0.8 * rows.Date.nunique())]
    test = rows[rows.Date > bound]
    whole = model.model.trees
    for k, error in enumerate(model.history, 1):
        if k > len(whole):
            break
        model.model.trees = whole[:k]
        pred = model.model.predict(test[list(model.columns)].to_numpy(dtype=float))
        assert np.mean((pred - test.Weekly_Sales) ** 2) == pytest.approx(error)


def test_trees_use_the_columns_drawn_for_their_round(spark, table):
    wide = table.withColumns({f"x{k}": F.pmod(F.xxhash64("Store", "Dept", "Date", F.lit(k)), F.lit(97)) for k in range(6)})
    params = BoostedParams(trees=8, depth=4, feature_share=0.5)
    model = GlobalModel(params).fit(wide)
    seen = []
    for round_, tree in enumerate(model.model.trees, 1):
        allowed = set(trees.drawn(params.seed, round_, len(model.columns), 0.5))
        used = set(tree.feature[tree.feature >= 0].tolist())
        assert used and used <= allowed and len(allowed) == 5
        seen.append(tuple(sorted(allowed)))
    assert len(set(seen)) > 1
    again = GlobalModel(params).fit(wide.repartition(7))  # same seed, other partitions: same trees
    a, b = (m.nodes(spark).orderBy("tree", "node").toPandas() for m in (model, again))
    assert a.drop(columns=["value", "gain"]).equals(b.drop(columns=["value", "gain"])) and np.allclose(a.value, b.value)


def test_fits_side_by_side_equal_separate_ones(spark, table):
    model = GlobalModel(BoostedParams(trees=4, depth=3))
    prepared = model.prepare(table)
    days = [int(d) for d in np.unique(np.concatenate([np.frombuffer(r.day, "<i4") for r in prepared.blocks.collect()]))]
    ranges = [trees.Fit(days[0], days[60]), trees.Fit(days[0], days[99], days[100], days[-1]), trees.Fit(1, 2), trees.Fit(days[0], days[-1])]
    together = model.fit_ranges(prepared, ranges, patience=2)
    assert together[2] is None
    values = table.select(*prepared.columns).toPandas().to_numpy(dtype=float)
    for k in (0, 1, 3):
        alone = model.fit_ranges(prepared, [ranges[k]], patience=2)[0]
        assert np.allclose(alone.model.predict(values), together[k].model.predict(values)) and alone.history == pytest.approx(together[k].history)


def test_a_stump_is_the_best_split(spark, table):
    """One tree of depth 1 against all splits tried one by one."""
    model = GlobalModel(BoostedParams(trees=1, depth=1, rate=1.0, row_share=1.0, feature_share=1.0)).fit(table)
    rows = table.toPandas()
    y, best = rows.Weekly_Sales.to_numpy(), None
    for k, c in enumerate(model.columns):
        for bound in model.model.edges[k]:
            left = rows[c].to_numpy(dtype=float) <= bound
            if 0 < left.sum() < len(y):
                error = y[left].var() * left.sum() + y[~left].var() * (~left).sum()
                if best is None or error < best[0]:
                    best = (error, c, bound, y[left].mean(), y[~left].mean())
    root = model.nodes(spark).where("node = 0").first()
    assert (root.name, root.bound) == best[1:3]
    assert model.model.base + model.model.trees[0].value[1:3] == pytest.approx(best[3:])
    assert root.gain == pytest.approx(y.var() * len(y) - best[0])


def test_boosted_cv(spark, table):
    params = BoostedParams(trees=5, depth=3)
    cv = GlobalModel(params).cross_validate(table, 2).orderBy("fold").collect()
    assert [r.fold for r in cv] == [None, 1, 2] and all(r.rmse >= r.mae > 0 for r in cv)
    assert cv[0].mae == pytest.approx((cv[1].mae + cv[2].mae) / 2) and cv[0].rows == cv[1].rows + cv[2].rows
    with pytest.raises(ValueError, match="fit"):
        GlobalModel().predict(table)


def test_folds_read_the_table_a_fixed_number_of_times(spark, table):
    """Bins and blocks are made once, however many folds there are."""
    made = []

    class Counted(GlobalModel):
        def prepare(self, df):
            made.append(1)
            return GlobalModel.prepare(self, df)

    preds = backtest(table, Counted(BoostedParams(trees=2, depth=2)), folds=4, horizon=5)
    assert preds.select("fold").distinct().count() == 4 and len(made) == 1 and preds.where("error is not null").count() == 0


def test_a_save_that_stops_midway_leaves_the_last_model(spark, table, monkeypatch):
    path = scratch_path(spark, "versions")
    first = GlobalModel(BoostedParams(trees=2, depth=2)).fit(table)
    first.save(spark, path)
    second = GlobalModel(BoostedParams(trees=3, depth=2)).fit(table)

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(boosted, "write_json", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        second.save(spark, path)
    assert len(GlobalModel.load(spark, path).model.trees) == 2
    monkeypatch.undo()
    second.save(spark, path)
    assert len(GlobalModel.load(spark, path).model.trees) == 3 and len(versions.versions(spark, path)) == 2
    assert versions.prune(spark, path) == 1 and len(GlobalModel.load(spark, path).model.trees) == 3
    with pytest.raises(FileNotFoundError):
        GlobalModel.load(spark, scratch_path(spark, "nothing"))


def test_partial_sums_are_as_many_as_parts(spark, seasonal):
    day = F.datediff("Date", F.lit("1970-01-01").cast("date"))
    frames = F.array(*[F.struct(F.lit(k).alias("fold"), F.lit(18000).alias("first"), F.lit(1100).alias("span"), F.lit(2.0).alias("scale")) for k in range(2)])
    rows = seasonal.select("Store", "Dept", day.alias("day"), F.col("Weekly_Sales").alias("y"), frames.alias("frames"))
    p = AdditiveParams(changepoints=2, year_order=1, week_order=0, holidays=False)
    for df in (rows.coalesce(1), rows.repartition(9)):
        sums = partial_sums(df, p, {}, [(0, 10 ** 6), (0, 18600)]).collect()
        assert len(sums) == sum(df.where(f"day <= {last}").select("Store", "Dept", F.floor(F.col("day") / 3650)).distinct().count() for last in (10 ** 6, 18600))
        assert sum(r.n for r in sums if r.fold == 0) == seasonal.count() and all(len(r.xx) == 21 for r in sums)


def test_regressors_equal_the_design(spark, seasonal):
    """What the fit multiplies in numpy is what the prediction evaluates in Spark."""
    p = AdditiveParams()
    rows = seasonal.where("Store = 1 and Dept = 1").withColumns({"first_date": F.lit("2020-01-05").cast("date"), "span": F.lit(900)})
    named = additive._with_holidays(rows, p, rows)
    want = named.select(F.unix_date("Date"), F.array(*additive.design(p)).alias("x"), "holiday_name").collect()
    names = {r[0]: HOLIDAY_NAMES.index(r[2].removesuffix(" (observed)")) for r in want if r[2]}
    day = np.array([r[0] for r in want])
    assert np.allclose(regressors(p, day, np.full(len(day), 18266), np.full(len(day), 900), names), [r[1] for r in want])


def test_narrow_rows_are_shuffled(spark, panel):
    """Neither regressors nor a second copy of the rows for more folds: the exchange holds six narrow columns."""
    frames = F.array(F.struct(F.lit(0).alias("fold"), F.lit(0).alias("first"), F.lit(1).alias("span"), F.lit(1.0).alias("scale")))
    rows = panel.select("Store", "Dept", F.unix_date("Date").alias("day"), F.col("Weekly_Sales").alias("y"), frames.alias("frames"))
    plan = partial_sums(rows, AdditiveParams(), {}, [(0, 10 ** 6)])._jdf.queryExecution().executedPlan().toString()
    assert "sin(" not in plan.lower() and plan.count("Exchange hashpartitioning") == 1


def test_folds_in_one_job_equal_separate_fits(spark, seasonal):
    together = LocalModel(top_n=2).fit_ranges(seasonal, [(0, 18700), (0, 10 ** 6)])
    for model, df in zip(together, (seasonal.where("unix_date(Date) <= 18700"), seasonal)):
        alone = LocalModel(top_n=2).fit(df).table.orderBy("Store", "Dept").collect()
        rows = model.table.orderBy("Store", "Dept").collect()
        assert [r[:5] for r in rows] == [r[:5] for r in alone] and [r.points for r in rows] == [r.points for r in alone]
        assert np.allclose([r.beta for r in rows], [r.beta for r in alone], rtol=1e-3, atol=1e-4)
    preds = backtest(seasonal, LocalModel(top_n=None), folds=3, horizon=5)
    assert preds.where("error is not null").count() == 0 and preds.select("fold").distinct().count() == 3


def test_calibrated_intervals_cover(spark, seasonal):
    """Heavy-tailed noise: of the dates after all that was seen, intervals hold about the share they name; the uncalibrated ones do not."""
    u = (F.pmod(F.xxhash64("Store", "Dept", "Date"), F.lit(1_000_000)) + 0.5) / 1_000_000
    heavy = F.when(u < 0.5, F.log(2 * u)).otherwise(-F.log(2 * (1 - u)))  # Laplace
    many = seasonal.select("*").withColumn("Store", F.explode(F.sequence(F.col("Store") * 10, F.col("Store") * 10 + 9)))
    noisy = many.withColumn("Weekly_Sales", 30000 + 20 * F.datediff("Date", F.lit("2020-01-05")) + 1500 * heavy * F.pow(F.abs(heavy), F.lit(1.0)))
    past, ahead = noisy.where("Date < '2022-09-15'"), noisy.where("Date >= '2022-09-15'")
    share = F.avg(F.col("Weekly_Sales").between(F.col("lower"), F.col("upper")).cast("int"))
    model = LocalModel(top_n=None).calibrated(past, 13)
    for width in (0.8, 0.5):
        assert abs(model.predict_intervals(ahead, width).agg(share).first()[0] - width) < 0.05
    plain = LocalModel(top_n=None).fit(past).predict_intervals(ahead, 0.5).agg(share).first()[0]
    assert abs(plain - 0.5) > 0.05
    again = LocalModel.load(spark, model.save(scratch_path(spark, "calibrated")))
    assert again.reach == pytest.approx(model.reach)


def test_all_series_get_a_model(spark, seasonal):
    model = LocalModel(top_n=None).fit(seasonal)
    assert model.table.where("error is null").count() == 6
    assert model.predict(seasonal).where("y_pred = 0").count() == 0


def test_blocks_are_dealt_over_the_cores(spark, table, monkeypatch):
    """A table in one partition is not grown on by one task."""
    parts, level = set(), trees._level
    monkeypatch.setattr(trees, "_level", lambda *a: (parts.add(getattr(a[0], "rdd", a[0]).getNumPartitions()), level(*a))[1])
    columns = [F.col("week").cast("double"), F.col("shop").cast("double")]
    edges = trees.edges_of(table, columns)
    models = [trees.grow(trees.blocks(df, columns, edges, 100), edges, [trees.Fit(0, 10 ** 6)], 2, 2, 1.0, 1.0, 1.0, 1)[0] for df in (table.coalesce(1), table.repartition(3))]
    assert parts == {4}
    assert all((a.feature == b.feature).all() and np.allclose(a.value, b.value) for a, b in zip(*(m.trees for m in models)))


def test_short_series_are_solved_where_their_rows_meet(spark, seasonal):
    """Only series of several parts send sums on; both ways give the same model."""
    long = seasonal.where("Store = 1").withColumn("Date", F.date_add("Date", F.when(F.col("Date") < "2021-06-01", -3650).otherwise(0)))
    early = seasonal.where("Store = 3").withColumn("Date", F.date_sub("Date", 7500))  # 1999 to 2002: no fixed date cuts it
    both = long.unionByName(seasonal.where("Store = 2")).unionByName(early)
    p = AdditiveParams(changepoints=3, year_order=2, holidays=False)
    day = F.unix_date("Date")
    frames = both.groupBy("Store", "Dept").agg(F.array(F.struct(F.lit(0).alias("fold"), F.min(day).alias("first"), (F.max(day) - F.min(day)).alias("span"),
                                                                 F.max("Weekly_Sales").alias("scale"))).alias("frames"))
    rows = both.join(frames, ["Store", "Dept"]).select("Store", "Dept", day.alias("day"), F.col("Weekly_Sales").alias("y"), "frames")
    met = additive.solved_or_sums(rows, p, {}, [(0, 10 ** 6)]).collect()
    assert {r.Store for r in met if r.xx is not None} == {1} and {r.Store for r in met if r.beta is not None} == {2, 3}
    assert sum(r.n for r in met) == both.count()
    table = LocalModel(p, top_n=None).fit(both).table.collect()
    assert len(table) == 6 and all(r.error is None and r.points == 156 for r in table)
    sums = {(r.Store, r.Dept): r for r in partial_sums(rows.where("Store > 1"), p, {}, [(0, 10 ** 6)]).collect()}
    scale = p.prior()
    laplace = (np.arange(len(scale)) >= 2) & (np.arange(len(scale)) < 5)
    for r in table:
        if r.Store > 1:
            s = sums[r.Store, r.Dept]
            xx = np.zeros((len(scale),) * 2)
            xx[np.triu_indices(len(scale))] = s.xx
            beta, sigma = solve_mode(xx + np.triu(xx, 1).T, np.array(s.xy), s.yy, s.n, scale, laplace)
            assert np.allclose(beta, r.beta, rtol=1e-3, atol=1e-4) and sigma == pytest.approx(r.sigma, rel=1e-3)


def test_short_levels_are_one_stage(spark, monkeypatch):
    """Small sums need no shuffle; the trees are the same as from sums that met in tasks."""
    table = spark.range(600).selectExpr("1L as Store", "id % 2 as Dept", "date_add(date'2020-01-01', cast(id as int)) as Date",
                                        "cast((id * 37) % 101 as double) as Weekly_Sales", "cast((id * 37) % 10 as double) as a")
    columns = [F.col("a")]
    edges = trees.edges_of(table, columns)
    blocks = trees.blocks(table, columns, edges, 100)
    shuffled = []
    plain = RDD.repartitionAndSortWithinPartitions
    monkeypatch.setattr(RDD, "repartitionAndSortWithinPartitions", lambda self, *a: (shuffled.append(1), plain(self, *a))[1])

    def grown():
        return trees.grow(blocks, edges, [trees.Fit(0, 10 ** 6), trees.Fit(0, 18300)], 2, 2, 1.0, 1.0, 1.0, 1)

    near = grown()
    assert not shuffled
    monkeypatch.setattr(trees, "NEAR", 0)
    for a, b in zip(near, grown()):
        assert all((x.feature == y.feature).all() and (x.value == y.value).all() for x, y in zip(a.trees, b.trees))
    assert len(shuffled) == 4


def test_features_are_counted_together():
    """Joint counts give each feature's own; 60 features of few bins need far fewer than 60 of them."""
    sizes = [32, 3, 2, 32, 5, 1] * 10
    groups = trees._together(range(60), sizes)
    assert sorted(i for g in groups for i in g) == list(range(60)) and len(groups) <= 20
    assert all(np.prod([sizes[i] for i in g]) <= trees.CELLS for g in groups)
    rng = np.random.default_rng(1)
    node, x = rng.integers(0, 3, 500), [rng.integers(0, n, 500) for n in (4, 3, 2)]
    joint = np.bincount(node * 24 + (x[0] * 3 + x[1]) * 2 + x[2], minlength=72)
    for n, own, got in zip((4, 3, 2), x, trees._each(joint, (4, 3, 2))):
        assert (got == np.bincount(node * n + own, minlength=3 * n).reshape(3, n)).all()


def test_only_the_smaller_sibling_is_counted(spark, table, monkeypatch):
    """The larger one is what remains of the parent; the trees are those of counting both. Bins of a block travel packed."""
    columns = [F.col("week").cast("double"), F.col("shop").cast("double"), F.col("day").cast("double")]
    edges = trees.edges_of(table, columns)
    blocks = trees.blocks(table, columns, edges, 100)
    counted, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: (got := collect(self), counted.append({part[0][:2] for part in got if isinstance(part[0], tuple)}))[0])

    def grown(paired):
        monkeypatch.setattr(trees, "PAIRED", paired)
        counted.clear()
        models = trees.grow(blocks, edges, [trees.Fit(0, 10 ** 6), trees.Fit(0, 18400, 18401, 10 ** 6)], 3, 4, 0.5, 0.8, 0.7, 1, 10)
        return models, sum(len({of for of in keys if of[1] >= 0}) for keys in counted)

    (some, few), (every, all_) = grown(1), grown(10 ** 9)
    assert few < 0.7 * all_
    for a, b in zip(some, every):
        assert all((x.feature == y.feature).all() and (x.bin == y.bin).all() and (x.rows == y.rows).all() and np.allclose(x.value, y.value)
                   for x, y in zip(a.trees, b.trees))
        assert np.allclose(a.history, b.history)
    block = blocks.first()
    packed = collect(trees._state(blocks))
    assert sum(len(row[2]) for row in packed) < sum(len(r.x) for r in blocks.collect()) and len(block.x) == 3 * block.n


def test_leaves_follow_the_splits():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 8, (5, 400)).astype(np.uint8)
    for depth in (0, 1, 4, 7, 8):  # nodes of a byte, and of more
        tree = trees.Tree.empty(depth)
        inner = (1 << depth) - 1
        tree.feature[:inner], tree.bin[:inner] = rng.integers(-1, 5, inner), rng.integers(0, 7, inner)
        for row, leaf in zip(x.T, tree.leaves(x, depth).tolist()):
            at = 0
            for _ in range(depth):
                if tree.feature[at] >= 0:
                    at = 2 * at + 1 + int(row[tree.feature[at]] > tree.bin[at])
            assert leaf == at


def test_sums_are_kept_every_other_round(spark, table, monkeypatch):
    """Pending rounds give the same trees as sums written anew in every round."""
    added, add = [], trees._add
    monkeypatch.setattr(trees, "_add", lambda *a: (added.append(1), add(*a))[1])
    columns = [F.col("week").cast("double"), F.col("shop").cast("double"), F.col("day").cast("double")]
    edges = trees.edges_of(table, columns)
    blocks = trees.blocks(table, columns, edges, 100)

    def grown():
        return trees.grow(blocks, edges, [trees.Fit(0, 18400, 18401, 10 ** 6)], 5, 3, 0.5, 0.8, 0.7, 1, 10)[0]

    some = grown()
    assert len(added) < 5
    monkeypatch.setattr(trees, "KEPT", 1)
    every = grown()
    assert some.history == every.history
    assert all((a.feature == b.feature).all() and (a.value == b.value).all() for a, b in zip(some.trees, every.trees))


def test_bounds_of_bins_are_quantiles(spark, monkeypatch):
    """Exact for few values, however they are dealt out; near for many; nulls and empty tables have none."""
    monkeypatch.setattr(trees, "SORTED", 500)
    df = spark.range(8000).repartition(3).selectExpr("cast(pow(id % 7, 2) as double) as few", "cast(id * 7919 % 8000 as double) as many",
                                                     "cast(if(id % 2 = 0, id % 3, null) as double) as gaps", "cast(null as double) as none")
    columns = [F.col(c) for c in df.columns]
    few, many, gaps, none = trees.edges_of(df, columns)
    own = np.sort((np.arange(8000) % 7) ** 2)
    assert few == sorted({float(own[-(-k * 8000 // 32) - 1]) for k in range(1, 32)})
    assert len(many) == 31 and np.abs(np.array(many) - 250 * np.arange(1, 32)).max() <= 16
    assert gaps == [0.0, 1.0, 2.0] and none == [] and trees.edges_of(df.where("few < 0"), columns) == [[]] * 4
    values, rows = trees._counted(np.arange(5000.0), 1000)
    assert len(values) == 1000 and rows.sum() == 5000 and values[-1] == 4999


def test_blocks_whose_files_are_gone_are_laid_out_anew(spark, table, monkeypatch):
    """A level moves names of files only; without the files the trees are the same, near and far, and no file stays behind."""
    columns = [F.col("week").cast("double"), F.col("shop").cast("double"), F.col("day").cast("double")]
    edges = trees.edges_of(table, columns)
    blocks = trees.blocks(table, columns, edges, 100)

    def grown():
        return trees.grow(blocks, edges, [trees.Fit(0, 10 ** 6), trees.Fit(0, 18400, 18401, 10 ** 6)], 6, 3, 0.5, 0.8, 0.7, 1, 10)

    whole, paths, moved, level = grown(), set(), [], trees._level

    def losing(state, *a):
        names = state.rdd.collect()
        moved.append(sum(len(pickle.dumps(of)) for of in names))
        paths.update(path for _, _, files in names for path, _ in files)
        if len(moved) % 4 == 0:
            shutil.rmtree(os.path.dirname(names[0][2][0][0]))
        return level(state, *a)

    monkeypatch.setattr(trees, "_level", losing)
    for near in (trees.NEAR, 0):
        monkeypatch.setattr(trees, "NEAR", near)
        for a, b in zip(whole, grown()):
            assert all((x.feature == y.feature).all() and np.allclose(x.value, y.value) for x, y in zip(a.trees, b.trees)) and np.allclose(a.history, b.history)
            assert len(a.trees) == len(b.trees)
    assert len(moved) > 30 and max(moved) < 4000 and len({os.path.dirname(os.path.dirname(p)) for p in paths}) > 8
    assert not any(os.path.exists(os.path.dirname(os.path.dirname(p))) for p in paths)


def test_rows_of_a_fold_are_scored_by_its_model_alone(spark, table, monkeypatch):
    """Cross-validation equals predictions fold by fold, in one pass of one function over the rows."""
    model, made, plain = GlobalModel(BoostedParams(trees=3, depth=2)), [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda *a: (made.append(1), plain(*a))[1])
    scores = {r.fold: r for r in model.cross_validate(table, 3).collect()}
    assert len(made) == 1 and len(scores) == 4
    for b in expanding_bounds(table, 3).collect():
        alone = model.fit_folds(table, [b])[0]
        test = table.where(F.col("Date").between(F.lit(b.test_start), F.lit(b.test_end)))
        got = alone.fit_metrics(test).first()
        assert scores[b.fold].rows == test.count() and (scores[b.fold].mae, scores[b.fold].rmse) == pytest.approx((got.mae, got.rmse))
