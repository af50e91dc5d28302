"""Rules that the SQL comparison does not show: hot keys, blocks, edges, invariants."""

import datetime as dt
import os
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillweave import schema as sc
from tillweave import session
from tillweave.catalog import tables
from tillweave.functions import quantiles
from tillweave.functions.quantiles import approx_quantiles, exact_quantiles
from tillweave.functions.windows import in_blocks
from tillweave.operators import backtest, calendar, cleaning, compare, exports, features, quality, relational, scoring, splits
from tillweave.plans import stages
from tillweave.session import scratch_path, shared_dir
from tillweave.sources import files, layout, starschema


def rows(df, *order):
    return sorted(map(tuple, df.collect()), key=str)


# --- quantiles

@pytest.mark.parametrize("few", [3, 50, 100_000])
def test_exact_quantiles_equal_numpy(spark, few, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = np.random.default_rng(7)
    n = 3000
    data = pd.DataFrame({
        "spread": rng.normal(size=n), "ties": rng.integers(0, 4, n).astype(float),
        "hot": np.where(rng.random(n) < 0.6, 0.0, rng.exponential(size=n)),  # one value holds most rows
        "constant": 5.0, "gaps": np.where(rng.random(n) < 0.9, np.nan, rng.random(n))})
    df = spark.createDataFrame(data).select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in data.columns], F.lit(None).cast("double").alias("empty"))
    probs = (0.0, 0.1, 0.25, 0.75, 1.0)
    got = exact_quantiles(df, df.columns, probs)
    assert got.pop("empty") == [None] * len(probs)
    for c, values in got.items():
        assert values == pytest.approx(list(np.nanquantile(data[c], probs)), abs=1e-12), c


@pytest.mark.parametrize("few", [3, 100_000])
def test_weighted_quantiles_equal_repeated_rows(spark, few, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = np.random.default_rng(9)
    v, w = rng.integers(0, 40, 300).astype(float), rng.integers(1, 60, 300)
    df = spark.createDataFrame(pd.DataFrame({"v": v, "w": w}))
    got = exact_quantiles(df, ["v"], (0.0, 0.25, 0.5, 0.99), "w")["v"]
    assert got == pytest.approx(list(np.quantile(np.repeat(v, w), (0.0, 0.25, 0.5, 0.99))))


@pytest.mark.parametrize("few,most", [(20_000, 1), (2_000, 1), (100, 2)])
def test_passes_of_exact_quantiles(spark, few, most, monkeypatch):
    """One pass counts and sketches; these are the passes after it, over all columns at once."""
    monkeypatch.setattr(quantiles, "FEW", few)
    passes, plain = [], quantiles._round
    monkeypatch.setattr(quantiles, "_round", lambda *a: passes.append(1) or plain(*a))
    df = spark.range(100_000, numPartitions=5).select(F.xxhash64("id").alias("a"), (F.col("id") % 977).alias("b"), F.pow("id", F.lit(3)).alias("c"))
    got = exact_quantiles(df, df.columns, (0.25, 0.5, 0.75))
    data = df.toPandas().astype(float)
    for c, values in got.items():
        assert values == pytest.approx(list(np.quantile(data[c], (0.25, 0.5, 0.75)))), c
    assert len(passes) <= most


@pytest.mark.parametrize("few", [3, 40])
def test_weights_that_mislead_the_sketch(spark, few, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", few)
    v = np.arange(500.0)
    w = np.where(v < 490, 1, 1000)  # nearly all weight on the last ten values
    got = exact_quantiles(spark.createDataFrame(pd.DataFrame({"v": v, "w": w})), ["v"], (0.01, 0.25, 0.5, 1.0), "w")["v"]
    assert got == pytest.approx(list(np.quantile(np.repeat(v, w), (0.01, 0.25, 0.5, 1.0))))


def test_exact_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.range(0).toDF("x"), ["x"], (0.5,)) == {"x": [None]}


def test_approx_quantiles(spark):
    assert approx_quantiles(spark.range(1001).toDF("x"), ["x"], (0.5,))["x"][0] == pytest.approx(500, abs=1)


# --- windows in blocks

def test_lookbacks_together_equal_single_ones(spark, panel):
    df = panel.withColumn("is_holiday_week", F.col("IsHoliday"))
    a, b = features.lookback_features(df), features.holiday_lags(_both(df, sc.SERIES))
    assert set(a.columns) == set(b.columns)
    a, b = (x.select(b.columns).toPandas().sort_values(list(sc.KEY), ignore_index=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b)


def _both(df, by):
    df = features.rolling_mean(features.lags(df, by=by), by=by)
    return features.rolling_slope(features.rolling_median(features.rolling_std(df, by=by), by=by), by=by)


@pytest.mark.parametrize("block_days", [14, 60, 400])
def test_blocks_equal_whole_series(spark, panel, block_days):
    # Gaps of uneven length, so halos reach over several blocks.
    holes = panel.where("Store = 1 or pmod(xxhash64(Store, Date), 5) < 2")
    shorter = holes.where("Store <> 1 or Date < '2020-09-01'")
    whole = _both(shorter, sc.SERIES)
    cut = in_blocks(shorter, _both, features.LOOKBACK, block_days=block_days)
    assert cut.columns == whole.columns
    a, b = (df.toPandas().sort_values(list(sc.KEY), ignore_index=True) for df in (whole, cut))
    pd.testing.assert_frame_equal(a, b)


def test_lookback_features_in_blocks(spark, panel):
    flagged = panel.withColumn("is_holiday_week", F.col("IsHoliday"))
    whole, cut = features.lookback_features(flagged), in_blocks(flagged, features.lookback_features, features.LOOKBACK, 200)
    a, b = (df.toPandas().sort_values(list(sc.KEY), ignore_index=True) for df in (whole, cut))
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_rolling_metrics_keep_models_apart(spark, panel):
    preds = backtest.baseline_forecast(panel, (4, "mean")).select("model", *sc.KEY, "fold", "y_true", "y_pred")
    a, b = (scoring.rolling_metrics(p) for p in (preds, preds.orderBy(F.rand(5)).repartition(6)))
    assert rows(a.select("model", *sc.KEY, "fold", F.round("rolling_mae", 6))) == rows(b.select("model", *sc.KEY, "fold", F.round("rolling_mae", 6)))
    one = scoring.rolling_metrics(preds.where("model = 'train_mean'"))
    assert rows(a.where("model = 'train_mean'").select(*sc.KEY, "fold", F.round("rolling_mae", 6))) == rows(one.select(*sc.KEY, "fold", F.round("rolling_mae", 6)))


def test_baselines_need_no_nested_loop(spark, panel, tmp_path):
    plan = backtest.baseline_forecast(files.read_parquet(spark, files.write_parquet(panel, f"{tmp_path}/p")))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_canonical_sort_reaches_the_files(spark, panel, tmp_path):
    """Within a file the rows are sorted, and a series lies in one file."""
    files.write_parquet(relational.canonical_sort(panel), f"{tmp_path}/s")
    seen = set()
    for part in sorted(tmp_path.glob("s/part-*")):
        keys = list(map(tuple, pd.read_parquet(part)[list(sc.KEY)].to_numpy().tolist()))
        assert keys == sorted(keys)
        series = {k[:2] for k in keys}
        assert not series & seen
        seen |= series
    assert len(seen) == 6


def test_repeated_keys_are_refused(spark, panel):
    assert quality.require_unique_keys(panel) is panel
    with pytest.raises(ValueError, match="repeat"):
        quality.require_unique_keys(panel.union(panel.limit(2)))


def test_scratch_is_cleared(spark, panel):
    from pathlib import Path

    path = scratch_path(spark, "gone")
    panel.limit(1).write.parquet(path)
    session.remove(spark, path)
    assert not Path(path.removeprefix("file:")).exists()


def test_partitioned_parquet_keeps_types_and_order(spark, panel, tmp_path):
    path = files.write_parquet(panel, f"{tmp_path}/p", ["Dept"])
    again = files.read_parquet(spark, path, panel.schema)
    assert again.dtypes == panel.dtypes and rows(again) == rows(panel)


def test_shuffled_input_gives_the_same_features(spark, panel):
    a, b = (_both(p, sc.SERIES).toPandas().sort_values(list(sc.KEY), ignore_index=True)
            for p in (panel, panel.orderBy(F.rand(3)).repartition(7)))
    pd.testing.assert_frame_equal(a, b)


def test_shift_keeps_the_target_out(spark, panel):
    shifted = features.rolling_slope(features.rolling_median(features.rolling_mean(panel, (3,), shift=1), (3,), shift=1), shift=1)
    other = panel.withColumn("Weekly_Sales", F.when(F.col("Date") == "2022-12-25", 1e9).otherwise(F.col("Weekly_Sales")))
    again = features.rolling_slope(features.rolling_median(features.rolling_mean(other, (3,), shift=1), (3,), shift=1), shift=1)
    assert rows(shifted.drop("Weekly_Sales")) == rows(again.drop("Weekly_Sales"))


def test_slope_against_polyfit(spark, panel):
    got = features.rolling_slope(panel.where("Store = 1 and Dept = 1")).orderBy("Date").toPandas()
    y = got.Weekly_Sales.to_numpy()
    for i in range(len(y)):
        part = y[max(0, i - 12):i + 1]
        want = np.polyfit(range(len(part)), part, 1)[0] if len(part) > 1 else 0
        assert got.sales_trend[i] == pytest.approx(want, abs=1e-6)


def test_one_shuffle_for_all_lookbacks(spark, panel):
    plan = _both(panel, sc.SERIES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(Store") == 1


# --- features

def test_equal_department_means_are_medium(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "Dept long, Weekly_Sales double")
    assert {r.dept_category for r in features.dept_band(df).collect()} == {"Medium"}


def test_bands_are_right_closed(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 2.0), (4, 3.0)], "Dept long, Weekly_Sales double")
    assert dict(map(tuple, features.dept_bands(df).collect())) == {1: "Low", 2: "Low", 3: "Medium", 4: "High"}


def test_align_features_keeps_absent_columns(spark, panel):
    got = features.align_features(panel, ["not_there", "IsHoliday"], keep=["Store"])
    assert got.columns == ["Store", "not_there", "IsHoliday"] and got.first().not_there == 0.0


def test_feature_columns_leave_out_keys_and_backtest_columns(spark, panel):
    df = panel.withColumns({"y_true": F.lit(1.0), "y_pred": F.lit(1.0), "fold": F.lit(1), "x": F.lit(2.0), "t": F.lit("a")})
    assert features.feature_columns(df) == ["x"]


# --- cleaning

def _weeks(spark, values, store=1):
    data = [(store, dt.date(2020, 1, 3) + dt.timedelta(weeks=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "Store long, Date date, MarkDown1 double")


def test_markdowns_carry_eight_weeks(spark):
    got = cleaning.fill_markdowns(_weeks(spark, [None, 5.0] + [None] * 10)).orderBy("Date").collect()
    assert [r.MarkDown1 for r in got] == [0.0] + [5.0] * 9 + [0.0, 0.0]


def test_store_without_promotion_is_zero(spark):
    got = cleaning.fill_markdowns(_weeks(spark, [None, -5.0, 0.0])).collect()
    assert {r.MarkDown1 for r in got} == {0.0}


def test_fill_adds_no_rows_and_keeps_values(spark, panel):
    df = panel.withColumn("Temperature", F.when(F.month("Date") % 2 == 0, F.dayofyear("Date").cast("double")))
    got = cleaning.ffill_bfill(df, ["Temperature"])
    assert got.count() == df.count() and got.where("Temperature is null").count() == 0
    assert got.join(df.where("Temperature is not null"), [*sc.KEY, "Temperature"]).count() == df.where("Temperature is not null").count()


def test_constant_group_scores_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 1.0), (2, 3.0), (3, None)], "Store long, CPI double")
    got = cleaning.zscore_by(df, ["CPI"])
    assert sorted(round(r.CPI_std, 6) for r in got.collect()) == [-0.707107, 0.0, 0.0, 0.0, 0.707107]


def test_capping_options(spark):
    df = spark.createDataFrame([(0.0,)] * 9 + [(100.0,)], "x double")
    assert cleaning.cap_outliers(df, ["x"]).agg(F.max("x")).first()[0] == 0.0
    assert cleaning.cap_outliers(df, ["x"], skip_zero_iqr=True).agg(F.max("x")).first()[0] == 100.0
    assert cleaning.cap_outliers(df, ["x"], approximate=True).agg(F.max("x")).first()[0] == 0.0


def test_clean_panel_equals_clean_merged(spark):
    from tillweave.catalog.tables import tables
    t = tables(spark, "/root/testdata/sf0.001")
    merged = relational.merge_sources(t.sales, cleaning.fill_markdowns(t.features), t.stores)
    a, b = cleaning.clean_panel(t.sales, t.features, t.stores), cleaning.clean_merged(merged)
    a, b = (df.toPandas().sort_values(list(sc.KEY), ignore_index=True) for df in (a, b))
    pd.testing.assert_frame_equal(a, b[a.columns])


# --- calendar

def test_known_holidays(spark):
    years = spark.createDataFrame([(2010, 2022)], "y0 int, y1 int")
    days = {r.Date: r.holiday_name for r in calendar.holiday_dim(years).collect()}
    for text, name in (("2010-11-25", "Thanksgiving Day"), ("2012-09-03", "Labor Day"), ("2011-01-17", "Martin Luther King Jr. Day"),
                       ("2010-12-31", "New Year's Day (observed)"), ("2021-12-31", "New Year's Day (observed)"),
                       ("2011-12-26", "Christmas Day (observed)"), ("2022-06-20", "Juneteenth National Independence Day (observed)"),
                       ("2010-05-31", "Memorial Day"), ("2012-02-20", "Washington's Birthday")):
        assert days[dt.date.fromisoformat(text)] == name
    assert dt.date(2020, 6, 19) not in days and dt.date(2012, 2, 10) not in days


def test_horizon_counts(spark):
    friday = spark.createDataFrame([(dt.date(2012, 10, 26),)], "Date date")
    monday = [r.Date for r in calendar.forecast_horizon(friday).orderBy("Date").collect()]
    assert len(monday) == 14 and monday[0] == dt.date(2012, 10, 22)
    assert calendar.forecast_horizon(friday, anchor="same_weekday").count() == 13
    sunday = spark.createDataFrame([(dt.date(2012, 10, 28),)], "Date date")
    assert calendar.forecast_horizon(sunday).count() == 13


# --- splits and backtests

def test_folds_do_not_leak(spark, panel):
    for folds in (4, 3, 2):
        bounds = splits.fold_bounds(panel, folds, 13).orderBy("fold").collect()
        assert len(bounds) == folds
        assert all(b.train_end < b.test_start <= b.test_end for b in bounds)
        assert all((b.test_end - b.test_start).days == 84 for b in bounds)


def test_too_few_dates_give_no_folds(spark, panel):
    assert splits.fold_bounds(panel.where("Date < '2020-01-20'"), 4, 13).count() == 0


def test_split_sizes(spark, panel):
    got = {r.split: r["count"] for r in splits.time_split(panel).groupBy("split").count().collect()}
    assert got == {"train": 750, "test": 186}


def test_protocol_and_single_plan_agree(spark, panel):
    one = backtest.baseline_forecast(panel, (4, "mean"))
    for model in (backtest.SeriesMean(4), backtest.SeriesMean(None)):
        a = backtest.backtest(panel, model).withColumn("y_pred", F.round("y_pred", 6))
        b = one.where(F.col("model") == model.name).withColumn("y_pred", F.round("y_pred", 6))
        assert rows(a.select(b.columns)) == rows(b)


def test_failing_fold_is_a_row(spark, panel):
    class Moody(backtest.SeriesMean):
        calls = 0

        def fit(self, train):
            Moody.calls += 1
            if Moody.calls == 2:
                raise ValueError("no")
            return super().fit(train)

    got = backtest.backtest(panel, Moody(4))
    assert {r.fold for r in got.where("error is null").select("fold").distinct().collect()} == {1, 3, 4}
    assert [(r.fold, r.error, r.y_pred) for r in got.where("error is not null").collect()] == [(2, "no", None)]


def test_ranks_share_ties(spark):
    scores = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 1.0), ("c", 1, 2.0)], "model string, fold int, mae double")
    got = {r.model: r.avg_rank for r in compare.model_ranks(scores).collect()}
    assert got == {"a": 1.5, "b": 1.5, "c": 3.0}
    assert compare.best_by_metric(scores).first().model == "a"


# --- quality, exports

def test_validation_of_schema(spark, panel):
    with pytest.raises(ValueError, match="missing"):
        quality.require_model_input(panel.drop("Dept"))
    with pytest.raises(ValueError, match="must be a date"):
        quality.require_model_input(panel.withColumn("Date", F.col("Date").cast("string")))
    checks = {r.check: r.ok for r in quality.validate_model_input(panel.where("Store > 9")).collect()}
    assert checks["non_empty"] is False


def test_duplicates_of_a_hot_key(spark, panel):
    hot = panel.limit(1).crossJoin(spark.range(500)).drop("id")
    assert quality.duplicate_keys(panel.unionByName(hot)).first()[0] == 500


def test_duplicate_rows_count_digests_first(spark, panel):
    odd = spark.createDataFrame([(None, 1.0, "a"), (1, None, "a"), (None, 1.0, "a"), (1, -0.0, "b"), (1, 0.0, "b"),
                                 (2, float("nan"), None), (2, float("nan"), None), (2, float("nan"), ""), (None, None, None), (None, None, None)],
                                "x long, y double, z string")
    assert quality.duplicate_rows(odd).first()[0] == 4
    assert quality.duplicate_rows(odd.limit(0)).first()[0] == 0
    assert quality.duplicate_rows(panel.unionByName(panel.where("Store = 1"))).first()[0] == 312
    plan = quality.duplicate_rows(panel)._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.splitlines() if "Aggregate [_h1" in line]
    assert counted and all("Weekly_Sales" not in line for line in counted)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_panel_stored_by_series_needs_no_exchange(spark, panel, tmp_path):
    plain = panel.withColumn("is_holiday_week", F.col("IsHoliday"))
    kept = layout.store(plain, "by_series", f"{tmp_path}/s")
    try:
        got = features.lookback_features(kept)
        assert _exchanges(got) == 0
        want = features.lookback_features(plain).toPandas().sort_values(list(sc.KEY), ignore_index=True)
        pd.testing.assert_frame_equal(got.select(*want.columns).toPandas().sort_values(list(sc.KEY), ignore_index=True), want)
    finally:
        spark.sql("drop table by_series")


def test_tables_stored_by_store_join_in_place(spark, panel, tmp_path, monkeypatch):
    days = panel.select("Store", "Date").distinct().withColumns({"Temperature": F.dayofyear("Date") * 1.0, "IsHoliday": F.lit(False)})
    stores = panel.select("Store").distinct().withColumn("Size", F.col("Store") * 1000)
    given = {"p_sales": panel, "p_days": days, "p_stores": stores}
    settings = {layout.PART_OF_KEYS: "true", "spark.sql.autoBroadcastJoinThreshold": spark.conf.get("spark.sql.autoBroadcastJoinThreshold")}
    try:
        kept = [layout.store(df, name, f"{tmp_path}/{name}", by=["Store"]) for name, df in given.items()]
        layout.in_place(spark).conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = features.lags(relational.merge_sources(*kept))
        assert _exchanges(got) == 0
        want = features.lags(relational.merge_sources(*given.values()))
        assert rows(got.select(*want.columns)) == rows(want)
    finally:
        for key, value in settings.items():
            spark.conf.set(key, value)
        for name in given:
            spark.sql(f"drop table if exists {name}")


def test_predictions_with_odd_values(spark):
    a = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, float("inf"))], "Store long, y_true double")
    b = spark.createDataFrame([(1, -1.0), (2, 1.0), (4, 1.0)], "Store long, y_pred double")
    got = quality.validate_predictions(a, b, ["Store"]).first().asDict()
    assert got == {"rows": 4, "unmatched": 2, "missing": 3, "infinite": 1, "negative": 1, "valid": False}


def test_roi_of_a_constant_side(spark, panel):
    got = exports.markdown_roi(panel.withColumn("MarkDown1", F.lit(3.0))).collect()
    assert len(got) == 6 and all(r.markdown_sales_correlation == 0 and r.uplift_percentage == 0 for r in got)


def test_csv_of_nulls_and_missing_path(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 0.5, None), (3, 1.5, "")], "A long, B double, C string")
    path = files.write_csv(df, scratch_path(spark, "csv"))
    assert rows(files.read_csv(spark, path, df.schema)) == rows(df.withColumn("C", F.nullif("C", F.lit(""))))  # empty is null
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_csv(spark, path + "-none", df.schema)


class _Session:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, named):
        self.conf = {"spark.checkpoint.dir": named}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"{master}-{named}"})


def test_shared_folder():
    assert shared_dir(_Session("spark://host", "hdfs://x/y")) == "hdfs://x/y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://host", None))
    local = _Session("local[2]", None)
    assert shared_dir(local) == shared_dir(local)


# --- the stages from end to end

def test_pipeline(spark):
    from tillweave.catalog.tables import tables
    t = tables(spark, "/root/testdata/sf0.001")
    out = scratch_path(spark, "pipeline")
    table = stages.prepare(t.sales, t.features, t.stores, out)
    assert table.count() == t.sales.count()
    assert table.where(" or ".join(f"`{c}` is null" for c in table.columns)).count() == 0
    preds = stages.run_backtests(table, [backtest.SeriesMean(2)], out)
    report = stages.compare_models(spark, out).first()
    assert report.models_evaluated == 4 and report.total_folds == 4
    stages.export_dashboard(table, preds, out)
    assert spark.read.option("header", True).csv(f"{out}/store_risk").count() == table.select(*sc.SERIES).distinct().count()


def test_departments_do_not_decide_the_parts(spark, panel):
    """The panel is dealt by series, not gathered by department, and its parts follow its rows."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        banded = features.seasonal_index(features.dept_encoding(panel.withColumn("month", F.month("Date"))), "month", "index")
        plan = banded._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(Store") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert layout.dealt(panel, 936, size=50).rdd.getNumPartitions() == 19
    assert layout.dealt(panel, 936) is panel


def test_parts_of_the_derived_tables_follow_the_lines(spark, monkeypatch):
    """No task of the derivation holds more than some ``LINES`` line items; the tables stay the same."""
    root = "/root/testdata/sf0.001"
    plain = [rows(starschema.sales(spark, root)), rows(starschema.features(spark, root))]
    monkeypatch.setattr(starschema, "LINES", 500)
    derived = [starschema.sales(spark, root), starschema.features(spark, root)]
    assert [rows(df) for df in derived] == plain
    for df in derived:
        assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString()


def test_quartiles_of_calendar_columns_come_from_dates(spark, monkeypatch):
    from tillweave.catalog.tables import tables
    t, read, bounds = tables(spark, "/root/testdata/sf0.001"), {}, cleaning.outlier_bounds
    monkeypatch.setattr(cleaning, "outlier_bounds", lambda df, cols, *a, **how: (read.update({c: df.count() for c in cols}), bounds(df, cols, *a, **how))[1])
    cleaning.clean_panel(t.sales, t.features, t.stores)
    assert read["month"] == read["week_sin"] == t.sales.select("Date").distinct().count() < read["Temperature"]


def test_few_series_shuffle_no_other_rows(spark, panel):
    few = relational.restrict_to_series(panel, relational.top_series(panel, 2), few=True)
    assert "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString()
    assert rows(few) == rows(relational.restrict_to_series(panel, relational.top_series(panel, 2))) and few.count() == 312


def test_quality_report_in_parts(spark, panel, monkeypatch):
    monkeypatch.setattr(quality, "COUNTED", 50)
    tables = panel, panel.select("Store", "Date").distinct(), panel.select("Store").distinct()
    whole, parts = quality.quality_report(*tables), quality.quality_report(*tables, {"sales": 936, "features": 468})
    assert rows(whole) == rows(parts) and "REPARTITION_BY_NUM" in parts._jdf.queryExecution().executedPlan().toString()


def test_queries_over_sales_derive_nothing_else(spark, monkeypatch):
    from tillweave.catalog.tables import Tables
    from tillweave.sources import starschema

    made = []
    for name in ("sales", "features", "stores"):
        monkeypatch.setattr(starschema, name, lambda s, root, name=name, make=getattr(starschema, name): (made.append(name), make(s, root))[1])
    t = Tables(spark, "/root/testdata/sf0.001")
    assert t.sales.count() == t.sales.count() > 0 and made == ["sales"]
    assert t.features is t.features and t.stores.columns == ["Store", "Type", "Size"] and made == ["sales", "features", "stores"]


def test_shares_of_a_sketch_are_one_constant(spark):
    """All shares, to the last bit, from one literal; the quantiles of many values stay exact."""
    from tillweave.functions import quantiles

    assert spark.range(1).select(quantiles._shares().alias("s")).first().s == [g / 200 for g in range(201)]
    df = spark.range(60_000).selectExpr("cast(id * 7919 % 60000 as double) as v", "1 + id % 3 as n")
    values = sorted((float(r.v), r.n) for r in df.collect())
    whole = [v for v, n in values for _ in range(n)]
    for q, got in zip((0.25, 0.75), quantiles.exact_quantiles(df, ["v"], (0.25, 0.75), "n")["v"]):
        at = q * (len(whole) - 1)
        low = whole[int(at)]
        assert abs(got - (low + (whole[int(at) + 1] - low) * (at - int(at)))) < 1e-9


def test_days_follow_the_rows_and_only_gaps_are_joined_back(spark, monkeypatch):
    """Parts of the merged panel and of its days grow in number with the rows; filled values travel for days with a gap only."""
    from tillweave.catalog import queries
    from tillweave.catalog.tables import tables
    from tillweave.operators import cleaning
    from tillweave.sources import layout

    df = spark.range(400).selectExpr("id % 4 as Store", "id % 2 as Dept", "date_add(date'2020-01-05', cast(7 * (id div 8) as int)) as Date",
                                     "if(id div 8 % 5 = 0 and (id % 8 > 3 or id div 8 % 2 = 0), null, cast(id as double)) as Temperature")
    gaps = df.where("Temperature is null").select("Store", "Date").distinct()
    filled = cleaning.filled_gaps(df, both=["Temperature"], rows=400)
    assert 0 < filled.count() == gaps.count() < df.select("Store", "Date").distinct().count()
    assert filled.where("Temperature is null").count() == 0
    plain = cleaning.fill_over_days(df, both=["Temperature"])
    monkeypatch.setattr(cleaning, "JOINED", 50)
    dealt = cleaning.fill_over_days(df, both=["Temperature"], rows=400)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dealt.collect()))
    parts = cleaning.filled_gaps(df, both=["Temperature"], rows=400)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in parts
    root = "/root/testdata/sf0.001"
    rows = tables(spark, root).sales.count()
    monkeypatch.setattr(layout, "JOINED", 500)
    assert queries.merged(spark, root).rdd.getNumPartitions() == -(-rows // 500) > 4


def test_staging_leaves_no_shuffle_files_behind(spark, panel):
    """Else those of every finished step stay until the driver happens to collect its garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_\d+", disk.getAllFiles().mkString(" ")))

    before = shuffles()
    kept = [session.materialise(panel.repartition(5, "Store"), "freed") for _ in range(4)]
    for _ in range(50):
        if len(shuffles() - before) <= 2:
            break
        time.sleep(0.1)
    assert len(shuffles() - before) <= 2 and kept[3].count() == 936  # those of the last step may wait for the next one


def test_the_cleaned_panel_goes_when_its_features_are_written(spark, panel, monkeypatch):
    monkeypatch.setattr(tables, "clean", lambda spark, root: panel)
    monkeypatch.setattr(tables, "build_features", lambda df: df.withColumn("twice", F.col("Weekly_Sales") * 2))
    made = session._MADE.setdefault(spark.sparkContext.applicationId, [])
    n = len(made)
    assert tables.featured(spark, "no such tables").where("twice > Weekly_Sales").count() == 936
    assert [(os.path.basename(path).split("-")[0], os.path.exists(path)) for path in made[n:]] == [("cleaned", False), ("featured", True)]
