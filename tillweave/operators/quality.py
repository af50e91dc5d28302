"""Validation and data-quality reports. Every check returns a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import is_infinite, unpivot
from ..schema import DATE, DEPT, KEY, SERIES, STORE, STORE_TYPES, TARGET, VALID_RANGES, numeric_columns
from ..sources.layout import dealt

#: Rows of a part while rows are counted by value.
COUNTED = 250_000

MODEL_KEYS = (STORE, DEPT, DATE)


def _per_column(df: DataFrame, counts: Mapping[str, Column], value: str) -> DataFrame:
    """One pass over ``df`` with one counter per column, as (column, value) rows."""
    if not counts:
        schema = T.StructType([T.StructField("column", T.StringType()), T.StructField(value, T.LongType())])
        return df.sparkSession.createDataFrame([], schema)
    totals = df.agg(*[c.cast("long").alias(f"c{i}") for i, c in enumerate(counts.values())])
    return unpivot(totals, {name: F.col(f"c{i}") for i, name in enumerate(counts)}, "column", value)


def _schema_rows(df: DataFrame, rows: Sequence[tuple], columns: str) -> DataFrame:
    """Findings about the schema, each with the number of rows that it affects."""
    found = df.sparkSession.createDataFrame(list(rows), columns)
    return found.crossJoin(df.agg(F.count(F.lit(1)).alias("rows")))


def missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Required columns that ``df`` lacks."""
    gone = [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name not in df.columns]
    return _schema_rows(df, gone, "column string, expected string")


def dtype_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns whose type is not the expected one."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [(f.name, f.dataType.simpleString(), have[f.name]) for f in schema.fields
             if f.name in have and have[f.name] != f.dataType.simpleString()]
    return _schema_rows(df, wrong, "column string, expected string, actual string")


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = VALID_RANGES) -> DataFrame:
    """Values outside the closed range, per column that has one."""
    present = {c: r for c, r in ranges.items() if c in numeric_columns(df)}
    return _per_column(df, {c: F.count_if((F.col(c) < lo) | (F.col(c) > hi)) for c, (lo, hi) in present.items()},
                       "violations")


def domain_violations(df: DataFrame, column: str = "Type", allowed: Sequence[str] = STORE_TYPES) -> DataFrame:
    """Distinct values outside the domain; null is outside."""
    ok = F.coalesce(F.col(column).isin(*allowed), F.lit(False))
    return df.where(~ok).select(column).distinct()


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in (columns or df.columns)}, "nulls")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows beyond the first of their key. Copies are counted before the shuffle,
    so a key with very many copies costs no more than any other."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("duplicates"))


def _digest(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row. Equal rows have equal digests; which columns are null takes part."""
    gaps = [F.col(c).isNull() for c in columns]
    return [F.xxhash64(*gaps, *columns).alias("_h1"), F.xxhash64(F.lit("row"), *gaps, *columns).alias("_h2")]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of their value, in two phases: 16-byte digests are counted
    first, and only rows of a repeated digest are compared in full. A table without
    repeats shuffles 16 bytes and a count per row, however wide it is. The second phase
    joins by size: a few repeated digests are broadcast."""
    columns = df.columns
    digests = df.select(*_digest(columns)).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    repeated = digests.where("_n > 1").select("_h1", "_h2")
    rows = df.select("*", *_digest(columns)).join(repeated, ["_h1", "_h2"], "left_semi")
    return duplicate_keys(rows, columns)


def date_range(df: DataFrame, column: str = DATE) -> DataFrame:
    first, last = F.min(column), F.max(column)
    return df.agg(first.alias("min_date"), last.alias("max_date"), F.datediff(last, first).alias("days"))



def coverage(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct stores (and departments, where there is such a column)."""
    columns = {c: n for c, n in ((STORE, "stores"), (DEPT, "depts")) if c in df.columns}
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(n) for c, n in columns.items()])
    return df.agg(*[F.count_distinct(c).alias(n) for c, n in columns.items()])


def missing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str] = (STORE,)) -> DataFrame:
    """Keys of ``left`` that ``right`` does not have."""
    keys = list(keys)
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def infinite_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, {c: F.count_if(is_infinite(c)) for c in (columns or numeric_columns(df))}, "infinite")


def negative_count(df: DataFrame, column: str = TARGET) -> DataFrame:
    return df.agg(F.count_if(F.col(column) < 0).cast("long").alias("negative"))


def span_consistency(df: DataFrame, groups: Sequence[str] = SERIES, column: str = DATE, tolerance: float = 7) -> DataFrame:
    """Spread of the groups' time spans; flagged when it exceeds ``tolerance`` days."""
    spans = df.groupBy(*groups).agg(F.datediff(F.max(column), F.min(column)).alias("span"))
    spread = F.stddev_samp("span")
    return spans.agg(F.count(F.lit(1)).alias("groups"), spread.alias("span_std"),
                     F.coalesce(spread > tolerance, F.lit(False)).alias("inconsistent"))


def time_series_checks(df: DataFrame, groups: Sequence[str] = SERIES, column: str = DATE) -> DataFrame:
    """Null dates, repeated dates within a group, uneven spans: one row."""
    nulls = df.agg(F.count_if(F.col(column).isNull()).cast("long").alias("null_dates"))
    return nulls.crossJoin(duplicate_keys(df, [*groups, column])).crossJoin(
        span_consistency(df, groups, column).select("inconsistent"))


def unmatched_counts(df: DataFrame, probes: Mapping[str, str] | None = None) -> DataFrame:
    """Rows that found no partner in a left join, seen by a null in the probe column."""
    probes = probes or {"features": "Temperature", "stores": "Type"}
    return df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(f"unmatched_{n}") for n, c in probes.items()])


def series_counts(df: DataFrame, groups: Sequence[str] = SERIES) -> DataFrame:
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("rows"))


def validate_model_input(df: DataFrame, require_target: bool = True) -> DataFrame:
    """Contract of a model's input as (check, severity, ok, detail) rows. Null keys
    are a warning, everything else an error."""
    needed = [*MODEL_KEYS, *([TARGET] if require_target else [])]
    gone = [c for c in needed if c not in df.columns]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    dated = isinstance(kinds.get(DATE), (T.DateType, T.TimestampType, T.TimestampNTZType))
    present = [c for c in needed if c in df.columns]
    # One aggregate gives both the emptiness and the null keys.
    nulls = F.lit(0)
    for c in present:
        nulls = nulls + F.count_if(F.col(c).isNull())
    seen = df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"))
    checks = F.array(*[
        F.struct(F.lit(name).alias("check"), F.lit("warning" if name == "null_keys" else "error").alias("severity"),
                 ok.alias("ok"), detail.cast("string").alias("detail"))
        for name, ok, detail in (
            ("non_empty", F.col("rows") > 0, F.col("rows")),
            ("required_columns", F.lit(not gone), F.lit(",".join(gone))),
            ("null_keys", F.col("nulls") == 0, F.col("nulls")),
            ("date_type", F.lit(dated), F.lit(kinds[DATE].simpleString() if DATE in kinds else "")))])
    return seen.select(F.inline(checks))


def require_model_input(df: DataFrame, require_target: bool = True) -> DataFrame:
    """Raise where the plan alone shows that ``df`` cannot feed a model."""
    needed = [*MODEL_KEYS, *([TARGET] if require_target else [])]
    gone = [c for c in needed if c not in df.columns]
    if gone:
        raise ValueError(f"missing required columns: {gone}")
    if not isinstance(df.schema[DATE].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{DATE} must be a date, not {df.schema[DATE].dataType.simpleString()}")
    return df


def require_unique_keys(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Raise if a key occurs twice: windows over a series rely on one row per date. Runs one job."""
    copies = duplicate_keys(df, keys).first().duplicates
    if copies:
        raise ValueError(f"{copies} rows repeat their key {list(keys)}")
    return df


def validate_predictions(actuals: DataFrame, preds: DataFrame, keys: Sequence[str] = KEY,
                         y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Compare actuals and predictions by key: unmatched rows make it invalid,
    null/NaN, infinite and negative values are only counted."""
    keys = list(keys)
    both = actuals.select(*keys, y, F.lit(1).alias("_a")).join(
        preds.select(*keys, p, F.lit(1).alias("_p")), keys, "full_outer")

    def odd(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(c)

    def either(test) -> Column:
        return F.count_if(test(y) | test(p)).cast("long")

    unmatched = F.count_if(F.col("_a").isNull() | F.col("_p").isNull()).cast("long")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), unmatched.alias("unmatched"),
        either(odd).alias("missing"), either(is_infinite).alias("infinite"),
        either(lambda c: F.coalesce(F.col(c) < 0, F.lit(False))).alias("negative"),
        (unmatched == 0).alias("valid"))


def quality_report(sales: DataFrame, features: DataFrame, stores: DataFrame, rows: Mapping[str, int] | None = None) -> DataFrame:
    """Nulls, duplicates, date ranges, coverage and missing stores of the three
    tables as (check, table, column, value) rows; dates as text.

    One pass over each table: its rows are counted by value, and the columns' counts and
    ends are taken from the distinct rows with their numbers. Stores are compared as sets.
    ``rows`` may give the sizes of tables: large ones are counted in parts of bounded size.
    """
    sizes = rows or {}
    tables = {"sales": sales, "features": features, "stores": stores}
    parts = []
    for name, df in tables.items():
        parts_of = dealt(df, sizes[name], df.columns, COUNTED) if name in sizes else df
        rows = parts_of.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
        n = F.col("_n")
        found = {("nulls", c): F.sum(F.when(F.col(c).isNull(), n).otherwise(0)) for c in df.columns}
        found["duplicates", "*"] = F.sum(n - 1)
        found |= {("coverage", out): F.count_distinct(c) for out, c in (("stores", STORE), ("depts", DEPT)) if c in df.columns}
        if DATE in df.columns:
            found |= {("date_range", out): fn(DATE) for out, fn in (("min_date", F.min), ("max_date", F.max))}
        # counts of an empty table are 0, its ends are null
        counted = rows.agg(*[(c if check == "date_range" else F.coalesce(c, F.lit(0))).cast("string").alias(f"c{k}")
                             for k, ((check, _), c) in enumerate(found.items())])
        parts.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(check).alias("check"), F.lit(name).alias("table"), F.lit(column).alias("column"), F.col(f"c{k}").alias("value"))
            for k, (check, column) in enumerate(found)]))))
    for name in ("features", "stores"):
        gone = missing_keys(sales, tables[name]).agg(F.count(F.lit(1)).alias("n"))
        parts.append(gone.select(F.lit("missing_stores").alias("check"), F.lit(name).alias("table"), F.lit(STORE).alias("column"), F.col("n").cast("string").alias("value")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
