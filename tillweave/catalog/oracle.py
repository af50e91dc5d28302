"""Independent SQL for the queries, over the star-schema tables.

``PARTS`` are named sub-queries; ``sql`` puts those a statement needs in front of
it. Doubles are brought to the form of ``queries.published`` by ``r``.
"""

from __future__ import annotations

import re

from .. import schema as sc


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    if name is None:
        name = expression
    return f"floor(({expression}) * 1e{digits} + 0.53) / 1e{digits} as {name}"


def rs(names, digits: int = 6) -> str:
    return ", ".join(r(n, digits=digits) for n in names)


SERIES = "partition by Store, Dept"
W = f"{SERIES} order by Date"
ECONOMY_WEATHER = ("Temperature", "Fuel_Price", *sc.MARKDOWNS, "CPI", "Unemployment")
COVARIATES = rs(ECONOMY_WEATHER)
SALES_COLS = "Store, Dept, Date, " + r("Weekly_Sales") + ", IsHoliday"
MERGED_COLS = f"{SALES_COLS}, {COVARIATES}, Type, Size"
PRED_COLS = f"model, fold, {SALES_COLS}, {r('y_true')}, {r('y_pred')}"

_CODES = "case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 when 'PROMO' then 4 when 'SMALL' then 5 else 6 end"
_MARKS = ",\n  ".join(
    f"floor(cast(sum(case when o_orderpriority like '{k}-%' then cast(floor(l_extendedprice * 100 + 0.5) as bigint) end) as double) / 100) / 100 as MarkDown{k}"
    for k in range(1, 6))

# Federal holidays by day of the month, and by weekday and days of the month.
_FIXED = "case strftime({d}, '%m-%d') when '01-01' then 'New Year''s Day' when '07-04' then 'Independence Day' " \
         "when '11-11' then 'Veterans Day' when '12-25' then 'Christmas Day' " \
         "when '06-19' then case when year({d}) >= 2021 then 'Juneteenth National Independence Day' end end"


def _fixed(d: str) -> str:
    return _FIXED.replace("{d}", d)


_FLOATING = (
    "case when isodow(d) = 1 and month(d) = 1 and day(d) between 15 and 21 then 'Martin Luther King Jr. Day' "
    "when isodow(d) = 1 and month(d) = 2 and day(d) between 15 and 21 then 'Washington''s Birthday' "
    "when isodow(d) = 1 and month(d) = 5 and day(d) >= 25 then 'Memorial Day' "
    "when isodow(d) = 1 and month(d) = 9 and day(d) <= 7 then 'Labor Day' "
    "when isodow(d) = 1 and month(d) = 10 and day(d) between 8 and 14 then 'Columbus Day' "
    "when isodow(d) = 4 and month(d) = 11 and day(d) between 22 and 28 then 'Thanksgiving Day' end")

_PARTS_OF_DATE = ("cast(year(Date) as bigint) as year, cast(month(Date) as bigint) as month, "
                  "cast(weekofyear(Date) as bigint) as week, cast(isodow(Date) - 1 as bigint) as day_of_week, "
                  "cast(dayofyear(Date) as bigint) as day_of_year, cast(quarter(Date) as bigint) as quarter")
_FLAGS_OF_DATE = ("isodow(Date) >= 6 as is_weekend, day(Date) = 1 as is_month_start, last_day(Date) = Date as is_month_end, "
                  "day(Date) = 1 and month(Date) in (1, 4, 7, 10) as is_quarter_start, "
                  "last_day(Date) = Date and month(Date) in (3, 6, 9, 12) as is_quarter_end")
_CYCLES = ", ".join(f"{fn}(2 * pi() * {part} / {n}.0) as {part}_{fn}"
                    for part, n in (("month", 12), ("week", 52)) for fn in ("sin", "cos"))


def _filled_forward(c: str) -> str:
    return f"last_value({c} ignore nulls) over (partition by Store order by Date rows between unbounded preceding and current row)"


def _filled_back(c: str) -> str:
    return f"first_value({c} ignore nulls) over (partition by Store order by Date rows between current row and unbounded following)"


def _markdown_fill(c: str) -> str:
    last = f"last_value({c} ignore nulls) over (partition by Store order by Date rows between 8 preceding and current row)"
    return f"case when max({c}) over (partition by Store) > 0 then coalesce({last}, 0) else 0.0 end as {c}"


def _folds(k: int, start: str, stop: str) -> str:
    """Fold bounds from positions in the ordered dates; ``f`` is the fold."""
    return (f"select cast(f as bigint) as fold, (select min(Date) from dates) as train_start, "
            f"max(case when i = {start} - 1 then Date end) as train_end, max(case when i = {start} then Date end) as test_start, "
            f"max(case when i = {stop} - 1 then Date end) as test_end "
            f"from dates, range(1, {k + 1}) t(f) where n // {k + 1} > 0 group by f")


def _clip(c: str, k: int) -> str:
    return f"greatest(least(cast({c} as double), q{k}[2] + 1.5 * (q{k}[2] - q{k}[1])), q{k}[1] - 1.5 * (q{k}[2] - q{k}[1]))"


def _capped(c: str, k: int) -> str:
    return f"case when {c} is not null then {_clip(c, k)} end"


MEASURES = ("Weekly_Sales", *ECONOMY_WEATHER, "Size")
CALENDAR_NUMBERS = ("year", "month", "week", "day_of_week", "day_of_year", "quarter", "month_sin", "month_cos", "week_sin", "week_cos")
CLEAN_NUMBERS = (*MEASURES, *CALENDAR_NUMBERS, "MarkDownSum", "CPI_std", "Unemployment_std")
CLEAN_REST = ("Store", "Dept", "Date", "IsHoliday", "Type", "is_weekend", "is_month_start", "is_month_end",
              "is_quarter_start", "is_quarter_end", "holiday_name", "is_federal_holiday", "is_holiday_week")


def _zscore(c: str) -> str:
    mean, dev = (f"{fn}({c}) over (partition by Store)" for fn in ("avg", "stddev_samp"))
    return f"coalesce(({c} - {mean}) / nullif({dev}, 0), 0) as {c}_std"


def _rolling(fn: str, n: int) -> str:
    return f"{fn}(Weekly_Sales) over ({W} rows between {n - 1} preceding and current row)"


ROLLING = {
    "mean": [(f"sales_rolling_mean_{n}", _rolling("avg", n)) for n in sc.WINDOWS],
    "std": [(f"sales_rolling_std_{n}", f"coalesce({_rolling('stddev_samp', n)}, 0)") for n in sc.WINDOWS],
    "median": [(f"sales_rolling_median_{n}", _rolling("median", n)) for n in sc.WINDOWS],
}
LAGS = [(f"sales_lag_{k}", f"lag(Weekly_Sales, {k}) over ({W})") for k in sc.LAGS]
LAGS0 = [(n, f"coalesce({e}, 0)") for n, e in LAGS]
_SLOPE_FRAME = f"over ({W} rows between 12 preceding and current row)"
SLOPE = f"case when count(*) {_SLOPE_FRAME} > 1 then regr_slope(Weekly_Sales, pos) {_SLOPE_FRAME} else 0 end"


def _index(part: str) -> str:
    return (f"coalesce(avg(Weekly_Sales) over ({SERIES}, {part}) / nullif(avg(Weekly_Sales) over ({SERIES}), 0), 1)")


def _hot(column: str, domain, prefix: str) -> list[tuple[str, str]]:
    return [(f"{prefix}_{v}", f"cast(coalesce({column} = '{v}', false) as bigint)") for v in domain]


def named(pairs, digits: int | None = 6) -> str:
    return ", ".join(r(e, n, digits) if digits is not None else f"{e} as {n}" for n, e in pairs)


INTERACTIONS = [
    ("size_temperature", "coalesce(Size * Temperature, 0)"),
    ("size_fuel_price", "coalesce(Size * Fuel_Price, 0)"),
    ("markdown_temperature", "coalesce(MarkDownSum * Temperature, 0)"),
    ("markdown_holiday", "coalesce(MarkDownSum * cast(IsHoliday as int), 0)"),
    ("holiday_temperature", "coalesce(cast(IsHoliday as int) * Temperature, 0)"),
    ("holiday_fuel_price", "coalesce(cast(IsHoliday as int) * Fuel_Price, 0)"),
]
MD_SUM = " + ".join(f"coalesce({c}, 0)" for c in sc.MARKDOWNS)

METRIC_SQL = {
    "mae": "avg(abs(y_true - y_pred))",
    "rmse": "sqrt(avg((y_true - y_pred) * (y_true - y_pred)))",
    "mape": "100 * avg(case when y_true <> 0 then abs((y_true - y_pred) / y_true) end)",
    "smape": "100 * avg(case when abs(y_true) + abs(y_pred) <> 0 then 2 * abs(y_pred - y_true) / (abs(y_true) + abs(y_pred)) end)",
    "wape": "100 * sum(abs(y_true - y_pred)) / nullif(sum(y_true), 0)",
}
ALL_METRICS = named(METRIC_SQL.items())
HEADLINE = named([(k, METRIC_SQL[k]) for k in ("mae", "rmse", "mape")])

PARTS = {
    "sale_lines": f"""select l_suppkey + 1 as Store, cast({_CODES} as bigint) as Dept,
  cast(date_trunc('week', l_shipdate) as date) + 4 as Date,
  cast(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) as bigint) as cents
from lineitem join part on l_partkey = p_partkey""",
    "sales": """select Store, Dept, Date, cast(sum(cents) as double) / 100 as Weekly_Sales,
  weekofyear(Date) in (6, 36, 47, 52) as IsHoliday from sale_lines group by Store, Dept, Date""",
    "covariates": f"""select l_suppkey + 1 as Store, cast(date_trunc('week', o_orderdate) as date) + 4 as Date,
  (4000 + floor(cast(sum(cast(floor(o_totalprice * 100 + 0.5) as bigint)) as double) / count(*) / 10000)) / 100 as Temperature,
  (200 + floor(cast(sum(cast(l_quantity as bigint)) as double) / count(*) * 4)) / 100 as Fuel_Price,
  {_MARKS},
  (9500 + floor(cast(sum(cast(floor(l_extendedprice * 100 + 0.5) as bigint)) as double) / count(*) / 1000)) / 100 as CPI,
  (400 + count(*) * 10.0::double) / 100 as Unemployment,
  weekofyear(cast(date_trunc('week', o_orderdate) as date) + 4) in (6, 36, 47, 52) as IsHoliday
from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, IsHoliday""",
    "shops": """select s_suppkey + 1 as Store,
  case when s_acctbal >= 0 then case s_nationkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end end as Type,
  cast(10000 + 20 * floor(abs(s_acctbal)) as bigint) as Size from supplier""",
    "merged": f"""select s.Store, s.Dept, s.Date, s.Weekly_Sales, s.IsHoliday, {", ".join("c." + c for c in ECONOMY_WEATHER)}, Type, Size
from sales s left join covariates c on s.Store = c.Store and s.Date = c.Date left join shops p on s.Store = p.Store""",
    "md_filled": f"""select Store, Date, Temperature, Fuel_Price, {", ".join(_markdown_fill(c) for c in sc.MARKDOWNS)}, CPI, Unemployment, IsHoliday
from covariates""",
    "merged_filled": f"""select s.Store, s.Dept, s.Date, s.Weekly_Sales, s.IsHoliday, Temperature, Fuel_Price,
  {", ".join(f"coalesce({c}, 0) as {c}" for c in sc.MARKDOWNS)}, CPI, Unemployment, Type, Size
from sales s left join md_filled c on s.Store = c.Store and s.Date = c.Date left join shops p on s.Store = p.Store""",
    "days": """select cast(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), interval 1 day)) as date) as d
from (select cast(year(min(Date)) as int) as y0, cast(year(max(Date)) as int) as y1 from sales)""",
    "holidays": f"""select d as Date, min(name) as holiday_name from (
  select d, {_fixed("d")} as name from days
  union all select d, {_FLOATING} from days
  union all select d, case when isodow(d) = 5 then {_fixed("(d + 1)")} when isodow(d) = 1 then {_fixed("(d - 1)")} end || ' (observed)' from days
) where name is not null group by d""",
    "holiday_weeks": "select distinct weekofyear(Date) as wk, isoyear(Date) as yr from sales where Date in (select Date from holidays)",
    "dates": "select Date, row_number() over (order by Date) - 1 as i, count(*) over () as n from (select distinct Date from sales)",
    "folds": _folds(4, "f * (n // 5)", "least(f * (n // 5) + 13, n)"),
    "assigned": """select fold, case when Date <= train_end then 'train' else 'test' end as role, sales.*
from sales join folds on Date between train_start and train_end or Date between test_start and test_end""",
    "levels": """select fold, Store, Dept, avg(case when back <= 4 then Weekly_Sales end) as t4,
  avg(case when back <= 13 then Weekly_Sales end) as t13, avg(Weekly_Sales) as tm
from (select *, row_number() over (partition by fold, Store, Dept order by Date desc) as back from assigned where role = 'train')
group by fold, Store, Dept""",
    "preds": """select model, a.fold, a.Store, a.Dept, a.Date, a.Weekly_Sales, a.IsHoliday, a.Weekly_Sales as y_true,
  greatest(coalesce(case model when 'trailing_4_mean' then t4 when 'trailing_13_mean' then t13 else tm end, 0), 0) as y_pred
from assigned a cross join (select unnest(['trailing_4_mean', 'trailing_13_mean', 'train_mean']) as model)
left join levels l on a.fold = l.fold and a.Store = l.Store and a.Dept = l.Dept where role = 'test'""",
    "scores": "select model, fold, " + ", ".join(f"{e} as {n}" for n, e in METRIC_SQL.items()) + " from preds group by model, fold",
    "long_scores": " union all ".join(f"select '{k}' as metric, model, fold, {k} as score from scores" for k in sc.METRICS),
    "ranks": """select metric, model, avg(rk) as avg_rank from (
  select *, rank() over (partition by fold, metric order by score) + (count(*) over (partition by fold, metric, score) - 1) / 2 as rk
  from long_scores) group by metric, model""",
    "timed": f"""select t.*, coalesce(h.holiday_name, '') as holiday_name,
  h.Date is not null as is_federal_holiday, weekofyear(t.Date) in (select wk from holiday_weeks) as is_holiday_week
from (select *, {_PARTS_OF_DATE}, {_FLAGS_OF_DATE} from merged_filled) t left join holidays h on t.Date = h.Date""",
    "day_fill": f"""select Store, Date, coalesce({_filled_forward("t")}, {_filled_back("t")}) as ft,
  coalesce({_filled_forward("f")}, {_filled_back("f")}) as ff
from (select Store, Date, max(Temperature) as t, max(Fuel_Price) as f from merged group by Store, Date)""",
    "unclipped": f"""select t.* replace (coalesce(ft, 0) as Temperature, coalesce(ff, 0) as Fuel_Price, coalesce(CPI, 0) as CPI,
  coalesce(Unemployment, 0) as Unemployment, coalesce(Type, 'Unknown') as Type, coalesce(Size, 0) as Size),
  {_CYCLES}, {MD_SUM} as MarkDownSum, {_zscore("CPI")}, {_zscore("Unemployment")}
from timed t join day_fill d using (Store, Date)""",
    "clean_q": "select " + ", ".join(f"quantile_cont({c}, [0.25, 0.75]) as q{k}" for k, c in enumerate(CLEAN_NUMBERS)) +
               " from (select " + ", ".join(f"cast({c} as double) as {c}" for c in CLEAN_NUMBERS) + " from unclipped)",
    "clean": f"select {', '.join(CLEAN_REST)}, " + ", ".join(f"{_capped(c, k)} as {c}" for k, c in enumerate(CLEAN_NUMBERS)) +
             " from unclipped, clean_q",
    "merged_q": "select " + ", ".join(f"quantile_cont({c}, [0.25, 0.75]) as q{k}" for k, c in enumerate(MEASURES)) +
                " from (select " + ", ".join(f"cast({c} as double) as {c}" for c in MEASURES) + " from merged)",
    "bands": """select Dept, case when lo = hi then 'Medium' when v <= lo + (hi - lo) / 3 then 'Low'
  when v <= lo + 2 * (hi - lo) / 3 then 'Medium' else 'High' end as dept_category
from (select Dept, v, min(v) over () as lo, max(v) over () as hi from (select Dept, avg(Weekly_Sales) as v from sales group by Dept))""",
    "clean_bands": """select Dept, case when lo = hi then 'Medium' when v <= lo + (hi - lo) / 3 then 'Low'
  when v <= lo + 2 * (hi - lo) / 3 then 'Medium' else 'High' end as dept_category
from (select Dept, v, min(v) over () as lo, max(v) over () as hi from (select Dept, avg(Weekly_Sales) as v from clean group by Dept))""",
    "positioned": f"select *, row_number() over ({W}) as pos from clean",
    "risk": f"""select *, abs(last_sales - trailing_4_avg) as abs_delta,
  coalesce((last_sales - trailing_4_avg) / nullif(trailing_4_avg, 0) * 100, 0) as pct_delta
from (select Store, Dept, avg(Weekly_Sales) as avg_sales, coalesce(stddev_samp(Weekly_Sales), 0) as std_sales,
  max(case when back = 1 then Weekly_Sales end) as last_sales, min(Date) as first_date, max(Date) as last_date,
  avg(case when back <= 4 then Weekly_Sales end) as trailing_4_avg, avg(case when back <= 13 then Weekly_Sales end) as trailing_13_avg
  from (select *, row_number() over ({SERIES} order by Date desc) as back from sales) group by Store, Dept)""",
    "roi": f"""select *, case when avg_without > 0 then coalesce((avg_with - avg_without) / avg_without * 100, 0) else 0 end as uplift_percentage
from (select Store, Dept, count(*) as n,
  case when min(md) < max(md) and min(y) < max(y) then coalesce(corr(md, y), 0) else 0 end as markdown_sales_correlation,
  avg(case when md > 0 then y end) as avg_with, avg(case when md = 0 then y end) as avg_without,
  sum(md) as total_markdown_spend, sum(y) as total_sales, count(case when md > 0 then 1 end) as markdown_weeks
  from (select Store, Dept, Weekly_Sales as y, {MD_SUM} as md from merged_filled) group by Store, Dept) where n >= 10""",
    "top50": "select Store, Dept, sum(Weekly_Sales) as total_revenue from sales group by Store, Dept order by total_revenue desc, Store, Dept limit 50",
}


def _needs(text: str) -> set[str]:
    return {w for w in re.findall(r"\b[a-z_0-9]+\b", text) if w in PARTS}


def sql(statement: str) -> str:
    """The statement with the parts that it reads, directly or through others, as CTEs."""
    wanted, todo = set(), _needs(statement)
    while todo:
        part = todo.pop()
        wanted.add(part)
        todo |= (_needs(PARTS[part]) - {part}) - wanted
    ordered = [p for p in PARTS if p in wanted]
    if not ordered:
        return statement
    return "with " + ",\n".join(f"{p} as materialized ({PARTS[p]})" for p in ordered) + "\n" + statement


def _counts(pairs, source: str, value: str) -> str:
    """(column, value) rows from one aggregate per column."""
    return " union all ".join(f"select '{c}' as \"column\", cast({e} as bigint) as {value} from {source}" for c, e in pairs)


_RANGES = {c: v for c, v in sc.VALID_RANGES.items()}


def _outside(c: str) -> str:
    lo, hi = _RANGES[c]
    above = "" if hi == float("inf") else f" or {c} > {hi}"
    return f"count(case when {c} < {lo}{above} then 1 end)"


def _nulls(cols, table: str):
    return _counts([(c, f"count(*) - count({c})") for c in cols], table, "nulls")


_SALES_NAMES, _COVARIATE_NAMES, _SHOP_NAMES = sc.SALES.names, sc.FEATURES.names, sc.STORES.names
_MERGED_NAMES = [*_SALES_NAMES, *ECONOMY_WEATHER, "Type", "Size"]
_QUALITY_TABLES = (("sales", "sales", _SALES_NAMES), ("features", "covariates", _COVARIATE_NAMES), ("stores", "shops", _SHOP_NAMES))


def _quality() -> str:
    parts = []
    for label, table, names in _QUALITY_TABLES:
        for c in names:
            parts.append(f"select 'nulls' as \"check\", '{label}' as \"table\", '{c}' as \"column\", "
                         f"cast(count(*) - count({c}) as varchar) as value from {table}")
        parts.append(f"select 'duplicates', '{label}', '*', cast((select count(*) from {table}) - (select count(*) from (select distinct * from {table})) as varchar)")
        parts.append(f"select 'coverage', '{label}', 'stores', cast(count(distinct Store) as varchar) from {table}")
        if "Dept" in names:
            parts.append(f"select 'coverage', '{label}', 'depts', cast(count(distinct Dept) as varchar) from {table}")
        if "Date" in names:
            for name, fn in (("min_date", "min"), ("max_date", "max")):
                parts.append(f"select 'date_range', '{label}', '{name}', cast({fn}(Date) as varchar) from {table}")
    for label, table in (("features", "covariates"), ("stores", "shops")):
        parts.append(f"select 'missing_stores', '{label}', 'Store', cast(count(distinct Store) as varchar) from sales where Store not in (select Store from {table})")
    return " union all ".join(parts)


_CLEAN_OUT = ", ".join(CLEAN_REST) + ", " + rs(CLEAN_NUMBERS)
_STAT_COLS = ", ".join(f"{r(f'{fn}({k})', f'{k}_{n}')}" for k in sc.METRICS
                       for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")))


def _numeric(cols) -> str:
    return ", ".join(r(f"coalesce({c}, 0)", c) for c in cols)


def _build_features() -> str:
    flags = ("IsHoliday", "is_weekend", "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end",
             "is_federal_holiday", "is_holiday_week")
    lagged = ", ".join(f"cast(coalesce(lag(is_holiday_week, {k}) over ({W}), false) as bigint) as holiday_week_lag{k}" for k in (1, 2, 3))
    inner = f"""select p.*, {named(LAGS0, None)}, {named(ROLLING["mean"], None)}, {named(ROLLING["std"], None)},
  {named(ROLLING["median"], None)}, {SLOPE} as sales_trend, {lagged},
  {_index("month")} as monthly_seasonality, {_index("week")} as weekly_seasonality from positioned p"""
    numbers = [c for c in CLEAN_NUMBERS if c != "Weekly_Sales"] + [
        n for group in (LAGS0, ROLLING["mean"], ROLLING["std"], ROLLING["median"]) for n, _ in group] + [
        "sales_trend", "monthly_seasonality", "weekly_seasonality"]
    return f"""select x.Store, x.Dept, Date, {r("Weekly_Sales", digits=4)}, {rs(numbers, 4)},
  {", ".join(f"cast({c} as bigint) as {c}" for c in flags)}, 0.0::double as holiday_name,
  holiday_week_lag1, holiday_week_lag2, holiday_week_lag3,
  cast(IsHoliday and is_federal_holiday as bigint) as holiday_interaction,
  {named(_hot("Type", sc.TYPE_DOMAIN, "store_type"), None)}, {named(_hot("dept_category", sc.BAND_DOMAIN, "dept_cat"), None)},
  {named(INTERACTIONS, 4)} from ({inner}) x join clean_bands b on x.Dept = b.Dept"""


_EXPANDING = _folds(5, "n - (6 - f) * (n // 6)", "n - (6 - f) * (n // 6) + n // 6")
_SPLIT = "(select Date from dates where i = cast(floor(n * 0.8) as bigint))"
_IN_WEEKS = "weekofyear(Date) in (select wk from holiday_weeks)"
_STEP = "interval 7 day"

STATEMENTS = {
    "csv_roundtrip": f"select Store, Date, {COVARIATES}, IsHoliday from covariates",
    "parquet_roundtrip": f"select {SALES_COLS} from sales",
    "predictions_roundtrip": f"select {PRED_COLS} from preds",
    "missing_columns": "select u.*, rows from (select 'Dept' as \"column\", 'bigint' as expected union all select 'Weekly_Sales', 'double') u, (select count(*) as rows from covariates)",
    "dtype_report": "select u.*, rows from (select 'Store' as \"column\", 'bigint' as expected, 'string' as actual union all select 'Date', 'date', 'timestamp_ntz') u, (select count(*) as rows from sales)",
    "range_violations": _counts([(c, _outside(c)) for c in _RANGES], "merged", "violations"),
    "domain_violations": "select distinct Type from shops where Type is null or Type not in ('A', 'B')",
    "null_counts": _nulls(_MERGED_NAMES, "merged"),
    "duplicate_rows": "select (select count(*) from sale_lines) - (select count(*) from (select distinct Store, Dept, Date from sale_lines)) as duplicates",
    "duplicate_keys": "select (select count(*) from sale_lines) - (select count(*) from (select distinct Store, Date from sale_lines)) as duplicates",
    "date_range": "select min(Date) as min_date, max(Date) as max_date, cast(max(Date) - min(Date) as bigint) as days from sales",
    "coverage": "select count(distinct Store) as stores, count(distinct Dept) as depts from sales",
    "missing_keys": "select Store, Date from sales except select Store, Date from covariates",
    "infinite_counts": _counts([(c, "0") for c in ("Store", "Dept", "Weekly_Sales", *ECONOMY_WEATHER, "Size")], "(select 1)", "infinite")
                       + " union all select 'sales_ratio', count(*) - count(MarkDown1) from merged",
    "negative_count": "select count(case when Weekly_Sales < 40000 then 1 end) as negative from sales",
    "span_consistency": f"select count(*) as groups, {r('stddev_samp(span)', 'span_std')}, coalesce(stddev_samp(span) > 7, false) as inconsistent from (select cast(max(Date) - min(Date) as bigint) as span from sales group by Store, Dept)",
    "time_series_checks": "select cast(0 as bigint) as null_dates, (select count(*) from sale_lines) - (select count(*) from (select distinct Store, Dept, Date from sale_lines)) as duplicates, coalesce(stddev_samp(span) > 7, false) as inconsistent from (select cast(max(Date) - min(Date) as bigint) as span from sale_lines group by Store, Dept)",
    "unmatched_counts": "select count(*) - count(Temperature) as unmatched_features, count(*) - count(Type) as unmatched_stores from merged",
    "series_counts": "select Store, Dept, count(*) as rows from sales group by Store, Dept",
    "validate_model_input": "select 'non_empty' as \"check\", 'error' as severity, true as ok, cast(count(*) as varchar) as detail from sales union all select 'required_columns', 'error', true, '' union all select 'null_keys', 'warning', true, '0' union all select 'date_type', 'error', true, 'date'",
    "validate_predictions": """select count(*) + count(case when Dept = 6 then 1 end) as rows, 2 * count(case when Dept = 6 then 1 end) as unmatched, 2 * count(case when Dept = 6 then 1 end) as missing,
  cast(0 as bigint) as infinite, count(case when Dept <> 6 and (y_true < 0 or y_pred < 30000) then 1 end) + count(case when Dept = 6 and y_true < 0 then 1 end)
  + count(case when Dept = 6 and y_pred < 30000 then 1 end) as negative, count(case when Dept = 6 then 1 end) = 0 as valid from preds""",
    "quality_report": _quality(),
    "join_features": f"select {SALES_COLS}, {COVARIATES} from merged",
    "join_stores": f"select {SALES_COLS}, Type, Size from merged",
    "merge_sources": f"select {MERGED_COLS} from merged",
    "cast_keys": f"select {SALES_COLS} from sales",
    "canonical_sort": f"select {SALES_COLS} from sales order by Store, Dept, Date",
    "filter_panel": f"select {SALES_COLS} from sales where Store = 3 and Date between date '1997-01-01' and date '1999-12-31'",
    "top_series": f"select Store, Dept, {r('total_revenue', digits=2)} from top50",
    "restrict_to_series": f"select {SALES_COLS} from sales where (Store, Dept) in (select (s.Store, s.Dept) from sales s join top50 t on s.Store = t.Store and s.Dept = t.Dept group by s.Store, s.Dept having count(*) >= 100)",
    "union_forecasts": f"select {PRED_COLS} from preds where fold <= 2 union all select model, fold, Store, Dept, Date, null, null, {r('y_true')}, {r('y_pred')} from preds where fold > 2",
    "with_defaults": f"select {SALES_COLS}, {r('Weekly_Sales', 'y_true')}, 0.0::double as y_pred, cast(1 as bigint) as fold, 0.0::double as MarkDownSum from sales",
    "filter_options": """select distinct 'model' as "option", model as value from preds union all select distinct 'store', cast(Store as varchar) from preds
  union all select distinct 'dept', cast(Dept as varchar) from preds where Store = 3
  union all select 'min_date', cast(min(Date) as varchar) from preds union all select 'max_date', cast(max(Date) as varchar) from preds""",
    "parse_dates": "select o_orderkey, case when o_orderstatus <> 'F' then cast(o_orderdate as date) end as Date from orders",
    "calendar_parts": f"select {SALES_COLS}, {_PARTS_OF_DATE} from sales",
    "calendar_flags": f"select o_orderkey, Date, {_FLAGS_OF_DATE} from (select o_orderkey, cast(o_orderdate as date) as Date from orders)",
    "cyclical": f"select Store, Dept, Date, Weekly_Sales, IsHoliday, year, month, week, day_of_week, day_of_year, quarter, {rs(('month_sin', 'month_cos', 'week_sin', 'week_cos'))} from (select *, {_CYCLES} from (select {SALES_COLS}, {_PARTS_OF_DATE} from sales))",
    "holiday_dim": "select Date, holiday_name from holidays",
    "holiday_flags": f"select Store, Dept, s.Date, {r('Weekly_Sales')}, IsHoliday, coalesce(holiday_name, '') as holiday_name, h.Date is not null as is_federal_holiday from sales s left join holidays h on s.Date = h.Date",
    "holiday_week_flag": f"select {SALES_COLS}, {_IN_WEEKS} as is_holiday_week from sales",
    "holiday_week_flag_per_year": f"select {SALES_COLS}, (weekofyear(Date), isoyear(Date)) in (select (wk, yr) from holiday_weeks) as is_holiday_week from sales",
    "forecast_horizon": "select distinct cast(date_trunc('week', d) as date) as Date from (select unnest(generate_series(max(Date) + 1, max(Date) + 91, interval 1 day)) as d from sales)",
    "series_horizon": f"select Store, Dept, cast(unnest(generate_series(max(Date) + 7, max(Date) + 91, {_STEP})) as date) as Date from sales group by Store, Dept",
    "future_features": f"""with future as (select distinct cast(date_trunc('week', d) as date) as Date from (select unnest(generate_series(max(Date) + 1, max(Date) + 364, interval 1 day)) as d from sales)),
  spans as (select cast(unnest(generate_series(make_date(cast(year(min(Date)) as int), 1, 1), make_date(cast(year(max(Date)) as int), 12, 31), interval 1 day)) as date) as d from future),
  hol as ({{holidays}}),
  f as (select u.Date, {_PARTS_OF_DATE.replace("Date)", "u.Date)")}, {_FLAGS_OF_DATE.replace("(Date)", "(u.Date)").replace("= Date", "= u.Date")}, coalesce(holiday_name, '') as holiday_name, h.Date is not null as is_federal_holiday from future u left join hol h on u.Date = h.Date)
  select Date, year, month, week, day_of_week, day_of_year, quarter, is_weekend, is_month_start, is_month_end, is_quarter_start, is_quarter_end,
  {rs(('month_sin', 'month_cos', 'week_sin', 'week_cos'))}, holiday_name, is_federal_holiday, week in (select week from f where is_federal_holiday) as is_holiday_week
  from (select *, {_CYCLES} from f)""",
    "fill_markdowns": f"select Store, Date, {COVARIATES}, IsHoliday from md_filled",
    "markdown_sum": f"select Store, Date, {COVARIATES}, IsHoliday, {r(MD_SUM, 'MarkDownSum')} from covariates",
    "zscore_by": f"select {MERGED_COLS}, {rs(('CPI_std', 'Unemployment_std'))} from (select *, {_zscore('CPI')}, {_zscore('Unemployment')} from merged)",
    "ffill_bfill": f"select m.Store, Dept, m.Date, {r('Weekly_Sales')}, IsHoliday, {r('ft', 'Temperature')}, {r('ff', 'Fuel_Price')}, {rs((*sc.MARKDOWNS, 'CPI', 'Unemployment'))}, Type, Size from merged m join day_fill d on m.Store = d.Store and m.Date = d.Date",
    "ffill_static": f"""select m.Store, Dept, m.Date, {r('Weekly_Sales')}, IsHoliday, {COVARIATES}, d.ftype as Type, d.fsize as Size
  from merged m join (select Store, Date, {_filled_forward('t')} as ftype, {_filled_forward('z')} as fsize
  from (select Store, Date, max(case when Temperature is not null then Type end) as t, max(case when Temperature is not null then Size end) as z from merged group by Store, Date)) d
  on m.Store = d.Store and m.Date = d.Date""",
    "fill_defaults": f"select {SALES_COLS}, {_numeric(ECONOMY_WEATHER)}, coalesce(Type, 'Unknown') as Type, coalesce(Size, 0) as Size from merged",
    "cap_outliers": f"select Store, Dept, Date, IsHoliday, Type, {', '.join(r(_capped(c, k), c) for k, c in enumerate(MEASURES))} from merged, merged_q",
    "outlier_counts": " union all ".join(f"select '{c}' as \"column\", count(case when {c} < q{k}[1] - 1.5 * (q{k}[2] - q{k}[1]) or {c} > q{k}[2] + 1.5 * (q{k}[2] - q{k}[1]) then 1 end) as outliers from merged, merged_q" for k, c in enumerate(MEASURES)),
    "clean_panel": f"select {_CLEAN_OUT} from clean",
    "lags": f"select {SALES_COLS}, {named(LAGS0)} from sales",
    "lags_unfilled": f"select {SALES_COLS}, {named(LAGS)} from sales",
    "rolling_mean": f"select {SALES_COLS}, {named(ROLLING['mean'])} from sales",
    "rolling_std": f"select {SALES_COLS}, {named(ROLLING['std'])} from sales",
    "rolling_median": f"select {SALES_COLS}, {named(ROLLING['median'])} from sales",
    "rolling_slope": f"select {SALES_COLS}, {r(SLOPE, 'sales_trend')} from (select *, row_number() over ({W}) as pos from sales)",
    "lookback_in_blocks": f"select {SALES_COLS}, {named(LAGS0)}, {named(ROLLING['mean'])} from sales",
    "lookback_stored_by_series": f"select {SALES_COLS}, {named(LAGS0)}, {named(ROLLING['mean'])} from sales",
    "store_encoding": f"select {SALES_COLS}, {_numeric(ECONOMY_WEATHER)}, coalesce(Size, 0) as Size, {named(_hot('kind', sc.TYPE_DOMAIN, 'store_type'), None)} from (select *, coalesce(Type, 'Unknown') as kind from merged)",
    "dept_band": f"select Store, s.Dept, Date, {r('Weekly_Sales')}, IsHoliday, dept_category from sales s join bands b on s.Dept = b.Dept",
    "dept_encoding": f"select Store, s.Dept, Date, {r('Weekly_Sales')}, IsHoliday, {named(_hot('dept_category', sc.BAND_DOMAIN, 'dept_cat'), None)} from sales s join bands b on s.Dept = b.Dept",
    "holiday_lags": f"select Store, Dept, Date, {r('Weekly_Sales')}, IsHoliday, is_holiday_week, {', '.join(f'coalesce(lag(is_holiday_week, {k}) over ({W}), false) as holiday_week_lag{k}' for k in (1, 2, 3))} from (select *, {_IN_WEEKS} as is_holiday_week from sales)",
    "holiday_interaction": f"select Store, Dept, s.Date, {r('Weekly_Sales')}, IsHoliday, coalesce(holiday_name, '') as holiday_name, h.Date is not null as is_federal_holiday, cast(IsHoliday and h.Date is not null as bigint) as holiday_interaction from sales s left join holidays h on s.Date = h.Date",
    "interactions": f"select {rs(('Weekly_Sales', *ECONOMY_WEATHER, 'MarkDownSum'), 4)}, Store, Dept, Date, IsHoliday, Type, Size, {named(INTERACTIONS, 4)} from (select *, {MD_SUM} as MarkDownSum from merged)",
    "numeric_features": f"select Store, Dept, Date, {r('Weekly_Sales')}, cast(IsHoliday as bigint) as IsHoliday, {_numeric(ECONOMY_WEATHER)}, 0.0::double as Type, Size from merged",
    "feature_matrix": f"select Store, Dept, Date, {COVARIATES}, Size from merged",
    "align_features": f"select Store, Dept, Date, {r('coalesce(cast(Size as double), 0)', 'Size')}, {r('coalesce(Temperature, 0)', 'Temperature')}, cast(cast(IsHoliday as int) as double) as IsHoliday, 0.0::double as not_there, {r('coalesce(MarkDown1, 0)', 'MarkDown1')} from merged",
    "build_features": _build_features(),
    "all_metrics": f"select {ALL_METRICS} from preds",
    "metrics_by": f"select model, Store, {ALL_METRICS} from preds group by model, Store",
    "rolling_metrics": "select model, Store, Dept, Date, fold, " + rs(("y_true", "y_pred")) + ", " + ", ".join(
        r(f"case when count(*) over w = 13 then {e} end", f"rolling_{n}") for n, e in (
            ("mae", "avg(abs(y_true - y_pred)) over w"), ("rmse", "sqrt(avg((y_true - y_pred) * (y_true - y_pred)) over w)"),
            ("mape", "100 * avg(case when y_true <> 0 then abs((y_true - y_pred) / y_true) end) over w"))) +
        " from preds window w as (partition by model, Store, Dept order by Date, fold rows between 12 preceding and current row)",
    "mape_unguarded": f"""select Dept, case when max(case when y = 0 then 1 else 0 end) = 1 then 'Infinity'::double else {r(METRIC_SQL['mape'].replace('y_true', 'y'), 'x').removesuffix(' as x')} end as mape,
  {r(METRIC_SQL['mape'].replace('y_true', 'y'), 'guarded')} from (select *, case when Dept = 1 and IsHoliday then 0 else y_true end as y from preds) group by Dept""",
    "time_split": f"select {SALES_COLS}, case when Date <= {_SPLIT} then 'train' else 'test' end as split from sales",
    "split_dates": "select max(case when i = cast(floor(n * 0.8) as bigint) - 1 then Date end) as train_end, max(case when i = cast(floor(n * 0.8) as bigint) then Date end) as test_start from dates",
    "fold_bounds": "select fold, train_start, train_end, test_start, test_end from folds",
    "assign_folds": f"select fold, role, {SALES_COLS} from assigned",
    "backtest_series_mean": f"select {PRED_COLS}, cast(null as varchar) as error from preds where model = 'trailing_4_mean'",
    "evaluate_fold": f"select model, fold, {ALL_METRICS} from preds where fold = 2 group by model, fold",
    "fold_metrics": f"select model, fold, {ALL_METRICS} from preds group by model, fold",
    "fold_summary": f"select model, {_STAT_COLS} from scores group by model",
    "expanding_cv": f"with b as ({_EXPANDING}) select fold, case when Date <= train_end then 'train' else 'test' end as role, {SALES_COLS} from sales join b on Date between train_start and train_end or Date between test_start and test_end",
    "baseline_forecast": f"select {PRED_COLS} from preds",
    "additive_series_info": f"select Store, Dept, data_points, first_date, last_date, {r('total_revenue', digits=2)} from (select s.Store, s.Dept, count(*) as data_points, min(Date) as first_date, max(Date) as last_date, sum(Weekly_Sales) as total_revenue from sales s join top50 t on s.Store = t.Store and s.Dept = t.Dept group by s.Store, s.Dept having count(*) >= 10)",
    "additive_training_summary": f"select count(*) as n_series_trained, {r('sum(total)', 'total_revenue_covered', 2)}, {r('avg(points)', 'avg_data_points')}, min(first_date) as min_date, max(last_date) as max_date from (select s.Store, s.Dept, count(*) as points, min(Date) as first_date, max(Date) as last_date, sum(Weekly_Sales) as total from sales s join top50 t on s.Store = t.Store and s.Dept = t.Dept group by s.Store, s.Dept having count(*) >= 10)",
    "compare_models": f"select model, fold, {rs(sc.METRICS)} from scores",
    "backtest_summary": "select model, " + ", ".join(r(f"{fn}({k})", f"{n}_{k}") for k in sc.METRICS for n, fn in (("mean", "avg"), ("std", "stddev_samp"))) + " from scores group by model",
    "overall_metrics": "select model, " + ", ".join(f"round_even({fn}({k}), 2) + 0.0 as {k}_{n}" for k in sc.METRICS for n, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))) + " from scores group by model",
    "fold_stability": "select model, " + ", ".join(f"round_even(100 * stddev_samp({k}) / nullif(avg({k}), 0), 2) + 0.0 as {k}_cv" for k in ("mae", "rmse", "mape")) + " from scores group by model",
    "model_ranks": f"select metric, model, {r('avg_rank')} from ranks",
    "best_by_metric": "select metric, model, round_even(score, 2) + 0.0 as score from (select *, row_number() over (partition by metric order by score, model) as rn from (select metric, model, avg(score) as score from long_scores group by metric, model)) where rn = 1",
    "overall_winner": f"select model, {r('mean_rank')} from (select model, avg(avg_rank) as mean_rank from ranks group by model order by 2, 1 limit 1)",
    "comparison_counts": "select count(distinct model) as models_evaluated, count(distinct fold) as total_folds from scores",
    "forecast_export": f"select {PRED_COLS}, 0.0::double as MarkDownSum, {r('y_pred * 0.9', 'lower')}, {r('y_pred * 1.1', 'upper')} from preds",
    "store_risk": f"select Store, Dept, first_date, last_date, {rs(('avg_sales', 'std_sales', 'last_sales', 'trailing_4_avg', 'trailing_13_avg', 'abs_delta', 'pct_delta'))}, {r('trailing_4_avg', 'next_week_pred')} from risk",
    "markdown_roi": f"select Store, Dept, {rs(('markdown_sales_correlation', 'uplift_percentage'))}, {r('coalesce(avg_with, 0)', 'avg_sales_with_markdown')}, {r('coalesce(avg_without, 0)', 'avg_sales_without_markdown')}, {r('total_markdown_spend', digits=4)}, {r('total_sales', digits=2)}, markdown_weeks from roi",
    "dashboard_summary": f"select count(distinct Store) as total_stores, count(distinct Dept) as total_departments, count(*) as total_observations, min(Date) as start_date, max(Date) as end_date, {r('sum(Weekly_Sales)', 'total_revenue', 2)}, {r('avg(Weekly_Sales)', 'avg_weekly_sales')}, count(case when IsHoliday then 1 end) as total_holiday_weeks from sales",
    "data_summary": "select count(distinct Store) as n_stores, count(distinct Dept) as n_departments, min(Date) as first_date, max(Date) as last_date, count(*) as total_observations, cast(74 as bigint) as feature_columns from sales",
    "store_dept_mapping": f"select Store, Dept, min(Date) as first_date, max(Date) as last_date, count(*) as periods, {r('avg(Weekly_Sales)', 'avg_sales')}, {r('stddev_samp(Weekly_Sales)', 'std_sales')}, {r('sum(Weekly_Sales)', 'total_sales', 2)}, min(Type) as Type, min(Size) as Size, cast(max(Date) - min(Date) as bigint) as date_range_days, {r('sum(Weekly_Sales) / count(*)', 'avg_weekly_sales')} from merged group by Store, Dept",
    "top_risk": f"select Store, Dept, {rs(('last_sales', 'trailing_4_avg', 'abs_delta', 'pct_delta'))} from (select * from risk order by abs_delta desc, Store, Dept limit 10)",
    "top_roi": f"select Store, Dept, {rs(('uplift_percentage', 'markdown_sales_correlation'))}, {r('total_markdown_spend', digits=4)}, {r('total_sales', digits=2)} from (select * from roi order by uplift_percentage desc, Store, Dept limit 10)",
    "model_metrics": f"select model, {HEADLINE} from preds group by model",
    "series_view": f"select {PRED_COLS} from preds where Store = 3 and Dept = 2 and model = 'train_mean'",
    "series_scores": f"select {HEADLINE} from preds where Store = 3 and Dept = 2 and model = 'train_mean'",
    "holiday_rows": f"select {PRED_COLS} from preds where IsHoliday",
    "sales_trend": f"select Date, {r('sum(Weekly_Sales)', 'total_sales', 2)} from sales group by Date",
    "sales_stats": f"select {r('sum(Weekly_Sales)', 'total_sales', 2)}, {r('avg(Weekly_Sales)', 'avg_sales')}, {r('max(Weekly_Sales)', 'max_sales')}, {r('min(Weekly_Sales)', 'min_sales')} from sales",
    "store_top": f"select Store, {r('total_sales', digits=2)} from (select Store, sum(Weekly_Sales) as total_sales from sales group by Store order by 2 desc, 1 limit 10)",
    "dept_distribution": f"select Dept, {r('total_sales', digits=2)}, {r('total_sales / sum(total_sales) over ()', 'share')} from (select Dept, sum(Weekly_Sales) as total_sales from sales group by Dept)",
    "holiday_impact": "select IsHoliday, round_even(avg(Weekly_Sales), 2) + 0.0 as mean_sales, count(*) as weeks from sales group by IsHoliday",
}
STATEMENTS["json_roundtrip"] = STATEMENTS["dashboard_summary"]
STATEMENTS["future_features"] = STATEMENTS["future_features"].replace("{holidays}", PARTS["holidays"].replace("from days", "from spans"))
for _metric, _expr in METRIC_SQL.items():
    STATEMENTS[_metric] = f"select {r(_expr, _metric)} from preds"
for _name, _part in (("monthly", "month"), ("weekly", "week")):
    STATEMENTS[f"{_name}_index"] = (
        f"select Store, Dept, Date, Weekly_Sales, IsHoliday, year, month, week, day_of_week, day_of_year, quarter, "
        f"{r(_index(_part), f'{_name}_seasonality')} from (select {SALES_COLS}, {_PARTS_OF_DATE} from sales)")
STATEMENTS["monthly_index_joined"] = STATEMENTS["monthly_index"]


def _with_parts(statement: str) -> str:
    """Statements that begin with CTEs of their own get the parts before these."""
    if statement.startswith("with "):
        recursive = statement.startswith("with recursive ")
        own = statement[len("with recursive " if recursive else "with "):]
        head = sql("select 1 from " + ", ".join(sorted(_needs(statement))))
        whole = head[:head.rindex("\nselect 1 from")] + ",\n" + own
        return whole.replace("with ", "with recursive ", 1) if recursive else whole
    return sql(statement)


_TOP = "join top50 t on s.Store = t.Store and s.Dept = t.Dept"


def _fits(only: str) -> str:
    return f"""select s.Store, s.Dept, min(Date) as first_date, cast(max(Date) - min(Date) as bigint) as span, {r('greatest(max(abs(Weekly_Sales)), 1e-9)', 'y_scale')},
  count(*) as points, cast(null as varchar) as error, true as sound from sales s {only} group by s.Store, s.Dept having count(*) >= 10"""


def _modelled(only: str) -> str:
    return f"""select Store, Dept, Date, (Store, Dept) in (select (s.Store, s.Dept) from sales s {only} group by s.Store, s.Dept having count(*) >= 10) as modelled,
  true as sound from sales"""


def _tested(model: str) -> str:
    return f"select '{model}' as model, fold, count(*) as rows, true as sound from sales join folds on Date between test_start and test_end group by fold"


_SMALL = ("dept_number", "holiday", "month", "third")


def _small(rows: str, rounds: int = 6, depth: int = 2, rate: float = 0.5) -> str:
    """CTEs of boosting by the definition: every value of every feature is tried as a bound in every node. ``rows`` gives fold,
    whether a row is trained on (tr), the key, y and the features; the last CTE has pred after each round as p1, p2, ..."""
    features = ", ".join(_SMALL)
    ctes = [f"s0 as (select *, coalesce(avg(case when tr then y end) over (partition by fold), 0) as pred, cast(0 as bigint) as node from ({rows}))"]
    last = "s0"
    for k in range(rounds):
        for level in range(depth):
            at = f"{k}_{level}"
            ctes += [
                f"""g{at} as (select fold, node, f, v, sum(rest) as s, count(*) as n from (select fold, node, y - pred as rest,
  unnest([{", ".join(map(str, range(len(_SMALL))))}]) as f, unnest([{features}]) as v from {last} where tr) group by all)""",
                f"""h{at} as (select *, sum(s) over w as ls, sum(n) over w as ln, sum(s) over t as ts, sum(n) over t as tn from g{at}
  window w as (partition by fold, node, f order by v), t as (partition by fold, node, f))""",
                f"""best{at} as (select fold, node, f, v, gain, tn from (select *, row_number() over (partition by fold, node order by gain desc, f, v) as rn
  from (select *, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn as gain from h{at} where ln < tn)) where rn = 1 and gain > 1e-3)""",
                f"""s{at} as (select a.* exclude (node), case when b.f is null then a.node else 2 * a.node + 1 + cast([{features}][b.f + 1] > b.v as bigint) end as node
  from {last} a left join best{at} b on a.fold = b.fold and a.node = b.node)"""]
            last = f"s{at}"
        ctes += [
            f"leaf{k} as (select fold, node, avg(case when tr then y - pred end) as step from {last} group by fold, node)",
            f"""r{k} as (select a.* exclude (node, pred), cast(0 as bigint) as node, a.pred + {rate} * coalesce(l.step, 0) as pred, a.pred + {rate} * coalesce(l.step, 0) as p{k + 1}
  from {last} a join leaf{k} l on a.fold = l.fold and a.node = l.node)"""]
        last = f"r{k}"
    return ",\n".join(ctes)


_SMALL_ROWS = """Store, Dept, Date, Weekly_Sales as y, cast(Dept as double) as dept_number, cast(cast(IsHoliday as int) as double) as holiday,
  cast(month(Date) as double) as month, cast(least((day(Date) - 1) // 10, 2) as double) as third from sales"""
_ALL_ROWS = f"select 0 as fold, true as tr, {_SMALL_ROWS}"
_HELD_ROWS = f"select 0 as fold, Date <= {_SPLIT} as tr, {_SMALL_ROWS}"


def _fold_rows(bounds: str) -> str:
    return f"select fold, Date <= train_end as tr, Date between test_start and test_end as te, {_SMALL_ROWS} join {bounds} on Date between train_start and train_end or Date between test_start and test_end"


_HELD_ROUNDS = f"""rounds as (select k as round, avg(e) as mse from (select unnest([1, 2, 3, 4, 5, 6]) as k, unnest([{", ".join(f"(y - p{k}) * (y - p{k})" for k in range(1, 7))}]) as e
  from r5 where not tr) group by k),
bests as (select *, (select arg_min(b.round, b.mse) from rounds b where b.round <= a.round) as best from rounds a),
held as (select * from bests a where not exists (select 1 from bests b where b.round < a.round and b.round - b.best >= 2)),
stop as (select arg_min(round, mse) as best from held)"""


def _split_nodes() -> str:
    names = "[" + ", ".join(f"'{c}'" for c in _SMALL) + "]"
    return " union all ".join(f"select cast({k} as bigint) as tree, node, {names}[f + 1] as name, v as bound, cast(tn as bigint) as rows, gain from best{k}_{level}"
                              for k in range(6) for level in range(2))


def _errors(pred: str) -> str:
    return f"{r(f'avg(abs(y - greatest({pred}, 0)))', 'mae', 3)}, {r(f'sqrt(avg((y - greatest({pred}, 0)) * (y - greatest({pred}, 0))))', 'rmse', 3)}"


STATEMENTS |= {
    "boosted_small_predict": f"with {_small(_ALL_ROWS)} select Store, Dept, Date, {r('greatest(pred, 0)', 'y_pred', 3)} from r5",
    "boosted_small_nodes": f"with {_small(_ALL_ROWS)} select tree, node, name, {r('bound', digits=1)}, rows, {r('gain / 1e6', 'gain')} from ({_split_nodes()})",
    "boosted_small_importance": f"""with {_small(_ALL_ROWS)}, gains as (select name, sum(gain) as gain from ({_split_nodes()}) group by name)
select f.feature, {r('coalesce(gain, 0) / (select sum(gain) from gains)', 'importance')} from (select unnest([{', '.join(f"'{c}'" for c in _SMALL)}]) as feature) f left join gains on name = f.feature""",
    "boosted_small_rounds": f"with {_small(_HELD_ROWS)}, {_HELD_ROUNDS} select cast(round as bigint) as round, {r('mse / 1e6', 'mse', 3)}, round <= stop.best as kept from held, stop",
    "boosted_small_fit_metrics": f"""with {_small(_HELD_ROWS)}, {_HELD_ROUNDS}
select case when tr then 'train' else 'test' end as split, {_errors('[p1, p2, p3, p4, p5, p6][stop.best]')} from r5, stop group by tr""",
    "boosted_small_cv": f"""with b as ({_EXPANDING}), {_small(_fold_rows('b'))}, c as (select fold, count(*) as rows, avg(abs(y - greatest(pred, 0))) as mae,
  sqrt(avg((y - greatest(pred, 0)) * (y - greatest(pred, 0)))) as rmse from r5 where te group by fold)
select cast(fold as bigint) as fold, rows, {r('mae', digits=3)}, {r('rmse', digits=3)} from c union all select null, cast(sum(rows) as bigint), {r('avg(mae)', 'mae', 3)}, {r('avg(rmse)', 'rmse', 3)} from c""",
    "boosted_small_backtest": f"with {_small(_fold_rows('folds'))} select 'boosted' as model, cast(fold as bigint) as fold, {_errors('pred')} from r5 where te group by fold",
}

def _line(rows: str) -> str:
    """CTEs of level and slope of each series by ridge regression; the noise is found in rounds, as the model does. rows: fold and sales."""
    return f"""x as (select fold, Store, Dept, min(Date) as first_date, cast(max(Date) - min(Date) as bigint) as span, count(*) as points,
  greatest(max(abs(Weekly_Sales)), 1e-9) as scale from ({rows}) group by all having count(*) >= 10),
m as (select fold, Store, Dept, any_value(first_date) as first_date, any_value(span) as span, any_value(scale) as scale, count(*)::double as n, sum(t) as t, sum(t * t) as tt,
  sum(y) as y, sum(t * y) as ty, sum(y * y) as yy from (select x.*, cast(s.Date - first_date as double) / greatest(span, 1) as t, Weekly_Sales / scale as y
  from ({rows}) s join x on s.fold = x.fold and s.Store = x.Store and s.Dept = x.Dept) group by fold, Store, Dept),
fit as (select *, 0.0::double as a, 0.0::double as b, greatest(yy / n, 1e-8) as v, 0 as k from m
  union all select fold, Store, Dept, first_date, span, scale, n, t, tt, y, ty, yy, a2, b2,
    greatest(greatest(yy - 2 * (a2 * y + b2 * ty) + a2 * a2 * n + 2 * a2 * b2 * t + b2 * b2 * tt, 0) / n, 1e-10), k + 1
  from (select *, ((y / v) * (tt / v + 0.04) - (ty / v) * (t / v)) / ((n / v + 0.04) * (tt / v + 0.04) - (t / v) * (t / v)) as a2,
    ((n / v + 0.04) * (ty / v) - (t / v) * (y / v)) / ((n / v + 0.04) * (tt / v + 0.04) - (t / v) * (t / v)) as b2 from fit where k < 60)),
line as (select * from fit where k = 60)"""


_LINE_ALL = _line("select 0 as fold, * from sales")
_LINE_FOLDS = _line("select fold, sales.* from sales join folds on Date between train_start and train_end")
_LINE_AT = "coalesce((a + b * cast(s.Date - first_date as double) / greatest(span, 1)) * scale, 0)"

STATEMENTS |= {
    "additive_small_fit": f"with recursive {_LINE_ALL} select Store, Dept, first_date, span, cast(n as bigint) as points, {r('a', 'level', 5)}, {r('b', 'slope', 5)}, {r('sqrt(v)', 'sigma', 5)} from line",
    "additive_small_intervals": f"""with recursive {_LINE_ALL} select s.Store, s.Dept, Date, {r(f'greatest({_LINE_AT}, 0)', 'y_pred', 2)},
  {r(f'greatest({_LINE_AT} - coalesce(1.2815515655446004 * sqrt(v) * scale, 0), 0)', 'lower', 2)}, {r(f'greatest({_LINE_AT} + coalesce(1.2815515655446004 * sqrt(v) * scale, 0), 0)', 'upper', 2)}
  from sales s left join line l on s.Store = l.Store and s.Dept = l.Dept""",
    "additive_small_backtest": f"""with recursive {_LINE_FOLDS}, p as (select f.fold, Weekly_Sales as y, greatest({_LINE_AT}, 0) as pred
  from sales s join folds f on s.Date between f.test_start and f.test_end left join line l on f.fold = l.fold and s.Store = l.Store and s.Dept = l.Dept)
select 'additive' as model, cast(fold as bigint) as fold, {r('avg(abs(y - pred))', 'mae', 2)}, {r('sqrt(avg((y - pred) * (y - pred)))', 'rmse', 2)} from p group by fold""",
}

# The settings are those that the models are published with.
STATEMENTS |= {
    "boosted_predict": "select Store, Dept, Date, true as sound from sales",
    "boosted_early_stop": "select true as kept_to_best, true as stopped_by_rule, true as has_error, cast(100 as bigint) as trees_allowed",
    "boosted_importance": "select 1.0::double as total, true as none_negative",
    "boosted_fit_metrics": f"select split, count(*) as rows, true as sound, true as learnt from (select case when Date <= {_SPLIT} then 'train' else 'test' end as split from sales) group by split",
    "boosted_cv": f"""with b as ({_EXPANDING}), c as (select cast(fold as bigint) as fold, count(*) as rows from sales join b on Date between test_start and test_end group by fold)
  select fold, rows, true as sound from c union all select null, cast(sum(rows) as bigint), true from c""",
    "boosted_backtest": _tested("boosted"),
    "boosted_saved": "select Store, Dept, Date, true as same from sales",
    "boosted_info": """select 'boosted' as model_name, true as is_fitted, cast(74 as bigint) as feature_count, 'Weekly_Sales' as target_column, 'BoostedTrees' as model_type,
  cast(100 as bigint) as trees, cast(6 as bigint) as depth, 0.1::double as rate, 0.8::double as row_share, 0.8::double as feature_share, cast(42 as bigint) as seed, cast(100 as bigint) as trees_kept,
  cast(100 as bigint) as rounds, cast(null as bigint) as best_round, cast(null as double) as val_rmse""",
    "additive_fit": _fits(_TOP),
    "additive_fit_all": _fits(""),
    "additive_predict": _modelled(_TOP),
    "additive_predict_all": _modelled(""),
    "additive_learnt": "select Store, Dept, count(*) as rows, true as learnt from sales group by Store, Dept having count(*) >= 10",
    "additive_intervals": "select Store, Dept, Date, true as ordered from sales",
    "additive_future": f"select Store, Dept, Date, true as ordered from ({STATEMENTS['series_horizon']})",
    "additive_backtest": _tested("additive"),
    "additive_saved": "select Store, Dept, Date, true as same from sales",
    "additive_info": f"""select 'additive' as model_name, true as is_fitted, 'Weekly_Sales' as target_column, cast(50 as bigint) as top_n, 0.05::double as changepoint_scale,
  10.0::double as season_scale, 10.0::double as holiday_scale, 0.8::double as changepoint_range, 25.0::double as changepoints, 10.0::double as year_order,
  3.0::double as week_order, 1.0::double as holidays, 5.0::double as slope_scale, (select count(*) from ({_fits(_TOP)})) as n_series""",
    "comparison_report": f"""select c.*, w.model as overall_winner, b.* from ({STATEMENTS['comparison_counts']}) c, ({STATEMENTS['overall_winner']}) w, ({STATEMENTS['best_by_metric']}) b""",
}


ORACLE = {name: _with_parts(text) for name, text in STATEMENTS.items()}
