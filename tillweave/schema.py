"""Column names, table schemas and value domains of the sales panel."""

from __future__ import annotations

from pyspark.sql import types as T

# The panel's key. One row per store, department and day: a series can therefore
# hold at most one row per calendar day, however large the panel grows.
STORE, DEPT, DATE = "Store", "Dept", "Date"
SERIES = (STORE, DEPT)
KEY = (STORE, DEPT, DATE)
TARGET = "Weekly_Sales"

MARKDOWNS = ("MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5")
ECONOMY = ("CPI", "Unemployment")
WEATHER = ("Temperature", "Fuel_Price")

SALES = T.StructType([
    T.StructField(STORE, T.LongType()),
    T.StructField(DEPT, T.LongType()),
    T.StructField(DATE, T.DateType()),
    T.StructField(TARGET, T.DoubleType()),
    T.StructField("IsHoliday", T.BooleanType()),
])

FEATURES = T.StructType(
    [T.StructField(STORE, T.LongType()), T.StructField(DATE, T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in (*WEATHER, *MARKDOWNS, *ECONOMY)]
    + [T.StructField("IsHoliday", T.BooleanType())]
)

STORES = T.StructType([
    T.StructField(STORE, T.LongType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Size", T.LongType()),
])

# Accepted range of each column, store types, one-hot domains.
UNBOUNDED = float("inf")
VALID_RANGES = {
    "Store": (1, 45),
    "Dept": (1, 99),
    "Weekly_Sales": (0, UNBOUNDED),
    "Temperature": (-50, 150),
    "Fuel_Price": (0, 10),
    "MarkDown1": (0, UNBOUNDED),
    "MarkDown2": (0, UNBOUNDED),
    "MarkDown3": (0, UNBOUNDED),
    "MarkDown4": (0, UNBOUNDED),
    "MarkDown5": (0, UNBOUNDED),
    "CPI": (100, 300),
    "Unemployment": (0, 20),
    "Size": (10000, 200000),
}
STORE_TYPES = ("A", "B", "C")
TYPE_DOMAIN = (*STORE_TYPES, "Unknown")
BAND_DOMAIN = ("Low", "Medium", "High")

LAGS = (1, 2, 3, 4, 6, 8, 13)
WINDOWS = (3, 4, 6, 8, 13)
METRICS = ("mae", "rmse", "mape", "smape", "wape")

NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType,
)


def numeric_columns(df, exclude=()):
    """Names of the numeric columns of ``df``; a plan-time look at the schema."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df, exclude=()):
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
