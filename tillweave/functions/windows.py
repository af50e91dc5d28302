"""Window specifications over series, and a way to cut them into blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schema import DATE, SERIES

BLOCK, HALO = "_block", "_halo"


def series_window(by: Sequence[str] = SERIES, order: str = DATE) -> WindowSpec:
    """Rows of one series in date order.

    A series has at most one row per day, so the rows of one window partition are
    bounded by the calendar and not by the size of the panel. All operators use
    the same specification: stacked, they share one shuffle and one sort.
    """
    return Window.partitionBy(*by).orderBy(order)


def trailing(window: WindowSpec, rows: int) -> WindowSpec:
    """The current row and the ``rows - 1`` rows before it."""
    return window.rowsBetween(-(rows - 1), 0)


def in_blocks(df: DataFrame, apply: Callable[[DataFrame, Sequence[str]], DataFrame], lookback: int,
              block_days: int = 3650, by: Sequence[str] = SERIES, order: str = DATE) -> DataFrame:
    """Run a look-back operator with all series cut into calendar blocks.

    ``apply(df, by)`` may look at no more than ``lookback`` earlier rows. Series are
    cut every ``block_days`` days; each block is preceded by a halo, the ``lookback``
    rows before it, which is dropped again afterwards. The blocks of a series thus run
    in different tasks. The result equals ``apply(df, by)``.
    """
    by = list(by)
    cut = df.withColumn(BLOCK, F.floor(F.datediff(order, F.lit("1970-01-01").cast("date")) / block_days))

    # Rows of each block, and how many rows of the block before it, the one before
    # that, ... are still wanted in its halo.
    counts = cut.groupBy(*by, BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    later = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(1, lookback)
    between = Window.partitionBy(*by, BLOCK).orderBy("_target").rowsBetween(Window.unboundedPreceding, -1)
    targets = (
        counts.withColumn("_later", F.collect_list(F.struct(F.col(BLOCK).alias("_target"), "_n")).over(later))
        .select(*by, BLOCK, F.explode("_later").alias("_t"))
        .select(*by, BLOCK, "_t._target", F.col("_t._n").alias("_target_n"))
        .withColumn("_want", lookback - F.coalesce(F.sum("_target_n").over(between), F.lit(0)))
        .where("_want > 0").select(*by, BLOCK, "_target", "_want"))
    from_end = Window.partitionBy(*by, BLOCK).orderBy(F.col(order).desc())
    tails = cut.withColumn("_rd", F.row_number().over(from_end)).where(F.col("_rd") <= lookback)
    halo = (tails.join(targets, [*by, BLOCK]).where(F.col("_rd") <= F.col("_want"))
            .withColumn(BLOCK, F.col("_target")).select(*df.columns, BLOCK, F.lit(True).alias(HALO)))

    both = cut.select(*df.columns, BLOCK, F.lit(False).alias(HALO)).unionByName(halo)
    return apply(both, [*by, BLOCK]).where(~F.col(HALO)).drop(BLOCK, HALO)
