"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .steps import Steps


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node reachable.

    Each round points every node at the smallest neighbour it knows of, first from
    the larger side and then from the smaller one, until the stars stay the same.
    Rounds are written to the shared folder, so a lost executor costs one round.
    Hubs are safe: minima are pre-aggregated and the joins may be split by Spark.
    Loops and rows with a null end are no links; an empty table gives no rows.
    """
    steps = Steps(links.sparkSession)
    stars = steps.write(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    before = None
    while True:
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if now[0] == 0 or now == before:
            return stars.selectExpr("hi as node", "lo as root").union(stars.selectExpr("lo as node", "lo as root")).distinct()
        before = now
        both = stars.selectExpr("hi as u", "lo as v").union(stars.selectExpr("lo as u", "hi as v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v as hi", "m as lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo > m").selectExpr("lo as hi", "m as lo")
        stars = steps.write(small.union(least.selectExpr("hi", "m as lo")).distinct(), "stars", (stars,))
