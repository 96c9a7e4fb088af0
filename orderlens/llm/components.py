"""Connected components by alternating large-star and small-star steps.

Edges live in written tables in the shared work folder, one per step; nothing
but their number and checksum comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import written


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _toward_least(sides: DataFrame, least_of: str) -> DataFrame:
    """(v, m): each v beside u with the least m of u and its neighbours."""
    least = sides.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    joined = sides.join(least, "u")
    if least_of == "larger":  # large star: larger neighbours move to the least
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # small star: u and its smaller neighbours move to the least
    return (joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u != v"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the least node of its component."""
    now = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both, "larger")
        now = written(_toward_least(large.distinct(), "smaller").distinct(), name)
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
