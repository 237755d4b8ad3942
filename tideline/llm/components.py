"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high"))).first()
    )


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node, root: every node of a link with the smallest node of its component.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    the smallest node it sees, then its smaller neighbours and itself. Each step is an
    aggregation to one minimum per node and a join of the links with it, so a node with
    very many links costs no more than its links. The number of rounds grows with the
    logarithm of the longest path.
    """
    edges = stored(
        links.select(
            F.least(left, right).alias("low"), F.greatest(left, right).alias("high")
        )
        .filter("low < high")
        .distinct(),
        "links",
    )
    before = _state(edges)
    while True:
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
            edges.select(F.col("high").alias("u"), F.col("low").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = stored(
            small.filter("v != m")
            .select(F.col("m").alias("low"), F.col("v").alias("high"))
            .unionByName(least.select(F.col("m").alias("low"), F.col("u").alias("high")))
            .distinct(),
            "links",
        )
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return roots.unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
