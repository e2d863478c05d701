"""Connected components of a graph given by its edges, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` for every node of an edge; a root names its component.

    Each round every node joins the neighbour (or itself) that comes first in an
    order drawn anew for the round, and the edges are renamed to those joined; an
    expected constant share of the nodes goes away each time, so rounds grow with
    the logarithm of a component's size.  Hot nodes are reduced before the shuffle.
    Rounds are cut by written tables, so a lost executor costs one round's tasks.
    """
    now = materialise(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    )
    nodes = now.select(F.col("u").alias("node")).union(now.select("v")).distinct()
    joined = materialise(nodes.select("node", F.col("node").alias("root")))
    turn = 0
    while now.limit(1).count():
        turn += 1
        both = now.union(now.select("v", "u"))

        def place(c, turn=turn):
            return F.struct(F.xxhash64(F.lit(turn), c).alias("at"), c.alias("id"))

        first = both.groupBy("u").agg(F.min(place(F.col("v"))).alias("first")).select(
            "u", F.least("first", place(F.col("u")))["id"].alias("to")
        )
        first = materialise(first)
        joined = materialise(
            joined.join(first, joined["root"] == first["u"], "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        )
        left = first.select(F.col("u").alias("v"), F.col("to").alias("v_to"))
        now = materialise(
            now.join(first, "u").join(left, "v")
            .select(F.col("to").alias("u"), F.col("v_to").alias("v"))
            .filter("u <> v").distinct()
        )
    return joined
