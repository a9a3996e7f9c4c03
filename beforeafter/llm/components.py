"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beforeafter.staging import stage


def connected(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all linked nodes.

    ``links`` has two long columns ``a`` and ``b``; direction, repeats and loops do
    not matter. Each round hooks the greater ends of a node's links to the least of
    its neighbours, then its smaller ends likewise, which keeps components, never adds
    links beyond the nodes' and about squares the reach. Minima are aggregated before
    the shuffle, so a hub's links meet in no task but as a join side that adaptive
    execution splits. Every round is written to the shared folder. Stops when a round
    changes nothing, which leaves one link from each node to its root; raises if the
    rounds run out.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    edges = stage(links.filter("a != b").select(hi, lo).distinct(), "links")
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("near")).unionByName(
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("near"))
        )
        least = both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("to"))
        large = edges.join(least, edges["lo"] == least["node"]).select("hi", F.col("to").alias("lo")).distinct()
        large = stage(large, "links")
        least = large.groupBy("hi").agg(F.min("lo").alias("to")).withColumnRenamed("hi", "node")
        met = large.join(least, large["hi"] == least["node"])
        small = met.select("hi", F.col("to").alias("lo")).unionByName(
            met.filter("lo != to").select(F.col("lo").alias("hi"), F.col("to").alias("lo"))
        )
        edges = stage(small.distinct(), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise ArithmeticError(f"components not settled after {max_rounds} rounds")
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    seen = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return seen["n"], seen["x"]
