"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cuota.llm.common import discard, stored


def _to_smallest(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is tied to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_low")).select("a", F.least("a", "_low").alias("_low"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_low").alias("b"))
            .where("a != b").distinct())


def _below(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_low"))
    tied = down.join(least, "a")
    return (tied.select(F.col("b").alias("a"), F.col("_low").alias("b")).where("a != b")
            .unionAll(least.select("a", F.col("_low").alias("b"))).distinct())


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, and their number and checksum, observed while they are written: a query of its own for these
    would leave its plan and stages in the driver's memory, round after round."""
    state = [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")]
    seen = Observation()
    kept = stored(edges.observe(seen, *state), "components")
    found = seen.get or kept.agg(*state).first().asDict()  # nothing is observed where Spark drops an empty part of a plan
    return kept, (found["rows"], found["sum"])


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `component`) for every node of `edges` (columns `a`, `b`) that is not the smallest of its component.

    Every round stores its edges and ends when they no longer change; the number of rounds grows with the logarithm of
    the graph, not with its diameter. Minima are partially aggregated, hot nodes' joins are split by AQE, and only a row
    count and a checksum come to the driver. Loops and repeated edges do no harm; no edges give no rows.
    """
    (current, state), seen = _kept(edges.select("a", "b").where("a != b").distinct()), None
    while state != seen and state[0]:
        seen, before = state, current
        current, state = _kept(_below(_to_smallest(current)))
        discard(before)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
