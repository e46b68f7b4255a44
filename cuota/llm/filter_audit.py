"""What each of several filters removes, in every order they can be applied, from counts on the lattice of filter sets."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuota.llm.common import SPACES, stored, text_or_empty

# Orders are listed one by one, so the number of filters is small; their lattice has 2^n states and n * 2^(n-1) edges.
MOST_FILTERS = 7

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def paths(count: int) -> tuple[list[int], list[int]]:
    """Per state (a set of filters, as bits): how many orders reach it from the empty set, and how many lead on from it
    to the full one."""
    states = 1 << count
    forward, backward = [1] + [0] * (states - 1), [0] * (states - 1) + [1]
    for state in range(states):
        for bit in (1 << f for f in range(count) if not state >> f & 1):
            forward[state | bit] += forward[state]
    for state in reversed(range(states - 1)):
        backward[state] = sum(backward[state | 1 << f] for f in range(count) if not state >> f & 1)
    return forward, backward


def _small(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A table whose size depends on the number of filters alone."""
    return spark.createDataFrame(pa.table({n: list(column) for n, column in zip(names, zip(*rows))}))


def edges(count: int) -> list[tuple[int, int, int]]:
    """(state before, filter, orders that take this edge), for every edge of the lattice."""
    forward, backward = paths(count)
    return [(state, f, forward[state] * backward[state | 1 << f]) for state in range(1 << count) for f in range(count)
            if not state >> f & 1]


def quality_filters(words: Column, text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text. `words` are its words, `text` is not null."""
    count, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    return {
        "A": count < 50,
        "B": 100 * distinct < 65 * count,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(df: DataFrame, labels: DataFrame, *, text: str = "text", id: str = "doc_id", part: str = "source",
             repeats: str = "E", filters: Mapping[str, object] | None = None) -> tuple[DataFrame, list[str]]:
    """(`part`, `mask`, `good`, `toxic`, `n`): how many rows of `df` are alike in all of these, and the names of the
    filters in the order of the mask's bits.

    `filters(words, text)` gives the conditions on one text; the filter `repeats` is the last bit: the text is that of a
    smaller id. Texts are read once; what is stored and shuffled is a digest per row. Copies of a text are counted per
    part and label, with how many of them have the smallest id there, before they meet the smallest id of all, so a text
    that most rows have is a few rows.
    """
    whole = df.select(F.col(f"`{id}`").alias("_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                      text_or_empty(f"`{text}`").alias("_text"))
    words = whole.withColumn("_words", F.array_remove(F.split("_text", f"[{SPACES}]+"), ""))
    tests = (filters or quality_filters)(F.col("_words"), F.col("_text"))
    names = [*tests, repeats]
    mask = sum((F.when(test, 1 << n).otherwise(0) for n, test in enumerate(tests.values())), F.lit(0))
    own = stored(words.select("_id", "part", mask.alias("_own"), F.sha2("_text", 256).alias("_hash")), "audit-masks")
    label = labels.groupBy(F.col("doc_id").alias("_labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
    joined = own.join(label, F.col("_id") == F.col("_labelled"), "left").select(
        "_id", "part", "_own", "_hash", F.coalesce("_good", F.lit(0)).alias("good"), F.coalesce("_toxic", F.lit(0)).alias("toxic"))
    like = ["_hash", "part", "_own", "good", "toxic"]
    per_id = joined.groupBy("_id", *like).agg(F.count("*").alias("_n"))
    named = F.when(F.col("_id").isNotNull(), F.struct("_id", "_n"))
    counted = stored(per_id.groupBy(*like).agg(F.sum("_n").alias("_n"), F.min(named).alias("_least"),
                                               F.sum(F.when(F.col("_id").isNull(), F.col("_n")).otherwise(0)).alias("_bare")),
                     "audit-copies")
    firsts = counted.groupBy("_hash").agg(F.min("_least._id").alias("_first"))
    both = counted.join(firsts.withColumnRenamed("_hash", "_same"), F.col("_hash") == F.col("_same"))
    fresh = F.col("_bare") + F.when(F.col("_least._id") == F.col("_first"), F.col("_least._n")).otherwise(0)
    kinds = F.array(F.struct(F.col("_own").alias("mask"), fresh.alias("n")),
                    F.struct((F.col("_own") + (1 << len(tests))).alias("mask"), (F.col("_n") - fresh).alias("n")))
    return both.select("part", "good", "toxic", F.inline(kinds)).where("n > 0"), names


def interaction_audit(failed: DataFrame, names: list[str]) -> DataFrame:
    """(`part`, `filter_order`, `step`, counts) for every part of `failed`, order of the filters and step.

    `failed` (`part`, `mask`, `good`, `toxic`, `n`) stands for `n` documents a row, bit n of the mask telling that they fail
    filter n. They are counted per part and mask first, at most 2^n rows a part. An edge of the lattice leads from a set of filters
    to that set and one filter more; what that filter removes there are the documents that fail it and none of the set.
    Every mask adds its count to the edges that remove it. All else is read from the edges: a step of an order is an
    edge; a filter's edge from the empty set has all that fail it, its edge from all the others what only it fails; the
    Shapley sum weighs each edge with the orders that reach its beginning times those that leave its end.
    """
    count = len(names)
    if count > MOST_FILTERS:
        raise ValueError(f"{count} filters have too many orders to list; {MOST_FILTERS} at most")
    spark, full = failed.sparkSession, (1 << count) - 1
    of = lambda label: F.sum(F.col(label) * F.col("n")).cast("long").alias(label)
    counted = stored(failed.groupBy("part", "mask").agg(F.sum("n").cast("long").alias("n"), of("good"), of("toxic")),
                     "audit-counts")
    lattice = edges(count)
    removing = _small(spark, ["mask", "before", "filter"], [
        (mask, state, f) for mask in range(1, full + 1) for state, f, _ in lattice if not mask & state and mask >> f & 1])
    steps = _small(spark, ["filter_order", "step", "before", "filter"], [
        ("".join(names[f] for f in order), n + 1, sum(1 << f for f in order[:n]), f)
        for order in permutations(range(count)) for n, f in enumerate(order)])
    weights = _small(spark, ["before", "filter", "orders", "others"], [(s, f, n, full ^ 1 << f) for s, f, n in lattice])

    parts = counted.groupBy("part").agg(F.sum("n").alias("total"))
    zeros = parts.select("part", F.inline(F.array(*[F.struct(F.lit(s).cast("long").alias("before"), F.lit(f).cast("long").alias("filter"))
                                                    for s, f, _ in lattice])))
    zero = F.lit(0).cast("long")
    taken = counted.join(F.broadcast(removing), "mask").select("part", "before", "filter", "n", "good", "toxic").unionAll(
        zeros.select("part", "before", "filter", zero, zero, zero))
    removed = taken.groupBy("part", "before", "filter").agg(
        F.sum("n").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
    of_filter = Window.partitionBy("part", "filter")
    known = removed.join(F.broadcast(weights), ["before", "filter"]).select(
        "part", "before", "filter", "removed", "good_lost", "toxic_lost",
        F.sum(F.col("orders") * F.col("removed")).over(of_filter).alias("shapley"),
        F.max(F.when(F.col("before") == 0, F.col("removed"))).over(of_filter).alias("_fails"),
        F.max(F.when(F.col("before") == F.col("others"), F.col("removed"))).over(of_filter).alias("unique_fails"))
    walked = known.join(F.broadcast(steps), ["before", "filter"]).join(parts, "part")
    so_far = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return walked.select("part", "filter_order", F.col("step").cast("int").alias("step"),
                         (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed",
                         (F.col("_fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
                         "shapley")


def audit_documents(df: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """`interaction_audit` of the five filters on the documents of `df`, by source.

    Null text is the empty text; a null source is the part ''. Rows that repeat an id have its labels each and are not
    copies of one another; a null id is smaller than none and fails no `E`. A document is good or toxic if any of its
    labels says so. An empty table gives no rows. Other columns of `df`, with whatever names, are not read.
    """
    return interaction_audit(*failures(df, labels, **columns))
