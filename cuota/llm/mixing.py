"""Mixing sources to target weights by weighted sampling without replacement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.llm.common import SPACES, stored, text_or_empty, without

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
# No source is taken more often than this.
MAX_EPOCHS = 3
# Slices of the key range. A source's rows are summed per slice, and only the slice that holds the cut is sorted, so the
# largest sort has about one part in KEY_SLICES of the largest source.
KEY_SLICES = 4096
# Share of these characters in a text lowers its quality weight.
SYMBOLS = r"[#$%&*+<=>@\\^_|~{}\[\]]"

_ADDED = ("size", "source_size", "target", "taken", "copies")


def words(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(f"[^{SPACES}]+")).cast("long")


def quality_weight(text: str) -> Column:
    """1 for plain prose, lower the more symbols a text has; always positive."""
    symbols = F.regexp_count(text_or_empty(text), F.lit(SYMBOLS))
    share = symbols.cast("double") / F.greatest(F.length(text_or_empty(text)), F.lit(1))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * share)


def exponential_key(id: str, weight: Column, seed: int) -> Column:
    """Efraimidis-Spirakis key -ln(u) / weight; u in (0, 1) is a hash of seed and id. Small keys are taken first."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id).cast("string"), F.lit("null"))))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((number + F.lit(0.5)) / F.lit(float(16 ** 13))) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds `target` to one row per source (`_source`, `source_size`): shares of all sizes by weight, capped.

    Sources are taken in order of cap over weight. A source is at its cap if the level that the rest would share without
    it still exceeds that ratio; the first that is not fixes the level for all after it.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    caps = sizes.withColumn("_weight", weight.cast("long")).withColumn("_cap", F.col("source_size") * max_epochs)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    level = left.cast("double") / F.sum("_weight").over(onward)
    levels = caps.withColumn("_level", level).withColumn("_rank", F.row_number().over(by_ratio))
    free = F.when(F.col("_cap") / F.col("_weight") >= F.col("_level"), F.col("_rank"))
    common = F.min_by("_level", free).over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("_cap").cast("double"), F.coalesce(common * F.col("_weight"), F.col("_cap").cast("double")))
    return levels.withColumn("target", target).select("_source", "source_size", "target")


def _cuts(scored: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the slice and the key up to which rows are taken once more, after the complete epochs.

    Slices that fit whole come first; in the slice where the budget ends, keys are added while that brings the sum nearer.
    """
    per_slice = scored.groupBy("_source", "_slice").agg(F.sum("size").alias("_slice_size"))
    so_far = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = (per_slice.withColumn("_before", F.coalesce(F.sum("_slice_size").over(so_far), F.lit(0)))
            .join(plan.select(F.col("_source").alias("_s"), "_budget"), F.col("_source").eqNullSafe(F.col("_s")))
            .where(F.col("_before") + F.col("_slice_size") > F.col("_budget"))
            .groupBy("_source").agg(F.min(F.struct("_slice", "_before", "_budget")).alias("_end"))
            .select(F.col("_source").alias("_s"), F.col("_end._slice").alias("_cut_slice"),
                    F.col("_end._before").alias("_before"), F.col("_end._budget").alias("_budget")))
    inside = scored.join(ends, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_cut_slice")))
    per_key = (inside.groupBy("_source", "_key")
               .agg(F.sum("size").alias("_size"), F.first("_before").alias("_before"),
                    F.first("_budget").alias("_budget")))
    by_key = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("_size").over(by_key), F.lit(0))
    last = (per_key.withColumn("_start", start)
            .where(2 * F.col("_start") + F.col("_size") <= 2 * F.col("_budget"))
            .groupBy("_source").agg(F.max("_key").alias("_cut_key")).select(F.col("_source").alias("_t"), "_cut_key"))
    return (ends.join(last, F.col("_s").eqNullSafe(F.col("_t")), "left").select("_s", "_cut_slice", "_cut_key"))


def mix_sources(df: DataFrame, *, text: str = "text", source: str = "source", id: str = "doc_id",
                weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                seed: int = 7, only_decisions: bool = False) -> DataFrame:
    """Every row of `df` with `size`, `source_size`, `target`, `taken` words and `copies` the mix takes of it.

    With `only_decisions` rows hold the id beside these alone, and the texts are read once, for sizes and keys; with the
    texts in the result they are read a second time.

    Targets share the sum of all sizes by the sources' weights, no source above `max_epochs` times its size. A source is
    taken whole as often as its target holds it; the rest of the target is filled by whole documents in order of
    exponential keys scaled by `weight` (quality of a document, positive), to the nearest document. Sums are partially
    aggregated per source and slice of keys; only the slice with the cut is sorted, and the chosen limits, one row per
    source, go back to the rows, whose texts never move.

    Null and empty texts have size 0 and are copied as their source's epochs and key say. A null source is a source of
    its own, after all others. Rows with the same id have the same random number; rows with equal keys are taken
    together. The choice depends on ids, texts and `seed` alone, so reruns agree. An empty table gives an empty result.
    Columns of `df` named like the added ones are replaced.
    """
    kept = [F.col(id)] if only_decisions else [F.col(f"`{c}`") for c in without(df, *_ADDED).columns]
    key = exponential_key(id, quality_weight(text) if weight is None else weight, seed)
    scored = df.select(*kept, words(text).alias("size"), F.col(source).alias("_source"), key.alias("_key"))
    scored = scored.withColumn("_slice", F.floor((1 - F.exp(-F.col("_key"))) * KEY_SLICES))
    own = [F.col(id).alias("_id")] if only_decisions else []
    small = stored(scored.select(*own, "_source", "size", "_key", "_slice"), "mixing-sizes")
    if only_decisions:
        scored = small.withColumnRenamed("_id", id)
    sizes = small.groupBy("_source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
    plan = targets.withColumn("_epochs", epochs.cast("long")).withColumn(
        "_budget", F.col("target") - F.col("_epochs") * F.col("source_size"))
    plan = stored(plan.withColumnRenamed("_source", "_p"), "mixing-targets")
    cuts = _cuts(small, plan.withColumnRenamed("_p", "_source"))
    limits = stored(plan.join(cuts, F.col("_p").eqNullSafe(F.col("_s")), "left").drop("_s"), "mixing-limits")
    more = (F.col("_cut_slice").isNotNull() & (F.col("_slice") < F.col("_cut_slice"))
            | (F.col("_slice") == F.col("_cut_slice")) & (F.col("_key") <= F.coalesce("_cut_key", F.lit(-1.0))))
    copies = F.least(F.col("_epochs") + F.coalesce(more, F.lit(False)).cast("long"), F.lit(max_epochs).cast("long"))
    return (scored.join(limits, F.col("_source").eqNullSafe(F.col("_p")))
            .select(*kept, "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                    copies.alias("copies")))
