"""Forward fill that does not put a whole group into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one group that are filled together. Groups longer than this are split and joined up by a carried value.
CHUNK_ROWS = 65_536
# Chunks that hand their value on in one window. With the rows of a chunk, this covers 40 of the 64 bits of an order.
SECTION_CHUNKS = 1 << 24


def chunk_of(row_no: Column, chunk_rows: int = CHUNK_ROWS) -> Column:
    """Number of the slice of `chunk_rows` consecutive row numbers a row falls into."""
    return F.call_function("div", row_no.cast("long"), F.lit(chunk_rows))


def fill_within_chunks(df: DataFrame, keys: list[str], order: str, value: str, carry: str) -> Column:
    """Last non-null `value` so far in the chunk, else the value carried into it."""
    so_far = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.coalesce(F.last(df[value], ignorenulls=True).over(so_far), df[carry])


def carried(keys: list[str], value: str) -> Column:
    """Last non-null chunk `value` of the chunks before this one, over one row per chunk."""
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return F.last(value, ignorenulls=True).over(before)


def join_chunks(rows: DataFrame, per_chunk: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the one row of their chunk.

    Keys match null-safely, so no row is lost. The hash join shuffles by chunk, as the window that follows needs, and leaves the sorting of the rows to it. Its
    build side is a row per chunk.
    """
    own = per_chunk.select(*[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in per_chunk.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return rows.join(own.hint("shuffle_hash"), same).drop(*[f"_of_{k}" for k in keys])


def _carried_in_two_levels(ends: DataFrame, keys: list[str], section_chunks: int) -> DataFrame:
    """`ends` with `_carry`, the last non-null `_last` of the chunks before, without a window over all chunks of a group.

    Chunks are cut into sections as rows are into chunks. A section hands its last value on to the next ones; inside it
    chunks do.
    """
    section = [*keys, "_section"]
    cut = ends.withColumn("_section", chunk_of(F.col("_chunk"), section_chunks))
    last = cut.groupBy(*section).agg(F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("_chunk"))).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_section").rowsBetween(Window.unboundedPreceding, -1)
    starts = last.select(*section, F.last("_sum", ignorenulls=True).over(before).alias("_start"))
    joined = join_chunks(cut, starts, section)
    return joined.select(*keys, "_chunk", F.coalesce(carried(section, "_last"), F.col("_start")).alias("_carry"))


def forward_fill(df: DataFrame, keys: list[str], order: str, value: str, *, out: str | None = None,
                 chunk_rows: int = CHUNK_ROWS, section_chunks: int = SECTION_CHUNKS) -> DataFrame:
    """Replace null `value`s by the last non-null one before them, by `order` within the `keys`.

    Every row comes back. Null keys are groups like any other; a row whose `order` is null has no place in its group, so
    its value neither changes nor goes on to another row.

    A group of any length is split into chunks of consecutive row numbers. Each chunk's last value is found by a
    partially aggregated group-by, handed on in two levels over that table, and joined back on the chunk, whose
    partitioning the final window shares. The order may have gaps of any width: where every row is a chunk of its own,
    the sections above the chunks still split the group. Rows without an order are spread by their content.
    """
    spread = F.xxhash64(*[F.col(name) for name, kind in df.dtypes if "map<" not in kind and kind != "variant"])
    chunked = df.withColumn("_chunk", F.coalesce(chunk_of(F.col(order), chunk_rows), spread))
    ends = chunked.groupBy(*keys, "_chunk").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
                                                .alias("_last"))
    joined = join_chunks(chunked, _carried_in_two_levels(ends, keys, section_chunks), [*keys, "_chunk"])
    # Nulls come first in the window; without their values they pass nothing on.
    placed = joined.withColumn("_placed", F.when(F.col(order).isNotNull(), F.col(value)))
    filled = placed.withColumn("_filled", F.when(F.col(order).isNull(), F.col(value)).otherwise(
        fill_within_chunks(placed, keys, order, "_placed", "_carry")))
    kept = [F.col("_filled").alias(name) if name == (out or value) else F.col(name) for name in df.columns]
    if out and out not in df.columns:
        kept.append(F.col("_filled").alias(out))
    return filled.select(*kept)
