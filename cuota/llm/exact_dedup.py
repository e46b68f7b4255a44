"""Exact duplicates by two passes over a Bloom filter, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuota.llm.common import SPACES, stored, text_or_empty, without

# Bits of each of the filter's two slices per row, at least. A row that repeats no other is a suspect where both of its
# positions are taken: with a chance of at most (1 - exp(-1 / LOAD)) ** 2, 0.4 %, whatever the number of rows.
LOAD = 16
LEAST_BITS = 1 << 16
# A filter of up to this many bits a slice (2^20 rows of 64 bits) is broadcast. A larger one is joined on its words.
BROADCAST_BITS = 1 << 26

_WORD_BITS = 64
_ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def normalised_sha256(text: str) -> Column:
    """Lowercase hex SHA-256 of the text with every run of ASCII white space made one space; null counts as empty."""
    return F.sha2(F.regexp_replace(text_or_empty(text), f"[{SPACES}]+", " "), 256)


def filter_bits(rows: int) -> int:
    return max(LEAST_BITS, 1 << math.ceil(math.log2(max(1, LOAD * rows))))


def _bit(slice_no: int, bits: int, of: Column | str = "text_sha256") -> Column:
    """Position of a row in one slice of the filter."""
    return F.pmod(F.xxhash64(F.lit(slice_no), of), F.lit(bits).cast("long"))


def _word(position: Column) -> Column:
    return F.call_function("div", position, F.lit(_WORD_BITS))


def repeat_filter(prints: DataFrame, slice_no: int, bits: int) -> DataFrame:
    """First pass: one row `(_word, _bits)` for each 64 positions of which some were set by more than one row.

    Counts are partially aggregated, so a hash that a third of all rows share is a row per task.
    """
    position = prints.select(_bit(slice_no, bits).alias("_position")).groupBy("_position").agg(F.count("*").alias("_n"))
    repeated = position.where("_n > 1")
    return _words(repeated, slice_no)


def _words(positions: DataFrame, slice_no: int | str, *keys: str) -> DataFrame:
    mask = F.expr(f"shiftleft(1L, cast(_position % {_WORD_BITS} as int))")
    return positions.groupBy(*keys, _word(F.col("_position")).alias(f"_word{slice_no}")).agg(
        F.bit_or(mask).alias(f"_bits{slice_no}"))


def suspects(df: DataFrame, key: Column, wanted: DataFrame, of: str,
             rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows of `df` whose `key` may be among the column `of` of the table `wanted` (of so many `rows`), and the others.

    A row that is not wanted is a suspect with a chance of 0.4 %; no wanted one is missing. The filter is broadcast, so
    that no row moves. Where it would have more than BROADCAST_BITS a slice all rows are suspects, and there are no others.
    """
    bits = filter_bits(wanted.count() if rows is None else rows)
    if bits > BROADCAST_BITS:
        return df, None
    positions = wanted.select(F.posexplode(F.array(*[_bit(n, bits, of) for n in range(2)])).alias("_slice", "_position"))
    words = stored(_words(positions, "", "_slice"), "wanted-filter")
    filters = [words.where(F.col("_slice") == n).select(*[F.col(c).alias(f"{c}{n}") for c in ("_word", "_bits")])
               for n in range(2)]
    flagged = flag_repeats(df, filters, bits, key)
    return flagged.where("_suspect").drop("_suspect"), flagged.where("not _suspect").drop("_suspect")


def flag_repeats(prints: DataFrame, filters: list[DataFrame], bits: int, of: Column | str = "text_sha256") -> DataFrame:
    """Second pass: adds `_suspect`, true where every slice has the row's bit set. Where the filter is broadcast no row
    moves; beyond that ids and hashes are sent to the words of the filter, never texts."""
    suspect, rows = F.lit(True), prints
    for number, words in enumerate(filters):
        position = _bit(number, bits, of)
        words = F.broadcast(words) if bits <= BROADCAST_BITS else words
        rows = (rows.withColumn(f"_at{number}", F.pmod(position, F.lit(_WORD_BITS)).cast("int"))
                .withColumn(f"_word{number}", _word(position)).join(words, f"_word{number}", "left"))
        set_bit = F.expr(f"(shiftrightunsigned(coalesce(_bits{number}, 0L), _at{number}) & 1L) = 1L")
        suspect = suspect & set_bit
    extra = [f"{p}{n}" for n in range(len(filters)) for p in ("_at", "_word", "_bits")]
    return rows.withColumn("_suspect", suspect).drop(*extra)


def _flagged(df: DataFrame, text: str, id: str, bits: int | None) -> tuple[DataFrame, DataFrame]:
    """Ids and hashes of all rows with `_suspect`, and the groups of more than one among the suspects."""
    prints = stored(df.select(F.col(id), normalised_sha256(text).alias("text_sha256")), "exact-dedup-prints")
    bits = bits or filter_bits(prints.count())
    filters = [stored(repeat_filter(prints, n, bits), "exact-dedup-filter") for n in range(2)]
    flagged = flag_repeats(prints, filters, bits)
    groups = stored(flagged.where("_suspect").groupBy("text_sha256")
                    .agg(F.min(id).alias("keep_id"), F.count("*").alias("group_size"))
                    .where("group_size > 1"), "exact-dedup-groups")
    return flagged, groups


def _decided(rows: DataFrame, groups: DataFrame, id: str) -> DataFrame:
    own = F.col("group_size").isNull()
    return (rows.join(groups, "text_sha256", "left").withColumn("keep_id", F.when(own, F.col(id)).otherwise(F.col("keep_id")))
            .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long"))))


def exact_dedup(df: DataFrame, *, text: str = "text", id: str = "doc_id", only_decisions: bool = False,
                bits: int | None = None) -> DataFrame:
    """Every row of `df` with `keep_id`, `group_size`, `kept` and `text_sha256` of its group of equal texts.

    Texts are read once for their hashes. The first pass counts filter positions, the second finds the rows whose
    positions all repeat. Only those rows (true repeats and a few false alarms, `bits` being sized by the number of rows)
    are grouped and joined with their group; the rest pass straight through as groups of one. The join's hot keys are
    split by AQE; each group is one row there. With `only_decisions` the result has just the id and the added columns and
    no text moves. Without, the whole rows join the groups of more than one.

    The row with the smallest `id` of a group stays. Null text is the empty text. Rows with equal text and equal id are
    the same document and share one decision. A null id never wins over another id; if all ids of a group are null,
    `keep_id` is null and all are kept. An empty table gives an empty result. Columns of `df` named like the added
    ones are replaced.
    """
    rest = without(df, *_ADDED)
    flagged, groups = _flagged(rest, text, id, bits)
    if only_decisions:
        alone = (flagged.where("not _suspect").withColumn("keep_id", F.col(id))
                 .withColumn("group_size", F.lit(1).cast("long")))
        both = alone.unionByName(_decided(flagged.where("_suspect"), groups, id))
    else:
        both = _decided(rest.withColumn("text_sha256", normalised_sha256(text)), groups, id)
    kept = F.col(id).eqNullSafe(F.col("keep_id"))
    first = [F.col(id)] if only_decisions else [F.col(f"`{c}`") for c in rest.columns]
    return both.select(*first, "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def exact_distinct(df: DataFrame, *, text: str = "text", id: str = "doc_id", bits: int | None = None) -> DataFrame:
    """`df` with one row of each group of equal texts, all columns as they are: the one with the smallest id.

    Decisions are made on ids and hashes; the rows themselves only leave out those that go. Of rows that are equal in
    text and id (or have a null id each) one stays too, any of them; only such rows are grouped, as rows. Null text is the
    empty text; an empty table gives an empty result.
    """
    flagged, groups = _flagged(df, text, id, bits)
    decided = stored(_decided(flagged.where("_suspect"), groups, id).select(
        F.col(id).alias("_of"), F.col("text_sha256").alias("_sha"), F.col(id).eqNullSafe(F.col("keep_id")).alias("_kept")),
        "exact-dedup-decided")
    gone = decided.where("not _kept").select("_of", "_sha").distinct()
    again = stored(decided.where("_kept").groupBy("_of", "_sha").agg(F.count("*").alias("_n")).where("_n > 1"),
                   "exact-dedup-again").drop("_n")
    same = F.col(f"`{id}`").eqNullSafe(F.col("_of")) & (F.col("_text_sha") == F.col("_sha"))
    hashed = df.withColumn("_text_sha", normalised_sha256(text)).join(gone, same, "left_anti")
    if again.isEmpty():
        return hashed.drop("_text_sha")
    single = hashed.join(again, same, "left_anti")
    repeated = hashed.join(again, same, "left_semi").dropDuplicates([id, "_text_sha"])
    return single.unionByName(repeated).drop("_text_sha")
