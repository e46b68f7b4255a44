"""Documents packed into token sequences of one length: a cutting-stock problem, solved by column generation."""

from __future__ import annotations

import logging
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.llm.bpe import VOCABULARY, bpe_encode
from cuota.llm.common import stored
from cuota.llm.ranks import ranked, running_totals

SEQUENCE = 2048
END_ID = 1
# Lengths up to this are a bin of the histogram each; a bin of longer ones is at most 2 / EXACT of its length wide.
EXACT = 256
# Patterns that leave more than this share of a sequence empty are not used; their pieces are laid end to end instead.
WASTE = 1 / 256
# The linear program is solved when no pattern is worth more than this over a sequence: within that share of the optimum.
GAP = 1e-3
# Patterns taken over from one knapsack table, and tables at most. Stopping early costs a few more pieces laid end to end.
COLUMNS = 24
TABLES = 200
# Weight of the lengths beside the duals when patterns are priced at first.
CALM = 0.9

_LOG = logging.getLogger(__name__)


def bin_top(length: int, exact: int = EXACT) -> int:
    """The largest length in the bin of `length`."""
    width = 1
    while length > exact * width:
        width *= 2
    return -(-length // width) * width


def _bin(length: Column, most: int, exact: int) -> Column:
    """`bin_top` as an expression, for lengths up to `most`."""
    top, width, reach = length, 1, exact
    case = F.when(length <= reach, top)
    while reach < most:
        width, reach = width * 2, reach * 2
        case = case.when(length <= reach, (F.ceil(length / width) * width).cast("long"))
    return case


def knapsack(sizes: np.ndarray, values: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Per capacity up to `room` the best total value of pieces that fit, each as often as wanted, and the piece to take
    first, -1 if a smaller capacity does as well. `sizes` ascend."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for capacity in range(1, room + 1):
        k = fitting[capacity]
        best[capacity] = best[capacity - 1]
        if k:
            totals = best[capacity - sizes[:k]] + values[:k]
            first = int(totals.argmax())
            if totals[first] > best[capacity] + 1e-12:
                best[capacity], choice[capacity] = totals[first], first
    return best, choice


def _pattern(sizes: np.ndarray, choice: np.ndarray, room: int) -> np.ndarray:
    counts = np.zeros(len(sizes))
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return counts


def first_basis(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """A pattern per size and how often to use it, holding the demand exactly: each pattern takes the largest piece left,
    then the largest that still fits, and is used until one of its sizes runs out. That size is in no later pattern, so
    the columns are independent. A size that runs out along with another has a pattern of its own, used zero times."""
    left, basis, used = demand.astype(float), np.zeros((len(sizes),) * 2), np.zeros(len(sizes))
    open_sizes = list(range(len(sizes)))
    while open_sizes:
        column, space, at = np.zeros(len(sizes)), room, len(open_sizes) - 1
        while at >= 0:
            piece = open_sizes[at]
            column[piece] = space // sizes[piece]
            space -= int(column[piece] * sizes[piece])
            at = min(at, int(np.searchsorted(sizes[open_sizes], space, side="right"))) - 1
        inside = np.flatnonzero(column)
        times = left[inside] / column[inside]
        gone = int(inside[times.argmin()])
        left[inside] -= times.min() * column[inside]
        basis[:, gone], used[gone], left[gone] = column, times.min(), 0
        for piece in inside[left[inside] <= 1e-9]:
            left[piece] = 0
            if piece != gone:
                basis[piece, piece] = room // sizes[piece]
            open_sizes.remove(piece)
    return basis, used


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, *, gap: float = GAP, columns: int = COLUMNS,
          tables: int = TABLES) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (a column of piece counts each) and how often to use each so that the fewest sequences hold the demand,
    fractions allowed: the revised simplex method, whose columns a knapsack under the current duals brings in.

    The duals swing widely at first, so the knapsack prices between them and the lengths themselves as shares of a
    sequence, which are feasible duals and near the best where full patterns exist. Whether a pattern enters is decided by
    the duals; when none does, pricing moves towards them, at last onto them.
    """
    basis, used = first_basis(sizes, demand, room)
    inverse, pivots, shares, calm, least = np.linalg.inv(basis), 0, sizes / room, CALM, float(sizes @ demand) / room
    for _ in range(tables):
        duals = inverse.sum(axis=0)
        best, choice = knapsack(sizes, calm * shares + (1 - calm) * duals, room)
        if not calm:
            least = max(least, float(duals @ demand) / max(1.0, best[room]))  # the duals made feasible
        if used.sum() <= (1 + gap) * least:
            break
        worth = calm * shares + (1 - calm) * duals + best[room - sizes]  # of the best pattern with each piece in it
        entered = 0
        for first in np.argsort(-worth, kind="stable")[:columns]:
            column = _pattern(sizes, choice, room - int(sizes[first]))
            column[first] += 1
            if inverse.sum(axis=0) @ column <= 1 + 1e-6:
                continue
            change = inverse @ column
            ratios = np.where(change > 1e-7, np.maximum(used, 0) / np.where(change > 1e-7, change, 1), np.inf)
            leaving = int(np.where(ratios <= ratios.min() + 1e-9, change, 0).argmax())  # of equals the safest to divide by
            basis[:, leaving] = column
            entered, pivots = entered + 1, pivots + 1
            if pivots % 100:
                row = inverse[leaving] / change[leaving]
                inverse -= np.outer(change, row)
                inverse[leaving] = row
                used = used - change * ratios[leaving]
                used[leaving] = ratios[leaving]
            else:  # rounding errors must not pile up
                inverse = np.linalg.inv(basis)
                used = inverse @ demand
        if not entered:
            if not calm:
                break
            calm = calm / 2 if calm > 0.05 else 0.0
    _LOG.info("%d lengths, %d pivots, %.2f sequences, at least %.2f", len(sizes), pivots, used.sum(), least)
    return basis, np.maximum(used, 0)


def whole_uses(patterns: np.ndarray, used: np.ndarray, demand: np.ndarray) -> np.ndarray:
    """Uses rounded down, and then up again, largest fractions first, as long as the demand has the pieces."""
    times = np.floor(used + 1e-9).astype(np.int64)
    counts = patterns.astype(np.int64)
    left = demand - counts @ times
    for number in np.argsort(times - used, kind="stable"):
        need = counts[:, number] > 0
        more = min(int((left[need] // counts[need, number]).min()), 1 if used[number] > 1e-9 else 0)
        times[number] += more
        left = left - more * counts[:, number]
    return times


def plan_runs(histogram: dict[int, int], room: int = SEQUENCE, waste: float = WASTE) -> tuple[pa.Table, int]:
    """Which sequence the pieces of each bin go to, by rank within the bin, and the number of sequences.

    A run (`bin`, `low`, `high`, `copies`, `base`) says that the pieces of ranks `low` to `high` - 1 go to the sequences
    from `base` on, `copies` to each. Ranks in no run are left over. The table has at most one run per pattern and bin in
    it, and no more patterns than bins, whatever the number of documents.
    """
    runs, sequences = [], histogram.get(room, 0)
    if sequences:
        runs.append((room, 0, sequences, 1, 0))
    sizes = np.array(sorted(s for s, n in histogram.items() if s < room and n), np.int64)
    if len(sizes):
        demand = np.array([histogram[s] for s in sizes.tolist()], np.int64)
        patterns, used = solve(sizes, demand.astype(float), room)
        full = sizes @ patterns.astype(np.int64) >= (1 - waste) * room
        patterns, used = patterns[:, full], used[full]
        start = np.zeros(len(sizes), np.int64)
        for column, times in zip(patterns.T.astype(np.int64), whole_uses(patterns, used, demand).tolist()):
            for piece in np.flatnonzero(column).tolist() if times else ():
                copies = int(column[piece])
                runs.append((int(sizes[piece]), int(start[piece]), int(start[piece]) + times * copies, copies, sequences))
                start[piece] += times * copies
            sequences += times
    names = ["bin", "low", "high", "copies", "base"]
    return pa.table({n: pa.array([r[i] for r in runs], pa.int64()) for i, n in enumerate(names)}), sequences


def tail_starts(total: int, room: int) -> list[int]:
    """Where the sequences begin that hold what is left behind the last full one: one for each power of two in it, the
    largest first, so that none of them needs padding."""
    starts, at = [], total - total % room
    for bit in reversed(range((total % room).bit_length())):
        if total % room >> bit & 1:
            starts.append(at)
            at += 1 << bit
    return starts


def lay_end_to_end(rest: DataFrame, first: int, room: int) -> DataFrame:
    """(`_piece`, `_skip`, `_take`, `sequence_id`, `offset`): the pieces of `rest` one behind the other, cut where a
    sequence is full."""
    placed = stored(running_totals(rest, "length", ["_id", "start", "_piece"], "packing-rest"), "packing-laid")
    total = placed.agg(F.max(F.col("_before") + F.col("length"))).first()[0] or 0
    starts, end = tail_starts(total, room), F.col("_before") + F.col("length")
    marks = F.array((F.call_function("div", F.col("_before"), F.lit(room)) + 1) * room,
                    *[F.lit(s).cast("long") for s in starts])
    inner = F.filter(F.array_distinct(marks), lambda m: (m > F.col("_before")) & (m < end))
    cuts = placed.withColumn("_cuts", F.concat(F.array("_before"), F.array_sort(inner), F.array(end)))
    parts = cuts.select("_piece", "_before", "_cuts", F.posexplode(F.slice("_cuts", F.lit(1), F.size("_cuts") - 1))
                        .alias("_n", "_from"))
    begin, number = (F.call_function("div", F.col("_from"), F.lit(room)) * room,
                     F.call_function("div", F.col("_from"), F.lit(room)))
    for n, start in enumerate(starts):
        begin = F.when(F.col("_from") >= start, F.lit(start)).otherwise(begin)
        number = F.when(F.col("_from") >= start, F.lit(total // room + n)).otherwise(number)
    # the last case has to win, so the conditions were put around one another
    return parts.select("_piece", (F.col("_from") - F.col("_before")).alias("_skip"),
                        (F.element_at("_cuts", F.col("_n") + 2) - F.col("_from")).alias("_take"),
                        (number + first).cast("long").alias("sequence_id"),
                        (F.col("_from") - begin).cast("long").alias("offset"))


def pieces(df: DataFrame, *, text: str, id: str, room: int, end_id: int, path: str) -> DataFrame:
    """(`_piece`, `_id`, `start`, `length`, `doc_tokens`, `_ids`): every document's ids and the end id, cut after each
    `room` ids. Stored, as encoding is the dear step."""
    own = df.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    encoded = bpe_encode(own, text="_text", out="_ids", path=path).select(
        "_id", F.concat("_ids", F.array(F.lit(end_id))).alias("_all"))
    starts = F.transform(F.sequence(F.lit(0), F.size("_all") - 1, F.lit(room)), lambda s: F.struct(
        s.cast("long").alias("start"), F.slice(F.col("_all"), s + 1, F.lit(room)).alias("_ids")))
    cut = encoded.select("_id", F.size("_all").cast("long").alias("doc_tokens"), F.inline(starts))
    return stored(cut.select(F.monotonically_increasing_id().alias("_piece"), "_id", "start",
                             F.size("_ids").cast("long").alias("length"), "doc_tokens", "_ids"), "packing-pieces")


def pack_documents(df: DataFrame, *, text: str = "text", id: str = "doc_id", sequence_tokens: int = SEQUENCE,
                   end_id: int = END_ID, path: str = VOCABULARY, exact: int = EXACT) -> DataFrame:
    """(id, `start`, `length`, `ids`, `doc_tokens`, `sequence_id`, `offset`) per piece of a document.

    Documents longer than a sequence give full sequences and a last piece. Those pieces are a cutting-stock problem: the
    histogram of their lengths (in bins, of one length each up to `exact`, of at most 2 / `exact` of it above) is the demand of a linear program
    over patterns of lengths that fill a sequence. Its columns come from a knapsack by dynamic programming, the rounded
    patterns say how many pieces of each bin go together, and a piece's rank within its bin says which of those sequences
    it goes to. What rounding leaves over, and lengths that no pattern combines well, is laid end to end and cut where a
    sequence is full; the tokens behind the last full one make sequences of powers of two, so they need no padding.

    Only the histogram, one row per bin, reaches the driver, and only the runs of the plan, bounded by the bins, are
    broadcast. Ranks and running totals are spread over ranges, so a length that most documents have fills many tasks.
    Ids are shuffled once, to their plan. Null and empty texts are the end id alone. Each row is a document, repeated rows
    and rows with a null id too; an empty table gives an empty result. Other columns of `df` are not read.
    """
    spark, room = df.sparkSession, sequence_tokens
    cut = pieces(df, text=text, id=id, room=room, end_id=end_id, path=path)
    narrow = cut.select("_piece", "_id", "start", "length", _bin(F.col("length"), room, exact).alias("bin"))
    places = stored(ranked(narrow, "bin", ["_id", "start", "_piece"], "packing-ordered"), "packing-ranks")
    histogram = {r["bin"]: r["n"] for r in places.groupBy("bin").agg(F.count("*").alias("n")).collect()}
    table, sequences = plan_runs(histogram, room)
    runs = spark.createDataFrame(table).withColumnRenamed("bin", "_b")
    held = places.join(F.broadcast(runs), (F.col("bin") == F.col("_b")) & (F.col("_rank") >= F.col("low"))
                       & (F.col("_rank") < F.col("high")), "left")
    planned = stored(held.select("_piece", "_id", "start", "length", "bin", (F.col("base") + F.call_function(
        "div", F.col("_rank") - F.col("low"), F.col("copies"))).alias("sequence_id")), "packing-planned")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("bin"), "_id", "start", "_piece").rowsBetween(
        Window.unboundedPreceding, -1)
    fitted = planned.where("sequence_id is not null").select(
        "_piece", F.lit(0).cast("long").alias("_skip"), F.col("length").alias("_take"), "sequence_id",
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"))
    rest = planned.where("sequence_id is null").select("_piece", "_id", "start", "length")
    plan = fitted.unionByName(lay_end_to_end(rest, sequences, room))
    joined = cut.join(plan.hint("shuffle_hash"), "_piece")
    return joined.select(
        F.col("_id").alias(id), (F.col("start") + F.col("_skip")).alias("start"), F.col("_take").alias("length"),
        F.slice("_ids", (F.col("_skip") + 1).cast("int"), F.col("_take").cast("int")).alias("ids"), "doc_tokens",
        "sequence_id", "offset")


def ids_crc32(ids: str) -> Column:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    @F.arrow_udf("bigint")
    def checksum(arrays: pa.Array) -> pa.Array:
        ends, values = np.asarray(arrays.offsets), arrays.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        return pa.array([crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])], pa.int64())

    return checksum(F.col(ids))
