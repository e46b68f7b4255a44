"""Near duplicates among embeddings by NN-descent, with recall audited and links counted exactly."""

from __future__ import annotations

import itertools
import logging
import math
import warnings

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuota.llm.common import discard, release, ship, stored, without
from cuota.llm.components import components

THRESHOLD = 0.95
# Neighbours a vector's list holds at first; the list of a vector doubles when all of it is above the threshold.
LIST = 16
# First graph: random trees, each cutting the vectors into leaves of about LEAF by the sides of random planes. TREES at
# least; the deeper they are, the more of them, so that a pair at the threshold shares no leaf with a chance of at most
# MISS. (A leaf of more than PART vectors is dealt out, so pairs near a large group may still miss each other there.)
TREES = 8
LEAF = 256
MISS = 0.005
# No task compares more than this many vectors at once. Larger groups are dealt out over parts, another way each time;
# for the final counts every pair of parts is compared.
PART = 1024
ROUNDS = 4
# Tables of rounds that the next pass may still read: the last lists, those before them and what was compared for both.
HELD = 6
# Vectors compared with all others: about AUDIT from the components of 2 to SMALL vectors and AUDIT from the larger ones,
# all of which have a link; of those without a found link so many that SHOWN of them would turn up if what they miss
# brought the recall of the small groups down to the limit, but AUDIT at least and AUDIT_MOST at most.
AUDIT = 256
AUDIT_MOST = 8192
SHOWN = 3
SMALL = 64
# Below this recall, of the small groups or of the large ones, more trees are grown and refined.
RECALL = 0.99
# Links within rounding of the threshold, on which two ways to add up may differ, are added but do not lower the recall.
TIE = 1e-12

_LOG = logging.getLogger(__name__)

_ADDED = ("n_links", "component_id", "kept")
_OUT = "a bigint, b bigint, cosine double"


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(v.values, dtype=np.float64) for v in column])


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _groups(batches, keys: int):
    """(key, rows) of each group of equal first `keys` columns, which arrive one after the other. A group is bounded by
    the way rows are dealt to it, and one is held at a time."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:]):
            key = tuple(c[start] for c in columns)
            if key != current and held:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, end - start))
    if held:
        yield current, pa.Table.from_batches(held)


def _spanning(cosines: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links that connect what a group's links connect: one per row that is not the first of its component."""
    linked, seen, links = cosines >= threshold, np.zeros(len(cosines), bool), []
    for first in range(len(cosines)):
        if seen[first]:
            continue
        seen[first], front = True, [first]
        while front:
            reached = linked[front].any(axis=0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached).tolist()
            links += [(first, i) for i in front]
    return links


def _forest(total: int, threshold: float, least: int) -> tuple[int, int]:
    """Planes per tree and number of trees for `total` vectors."""
    bits = min(60, max(0, math.ceil(math.log2(total / LEAF))))
    together = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits  # chance of a pair to share a leaf
    return bits, least if together >= 1 else max(least, math.ceil(math.log(MISS) / math.log1p(-together)))


def _compare(threshold: float):
    """Per group: for each row the best others (as many as its list may hold, and closer than `worst`), and spanning
    links. The latter are rows with a null cosine. Rows of one `component` are known to be connected: nothing is given out
    between them, so a large group of near vectors costs its own rows here, not their pairs. Nor is anything between two
    rows that are not `fresh`, as those have met in this group before."""
    def run(batches):
        for _, table in _groups(batches, 2):
            table = table.combine_chunks()
            node, component = table["node"].to_numpy(), table["component"].to_numpy()
            if (component == component[0]).all():
                continue
            limit, worst = table["most"].to_numpy(), table["worst"].to_numpy()
            own = units(_matrix(table["vec"].chunk(0)))
            cosines = own @ own.T
            np.fill_diagonal(cosines, -2)
            links = np.array(_spanning(cosines, threshold), np.int64).reshape(-1, 2)
            links = links[component[links[:, 0]] != component[links[:, 1]]]
            fresh = table["fresh"].to_numpy()
            cosines[(component[:, None] == component) | ~(fresh[:, None] | fresh)] = -2
            entering = cosines > np.maximum(worst, -1.5)[:, None]
            room = int(limit.max())
            if room < len(node) - 1:  # those that are no longer among the first `room` of their row need no sorting
                entering &= cosines >= np.partition(cosines, len(node) - room, axis=1)[:, len(node) - room, None]
            a, b = np.nonzero(entering)
            order = np.lexsort((node[b], -cosines[a, b], a))
            a, b = a[order], b[order]
            rank = np.arange(len(a)) - np.searchsorted(a, a)
            best = rank < limit[a]
            a, b = a[best], b[best]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[a], node[links[:, 0]]])),
                 pa.array(np.concatenate([node[b], node[links[:, 1]]])),
                 pa.array(np.concatenate([cosines[a, b], np.zeros(len(links))]),
                          mask=np.repeat([False, True], [len(a), len(links)]))], ["a", "b", "cosine"])

    return run


def _dealt(members: DataFrame, turn: int, part: int) -> DataFrame:
    """Members of each `_group` in parts of about `part` rows; which part is a matter of a hash, another one each turn."""
    sizes = members.groupBy("_group").agg(F.count("*").alias("_n")).where(F.col("_n") > part)
    parts = F.ceil(F.col("_n") / part)
    number = F.coalesce(F.pmod(F.xxhash64(F.lit(turn), "node"), parts), F.lit(0))
    return (members.join(sizes, "_group", "left").withColumn("_part", number)
            .select("_group", "_part", "node", "component", "fresh", "most", "worst", "vec").repartition("_group", "_part")
            .sortWithinPartitions("_group", "_part", "node"))


def _leaves(placed: DataFrame, bits: int, trees: int, turn: int) -> DataFrame:
    """A row per vector and tree with the leaf as `_group`: on which side of `bits` random planes the vector lies."""
    def sides(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = batch.column("vec")
            lengths = np.diff(np.asarray(vec.offsets))
            leaves = np.zeros((batch.num_rows, trees), np.int64)
            for length in set(lengths.tolist()):
                rows = np.flatnonzero(lengths == length)
                planes = np.random.default_rng([turn, int(length)]).standard_normal((length, trees * bits))
                above = (_matrix(vec.take(pa.array(rows))) @ planes > 0).reshape(len(rows), trees, bits)
                leaves[rows] = above @ (np.int64(1) << np.arange(bits, dtype=np.int64)) if bits else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(leaves), pa.list_(pa.int64()))],
                                             [*batch.schema.names, "_leaves"])

    kind = placed.schema["vec"].dataType.simpleString()
    coded = placed.select("node", "component", "vec").mapInArrow(
        sides, f"node bigint, component bigint, vec {kind}, _leaves array<bigint>")
    apart = coded.select("node", "component", "vec", F.posexplode("_leaves").alias("_tree", "_leaf"))
    return apart.select(F.xxhash64("_tree", "_leaf", F.size("vec")).alias("_group"), "node", "component",
                        F.lit(True).alias("fresh"), F.lit(LIST).alias("most"), F.lit(-2.0).alias("worst"), "vec")


def _lists(found: DataFrame, threshold: float, former: DataFrame | None) -> DataFrame:
    """(`node`, `most`, `worst`, `near`, `fresh`): each vector's best neighbours, however far they are, twice the room for
    those whose list is full of links, the cosine that a new neighbour must exceed, and the ids that the `former` lists
    did not hold."""
    room = F.lit(LIST) if former is None else F.coalesce("_room", F.lit(LIST))
    known = F.array().cast("array<bigint>") if former is None else F.coalesce("_known", F.array().cast("array<bigint>"))
    # One row per pair: the same cosine, added up in another group, may differ in its last bits.
    pairs = found.where("cosine is not null").groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    lists = pairs.groupBy(F.col("a").alias("node")).agg(
        F.collect_list(F.struct((-F.col("cosine")).alias("far"), F.col("b").alias("id"))).alias("_all"))
    if former is not None:
        lists = lists.join(former.select("node", F.col("most").alias("_room"), F.col("near.id").alias("_known")), "node", "left")
    cut = lists.select("node", room.alias("most"), F.slice(F.array_sort("_all"), F.lit(1), room).alias("near"),
                       known.alias("_known"))
    saturated = (F.size("near") >= F.col("most")) & (F.element_at("near", -1)["far"] <= -threshold)
    worst = F.when(~saturated & (F.size("near") >= F.col("most")), -F.element_at("near", -1)["far"]).otherwise(F.lit(-2.0))
    return cut.select("node", F.when(saturated, 2 * F.col("most")).otherwise(F.col("most")).alias("most"),
                      worst.alias("worst"), "near", F.array_except("near.id", "_known").alias("fresh"))


def _refine(lists: DataFrame, placed: DataFrame, turn: int, threshold: float) -> DataFrame:
    """Neighbours of neighbours: around each vector, those on its list and those that list it are compared.

    Pairs of which neither came to the list in the last round have been compared already. Where that is so of all of a
    group, or all are in one component, nothing is left to find, and no vector is moved.
    """
    pairs = lists.select("node", F.col("fresh").alias("_fresh"), F.explode("near.id").alias("_other")).select(
        "node", "_other", F.array_contains("_fresh", F.col("_other")).alias("fresh"))
    around = (pairs.select(F.col("node").alias("_group"), F.col("_other").alias("node"), "fresh")
              .unionAll(pairs.select(F.col("_other").alias("_group"), "node", "fresh"))
              .unionAll(lists.select(F.col("node").alias("_group"), "node", F.lit(False)))
              .groupBy("_group", "node").agg(F.max("fresh").alias("fresh")))
    known = around.join(placed.select("node", "component"), "node")
    open_groups = known.groupBy("_group").agg(F.min("component").alias("_low"), F.max("component").alias("_high"),
                                              F.max("fresh").alias("_any")).where("_low < _high and _any").select("_group")
    members = (known.join(open_groups, "_group").join(lists.select("node", "most", "worst"), "node", "left")
               .join(placed.select("node", "vec"), "node")
               .withColumn("most", F.coalesce("most", F.lit(LIST))).withColumn("worst", F.coalesce("worst", F.lit(-2.0))))
    return _dealt(members, turn, PART).mapInArrow(_compare(threshold), _OUT)


def _samples(numbers: list[int], audit: int, recall: float) -> list[int]:
    """How many vectors to audit of those alone, in small and in large components, from how many there are of each."""
    alone, small, large = numbers
    # as many missed vectors as would bring the small groups below the recall, if all the missed ones were alone
    tolerable = max(1.0, (1 - recall) * small)
    return [min(alone, AUDIT_MOST, max(audit, math.ceil(SHOWN * alone / tolerable))), min(small, audit), min(large, audit)]


def _recall(numbers: list[int], sampled: list[list[tuple[int, int]]]) -> float:
    """The lower of the recalls of small and of large components, each the average over vectors that have a link.

    `sampled` has (links, missed) of the sampled vectors, alone, in small and in large components. A vector alone that
    has a link misses all of them; such vectors count as small groups, as often as the sample stands for.
    """
    means = [sum(1 - missed / links for links, missed in rows if links) / max(1, sum(links > 0 for links, _ in rows))
             for rows in sampled]
    lost = numbers[0] * sum(links > 0 for links, _ in sampled[0]) / max(1, len(sampled[0]))
    held = numbers[1] if sampled[1] else 0
    small = means[1] * held / (held + lost) if held + lost else 1.0
    return min(small, means[2] if sampled[2] else 1.0)


def _by_length(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes, components and unit vectors of the rows, by the vectors' length."""
    if not rows.num_rows:
        return {}
    lengths = pc.list_value_length(rows["vec"]).to_numpy()
    kinds = {length: rows.take(np.flatnonzero(lengths == length)).combine_chunks() for length in np.unique(lengths).tolist()}
    return {length: (own["node"].to_numpy(), own["component"].to_numpy(), units(_matrix(own["vec"].chunk(0))))
            for length, own in kinds.items()}


def _audit(placed: DataFrame, threshold: float, audit: int, recall: float, turn: int) -> tuple[float, DataFrame]:
    """Recall of the vectors that have a link, from a sample compared with all others, and the links that were missed.

    `placed` has each vector's component. Vectors alone, in small and in large components are sampled apart, so that a
    large group, whose vectors have many links, says nothing of the small ones. The samples are bounded; all rows are
    compared with them in blocks. What leaves a task is two counts per sampled vector and, of the missed links, one for
    each sampled vector and foreign component of a block, which connects the same.
    """
    sizes = placed.groupBy("component").agg(F.count("*").alias("_n"))
    kind = F.when(F.col("_n") == 1, 0).when(F.col("_n") <= SMALL, 1).otherwise(2)
    known_sizes = sizes.withColumn("_kind", kind)
    per_kind = {r["_kind"]: int(r["n"]) for r in known_sizes.groupBy("_kind").agg(F.sum("_n").alias("n")).collect()}
    numbers = [per_kind.get(k, 0) for k in range(3)]
    wanted = _samples(numbers, audit, recall)
    share = F.element_at(F.array(*[F.lit(int((1 << 30) * w / max(1, n))) for w, n in zip(wanted, numbers)]),
                         F.col("_kind") + 1)
    chance = F.pmod(F.xxhash64(F.lit(1000 + turn), "node"), F.lit(1 << 30)) < share
    chosen = placed.join(known_sizes.select("component", "_kind"), "component").where(chance)
    # as Arrow and in arrays: rows of Python numbers would take several times the memory of the driver, in the JVM as well
    rows = chosen.limit(2 * sum(wanted) + 1000).select("node", "component", "vec", "_kind").toArrow().combine_chunks()
    sampled_nodes, kinds = rows["node"].to_pylist(), rows["_kind"].to_pylist()
    sample = placed.sparkSession.sparkContext.broadcast(_by_length(rows))
    del rows
    names = ["a", "b", "links", "missed"]

    def compare(batches):
        known = sample.value
        links = {length: np.zeros((2, len(nodes)), np.int64) for length, (nodes, _, _) in known.items()}
        for batch in batches:
            lengths = np.diff(np.asarray(batch.column("vec").offsets))
            for length, (nodes, places, own) in known.items():
                mine = batch.take(pa.array(np.flatnonzero(lengths == length)))
                step = max(1, (1 << 22) // len(nodes))
                for start in range(0, mine.num_rows, step):
                    block = mine.slice(start, step)
                    cosines = units(_matrix(block.column("vec"))) @ own.T
                    node, place = block.column("node").to_numpy(), block.column("component").to_numpy()
                    cosines[node[:, None] == nodes] = -2
                    apart = place[:, None] != places
                    clear, lost = cosines >= threshold + TIE, apart & (cosines >= threshold)
                    links[length] += np.stack([clear.sum(axis=0), (apart & clear).sum(axis=0)])
                    a, b = np.nonzero(lost)
                    _, first = np.unique(np.stack([place[a], b]), axis=1, return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[a[first]]), pa.array(nodes[b[first]]), pa.nulls(len(first), pa.int64()),
                         pa.nulls(len(first), pa.int64())], names)
        for length, (nodes, _, _) in known.items():
            some = np.flatnonzero(links[length][0])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.array(nodes[some]),
                                              *[pa.array(n[some]) for n in links[length]]], names)

    result = stored(placed.select("node", "component", "vec").mapInArrow(
        compare, "a bigint, b bigint, links bigint, missed bigint"), "neighbours-audit")
    counted = result.where("a is null").groupBy("b").agg(F.sum("links").alias("links"), F.sum("missed").alias("missed"))
    found = {r["b"]: (r["links"], r["missed"]) for r in counted.collect()}
    sampled = [[found.get(n, (0, 0)) for n, own in zip(sampled_nodes, kinds) if own == k] for k in range(3)]
    sample.destroy()  # its result is stored
    release()
    reached = _recall(numbers, sampled)
    _LOG.info("recall %.5f, vectors alone, in small, in large components: %s, sampled %s", reached, numbers,
              [len(s) for s in sampled])
    return reached, result.where("a is not null").select("a", "b")


def _connecting(compared: DataFrame) -> DataFrame:
    return compared.where("cosine is null").select("a", "b")


def _placed(vectors: DataFrame, links: DataFrame) -> DataFrame:
    """`vectors` with the `component` of each, its own `node` if it has no link."""
    tied = components(links)
    placed = stored(vectors.join(tied, "node", "left")
                    .withColumn("component", F.coalesce("component", "node")), "neighbours-placed")
    discard(tied)
    return placed


def _counts(placed: DataFrame, threshold: float) -> DataFrame:
    """(`node`, `n`): how many rows a vector is linked with in its component, itself left out.

    A component of more than `PART` vectors is dealt out over parts, and every two of its parts meet in a group.
    """
    sizes = placed.groupBy("component").agg(F.count("*").alias("_n")).where("_n > 1")
    many = F.ceil(F.col("_n") / PART).cast("int")
    members = placed.join(sizes, "component").withColumn("_many", many).withColumn(
        "_own", F.pmod(F.xxhash64(F.lit(0), "node"), F.col("_many")).cast("int"))
    met = members.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_many") - 1))).select(
        "component", (F.least("_own", "_with") * F.col("_many") + F.greatest("_own", "_with")).alias("_pair"),
        (F.col("_own") <= F.col("_with")).alias("_left"), (F.col("_own") == F.col("_with")).alias("_same"),
        "node", "size", "vec")

    def count(batches):
        for _, table in _groups(batches, 2):
            table = table.combine_chunks()
            own, weights = units(_matrix(table["vec"].chunk(0))), table["size"].to_numpy()
            if table["_same"][0].as_py():
                numbers = (own @ own.T >= threshold) @ weights
            else:
                left = table["_left"].to_numpy()
                linked = own[left] @ own[~left].T >= threshold
                numbers = np.zeros(len(own), np.int64)
                numbers[left], numbers[~left] = linked @ weights[~left], weights[left] @ linked
            # a vector is compared with itself where its own part meets itself; rounding must not decide that one
            if table["_same"][0].as_py():
                numbers = numbers - np.where((own * own).sum(axis=1) >= threshold, weights, 0)
            yield pa.RecordBatch.from_arrays([table["node"].chunk(0), pa.array(numbers.astype(np.int64))], ["node", "n"])

    grouped = met.repartition("component", "_pair").sortWithinPartitions("component", "_pair", "node")
    return grouped.mapInArrow(count, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))


def near_vectors(df: DataFrame, *, id: str = "vec_id", vec: str = "embedding", threshold: float = THRESHOLD,
                 trees: int = TREES, recall: float = RECALL, passes: int | None = None) -> DataFrame:
    """Every row of `df` with `n_links`, `component_id` and `kept`: vectors of cosine `threshold` or more are linked.

    Equal vectors are folded. A forest of random trees, `trees` at least and more for more vectors, gives the first
    neighbour lists, which hold the nearest however far they are; rounds of NN-descent compare the
    neighbours of neighbours until the lists stand still, lists full of links getting twice the room. What a group finds
    linked is also kept as spanning links, so lists need not hold a large group of copies. The components of these links
    are audited: bounded samples of the vectors alone, in small and in large components against all. What was missed is
    added. Below `recall`, the average over vectors that have a link, of small or of large groups, more trees are grown,
    other ones each time and more the longer it takes, until it is reached. Only a caller that sets `passes` can end that
    early; a `RuntimeWarning` then tells that the recall is below. Links are then counted exactly, in
    double precision, among all pairs of each component; a pair below the threshold never counts.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do vectors of
    different lengths with each other, nor rows with a null id (their `component_id` is null; they are kept). Rows that
    repeat an id are vectors each. No vectors give an empty result. Columns of `df` named like the added ones are
    replaced.
    """
    spark = df.sparkSession
    ship(spark)
    rest = without(df, *_ADDED)
    kept = [F.col(f"`{c}`") for c in rest.columns]
    good = (F.size(vec) > 0) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.coalesce(good & F.exists(vec, lambda x: x != 0) & F.col(id).isNotNull(), F.lit(False))
    exact = F.transform(F.col(vec), lambda x: x + 0.0).cast(rest.schema[vec].dataType)  # no negative zeros
    valid = rest.where(good).select(F.col(id).alias("_id"), exact.alias("vec"))
    folded = valid.groupBy("vec").agg(F.min("_id").alias("first"), F.count("*").alias("size"))
    vectors = stored(folded.withColumn("node", F.monotonically_increasing_id()), "neighbours-vectors")
    total = vectors.count()

    links = spark.createDataFrame([], "a bigint, b bigint")
    found, former, placed, rounds = None, None, vectors.withColumn("component", F.col("node")), []
    for number in itertools.count() if passes is None else range(passes):
        if not total:
            break
        bits, grown_trees = _forest(total, threshold, trees)
        grown = _dealt(_leaves(placed, bits, (number + 1) * grown_trees, number), number, PART)
        new = stored(grown.mapInArrow(_compare(threshold), _OUT), "neighbours-trees")
        rounds.append(new)
        found = new if found is None else found.unionAll(new)
        links = stored(links.unionAll(_connecting(new)).distinct(), "neighbours-links")
        placed, before = _placed(vectors, links), None
        for turn in range(ROUNDS):
            lists = stored(_lists(found, threshold, former), "neighbours-lists")
            rounds.append(lists)
            former = lists
            state = lists.agg(F.sum(F.size("near")), F.sum("most"),
                              F.sum(F.xxhash64("node", "near.id").cast("decimal(38,0)"))).first()
            if state == before or not state[0]:
                break
            before = state
            more = stored(_refine(lists, placed, 100 * number + turn, threshold), "neighbours-refined")
            rounds.append(more)
            links = links.unionAll(_connecting(more))
            held = lists.select(F.col("node").alias("a"), F.explode("near").alias("_n"))
            found = held.select("a", F.col("_n.id").alias("b"), (-F.col("_n.far")).alias("cosine")).unionAll(more)
        links = stored(links.distinct(), "neighbours-links")
        found = found.where("cosine is not null")
        for superseded in rounds[:-HELD]:
            discard(superseded)
        rounds = rounds[-HELD:]
        placed = _placed(vectors, links)
        reached, missed = _audit(placed, threshold, AUDIT, recall, number)
        if not missed.isEmpty():
            links = links.unionAll(missed)
            placed = _placed(vectors, links)
        if reached >= recall:
            break
    else:
        if passes:
            warnings.warn(f"near_vectors: recall {reached:.4f} after {passes} passes, {recall} is asked for",
                          RuntimeWarning, stacklevel=2)
    if not total or passes == 0:
        return rest.select(*kept, F.lit(0).cast("long").alias("n_links"), F.col(id).alias("component_id"),
                           F.lit(True).alias("kept"))
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    numbers = (placed.join(least, "component").join(_counts(placed, threshold), "node", "left")
               .select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")))
    by_vector = stored(placed.select("node", F.col("vec").alias("_vec")).join(numbers, "node").drop("node"),
                       "neighbours-numbers")
    named = rest.withColumn("_key", F.when(good, exact))
    joined = named.join(by_vector, F.col("_key") == F.col("_vec"), "left")
    component = F.when(good, F.col("component_id")).otherwise(F.col(id))
    return joined.select(*kept, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                         component.alias("component_id"), F.col(id).eqNullSafe(component).alias("kept"))
