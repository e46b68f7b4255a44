"""Near duplicates by SimHash fingerprints, linked through BK-trees."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cuota.llm.common import ship, stored
from cuota.llm.components import components

SEED = 42
WORDS = 3
RADIUS = 3
# Shards with more fingerprints than this are split once more, by the bits that the shard's key leaves open.
SHARD_ROWS = 8192

_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have bit 0, 1, ... 63. Eight byte lanes are added at once, 255 hashes at a time."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[:len(hashes)] = hashes
    blocks, counts = padded.reshape(-1, 255), np.zeros((8, 8), np.int64)
    for bit in range(8):
        lanes = ((blocks >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.ravel()


def fingerprint(data: bytes) -> int:
    """SimHash of a text in UTF-8, as a signed 64-bit number."""
    words = data.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*[words[i:] for i in range(WORDS)])) if len(words) >= WORDS else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    set_bits = 2 * bit_counts(hashes) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


class LinkTree:
    """BK-tree over the fingerprints of a shard, which ties linked ones together as they come in.

    Children are keyed by their distance to the parent; everything below a child has exactly that distance to the parent.
    So a search follows only the edges within the radius of its own distance. Where it meets a linked node, what hangs
    on edges within the radius is linked with that node already and needs no visit; a dense cluster costs a few steps
    per fingerprint, not one per pair.
    """

    def __init__(self, radius: int = RADIUS):
        self.radius = radius
        self.points: list[int] = []
        self.children: list[dict[int, int]] = []
        self.owner: list[int] = []

    def _root(self, node: int) -> int:
        owner = self.owner
        while owner[node] != node:
            owner[node] = owner[owner[node]]
            node = owner[node]
        return node

    def tie(self, node: int, new: int) -> None:
        a, b = self._root(node), self._root(new)
        self.owner[max(a, b)] = min(a, b)

    def add(self, point: int) -> None:
        new, radius, stack = len(self.points), self.radius, [0]
        self.points.append(point)
        self.children.append({})
        self.owner.append(new)
        if not new:
            return
        while stack:
            node = stack.pop()
            distance = (point ^ self.points[node]).bit_count()
            low, high = distance - radius, distance + radius
            if distance <= radius:
                self.tie(node, new)
                low = radius + 1
            stack += [child for edge, child in self.children[node].items() if low <= edge <= high]
        node = 0
        while True:
            distance = (point ^ self.points[node]).bit_count()
            below = self.children[node].get(distance)
            if below is None:
                self.children[node][distance] = new
                return
            node = below

    def links(self) -> list[tuple[int, int]]:
        """A link from each point to the first of its tied points, which connects what the tree has found connected."""
        return [(p, self.points[r]) for n, p in enumerate(self.points) if (r := self._root(n)) != n]


def _blocks(rows: DataFrame, block_bits: int, offset: int) -> DataFrame:
    """A row per block of `block_bits` bits, of four, beginning at `offset` bits: `_block`, `_value`."""
    return rows.select("*", F.posexplode(F.array(*[
        F.shiftrightunsigned("_turned", offset + block_bits * i).bitwiseAND(F.lit((1 << block_bits) - 1))
        for i in range(4)])).alias("_block", "_value"))


def shards(fingerprints: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(`_shard`, `_point`): every fingerprint in the shards of its four 16-bit blocks.

    Two fingerprints with at most three differing bits agree in one of the blocks, so they meet in a shard. A shard of
    more than `shard_rows` is split the same way by four blocks of its other 48 bits.
    """
    first = _blocks(fingerprints.select("_point", F.col("_point").alias("_turned")), 16, 0)
    keyed = first.select("_point", F.struct("_block", "_value").alias("_key"))
    large = keyed.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") > shard_rows)
    marked = keyed.join(large, "_key", "left")
    small = marked.where("_n is null").select(
        F.struct(F.col("_key._block").alias("a"), F.col("_key._value").alias("b"), F.lit(-1).alias("c"),
                 F.lit(0).cast("long").alias("d")).alias("_shard"), "_point")
    # turned so that the block the shard agrees in comes to the upper end and the other 48 bits to the lower
    turned = (F.when(F.col("_key._block") == 3, F.col("_point"))
              .otherwise(F.expr("shiftleft(_point, cast(48 - 16 * _key._block as int)) "
                                "| shiftrightunsigned(_point, cast(16 * (_key._block + 1) as int))")))
    split = _blocks(marked.where("_n is not null").withColumn("_turned", turned), 12, 0).select(
        F.struct(F.col("_key._block").alias("a"), F.col("_key._value").alias("b"), F.col("_block").alias("c"),
                 F.col("_value").alias("d")).alias("_shard"), "_point")
    return small.unionAll(split)


def _link_shards(batches):
    """Links within each shard; shards arrive one after the other, so one tree is held at a time."""
    tree, current = LinkTree(), None
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(4)]))
        links = []
        for key, point in zip(keys, batch.column(4).to_pylist()):
            if key != current:
                links += tree.links()
                tree, current = LinkTree(), key
            tree.add(point & 0xFFFFFFFFFFFFFFFF)
        yield _as_links(links)
    yield _as_links(tree.links())


def _as_links(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


def fingerprints(df: DataFrame, *, text: str = "text") -> Column:
    @F.arrow_udf("bigint")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(data or b"") for data in texts.cast(pa.binary()).to_pylist()], pa.int64())

    return compute(F.col(text))


def simhash_groups(df: DataFrame, *, text: str = "text", id: str = "doc_id", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, `fingerprint`, `component_id`, `kept`) of every row of `df`.

    The fingerprint (16 hex digits) is the SimHash of the whole text's shingles of three words, repeats included; texts
    of one or two words are one shingle, texts without a word (null and empty ones too) have fingerprint zero and are
    linked like any other. Fingerprints with three or fewer differing bits are linked; `component_id` is the smallest id
    reachable through links, and its row is the one `kept`.

    Equal fingerprints are folded first, so groups of copies count once. Each shard of fingerprints that agree in a block
    gets a BK-tree in the one task that holds the shard's rows, instead of a broadcast of all trees, which would grow
    with the input; links are spanning links, never all pairs. Null ids are never the smallest; a component of null ids
    only has a null `component_id`, and its rows are kept. Rows that repeat an id share its fate. An empty table gives
    an empty result.
    """
    ship(df.sparkSession)
    own = stored(df.select(F.col(id), fingerprints(df, text=text).alias("_point")), "simhash-fingerprints")
    points = own.groupBy("_point").agg(F.min(id).alias("_first"))
    keyed = shards(points, shard_rows).select("_shard.*", "_point").repartition("a", "b", "c", "d")
    links = keyed.sortWithinPartitions("a", "b", "c", "d", "_point").mapInArrow(_link_shards, "a bigint, b bigint")
    tied = components(links)
    grouped = points.join(tied, points["_point"] == tied["node"], "left").select(
        "_point", "_first", F.coalesce("component", "_point").alias("_component"))
    least = grouped.groupBy("_component").agg(F.min("_first").alias("component_id"))
    by_point = stored(grouped.join(least, "_component").select(F.col("_point").alias("_p"), "component_id"),
                      "simhash-components")
    joined = own.join(by_point, F.col("_point") == F.col("_p"))
    return joined.select(F.col(id), F.lpad(F.lower(F.hex("_point")), 16, "0").alias("fingerprint"), "component_id",
                         F.col(id).eqNullSafe(F.col("component_id")).alias("kept"))
