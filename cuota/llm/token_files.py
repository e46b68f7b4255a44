"""Token-id files: frequency-ranked ids in bytes, with control bytes that say how many bytes each id has."""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cuota.llm.common import ship, stored

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
# Distinct words whose ids a worker remembers; the memory is emptied when it is full. Results do not depend on it.
MEMORY_WORDS = 1_200_000

_MARKS = frozenset(b".,;:!?")
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
# Plain letters and the ASCII marks behind them, but for those of contractions and special tokens.
_MARKED = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:;=?@\[-`{}~]+)").fullmatch
# The characters that stand for bytes in such files: printable Latin-1 for itself, the rest from 256 on in byte order.
_PRINTED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
_CHARACTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}

# A control byte holds the widths of four ids, two bits each, lowest first: width - 1.
_WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers: each in as few bytes as it needs, lowest byte first."""
    largest = ranks.max(initial=0)
    most = 4 if largest > 0xFFFF else 2
    kept = np.empty((len(ranks), most), bool)  # of each number's bytes
    kept[:, 0] = True
    for place in range(1, most):
        np.greater_equal(ranks, 1 << 8 * place, out=kept[:, place])
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = kept[:, 1] if most == 2 else kept.sum(axis=1) - 1
    four = padded.view("<u4")
    control = (four | four >> 6 | four >> 12 | four >> 18).astype(np.uint8)
    return control.tobytes(), ranks.astype(f"<u{most}").view(np.uint8)[kept.ravel()].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers again: the widths are looked up by control byte, the bytes put at the places these leave for them."""
    widths = _WIDTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    most = 4 if widths.max(initial=1) > 2 else 2
    kept = np.empty((count, most), bool)
    kept[:, 0] = True
    for place in range(1, most):
        np.greater(widths, place, out=kept[:, place])
    numbers = np.zeros(count * most, np.uint8)
    numbers[kept.ravel()] = np.frombuffer(data, np.uint8)
    return numbers.view(f"<u{most}").astype(np.uint32)


class WordIds(dict):
    """Ids of words as little-endian bytes, found on first sight. White space only separates words for this kind of
    tokenizer, so a text's ids are those of its words. Marks behind a letter at the end of a word are a piece of their own
    there, so such a word is put together from its parts. Plain lower-case words go straight to the library's merge
    model: nothing normalises or splits them, and each byte has its own character there, an ASCII letter itself."""

    def __init__(self, path: str, limit: int):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
        self.limit = limit
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.kind = id_kind(self.tokenizer)
        code = np.dtype(self.kind).char
        self.packers = lru_cache(maxsize=64)(lambda count: struct.Struct(f"<{count}{code}").pack)

    def __missing__(self, word: bytes) -> bytes:
        if word[-1] in _MARKS and word[-2:-1].isalpha():
            found = self[word[:-1]] + self[word[-1:]]
        else:
            found = self._found(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = found
        return found

    def _found(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha() and word.islower():
            ids = [t.id for t in self.model.tokenize(text)]
        elif _PLAIN(text):
            ids = [t.id for t in self.model.tokenize(word.decode("latin-1").translate(_CHARACTERS))]
        elif parts := _MARKED(text):
            return self[parts[1].encode()] + self[parts[2].encode()]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.packers(len(ids))(*ids)

    def ids_of(self, text: bytes) -> bytes:
        # The tokenizer lower-cases too, but not before it has looked for its special tokens.
        words = (text if b"<|" in text else text.lower()).split()
        return b"".join(map(self.__getitem__, words))


def id_kind(tokenizer: Tokenizer) -> str:
    """Two bytes hold an id of a small vocabulary on its way to the files."""
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


@lru_cache(maxsize=2)
def word_ids(path: str, limit: int = MEMORY_WORDS) -> WordIds:
    return WordIds(path, limit)


def tokenise(df: DataFrame, *, text: str, id: str, path: str, end_id: int | None) -> DataFrame:
    """(id, `tokens`): the ids of each whole text as bytes of the vocabulary's `id_kind`, `end_id` after them."""
    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        ids = word_ids(path)
        end = b"" if end_id is None else np.array([end_id], ids.kind).tobytes()
        return pa.array([ids.ids_of(data or b"") + end for data in texts.cast(pa.binary()).to_pylist()],
                        pa.binary())

    return df.select(F.col(id), encode(F.col(text)).alias("tokens"))


def frequency_order(tokens: DataFrame, kind: str) -> np.ndarray:
    """All ids that occur, the most frequent first, ties by id. Counted per task first; one row per id of the vocabulary
    reaches the driver, so its size is bounded by the vocabulary."""
    def counts(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = b"".join(batch.column(0).to_pylist())
            own = np.bincount(np.frombuffer(ids, kind), minlength=len(total))
            own[:len(total)] += total
            total = own
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found])], ["token", "n"])

    per_id = tokens.select("tokens").mapInArrow(counts, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = per_id.toArrow()
    token, n = rows["token"].to_numpy(), rows["n"].to_numpy()
    return token[np.lexsort((token, -n))].astype(np.int64)


def write_token_files(df: DataFrame, path: str, *, text: str = "text", id: str = "doc_id", vocabulary: str = VOCABULARY,
                      end_id: int | None = END_ID, files: int | None = None) -> None:
    """Encode every whole text and write the folder `path`.

    `shards`: documents in ascending order of id over the shards in order and within each, a row per document with its
    place (`shard`, `at`: ids of the documents before it in the shard), `n_tokens`, and its ids as `control` and `data`
    bytes. An id is written as its rank by frequency over the whole input, so common ids take one byte. `ranks`: the ids
    in that order. `starts`: one row per shard with the ids of all shards before it.

    Texts are tokenised once; the ids are range-partitioned by id, so the longest sort is a shard. Null and empty texts
    have only the end id. Null ids come first; rows with equal ids stand in the order of their tokens. An empty table
    gives empty files. Ids are kept, other columns are not.
    """
    spark = df.sparkSession
    ship(spark)
    tokens = stored(tokenise(df, text=text, id=id, path=vocabulary, end_id=end_id), "token-ids", compression="zstd")
    ids_as = id_kind(Tokenizer.from_file(vocabulary))
    order = frequency_order(tokens, ids_as)
    ranks_of = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    ranks_of[order] = np.arange(len(order), dtype=np.uint32)
    sent = spark.sparkContext.broadcast(ranks_of)

    def encode(batches):
        at = 0
        for batch in batches:
            packed, places, sizes = [], [], []
            for data in batch.column("tokens").to_pylist():
                ids = np.frombuffer(data, ids_as)
                packed.append(pack(sent.value[ids]))
                places.append(at)
                sizes.append(len(ids))
                at += len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), batch.column("shard"), pa.array(places, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array([c for c, _ in packed], pa.binary()), pa.array([d for _, d in packed], pa.binary())],
                [id, "shard", "at", "n_tokens", "control", "data"])

    ranged = tokens.repartitionByRange(files, id) if files else tokens.repartitionByRange(id)
    placed = ranged.sortWithinPartitions(id, "tokens").withColumn("shard", F.spark_partition_id())
    id_type = tokens.schema[id].dataType.simpleString()
    coded = placed.mapInArrow(encode, f"`{id}` {id_type}, shard int, at bigint, n_tokens bigint, control binary, data binary")
    coded.write.option("compression", "none").parquet(f"{path}/shards")
    sizes = spark.read.parquet(f"{path}/shards").groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first")).coalesce(1).write.parquet(
        f"{path}/starts")
    spark.createDataFrame(pa.table({"token": pa.array(order, pa.int64())})).select(
        F.monotonically_increasing_id().alias("place"), "token").coalesce(1).write.parquet(f"{path}/ranks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, `start`, `n_tokens`, `tokens`) per document of a folder: the ids as little-endian 32-bit bytes, and how many
    ids all documents before it have. The list of ids by rank is bounded by the vocabulary."""
    ship(spark)
    ranks = spark.read.parquet(f"{path}/ranks").toArrow()
    order = np.zeros(len(ranks), np.uint32)
    order[np.argsort(ranks["place"].to_numpy(), kind="stable").argsort(kind="stable")] = ranks["token"].to_numpy()
    sent = spark.sparkContext.broadcast(order)

    @F.arrow_udf("binary")
    def decode(control: pa.Array, data: pa.Array, count: pa.Array) -> pa.Array:
        rows = zip(control.to_pylist(), data.to_pylist(), count.to_pylist())
        return pa.array([sent.value[unpack(c, d, n)].astype("<u4").tobytes() for c, d, n in rows], pa.binary())

    rows = spark.read.parquet(f"{path}/shards")
    starts = spark.read.parquet(f"{path}/starts")
    id = rows.columns[0]
    return rows.join(starts, "shard").select(
        F.col(id), (F.col("first") + F.col("at")).alias("start"), "n_tokens",
        decode(F.col("control"), F.col("data"), F.col("n_tokens")).alias("tokens"))


def ids_crc32(tokens: str) -> Column:
    return F.crc32(F.col(tokens))
