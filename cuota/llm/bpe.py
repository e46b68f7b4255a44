"""Byte-level BPE encoding and decoding, with long texts encoded in parallel pieces and joined exactly."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuota.llm.common import release, ship, without

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Texts up to this many characters are encoded at once. Longer ones are cut into pieces of about this size, which other
# tasks encode. Ids do not depend on it.
PIECE_CHARS = 65_536
# Tokens on either side of a join that are encoded anew at first; doubled until both sides agree.
WINDOW_TOKENS = 8

PIECES = "array<struct<run:int,text:binary>>"


class Codec:
    """Vocabulary, encoder and decoding table of one byte-level BPE file.

    The merge order of such a file is the order of its ids, and each token encodes to itself, so that merging by the
    lowest id gives the file's own result. A file of another kind is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        bytes_of = self._alphabet()
        ranks = {bytes(bytes_of[c] for c in token): i for token, i in vocab.items()}
        if [vocab["".join(m)] for m in model["merges"]] != list(range(256, 256 + len(model["merges"]))):
            raise ValueError(f"{path}: ids are not in the order of the merges")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.encoding = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens=special)
        self.table = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.table[i] = token

    @staticmethod
    def _alphabet() -> dict[str, int]:
        """Printable Latin-1 characters stand for their own byte, the rest for characters from 256 on, in byte order."""
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
        rest = [b for b in range(256) if b not in set(plain)]
        return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all").view(np.int32)

    def merge(self, data: bytes) -> list[int]:
        """Ids of bytes that pre-tokenization keeps together."""
        return self.encoding._encode_single_piece(data)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def halves(data: bytes, limit: int) -> list[bytes]:
    """A run cut in halves until no part is longer than `limit` bytes."""
    if len(data) <= limit:
        return [data]
    middle = len(data) // 2
    return halves(data[:middle], limit) + halves(data[middle:], limit)


def cut(text: str, coder: Codec, limit: int) -> list[tuple[int, bytes]]:
    """Pieces (run, bytes) of a long text. Run 0: plain text that starts and ends between pre-tokens; its ids stand as
    they are. Run n: a part of the n-th pre-token that is itself longer than `limit`; its parts have to be joined.

    A plain piece ends only after a character that is no white space, as only trailing white space would be split
    otherwise if the text ended there. The white space between such a place and a long pre-token is a run of its own per
    pre-token, whose bytes are merged as they are.
    """
    pieces: list[tuple[int, bytes]] = []
    runs, start, position = 0, 0, 0

    def plain(end: int) -> None:
        nonlocal start
        if end > start:
            pieces.append((0, text[start:end].encode()))
        start = end

    def run(data: str) -> None:
        nonlocal runs
        runs += 1
        pieces.extend((runs, part) for part in halves(data.encode(), limit))

    def walk(begin: int, stop: int) -> None:
        nonlocal start
        blanks: list[str] = []  # pre-tokens since the text could last be cut, which end in white space
        for match in coder.pattern.finditer(text, begin, stop):
            token = match.group()
            if len(token) > limit:
                plain(match.start() - sum(map(len, blanks)))
                for part in (*blanks, token):
                    run(part)
                start, blanks = match.end(), []
                continue
            if not blanks and match.end() - start > limit:
                plain(match.start())
            blanks = [*blanks, token] if token[-1].isspace() else []

    for special in coder.special.finditer(text):
        walk(position, special.start())
        plain(special.start())
        position = special.end()
        plain(position)
    walk(position, len(text))
    plain(len(text))
    return pieces


def join(left: list[int], right: list[int], coder: Codec, window: int = WINDOW_TOKENS) -> list[int]:
    """Ids of two neighbouring parts of one pre-token, put together.

    The tokens around the join are encoded anew. A sequence is the encoding of its bytes exactly if every two neighbours
    encode to themselves. So once the new tokens begin and end with the very tokens that stood there, both rest parts
    fit; otherwise the window doubles, at most to both sides as a whole.
    """
    while True:
        a, b = left[-window:], right[:window]
        middle = coder.merge(coder.decode(a) + coder.decode(b))
        fits_left = len(a) == len(left) or middle[0] == a[0]
        fits_right = len(b) == len(right) or middle[-1] == b[-1]
        if fits_left and fits_right:
            return left[:len(left) - len(a)] + middle + right[len(b):]
        window *= 2


def join_tree(parts: list[list[int]], coder: Codec, window: int = WINDOW_TOKENS) -> list[int]:
    """Neighbours joined pair by pair, level by level."""
    while len(parts) > 1:
        pairs = [join(a, b, coder, window) for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + parts[len(pairs) * 2:]
    return parts[0] if parts else []


def _lists(arrays: list) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int64)
    values = np.concatenate(arrays) if len(arrays) else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32, copy=False)))


def _encoder(path: str):
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        coder = codec(path)
        found = _lists([coder.encode(t.as_py() or "") for t in texts])
        release()
        return found

    return encode


def _cutter(path: str, limit: int):
    @F.arrow_udf(PIECES)
    def pieces(texts: pa.Array) -> pa.Array:
        coder = codec(path)
        kind = pa.list_(pa.struct([("run", pa.int32()), ("text", pa.binary())]))
        return pa.array([[{"run": r, "text": b} for r, b in cut(t, coder, limit)] for t in texts.to_pylist()], kind)

    return pieces


def _piece_encoder(path: str):
    @F.arrow_udf("array<int>")
    def encode(runs: pa.Array, data: pa.Array) -> pa.Array:
        coder = codec(path)
        return _lists([np.asarray(coder.merge(d), dtype=np.int32) if r else coder.encode(d.decode())
                       for r, d in zip(runs.to_pylist(), data.to_pylist())])

    return encode


def _joiner(path: str):
    @F.arrow_udf("array<int>")
    def joined(pieces: pa.Array) -> pa.Array:
        coder, out = codec(path), []
        inner = pieces.values
        first, runs = np.asarray(pieces.offsets), inner.field("run").to_numpy()
        at, ids = np.asarray(inner.field("ids").offsets), inner.field("ids").values.to_numpy()
        for start, end in zip(first, first[1:]):
            whole, number = [], start
            while number < end:
                run, begin = runs[number], number
                while number < end and runs[number] == run:
                    number += 1
                if run:
                    parts = [ids[at[i]:at[i + 1]].tolist() for i in range(begin, number)]
                    whole.append(np.asarray(join_tree(parts, coder), dtype=np.int32))
                else:
                    whole.append(ids[at[begin]:at[number]])
            out.append(np.concatenate(whole))
        found = _lists(out)
        del out
        release()
        return found

    return joined


def bpe_encode(df: DataFrame, *, text: str = "text", out: str = "ids", path: str = VOCABULARY,
               piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Every row of `df` with the array `out` of its whole text's ids, equal to the tokenizers library's for the file
    `path` with add_special_tokens=False; the strings of special tokens in a text become their ids, as there.

    Texts up to `piece_chars` are encoded where they are. Longer ones are cut between pre-tokens; a pre-token that is
    itself longer (a stretch that nothing splits) is halved. The pieces are spread over all tasks, encoded, brought
    together per document (whose ids form one row anyway), and the halves are joined as a tree, with growing windows
    encoded anew around each join.

    Null and empty texts have an empty array. Each row gives one row, repeated ones too; an empty table gives an empty
    result. A column of `df` named `out` is replaced.
    """
    ship(df.sparkSession)
    rest = without(df, out)
    names = rest.columns
    long = F.coalesce(F.length(text) > piece_chars, F.lit(False))
    direct = rest.where(~long).withColumn(out, _encoder(path)(F.col(text)))
    carried = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    cut_up = rest.where(long).select(F.monotonically_increasing_id().alias("_row"), carried.alias("_rest"),
                                     _cutter(path, piece_chars)(F.col(text)).alias("_pieces"))
    pieces = (cut_up.select("_row", "_rest", F.posexplode("_pieces").alias("_no", "_piece"))
              .select("_row", "_no", F.when(F.col("_no") == 0, F.col("_rest")).alias("_rest"), "_piece")
              .repartition("_row", "_no")
              .select("_row", "_no", "_rest", F.col("_piece.run").alias("_run"),
                      _piece_encoder(path)(F.col("_piece.run"), F.col("_piece.text")).alias("_ids")))
    whole = pieces.groupBy("_row").agg(
        F.first("_rest", ignorenulls=True).alias("_rest"),
        F.array_sort(F.collect_list(F.struct("_no", F.col("_run").alias("run"), F.col("_ids").alias("ids"))))
        .alias("_pieces"))
    joined = whole.select(*[F.col(f"_rest.c{i}").alias(c) for i, c in enumerate(names)],
                          _joiner(path)(F.col("_pieces")).alias(out))
    return direct.unionByName(joined)


def bpe_decode(df: DataFrame, *, ids: str = "ids", out: str = "decoded", path: str = VOCABULARY) -> DataFrame:
    """Every row of `df` with the string `out` of its ids, equal to the tokenizers library's decode with
    skip_special_tokens=False. Bytes that are no UTF-8 become U+FFFD; a null array gives the empty text; ids outside
    the vocabulary and null ids give nothing.
    """
    ship(df.sparkSession)

    @F.arrow_udf("string")
    def decode(arrays: pa.Array) -> pa.Array:
        coder, texts = codec(path), []
        for array in arrays:
            numbers = (array.values if array.is_valid else pa.array([], pa.int32())).drop_null().to_numpy()
            known = (numbers >= 0) & (numbers < len(coder.table))
            texts.append(coder.decode((numbers if known.all() else numbers[known]).tolist()).decode("utf-8", "replace"))
        found = pa.array(texts, pa.string())
        del texts
        release()
        return found

    return without(df, out).withColumn(out, decode(F.col(ids)))


def ids_sha256(ids: str) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256)
