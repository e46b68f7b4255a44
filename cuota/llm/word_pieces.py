"""Lengths of greedy longest-match word pieces, in one pass over each word and without building the pieces."""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuota.llm.common import ship, without

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Distinct words whose counts a worker remembers; the memory is emptied when it is full. Results do not depend on it.
MEMORY_WORDS = 400_000

_ADDED = ("n_words", "n_pieces")


class PieceCounter:
    """Automaton over a vocabulary of pieces that begin a word (`initial`) and pieces that go on with it (`inner`).

    A trie holds both kinds below a root each. When a byte cannot follow a node, the node's failure link says where to
    go on: at the longest rest of what was read that some pieces still begin with, after the pieces in front of it have
    been popped. How many those are is computed beforehand, so the walk only adds numbers. A word that no sequence of
    pieces spells is one unknown piece.
    """

    def __init__(self, initial, inner):
        # per node: children by byte, failure link (None: nowhere to go on), pieces popped on the way, ends a piece
        self.children: list[dict[int, int]] = [{}, {}]
        self.fail: list[int | None] = [None, None]
        self.popped = [0, 0]
        self.ends = [False, False]
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                self._add(root, piece)
        self._link()

    def _add(self, root: int, piece: bytes) -> None:
        node = root
        for byte in piece:
            following = self.children[node].get(byte)
            if following is None:
                following = self.children[node][byte] = len(self.children)
                self.children.append({})
                self.fail.append(None)
                self.popped.append(0)
                self.ends.append(False)
            node = following
        if piece:
            self.ends[node] = True

    def _link(self) -> None:
        """Breadth first: a node that ends a piece pops it; any other goes where its parent's links let the byte in."""
        level = [0, 1]
        while level:
            below = []
            for parent in level:
                for byte, node in self.children[parent].items():
                    below.append(node)
                    if self.ends[node]:
                        self.fail[node], self.popped[node] = 1, 1
                        continue
                    at, count = self.fail[parent], self.popped[parent]
                    while at is not None and byte not in self.children[at]:
                        count, at = count + self.popped[at], self.fail[at]
                    if at is not None:
                        self.fail[node], self.popped[node] = self.children[at][byte], count
            level = below

    def count(self, word: bytes) -> int:
        children, fail, popped = self.children, self.fail, self.popped
        node, total = 0, 0
        for byte in word:
            while (following := children[node].get(byte)) is None:
                total += popped[node]
                node = fail[node]
                if node is None:
                    return 1
            node = following
        while node > 1:
            total += popped[node]
            node = fail[node]
            if node is None:
                return 1
        return total


class Memory(dict):
    """Counts by word, worked out on first sight."""

    def __init__(self, count, limit: int):
        super().__init__()
        self.work_out, self.limit = count, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        number = self[word] = self.work_out(word)
        return number


@lru_cache(maxsize=2)
def memory(path: str, limit: int = MEMORY_WORDS) -> Memory:
    """Counter for a rank file (base64 token and id per line). Words are read with a space in front, so tokens with a
    leading space are those that begin a word; all others go on with it."""
    with open(path, "rb") as file:
        tokens = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    begin = [t for t in tokens if t.startswith(b" ")]
    counter = PieceCounter(begin, [t for t in tokens if not t.startswith(b" ")])
    return Memory(lambda word: counter.count(b" " + word), limit)


def count_pieces(df: DataFrame, *, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Every row of `df` with `n_words` and `n_pieces`: its whole text's words (runs of other than ASCII white space) and
    the pieces that greedy longest match splits them into, over the UTF-8 bytes.

    Nothing is shuffled: a text's counts need the vocabulary only. Null and empty texts have 0 of both; repeated rows are
    counted each; an empty table gives an empty result. Columns of `df` named like the added ones are replaced.
    """
    @F.arrow_udf("struct<n_words:bigint,n_pieces:bigint>")
    def count(texts: pa.Array) -> pa.Array:
        pieces, words, totals = memory(path), [], []
        for data in texts.cast(pa.binary()).to_pylist():
            found = (data or b"").split()
            words.append(len(found))
            totals.append(sum(map(pieces.__getitem__, found)))
        return pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(totals, pa.int64())], list(_ADDED))

    ship(df.sparkSession)
    rest = without(df, *_ADDED)
    kept = [F.col(f"`{c}`") for c in rest.columns]
    counted = rest.withColumn("_counts", count(F.col(text)))
    return counted.select(*kept, "_counts.n_words", "_counts.n_pieces")
