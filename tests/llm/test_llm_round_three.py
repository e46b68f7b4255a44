"""Packing, filter audit and Merkle manifest against brute force."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_operators import ODD, ROWS, SF
from tokenizers import Tokenizer

from cuota.llm import filter_audit, merkle, packing
from cuota.llm.queries import QUERIES
from cuota.llm.ranks import ranked, running_totals


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "s", "k", "i", "r", "x") for r in ROWS], ODD)


def test_ranks_and_totals_of_a_hot_key(spark):
    rows = [("hot", i % 50, i) for i in range(3000)] + [("cold", 1, 7), ("last", 5, 5), ("last", 5, 5)]
    df = spark.createDataFrame(rows, "k string, o long, v long").repartition(7)
    got = defaultdict(list)
    for r in ranked(df, "k", ["o"], "t").collect():
        got[r["k"]].append((r["_rank"], r["o"]))
    for key, found in got.items():
        found.sort()
        assert [n for n, _ in found] == list(range(len(found)))
        assert [o for _, o in found] == sorted(o for k, o, _ in rows if k == key)
    before = 0
    for r in sorted(running_totals(df, "v", ["k", "o", "v"], "t").collect(), key=lambda r: (r["k"], r["o"], r["v"])):
        assert r["_before"] == before
        before += r["v"]
    assert ranked(df.limit(0), "k", ["o"], "t").count() == running_totals(df.limit(0), "v", ["k"], "t").count() == 0


# packing -------------------------------------------------------------------------------------------------------------

def check_packing(rows, texts, room, library):
    """Every id in one piece, sequences gapless and within `room`; returns tokens and padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == r["length"] > 0
    wanted = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in texts)
    got = Counter()
    for (i, total), found in pieces.items():
        found.sort(key=lambda r: r["start"])
        copies = Counter(r["start"] for r in found)[0]
        ids = [r["ids"] for r in found]
        if copies == 1:
            assert [r["start"] for r in found] == np.cumsum([0, *[r["length"] for r in found[:-1]]]).tolist()
            got[i, tuple(itertools.chain(*ids))] += 1
        else:  # repeated rows and texts under one id: only their number of ids can be told apart
            assert sum(map(len, ids)) == copies * total
            got.update({k: n for k, n in wanted.items() if k[0] == i and len(k[1]) == total})
    assert got == wanted
    padding = 0
    for found in sequences.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= room
        padding += 0 if end & (end - 1) == 0 else room - end
    return sum(len(k[1]) * n for k, n in wanted.items()), padding


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.VOCABULARY)


@pytest.mark.parametrize("room", [64, 2048])
def test_packing_of_documents(spark, library, room):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = packing.pack_documents(docs, sequence_tokens=room).collect()
    tokens, padding = check_packing(rows, texts, room, library)
    assert padding <= 0.005 * tokens
    assert {r["sequence_id"] for r in rows} == set(range(1 + max(r["sequence_id"] for r in rows)))


def test_packing_of_odd_rows(spark, odd, library):
    rows = packing.pack_documents(odd, sequence_tokens=128).collect()
    tokens, padding = check_packing(rows, [(r[0], r[1]) for r in ROWS], 128, library)
    assert padding <= 0.02 * tokens
    assert packing.pack_documents(odd.limit(0)).count() == 0
    one_length = spark.createDataFrame([(i, "word " * 80) for i in range(40)], "doc_id long, text string")
    tokens, padding = check_packing(packing.pack_documents(one_length, sequence_tokens=128).collect(),
                                    [(i, "word " * 80) for i in range(40)], 128, library)
    assert padding <= 0.02 * tokens


def test_packing_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_pack_documents"](spark, SF).collect()
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [1]
        part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids)
    assert sum(r["length"] for r in rows) == sum(
        len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts.values())


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), min_size=1), st.integers(40, 60))
def test_patterns_hold_the_demand(histogram, room):
    sizes = np.array(sorted(histogram))
    demand = np.array([histogram[s] for s in sizes.tolist()])
    patterns, used = packing.solve(sizes, demand.astype(float), room)
    assert (sizes @ patterns <= room).all() and np.allclose(patterns @ used, demand, atol=1e-6)
    times = packing.whole_uses(patterns, used, demand)
    assert (times >= 0).all() and (patterns.astype(int) @ times <= demand).all()
    best, choice = packing.knapsack(sizes, np.sqrt(sizes), room)
    slow = [0.0] * (room + 1)
    for c in range(1, room + 1):
        slow[c] = max([slow[c - 1], *[slow[c - s] + s ** 0.5 for s in sizes.tolist() if s <= c]])
    assert np.allclose(best, slow)
    runs, _ = packing.plan_runs(histogram, room)
    assert runs.num_rows <= len(sizes) ** 2 + 1


def test_linear_program_reaches_the_optimum():
    """Three lengths whose best mixture is known: 20 of 6 and 20 of 4 fill 20 tens, 10 of 5 fill 5."""
    patterns, used = packing.solve(np.array([4, 5, 6]), np.array([20.0, 10.0, 20.0]), 10)
    assert used.sum() == pytest.approx(25, rel=1e-3)
    patterns, used = packing.solve(np.array([3, 7]), np.array([30.0, 10.0]), 10)
    assert used.sum() == pytest.approx(10 + 20 / 3, rel=1e-3)


def test_bins_hold_their_lengths(spark):
    tops = [packing.bin_top(n) for n in range(1, 2049)]
    assert all(n <= t <= n * (1 + 2 / packing.EXACT) for n, t in enumerate(tops, 1)) and tops[-1] == 2048
    found = spark.range(1, 2049).select(packing._bin(packing.F.col("id"), 2048, packing.EXACT).alias("b")).collect()
    assert [r["b"] for r in found] == tops
    for total in range(1, 300):
        starts = packing.tail_starts(total, 64)
        ends = [*starts[1:], total]
        assert all((e - s) & (e - s - 1) == 0 for s, e in zip(starts, ends)) and (not starts or starts[0] == total // 64 * 64)


# filter audit --------------------------------------------------------------------------------------------------------

def slow_audit(rows, labels):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, _ in rows]
    fails = []
    for (i, text, _), w in zip(rows, words):
        text = text or ""
        held = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)}
        fails.append({k for k, v in held.items() if v})
    out = {}
    for part in {s or "" for _, _, s in rows}:
        own = [n for n, r in enumerate(rows) if (r[2] or "") == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [n for n in left if f in fails[n]]
                left = [n for n in left if f not in fails[n]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in fails[n] for n in own) - len(gone),
                    sum(fails[n] == {f} for n in own), sum((rows[n][0], "good") in labels for n in gone),
                    sum((rows[n][0], "toxic") in labels for n in gone), f]
        for key in [k for k in out if k[0] == part]:
            out[key][6] = shapley[out[key][6]]
    return out


def test_audit_of_odd_rows(spark, odd):
    marks = [(1, 1, 0), (1, 0, 1), (6, 1, 1), (8, None, 1), (None, 1, 1), (99, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality long, toxic long")
    known = {(i, "good") for i, q, _ in marks if q and i} | {(i, "toxic") for i, _, t in marks if t and i}
    rows = filter_audit.audit_documents(odd, labels).collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in filter_audit.COUNTS] for r in rows}
    assert len(got) == len(rows) and got == slow_audit([(r[0], r[1], r[3]) for r in ROWS], known)
    assert filter_audit.audit_documents(odd.limit(0), labels).count() == 0
    assert filter_audit.audit_documents(odd, labels.limit(0)).count() == len(rows)


def test_paths_on_the_lattice():
    forward, backward = filter_audit.paths(4)
    for state in range(16):
        size = bin(state).count("1")
        assert forward[state] == np.prod(range(1, size + 1)) and backward[state] == np.prod(range(1, 5 - size))
    weights = Counter()
    for _, f, orders in filter_audit.edges(4):
        weights[f] += orders
    assert set(weights.values()) == {24}  # every order takes one edge of each filter
    with pytest.raises(ValueError):
        filter_audit.interaction_audit(None, list("ABCDEFGH"))


# manifest ------------------------------------------------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_tree(nodes):
    """(root, siblings per leaf as (left, right))."""
    sides, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for leaf, place in enumerate(at):
            if place % 2:
                sides[leaf].append((level[place - 1], ""))
            else:
                sides[leaf].append(("", level[place + 1] if place + 1 < len(level) else ""))
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [place // 2 for place in at]
    return level[0], sides


@pytest.mark.parametrize("levels", [1, 3, 10])
@pytest.mark.parametrize("table", ["odd", "documents"])
def test_manifest(spark, odd, table, levels):
    df = odd.withColumn("n_chars", packing.F.length("text")) if table == "odd" else spark.read.parquet(f"{SF}/documents.parquet")
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for r in df.collect():
        leaf = h(*[field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        groups[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: slow_tree([leaf for *_, leaf in sorted(groups[x])]) for x in langs}
    root, upper = slow_tree([trees[x][0] for x in langs])
    want = Counter((leaf, trees[x][0], tuple(trees[x][1][n] + upper[m]))
                   for m, x in enumerate(langs) for n, (*_, leaf) in enumerate(sorted(groups[x])))
    rows = merkle.merkle_manifest(df, levels=levels).withColumn(
        "folded", merkle.fold(packing.F.col("sides"), packing.F.col("leaf"))).collect()
    assert Counter((r["leaf"], r["subroot"], tuple(map(tuple, r["sides"]))) for r in rows) == want
    assert {r["root"] for r in rows} == {root} == {r["folded"] for r in rows}
    assert merkle.merkle_manifest(df.limit(0)).count() == 0


def test_manifest_query_finds_tampering(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op13_merkle_manifest"](spark, SF).collect():
        hit = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and docs[r["doc_id"]]["n_chars"] is not None
        assert r["verified"] == (not hit) == (r["folded_root"] == r["root"])
