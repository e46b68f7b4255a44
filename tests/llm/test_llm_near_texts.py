"""The near-duplicate stage against all pairs of texts, on edited copies of every degree."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import ODD, ROWS

from cuota.llm import near_texts


def shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def alike(a, b):
    return len(a & b) / len(a | b)


def groups_of(texts, similarity=0.8):
    """Smallest id of each id's group, all pairs compared that share a shingle."""
    owner, sets, seen = {i: i for i in texts}, {i: shingles(t or "") for i, t in texts.items()}, {}
    for i in sorted(texts):
        for j in {j for s in sets[i] for j in seen.setdefault(s, [])}:
            if owner[i] != owner[j] and alike(sets[i], sets[j]) >= similarity:
                low, high = sorted((owner[i], owner[j]))
                owner = {k: low if o == high else o for k, o in owner.items()}
        for s in sets[i]:
            seen[s].append(i)
    return owner


def edited(words, share, choice):
    return " ".join(choice.choice("abcdefgh") * 5 if choice.random() < share else w for w in words)


@pytest.fixture(scope="module")
def copies():
    """Texts of 60 to 400 words with an edited copy each; a large group of edited copies of one text."""
    choice, texts = random.Random(11), {}
    vocabulary = ["".join(choice.choices("abcdefghijklmno", k=choice.randint(2, 9))) for _ in range(3000)]
    for n in range(240):
        words = choice.choices(vocabulary, k=choice.randint(60, 400))
        texts[2 * n] = " ".join(words)
        texts[2 * n + 1] = edited(words, (0.004, 0.01, 0.02, 0.03)[n % 4], choice)
    for n in range(300):
        texts[1000 + n] = edited(words, 0.008, choice)
    return texts


@pytest.mark.parametrize("shard_rows", [50, 8192])
def test_edited_copies(spark, copies, shard_rows):
    df = spark.createDataFrame(list(copies.items()), "doc_id long, text string").repartition(5)
    left = {r["doc_id"] for r in near_texts.near_dedup(df, shard_rows=shard_rows).collect()}
    want = groups_of(copies)
    goes = {i for i, o in want.items() if i != o}
    assert not (set(copies) - left) - goes  # nothing goes that has no like text
    assert len(goes - left) >= 0.95 * len(goes) > 300
    sets = {i: shingles(t) for i, t in copies.items()}
    for low, high in ((0.8, 0.9), (0.9, 1.01)):
        pairs = [i for i in range(1, 480, 2) if low <= alike(sets[i], sets[i - 1]) < high]
        assert sum(i not in left for i in pairs) >= 0.9 * len(pairs) > 20
    assert near_texts.near_dedup(df.limit(0)).count() == 0


def test_odd_rows(spark):
    odd = spark.createDataFrame([(*r, "s", "k", "i", "r", "x") for r in ROWS], ODD)
    rows = near_texts.near_dedup(odd).collect()
    ids = [r["doc_id"] for r in rows]
    # 1 and 2 have the same words; the wordless texts 3, 4, 5 and a null id are alike, as are a null id and 1
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 6, 7, 8, 9, 10, 11] and None not in ids
    assert near_texts.near_dedup(odd).columns == odd.columns


@pytest.mark.parametrize("total", [1, 1000, 250_000, 10**9])
def test_enough_tables_at_every_size(total):
    bits, count = near_texts.tables(total)
    agree = (1 - near_texts.flip_chance(0.8)) ** bits
    assert (1 - agree) ** count <= near_texts.MISS and total / 2 ** bits <= near_texts.SHARD_MEAN


def test_fingerprints_do_not_depend_on_slices(monkeypatch):
    text = " ".join(random.Random(2).choices("abcdefgh", k=300)).encode()
    whole = near_texts.fingerprint_bits(text, 3)
    monkeypatch.setattr(near_texts, "_SLICE", 7)
    assert (near_texts.fingerprint_bits(text, 3) == whole).all() and len(whole) == 192
    other = near_texts.fingerprint_bits(b"one other text of quite different words", 3)
    assert 60 < np.count_nonzero(whole != other) < 130


@pytest.fixture(scope="module")
def borderline():
    """Groups of texts around the threshold: short ones, chains, and a passage that many share."""
    choice, texts = random.Random(5), {}
    vocabulary = ["".join(choice.choices("abcdefghijklmno", k=choice.randint(2, 9))) for _ in range(3000)]
    passage = choice.choices(vocabulary, k=60)
    for _ in range(60):
        words = choice.choices(vocabulary, k=choice.randint(6, 120))
        for _ in range(8):
            if choice.random() < 0.5:
                words = words + choice.choices(vocabulary, k=1 + len(words) // 30)
            texts[len(texts)] = edited(words, choice.choice((0.005, 0.015, 0.025)), choice)
    for _ in range(80):
        texts[len(texts)] = " ".join(passage + choice.choices(vocabulary, k=choice.randint(2, 60)))
    return texts


def test_no_link_is_lost(spark, borderline):
    df = spark.createDataFrame(list(borderline.items()), "doc_id long, text string").repartition(5)
    left = {r["doc_id"] for r in near_texts.near_dedup(df).collect()}
    want = groups_of(borderline)
    assert left == set(want.values()) and 150 < len(left) < len(want)


def test_links_that_the_trees_do_not_offer(spark, borderline, monkeypatch):
    none = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(near_texts, "candidate_pairs", lambda *args: none)
    monkeypatch.setattr(near_texts, "ORDER_SHINGLES", 5)
    df = spark.createDataFrame(list(borderline.items()), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in near_texts.near_dedup(df).collect()} == set(groups_of(borderline).values())


def test_prefixes_and_counters_lose_no_pair():
    choice = random.Random(8)
    for _ in range(3000):
        common, size = choice.randint(1, 60), choice.randint(0, 12)
        kinds = choice.sample(range(100), min(100, common + size))
        a, b = set(kinds[:common]), set(kinds[:common])
        for k in kinds[common:]:
            (a if choice.random() < 0.5 else b).add(k)
        late = np.sort(np.array(choice.sample(range(100), 20), np.uint64))
        places = np.array(choice.sample(range(1, 21), 20))
        heads = [near_texts.prefix(np.array(list(k), np.uint64), 0.8, late, places) for k in sorted((a, b), key=len)]
        if len(a & b) / len(a | b) >= 0.8:
            assert set(heads[0][0][:heads[0][1]].tolist()) & set(heads[1][0].tolist())
            counts = [np.frombuffer(near_texts.counters(np.array(list(k), np.uint64)), np.uint8).astype(int) for k in (a, b)]
            assert abs(counts[0] - counts[1]).sum() <= (len(a) + len(b)) / 9 + 1e-9


def test_sketches_lose_no_pair_and_tell_long_texts_apart():
    choice = random.Random(9)
    for size in (1, 30, 600, 5000):
        for share in (0.0, 0.05, 0.19, 0.3):
            kinds = [choice.getrandbits(64) for _ in range(size + int(2 * share * size))]
            extra = len(kinds) - size
            a, b = kinds[:size + extra // 3], kinds[extra // 3:] if size > extra else kinds
            differ = len(set(a) ^ set(b))
            found = near_texts.sketch_distance(*[near_texts.sketch(np.array(k, np.uint64)) for k in (a, b)])
            assert found <= differ and found >= 0.6 * differ
            assert (differ - found) % 2 == 0


def test_no_tie_within_a_known_group():
    tree = near_texts.PairTree(3)
    for point, group in ((0b1, 7), (0b11, 7), (0xFF00, 7), (0xFF01, 8), (0xFF03, 8), (0b111, 9)):
        tree.add(point, group)
    # one pair for each group that a point ties in, none between points of one
    assert tree.pairs == [(2, 3), (0, 5)] and tree.firsts() == [0]


def test_copies_of_one_text_meet_at_it(spark):
    links = spark.createDataFrame([(5, 9), (3, 9), (9, 12), (20, 21)], "a long, b long")
    known = spark.createDataFrame([(5, 3), (9, 3), (12, 3), (21, 20)], "node long, component long")
    pairs = spark.createDataFrame([(3, 30), (12, 21), (3, 5)], "a long, b long")
    found = {tuple(r) for r in near_texts.hub_pairs(pairs, links, known).collect()}
    assert found == {(9, 30), (3, 30), (9, 21), (12, 20), (9, 20)}


def test_texts_that_share_shingles_meet_where_they_can_be_alike(spark):
    """A shingle that comes too late in both texts to be their first common one makes no pair."""
    prints = spark.createDataFrame([(n, 20, [100 * n, 100 * n + 1, 100 * n + 2, 7]) for n in range(1, 30)] + [
        (40, 20, [7, 8]), (41, 20, [7, 9])], "node long, _size long, _prefix array<long>")
    known = spark.createDataFrame([], "node long, component long")
    assert {tuple(r) for r in near_texts.sharing_pairs(prints, known, 0.8).collect()} == {(40, 41)}


def test_only_tied_texts_move(spark):
    from cuota.llm.exact_dedup import suspects

    rows = spark.range(20_000).select(F.when(F.col("id") % 5000 != 1, F.col("id")).alias("k"), F.lit("text").alias("text"))
    wanted = spark.createDataFrame([(i,) for i in range(0, 400, 2)] + [(None,)], "k long")
    some, others = suspects(rows, F.col("k"), wanted, "k")
    found = {r["k"] for r in some.collect()}
    assert found >= set(range(0, 400, 2)) | {None} and len(found) < 201 + 200
    assert some.count() + others.count() == 20_000 and "Exchange hashpartitioning" not in others._jdf.queryExecution().toString()


def test_folds_lose_no_pair_and_keep_unlike_texts_apart(spark):
    """Texts with a common beginning meet at its shingles; the folds let those of the similarity through, no crowd of others."""
    choice = random.Random(11)
    base = [choice.randrange(1 << 60) for _ in range(40)]
    sets = [base[:k] + [choice.randrange(1 << 60) for _ in range(40 - k)] for k in [40, 39, 38, 37, 36] + [28] * 60]
    late = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = []
    for node, own in enumerate(sets):
        hashes = np.array(own, np.uint64)
        common_first = [h for h in base if h in own] + [h for h in own if h not in base]
        rows.append((node, len(own), common_first[:len(near_texts.prefix(hashes, 0.8, *late)[0])],
                     *near_texts.folded(near_texts.sketch(hashes)).tolist()))
    prints = spark.createDataFrame(rows, "node long, _size long, _prefix array<long>, "
                                   + ", ".join(f"_fold{i} long" for i in range(near_texts.FOLD_WORDS)))
    known = spark.createDataFrame([], "node long, component long")
    alike_pairs = {(a, b) for b in range(len(sets)) for a in range(b) if alike(set(sets[a]), set(sets[b])) >= 0.8}
    every = {tuple(r) for r in near_texts.sharing_pairs(prints.select("node", "_size", "_prefix"), known, 0.8).collect()}
    found = {tuple(r) for r in near_texts.sharing_pairs(prints, known, 0.8).collect()}
    assert alike_pairs and alike_pairs <= found <= every and len(every) > 1500 and len(found) < 100
    for a in range(len(sets)):
        for b in range(a):
            x, y = (near_texts.folded(near_texts.sketch(np.array(sets[i], np.uint64))) for i in (a, b))
            assert sum(((int(p) ^ int(q)) % (1 << 64)).bit_count() for p, q in zip(x, y)) <= len(set(sets[a]) ^ set(sets[b]))
