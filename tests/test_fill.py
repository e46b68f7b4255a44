import random

import pytest
from pyspark.sql import functions as F

from cuota.operators.fill import forward_fill


@pytest.mark.parametrize("chunk_rows", [1, 3, 7, 65_536])
def test_like_a_loop_with_one_hot_group(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    rows, expected = [], []
    for group in ["hot"] * 6 + ["a", "b"]:
        start = sum(1 for r in rows if r[0] == group)
        for i in range(start, start + 20):
            rows.append((group, i * 2, rng.choice([None, None, None, rng.randint(0, 9)])))
    for group in {r[0] for r in rows}:
        last = None
        for _, n, v in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            last = v if v is not None else last
            expected.append((group, n, last))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, n long, v int").repartition(5)
    got = forward_fill(df, ["g"], "n", "v", chunk_rows=chunk_rows).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_second_column(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None)], "g string, n long, v int")
    got = forward_fill(df, ["g"], "n", "v", out="w").orderBy("n").collect()
    assert [tuple(r) for r in got] == [("a", 1, 5, 5), ("a", 2, None, 5)]
    assert forward_fill(df, ["g"], "n", "v").filter(F.col("v").isNull()).count() == 0


def test_rows_with_null_keys_and_orders_come_back(spark):
    rows = [(None, 1, 5), (None, 2, None), ("a", None, None), ("a", None, 8), ("a", 3, None), ("a", 9_000_000_000, None),
            ("b", -7, 1), ("b", 5_000_000, None)]
    df = spark.createDataFrame(rows, "g string, n long, v int")
    got = forward_fill(df, ["g"], "n", "v").collect()
    expected = [(None, 1, 5), (None, 2, 5), ("a", None, None), ("a", None, 8), ("a", 3, None), ("a", 9_000_000_000, None),
                ("b", -7, 1), ("b", 5_000_000, 1)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


@pytest.mark.parametrize("section_chunks", [1, 2, 5])
def test_sections_hand_values_on_over_wide_gaps(spark, section_chunks):
    rng = random.Random(section_chunks)
    orders = sorted(rng.sample(range(-10**15, 10**15), 60))
    rows = [("hot", n, rng.choice([None, None, None, rng.randint(0, 9)])) for n in orders]
    rows += [("hot", None, 77)] * 5 + [("hot", None, None)]
    expected, last = [r for r in rows if r[1] is None], None
    for group, n, v in rows[:60]:
        last = v if v is not None else last
        expected.append((group, n, last))
    df = spark.createDataFrame(rows, "g string, n long, v int").repartition(4)
    for chunk_rows in (1, 65_536, 10**14):
        got = forward_fill(df, ["g"], "n", "v", chunk_rows=chunk_rows, section_chunks=section_chunks).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
