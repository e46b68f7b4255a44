"""What components and the near stage leave to the driver: few queries and no small hash tables."""

import sys

import corpus_pipeline
from cuota.llm import common, exact_dedup, near_texts
from cuota.llm.components import components

components_module = sys.modules["cuota.llm.components"]


def test_rounds_have_no_query_of_their_own(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint").repartition(3)

    def first(*args):
        raise AssertionError("a query of its own")

    with monkeypatch.context() as patch:
        patch.setattr(type(edges), "first", first)
        found = components(edges)
    assert {r["node"]: r["component"] for r in found.collect()} == {i: 0 for i in range(1, 41)} | {101: 100}


def test_no_edges(spark):
    for edges in ([], [(3, 3)]):
        assert components(spark.createDataFrame(edges, "a bigint, b bigint")).count() == 0


def test_near_stage_leaves_little_to_the_driver(spark, monkeypatch):
    """No small side of a join becomes a hash table in the driver, and where nothing is alike no query follows."""
    texts = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    names, plans = [], []

    def stored(df, name, **options):
        kept = common_stored(df, name, **options)
        names.append(name)
        if not name.startswith("wanted-filter"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept

    common_stored = common.stored
    for module in (common, near_texts, components_module, exact_dedup):
        monkeypatch.setattr(module, "stored", stored)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(k, None) for k in keys]
    assert corpus_pipeline.near(spark, docs, "").count() == 30
    assert "components" not in names and "near-links" not in names and names.count("wanted-filter") == 1
    alike = docs.unionAll(docs.selectExpr("doc_id + 100", "concat(text, ' end')"))
    assert corpus_pipeline.near(spark, alike, "").count() == 30
    assert "components" in names and not any("BroadcastHashJoin" in p and "wanted-filter" not in p for p in plans)
    assert [spark.conf.get(k, None) for k in keys] == before
