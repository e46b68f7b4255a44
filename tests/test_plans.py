"""Physical plans: what is pushed down, what is shuffled, and what never happens."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from cuota.operators.entities import look_up
from cuota.operators.portfolio import consolidate_portfolio, cutoff_composition, trailing_share
from cuota.plans import bindings
from cuota.plans.queries import QUERIES
from cuota.session import scratch_path
from cuota.sinks.tables import refresh_table
from cuota.specs import PORTFOLIO

SF = "/root/testdata/sf0.001"
WITH_PYTHON = {"link_methods", "link_extract", "link_dedupe", "link_categorize", "link_first"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fact_shuffles(df):
    """Hash exchanges but for those of lookup tables."""
    lines = [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]
    return sum("hashpartitioning(_lookup_key" not in line for line in lines)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_python_only_for_pages(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("MapInPandas" in text) == (name in WITH_PYTHON)
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    assert text.count("MapInPandas") <= 1  # a page is parsed once


def test_the_window_reaches_the_scan(spark):
    text = plan(queries()["trailing_share"](spark, SF))
    for column in ("o_orderdate", "l_shipdate"):
        assert f"GreaterThanOrEqual({column},1999-04-01T00:00)" in text
    assert "l_quantity" not in text and "o_orderstatus" not in text


def test_stored_portfolio_is_pruned_by_month(spark):
    facts = consolidate_portfolio([bindings.portfolio(spark, SF)], scale=2)
    table = refresh_table(facts, scratch_path(spark, "cartera_pf"), PORTFOLIO, sort_by=["fecha", "banco", "producto"])
    text = plan(trailing_share(table, "2001-03-31"))
    assert "GreaterThanOrEqual(fecha,1999-04-01), LessThanOrEqual(fecha,2001-03-01)" in text
    text = plan(cutoff_composition(table, "2001-03-31"))
    assert "GreaterThanOrEqual(fecha,2001-03-01), LessThanOrEqual(fecha,2001-03-01)" in text


def test_each_family_is_shuffled_once(spark):
    for name in ("credit_consolidated", "card_consolidated", "portfolio_consolidated", "sheet_select", "link_extract"):
        spread = int(name == "link_extract")  # the pages that pass the gate are dealt out before they are parsed
        text = plan(df := queries()[name](spark, SF))
        assert text.count("REPARTITION_BY_COL") == spread and fact_shuffles(df) == 1 + spread, name


def test_shared_work_is_computed_once(spark):
    df = queries()["trailing_share"](spark, SF)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet [o_custkey") == 1


def test_lookups_are_broadcast_by_size_alone(spark):
    names = {i: f"n{i}" for i in range(100_001)}
    df = spark.range(10).withColumn("code", F.col("id"))
    for lookup in ({1: "a"}, names):
        found = look_up(df, lookup, df["code"], F.lit("?"), "name")
        assert "strategy=broadcast" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in plan(look_up(df, {1: "a"}, df["code"], F.lit("?"), "name"))
    assert [r.name for r in found.orderBy("id").collect()] == [f"n{i}" for i in range(10)]


def test_dense_views_scan_each_table_once(spark):
    """The composition that is stored scans each fact table once; the views on it read that one small table alone."""
    def final(name):
        df = queries()[name](spark, SF)
        df.collect()
        return plan(df).split("Initial Plan")[0]

    text = final("cutoff_composition")
    assert text.count("orders.parquet") == 1 and text.count("lineitem.parquet") == 1
    for name in ("stack_base", "composition_matrix"):
        text = final(name)
        assert text.count("FileScan") == text.count("/composicion") == 1, name


def test_the_adjusted_window_reaches_the_scan(spark):
    text = plan(queries()["share_at_adjusted_cutoff"](spark, SF))
    for column in ("o_orderdate", "l_shipdate"):
        assert f"GreaterThanOrEqual({column}," in text and f"LessThan({column}," in text


def test_income_is_shuffled_by_key_alone(spark):
    assert fact_shuffles(queries()["income_consolidated"](spark, SF)) == 1
