import math
import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from cuota.functions.dates import as_date
from cuota.operators.consolidate import repeated_keys, union_institutions
from cuota.operators.entities import look_up
from cuota.operators.portfolio import (adjust_cutoffs, adjusted_cutoff, composition, composition_matrix,
                                       consolidate_portfolio, cutoff_composition, dense_composition, stack_bases,
                                       trailing_share)
from cuota.operators.shares import absent_values, distinct_values, monthly_cards, monthly_credit, period_bounds, share_cap
from cuota.plans.market_share import market_share_report, write_report
from cuota.specs import CARDS, PORTFOLIO


def month(n):
    return date(2023 + n // 12, n % 12 + 1, 1)


@pytest.fixture(scope="module")
def facts():
    rng = random.Random(7)
    rows = [(month(m), bank, product, round(rng.uniform(1, 1000), 2)) for m in range(30) if m != 20
            for bank in "ABC" for product in ("Consumo", "TC", "Vivienda") if rng.random() < 0.8]
    rows += [(month(29), "D", "TC", -5.0), (month(29), "E", "TC", 0.0)]
    rows = [r if r[0] != month(15) else (*r[:3], 0.0) for r in rows]  # a month that adds up to nothing
    return rows


@pytest.fixture(scope="module")
def portfolio(spark, facts):
    return spark.createDataFrame(facts, PORTFOLIO.schema).repartition(3)


def test_trailing_share_like_a_loop(portfolio, facts):
    last = month(25)
    base, totals = defaultdict(float), defaultdict(float)
    for m, bank, product, amount in facts:
        if month(2) <= m <= last:
            base[m, bank, product] += amount
            totals[m] += amount
    rows = trailing_share(portfolio, "2025-02-17", scale=2).collect()
    assert [(r.mes, r.banco, r.producto) for r in rows] == sorted(base)
    for r in rows:
        assert math.isclose(r.monto_mes, base[r.mes, r.banco, r.producto], abs_tol=1e-9)
        if r.mes == month(15):
            assert r.total_mes == 0 and r.share_mes is None
        else:
            assert math.isclose(r.share_mes, base[r.mes, r.banco, r.producto] / totals[r.mes], rel_tol=1e-12)
    sums = defaultdict(float)
    for r in rows:
        sums[r.mes] += r.share_mes or 0.0
    assert all(math.isclose(s, 1.0) for m, s in sums.items() if m != month(15))


def test_exact_and_plain_sums_agree(portfolio):
    exact = trailing_share(portfolio, "2025-02-17", scale=2).collect()
    plain = trailing_share(portfolio, as_date("2025-02-17")).collect()
    for a, b in zip(exact, plain, strict=True):
        assert tuple(a)[:3] == tuple(b)[:3] and math.isclose(a.monto_mes, b.monto_mes, abs_tol=1e-9)


def test_cutoffs(portfolio):
    got = {str(r.pedido): str(r.corte) for r in adjust_cutoffs(
        portfolio, ["2020-01-31", "2024-05-20", "2030-01-01"]).collect()}
    assert got == {"2020-01-31": "2023-01-01", "2024-05-20": "2024-05-01", "2030-01-01": "2025-06-01"}
    assert adjusted_cutoff(portfolio, "2030-01-01") == month(29)
    with pytest.raises(Exception, match="is empty"):
        adjust_cutoffs(portfolio.limit(0), ["2024-05-20"]).collect()


def test_composition(portfolio):
    rows = cutoff_composition(portfolio, "2025-06-30", scale=2).collect()
    by_bank = defaultdict(list)
    for r in rows:
        by_bank[r.banco].append(r)
    for bank in "ABC":
        assert math.isclose(sum(r.share_producto for r in by_bank[bank]), 1.0)
    assert by_bank["D"][0].share_producto is None and by_bank["E"][0].share_producto is None
    whole = composition(trailing_share(portfolio, "2025-06-30", scale=2), "2025-06-30", scale=2).collect()
    assert sorted(map(str, whole)) == sorted(map(str, rows))
    assert cutoff_composition(portfolio, "2024-09-30").isEmpty()  # the month without rows


def test_dense_views(portfolio):
    mix = cutoff_composition(portfolio, "2025-06-30", scale=2)
    present = {(r.banco, r.producto): r.share_producto for r in mix.collect()}
    products = sorted({p for _, p in present})
    dense = {(r.banco, r.producto): r.share_producto for r in dense_composition(mix, products).collect()}
    assert set(dense) == {(b, p) for b in "ABCDE" for p in products}
    assert all(dense[k] == v for k, v in present.items())
    for r in stack_bases(mix, products).collect():
        below = sum(dense[r.banco, p] or 0.0 for p in products if p < r.producto)
        assert math.isclose(r.base, below, abs_tol=1e-12)
    matrix = composition_matrix(mix, products).collect()
    assert [r.banco for r in matrix] == list("ABCDE")
    assert all(r[p] == dense[r.banco, p] for r in matrix for p in products)
    for view in (dense_composition, stack_bases, composition_matrix):  # the products of the data, or none left out
        assert sorted(map(str, view(mix).collect())) == sorted(map(str, view(mix, products).collect()))
        with pytest.raises(Exception, match=f"products not listed: {products[-1]}"):
            view(mix, products[:-1]).collect()


def test_a_product_nobody_listed_is_in_the_dense_views(spark, portfolio):
    more = spark.createDataFrame([(date(2025, 6, 1), "A", "ZZ nuevo", 5.0)], PORTFOLIO.schema)
    mix = cutoff_composition(portfolio.unionAll(more), "2025-06-30", scale=2)
    assert "ZZ nuevo" in {r.producto for r in stack_bases(mix).collect()}
    assert "ZZ nuevo" in composition_matrix(mix).columns


def test_consolidation_drops_null_keys_and_strips(spark):
    rows = [(month(0), " A ", "TC", 1.0), (month(0), " A ", "TC", 2.0), (None, "A", "TC", 4.0), (month(0), None, "TC", 8.0)]
    df = spark.createDataFrame(rows, PORTFOLIO.schema)
    assert [tuple(r) for r in consolidate_portfolio([df, df]).collect()] == [(month(0), "A", "TC", 6.0)]


def test_summaries(spark, portfolio):
    shares = trailing_share(portfolio, "2025-06-30")
    assert [r[0] for r in distinct_values(shares, "banco").collect()] == list("ABCDE")
    assert tuple(period_bounds(shares).first()) == (month(6), month(29), "Jul-23 a Jun-25")
    half = spark.createDataFrame([(0.5,), (0.25,), (None,)], "share double")
    assert share_cap(half, "share").first()[0] == 0.6
    assert share_cap(spark.createDataFrame([(0.9,)], "share double"), "share").first()[0] == 1.0


def test_monthly_shares(spark):
    credit = spark.createDataFrame([
        (date(2025, 1, 31), "X", "Consumo", 10.0, 5.0, 15.0), (date(2025, 1, 15), "X", "CONSUMO", 0.0, 5.0, 5.0),
        (date(2025, 1, 31), "ERROR", "consumo", 60.0, 0.0, 60.0), (date(2025, 2, 28), "X", "Consumo", 0.0, 0.0, 0.0),
        (None, "X", "Consumo", 1.0, 1.0, 2.0), (date(2025, 1, 31), "X", "Vivienda", 7.0, 0.0, 7.0),
    ], "fecha date, entidad string, actividad string, cartera_vigente double, cartera_vencida double, cartera_total double")
    for scale in (None, 2):
        assert [tuple(r) for r in monthly_credit(credit, "consumo", scale=scale).collect()] == [
            (None, "X", 2.0, 1.0, None, 0.5), (month(24), "ERROR", 60.0, 0.0, 0.75, 0.0),
            (month(24), "X", 20.0, 10.0, 0.25, 0.5), (month(25), "X", 0.0, 0.0, None, None)]
    cards = spark.createDataFrame([(date(2025, 1, 31), "X", "SALDO", 1.0), (date(2025, 1, 31), "Y", "SALDO", 3.0)],
                                  "fecha date, entidad string, clasificacion string, total double")
    assert [r.share for r in monthly_cards(cards, "Saldo").collect()] == [0.25, 0.75]


def test_unions_need_every_column(spark):
    whole = spark.createDataFrame([], CARDS.schema)
    with pytest.raises(ValueError, match="missing columns total"):
        union_institutions([whole, whole.drop("total")], CARDS)
    index = spark.createDataFrame([("a",), ("a",), ("b",)], "sub_rubro_base string")
    assert [tuple(r) for r in repeated_keys(index).collect()] == [("a", 2)]


def test_report_files(spark, portfolio, tmp_path):
    write_report(portfolio, str(tmp_path), "2031-01-01", scale=2)
    shares, mix = market_share_report(portfolio, "2025-06-30", scale=2)
    for name, df in (("share_24m", shares), ("compo_cutoff", mix)):
        back = spark.read.option("header", True).schema(df.schema).csv(f"{tmp_path}/{name}")
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="is empty|no portfolio rows"):
        write_report(portfolio.limit(0), str(tmp_path))


def test_a_lookup_key_listed_twice_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "code long")
    names = spark.createDataFrame([(1, "a"), (3, "c"), (None, "x"), (None, "y")], "k long, v string")
    got = look_up(df, names, df["code"], F.lit("?"), "name").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(["(1, 'a')", "(2, '?')", "(None, '?')"])
    twice = names.unionByName(names)
    with pytest.raises(Exception, match="lookup key listed twice: "):
        look_up(df, twice, df["code"], F.lit("?"), "name").collect()


def test_asked_values_without_rows(spark):
    df = spark.createDataFrame([("Consumo",), ("otro",), (None,)], "actividad string")
    got = absent_values(df, "actividad", ["consumo", "Vivienda", "X"]).collect()
    assert sorted(map(tuple, got)) == [("actividad", "VIVIENDA"), ("actividad", "X")]
    assert absent_values(df.limit(0), "actividad", ["a"]).count() == 1
