import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cuota.operators.entities import group_banks
from cuota.operators.portfolio import consolidate_portfolio
from cuota.operators.sheets import body_rows, rejected_months, select_sheets, unpivot_wide_sheets
from cuota.specs import CARD_SHEET, CREDIT_SHEET, SHEET_ROWS_DDL, SheetTarget

CREDIT, CARD = CREDIT_SHEET.sheet, CARD_SHEET.sheet


def cell(value):
    if value is None:
        return None, None
    if isinstance(value, date):
        return f"{value} 00:00:00", "d"
    if isinstance(value, (int, float)):
        return str(value), "n"
    return value, "s"


def sheet(file, name, lines):
    rows = []
    for row_no, line in enumerate(lines):
        pairs = [cell(v) for v in [None, *line]]
        rows.append((file, name, 0, row_no, [p[0] for p in pairs], [p[1] for p in pairs]))
    return rows


FIXTURE = [
    ["título"],
    ["Fecha", "Sector x", None, "Z"],  # no institutions: not the header
    ["Fecha", "Sector x", "ATLAS", "FAMILIAR", None, "Z"],
    [date(2025, 1, 31), "Consumo", 10.0, 20.0, 99, 99],
    [None, "Vivienda", None, 5.0],
    [45716, "CONSUMO PERSONAS FÍSICAS", 1.0, 2.0],
    ["2025/3", "Otro sector", 7, 7],
    [None, "Consumo", 3.0, 4.0],
    ["Total general", None, 1, 1],
    ["2025/4", "Consumo", 9, 9],
    ["not a month", "Consumo", 9, 9],
]
EXPECTED = [
    (date(2025, 1, 1), "ATLAS/FAMILIAR", "Consumo", 30.0), (date(2025, 1, 1), "ATLAS/FAMILIAR", "Vivienda", 5.0),
    (date(2025, 2, 1), "ATLAS/FAMILIAR", "Consumo", 3.0), (date(2025, 3, 1), "ATLAS/FAMILIAR", "Consumo", 7.0),
]


@pytest.mark.parametrize("chunk_rows", [1, 2, 3, 65_536])
def test_fixture_in_any_row_order(spark, chunk_rows):
    rows = sheet("b.xlsx", CREDIT, FIXTURE)
    random.Random(chunk_rows).shuffle(rows)
    df = spark.createDataFrame(rows, SHEET_ROWS_DDL).repartition(4)
    facts = consolidate_portfolio([unpivot_wide_sheets(df, chunk_rows=chunk_rows)])
    assert sorted(map(tuple, facts.collect())) == EXPECTED


def test_card_sheet_and_unknown_names(spark):
    lines = [["Fecha", "Clasificación", "Itaú ", "d'oro  tu-fin", 2020], ["2025-01-15", "Saldo", 1, 2.5, 3],
             [None, "Cantidad", 4, 4, 4], [0, "SALDO", 5]]
    df = spark.createDataFrame(sheet("f.xlsx", CARD, lines) + sheet("f.xlsx", "Otra", lines), SHEET_ROWS_DDL)
    got = sorted(map(tuple, unpivot_wide_sheets(df).collect()))
    month = date(2025, 1, 1)
    assert got == [(month, "2020", "TC", 3.0), (month, "D'Oro Tu-Fin", "TC", 2.5), (month, "ITAU", "TC", 1.0),
                   (month, "ITAU", "TC", 5.0)]


def test_unreadable_month(spark):
    lines = [["Fecha", "Sector", "BNF"], ["2025/02/30", "Consumo", 1], ["2025/03", "Consumo", 2]]
    df = spark.createDataFrame(sheet("f.xlsx", CREDIT, lines), SHEET_ROWS_DDL)
    with pytest.raises(Exception, match="unreadable month"):
        unpivot_wide_sheets(df).collect()
    kept = unpivot_wide_sheets(df, on_bad_month="null").collect()
    assert [tuple(r) for r in kept] == [(date(2025, 3, 1), "BNF", "Consumo", 2.0)]
    assert [tuple(r) for r in rejected_months(df).collect()] == [("f.xlsx", CREDIT, 1, "2025/02/30", "Consumo")]


def laid_out(rng, facts, names):
    """A credit sheet that states the given facts, ordered by month: title, header, one line per month and product with
    the month on its first line only, lines of no product and empty lines in between, and an end line with more behind."""
    lines = [["Boletín"], [], ["Fecha", "Sector económico", *names, None, "no"]]
    for month in sorted({m for m, *_ in facts}):
        shown = [month]
        products = sorted({p for m, _, p, _ in facts if m == month})
        for product in products:
            values = {n: v for m, n, p, v in facts if (m, p) == (month, product)}
            lines.append([shown.pop() if shown else None, product, *[values.get(n) for n in names], 77, 77])
            lines += rng.choice([[], [[None, "Otro", *[1.0] * len(names)]], [[]], [[None, None, 3]]])
    return [*lines, ["Total general", None, 9, 9], [date(2030, 1, 1), "Consumo", *[5.0] * len(names)]]


@pytest.mark.parametrize("seed", range(4))
def test_generated_facts_come_back(spark, seed):
    rng = random.Random(seed)
    rows, expected = [], []
    for number in range(6):
        names = rng.sample(["BNF", "GNB", "BASA", "UENO"], rng.randint(1, 4))
        months = rng.sample([date(2024, m, 1) for m in range(1, 13)], rng.choice([1, 5, 12]))
        facts = [(m, n, p, rng.choice([0.0, 1.5, 2.0])) for m in months for p in ("Consumo", "Vivienda") for n in names
                 if rng.random() < 0.7]
        rows += sheet(f"{number}.xlsx", CREDIT, laid_out(rng, facts, names))
        expected += facts
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SHEET_ROWS_DDL).repartition(3)
    named = {n: g for n, g in spark.createDataFrame([(n,) for n in ("BNF", "GNB", "BASA", "UENO")], "n string").transform(
        lambda d: group_banks(d, "n")).select("n", "banco").collect()}
    for chunk_rows in (1, 4, 64):
        got = unpivot_wide_sheets(df, chunk_rows=chunk_rows).collect()
        assert sorted(map(tuple, got)) == sorted((m, named[n], p, v) for m, n, p, v in expected)


def test_rows_of_a_null_file_come_back(spark):
    lines = [["Fecha", "Sector", "BNF"], ["2025/03", "Consumo", 2]]
    df = spark.createDataFrame(sheet(None, CREDIT, lines), SHEET_ROWS_DDL)
    assert [tuple(r) for r in unpivot_wide_sheets(df).collect()] == [(date(2025, 3, 1), "BNF", "Consumo", 2.0)]


def test_only_needed_rows_are_shuffled(spark):
    df = spark.createDataFrame(sheet("b.xlsx", CREDIT, FIXTURE), SHEET_ROWS_DDL)
    assert body_rows(df).count() == 4


def test_first_matching_sheet(spark):
    titles = ["Índice", "5. Créd. por Sector", "Etcétera", "7. E. TC", "EEFF 2025", "Cred sector 2"]
    df = spark.createDataFrame([("b", t, i) for i, t in enumerate(titles)], "file string, sheet string, sheet_pos int")
    got = {r.target: r.sheet for r in select_sheets(df.repartition(3)).collect()}
    assert got == {"EEFF": "EEFF 2025", "TC": "Etcétera", "Credito Sector": "5. Créd. por Sector"}
    assert select_sheets(df, (SheetTarget("x", "X", ("nada",)),)).isEmpty()


def test_values_must_be_numbers(spark):
    for text in ("n/d", "12d"):  # the latter is a number in Java's spelling only
        lines = [["Fecha", "Sector", "BNF"], ["2025/03", "Consumo", text]]
        df = spark.createDataFrame(sheet("f.xlsx", CREDIT, lines), SHEET_ROWS_DDL)
        with pytest.raises(Exception, match=f"no number: {text}"):
            unpivot_wide_sheets(df).select(F.sum("monto")).collect()


def test_groups_per_header_and_per_cell_agree(spark):
    lines = [["Fecha", "Sector", "BNF", "atlas", "Itaú ", "d'oro"], ["2025/03", "Consumo", 1, 2, 3, 4]]
    df = spark.createDataFrame(sheet("f.xlsx", CREDIT, lines), SHEET_ROWS_DDL)
    as_table = spark.createDataFrame([("ATLAS", "Grupo A"), ("BNF", "Grupo B")], "k string, v string")
    for mapping, lookup in (({"ATLAS": "Grupo A", "BNF": "Grupo B"}, as_table), ({}, as_table.limit(0))):
        per_header, per_cell = (unpivot_wide_sheets(df, groups=g).collect() for g in (mapping, lookup))
        assert sorted(map(tuple, per_header)) == sorted(map(tuple, per_cell)) and len(per_cell) == 4
