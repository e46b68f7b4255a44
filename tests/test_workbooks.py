import csv
import io
import json
import os
import zipfile
from datetime import date
from xml.sax.saxutils import escape

import pytest
from pyspark.sql import functions as F

from cuota.operators.sheets import missing_sheets, select_sheets
from cuota.plans.market_share import load_portfolio, open_portfolio
from cuota.sinks.files import export_sheets, write_manifest
from cuota.sources.listing import is_valid_file, list_files
from cuota.sinks.tables import read_table, write_table
from cuota.sources.workbooks import read_workbooks, rejected_workbooks, whole_workbooks, workbook_sheets
from cuota.sources.staging import read_bulletin
from cuota.specs import CARD_SHEET, CREDIT_SHEET, EXPORTED_FILES

SPREADSHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook(sheets):
    """Bytes of a workbook; sheets is {title: [row of cells or None for a row left out]}."""
    strings, out = [], io.BytesIO()

    def cell(row, column, value):
        ref = f'r="{chr(65 + column)}{row}"'
        if isinstance(value, date):
            return f'<c {ref} s="1"><v>{(value - date(1899, 12, 30)).days}</v></c>'
        if isinstance(value, bool):
            return f'<c {ref} t="b"><v>{int(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c {ref}><v>{value}</v></c>'
        if value.startswith("="):
            return f'<c {ref} t="str"><f>x</f><v>{escape(value[1:])}</v></c>'
        strings.append(value)
        return f'<c {ref} t="s"><v>{len(strings) - 1}</v></c>'

    with zipfile.ZipFile(out, "w") as archive:
        names = "".join(f'<sheet name="{escape(t)}" sheetId="{i}" r:id="rId{i}"/>' for i, t in enumerate(sheets, 1))
        archive.writestr("xl/workbook.xml",
                         f'<workbook xmlns="{SPREADSHEET}" xmlns:r="{RELATIONS}"><sheets>{names}</sheets></workbook>')
        archive.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)
        ) + "</Relationships>")
        archive.writestr("xl/styles.xml", f'<styleSheet xmlns="{SPREADSHEET}"><cellXfs><xf numFmtId="0"/>'
                                          '<xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(
                f'<row r="{n}">' + "".join(cell(n, c, v) for c, v in enumerate(row) if v is not None) + "</row>"
                for n, row in enumerate(rows, 1) if row is not None)
            archive.writestr(f"xl/worksheets/sheet{i}.xml",
                             f'<worksheet xmlns="{SPREADSHEET}"><sheetData>{body}</sheetData></worksheet>')
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{SPREADSHEET}">' + "".join(
            f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r><rPh><t>!</t></rPh></si>" for s in strings)
            + "</sst>")
    return out.getvalue()


def credit(*amounts):
    return [[None, "Boletín"], None, [None, "Fecha", "Sector", "ATLAS", "Itaú"],
            [None, date(2025, 1, 31), "Consumo", *amounts], [None, "2025/2", "Vivienda", *amounts], [None, "Total"]]


@pytest.fixture()
def folder(tmp_path):
    cards = [[None, "Fecha", "Clase", "ATLAS"], [None, 45716, "Saldo", 7]]
    (tmp_path / "tabla_de_bancos.xlsx").write_bytes(workbook({
        "Índice": [["a,b", 'c"d', None, 1.5, True, "=x\ny"], None, ["z"]], CREDIT_SHEET.sheet: credit(10, 20.5),
        CARD_SHEET.sheet: cards}))
    (tmp_path / "tabla_de_financieras.xlsx").write_bytes(workbook({CREDIT_SHEET.sheet: credit(1, None), "EEFF": [["k"]],
                                                                   CARD_SHEET.sheet: cards}))
    return tmp_path


def test_rows(spark, folder):
    rows = read_workbooks(spark, f"{folder}/*.xlsx")
    index = rows.filter("sheet = 'Índice'").orderBy("row_no").collect()
    assert [(r.row_no, r.cells) for r in index] == [(0, ["a,b", 'c"d', None, "1.5", "1", "x\ny"]), (1, []), (2, ["z"])]
    assert index[0].types == ["s", "s", None, "n", "b", "s"]
    dated = rows.filter(F.col("file").endswith("bancos.xlsx") & (F.col("sheet") == CREDIT_SHEET.sheet)
                        & (F.col("row_no") == 3)).first()
    assert dated.cells == [None, "2025-01-31 00:00:00", "Consumo", "10", "20.5"]
    assert dated.types == [None, "d", "s", "n", "n"]
    assert workbook_sheets(rows).count() == 6


def test_portfolio_from_workbooks(spark, folder):
    books = [f"{folder}/tabla_de_bancos.xlsx", f"{folder}/tabla_de_financieras.xlsx"]
    load_portfolio(spark, books, f"{folder}/rows", f"{folder}/cartera_pf", scale=2)
    got = sorted(map(tuple, open_portfolio(spark, f"{folder}/cartera_pf").collect()))
    jan, feb = date(2025, 1, 1), date(2025, 2, 1)
    assert got == [(jan, "ATLAS/FAMILIAR", "Consumo", 11.0), (jan, "ITAU", "Consumo", 20.5),
                   (feb, "ATLAS/FAMILIAR", "TC", 14.0), (feb, "ATLAS/FAMILIAR", "Vivienda", 11.0),
                   (feb, "ITAU", "Vivienda", 20.5)]
    with pytest.raises(FileNotFoundError):
        load_portfolio(spark, [f"{folder}/nada.xlsx"], f"{folder}/r", f"{folder}/c")


def test_sheet_export(spark, folder):
    rows = read_workbooks(spark, f"{folder}/*.xlsx")
    export_sheets(rows, f"{folder}/out")
    outputs = {name.split("=")[1] for name in os.listdir(f"{folder}/out") if "=" in name}
    assert outputs == {"CSBI", "TCBI", "CSFI", "TCFI", "ERFI"}
    (book,) = [name for name in os.listdir(f"{folder}/out/salida=CSBI") if name.startswith("libro=")]
    (part,) = [name for name in os.listdir(f"{folder}/out/salida=CSBI/{book}") if name.startswith("part-")]
    text = open(f"{folder}/out/salida=CSBI/{book}/{part}", encoding="utf-8").read()
    assert list(csv.reader(io.StringIO(text))) == [
        ["", "Boletín"], [], ["", "Fecha", "Sector", "ATLAS", "Itaú"],
        ["", "2025-01-31 00:00:00", "Consumo", "10", "20.5"], ["", "2025/2", "Vivienda", "10", "20.5"], ["", "Total"]]


def test_exported_tidy_sheets_are_staging_tables(spark, tmp_path):
    credit_rows = [["Fecha", "Código Entidad", "Actividad Destino VS2", "Cartera Vencida", "Cartera Vigente"],
                   [date(2025, 1, 31), 1046, 'Consumo "x",\ny', 0.10000000000000001, 2]]
    cards = [["Fecha", "Código Entidad", "Clasificación", "Total"], [date(2025, 1, 31), 1046, "Saldo", 5]]
    income = [["Fecha", "Código Entidad", "Sub Rubro", "Código Moneda", "Importe", "Reporte"],
              [date(2025, 1, 31), 1046, "Otros", 1, 1e-3, True]]
    for month in ("2025-01", "2025-02"):
        (tmp_path / month).mkdir()
        for name in ("bancos", "financieras"):
            (tmp_path / month / f"tabla_de_{name}.xlsx").write_bytes(workbook(
                {"EEFF": income, "E. TC": cards, "Cred. por sector": credit_rows}))
    export_sheets(read_workbooks(spark, f"{tmp_path}/*/*.xlsx"), f"{tmp_path}/out")
    staging = read_bulletin(spark, f"{tmp_path}/out", EXPORTED_FILES, multi_line=True)
    day = date(2025, 1, 31)
    for side in ("bi", "fi"):
        assert [tuple(r) for r in staging[f"cs{side}"].collect()] == [(day, 1046, 'Consumo "x",\ny', 0.1, 2.0)] * 2
        assert [tuple(r) for r in staging[f"tc{side}"].collect()] == [(day, 1046, "Saldo", 5.0)] * 2
        assert [tuple(r) for r in staging[f"er{side}"].collect()] == [(day, 1046, "Otros", 1, 0.001, "True")] * 2


def test_manifest(spark, folder):
    files = list_files(spark, str(folder), "*.xlsx")
    listed = files.collect()
    assert [r.filename for r in listed] == ["tabla_de_bancos.xlsx", "tabla_de_financieras.xlsx"]
    assert [r.size for r in listed] == [os.path.getsize(f"{folder}/{r.filename}") for r in listed]
    write_manifest(files, f"{folder}/manifest", "2025-08-01T10:00:00")
    parts = sorted(p for p in os.listdir(f"{folder}/manifest") if p.startswith("part-"))
    lines = [json.loads(line) for p in parts for line in open(f"{folder}/manifest/{p}", encoding="utf-8")]
    assert [list(line) for line in lines] == [["timestamp", "filename", "path", "size", "modified"]] * 2
    assert sorted(line["filename"] for line in lines) == [r.filename for r in listed]
    assert {line["timestamp"] for line in lines} == {"2025-08-01T10:00:00"}


def test_valid_files(spark):
    rows = [("a.xlsx", 1024), ("a.XLS", 104857600), ("a.xlsx", 1023), ("a.xls", 104857601), ("a.csv", 5000),
            ("dir.xls/a", 5000)]
    df = spark.createDataFrame(rows, "path string, size long")
    assert [r[0] for r in df.select(is_valid_file(F.col("path"), F.col("size"))).collect()] == [
        True, True, False, False, False, False]


def test_a_damaged_workbook_is_told_and_left_out(spark, folder):
    whole = (folder / "tabla_de_bancos.xlsx").read_bytes()
    (folder / "cortado.xlsx").write_bytes(whole[: len(whole) // 2])
    broken = workbook({CREDIT_SHEET.sheet: credit(5, 5), CARD_SHEET.sheet: [[None, "x"]]})
    text = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(broken)) as source, zipfile.ZipFile(text, "w") as target:
        for name in source.namelist():
            target.writestr(name, source.read(name)[: -20 if name.endswith("sheet2.xml") else None])
    (folder / "roto.xlsx").write_bytes(text.getvalue())  # its first sheet can be read
    with pytest.raises(Exception, match="BadZipFile|ParseError"):
        read_workbooks(spark, f"{folder}/*.xlsx").collect()
    rows = read_workbooks(spark, f"{folder}/*.xlsx", on_bad_file="reject")
    told = {r.file.rsplit("/", 1)[1]: r.problem.split(":")[0] for r in rejected_workbooks(rows).collect()}
    assert told == {"cortado.xlsx": "BadZipFile", "roto.xlsx": "ParseError"}
    kept = {r.file.rsplit("/", 1)[1] for r in whole_workbooks(rows).select("file").distinct().collect()}
    assert kept == {"tabla_de_bancos.xlsx", "tabla_de_financieras.xlsx"}
    load_portfolio(spark, [f"{folder}/*.xlsx"], f"{folder}/rows", f"{folder}/cartera_pf", on_bad_file="reject", scale=2)
    assert open_portfolio(spark, f"{folder}/cartera_pf").agg(F.sum("monto")).first()[0] == 11 + 20.5 + 14 + 11 + 20.5
    with pytest.raises(ValueError, match="on_bad_file"):
        read_workbooks(spark, str(folder), on_bad_file="x")


def test_sheets_without_rows_are_seen(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook({"EEFF": [], "EEFF 2": [["k"]]}))
    sheets = workbook_sheets(read_workbooks(spark, f"{tmp_path}/*.xlsx"))
    assert [(r.target, r.sheet) for r in select_sheets(sheets).collect()] == [("EEFF", "EEFF")]
    assert sorted(r.target for r in missing_sheets(sheets).collect()) == ["Credito Sector", "TC"]


def test_a_refresh_may_read_what_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/tabla"
    table = write_table(spark.range(5), path)
    assert sorted(r.id for r in write_table(table.select((F.col("id") + 1).alias("id")), path).collect()) == [1, 2, 3, 4, 5]
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        write_table(broken, path)
    assert read_table(spark, path).count() == 5


def test_a_table_is_there_at_every_step_of_its_replacement(spark, tmp_path):
    """Whatever a failed job leaves behind, the former version is read; the one before it goes, and so do remains."""
    path = f"{tmp_path}/tabla"
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    for rows in (1, 2, 3):
        former = write_table(spark.range(rows), path)
    assert sorted(p.name for p in (tmp_path / "tabla").iterdir()) == ["v-000000002", "v-000000003"]
    unfinished = tmp_path / "tabla" / "v-000000004"
    spark.range(9).write.parquet(str(unfinished))
    (unfinished / "_SUCCESS").unlink()  # as a crash before the last step leaves it
    assert read_table(spark, path).count() == 3
    assert write_table(former.unionAll(former), path).count() == 6 and former.count() == 3
    assert sorted(p.name for p in (tmp_path / "tabla").iterdir()) == ["v-000000003", "v-000000005"]
