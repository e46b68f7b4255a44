from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cuota.functions.amounts import to_double, to_whole
from cuota.operators.consolidate import profile_metrics
from cuota.plans.bulletin import load_bulletin, share_reports
from cuota.sources.listing import list_tables, require_paths
from cuota.sources.staging import (apply_types, normalize_column_name, normalize_columns, read_bulletin_with_rejects,
                                   read_csv_text, read_income_index, read_staging, rejected_bulletin, rejected_cells,
                                   typed_with_rejects)
from cuota.sinks.tables import drop_views, empty_table, write_table
from cuota.specs import CARDS, CREDIT, INCOME_INDEX, TableSpec

FILES = {
    "CSBI.csv": """Fecha,Código Entidad,Actividad  Destino VS2,Cartera Vencida,CARTERA_VIGENTE,sobra
2025-01-31,1039,Consumo,1.5,10,x
2025-01-31,1046,Consumo,2.5,20.25,x
2025-01-31,9999,CONSUMO,n/d,7,x
2025-01-31,,CONSUMO,,3,x
2025-02-28,1046,"Vivienda, nueva",,,x
""",
    "CSFI.csv": """cartera_vigente,cartera_vencida,actividad_destino_vs2,codigo_entidad,fecha
100,5,Consumo,2007,2025-01-31
1,1,Consumo,1.5,2025-01-31
""",
    "TCBI.csv": "fecha,codigo_entidad,clasificacion,total\n2025-01-31,1046,Saldo,4\n2025-01-31,1039,Saldo,6\n",
    "TCFI.csv": "fecha,codigo_entidad,clasificacion,total\n2025-01-31,2080,saldo,10\n",
    "ERBI.csv": """fecha,codigo_entidad,sub_rubro,codigo_moneda,importe,reporte
2025-01-31,1046,Intereses,1,10,B
2025-01-31,1046,Intereses,2,5,A
2025-01-31,1046,Otros,1,NA,NULL
""",
    "ERFI.csv": "fecha,codigo_entidad,sub_rubro,codigo_moneda,importe,reporte\n2025-01-31,2080,Comisiones,1,2,C\n",
}
INDEX = """Sub Rubro Base,Clasificación,Rubro,Sub Rubro Reporte
Intereses,I,R1,a
Intereses,I,R2,b
Otros,E,R3,c
"""


@pytest.fixture()
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return tmp_path


def test_column_names(spark):
    assert normalize_column_name("  Código  Entidad ") == "codigo_entidad"
    assert normalize_column_name("a   b") == "a__b"  # one pass only
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(spark.createDataFrame([(1, 2)], "`Año` int, `ano` int"))


def test_types(spark, folder):
    rows = read_staging(spark, f"{folder}/CSBI.csv", CREDIT).collect()
    assert [tuple(r) for r in rows][:3] == [
        (date(2025, 1, 31), 1039, "Consumo", 1.5, 10.0), (date(2025, 1, 31), 1046, "Consumo", 2.5, 20.25),
        (date(2025, 1, 31), 9999, "CONSUMO", None, 7.0)]
    assert rows[3].codigo_entidad is None and rows[4].actividad_destino_vs2 == "Vivienda, nueva"


def test_number_texts(spark):
    texts = ["1", " 2 ", "1.0", "1.5", "1e2", "12d", "0x1F", "NaN", "abc", "", "-.5", "9007199254740993", "inf", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [tuple(r) for r in df.select(to_double(df.t), to_whole(df.t)).collect()]
    assert got == [(1.0, 1), (2.0, 2), (1.0, 1), (1.5, None), (100.0, 100), (None, None), (None, None), (None, None),
                   (None, None), (None, None), (-0.5, None), (9007199254740992.0, 9007199254740993),
                   (float("inf"), None), (None, None)]


def test_rejected_cells_are_reported(spark, folder):
    text = normalize_columns(read_csv_text(spark, f"{folder}/CSFI.csv"))
    assert [r.rechazadas for r in rejected_cells(text, CREDIT).collect()] == [["codigo_entidad"]]


def test_bad_dates(spark):
    df = spark.createDataFrame([("31/31/2025", "1", "x", "1"), (None, "1", "x", "1")],
                               "fecha string, codigo_entidad string, clasificacion string, total string")
    with pytest.raises(Exception, match="bad date"):
        apply_types(df, CARDS).collect()
    assert [r.fecha for r in apply_types(df, CARDS, on_bad_date="null").collect()] == [None, None]
    assert rejected_cells(df, CARDS).count() == 1
    with pytest.raises(ValueError, match="missing columns total"):
        apply_types(df.drop("total"), CARDS)


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fecha,total\n2025-01-31,1\n")
    (tmp_path / "b.csv").write_text("total,fecha\n1,2025-01-31\n")
    with pytest.raises(Exception):
        read_csv_text(spark, str(tmp_path)).collect()


def test_missing_files(spark, folder):
    with pytest.raises(FileNotFoundError, match="nada.csv"):
        require_paths(spark, [f"{folder}/CSBI.csv", f"{folder}/nada.csv"])
    index = read_income_index(spark, f"{folder}/indice.csv")
    assert index.schema == INCOME_INDEX.schema and index.isEmpty()


def test_whole_bulletin(spark, folder):
    (folder / "indice.csv").write_text(INDEX, encoding="utf-8")
    out = load_bulletin(spark, str(folder), f"{folder}/out", index_path=f"{folder}/indice.csv", scale=2)
    credit = sorted((tuple(r) for r in out["credito_sector"].collect()), key=str)
    jan, feb = date(2025, 1, 31), date(2025, 2, 28)
    assert credit == sorted([
        (jan, "UENO", "Consumo", 130.25, 9.0, 139.25),        # 1039, 2007 and 1046 together
        (jan, "ERROR", "CONSUMO", 7.0, 0.0, 7.0),             # unknown code
        (jan, "ERROR", "CONSUMO", 3.0, 0.0, 3.0),             # null code: a row of its own
        (jan, "ERROR", "Consumo", 1.0, 1.0, 2.0),             # 1.5 is no code
        (feb, "UENO", "Vivienda, nueva", 0.0, 0.0, 0.0),      # nothing but nulls
    ], key=str)
    assert sorted(map(tuple, out["tarjetas"].collect())) == [
        (jan, "FIC", "SALDO", 10.0), (jan, "UENO", "SALDO", 10.0)]
    income = sorted((tuple(r) for r in out["estado_resultados"].collect()), key=str)
    assert income == sorted([
        (jan, "UENO", "I", "R1", "a", "Intereses", "A", 15.0), (jan, "UENO", "I", "R2", "b", "Intereses", "A", 15.0),
        (jan, "UENO", "E", "R3", "c", "Otros", None, 0.0), (jan, "FIC", None, None, None, "Comisiones", "C", 2.0),
    ], key=str)
    assert [tuple(r) for r in out["perfil"].orderBy("tabla").collect()] == [
        ("credito_sector", 5, jan, feb), ("estado_resultados", 4, jan, jan), ("tarjetas", 2, jan, jan)]
    assert "parquet" not in out["perfil"]._jdf.queryExecution().executedPlan().toString().lower()  # seen while writing
    reports = share_reports(out, scale=2)
    assert [(r.producto, r.entidad, r.share) for r in reports["credito"].collect()] == [
        ("CONSUMO", "ERROR", 12.0 / 151.25), ("CONSUMO", "UENO", 139.25 / 151.25)]
    assert [(r.clasificacion, r.entidad, r.share) for r in reports["tarjetas"].collect()] == [
        ("SALDO", "FIC", 0.5), ("SALDO", "UENO", 0.5)]
    assert [tuple(r) for r in reports["periodo_tarjetas"].collect()] == [
        ("SALDO", date(2025, 1, 1), date(2025, 1, 1), "Jan-25 a Jan-25")]
    assert reports["periodo_credito"].count() == 1
    assert ("actividad", "VIVIENDA") in {tuple(r) for r in reports["sin_filas"].collect()}
    assert ("csfi", ["codigo_entidad"]) in [(r.tabla, r.rechazadas) for r in out["rechazos"].collect()]
    assert [r.sub_rubro_base for r in out["claves_repetidas"].collect()] == ["Intereses"]


def test_files_are_read_once_for_rows_and_rejects(spark, folder):
    """The list of refused rows and the final tables come from one reading: the files may be gone by then."""
    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")

    apart = sorted(map(tuple, rejected_bulletin(spark, str(folder)).collect()), key=str)
    assert all(scans(df) == 1 for df in read_bulletin_with_rejects(spark, str(folder)).values())
    out = load_bulletin(spark, str(folder), f"{folder}/out", scale=2)
    for name in FILES:
        (folder / name).write_text("")
    assert all(scans(df) == 0 for df in out.values())
    assert sorted(map(tuple, out["rechazos"].collect()), key=str) == apart and len(apart) == 2
    assert out["credito_sector"].count() == 5


def test_no_staging_table_without_rejects(spark, folder):
    kept = load_bulletin(spark, str(folder), f"{folder}/a", scale=2)
    plain = load_bulletin(spark, str(folder), f"{folder}/b", scale=2, rejects=False)
    assert "rechazos" not in plain and not (folder / "b/staging").exists()
    for name in ("credito_sector", "tarjetas", "estado_resultados"):
        assert sorted(map(str, kept[name].collect())) == sorted(map(str, plain[name].collect()))


def test_rejects_beside_typed_rows(spark, folder):
    text = normalize_columns(read_csv_text(spark, f"{folder}/CSFI.csv"))
    both = typed_with_rejects(text, CREDIT)
    assert both.drop("rechazadas", "fila").collect() == apply_types(text, CREDIT).collect()
    assert [(r.rechazadas, "1.5" in (r.fila or "")) for r in both.collect()] == [(None, False), (["codigo_entidad"], True)]
    with pytest.raises(Exception, match="bad date"):
        typed_with_rejects(text.withColumn("fecha", F.lit("31/31/2025")), CREDIT).collect()
    clash = TableSpec("t", (("fila", LongType()),))
    with pytest.raises(ValueError, match="named like the added ones: fila"):
        typed_with_rejects(spark.createDataFrame([("1",)], "fila string"), clash)


def test_other_date_formats(spark, tmp_path):
    (tmp_path / "t.csv").write_text("fecha,codigo_entidad,clasificacion,total\n31/01/2025,1,x,2\n")
    with pytest.raises(Exception, match="bad date"):
        read_staging(spark, f"{tmp_path}/t.csv", CARDS).collect()
    got = read_staging(spark, f"{tmp_path}/t.csv", CARDS, date_formats=("dd/MM/yyyy",)).collect()
    assert [r.fecha for r in got] == [date(2025, 1, 31)]


def test_views_and_empty_tables(spark):
    empty_table(spark, CARDS).createOrReplaceTempView("em_tmp_b")
    empty_table(spark, CARDS).createOrReplaceTempView("em_tmp_a")
    assert list_tables(spark, "em_tmp_*") == ["em_tmp_a", "em_tmp_b"]
    drop_views(spark, "em_tmp_a", "em_tmp_b", "no_such_view")
    assert list_tables(spark, "em_tmp_*") == []


def test_metrics_are_taken_once_and_of_empty_tables_too(spark, tmp_path):
    """The shuffle by range samples the rows before it writes them; the sample must not be counted."""
    rows = spark.range(5000).select(F.expr("date_add(date'2020-01-01', int(id % 900))").alias("fecha"), "id")
    for name, df, expected in (("full", rows, (5000, date(2020, 1, 1), date(2022, 6, 18))),
                               ("empty", rows.where("id < 0"), (0, None, None)),
                               ("nothing", rows.limit(0), (0, None, None))):
        seen = Observation(name)
        write_table(df, f"{tmp_path}/{name}", sort_by=["fecha"], watch=(seen, profile_metrics()))
        assert tuple(seen.get[k] for k in ("filas", "min_fecha", "max_fecha")) == expected, name
