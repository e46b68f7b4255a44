"""The check tables seen as bulletin inputs: which column plays which part.

The tables are not bulletins, so every operator is bound to them through its column names. No rows are left out: each
pair of parts covers its table.
"""

from __future__ import annotations

from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuota.functions.amounts import total
from cuota.specs import INCOME_INDEX, LinkCategory, LinkSpec, Selector, SheetTarget, WideSheet

# Codes 3 and 7 merge into 1001 and 18 into 1002, which have no name; 11 merges into 12, which has one.
SUCCESSORS = {3: 1001, 7: 1001, 11: 12, 18: 1002}
INDEX_ROWS = [
    ("click", "INGRESOS", "COMISIONES", "Clics"),
    ("view", "INGRESOS", "INTERESES", "Vistas"),
    ("view", "EGRESOS", "INTERESES", "Vistas pagadas"),
    ("purchase", "EGRESOS", "GASTOS", "Compras"),
]
BANKS = {"NATION_1": "GRUPO NORTE", "NATION_2": "GRUPO NORTE", "NATION_12": "GRUPO SUR"}
CREDIT_LIKE = WideSheet("Credito", {"ECONOMY": "Economia", "PROMO": "Promocion", "SMALL": "Menudo", "MEDIUM": "Menudo"},
                        header_category="Sector")
CARD_LIKE = WideSheet("Tarjetas", {"1-URGENT": "TC"})
SHEET_LIKE = (
    SheetTarget("Urgente", "UR", ("urgent",)), SheetTarget("Alto F", "HF", ("high", " f")),
    SheetTarget("Bajo", "LO", ("low", "5")),
)
PAGE_LINKS = LinkSpec(
    base_url="https://boletin.example",
    categories=(
        LinkCategory("tabla_a", "Tabla A", "de", ("ll", "qu"), ("tabla a", "en", "qu"), "la"),
        LinkCategory("tabla_b", "Tabla B", "er", ("ing", "ei"), ("tabla b", "re", "in"), "th"),
    ),
    href_contains="e", href_excludes="de", item=Selector("nav"), item_title=Selector("ul"), item_links=Selector("li"),
    header_tags=("h1",), header_pattern="(de|er)", button_pattern="(e|i)n",
)
PAGE_FALLBACK = {"tabla_a": "https://boletin.example/a.xls?v=1", "tabla_b": "https://boletin.example/b/7f3c"}
PAGE_FILES = {"tabla_a": "archivo_a"}
PRODUCTS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "ECONOMY", "LARGE", "MEDIUM", "PROMO",
            "SMALL", "STANDARD")
_END_ROW = 2_000_000_000


# Declared, so that opening a table reads no file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


def entity_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("long"), "n_name")


def credit_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    overdue = F.col("l_returnflag") == "R"

    def part(rows: Column) -> DataFrame:
        return lines.filter(rows).select(
            F.to_date("l_shipdate").alias("fecha"), F.col("s_nationkey").cast("long").alias("codigo_entidad"),
            F.lower("p_type").alias("actividad_destino_vs2"),
            F.when(overdue, F.col("l_extendedprice")).alias("cartera_vencida"),
            F.when(~overdue, F.col("l_extendedprice")).alias("cartera_vigente"))

    return part(F.col("l_linestatus") == "O"), part(F.col("l_linestatus") != "O")


def card_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))

    def part(rows: Column) -> DataFrame:
        return orders.filter(rows).select(
            F.to_date("o_orderdate").alias("fecha"), F.col("c_nationkey").cast("long").alias("codigo_entidad"),
            F.lower("o_orderpriority").alias("clasificacion"), F.col("o_totalprice").alias("total"))

    return part(F.col("o_orderstatus") == "F"), part(F.col("o_orderstatus") != "F")


def income_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf, "events")

    def part(rows: Column) -> DataFrame:
        return events.filter(rows).select(
            F.to_date("ts").alias("fecha"), F.pmod("user_id", F.lit(25)).alias("codigo_entidad"),
            F.col("event_type").alias("sub_rubro"), F.pmod("event_id", F.lit(2)).alias("codigo_moneda"),
            F.col("value").alias("importe"), F.col("props").alias("reporte"))

    direct = F.col("event_type").isin("view", "click")
    return part(direct), part(~direct)


def income_index(spark: SparkSession) -> DataFrame:
    columns = dict(zip(INCOME_INDEX.names, map(list, zip(*INDEX_ROWS))))
    return spark.createDataFrame(pa.table(columns))


def _in_window(column: str, since: date | None, until: date | None) -> Column:
    """Raw-column range of whole months, so that it reaches the scan; open when no dates are given."""
    rows = F.lit(True)
    if since is not None:
        rows = rows & (F.col(column) >= F.lit(since))
    if until is not None:
        rows = rows & (F.col(column) < F.add_months(F.lit(until), 1))
    return rows


def portfolio_parts(spark: SparkSession, sf: str, since: date | None = None, until: date | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """Card-like facts from orders and credit-like facts from line items. `since` and `until` are month starts."""
    nation = table(spark, sf, "nation")
    orders = table(spark, sf, "orders").filter(_in_window("o_orderdate", since, until)).join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.trunc("o_orderdate", "MM").alias("fecha"), F.col("n_name").alias("banco"),
        F.col("o_orderpriority").alias("producto"), F.col("o_totalprice").alias("monto"))
    lines = table(spark, sf, "lineitem").filter(_in_window("l_shipdate", since, until)).join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
           ).join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.trunc("l_shipdate", "MM").alias("fecha"), F.col("n_name").alias("banco"),
        F.col("p_type").alias("producto"), F.col("l_extendedprice").alias("monto"))
    return orders, lines


def portfolio(spark: SparkSession, sf: str, since: date | None = None, until: date | None = None) -> DataFrame:
    orders, lines = portfolio_parts(spark, sf, since, until)
    return orders.unionByName(lines)


def wide_sheet_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The portfolio laid out as wide sheets: a workbook per region, a column per nation, months filled down.

    Row numbers follow from month and product and have gaps. Behind the end row every row is repeated.
    """
    nothing = F.lit(None).cast("string")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    # A header cell per nation of the region: a list as long as a sheet is wide.
    heads = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(
        F.concat("r_name", F.lit(".xlsx")).alias("file")).agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    facts = portfolio(spark, sf).groupBy("fecha", "banco", "producto").agg(total(F.col("monto"), 2).alias("monto"))
    sheet = F.when(F.col("producto").rlike("^[0-9]"), CARD_LIKE.sheet).otherwise(CREDIT_LIKE.sheet)
    lines = facts.join(heads.select("file", "names", F.explode("names").alias("banco")), "banco").groupBy(
        "file", "names", sheet.alias("sheet"), "fecha", "producto").agg(
        F.map_from_entries(F.collect_list(F.struct("banco", "monto"))).alias("amounts"))

    # Month cells stand on a row of their own, before the month's first product; its category is no product.
    month = F.month("fecha")
    text = F.when(month <= 3, F.date_format("fecha", "yyyy-MM-dd")).when(month <= 6, F.date_format("fecha", "yyyy/M")) \
        .when(month <= 9, F.date_format(F.last_day("fecha"), "dd.MM.yyyy")).when(
            month <= 11, F.datediff("fecha", F.lit(date(1899, 12, 30))).cast("string")).otherwise(
            F.date_format("fecha", "yyyy-MM-dd HH:mm:ss"))
    kind = F.when(month <= 9, "s").when(month <= 11, "n").otherwise("d")
    place = F.array_position(F.array(*[F.lit(p) for p in PRODUCTS]), F.col("producto"))
    first = F.min("_place").over(Window.partitionBy("file", "sheet", "fecha"))
    placed = lines.withColumn("_place", place).withColumn("_first", first == F.col("_place"))
    start = (F.year("fecha") * 12 + month).cast("long") * 1000

    def row(row_no, cells, types):
        return F.struct(row_no.cast("long").alias("row_no"), cells.alias("cells"), types.alias("types"))

    cells = F.concat(F.array(nothing, nothing, F.col("producto")),
                     F.transform("names", lambda n: F.col("amounts")[n].cast("string")))
    types = F.concat(F.array(nothing, nothing, F.lit("s")), F.transform("names", lambda n: F.lit("n")))
    body = placed.select("file", "sheet", F.inline(F.array_compact(F.array(
        row(start + F.col("_place"), cells, types), row(start + F.col("_place") + _END_ROW, cells, types),
        F.when(F.col("_first"), row(start, F.array(nothing, text, F.lit("Subtotal")),
                                    F.array(nothing, kind, F.lit("s"))))))))
    frame = heads.select("file", F.explode(F.array(F.lit(CREDIT_LIKE.sheet), F.lit(CARD_LIKE.sheet))).alias("sheet"),
                         "names").select("file", "sheet", F.inline(F.array(
        row(F.lit(5), F.concat(F.array(nothing, F.lit("Fecha"), F.lit("Sector o clase")), "names"),
            F.concat(F.array(nothing, F.lit("s"), F.lit("s")), F.transform("names", lambda n: F.lit("s")))),
        row(F.lit(_END_ROW), F.array(nothing, F.lit("Total general"), nothing), F.array(nothing, F.lit("s"), nothing)))))
    return body.unionByName(frame).select("file", "sheet", F.lit(0).alias("sheet_pos"), "row_no", "cells", "types")
