"""One registered query per operator, bound to the check tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType

from cuota.functions.dates import add_months, parse_month
from cuota.functions.text import normalize_name, normalize_text, percent_label
from cuota.operators.consolidate import (classify_income, consolidate_cards, consolidate_credit, consolidate_income,
                                         profile_tables, repeated_keys, union_institutions)
from cuota.operators.entities import group_banks, name_entities, remap_entities
from cuota.operators.fill import forward_fill
from cuota.operators.links import (categorize_links, dedupe_links, extract_links, method_name,
                                   select_links)
from cuota.operators.portfolio import (adjust_cutoffs, adjusted_cutoff, composition_matrix, consolidate_portfolio,
                                       cutoff_composition, stack_bases, trailing_share)
from cuota.operators.shares import (distinct_values, monthly_cards, monthly_cards_by_class, monthly_credit,
                                    monthly_credit_by_product, period_bounds, share_cap)
from cuota.operators.sheets import missing_sheets, select_sheets, unpivot_wide_sheets
from cuota.plans import bindings as b
from cuota.plans.market_share import open_portfolio
from cuota.session import scratch_path
from cuota.sinks.files import manifest, sheet_lines, write_manifest
from cuota.sinks.tables import read_csv_table, refresh_table, write_csv, write_table
from cuota.sources.html import link_candidates
from cuota.sources.listing import is_valid_file, list_files
from cuota.sources.staging import normalize_columns, read_staging, rejected_cells
from cuota.specs import CREDIT, PORTFOLIO, WINDOW_MONTHS, TableSpec

CUTOFF = "2001-03-31"
CUTOFF_MONTH, WINDOW_START = date(2001, 3, 1), date(1999, 4, 1)
SCALE = 2  # amounts of the check tables have two decimals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _credit(spark, sf):
    return consolidate_credit(*b.credit_parts(spark, sf), successors=b.SUCCESSORS, names=b.entity_names(spark, sf),
                              scale=SCALE)


def _cards(spark, sf):
    return consolidate_cards(*b.card_parts(spark, sf), successors=b.SUCCESSORS, names=b.entity_names(spark, sf),
                             scale=SCALE)


def _income(spark, sf):
    return consolidate_income(*b.income_parts(spark, sf), successors=b.SUCCESSORS, names=b.entity_names(spark, sf),
                              scale=SCALE)


def _window_facts(spark, sf):
    return b.portfolio(spark, sf, WINDOW_START, CUTOFF_MONTH)


def _composition(spark, sf):
    return cutoff_composition(b.portfolio(spark, sf, CUTOFF_MONTH, CUTOFF_MONTH), CUTOFF, scale=SCALE)


def _stored_composition(spark, sf):
    """The composition as a table: its products are read from it before its shares are laid out."""
    return write_table(_composition(spark, sf), scratch_path(spark, "composicion"))


@query("trailing_share")
def _trailing_share(spark, sf):
    return trailing_share(_window_facts(spark, sf), CUTOFF, scale=SCALE)


DECLARED = TableSpec("prueba", (("fecha", DateType()), ("codigo_entidad", LongType()), ("sub_rubro", StringType()),
                                ("importe", DoubleType())))


def _untidy(spark, sf, *further):
    """Line items as the untidy text of a CSV table."""
    return b.table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias(" Fecha "),
        F.when(F.col("l_linenumber") == 1, F.lit("n/d")).when(
            F.col("l_linenumber") == 2, F.concat(F.col("l_suppkey").cast("string"), F.lit(".0"))).when(
            F.col("l_linenumber") == 3, F.concat(F.col("l_suppkey").cast("string"), F.lit(".5"))).otherwise(
            F.col("l_suppkey").cast("string")).alias("Código Entidad"),
        F.when(F.col("l_returnflag") == "R", F.lit("NA")).otherwise(F.col("l_returnflag")).alias("Sub  Rubro"),
        F.when(F.col("l_linestatus") == "O", F.lit("12d")).otherwise(
            F.col("l_extendedprice").cast("string")).alias("IMPORTE"),
        F.lit("x").alias("sobra"), *further)


@query("staging_typed")
def _staging_typed(spark, sf):
    """Line items written as untidy CSV text, then read back as a declared table."""
    path = scratch_path(spark, "staging")
    _untidy(spark, sf).write.option("header", True).csv(path)
    return read_staging(spark, path, DECLARED)


@query("staging_rejects")
def _staging_rejects(spark, sf):
    """The line items that lose a cell to the declared types, with the names of the columns that lose it."""
    text = normalize_columns(_untidy(spark, sf, "l_orderkey", "l_linenumber"))
    return rejected_cells(text, DECLARED).select("l_orderkey", "l_linenumber", F.concat_ws(",", "rechazadas").alias("rechazadas"))


@query("union_institutions")
def _union_institutions(spark, sf):
    return union_institutions(list(b.credit_parts(spark, sf)), CREDIT)


@query("entity_remap")
def _entity_remap(spark, sf):
    parts = union_institutions(list(b.credit_parts(spark, sf)), CREDIT)
    return remap_entities(parts, b.SUCCESSORS).select("fecha", "codigo_entidad", "actividad_destino_vs2")


@query("entity_name")
def _entity_name(spark, sf):
    parts = remap_entities(union_institutions(list(b.credit_parts(spark, sf)), CREDIT), b.SUCCESSORS)
    return name_entities(parts, b.entity_names(spark, sf)).select("fecha", "codigo_entidad", "entidad")


@query("credit_consolidated")
def _credit_consolidated(spark, sf):
    return _credit(spark, sf)


@query("card_consolidated")
def _card_consolidated(spark, sf):
    return _cards(spark, sf)


@query("income_consolidated")
def _income_consolidated(spark, sf):
    return _income(spark, sf)


@query("income_classified")
def _income_classified(spark, sf):
    return classify_income(_income(spark, sf), b.income_index(spark))


@query("index_repeated_keys")
def _index_repeated_keys(spark, sf):
    """Income lines checked against an index made of the events themselves, so that every type repeats."""
    index = b.table(spark, sf, "events").select(F.col("event_type").alias("sub_rubro_base"))
    return repeated_keys(index)


@query("table_profile")
def _table_profile(spark, sf):
    return profile_tables({
        "credito_sector": _credit(spark, sf), "tarjetas": _cards(spark, sf),
        "estado_resultados": classify_income(_income(spark, sf), b.income_index(spark)),
    })


@query("monthly_credit_share")
def _monthly_credit_share(spark, sf):
    return monthly_credit(_credit(spark, sf), "Economy", scale=SCALE).drop("morosidad")


@query("delinquency")
def _delinquency(spark, sf):
    return monthly_credit(_credit(spark, sf), "Promo", scale=SCALE).drop("share")


@query("monthly_card_share")
def _monthly_card_share(spark, sf):
    return monthly_cards(_cards(spark, sf), "1-Urgent", scale=SCALE)


@query("monthly_credit_by_product")
def _monthly_credit_by_product(spark, sf):
    return monthly_credit_by_product(_credit(spark, sf), ["Economy", "promo", "LARGE"], scale=SCALE)


@query("monthly_cards_by_class")
def _monthly_cards_by_class(spark, sf):
    return monthly_cards_by_class(_cards(spark, sf), ["1-urgent", "5-LOW"], scale=SCALE)


@query("period_by_product")
def _period_by_product(spark, sf):
    return period_bounds(monthly_credit_by_product(_credit(spark, sf), ["Economy", "promo"], scale=SCALE),
                         by=["producto"])


@query("adjust_cutoff")
def _adjust_cutoff(spark, sf):
    return adjust_cutoffs(b.portfolio(spark, sf), ["1990-05-20", "2000-02-29", "2030-12-31"])


@query("share_at_adjusted_cutoff")
def _share_at_adjusted_cutoff(spark, sf):
    """A cutoff beyond the data, moved to its last month first."""
    month = adjusted_cutoff(b.portfolio(spark, sf), "2030-12-31")
    return trailing_share(b.portfolio(spark, sf, since=add_months(month, 1 - WINDOW_MONTHS), until=month), month, scale=SCALE)


@query("cutoff_composition")
def _cutoff_composition(spark, sf):
    return _composition(spark, sf)


@query("composition_matrix")
def _composition_matrix(spark, sf):
    return composition_matrix(_stored_composition(spark, sf))


@query("stack_base")
def _stack_base(spark, sf):
    return stack_bases(_stored_composition(spark, sf))


@query("distinct_entities")
def _distinct_entities(spark, sf):
    return distinct_values(trailing_share(_window_facts(spark, sf), CUTOFF, scale=SCALE, ordered=False), "banco")


@query("period_bounds")
def _period_bounds(spark, sf):
    return period_bounds(trailing_share(_window_facts(spark, sf), CUTOFF, scale=SCALE, ordered=False))


@query("share_cap")
def _share_cap(spark, sf):
    return share_cap(trailing_share(_window_facts(spark, sf), CUTOFF, scale=SCALE, ordered=False), "share_mes")


@query("share_labels")
def _share_labels(spark, sf):
    return _composition(spark, sf).select("banco", "producto", percent_label(F.col("share_producto")).alias("etiqueta"))


@query("wide_sheet_unpivot")
def _wide_sheet_unpivot(spark, sf):
    # The laid-out rows are a table of their own, as stored workbook rows are: the reader goes over them twice.
    rows = write_table(b.wide_sheet_rows(spark, sf), scratch_path(spark, "sheet_rows"))
    facts = unpivot_wide_sheets(rows, (b.CREDIT_LIKE, b.CARD_LIKE), groups=b.BANKS)
    return consolidate_portfolio([facts], scale=SCALE)


@query("forward_fill")
def _forward_fill(spark, sf):
    orders = b.table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderkey",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), F.trunc("o_orderdate", "MM")).alias("mes"))
    return forward_fill(orders, ["o_orderstatus"], "o_orderkey", "mes")


@query("parse_month")
def _parse_month(spark, sf):
    """Order dates written in each accepted style, and as a serial number held in a text cell, which is refused."""
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    serial = F.datediff(day, F.lit(date(1899, 12, 30))).cast("string")
    text = (F.when(F.col("o_orderstatus") == "P", serial).when(priority == "1-URGENT", F.date_format(day, " yyyy-MM-dd "))
            .when(priority == "2-HIGH", F.date_format(day, "yyyy.M")).when(priority == "3-MEDIUM", F.date_format(
                day, "d/M/yyyy")).when(priority == "4-NOT SPECIFIED", F.concat(serial, F.lit(".75")))
            .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss")))
    kind = (F.when(F.col("o_orderstatus") == "P", "s").when(priority == "4-NOT SPECIFIED", "n")
            .when(priority == "5-LOW", "d").otherwise("s"))
    cells = b.table(spark, sf, "orders").select("o_orderkey", text.alias("texto"), kind.alias("tipo"))
    return cells.select("o_orderkey", parse_month(F.col("texto"), F.col("tipo")).alias("mes"))


@query("normalize_name")
def _normalize_name(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", normalize_name(F.col("text")).alias("nombre"))


@query("normalize_ligatures")
def _normalize_ligatures(spark, sf):
    """Texts in which ligatures and a fraction stand for letters and digits fold to the same names."""
    text = F.replace(F.replace(F.replace(F.col("text"), F.lit("fi"), F.lit("ﬁ")), F.lit("st"), F.lit("ﬆ")), F.lit("10"), F.lit("⑩"))
    return b.table(spark, sf, "documents").select("doc_id", normalize_name(text).alias("nombre"))


@query("normalize_text")
def _normalize_text(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", normalize_text(F.col("text")).alias("texto"))


@query("bank_group")
def _bank_group(spark, sf):
    """Nation names spelled in several ways by market segment."""
    customers = b.table(spark, sf, "customer").join(b.table(spark, sf, "nation"),
                                                    F.col("c_nationkey") == F.col("n_nationkey"))
    spelled = (F.when(F.col("c_mktsegment") == "BUILDING", F.lower("n_name"))
               .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("  "), F.col("n_name"), F.lit("\t")))
               .when(F.col("c_mktsegment") == "AUTOMOBILE", F.translate("n_name", "AI", "ÁÎ"))
               .otherwise(F.concat(F.lit("caja  de  "), F.lower("n_name"))))
    return group_banks(customers.select("c_custkey", spelled.alias("escrito")), "escrito", b.BANKS)


@query("portfolio_consolidated")
def _portfolio_consolidated(spark, sf):
    orders, lines = b.portfolio_parts(spark, sf)
    split = [part.filter(test) for part in (orders, lines)
             for test in (F.col("banco") < "NATION_2", F.col("banco") >= "NATION_2")]
    return consolidate_portfolio(split, scale=SCALE)


@query("full_refresh")
def _full_refresh(spark, sf):
    """A table that held other rows, replaced and read back."""
    path = scratch_path(spark, "cartera_pf")
    orders, lines = b.portfolio_parts(spark, sf)
    refresh_table(consolidate_portfolio([orders], scale=SCALE), path, PORTFOLIO)
    return refresh_table(consolidate_portfolio([lines], scale=SCALE), path, PORTFOLIO,
                         sort_by=["fecha", "banco", "producto"])


@query("portfolio_stored")
def _portfolio_stored(spark, sf):
    """The stored portfolio, opened as a later job does."""
    path = scratch_path(spark, "cartera_pf")
    refresh_table(consolidate_portfolio([b.portfolio(spark, sf)], scale=SCALE), path, PORTFOLIO)
    return open_portfolio(spark, path)


@query("csv_roundtrip")
def _csv_roundtrip(spark, sf):
    shares = trailing_share(_window_facts(spark, sf), CUTOFF, scale=SCALE, ordered=False)
    path = scratch_path(spark, "share_24m")
    write_csv(shares, path, sort_by=["mes", "banco", "producto"])
    return read_csv_table(spark, path, shares.schema)


@query("link_methods")
def _link_methods(spark, sf):
    """Every candidate of the four search methods, before any is gated."""
    found = link_candidates(b.table(spark, sf, "pages"), b.PAGE_LINKS)
    return found.select("page_id", method_name(F.col("method_rank")).alias("method"), "url", "text", "type")


@query("link_extract")
def _link_extract(spark, sf):
    return extract_links(b.table(spark, sf, "pages"), b.PAGE_LINKS).select("page_id", "url", "text", "type", "method")


@query("link_dedupe")
def _link_dedupe(spark, sf):
    """The first find of each URL of a page, over all methods in their order."""
    return dedupe_links(link_candidates(b.table(spark, sf, "pages"), b.PAGE_LINKS)).select("page_id", "url", "text")


@query("link_categorize")
def _link_categorize(spark, sf):
    links = extract_links(b.table(spark, sf, "pages"), b.PAGE_LINKS)
    return categorize_links(links, b.PAGE_LINKS).select("page_id", "url", "category")


@query("link_first")
def _link_first(spark, sf):
    pages = b.table(spark, sf, "pages")
    links = categorize_links(extract_links(pages, b.PAGE_LINKS), b.PAGE_LINKS)
    return select_links(pages, links, b.PAGE_LINKS, b.PAGE_FALLBACK, files=b.PAGE_FILES)


def _order_sheets(spark, sf):
    """Customers as workbooks and their orders as sheets titled by priority and status."""
    return b.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("file"), F.concat_ws(" - ", "o_orderpriority", "o_orderstatus").alias("sheet"),
        F.col("o_orderkey").alias("sheet_pos"))


@query("sheet_select")
def _sheet_select(spark, sf):
    return select_sheets(_order_sheets(spark, sf), b.SHEET_LIKE)


@query("sheet_missing")
def _sheet_missing(spark, sf):
    return missing_sheets(_order_sheets(spark, sf), b.SHEET_LIKE)


@query("sheet_lines")
def _sheet_lines(spark, sf):
    """Each customer's orders as the rows of sheets titled by priority and status, exported as CSV lines."""
    cells = F.array(F.col("o_orderkey").cast("string"), F.lit(None).cast("string"),
                    F.concat("o_orderpriority", F.lit(', "x"')), F.when(F.col("o_orderstatus") == "F", "1").otherwise("0"))
    rows = b.table(spark, sf, "orders").select(
        F.concat(F.when(F.col("o_custkey") % 2 == 0, "/m/tabla_de_bancos.").otherwise("/m/otra."), F.col("o_custkey"),
                 F.lit(".xlsx")).alias("file"),
        F.concat_ws(" - ", "o_orderpriority", "o_orderstatus").alias("sheet"), F.col("o_orderkey").alias("sheet_pos"),
        F.col("o_orderkey").alias("row_no"), cells.alias("cells"),
        F.array(F.lit("n"), F.lit(None).cast("string"), F.lit("s"), F.lit("b")).alias("types"))
    return sheet_lines(rows, b.SHEET_LIKE)


@query("file_validity")
def _file_validity(spark, sf):
    """Pages as files: size of the HTML, extension by language of the page's URL."""
    name = F.concat(F.lit("/x/"), F.col("page_id"), F.when(F.col("url").contains("/en/"), ".XLSX").when(
        F.col("url").contains("/fr/"), ".xls").when(F.col("url").contains("/de/"), ".csv").otherwise(""))
    return b.table(spark, sf, "pages").select(
        "page_id", is_valid_file(name, F.octet_length("html").cast("long")).alias("valido"))


@query("file_manifest")
def _file_manifest(spark, sf):
    """Pages as files of a folder: path and name by page, size of the HTML, a day of change by page."""
    day = F.date_add(F.lit(date(2000, 1, 1)), (F.col("page_id") % 3650).cast("int"))
    name = F.concat(F.lit("page-"), F.col("page_id"), F.lit(".html"))
    files = b.table(spark, sf, "pages").select(
        F.concat(F.lit("/pages/"), name).alias("path"), name.alias("filename"),
        F.octet_length("html").cast("long").alias("size"), F.date_format(day, "yyyy-MM-dd").alias("modified"))
    path = scratch_path(spark, "manifest")
    write_manifest(files, path, "2000-01-01T00:00:00")
    return spark.read.schema(manifest(files, "").schema).json(path)


@query("written_files")
def _written_files(spark, sf):
    """Pages written as one text file for every 64 of them, then listed with what the file system says of each file."""
    group = F.floor(F.col("page_id") / 64).alias("grupo")
    pages = b.table(spark, sf, "pages").select(group, F.coalesce("html", F.lit("")).alias("value"))
    folder, start = scratch_path(spark, "written-pages"), F.lit(int(time.time()))
    pages.repartition("grupo").write.partitionBy("grupo").text(folder)
    path = scratch_path(spark, "written-manifest")
    write_manifest(list_files(spark, folder, "*.txt"), path, "2000-01-01T00:00:00")
    listed = spark.read.json(path)
    changed = F.to_timestamp("modified", "yyyy-MM-dd'T'HH:mm:ss.SSS").cast("long")
    return listed.select("timestamp", F.regexp_extract("path", "/(grupo=[0-9]+)/", 1).alias("carpeta"),
                         F.col("path").endswith(F.concat(F.lit("/"), "filename")).alias("nombre_en_ruta"), "size",
                         (changed >= start - 3600).alias("reciente"))
