import pytest

from cuota.operators.links import categorize_links, extract_links, file_extension, select_links
from cuota.plans.discovery import workbooks_to_fetch
from cuota.sources.html import link_candidates
from cuota.specs import LinkSpec, Selector

SPEC = LinkSpec("https://boletin.example")
FALLBACK = {"tabla_bancos": "https://boletin.example/d/b.xlsx/c44c", "tabla_financieras": "https://boletin.example/d/f.xls"}

STRUCTURED = """<div class="x list_item section-item"><span class="item_title"> Tabla <b>A</b> </span>
<div class="item_links"><a>none</a><a href="/d/a.XLSX">Descargar</a><a href="/d/late.xlsx">x</a></div></div>
<div class="list_item section-item"><div class="item_links"><a href="/d/macro.xlsm">x</a><a href="/d/c.xls">y</a></div></div>
<div class="list_item section-item"><div class="item_links"><a href="b.xls"></a></div></div>
<div class="list_item"><div class="item_links"><a href="/d/not-an-item.xls">z</a></div></div>"""

HEADERS = """<section><div><h3>Tabla de BANCOS</h3></div><p><a href="/x.pdf">Descargar</a>
<a href="/bi.xlsx?t=1&amp;v=2"><i>DESCARGAR ya</i></a></p></section>
<section><h3>Tabla de financieras</h3><div><a href="//cdn.example/fi.xls">descargar</a></div></section>"""

CONTEXT = """<ul><li><p>Las financieras</p><div><span><a href="/1.xls">Descargar</a></span></div></li></ul>
<ul><li>Los Bancos y financieras <a href="/2.xls">Descargar <!-- no --></a></li>
<li>Bancos <a href="/3.xls">descargar</a></li></ul><p><a href="/4.xls">otro</a></p>"""

DIRECT = """<p>nada<br><a href="/a.xls"> Uno  <b>dos</b></a><a href="/m.XLSM">m</a><a href="/a.xls">otra vez</a>
<a name="n">x</a><a href="b.html">y</a><a HREF='https://otra.example/b.XLS#h'>z</a>"""


def found(spark, html, spec=SPEC):
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "<p>sin enlaces</p>")],
                                  "page_id long, url string, html string")
    rows = extract_links(pages, spec).orderBy("page_id", "method_rank", "pos").collect()
    return [(r.url.replace("https://boletin.example", ""), r.text, r.type, r.method) for r in rows]


def test_structured_section(spark):
    assert found(spark, STRUCTURED) == [
        ("/d/a.XLSX", "TablaA", None, "structured_section"), ("/b.xls", "descargar", None, "structured_section")]


def test_section_header(spark):
    assert found(spark, HEADERS) == [
        ("/bi.xlsx?t=1&v=2", "Tabla de Bancos", "tabla_bancos", "section_header"),
        ("https://cdn.example/fi.xls", "Tabla de Financieras", "tabla_financieras", "section_header")]


def test_header_levels(spark):
    def page(tag, depth):
        return f"<{tag}>" * depth + "<h2>tabla de bancos</h2>" + f"</{tag}>" * depth + "<a href='/x.xls'>descargar</a>"

    assert [f[3] for f in found(spark, page("main", 4))] == ["section_header"]
    assert [f[3] for f in found(spark, page("main", 5))] == ["context_analysis"]
    # A block that holds nothing but the heading is a heading too.
    assert [f[3] for f in found(spark, page("div", 5))] == ["section_header"]


def test_context(spark):
    # The second link's element holds a comment beside its text, so it has no single string and is no button.
    assert found(spark, CONTEXT) == [
        ("/1.xls", "Tabla de Financieras", "tabla_financieras", "context_analysis"),
        ("/3.xls", "Tabla de Bancos", "tabla_bancos", "context_analysis")]


def test_direct(spark):
    assert found(spark, DIRECT) == [("/a.xls", "Uno  dos", None, "direct_link"),
                                    ("https://otra.example/b.XLS#h", "z", None, "direct_link")]


def test_later_methods_only_fill_up(spark):
    one = HEADERS.split("</section>")[0] + "</section>"
    assert [f[3] for f in found(spark, one + DIRECT)] == ["section_header", "direct_link", "direct_link"]
    assert [f[3] for f in found(spark, HEADERS + DIRECT)] == ["section_header", "section_header"]


def test_invisible_text_and_broken_markup(spark):
    html = """<div><script>bancos</script><style>bancos</style><!-- bancos --><p>financieras
    <a href="/q.xls">descargar</a></span></p></div>"""
    assert found(spark, html) == [("/q.xls", "Tabla de Financieras", "tabla_financieras", "context_analysis")]
    assert found(spark, "<a href='/e.&#120;ls'>x</a>") == [("/e.xls", "x", None, "direct_link")]
    assert found(spark, "<a href='http://[bad.xls'>x</a>")[0][0] == "http://[bad.xls"


def test_other_selectors(spark):
    spec = LinkSpec("https://boletin.example", item=Selector("article"), item_title=Selector("h1"),
                    item_links=Selector("", ("files",)), href_contains=".csv", href_excludes="")
    html = "<article><h1>T</h1><ul class='a files'><li><a href='x.csv'>c</a></ul></article>"
    assert found(spark, html, spec) == [("/x.csv", "T", None, "structured_section")]


def test_pages_without_the_wanted_href_never_reach_python(spark):
    pages = spark.createDataFrame([(1, "u", "<a href='/a.pdf'>x</a>")] * 3, "page_id long, url string, html string")
    plan = link_candidates(pages, SPEC)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan.split("MapInPandas")[1]
    spread, gated = plan.index("Repartition"), plan.rindex("Filter")
    assert plan.index("MapInPandas") < spread < gated  # pages are gated before they are spread over tasks


def test_categories(spark):
    rows = [("Informe", "https://x/y", "tabla_financieras"), ("SISTEMA BANCARIO", "https://x/y", None),
            ("Entidades financieras", "https://x/BANCO.xls", None), ("entidades FINANCIERAS", "https://x/y", None),
            (None, "https://x/financiero", None), ("otro", "https://x/y", None), ("bancos", "https://x", "raro")]
    links = spark.createDataFrame(rows, "text string, url string, type string")
    assert [r.category for r in categorize_links(links, SPEC).collect()] == [
        "tabla_financieras", "tabla_bancos", "tabla_bancos", "tabla_financieras", "tabla_financieras", "otros",
        "tabla_bancos"]


@pytest.mark.parametrize("url, extension", [
    ("https://x/a/b.xls?t=1.zip", ".xls"), ("https://x/a.xlsx/c44c-0", ".xlsx"), ("https://x.org", ".xlsx"),
    ("https://x/.xls", ".xlsx"), ("https://x/a.tar.gz#f.b", ".gz"), ("https://x/a.xls;v=1.2", ".xls"), ("b.ods", ".ods"),
    ("https://x/dir.d/name", ".xlsx"), ("https://x/name.", "."),
])
def test_extensions(spark, url, extension):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(file_extension(df.url)).first()[0] == extension


def test_selection_and_fallback(spark):
    pages = spark.createDataFrame([(1, "u", HEADERS), (2, "u", HEADERS.split("</section>")[0]), (3, "u", None)],
                                  "page_id long, url string, html string")
    got = [tuple(r) for r in workbooks_to_fetch(pages, SPEC, FALLBACK).orderBy("page_id", "category").collect()]
    back = [("tabla_bancos", FALLBACK["tabla_bancos"], "tabla_de_bancos.xlsx", "fallback"),
            ("tabla_financieras", FALLBACK["tabla_financieras"], "tabla_de_financieras.xls", "fallback")]
    assert got == [
        (1, "tabla_bancos", "https://boletin.example/bi.xlsx?t=1&v=2", "tabla_de_bancos.xlsx", "page"),
        (1, "tabla_financieras", "https://cdn.example/fi.xls", "tabla_de_financieras.xls", "page"),
        *[(2, *b) for b in back], *[(3, *b) for b in back]]


def test_first_of_each_category(spark):
    links = spark.createDataFrame([(1, "tabla_bancos", 4, 9, "u9.xls"), (1, "tabla_bancos", 2, 11, "u11.xls"),
                                   (1, "tabla_financieras", 4, 1, "u1"), (1, "otros", 1, 1, "o.xls")],
                                  "page_id long, category string, method_rank int, pos long, url string")
    pages = spark.createDataFrame([(1,)], "page_id long")
    got = {r.category: (r.url, r.file_name) for r in select_links(pages, links, SPEC, FALLBACK).collect()}
    assert got == {"tabla_bancos": ("u11.xls", "tabla_de_bancos.xls"),
                   "tabla_financieras": ("u1", "tabla_de_financieras.xlsx")}
