"""Link discovery over many pages: gating of the search methods, repeats, categories and the choice per category.

Everything is keyed by page, so one shuffle of the candidate rows serves all steps. A group is one page's links.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.sources.html import link_candidates
from cuota.specs import CATEGORY_FILES, DEFAULT_EXTENSION, LINK_METHODS, OTHER_CATEGORY, LinkSpec


def gate_methods(candidates: DataFrame, enough: int = 2) -> DataFrame:
    """Drop the third method's rows on pages where the first two found enough distinct URLs, the fourth's likewise."""
    page = Window.partitionBy("page_id")

    def urls_up_to(rank: int) -> Column:
        found = F.when(F.col("method_rank") <= rank, F.col("url"))
        if enough == 2:  # two differ exactly when the least and the greatest do: nothing to collect
            return F.when(F.min(found).over(page) < F.max(found).over(page), 2).otherwise(0)
        return F.size(F.collect_set(found).over(page))

    counted = candidates.withColumn("_two", urls_up_to(2)).withColumn("_three", urls_up_to(3))
    allowed = (F.col("method_rank") <= 2) | ((F.col("method_rank") == 3) & (F.col("_two") < enough)) | (
        (F.col("method_rank") == 4) & (F.col("_three") < enough))
    return counted.filter(allowed).drop("_two", "_three")


def dedupe_links(links: DataFrame) -> DataFrame:
    """Keep the first find of each URL of a page, in discovery order."""
    first = F.min_by(F.struct("text", "type", "method_rank", "pos"), F.struct("method_rank", "pos"))
    return links.groupBy("page_id", "url").agg(first.alias("_first")).select("page_id", "url", "_first.*")


def extract_links(pages: DataFrame, spec: LinkSpec, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """page_id, url, text, type, method_rank, pos, method of every distinct workbook link of every page."""
    links = dedupe_links(gate_methods(link_candidates(pages, spec, page_id=page_id, html=html), spec.enough_links))
    return links.withColumn("method", method_name(F.col("method_rank")))


def method_name(rank: Column) -> Column:
    """Name of a search method by its rank."""
    return F.element_at(F.array(*[F.lit(name) for name in LINK_METHODS]), rank)


def categorize_links(links: DataFrame, spec: LinkSpec) -> DataFrame:
    """Add `category`: the link's own type, else the first category whose keywords fit its text or URL, else 'otros'."""
    text, url = F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lower("url")
    by_type = F.when(F.col("type").isin(*[c.name for c in spec.categories]), F.col("type"))
    by_words = reduce(
        lambda chain, c: chain.when(
            reduce(lambda a, b: a | b, [text.contains(word) for word in c.keywords], url.contains(c.url_keyword)),
            F.lit(c.name)),
        spec.categories, F.when(F.lit(False), F.lit(None).cast("string")))
    return links.withColumn("category", F.coalesce(by_type, by_words, F.lit(OTHER_CATEGORY)))


def file_extension(url: Column) -> Column:
    """Extension of an URL's path, or the default one."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    extension = F.regexp_extract(F.regexp_replace(path, ";[^/]*$", ""), r"[^/.][^/]*(\.[^/.]*)$", 1)
    return F.when(extension == "", F.lit(DEFAULT_EXTENSION)).otherwise(extension)


def select_links(pages: DataFrame, links: DataFrame, spec: LinkSpec, fallback: Mapping[str, str], *,
                 files: Mapping[str, str] = CATEGORY_FILES, page_id: str = "page_id") -> DataFrame:
    """page_id, category, url, file_name, origin: the first link of each category of a page.

    A page that lacks a category (or every link) gets the fallback URLs for all of them instead.
    """
    names = [c.name for c in spec.categories]
    found = links.filter(F.col("category").isin(*names)).select(
        "page_id", "category", F.struct("method_rank", "pos", "url").alias("_link"))
    every_page = pages.select(F.col(page_id).cast("long").alias("page_id"), F.lit(None).cast("string").alias("category"),
                              F.lit(None).cast(found.schema["_link"].dataType).alias("_link"))
    firsts = found.unionByName(every_page).groupBy("page_id").agg(*[
        F.min(F.when(F.col("category") == name, F.col("_link"))).alias(f"_{i}") for i, name in enumerate(names)])
    complete = reduce(lambda a, b: a & b, [F.col(f"_{i}").isNotNull() for i in range(len(names))])
    picks = F.when(complete, F.array(*[
        F.struct(F.lit(name).alias("category"), F.col(f"_{i}.url").alias("url"), F.lit("page").alias("origin"))
        for i, name in enumerate(names)
    ])).otherwise(F.array(*[
        F.struct(F.lit(name).alias("category"), F.lit(fallback[name]).alias("url"), F.lit("fallback").alias("origin"))
        for name in names
    ]))
    base = F.create_map(*[F.lit(part) for pair in files.items() for part in pair])
    rows = firsts.select("page_id", F.inline(picks))
    return rows.select("page_id", "category", "url", F.concat(
        F.coalesce(F.try_element_at(base, F.col("category")), F.col("category")), file_extension(F.col("url"))
    ).alias("file_name"), "origin")
