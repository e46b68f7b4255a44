"""Pages to the workbooks to fetch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from cuota.operators.links import categorize_links, extract_links, select_links
from cuota.specs import LinkSpec


def workbooks_to_fetch(pages: DataFrame, spec: LinkSpec, fallback: Mapping[str, str]) -> DataFrame:
    """page_id, category, url, file_name, origin: what to download for each page. Nothing is downloaded here."""
    return select_links(pages, categorize_links(extract_links(pages, spec), spec), spec, fallback)
