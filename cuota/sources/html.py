"""Candidate workbook links of HTML pages.

Only the part that needs the element tree runs in Python, one page at a time and in linear time: it reports every link
candidate of the four search methods. Which methods count for a page, the removal of repeats, categories and the choice
of links are DataFrame work in `cuota.operators.links`.
"""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser
from itertools import islice
from urllib.parse import urljoin

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuota.specs import LinkSpec

# Executors need not have the package installed: the scan and its parameter object travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[LinkSpec.__module__])

CANDIDATE_DDL = "page_id long, method_rank int, pos long, url string, text string, type string"
# Elements that never have content.
_VOID_TAGS = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param", "source",
    "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
))
_SPACES = " \n\t\f\r"


def link_candidates(pages: DataFrame, spec: LinkSpec, *, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, method_rank 1-4, pos, url, text, type) in discovery order, before gating and de-duplication.

    Pages that cannot hold a matching href are dropped before any Python runs; those that can are spread over all tasks by
    page, so that one big row group of pages is not one task. Spark bounds each batch of pages by bytes, so a batch and
    its rows stay small however long the pages are.
    """
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(html).alias("html"))
    wanted = spec.href_contains
    if wanted and re.fullmatch(r"[.A-Za-z0-9]+", wanted):
        # A character reference could spell part of the wanted text, so pages with one are kept.
        source = source.filter(F.lower("html").contains(wanted.lower()) | F.col("html").rlike("&(#|period|fjlig)"))

    def scan(batches):
        for batch in batches:
            rows = [(page, *row) for page, text in zip(batch["page_id"], batch["html"]) if text
                    for row in _candidates(text, spec)]
            yield pd.DataFrame(rows, columns=["page_id", "method_rank", "pos", "url", "text", "type"])

    return source.repartition("page_id").mapInPandas(scan, CANDIDATE_DDL)


class _Node:
    __slots__ = ("tag", "attrs", "parent", "children", "start", "end", "pieces", "in_links")

    def __init__(self, tag, attrs, parent, start, piece):
        self.tag, self.attrs, self.parent, self.start, self.end = tag, attrs, parent, start, start
        self.children, self.pieces, self.in_links = [], (piece, piece), False


class _Tree(HTMLParser):
    """Elements in document order; each knows the span of visible text it covers."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.pending, self.texts, self.length = [], [], 0
        self.root = self.top = _Node("", {}, None, 0, 0)
        self.nodes, self.open_tags = [], {}
        self.feed(html)
        self.close()
        self._flush()
        while self.top is not None:
            self._close_top()
        self.text = "".join(self.texts)

    def handle_starttag(self, tag, attrs):
        self._flush()
        node = _Node(tag, {key: value or "" for key, value in attrs}, self.top, self.length, len(self.texts))
        self.top.children.append(node)
        self.nodes.append(node)
        if tag not in _VOID_TAGS:
            self.top = node
            self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        if not self.open_tags.get(tag):
            return
        while self.top.tag != tag:
            self._close_top()
        self._close_top()

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()
        self.top.children.append(data)

    def _flush(self):
        """Adjoining data is one string; a blank one shrinks to a line break or a space."""
        if not self.pending:
            return
        data = "".join(self.pending)
        self.pending = []
        if not data.strip(_SPACES) and not (self.open_tags.get("pre") or self.open_tags.get("textarea")):
            data = "\n" if "\n" in data else " "
        self.top.children.append(data)
        if self.top.tag not in ("script", "style", "template"):
            self.texts.append(data)
            self.length += len(data)

    def _close_top(self):
        node = self.top
        node.end, node.pieces = self.length, (node.pieces[0], len(self.texts))
        if node.tag:
            self.open_tags[node.tag] -= 1
        self.top = node.parent

    def text_of(self, node):
        return self.text[node.start:node.end]

    def stripped_text_of(self, node):
        return "".join(piece.strip() for piece in self.texts[slice(*node.pieces)])


def _only_string(node):
    """The one string a node holds, through single-child elements; None when there are several children."""
    while len(node.children) == 1:
        child = node.children[0]
        if isinstance(child, str):
            return child
        node = child
    return None


def _ancestors(node):
    while node.parent is not None:
        node = node.parent
        yield node


def _matches(node, selector):
    if selector.tag and node.tag != selector.tag:
        return False
    return set(selector.classes) <= set((node.attrs.get("class") or "").split()) and bool(node.tag)


def _set_upwards(found, node):
    """Make `node` the first find of every ancestor that has none. Where one has, all above it have."""
    for above in _ancestors(node):
        if above in found:
            break
        found[above] = node


def _join_url(base, href):
    try:
        return urljoin(base, href)
    except ValueError:  # not a URL at all
        return href


def _candidates(html, spec):
    """Rows (method_rank, pos, url, text, type) of one page."""
    tree = _Tree(html)
    button, header = re.compile(spec.button_pattern, re.I), re.compile(spec.header_pattern, re.I)
    first_link, titles, first_button, buttons, direct, context = {}, {}, {}, [], [], {}

    def wanted(href):
        href = href.lower()
        excluded = (spec.href_excludes or "").lower()
        return bool(href) and spec.href_contains.lower() in href and not (excluded and excluded in href)

    def row(rank, position, node, text, kind):
        return rank, position, _join_url(spec.base_url, node.attrs["href"]), text, kind

    for position, node in enumerate(tree.nodes):
        node.in_links = node.parent.in_links or _matches(node.parent, spec.item_links)
        if _matches(node, spec.item_title):
            _set_upwards(titles, node)
        if node.tag != "a" or "href" not in node.attrs:
            continue
        if node.in_links:
            _set_upwards(first_link, node)
        if wanted(node.attrs["href"]):
            direct.append((position, node))
            if button.search(_only_string(node) or ""):
                buttons.append((position, node))
                _set_upwards(first_button, node)

    for position, node in enumerate(tree.nodes):
        if _matches(node, spec.item) and node in first_link and wanted(first_link[node].attrs["href"]):
            title = tree.stripped_text_of(titles[node]) if node in titles else ""
            link = first_link[node]
            yield row(1, position, link, title or tree.stripped_text_of(link) or spec.default_text, None)
        if node.tag in spec.header_tags and header.search(_only_string(node) or ""):
            text = tree.text_of(node).strip().lower()
            kind = next((c for c in spec.categories if c.heading in text), None)
            near = next((first_button[a] for a in islice(_ancestors(node), spec.header_levels) if a in first_button),
                        None)
            if kind is not None and near is not None:
                yield row(2, position, near, kind.label, kind.name)
    for position, node in buttons:
        for above in islice(_ancestors(node), spec.context_levels):
            if above not in context:
                text = tree.text_of(above).lower()
                context[above] = next((c for c in spec.categories if any(w in text for w in c.context)), None)
            if context[above] is not None:
                yield row(3, position, node, context[above].label, context[above].name)
                break
    for position, node in direct:
        yield row(4, position, node, tree.text_of(node).strip(), None)
