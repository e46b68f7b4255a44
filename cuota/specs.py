"""Declared schemas, dimensions and parameter objects.

Everything here is either a schema, a small lookup given as a plain dict, or a frozen parameter object. A caller
replaces any of them by passing another value to the operators.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import DataType, DateType, DoubleType, LongType, StringType, StructField, StructType


@dataclass(frozen=True)
class TableSpec:
    """A declared table: normalised column names and their types."""

    name: str
    columns: tuple[tuple[str, DataType], ...]

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def schema(self) -> StructType:
        return StructType([StructField(name, dtype, True) for name, dtype in self.columns])


CREDIT = TableSpec("credito", (
    ("fecha", DateType()),
    ("codigo_entidad", LongType()),
    ("actividad_destino_vs2", StringType()),
    ("cartera_vencida", DoubleType()),
    ("cartera_vigente", DoubleType()),
))

CARDS = TableSpec("tarjetas", (
    ("fecha", DateType()),
    ("codigo_entidad", LongType()),
    ("clasificacion", StringType()),
    ("total", DoubleType()),
))

INCOME = TableSpec("resultados", (
    ("fecha", DateType()),
    ("codigo_entidad", LongType()),
    ("sub_rubro", StringType()),
    ("codigo_moneda", LongType()),
    ("importe", DoubleType()),
    ("reporte", StringType()),
))

INCOME_INDEX = TableSpec("indice_resultados", (
    ("sub_rubro_base", StringType()),
    ("clasificacion", StringType()),
    ("rubro", StringType()),
    ("sub_rubro_reporte", StringType()),
))

PORTFOLIO = TableSpec("cartera_pf", (
    ("fecha", DateType()),
    ("banco", StringType()),
    ("producto", StringType()),
    ("monto", DoubleType()),
))

# Rows of workbook sheets. `types` tells text ('s'), number ('n'), date ('d') and boolean ('b') cells apart.
SHEET_ROWS_DDL = "file string, sheet string, sheet_pos int, row_no long, cells array<string>, types array<string>"

# One tidy CSV file per staging table: prefix = sheet family, suffix = banks (BI) or finance companies (FI).
STAGING_FILES: dict[str, tuple[str, TableSpec]] = {
    "csbi": ("CSBI.csv", CREDIT),
    "csfi": ("CSFI.csv", CREDIT),
    "tcbi": ("TCBI.csv", CARDS),
    "tcfi": ("TCFI.csv", CARDS),
    "erbi": ("ERBI.csv", INCOME),
    "erfi": ("ERFI.csv", INCOME),
}

# The same tables where sheets were exported from workbooks.
EXPORTED_FILES = {table: (f"salida={name.removesuffix('.csv')}", spec) for table, (name, spec) in STAGING_FILES.items()}

# Institution codes that merged into a successor.
ENTITY_SUCCESSORS: dict[int, int] = {
    1039: 1046, 2007: 1046, 1041: 1042, 1028: 1008, 1007: 1004, 2036: 1047, 2077: 1020, 1040: 1020, 2081: 1045,
}

# Institution names by code.
ENTITY_NAMES: dict[int, str] = {
    1046: "UENO", 1047: "ZETA", 1045: "SOLAR", 1042: "ATLAS/FAMILIAR", 1043: "BANCOP", 1030: "BASA", 1003: "BNA",
    1002: "BNF", 1006: "CITIBANK", 1020: "CONTINENTAL/RIO", 1005: "DO BRASIL", 1004: "GNB", 1044: "INTERFISA",
    1017: "ITAU", 1008: "SUDAMERIS", 2037: "CEFISA", 2080: "FIC", 2071: "FINLATINA", 2013: "FPJ",
    2078: "TU FINANCIERA",
}

# Fixed value: name given to a code that has none.
UNNAMED_ENTITY = "ERROR"

# Sheet header spellings (already folded to upper-case ASCII) and the group they belong to.
BANK_GROUPS: dict[str, str] = {
    "ATLAS": "ATLAS/FAMILIAR", "FAMILIAR": "ATLAS/FAMILIAR", "CONTINENTAL": "CONTINENTAL/RIO",
    "RIO": "CONTINENTAL/RIO", "R?O": "CONTINENTAL/RIO", "BANCOP": "BANCOP", "BASA": "BASA", "BNA": "BNA",
    "BNF": "BNF", "CITIBANK": "CITIBANK", "DO BRASIL": "DO BRASIL", "GNB": "GNB", "INTERFISA": "INTERFISA",
    "ITAU": "ITAU", "SOLAR": "SOLAR", "SUDAMERIS": "SUDAMERIS", "UENO": "UENO", "ZETA": "ZETA",
    "CEFISA": "CEFISA", "FIC": "FIC", "FINLATINA": "FINLATINA", "FPJ": "FPJ", "TU FINANCIERA": "TU FINANCIERA",
}

# Folded sector names that count as a product, and the label of each.
PRODUCT_LABELS: dict[str, str] = {
    "CONSUMO": "Consumo", "CONSUMO PERSONAS FISICAS": "Consumo", "VIVIENDA": "Vivienda",
}

# The products and card classes reported by default, and the default cutoff.
CREDIT_PRODUCTS = ("CONSUMO", "VIVIENDA", "COMERCIO AL POR MENOR", "COMERCIO AL POR MAYOR")
CARD_CLASSES = ("SALDO", "CANTIDAD")
DEFAULT_CUTOFF = "2025-03-31"
WINDOW_MONTHS = 24


@dataclass(frozen=True)
class WideSheet:
    """A sheet with one column per institution: where its header, categories and end are."""

    sheet: str
    categories: Mapping[str, str]
    header_date: str = "Fecha"
    header_category: str = ""  # prefix of the category heading; empty accepts any non-blank heading
    stop_prefix: str = "Total"


# Exact titles and headings of the two wide sheets.
CREDIT_SHEET = WideSheet("5. Cred. por sector", PRODUCT_LABELS, header_category="Sector")
CARD_SHEET = WideSheet("7. E. TC", {"SALDO": "TC"})


@dataclass(frozen=True)
class SheetTarget:
    """A sheet to export: the first one whose folded title contains every keyword."""

    label: str
    prefix: str
    keywords: tuple[str, ...]


# Exported sheets, file prefix of each and title keywords.
SHEET_TARGETS = (
    SheetTarget("EEFF", "ER", ("eeff",)),
    SheetTarget("TC", "TC", ("tc",)),
    SheetTarget("Credito Sector", "CS", ("cred", "sector")),
)

# Base file name and institution suffix of each link category.
CATEGORY_FILES = {"tabla_bancos": "tabla_de_bancos", "tabla_financieras": "tabla_de_financieras"}
CATEGORY_SUFFIXES = {"tabla_bancos": "BI", "tabla_financieras": "FI"}
UNKNOWN_SUFFIX = "XX"
DEFAULT_EXTENSION = ".xlsx"


@dataclass(frozen=True)
class Selector:
    """An element test: a tag name (empty = any) carrying all the given classes."""

    tag: str = ""
    classes: tuple[str, ...] = ()


@dataclass(frozen=True)
class LinkCategory:
    """A wanted link: phrase in a heading, words in its context, text keywords and an URL keyword."""

    name: str
    label: str
    heading: str
    context: tuple[str, ...]
    keywords: tuple[str, ...]
    url_keyword: str


# The phrases and words that tell the two workbooks apart, in test order.
LINK_CATEGORIES = (
    LinkCategory("tabla_bancos", "Tabla de Bancos", "tabla de bancos", ("bancos",),
                 ("tabla de bancos", "bancos", "sistema bancario"), "banco"),
    LinkCategory("tabla_financieras", "Tabla de Financieras", "tabla de financieras", ("financieras",),
                 ("tabla de financieras", "financieras", "entidades financieras"), "financier"),
)
OTHER_CATEGORY = "otros"


@dataclass(frozen=True)
class LinkSpec:
    """How workbook links are found in a page. Defaults hold the fixed values of the bulletin site's markup."""

    base_url: str
    categories: tuple[LinkCategory, ...] = LINK_CATEGORIES
    href_contains: str = ".xls"
    href_excludes: str = "xlsm"
    item: Selector = Selector("div", ("list_item", "section-item"))
    item_title: Selector = Selector("", ("item_title",))
    item_links: Selector = Selector("div", ("item_links",))
    header_tags: tuple[str, ...] = ("h1", "h2", "h3", "h4", "h5", "h6", "div", "span")
    header_pattern: str = r"tabla de (bancos|financieras)"
    button_pattern: str = r"descargar"
    default_text: str = "descargar"
    header_levels: int = 5
    context_levels: int = 3
    enough_links: int = 2


# Method names in the order they are tried.
LINK_METHODS = ("structured_section", "section_header", "context_analysis", "direct_link")


@dataclass(frozen=True)
class FileRules:
    """Accepted size range (bytes) and extensions of a downloaded file."""

    min_bytes: int = 1024
    max_bytes: int = 100 * 1024 * 1024
    extensions: tuple[str, ...] = field(default=(".xlsx", ".xls"))
