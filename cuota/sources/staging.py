"""Tidy CSV tables: all-text scan, name normalisation and declared types."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType

from cuota.functions.amounts import to_double, to_whole
from cuota.functions.text import strip_accents, strip_blanks
from cuota.sources.listing import require_paths
from cuota.specs import INCOME_INDEX, STAGING_FILES, TableSpec

# Cell texts that mean "missing" in a CSV file.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd")


def normalize_column_name(name: str) -> str:
    """No accents, trimmed, lower case, spaces to '_', then one pass of '__' to '_'."""
    return strip_accents(name).strip().lower().replace(" ", "_").replace("__", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column; two columns that end up with one name are an error."""
    names = [normalize_column_name(name) for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns collide after normalisation: {', '.join(twice)}")
    return df.toDF(*names)


def read_csv_text(spark: SparkSession, path: str | list[str], *, multi_line: bool = False) -> DataFrame:
    """CSV with a header row, every column as text. Files whose header differs from the first one's are refused.

    With `multi_line` cells may hold line breaks. Such a file cannot be split, so leave it off for large ones.
    """
    return (
        spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
        .option("multiLine", multi_line).option("escape", '"').csv(path)
    )


def _typed(col: Column, dtype, date_formats: Iterable[str]) -> Column:
    value = F.when(~col.isin(*MISSING_TOKENS), col)
    if isinstance(dtype, DateType):
        trimmed = strip_blanks(value)
        return F.coalesce(*[F.to_date(F.try_to_timestamp(trimmed, F.lit(fmt))) for fmt in date_formats])
    if isinstance(dtype, LongType):
        return to_whole(value)
    if isinstance(dtype, DoubleType):
        return to_double(value)
    return value.cast(dtype)


def apply_types(df: DataFrame, spec: TableSpec, *, on_bad_date: str = "raise",
                date_formats: Iterable[str] = DATE_FORMATS) -> DataFrame:
    """Text columns to the declared ones. Bad numbers become null; a bad date raises, or with 'null' becomes null.

    A declared column the input lacks is an error; further columns are dropped.
    """
    return df.select(*_declared(df, spec, on_bad_date, date_formats))


def _declared(df: DataFrame, spec: TableSpec, on_bad_date: str, date_formats: Iterable[str]) -> list[Column]:
    absent = [name for name in spec.names if name not in df.columns]
    if absent:
        raise ValueError(f"{spec.name}: missing columns {', '.join(absent)}")
    out = []
    for name, dtype in spec.columns:
        value = _typed(F.col(name), dtype, date_formats)
        if isinstance(dtype, DateType) and on_bad_date == "raise":
            bad = value.isNull() & F.col(name).isNotNull() & ~F.col(name).isin(*MISSING_TOKENS)
            value = F.when(bad, F.raise_error(F.concat(F.lit(f"{spec.name}.{name}: bad date "), F.col(name)))
                           .cast("date")).otherwise(value)
        out.append(value.alias(name))
    return out


def _lost(spec: TableSpec, date_formats: Iterable[str]) -> Column:
    """Names of the declared columns whose text a row loses, as an array."""
    return F.array_compact(F.array(*[
        F.when(F.col(name).isNotNull() & ~F.col(name).isin(*MISSING_TOKENS)
               & _typed(F.col(name), dtype, date_formats).isNull(), F.lit(name))
        for name, dtype in spec.columns
    ]))


def rejected_cells(df: DataFrame, spec: TableSpec, *, date_formats: Iterable[str] = DATE_FORMATS) -> DataFrame:
    """The text rows that lose a cell in `apply_types`, with the names of the lost columns in `rechazadas`."""
    return df.withColumn("rechazadas", _lost(spec, date_formats)).filter(F.size("rechazadas") > 0)


def typed_with_rejects(df: DataFrame, spec: TableSpec, *, on_bad_date: str = "raise",
                       date_formats: Iterable[str] = DATE_FORMATS) -> DataFrame:
    """What `apply_types` gives, with `rechazadas` and `fila` (the row's text): both null in a row that loses no cell.

    Stored, it serves the good values and the list of what was refused from one reading of the files.
    """
    taken = sorted({"rechazadas", "fila"} & set(spec.names))
    if taken:
        raise ValueError(f"{spec.name}: columns named like the added ones: {', '.join(taken)}")
    lost = _lost(spec, date_formats)
    return df.select(*_declared(df, spec, on_bad_date, date_formats), F.when(F.size(lost) > 0, lost).alias("rechazadas"),
                     F.when(F.size(lost) > 0, F.to_json(F.struct(*spec.names))).alias("fila"))


def read_staging(spark: SparkSession, path: str | list[str], spec: TableSpec, *, on_bad_date: str = "raise",
                 multi_line: bool = False, date_formats: Iterable[str] = DATE_FORMATS) -> DataFrame:
    """One staging table; `path` may be a glob over many months."""
    text = normalize_columns(read_csv_text(spark, path, multi_line=multi_line))
    return apply_types(text, spec, on_bad_date=on_bad_date, date_formats=date_formats)


def read_bulletin(spark: SparkSession, folder: str, files: Mapping[str, tuple[str, TableSpec]] = STAGING_FILES, *,
                  on_bad_date: str = "raise", multi_line: bool = False, date_formats: Iterable[str] = DATE_FORMATS
                  ) -> dict[str, DataFrame]:
    """All staging tables of a folder. Every file must exist."""
    paths = _bulletin_paths(spark, folder, files)
    return {table: read_staging(spark, paths[table], spec, on_bad_date=on_bad_date, multi_line=multi_line,
                                date_formats=date_formats)
            for table, (_, spec) in files.items()}


def rejected_bulletin(spark: SparkSession, folder: str, files: Mapping[str, tuple[str, TableSpec]] = STAGING_FILES, *,
                      multi_line: bool = False, date_formats: Iterable[str] = DATE_FORMATS) -> DataFrame:
    """tabla, rechazadas, fila: the rows of all staging tables that lose a cell, with the lost columns and the row's text."""
    paths = _bulletin_paths(spark, folder, files)

    def rejects(table: str, spec: TableSpec) -> DataFrame:
        text = normalize_columns(read_csv_text(spark, paths[table], multi_line=multi_line))
        return rejected_cells(text, spec, date_formats=date_formats).select(
            F.lit(table).alias("tabla"), "rechazadas", F.to_json(F.struct(*spec.names)).alias("fila"))

    return reduce(DataFrame.unionByName, [rejects(table, spec) for table, (_, spec) in files.items()])


def read_bulletin_with_rejects(spark: SparkSession, folder: str,
                               files: Mapping[str, tuple[str, TableSpec]] = STAGING_FILES, *, on_bad_date: str = "raise",
                               multi_line: bool = False, date_formats: Iterable[str] = DATE_FORMATS
                               ) -> dict[str, DataFrame]:
    """As `read_bulletin`, each table with `rechazadas` and `fila` as `typed_with_rejects` adds them."""
    paths = _bulletin_paths(spark, folder, files)
    return {table: typed_with_rejects(normalize_columns(read_csv_text(spark, paths[table], multi_line=multi_line)), spec,
                                      on_bad_date=on_bad_date, date_formats=date_formats)
            for table, (_, spec) in files.items()}


def _bulletin_paths(spark: SparkSession, folder: str, files: Mapping[str, tuple[str, TableSpec]]) -> dict[str, str]:
    paths = {table: f"{folder.rstrip('/')}/{name}" for table, (name, _) in files.items()}
    require_paths(spark, paths.values())
    return paths


def read_income_index(spark: SparkSession, path: str | None) -> DataFrame:
    """The classification index, or an empty table of its declared shape when there is no file."""
    if path is None or not _found(spark, path):
        return spark.createDataFrame([], INCOME_INDEX.schema)
    return apply_types(normalize_columns(read_csv_text(spark, path)), INCOME_INDEX)


def _found(spark: SparkSession, path: str) -> bool:
    try:
        require_paths(spark, [path])
    except FileNotFoundError:
        return False
    return True
