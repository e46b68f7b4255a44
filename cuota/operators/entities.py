"""Lookups of institution codes, names and groups."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuota.functions.text import normalize_name, title_case
from cuota.specs import BANK_GROUPS, ENTITY_NAMES, ENTITY_SUCCESSORS, UNNAMED_ENTITY

Lookup = Mapping | DataFrame


def as_dimension(spark: SparkSession, lookup: Lookup, key: str, value: str) -> DataFrame:
    """A two-column dimension.

    A dict becomes a local relation of known size. Spark broadcasts either kind if its measured size allows, and otherwise
    does a shuffled join, splitting skewed partitions.
    """
    if isinstance(lookup, DataFrame):
        return _one_row_per_key(lookup.toDF(key, value), key, value)
    table = pa.table({key: list(lookup.keys()), value: list(lookup.values())})
    return spark.createDataFrame(table)


def _one_row_per_key(dimension: DataFrame, key: str, value: str) -> DataFrame:
    """The dimension, failing on a key that is listed twice, which would multiply the rows joined to it."""
    twice = F.raise_error(F.concat(F.lit("lookup key listed twice: "), F.col(key).cast("string")))
    return dimension.where(F.col(key).isNotNull()).groupBy(key).agg(F.when(F.count("*") == 1, F.min(value)).otherwise(
        twice.cast(dimension.schema[value].dataType)).alias(value))


def look_up(df: DataFrame, lookup: Lookup, key: Column, otherwise: Column, out: str) -> DataFrame:
    """Set `out` to the looked-up value of `key`, or to `otherwise`. A key listed twice in a lookup table is an error."""
    dimension = as_dimension(df.sparkSession, lookup, "_lookup_key", "_lookup_value")
    joined = df.join(dimension, key == F.col("_lookup_key"), "left")
    value = F.coalesce(F.col("_lookup_value"), otherwise)
    kept = [value.alias(out) if name == out else df[name] for name in df.columns]
    return joined.select(*kept, *([] if out in df.columns else [value.alias(out)]))


def remap_entities(df: DataFrame, successors: Lookup = ENTITY_SUCCESSORS, code: str = "codigo_entidad") -> DataFrame:
    """Replace the code of a merged institution by its successor's. One hop; a null code stays null."""
    return look_up(df, successors, df[code], df[code], code)


def name_entities(df: DataFrame, names: Lookup = ENTITY_NAMES, code: str = "codigo_entidad", out: str = "entidad",
                  unnamed: str = UNNAMED_ENTITY) -> DataFrame:
    """Add the institution's name; unknown and null codes get `unnamed`."""
    return look_up(df, names, df[code], F.lit(unnamed), out)


def group_names(names: Column, groups: Mapping) -> Column:
    """An array of spelled institution names, each replaced as `group_banks` does."""
    listed = F.create_map(*[F.lit(part) for pair in groups.items() for part in pair])
    folded = F.transform(names, normalize_name)
    if not groups:
        return F.transform(folded, title_case)
    return F.transform(folded, lambda name: F.coalesce(F.try_element_at(listed, name), title_case(name)))


def group_banks(df: DataFrame, raw: str, groups: Lookup = BANK_GROUPS, out: str = "banco") -> DataFrame:
    """Group of a spelled institution name, or the folded name in title case when it belongs to none."""
    keyed = df.withColumn("_folded", normalize_name(F.col(raw)))
    grouped = look_up(keyed, groups, keyed["_folded"], title_case(keyed["_folded"]), out)
    return grouped.drop("_folded")
