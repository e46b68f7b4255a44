"""Consolidation of the bank and finance-company tables: union, successor codes, group-sum, names.

Sums are partially aggregated before the only shuffle of each family, so a hot (date, institution, category) key costs
one row per task. Nothing is sorted here; order is given where a table is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuota.functions.amounts import total_or_zero
from cuota.operators.entities import Lookup, name_entities, remap_entities
from cuota.specs import CARDS, CREDIT, ENTITY_NAMES, ENTITY_SUCCESSORS, INCOME, TableSpec


def union_institutions(parts: list[DataFrame], spec: TableSpec) -> DataFrame:
    """UNION ALL by name on the declared columns; a part that lacks one is an error."""
    for part in parts:
        absent = [name for name in spec.names if name not in part.columns]
        if absent:
            raise ValueError(f"{spec.name}: missing columns {', '.join(absent)}")
    return reduce(DataFrame.unionByName, [part.select(*spec.names) for part in parts])


def consolidate_credit(banks: DataFrame, finance: DataFrame, *, successors: Lookup = ENTITY_SUCCESSORS,
                       names: Lookup = ENTITY_NAMES, scale: int | None = None) -> DataFrame:
    """fecha, entidad, actividad, cartera_vigente, cartera_vencida, cartera_total.

    Names come after grouping by code, so several unnamed codes give several rows.
    """
    summed = (
        remap_entities(union_institutions([banks, finance], CREDIT), successors)
        .groupBy("fecha", "codigo_entidad", "actividad_destino_vs2")
        .agg(total_or_zero(F.col("cartera_vigente"), scale).alias("cartera_vigente"),
             total_or_zero(F.col("cartera_vencida"), scale).alias("cartera_vencida"))
    )
    return name_entities(summed, names).select(
        "fecha", "entidad", F.col("actividad_destino_vs2").alias("actividad"), "cartera_vigente", "cartera_vencida",
        (F.col("cartera_vigente") + F.col("cartera_vencida")).alias("cartera_total"),
    )


def consolidate_cards(banks: DataFrame, finance: DataFrame, *, successors: Lookup = ENTITY_SUCCESSORS,
                      names: Lookup = ENTITY_NAMES, scale: int | None = None) -> DataFrame:
    """fecha, entidad, clasificacion (upper case), total."""
    summed = (
        remap_entities(union_institutions([banks, finance], CARDS), successors)
        .groupBy("fecha", "codigo_entidad", "clasificacion")
        .agg(total_or_zero(F.col("total"), scale).alias("total"))
    )
    return name_entities(summed, names).select(
        "fecha", "entidad", F.upper("clasificacion").alias("clasificacion"), "total")


def consolidate_income(banks: DataFrame, finance: DataFrame, *, successors: Lookup = ENTITY_SUCCESSORS,
                       names: Lookup = ENTITY_NAMES, scale: int | None = None) -> DataFrame:
    """fecha, entidad, sub_rubro, importe, reporte. Currencies are added up; the least report label is kept."""
    keys = ["fecha", "codigo_entidad", "sub_rubro"]
    # A text minimum makes Spark sort each task's rows before the partial step (on disk where they do not fit). What is
    # shuffled is one row per key and task, however many labels a key has.
    summed = remap_entities(union_institutions([banks, finance], INCOME), successors).groupBy(*keys).agg(
        total_or_zero(F.col("importe"), scale).alias("importe"), F.min("reporte").alias("reporte"))
    return name_entities(summed, names).select("fecha", "entidad", "sub_rubro", "importe", "reporte")


def classify_income(income: DataFrame, index: DataFrame) -> DataFrame:
    """Attach the classification index. Unlisted lines keep nulls; a key listed twice doubles its lines."""
    return income.join(index, income["sub_rubro"] == index["sub_rubro_base"], "left").select(
        income["fecha"], income["entidad"], index["clasificacion"], index["rubro"], index["sub_rubro_reporte"],
        income["sub_rubro"], income["reporte"], income["importe"],
    )


def repeated_keys(index: DataFrame, key: str = "sub_rubro_base") -> DataFrame:
    """Index keys listed more than once, which multiply amounts in `classify_income`."""
    return index.groupBy(key).agg(F.count("*").alias("veces")).filter(F.col("veces") > 1)


def profile_metrics(date: str = "fecha") -> list[Column]:
    """Number of rows and first and last date of a table."""
    return [F.count(F.lit(1)).alias("filas"), F.min(date).alias("min_fecha"), F.max(date).alias("max_fecha")]


def profile_tables(tables: dict[str, DataFrame], date: str = "fecha") -> DataFrame:
    """tabla, filas, min_fecha, max_fecha: one row per table."""
    return reduce(DataFrame.unionByName, [
        df.agg(*profile_metrics(date)).select(F.lit(name).alias("tabla"), "filas", "min_fecha", "max_fecha")
        for name, df in tables.items()
    ])
