"""Tidy CSV tables to the three final tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cuota.operators.consolidate import (classify_income, consolidate_cards, consolidate_credit, consolidate_income,
                                         profile_metrics, repeated_keys)
from cuota.operators.entities import Lookup
from cuota.operators.shares import absent_values, monthly_cards_by_class, monthly_credit_by_product, period_bounds
from cuota.sinks.tables import write_table
from cuota.sources.staging import DATE_FORMATS, read_bulletin, read_bulletin_with_rejects, read_income_index
from cuota.specs import CARD_CLASSES, CREDIT_PRODUCTS, ENTITY_NAMES, ENTITY_SUCCESSORS, STAGING_FILES, TableSpec

# Final tables and the order their rows are stored in.
FINAL_ORDER = {
    "credito_sector": ["fecha", "entidad", "actividad"],
    "tarjetas": ["fecha", "entidad", "clasificacion"],
    "estado_resultados": ["fecha", "entidad", "sub_rubro"],
}


def consolidate_bulletin(staging: dict[str, DataFrame], index: DataFrame, *, successors: Lookup = ENTITY_SUCCESSORS,
                         names: Lookup = ENTITY_NAMES, scale: int | None = None) -> dict[str, DataFrame]:
    """The final tables as lazy DataFrames; no table is written in between."""
    options = {"successors": successors, "names": names, "scale": scale}
    income = consolidate_income(staging["erbi"], staging["erfi"], **options)
    return {
        "credito_sector": consolidate_credit(staging["csbi"], staging["csfi"], **options),
        "tarjetas": consolidate_cards(staging["tcbi"], staging["tcfi"], **options),
        "estado_resultados": classify_income(income, index),
    }


def load_bulletin(spark: SparkSession, folder: str, out: str, *, files: Mapping[str, tuple[str, TableSpec]] = STAGING_FILES,
                  index_path: str | None = None, on_bad_date: str = "raise", multi_line: bool = False,
                  scale: int | None = None, date_formats: Iterable[str] = DATE_FORMATS, rejects: bool = True
                  ) -> dict[str, DataFrame]:
    """Read a folder of tidy CSV files, write the final tables under `out` and return them with their profile.

    The profile (`perfil`) is taken of the rows as they are written, so no table is read again for it.
    `claves_repetidas` lists the index keys that multiply income lines, and `rechazos` (tabla, rechazadas, fila) the rows that
    lost a cell. For the latter the typed rows are stored under `out`/staging first, so that the files are read once for
    both; with rejects=False nothing is stored but the final tables, and `rechazos` is left out. For a folder of exported
    sheets pass files=EXPORTED_FILES and multi_line=True.
    """
    options = {"on_bad_date": on_bad_date, "multi_line": multi_line, "date_formats": tuple(date_formats)}
    if rejects:
        read = {name: write_table(df, f"{out.rstrip('/')}/staging/{name}")
                for name, df in read_bulletin_with_rejects(spark, folder, files, **options).items()}
        staging = {name: df.drop("rechazadas", "fila") for name, df in read.items()}
        refused = {"rechazos": reduce(DataFrame.unionByName, [
            df.filter(F.col("fila").isNotNull()).select(F.lit(name).alias("tabla"), "rechazadas", "fila")
            for name, df in read.items()])}
    else:
        staging, refused = read_bulletin(spark, folder, files, **options), {}
    index = read_income_index(spark, index_path)
    finals = consolidate_bulletin(staging, index, scale=scale)
    seen = {name: Observation(name) for name in finals}
    stored = {name: write_table(df, f"{out.rstrip('/')}/{name}", sort_by=FINAL_ORDER[name],
                                watch=(seen[name], profile_metrics()))
              for name, df in finals.items()}
    profile = spark.createDataFrame([{"tabla": name, **observation.get} for name, observation in seen.items()],
                                    "tabla string, filas bigint, min_fecha date, max_fecha date")
    return {**stored, "perfil": profile, "claves_repetidas": repeated_keys(index), **refused}


def share_reports(finals: dict[str, DataFrame], *, products: Sequence[str] = CREDIT_PRODUCTS,
                  classes: Sequence[str] = CARD_CLASSES, scale: int | None = None) -> dict[str, DataFrame]:
    """Monthly shares of the asked products and card classes, the period each covers, and those without any rows."""
    credit = monthly_credit_by_product(finals["credito_sector"], products, scale=scale)
    cards = monthly_cards_by_class(finals["tarjetas"], classes, scale=scale)
    return {"credito": credit, "tarjetas": cards, "periodo_credito": period_bounds(credit, by=["producto"]),
            "periodo_tarjetas": period_bounds(cards, by=["clasificacion"]),
            "sin_filas": absent_values(finals["credito_sector"], "actividad", products).unionByName(
                absent_values(finals["tarjetas"], "clasificacion", classes))}
