"""Monthly shares over the consolidated tables, delinquency, and the small summaries behind a chart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuota.functions.amounts import share_of, share_of_positive, total
from cuota.functions.dates import month_label, month_start
from cuota.specs import CARD_CLASSES, CREDIT_PRODUCTS


def with_share(summed: DataFrame, amount: str, by: Sequence[str], out: str = "share") -> DataFrame:
    """Add `amount` over its total per `by`; null when that total is 0 or a `by` column is null.

    The totals are a second group-by over the already summed rows, joined back, instead of a window that would sort
    every row of a month in one task. The caller bounds the number of `by` groups: asked categories times calendar
    months.
    """
    totals = summed.groupBy(*[F.col(name).alias(f"_{name}") for name in by]).agg(F.sum(amount).alias("_total"))
    joined = summed.join(F.broadcast(totals), [F.col(name) == F.col(f"_{name}") for name in by], "left")
    return joined.withColumn(out, share_of(F.col(amount), F.col("_total"))).drop("_total", *[f"_{n}" for n in by])


def _monthly(df: DataFrame, category: str, wanted: Sequence[str], out: str, sums: dict[str, str],
             scale: int | None) -> DataFrame:
    """One pass over all wanted categories (matched ignoring case): their sums per month and institution."""
    key = F.upper(category)
    return df.filter(key.isin(*[name.upper() for name in wanted])).groupBy(
        key.alias(out), month_start(F.col("fecha")).alias("mes"), "entidad"
    ).agg(*[total(F.col(source), scale, summed=True).alias(name) for name, source in sums.items()])


def monthly_credit_by_product(credit: DataFrame, products: Sequence[str] = CREDIT_PRODUCTS, *, scale: int | None = None
                              ) -> DataFrame:
    """producto, mes, entidad, monto, vencida, share, morosidad."""
    summed = _monthly(credit, "actividad", products, "producto", {"monto": "cartera_total", "vencida": "cartera_vencida"},
                      scale)
    return with_share(summed, "monto", ["producto", "mes"]).select(
        "producto", "mes", "entidad", F.col("monto").cast("double").alias("monto"),
        F.col("vencida").cast("double").alias("vencida"), "share",
        delinquency(F.col("vencida"), F.col("monto")).alias("morosidad"),
    ).orderBy("producto", "mes", "entidad")


def monthly_credit(credit: DataFrame, product: str, *, scale: int | None = None) -> DataFrame:
    """mes, entidad, monto, vencida, share, morosidad of one product."""
    return monthly_credit_by_product(credit, [product], scale=scale).drop("producto")


def monthly_cards_by_class(cards: DataFrame, classes: Sequence[str] = CARD_CLASSES, *, scale: int | None = None
                           ) -> DataFrame:
    """clasificacion, mes, entidad, total, share."""
    summed = _monthly(cards, "clasificacion", classes, "clasificacion", {"total": "total"}, scale)
    return with_share(summed, "total", ["clasificacion", "mes"]).select(
        "clasificacion", "mes", "entidad", F.col("total").cast("double").alias("total"), "share",
    ).orderBy("clasificacion", "mes", "entidad")


def monthly_cards(cards: DataFrame, card_class: str, *, scale: int | None = None) -> DataFrame:
    """mes, entidad, total, share of one card class."""
    return monthly_cards_by_class(cards, [card_class], scale=scale).drop("clasificacion")


def delinquency(overdue: Column, amount: Column) -> Column:
    """Overdue part of an amount; null unless the amount is above 0."""
    return share_of_positive(overdue, amount)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column, each once, sorted."""
    return df.select(column).distinct().orderBy(column)


def absent_values(df: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    """columna, valor: the asked values (matched ignoring case) that no row has. What is gathered is asked values only."""
    upper, asked = F.upper(column), F.array(*[F.lit(name.upper()) for name in wanted]).cast("array<string>")
    found = df.agg(F.collect_set(F.when(F.array_contains(asked, upper), upper)).alias("_found"))
    return found.select(F.lit(column).alias("columna"), F.explode(F.array_except(asked, "_found")).alias("valor"))


def period_bounds(df: DataFrame, month: str = "mes", by: Sequence[str] = ()) -> DataFrame:
    """desde, hasta and their label, such as 'Apr-23 a Mar-25', of the whole table or per `by`."""
    bounds = df.groupBy(*by).agg(F.min(month).alias("desde"), F.max(month).alias("hasta"))
    label = F.concat_ws(" a ", month_label(F.col("desde")), month_label(F.col("hasta")))
    return bounds.withColumn("periodo", label)


def share_cap(df: DataFrame, share: str) -> DataFrame:
    """Upper end of a share axis: a fifth above the largest share, 1 at most."""
    return df.agg(F.least(F.lit(1.0), F.max(share) * 1.2).alias("tope"))
