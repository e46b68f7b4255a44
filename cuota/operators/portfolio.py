"""Portfolio table: consolidation, cutoff, trailing share and composition at the cutoff."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.functions.amounts import share_of, share_of_positive, total
from cuota.functions.dates import as_date, month_start
from cuota.functions.text import strip_blanks
from cuota.specs import PORTFOLIO, WINDOW_MONTHS

Cutoff = str | date | Column


def consolidate_portfolio(parts: Sequence[DataFrame], *, scale: int | None = None) -> DataFrame:
    """Sum the long parts to one row per (fecha, banco, producto); rows with a null key are dropped."""
    keys = ["fecha", "banco", "producto"]
    facts = reduce(DataFrame.unionByName, [part.select(*PORTFOLIO.names) for part in parts])
    summed = facts.dropna(subset=keys).groupBy(*keys).agg(total(F.col("monto"), scale).cast("double").alias("monto"))
    return summed.select("fecha", strip_blanks(F.col("banco")).alias("banco"),
                         strip_blanks(F.col("producto")).alias("producto"), "monto")


def _clamped(first: Column, last: Column, cutoff: Cutoff) -> Column:
    empty = F.raise_error(F.lit("the portfolio table is empty; load it first")).cast("date")
    wanted = F.greatest(month_start(first), F.least(month_start(last), month_start(as_date(cutoff))))
    return F.when(first.isNull(), empty).otherwise(wanted)


def adjust_cutoffs(portfolio: DataFrame, cutoffs: Sequence[str]) -> DataFrame:
    """pedido, min_mes, max_mes, corte: each asked cutoff moved into the months the table holds."""
    bounds = portfolio.agg(F.min("fecha").alias("_first"), F.max("fecha").alias("_last"))
    asked = F.explode(F.array(*[F.to_date(F.lit(cutoff)) for cutoff in cutoffs]))
    return bounds.select("_first", "_last", asked.alias("pedido")).select(
        "pedido", month_start(F.col("_first")).alias("min_mes"), month_start(F.col("_last")).alias("max_mes"),
        _clamped(F.col("_first"), F.col("_last"), F.col("pedido")).alias("corte"),
    )


def adjusted_cutoff(portfolio: DataFrame, cutoff: str) -> date:
    """The adjusted cutoff month as a plain date: one row is fetched.

    A literal in the later range filter reaches file pruning when the plan is made; a subquery's result would not.
    """
    return adjust_cutoffs(portfolio, [cutoff]).first()["corte"]


def in_window(portfolio: DataFrame, cutoff: Cutoff, months: int = WINDOW_MONTHS) -> DataFrame:
    """The rows of the `months` months up to the cutoff's, by a range on the raw date column."""
    last = month_start(as_date(cutoff))
    return portfolio.filter(F.col("fecha").between(F.add_months(last, 1 - months), last))


def trailing_share(portfolio: DataFrame, cutoff: Cutoff, *, months: int = WINDOW_MONTHS, scale: int | None = None,
                   ordered: bool = True) -> DataFrame:
    """mes, banco, producto, monto_mes, total_mes, share_mes over the `months` months up to the cutoff's.

    The range is put on the raw date column so that it reaches the file scan. The upper bound is the first day of the
    cutoff month: facts carry month starts.
    """
    base = (
        in_window(portfolio, cutoff, months)
        .groupBy(month_start(F.col("fecha")).alias("mes"), "banco", "producto")
        .agg(total(F.col("monto"), scale).alias("monto_mes"))
        .filter(F.col("mes").isNotNull())  # the join would test it on the totals' side only and part the two uses
    )
    totals = base.groupBy("mes").agg(F.sum("monto_mes").alias("total_mes"))
    # `totals` has `months` rows at most, whatever the input; it reuses the shuffle of `base`. Every month has a total: the
    # left join is dropped with the totals where nothing asks for them.
    shares = base.join(F.broadcast(totals), "mes", "left").select(
        "mes", "banco", "producto", F.col("monto_mes").cast("double").alias("monto_mes"),
        F.col("total_mes").cast("double").alias("total_mes"),
        share_of(F.col("monto_mes"), F.col("total_mes")).alias("share_mes"),
    )
    return shares.orderBy("mes", "banco", "producto") if ordered else shares


def composition(shares: DataFrame, cutoff: Cutoff, *, scale: int | None = None) -> DataFrame:
    """The rows of the cutoff month with total_banco and share_producto. Empty when the month has no rows."""
    amount = F.col("monto_mes") if scale is None else F.col("monto_mes").cast(f"decimal(28,{scale})")
    # One row per product in each group: the input is summed already.
    per_bank = F.sum(amount).over(Window.partitionBy("banco")).cast("double")
    return shares.filter(F.col("mes") == month_start(as_date(cutoff))).withColumn("total_banco", per_bank).withColumn(
        "share_producto", share_of_positive(F.col("monto_mes"), F.col("total_banco")))


def cutoff_composition(portfolio: DataFrame, cutoff: Cutoff, *, scale: int | None = None) -> DataFrame:
    """`composition` straight from the portfolio table, reading the cutoff month only."""
    return composition(trailing_share(portfolio, cutoff, months=1, scale=scale, ordered=False), cutoff, scale=scale)


def product_names(compo: DataFrame) -> list[str]:
    """The products of a composition in name order. Runs a job; give it a stored composition, which is small."""
    return [row["producto"] for row in compo.select("producto").where("producto is not null").distinct()
            .orderBy("producto").collect()]


def dense_composition(compo: DataFrame, products: Sequence[str] | None = None) -> DataFrame:
    """banco, producto, share_producto for every bank and every product of `compo`; null where a bank lacks one.

    A bank's shares, one per product, become a map that the products are looked up in. Without a list the products are
    those of the composition, which is read for them: store it before. With a list a product that is not on it is an error.
    """
    names = sorted(set(product_names(compo) if products is None else products))
    share = F.when(F.col("producto").isNotNull(), F.struct("producto", "share_producto"))
    per_bank = compo.groupBy("banco").agg(F.map_from_entries(F.collect_list(share)).alias("_shares"))
    listed = F.array(*[F.lit(p) for p in names]).cast("array<string>")
    others = F.array_except(F.map_keys("_shares"), listed)
    known = F.when(F.size(others) > 0, F.raise_error(F.concat(F.lit("products not listed: "), F.array_join(others, ", ")))
                   .cast("array<string>")).otherwise(listed)
    return per_bank.select("banco", "_shares", F.explode(known).alias("producto")).select(
        "banco", "producto", F.try_element_at("_shares", F.col("producto")).alias("share_producto"))


def stack_bases(compo: DataFrame, products: Sequence[str] | None = None) -> DataFrame:
    """banco, producto, share_producto, base: where each bar of the stacked view starts, products in name order."""
    below = Window.partitionBy("banco").orderBy("producto").rowsBetween(Window.unboundedPreceding, -1)
    height = F.coalesce(F.col("share_producto"), F.lit(0.0))
    return dense_composition(compo, products).withColumn("base", F.coalesce(F.sum(height).over(below), F.lit(0.0)))


def composition_matrix(compo: DataFrame, products: Sequence[str] | None = None) -> DataFrame:
    """One row per bank, one column per product of `compo` (or of the list, others being an error); null where a bank
    lacks it."""
    names = product_names(compo) if products is None else list(products)
    dense = dense_composition(compo, names)
    return dense.groupBy("banco").pivot("producto", names).agg(F.max("share_producto")).orderBy("banco")
