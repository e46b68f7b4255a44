"""Wide workbooks to the portfolio table, and from it the trailing share and the composition at the cutoff."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cuota.operators.portfolio import adjusted_cutoff, composition, consolidate_portfolio, in_window, trailing_share
from cuota.operators.sheets import unpivot_wide_sheets
from cuota.sinks.tables import read_table, refresh_table, write_csv, write_table
from cuota.sources.listing import require_paths
from cuota.sources.workbooks import read_workbooks, whole_workbooks
from cuota.specs import DEFAULT_CUTOFF, PORTFOLIO


def load_portfolio(spark: SparkSession, workbooks: list[str], rows_path: str, table_path: str, *,
                   on_bad_month: str = "raise", on_bad_file: str = "raise", scale: int | None = None) -> DataFrame:
    """Read workbooks, keep their sheet rows under `rows_path`, and refresh the portfolio table.

    Both wide sheets of all workbooks go through one pass. The rows are stored because parsing a workbook is the
    dear step and the next one reads them twice. What was refused is told from them: `rejected_workbooks` lists damaged
    files (on_bad_file='reject' leaves such files out whole), `rejected_months` rows with unreadable months.
    """
    require_paths(spark, workbooks)
    rows = write_table(read_workbooks(spark, workbooks, on_bad_file=on_bad_file), rows_path)
    if on_bad_file == "reject":
        rows = whole_workbooks(rows)
    facts = consolidate_portfolio([unpivot_wide_sheets(rows, on_bad_month=on_bad_month)], scale=scale)
    return refresh_table(facts, table_path, PORTFOLIO, sort_by=["fecha", "banco", "producto"])


def open_portfolio(spark: SparkSession, table_path: str) -> DataFrame:
    """The portfolio table as loaded before."""
    return read_table(spark, table_path, PORTFOLIO.schema)


def market_share_report(portfolio: DataFrame, cutoff: str = DEFAULT_CUTOFF, *, scale: int | None = None
                        ) -> tuple[DataFrame, DataFrame]:
    """(share, composition) for the cutoff moved into the available months."""
    return _report(portfolio, adjusted_cutoff(portfolio, cutoff), scale)


def _report(portfolio: DataFrame, month: date, scale: int | None) -> tuple[DataFrame, DataFrame]:
    shares = trailing_share(portfolio, month, scale=scale)
    return shares, composition(trailing_share(portfolio, month, months=1, scale=scale, ordered=False), month,
                               scale=scale)


def write_report(portfolio: DataFrame, out: str, cutoff: str = DEFAULT_CUTOFF, *, scale: int | None = None) -> None:
    """Write both results as CSV. An empty window is an error; an empty composition is not."""
    month = adjusted_cutoff(portfolio, cutoff)
    if in_window(portfolio, month).isEmpty():  # ends at the first row
        raise ValueError("no portfolio rows in the asked window")
    shares, mix = _report(portfolio, month, scale)
    write_csv(shares, f"{out.rstrip('/')}/share_24m", sort_by=["mes", "banco", "producto"])
    write_csv(mix, f"{out.rstrip('/')}/compo_cutoff", sort_by=["mes", "banco", "producto"])
