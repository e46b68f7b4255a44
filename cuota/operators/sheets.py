"""Wide workbook sheets to long facts, and the choice of sheets to export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.functions.amounts import to_double
from cuota.functions.dates import parse_month
from cuota.functions.text import normalize_name, normalize_text
from cuota.operators.entities import Lookup, group_banks, group_names
from cuota.operators.fill import CHUNK_ROWS, carried, chunk_of, fill_within_chunks, join_chunks
from cuota.specs import BANK_GROUPS, CARD_SHEET, CREDIT_SHEET, SHEET_TARGETS, SheetTarget, WideSheet

_SHEET = ["file", "sheet"]
_CHUNK = ["file", "sheet", "_chunk"]


def _blank(text: Column, kind: Column) -> Column:
    """No value, an empty text or the number 0."""
    zero = kind.isin("n", "b") & (text.try_cast("double") == 0)
    return text.isNull() | (text == "") | F.coalesce(zero, F.lit(False))


def _entity_names() -> Column:
    """Header cells from the fourth on, up to the first blank one."""
    cells = F.slice(F.arrays_zip("cells", "types"), 4, F.greatest(F.size("cells") - 3, F.lit(0)))
    gap = F.array_position(F.transform(cells, lambda c: _blank(c["cells"], c["types"])), True)
    length = F.when(gap == 0, F.size(cells)).otherwise((gap - 1).cast("int"))
    return F.slice(F.transform(cells, lambda c: c["cells"]), 1, length)


def _relevant_rows(rows: DataFrame, layouts: Sequence[WideSheet], chunk_rows: int) -> DataFrame:
    """Header, end, month and product rows only, cut down to what each is needed for, before anything is shuffled."""
    text, kind = F.get("cells", F.lit(1)), F.get("types", F.lit(1))
    category, category_kind = F.get("cells", F.lit(2)), F.get("types", F.lit(2))
    has_category = ~_blank(category, category_kind)

    def per_layout(test):
        return F.coalesce(reduce(lambda a, b: a | b, [(F.col("sheet") == s.sheet) & test(s) for s in layouts]),
                          F.lit(False))

    def heading(layout):
        known = category.startswith(layout.header_category) if layout.header_category else has_category
        return (text == layout.header_date) & (kind == "s") & known

    names = _entity_names()
    labels = F.create_map(*[F.lit(part) for s in layouts for key, label in s.categories.items()
                            for part in (f"{s.sheet}\n{key}", label)])
    label = F.try_element_at(labels, F.concat(F.col("sheet"), F.lit("\n"), normalize_name(category)))
    marked = rows.filter(F.col("sheet").isin(*[s.sheet for s in layouts])).select(
        *_SHEET, "row_no", chunk_of(F.col("row_no"), chunk_rows).alias("_chunk"),
        F.when(per_layout(heading) & (F.size(names) > 0), names).alias("_names"),
        (per_layout(lambda s: text.startswith(s.stop_prefix)) & (kind == "s")).alias("_stop"),
        F.when(~_blank(text, kind), F.struct(text.alias("text"), parse_month(text, kind).alias("month"))).alias("_month"),
        F.when(has_category, label).alias("producto"),
        "cells",
    )
    wanted = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in ("_names", "_month", "producto")])
    values = F.slice("cells", 4, F.greatest(F.size("cells") - 3, F.lit(0)))
    return marked.filter(wanted | F.col("_stop")).withColumn("cells", F.when(F.col("producto").isNotNull(), values))


def _chunk_bounds(marked: DataFrame, groups: Mapping | None) -> DataFrame:
    """Per chunk: the sheet's header row, institution names (or groups), end row and the month carried in from before.

    A chunk gives one small row (at most its own row count of end rows); the windows run over those.
    """
    chunks = marked.groupBy(*_CHUNK).agg(
        F.min(F.when(F.col("_names").isNotNull(), F.struct("row_no", "_names"))).alias("_head"),
        F.collect_list(F.when(F.col("_stop"), F.col("row_no"))).alias("_stops"),
        F.max(F.when(F.col("_month").isNotNull(), F.struct("row_no", "_month"))).alias("_last"),
    )
    sheet, names = Window.partitionBy(*_SHEET), F.col("_head._names")
    headed = chunks.withColumn("_head", F.min("_head").over(sheet)).select(
        *_CHUNK, F.col("_head.row_no").alias("_header"), (names if groups is None else group_names(names, groups)).alias("_entities"),
        F.array_min(F.filter("_stops", lambda row: row > F.col("_head.row_no"))).alias("_stop_here"),
        F.when(F.col("_last.row_no") > F.col("_head.row_no"), F.col("_last._month")).alias("_last_month"),
    )
    return headed.select(*_CHUNK, "_header", "_entities", F.min("_stop_here").over(sheet).alias("_end"),
                         carried(_SHEET, "_last_month").alias("_carry")).filter(F.col("_header").isNotNull())


def body_rows(rows: DataFrame, layouts: Sequence[WideSheet] = (CREDIT_SHEET, CARD_SHEET), *,
              on_bad_month: str = "raise", chunk_rows: int = CHUNK_ROWS, groups: Mapping | None = None) -> DataFrame:
    """Product rows between header and end row with their month filled down: file, sheet, row_no, fecha, producto,
    month text, institution names and values. With `groups` the names are replaced by their groups, once per header.

    With on_bad_month='null' an unreadable month gives a null `fecha` (see `rejected_months`).
    """
    marked = _relevant_rows(rows, layouts, chunk_rows)
    inside = join_chunks(marked, _chunk_bounds(marked, groups), _CHUNK).filter(
        (F.col("row_no") > F.col("_header")) & (F.col("_end").isNull() | (F.col("row_no") < F.col("_end"))))
    if on_bad_month == "raise":
        unread = F.col("_month").isNotNull() & F.col("_month.month").isNull()
        problem = F.concat_ws(" ", F.lit("unreadable month:"), "file", "sheet", "row_no", "_month.text")
        inside = inside.withColumn("_month", F.when(unread, F.raise_error(problem).cast(
            "struct<text:string,month:date>")).otherwise(F.col("_month")))
    filled = inside.withColumn("_filled", fill_within_chunks(inside, _SHEET, "row_no", "_month", "_carry"))
    return filled.filter(F.col("producto").isNotNull() & F.col("_filled").isNotNull()).select(
        *_SHEET, "row_no", F.col("_filled.month").alias("fecha"), F.col("_filled.text").alias("texto_mes"),
        "producto", "_entities", "cells")


def rejected_months(rows: DataFrame, layouts: Sequence[WideSheet] = (CREDIT_SHEET, CARD_SHEET), *,
                    chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Product rows whose month cannot be read."""
    body = body_rows(rows, layouts, on_bad_month="null", chunk_rows=chunk_rows)
    return body.filter(F.col("fecha").isNull()).select(*_SHEET, "row_no", "texto_mes", "producto")


def unpivot_wide_sheets(rows: DataFrame, layouts: Sequence[WideSheet] = (CREDIT_SHEET, CARD_SHEET), *,
                        groups: Lookup = BANK_GROUPS, on_bad_month: str = "raise", chunk_rows: int = CHUNK_ROWS
                        ) -> DataFrame:
    """fecha, banco, producto, monto: one row per institution cell that holds a value."""
    known = groups if isinstance(groups, Mapping) else None  # a lookup table has to be joined per cell
    body = body_rows(rows, layouts, on_bad_month=on_bad_month, chunk_rows=chunk_rows, groups=known)
    # Header and values pair up by position; the shorter list wins.
    width = F.least(F.size("_entities"), F.size("cells"))
    pairs = F.arrays_zip(F.slice("_entities", 1, width).alias("entity"), F.slice("cells", 1, width).alias("value"))
    cells = body.filter(F.col("fecha").isNotNull()).select("fecha", "producto", F.explode(pairs).alias("_pair")).select(
        "fecha", "producto", F.col("_pair.entity").alias("_entity"), F.col("_pair.value").alias("_value"))
    stated = cells.filter(F.col("_value").isNotNull() & (F.lower(F.trim("_value")) != "nan"))
    amounts = stated.withColumn("monto", F.coalesce(to_double(F.col("_value")), F.raise_error(
        F.concat(F.lit("no number: "), "_value")).cast("double")))
    named = amounts.withColumnRenamed("_entity", "banco") if known is not None else group_banks(amounts, "_entity", groups)
    return named.select("fecha", "banco", "producto", "monto")


def missing_sheets(sheets: DataFrame, targets: Sequence[SheetTarget] = SHEET_TARGETS, **columns: str) -> DataFrame:
    """file, target: the targets no sheet of a workbook fits. Takes what `select_sheets` takes."""
    file = columns.get("file", "file")
    wanted = F.explode(F.array(*[F.lit(target.label) for target in targets])).alias("target")
    asked = sheets.select(F.col(file).alias("file")).distinct().select("file", wanted)
    return asked.join(select_sheets(sheets, targets, **columns), ["file", "target"], "left_anti")


def select_sheets(sheets: DataFrame, targets: Sequence[SheetTarget] = SHEET_TARGETS, *, file: str = "file",
                  title: str = "sheet", position: str = "sheet_pos") -> DataFrame:
    """file, target, sheet: for each target the first sheet, in workbook order, whose title has all its keywords."""
    folded = sheets.select(F.col(file).alias("file"), F.col(title).alias("sheet"), F.col(position).alias("_pos"),
                           normalize_text(F.col(title)).alias("_title"))
    hits = F.array_compact(F.array(*[
        F.when(reduce(lambda a, b: a & b, [F.col("_title").contains(word) for word in target.keywords]),
               F.lit(target.label))
        for target in targets
    ]))
    matched = folded.select("file", "sheet", "_pos", F.explode(hits).alias("target"))
    return matched.groupBy("file", "target").agg(F.min_by("sheet", "_pos").alias("sheet"))
