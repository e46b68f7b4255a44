"""Raw sheet export and the file manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuota.operators.sheets import select_sheets
from cuota.sources.workbooks import workbook_sheets
from cuota.specs import CATEGORY_FILES, CATEGORY_SUFFIXES, SHEET_TARGETS, UNKNOWN_SUFFIX, SheetTarget


def _csv_field(value: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(value.isNull(), F.lit("")).when(value.rlike('[",\r\n]'), quoted).otherwise(value)


def institution_suffix(file: Column) -> Column:
    """BI or FI by the base name of the workbook file."""
    suffix = F.lit(UNKNOWN_SUFFIX)
    for category, base in CATEGORY_FILES.items():
        suffix = F.when(F.element_at(F.split(file, "/"), -1).startswith(base + "."),
                        F.lit(CATEGORY_SUFFIXES[category])).otherwise(suffix)
    return suffix


def sheet_lines(rows: DataFrame, targets: Sequence[SheetTarget] = SHEET_TARGETS) -> DataFrame:
    """file, salida, row_no, value: the chosen sheets as CSV lines. `salida` is the prefix plus BI or FI."""
    chosen = select_sheets(workbook_sheets(rows), targets)
    prefixes = F.create_map(*[F.lit(part) for t in targets for part in (t.label, t.prefix)])
    outputs = chosen.select("file", "sheet", F.concat(F.element_at(prefixes, F.col("target")),
                                                      institution_suffix(F.col("file"))).alias("salida"))

    def shown(cell: Column) -> Column:
        flag = F.when(cell["cells"] == "1", "True").otherwise("False")
        return _csv_field(F.when(cell["types"] == "b", flag).otherwise(cell["cells"]))

    line = F.array_join(F.transform(F.arrays_zip("cells", "types"), shown), ",")
    return rows.join(outputs, ["file", "sheet"]).select("file", "salida", "row_no", line.alias("value"))


def export_sheets(rows: DataFrame, path: str, targets: Sequence[SheetTarget] = SHEET_TARGETS) -> None:
    """One CSV file per workbook and target, in sheet order, under salida=<target>/libro=<workbook>.

    The file format holds a sheet to 1,048,576 rows, so writing one in one task is bounded. `libro` is a digest of the
    workbook's path, as base names repeat every month. Pass stored rows: they are read twice.
    """
    lines = sheet_lines(rows, targets).withColumn("libro", F.sha1("file"))
    ordered = lines.repartition("salida", "libro").sortWithinPartitions("salida", "libro", "row_no")
    ordered.select("salida", "libro", "value").write.mode("overwrite").partitionBy("salida", "libro").text(path)


def manifest(files: DataFrame, timestamp: str) -> DataFrame:
    """One row per file: timestamp, filename, path, size, modified."""
    return files.select(F.lit(timestamp).alias("timestamp"), "filename", "path", "size", "modified")


def write_manifest(files: DataFrame, path: str, timestamp: str) -> None:
    """JSON manifest, one line per file however many there are."""
    manifest(files, timestamp).write.mode("overwrite").json(path)
