"""Places and running totals of rows within a key, for keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuota.llm.common import stored

# Row numbers of one task begin here in what monotonically_increasing_id gives; above stands the task.
_TASK_BIT = 33


def _in_order(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The rows stored in ranges of the columns: `_at` ascends through all ranges. Equal rows may part at a boundary."""
    spread = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*columns, "_tie")
    return stored(spread.sortWithinPartitions(*columns, "_tie").drop("_tie")
                  .withColumn("_at", F.monotonically_increasing_id()), name)


def _task() -> Column:
    return F.shiftright("_at", _TASK_BIT)


def ranked(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """`df` with `_rank`: each row's place, from 0, among the rows of its `key` (not null) in the order given.

    Rows are spread by ranges of key and order, so a key that holds most rows fills many tasks. A row's place is its
    number within its task plus the rows of its key in the tasks before, of which there is one small row a task and key.
    Give stored rows: Spark samples them once to find the ranges.
    """
    rows = _in_order(df, [key, *order], name)
    parts = rows.groupBy(F.col(key).alias("_k"), _task().alias("_task")).agg(F.count("*").alias("_n"),
                                                                            F.min("_at").alias("_first"))
    before = Window.partitionBy("_k").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select("_k", "_task", (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_shift"))
    joined = rows.join(shifts, (F.col(key) == F.col("_k")) & (_task() == F.col("_task")))
    return joined.withColumn("_rank", F.col("_at") - F.col("_shift")).drop("_k", "_task", "_shift", "_at")


def running_totals(df: DataFrame, size: str, order: list[str], name: str) -> DataFrame:
    """`df` with `_before`: the sum of `size` over all rows before, in the order given. Sums run within a task, and the
    tasks' own sums, one row each, are added up over the tasks."""
    rows = _in_order(df, order, name).withColumn("_task", _task())
    tasks = rows.groupBy("_task").agg(F.sum(size).alias("_sum"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = tasks.select("_task", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_task").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(size).over(within), F.lit(0))
    return rows.withColumn("_own", own).join(shifts, "_task").withColumn(
        "_before", F.col("_own") + F.col("_shift")).drop("_own", "_shift", "_task", "_at")
