"""Table and CSV writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from cuota.specs import TableSpec


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """A table of a declared shape without rows."""
    return spark.createDataFrame([], spec.schema)


def write_table(df: DataFrame, path: str, *, sort_by: list[str] | None = None,
                partition_by: list[str] | None = None, watch: tuple[Observation, Sequence[Column]] | None = None
                ) -> DataFrame:
    """Replace a Parquet table and return it as stored.

    A table is a folder of versions. The rows become a new version, which counts once the mark that Spark writes last is
    there; until then, and if the job fails, `read_table` finds the former one. Nothing is renamed, so there is no moment
    without a table, on object stores either. The former version stays for jobs that still read it, and `df` may be one;
    older ones and remains of failed jobs go. One job at a time may write a table.

    `sort_by` spreads the rows by range before sorting inside files, so row-group statistics prune later reads.
    `watch` names an observation and the aggregates it takes of the rows as they are written, which spares a read.
    """
    spark, base = df.sparkSession, path.rstrip("/")
    ordered = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by) if sort_by else df
    if watch is not None:
        ordered = ordered.observe(watch[0], *watch[1])  # above the shuffle by range, whose sampling reads rows as well
    versions = _versions(spark, base)
    fresh = 1 + max(versions, default=0)
    ordered.write.partitionBy(*(partition_by or [])).option(_MARKS, "true").parquet(_version_path(base, fresh))
    former = max((n for n, complete in versions.items() if complete), default=None)
    for number in versions:
        if number != former:
            _file_system(spark, base).delete(_hadoop_path(spark, _version_path(base, number)), True)
    return spark.read.schema(df.schema).parquet(_version_path(base, fresh))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The newest complete version of a table."""
    base = path.rstrip("/")
    complete = [n for n, done in _versions(spark, base).items() if done]
    if not complete:
        raise FileNotFoundError(f"no table at {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(_version_path(base, max(complete)))


_MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def _version_path(base: str, number: int) -> str:
    return f"{base}/v-{number:09d}"


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, base: str) -> dict[int, bool]:
    """The versions in a table's folder, and whether each is complete. There are three at most, as older ones go."""
    files, folder = _file_system(spark, base), _hadoop_path(spark, base)
    if not files.exists(folder):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return {int(name[2:]): files.exists(_hadoop_path(spark, f"{base}/{name}/_SUCCESS"))
            for name in names if name.startswith("v-") and name[2:].isdigit()}


def refresh_table(df: DataFrame, path: str, spec: TableSpec, *, sort_by: list[str] | None = None) -> DataFrame:
    """Full refresh: the declared columns in declared order replace whatever the table held."""
    columns = [df[name].cast(dtype).alias(name) for name, dtype in spec.columns]
    return write_table(df.select(*columns), path, sort_by=sort_by)


def write_csv(df: DataFrame, path: str, *, sort_by: list[str] | None = None) -> None:
    """Replace a CSV folder, with a header row in every file. Range-sorted files are in order by name."""
    ordered = df.orderBy(*sort_by) if sort_by else df
    ordered.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what `write_csv` wrote."""
    return spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').schema(schema).csv(path)


def drop_views(spark: SparkSession, *names: str) -> None:
    """Drop temporary views that exist."""
    for name in names:
        spark.catalog.dropTempView(name)
