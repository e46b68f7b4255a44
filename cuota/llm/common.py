"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cuota.session import scratch_path

# What separates words everywhere in this package: the six ASCII white-space characters, as bytes.split() takes them.
SPACES = r"\x20\x09-\x0D"

_SHIPPED: set[str] = set()


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows of `df`, written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a re-run, and Spark knows the size of what it reads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_rows(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`stored`, and the number of rows, observed while they are written: a query of its own would leave its plan and stages
    in the driver's memory."""
    seen = Observation()
    kept = stored(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return kept, (seen.get or {"rows": kept.count()})["rows"]  # nothing is observed where Spark drops an empty part of a plan


def discard(df: DataFrame) -> None:
    """Delete a table that `stored` gave, once later ones stand for it."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def batch_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches of about `size` bytes at most (one row at least) for what is written inside. Both the executor and its
    Python workers hold several copies of a batch, and what they once took of the system they hardly give back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def joins_by_shuffle(spark: SparkSession) -> Iterator[None]:
    """No side of a join planned inside is broadcast for its size alone; F.broadcast still holds. The driver builds the hash
    table of each such side, of a page of memory at least however few its rows, and many small joins add up there."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def release() -> None:
    """Give memory that a batch has left back to the system: Python workers stay for later tasks, and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def without(df: DataFrame, *names: str) -> DataFrame:
    """`df` without the columns an operator is about to add; what it computes replaces columns of the same name."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, so that they need not have it installed.

    It is imported there by name, so what a worker has learnt (vocabularies, words) serves all its tasks.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="cuota-package-")  # the driver hands the file out as long as it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = Path(folder) / "cuota-package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted((root / "cuota").rglob("*.py")):
                out.write(file, file.relative_to(root))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
