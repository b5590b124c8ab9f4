"""Helpers shared by the corpus operators: reading, intermediate tables, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_folder
from tidemark.sources.files import file_system

# Rows a Python worker holds at a time; long texts count by bytes as well.
BATCH_ROWS = 4096
BATCH_BYTES = 8 << 20
_BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", str(BATCH_ROWS)),
    "spark.sql.execution.arrow.maxBytesPerBatch": (None, str(BATCH_BYTES)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, where the session leaves Spark's defaults."""
    for key, (default, wanted) in _BATCH_SETTINGS.items():
        now = spark.conf.get(key, None)
        if default is None or now == default:
            spark.conf.set(key, wanted)


def stored(frame: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """Write a table below the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = work_folder(spark, purpose)
    writer = frame.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    kept = spark.read.schema(frame.schema).parquet(path)
    _folders[kept] = path
    return kept


_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` gave, so that a long job does not keep all of its steps.

    Whatever was made from them must be stored by now: a lost executor's part of it could not be made again.
    """
    for kept in tables:
        files, path = file_system(kept.sparkSession, _folders.pop(kept))
        files.delete(path, True)


# Called in a Python worker when a task ends, so that workers that wait for the next one hold little.
AFTER_TASK: list[Callable[[], None]] = []


def give_back() -> None:
    """Drop what tasks leave behind and return free memory to the system, where it can be asked to take it."""
    for release in AFTER_TASK:
        release()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every platform's library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_rows(frame: DataFrame, function: Callable[..., dict[str, list]], schema: str, *columns: str) -> DataFrame:
    """Apply ``function`` to lists of the columns, batch by batch; it returns lists by output name.

    ``columns`` are taken from ``frame`` by name; others never reach Python.
    """
    small_batches(frame.sparkSession)
    names = list(columns)
    fields = frame.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for part in parts:
                if part.num_rows:
                    found = function(*(part.column(n).to_pylist() for n in names))
                    yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in arrow], schema=arrow)
        finally:
            give_back()

    return frame.select(*names).mapInArrow(batches, schema)


def running_number(
    frame: DataFrame, within: list[str], order: list[str], number: str, rows: int | None = None, rows_per_bucket: int = 200_000
) -> DataFrame:
    """Number the rows of each group from 0 without gaps, with no task holding a whole group.

    Rows are dealt into buckets by a hash of ``order`` (which must tell rows of a group apart);
    each bucket is numbered by itself, then shifted by the rows of the group's earlier buckets.
    ``rows`` is about how many rows there are; without it they are counted.
    """
    from pyspark.sql import Window

    buckets = max(1, -(-(frame.count() if rows is None else rows) // rows_per_bucket))
    placed = frame.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = placed.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    own = Window.partitionBy(*within, "_bucket").orderBy(*order)
    numbered = placed.withColumn("_own", F.row_number().over(own) - 1)
    return numbered.join(starts, [*within, "_bucket"]).withColumn(number, F.col("_own") + F.col("_before")).drop(
        "_bucket", "_own", "_before"
    )
