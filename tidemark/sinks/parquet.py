"""Parquet writes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame

from tidemark.operators.by_key import bucket_of, key_hash
from tidemark.sources.keyed import KeyedTable
from tidemark.sources.files import file_system
from tidemark.sources.tables import DROPPED, FINISHED, BatchTable
from tidemark.specs import BUCKET, CURRENT, KEY_HASH, STATUS


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = True) -> None:
    """Replace a directory, with one level per partition column.

    ``gather`` brings rows of a partition value together first, so that a value gets few
    large files instead of one per task; adaptive execution splits large values again.
    """
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_batch(df: DataFrame, table: BatchTable, batch_date: date, gather: bool | None = None) -> None:
    """Replace one batch of a table.

    Two status values make at most two files per task, which is not worth a shuffle;
    further partition levels are, unless the caller knows them to have few values.
    """
    spec = table.spec
    if gather is None:
        gather = bool(spec.partition_by)
    write_partitioned(df, table.batch_path(batch_date), spec.stored_partitions, gather)
    finish(table, batch_date)


def finish(table: BatchTable, batch_date: date) -> None:
    """Let readers see a batch."""
    files, marker = file_system(table.spark, f"{table.batch_path(batch_date)}/{FINISHED}")
    files.create(marker, True).close()


def write_keyed(df: DataFrame, table: KeyedTable, batch_date: date, touched: set[int], previous: date | None) -> None:
    """Replace one batch of a table that is kept by key.

    ``df`` holds all rows of the touched buckets; each task writes the buckets it has, so nothing is shuffled.
    The files of all other buckets stay where the ``previous`` batch has them.
    """
    layout = {b: day for b, day in table.layout(previous).items() if b not in touched} | dict.fromkeys(touched, batch_date)
    write_buckets(df, table, table.batch_path(batch_date))
    table.write_layout(batch_date, layout)
    finish(table, batch_date)


def write_all_keyed(versions: DataFrame, table: KeyedTable, batch_date: date) -> None:
    """Store whole versions as a batch of a table that is kept by key; the rows are shuffled into their buckets."""
    spec = table.spec
    placed = versions.withColumn(KEY_HASH, key_hash(spec)).repartition(spec.buckets, KEY_HASH)
    every = set(range(spec.buckets))
    write_keyed(placed.withColumn(BUCKET, bucket_of(spec)), table, batch_date, every, None)


def write_buckets(df: DataFrame, table: KeyedTable, path: str) -> None:
    """Replace a folder, with levels by status and bucket, its files named by bucket as Spark's bucketed reads want.

    Spark writes such files for tables only; the one declared for that owns no data and is gone afterwards.
    """
    spark, spec = table.spark, table.spec
    name = f"tidemark_{spec.name}_{uuid4().hex[:12]}"
    writer = df.write.format("parquet").mode("overwrite").option("path", path).option("partitionOverwriteMode", "static")
    try:
        writer.partitionBy(STATUS, BUCKET).bucketBy(spec.buckets, KEY_HASH).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_old_snapshots(table: BatchTable, keep: int = 2) -> list[date]:
    """Delete the current rows of all but the newest batches; closed rows, and so the history, stay.

    A batch can be run again while the snapshot before it is kept.
    """
    if keep < 2:
        raise ValueError("keep at least the newest snapshot and the one before it")
    if isinstance(table, KeyedTable):
        return _drop_old_buckets(table, keep)
    dropped = []
    for batch_date in table.batches()[:-keep]:
        files, marker = file_system(table.spark, f"{table.batch_path(batch_date)}/{DROPPED}")
        files.create(marker, True).close()
        files, snapshot = file_system(table.spark, f"{table.batch_path(batch_date)}/{STATUS}={CURRENT}")
        if files.delete(snapshot, True):
            dropped.append(batch_date)
    return dropped


def _drop_old_buckets(table: KeyedTable, keep: int) -> list[date]:
    """Delete the buckets that no kept snapshot uses; returns the batches that lost some.

    Any older snapshot may have used them, so none of those can be read any more.
    """
    batches = table.batches()
    used = {(day, b) for kept in batches[-keep:] for b, day in table.layout(kept).items()}
    dropped = []
    for batch_date in batches[:-keep]:
        files, marker = file_system(table.spark, f"{table.batch_path(batch_date)}/{DROPPED}")
        files.create(marker, True).close()
        unused = [b for b in sorted(table.bucket_folders(batch_date)) if (batch_date, b) not in used]
        for bucket in unused:
            files, folder = file_system(table.spark, table.bucket_path(batch_date, bucket))
            files.delete(folder, True)
        dropped += [batch_date] if unused else []
    return dropped
