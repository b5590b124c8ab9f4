"""Running a batch again, and carrying what it changes through the later batches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import same_key
from tidemark.operators import rebuild, touched_buckets
from tidemark.operators.by_key import bucket_of, key_hash
from tidemark.session import work_folder
from tidemark.sinks.parquet import finish, write_buckets, write_partitioned
from tidemark.sources import BatchTable, KeyedTable
from tidemark.sources.by_day import MARKER
from tidemark.sources.files import file_system
from tidemark.sources.tables import COMMITTED, FINISHED
from tidemark.specs import BATCH, BUCKET, CLOSED, CURRENT, EFF_END, EFF_START, KEY_HASH, STATUS, Dataset

_SINCE, _BATCH = "_since", "_batch"


def rerun(table: BatchTable, batch_date: date, load: Callable[[], None], rows: DataFrame) -> tuple[date, ...]:
    """Load a batch that has later ones, then repair those; returns the batches that were repaired.

    ``load`` stores the batch anew from ``rows``.  Only keys whose active version after the batch is another than
    before can make a difference later, and they are among those delivered then and now.  Their further history
    is rebuilt in one go from that version and what the later batches delivered of them, which the table itself
    holds: the rows that start on a batch's date.  Rows of all other keys stay; of a table kept by key only buckets
    with changed keys are read and written.

    Each later batch is unfinished while it is replaced.  Should that be interrupted, readers do not see it, and it
    and those after it are to be run again.
    """
    spec = table.spec
    later = table.batches(after=batch_date)
    if not later:
        load()
        return ()
    # a batch that was not there before changed nothing
    there = batch_date in table.batches()
    if lost := table.dropped([*([batch_date] if there else []), *later]):
        raise LookupError(f"{spec.name}: the snapshots of {lost} were dropped, and with them what was delivered")
    old = table.read([batch_date] if there else []).where(F.col(EFF_START) == F.lit(batch_date))
    delivered = _kept(old.select(*spec.keys).unionByName(_keys(rows, spec)).distinct(), table, "delivered")
    before = _kept(_state(table, batch_date if there else table.previous(batch_date), delivered), table, "before")
    load()
    after = _state(table, batch_date, delivered)
    names = [f"_after_{c}" for c in after.columns]
    same = same_key(spec.keys, [f"_after_{k}" for k in spec.keys]) & (F.col("_digest") == F.col("_after__digest"))
    compared = before.join(after.toDF(*names), same, "full_outer")
    lost, gained = F.col("_after__digest").isNull(), F.col("_digest").isNull()
    there_now = [F.col(f"_after_{k}").alias(k) for k in spec.keys]
    differing = compared.where(lost).select(*spec.keys).unionByName(compared.where(gained).select(*there_now))
    changed = _kept(differing.distinct(), table, "changed")
    if isinstance(table, KeyedTable):
        _relay(table, batch_date, later)
    if changed.isEmpty():
        return ()
    return tuple(_propagate(table, batch_date, later, changed))


def _kept(df: DataFrame, table: BatchTable, purpose: str) -> DataFrame:
    """Written out, since the folders it was read from are about to change."""
    path = work_folder(table.spark, f"repair-{purpose}")
    df.write.parquet(path)
    return table.spark.read.schema(df.schema).parquet(path)


def _keys(rows: DataFrame, spec: Dataset) -> DataFrame:
    return rows.select(*(F.col(k).cast(spec.schema[k].dataType).alias(k) for k in spec.keys))


def _among(df: DataFrame, keys: DataFrame, spec: Dataset, how: str) -> DataFrame:
    listed = keys.select(*(F.col(k).alias(f"_key_{k}") for k in spec.keys))
    return df.join(listed, same_key(spec.keys, listed.columns), how)


def _state(table: BatchTable, batch_date: date | None, keys: DataFrame) -> DataFrame:
    """Key and digest of the active versions of some keys after a batch."""
    spec = table.spec
    snapshot = _in_buckets(table, batch_date, keys) if isinstance(table, KeyedTable) else table.snapshot(batch_date)
    digest = F.xxhash64(*spec.version_schema.names).alias("_digest")
    return _among(snapshot, keys, spec, "left_semi").select(*spec.keys, digest)


def _in_buckets(table: KeyedTable, batch_date: date | None, keys: DataFrame) -> DataFrame:
    """The snapshot's rows in the buckets of some keys."""
    wanted = touched_buckets(keys, table.spec)
    return table.rows_of([path for b, path in table.held(batch_date).items() if b in wanted])


def _relay(table: KeyedTable, batch_date: date, later: list[date]) -> None:
    """Let later snapshots find their buckets where they are now: a batch's own, else where the one before has them."""
    layout = table.layout(batch_date)
    for day in later:
        layout = layout | {b: day for b, written in table.layout(day).items() if written == day}
        table.write_layout(day, layout)


def _propagate(table: BatchTable, batch_date: date, later: list[date], changed: DataFrame) -> list[date]:
    spec = table.spec
    by_key = isinstance(table, KeyedTable)
    buckets = touched_buckets(changed, spec) if by_key else None
    start = _in_buckets(table, batch_date, changed) if by_key else table.snapshot(batch_date)
    start = start.withColumns({_BATCH: F.lit(batch_date), _SINCE: F.col(EFF_START)})
    arrived = _stored(table, later, buckets).where(F.col(EFF_START) == F.col(BATCH))
    arrived = arrived.withColumns({_BATCH: F.col(BATCH), _SINCE: F.col(EFF_START)})
    rows = [_among(part, changed, spec, "left_semi").select(*spec.schema.names, _BATCH, _SINCE) for part in (start, arrived)]
    history = rebuild(rows[0].unionByName(rows[1]), spec, _BATCH, carried=[_SINCE])
    history = _kept(history.withColumnsRenamed({EFF_START: _BATCH}).withColumnRenamed(_SINCE, EFF_START), table, "history")

    for day in later:
        closed = history.where(F.col(EFF_END) == F.lit(day)).withColumn(STATUS, F.lit(CLOSED))
        lives = F.col(EFF_END).isNull() | (F.col(EFF_END) > F.lit(day))
        current = history.where((F.col(_BATCH) <= F.lit(day)) & lives)
        current = current.withColumns({EFF_END: F.lit(None).cast("date"), STATUS: F.lit(CURRENT)})
        new = closed.unionByName(current).select(*spec.version_schema.names, STATUS)
        mine = sorted(b for b, written in table.layout(day).items() if written == day and b in buckets) if by_key else None
        if by_key and not mine:
            continue
        others = _among(_stored(table, [day], mine), changed, spec, "left_anti").select(*new.columns)
        if by_key:  # a key's rows are where its bucket was last written
            placed = others.unionByName(new).withColumn(KEY_HASH, key_hash(spec)).withColumn(BUCKET, bucket_of(spec))
            _replace_buckets(table, day, placed.where(F.col(BUCKET).isin(mine)), mine)
        else:
            _replace(table, day, others.unionByName(new))
    if spec.by_day:
        table.file_by_day()
    return later


def _stored(table: BatchTable, days: list[date], buckets: set[int] | list[int] | None) -> DataFrame:
    """Rows written by some batches, of some buckets if the table is kept by key."""
    rows = table.read(days)
    return rows if buckets is None else rows.where(F.col(BUCKET).isin(sorted(buckets)))


def _replace(table: BatchTable, day: date, rows: DataFrame) -> None:
    stage = f"{table.location}/_repair-{uuid4().hex[:12]}"
    write_partitioned(rows, stage, table.spec.stored_partitions, gather=bool(table.spec.partition_by))
    _move(table, stage, table.batch_path(day))
    finish(table, day)


def _replace_buckets(table: KeyedTable, day: date, rows: DataFrame, buckets: list[int]) -> None:
    stage = f"{table.location}/_repair-{uuid4().hex[:12]}"
    write_buckets(rows.repartition(table.spec.buckets, KEY_HASH), table, stage)
    _unmark(table, day)
    for status in (CURRENT, CLOSED):
        for bucket in buckets:
            part = f"{STATUS}={status}/{BUCKET}={bucket}"
            _move(table, f"{stage}/{part}", f"{table.batch_path(day)}/{part}")
    files, left = file_system(table.spark, stage)
    files.delete(left, True)
    finish(table, day)


def _unmark(table: BatchTable, day: date) -> None:
    run = table.day_index().filed().get(day) if table.spec.by_day else None
    for name in (FINISHED, COMMITTED, *([f"{MARKER}{run}"] if run else [])):
        files, marker = file_system(table.spark, f"{table.batch_path(day)}/{name}")
        files.delete(marker, False)


def _move(table: BatchTable, source: str, target: str) -> None:
    """Put a folder in the place of another; if there is none, the other is deleted."""
    files, new = file_system(table.spark, source)
    _, old = file_system(table.spark, target)
    files.delete(old, True)
    if files.exists(new):
        files.mkdirs(old.getParent())
        if not files.rename(new, old):
            raise OSError(f"{source} could not be moved to {target}")
