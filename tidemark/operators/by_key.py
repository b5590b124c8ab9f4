"""The type 2 step over a snapshot that is stored by a hash of the key."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import current_status, is_active, newest_first
from tidemark.operators.hot_keys import ROWS_PER_TASK, KeyCounts, checkpointed, count_keys
from tidemark.operators.newest import NEWEST, mark_newest
from tidemark.operators.union import conform
from tidemark.operators.versions import stamp_open
from tidemark.specs import BUCKET, EFF_END, EFF_START, KEY_HASH, STATUS, Dataset


def key_hash(spec: Dataset) -> Column:
    """One number for a key, the same for stored and delivered rows, also where parts of it are NULL."""
    return F.xxhash64(*(F.col(k).cast(spec.schema[k].dataType) for k in spec.keys))


def bucket_of(spec: Dataset) -> Column:
    """The bucket that Spark's writer gives a row by its ``key_hash``."""
    return F.pmod(F.hash(KEY_HASH), F.lit(spec.buckets))


def touched_buckets(rows: DataFrame, spec: Dataset) -> set[int]:
    """Buckets that the keys of some rows fall into; at most ``spec.buckets`` numbers."""
    found = rows.select(key_hash(spec).alias(KEY_HASH)).select(bucket_of(spec).alias(BUCKET)).distinct()
    return {r[BUCKET] for r in found.collect()}


def _rank(version: str, spec: Dataset) -> Column:
    """Comparable as ``newest_first`` sorts: NULL is least, later arrival wins, then the row hash."""
    fields = [F.col(f"{version}.{c}") for c in (spec.version_order, *spec.ties, EFF_START)]
    return F.struct(*fields, F.xxhash64(*(F.col(f"{version}.{c}") for c in spec.schema.names)))


def _same(keys: tuple[str, ...], a: str, b: str) -> Column:
    """Equal or both NULL, written so that Spark joins by ``key_hash`` alone, as the rows are stored."""

    def same(key: str) -> Column:
        x, y = F.col(f"{a}.{key}"), F.col(f"{b}.{key}")
        return F.coalesce(x == y, x.isNull() & y.isNull())

    return reduce(lambda p, q: p & q, (same(k) for k in keys))


def step_by_key(
    existing: DataFrame,
    incoming: DataFrame,
    spec: Dataset,
    batch_date: date,
    counts: KeyCounts | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """As :func:`step`, with ``key_hash`` and ``bucket``; only the delivery is shuffled, once.

    ``existing`` are the stored rows of the buckets touched, divided by ``key_hash``.  The newest delivered row of
    every key meets the stored one by a join; all other delivered rows are closed at once.  Those of keys too
    large for a task do not go through the join.
    """
    incoming = conform(incoming, spec.schema, spec.decisive)
    counts = counts or count_keys(incoming, spec.keys)
    hot = counts.hot(rows_per_task)
    names = spec.version_schema.names
    arrived = stamp_open(incoming, batch_date).select(*names, key_hash(spec).alias(KEY_HASH))
    if hot is None:
        placed = arrived.repartition(spec.buckets, KEY_HASH)
        delivered, superseded = mark_newest(placed, [KEY_HASH, *spec.keys], newest_first(spec)), None
    else:  # read by two branches
        marked = checkpointed(mark_newest(arrived, spec.keys, newest_first(spec), hot))
        delivered = marked.where(NEWEST).repartition(spec.buckets, KEY_HASH)
        superseded = marked.where(~F.col(NEWEST))

    old = existing.select(F.struct(*names).alias("old"), F.col(KEY_HASH).alias("old_hash"))
    new = delivered.select(F.struct(*names).alias("new"), F.col(NEWEST).alias("leads"), F.col(KEY_HASH).alias("new_hash"))
    match = (F.col("old_hash") == F.col("new_hash")) & F.col("leads") & _same(spec.keys, "old", "new")
    both = old.join(new, match, "full_outer")
    beaten = F.col("old").isNotNull() & F.col("new").isNotNull() & (_rank("old", spec) > _rank("new", spec))
    newest_old = F.col("new").isNull() | beaten
    newest_new = F.col("leads") & ~beaten
    versions = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), F.struct("old.*", newest_old.alias(NEWEST), F.col("old_hash").alias(KEY_HASH))),
            F.when(F.col("new").isNotNull(), F.struct("new.*", newest_new.alias(NEWEST), F.col("new_hash").alias(KEY_HASH))),
        )
    )
    ranked = both.select(F.explode(versions).alias("version")).select("version.*")
    if superseded is not None:
        ranked = ranked.unionByName(superseded)
    current = F.col(NEWEST) & is_active(spec)
    return ranked.select(
        *spec.schema.names,
        EFF_START,
        F.when(current, F.col(EFF_END)).otherwise(F.lit(batch_date)).alias(EFF_END),
        KEY_HASH,
        current_status(current).alias(STATUS),
        bucket_of(spec).alias(BUCKET),
    )
