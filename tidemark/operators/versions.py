"""The type 2 step, and reads over histories."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import current_status, is_active, newest_first
from tidemark.operators.hot_keys import BROADCAST_BYTES, ROWS_PER_TASK, KeyCounts, checkpointed, count_keys
from tidemark.operators.newest import NEWEST, mark_newest
from tidemark.operators.touched import divide
from tidemark.operators.union import conform, union_by_name
from tidemark.specs import EFF_END, EFF_START, STATUS, Dataset


def stamp_open(df: DataFrame, batch_date: date) -> DataFrame:
    """New rows become valid on the batch date and have no end."""
    return df.withColumns({EFF_START: F.lit(batch_date), EFF_END: F.lit(None).cast("date")})


def active_rows(df: DataFrame, spec: Dataset) -> DataFrame:
    return df.where(F.expr(spec.active))


def inactive_rows(df: DataFrame, spec: Dataset) -> DataFrame:
    """The exact complement of :func:`active_rows`: an unknown activity is not active."""
    return df.where(~is_active(spec))


def step(
    existing: DataFrame,
    incoming: DataFrame,
    spec: Dataset,
    batch_date: date,
    counts: KeyCounts | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    touched_only: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One day: the active snapshot plus a delivery become current and closed versions.

    ``existing`` holds at most one row per key, as every snapshot does.  The newest
    version of a key is current if it is active; all others are closed on the
    batch date.  Keys with too many delivered rows for one task are split; ``counts``
    are those of the delivery.

    Only keys in the delivery can change.  With ``touched_only``, and if they can be told apart by a
    broadcast of at most ``broadcast_bytes``, rows of all other keys skip the shuffle, at
    the price of reading ``existing`` twice: right for a large stored snapshot.  Closed rows
    then all come out of the shuffle, in few files, and not one by one from wherever they were stored.
    """
    incoming = conform(incoming, spec.schema, spec.decisive)
    counts = counts or count_keys(incoming, spec.keys)
    arrived = stamp_open(incoming, batch_date)
    order = newest_first(spec)
    hot = counts.hot(rows_per_task)

    divided = divide(existing, counts, spec, broadcast_bytes) if touched_only else None
    if divided is None:
        ranked = mark_newest(union_by_name(existing, arrived), spec.keys, order, hot)
    else:
        untouched, touched = divided
        if hot is not None:  # read by each branch of the ranking
            touched = checkpointed(touched)
        ranked = untouched.withColumn(NEWEST, F.lit(True)).unionByName(
            mark_newest(union_by_name(touched, arrived), spec.keys, order, hot)
        )

    current = F.col(NEWEST) & is_active(spec)
    return ranked.select(
        *spec.schema.names,
        EFF_START,
        F.when(current, F.col(EFF_END)).otherwise(F.lit(batch_date)).alias(EFF_END),
        current_status(current).alias(STATUS),
    )


def arrives_in_order(versions: DataFrame, spec: Dataset, batch: str) -> bool:
    """Whether no row is older than a row of its key from an earlier batch.

    Rows are reduced to one range per key and batch before anything is compared.
    """
    rank = F.struct(spec.version_order, *spec.ties)
    ranges = versions.groupBy(*spec.keys, batch).agg(F.min(rank).alias("oldest"), F.max(rank).alias("newest"))
    before = Window.partitionBy(*spec.keys).orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("seen", F.max("newest").over(before)).where("oldest < seen").isEmpty()


def as_of(history: DataFrame, day: date) -> DataFrame:
    """The versions valid on a day; intervals are half-open."""
    started = F.col(EFF_START) <= F.lit(day)
    not_ended = F.col(EFF_END).isNull() | (F.col(EFF_END) > F.lit(day))
    return history.where(started & not_ended)
