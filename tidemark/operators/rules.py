"""Rules about several rows or datasets: what repeats within a delivery, and what refers to nothing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import same_key
from tidemark.operators.hot_keys import BROADCAST_BYTES, ROWS_PER_TASK, KeyCounts, checkpointed, count_keys
from tidemark.operators.touched import divide
from tidemark.specs import FULL, Dataset

_LISTED = "_listed"


def with_reason(rows: DataFrame, reason: str, flag: Column, text: str) -> DataFrame:
    """``reason`` filled where ``flag`` holds and nothing else was amiss before."""
    return rows.withColumn(reason, F.coalesce(F.col(reason), F.when(flag, F.lit(text))))


def flag_repeated(
    rows: DataFrame, columns: Sequence[str], reason: str, limit: int = BROADCAST_BYTES, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows whose values of ``columns`` are all known and occur more than once get a reason, each of them.

    Rows are counted by partial aggregation; only the values that repeat are joined back.
    """
    counts = count_keys(rows.where(_known(columns)), columns)
    if counts.largest < 2:
        return rows
    repeated = counts.table.where("_n > 1").select(*counts.key_columns())
    return _flagged(rows, repeated, counts, reason, f"repeated {', '.join(columns)}", limit, rows_per_task)


def flag_unknown(
    rows: DataFrame,
    columns: Sequence[str],
    parents: DataFrame,
    parent_columns: Sequence[str],
    reason: str,
    text: str,
    limit: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Rows whose values of ``columns`` are all known and stand in no row of ``parents`` get a reason.

    What is referred to is reduced to its distinct values.  These, as a list or, if that is too large, as a bitmap of
    their hashes, keep all other parents out of the exact anti join that follows; a parent that the bitmap lets pass
    without need does no harm.
    """
    types = StructType([rows.schema[c] for c in columns])
    referred = count_keys(rows.where(_known(columns)), columns)
    if not referred.total_keys:
        return rows
    named = parents.select(*(F.col(p).cast(types[c].dataType).alias(c) for p, c in zip(parent_columns, columns)))
    as_parents = Dataset("parents", types, FULL, keys=tuple(columns))
    divided = divide(named, referred, as_parents, limit)
    asked = (divided[1] if divided else named).select(*(F.col(c).alias(f"_parent_{c}") for c in columns)).distinct()
    names = referred.names()
    match = reduce(lambda a, b: a & b, (F.col(n) == F.col(f"_parent_{c}") for n, c in zip(names, columns)))
    unknown = checkpointed(referred.distinct_keys().join(asked, match, "left_anti"))
    return _flagged(rows, unknown, referred, reason, text, limit, rows_per_task)


def _known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def _flagged(
    rows: DataFrame, listed: DataFrame, counts: KeyCounts, reason: str, text: str, limit: int, rows_per_task: int
) -> DataFrame:
    """Rows whose key is listed get a reason.

    A short list is broadcast.  Beyond that rows are shuffled to it, but for those of keys too large for a task,
    whose list is short whatever the data.
    """
    names = counts.names()
    per_key = -(-counts.key_bytes // max(1, counts.total_keys))
    if listed.count() * per_key <= limit:
        return _joined(rows, F.broadcast(listed), counts, reason, text)
    hot = counts.hot(rows_per_task)
    if hot is None:
        return _joined(rows, listed, counts, reason, text)
    match = same_key(counts.keys, names)
    is_hot = F.broadcast(hot.select(*names))
    listed_hot = F.broadcast(listed.join(is_hot.select(*(F.col(n).alias(f"{n}_hot") for n in names)), same_key(names, [f"{n}_hot" for n in names]), "left_semi"))
    hot_rows = _joined(rows.join(is_hot, match, "left_semi"), listed_hot, counts, reason, text)
    return hot_rows.unionByName(_joined(rows.join(is_hot, match, "left_anti"), listed, counts, reason, text))


def _joined(rows: DataFrame, listed: DataFrame, counts: KeyCounts, reason: str, text: str) -> DataFrame:
    equal = (F.col(k) == F.col(n) for k, n in zip(counts.keys, counts.names()))
    found = rows.join(listed.withColumn(_LISTED, F.lit(True)), reduce(lambda a, b: a & b, equal), "left")
    return with_reason(found, reason, F.col(_LISTED), text).select(*rows.columns)
