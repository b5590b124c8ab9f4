"""Which version of a key is the newest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import same_key
from tidemark.operators.hot_keys import SPLITS, KeyCounts

NEWEST = "_newest"
_RANK = "_rank"
_PART = "_part"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The newest row of every key.

    Spark ranks within each task before the shuffle and keeps one row per key
    and task, so a hot key moves no more rows than there are tasks.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def mark_newest(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], hot: DataFrame | None = None
) -> DataFrame:
    """All rows, with a flag that is true for exactly one row of every key.

    ``hot`` (see :meth:`KeyCounts.hot`) lists keys to split.  Their rows are ranked in
    parts first; the winners of the parts, one per part, are then ranked against
    each other.  Every row passes through once, so copies of a row stay distinct.
    """
    if hot is None:
        return df.withColumn(NEWEST, _first(keys, newest_first))

    listed = hot.columns[: len(keys)]
    match = same_key(keys, listed)
    cold_rows = df.join(F.broadcast(hot), match, "left_anti").withColumn(NEWEST, _first(keys, newest_first))
    parts = split_rows(df.join(F.broadcast(hot), match, "inner").drop(*listed), df.columns)
    leads_part = parts.withColumn(NEWEST, _first([*keys, _PART], newest_first))
    finalists = F.when(F.col(NEWEST), F.lit(-1).cast("long")).otherwise(F.col(_PART))
    hot_rows = leads_part.withColumn(_PART, finalists).withColumn(
        NEWEST, F.col(NEWEST) & _first([*keys, _PART], newest_first)
    )
    return cold_rows.unionByName(hot_rows.drop(_PART, SPLITS))


def split_rows(df: DataFrame, columns: Sequence[str], part: str = _PART) -> DataFrame:
    """Number the parts of split keys.

    The part depends on the row and on the task that read it: copies of a row spread
    over parts too, and a task that is run again assigns the same parts.
    """
    spread = F.xxhash64(F.spark_partition_id(), *columns)
    return df.withColumn(part, F.pmod(spread, F.col(SPLITS)))


def superseded(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], counts: KeyCounts | None = None
) -> DataFrame:
    """All rows but the newest of every key."""
    hot = counts.hot() if counts else None
    return mark_newest(df, keys, newest_first, hot).where(~F.col(NEWEST)).drop(NEWEST)


def _first(keys: Sequence[str], newest_first: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)) == 1
