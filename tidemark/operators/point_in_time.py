"""Facts with the version of their entity that was valid when they happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import same_key
from tidemark.operators.hot_keys import ROWS_PER_TASK, SPLITS, KeyCounts, count_keys
from tidemark.operators.newest import split_rows
from tidemark.specs import EFF_END, EFF_START, Dataset

VERSION = "version"
_LANE, _DAY, _FACT = "_lane", "_day", "_fact"


def with_version(
    facts: DataFrame,
    versions: DataFrame,
    spec: Dataset,
    day: str,
    keys: Sequence[str] | None = None,
    counts: KeyCounts | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every fact once, with ``version``: the one valid on its day, as a struct, or NULL if there was none.

    ``versions`` is a history with intervals, which of a key never overlap; ``day`` a date or timestamp of the
    facts, ``keys`` their columns for the keys of ``spec`` (by default of the same names).  Versions and facts
    are brought together by key and put in order of time; the last version before a fact is the one, if it has
    not ended.  No fact meets more than one version, however many there are.

    Keys with more facts than a task should sort are dealt into lanes, each with all versions of the key, of which
    there is at most one a batch.  NULL keys match each other, facts without a day match nothing.
    """
    keys = tuple(keys or spec.keys)
    names = spec.version_schema.names
    counts = counts or count_keys(facts, keys)
    hot = counts.hot(rows_per_task)

    group = [f"_k{n}" for n in range(len(keys))]
    as_key = [F.col(k).cast(spec.schema[own].dataType).alias(g) for k, own, g in zip(keys, spec.keys, group)]
    lasting = versions.where(F.col(EFF_END).isNull() | (F.col(EFF_END) > F.col(EFF_START)))
    opened = lasting.select(
        *(F.col(own).alias(g) for own, g in zip(spec.keys, group)),
        F.col(EFF_START).alias(_DAY),
        F.lit(None).cast(facts.schema).alias(_FACT),
        F.struct(*names).alias(VERSION),
    )
    happened = facts.select(
        *as_key,
        F.col(day).cast("date").alias(_DAY),
        F.struct(*facts.columns).alias(_FACT),
        F.lit(None).cast(opened.schema[VERSION].dataType).alias(VERSION),
    )
    if hot is not None:
        listed = hot.columns[: len(keys)]
        match = same_key(group, listed)
        splits = F.coalesce(F.col(SPLITS), F.lit(1).cast("long"))
        lanes = F.explode(F.sequence(F.lit(0).cast("long"), splits - 1))
        opened = opened.join(F.broadcast(hot), match, "left").withColumn(_LANE, lanes).drop(*listed, SPLITS)
        dealt = happened.join(F.broadcast(hot), match, "left").drop(*listed).withColumn(SPLITS, splits)
        happened = split_rows(dealt, happened.columns, _LANE).drop(SPLITS)
        group = [*group, _LANE]

    # on one day versions come before facts
    in_time = Window.partitionBy(*group).orderBy(F.col(_DAY).asc_nulls_first(), F.col(_FACT).isNotNull())
    until_now = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(VERSION, ignorenulls=True).over(until_now)
    found = opened.unionByName(happened).withColumn(VERSION, last).where(F.col(_FACT).isNotNull())
    ended = F.col(f"{VERSION}.{EFF_END}") <= F.col(_DAY)
    return found.select(f"{_FACT}.*", F.when(~F.coalesce(ended, F.lit(False)) & F.col(_DAY).isNotNull(), F.col(VERSION)).alias(VERSION))
