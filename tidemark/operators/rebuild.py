"""The whole history from all deliveries at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import current_status, is_active, newest_first, same_key
from tidemark.operators.hot_keys import ROWS_PER_TASK, SPLITS, KeyCounts, count_keys, counted, key_totals, per_key
from tidemark.operators.newest import NEWEST, mark_newest, split_rows
from tidemark.specs import EFF_END, EFF_START, STATUS, Dataset

_PART, _RANK, _LIVES, _NEXT, _OPEN, _SEG, _ENDS = "_part", "_rank", "_lives", "_next", "_open", "_seg", "_ends"


@dataclass(frozen=True)
class Survey:
    """What one aggregation says of a set of deliveries."""

    counts: KeyCounts
    last: date | None


def survey(versions: DataFrame, spec: Dataset, batch: str) -> Survey:
    """Rows per key and the last batch; rows without a batch are an error, since they belong nowhere."""
    found = (F.max(batch).alias("_last"), F.count_if(F.col(batch).isNull()).alias("_undated"))
    table = per_key(versions, spec.keys, *found)
    totals = table.agg(*key_totals(spec.keys), F.max("_last").alias("last"), F.sum("_undated").alias("undated")).first()
    if totals["undated"]:
        raise ValueError(f"{totals['undated']} rows of {spec.name} have no {batch}")
    return Survey(counted(table, spec.keys, totals), totals["last"])


def rebuild(
    versions: DataFrame,
    spec: Dataset,
    batch: str,
    rows_per_task: int = ROWS_PER_TASK,
    surveyed: Survey | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """The whole history from all deliveries at once, in place of one step per day.

    ``batch`` is the delivery date of each row; none may be NULL.  The result equals the daily steps, in whatever
    order versions arrive.  Of a key's rows in one batch only the newest can outlive it; call those leaders.  A
    leader lives until the batch of the next one that is newer than it, whether that is active or not.  It comes
    to live if it is active, unless an older batch's active leader, newer than it, still lives: then it is late, and
    closed at once.  So along the batches:

    * Leaders newer than all before them (records) never are late.  They end at the next record.
    * Behind an active record all others are late.
    * Behind an inactive record the key is forgotten, and the leaders up to the next record are judged among
      themselves by the rule above.

    Records come from a running maximum; only leaders behind an inactive record, at most one a batch, are gathered.
    Everything happens in one division of the rows by key.  Keys too large for a task are split first: their
    leaders are found in parts.  ``carried`` columns are kept and decide nothing.
    """
    surveyed = surveyed or survey(versions, spec, batch)
    hot = surveyed.counts.hot(rows_per_task)
    rows, group = versions, list(spec.keys)
    if hot is not None:
        rows, group = _in_lanes(versions, spec, batch, hot, rows_per_task), [*group, _PART]
    lane = F.col(_PART) < 0 if hot is not None else F.lit(True)

    rank = F.struct(spec.version_order, *spec.ties, F.col(batch), F.xxhash64(*spec.schema.names))
    rows = rows.withColumns({_RANK: rank, _LIVES: is_active(spec)})
    onward = Window.partitionBy(*group).orderBy(batch, _RANK)
    backward = Window.partitionBy(*group).orderBy(F.col(batch).desc(), F.col(_RANK).desc())
    before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (onward, backward))
    following = F.lead(batch).over(onward)
    rows = rows.withColumns(
        {
            "_leads": lane & (following.isNull() | (following != F.col(batch))),
            "_best": F.max(F.struct(_RANK, _LIVES, F.col(batch).alias("batch"))).over(before),
        }
    )
    record = F.col("_leads") & (F.col("_best").isNull() | (F.col(_RANK) > F.col(f"_best.{_RANK}")))
    rows = rows.withColumn("_record", record)
    rows = rows.withColumn(_NEXT, F.last(F.when(F.col("_record"), F.col(batch)), ignorenulls=True).over(after))
    behind = F.col("_leads") & ~F.col("_record") & ~F.col(f"_best.{_LIVES}")
    rows = rows.withColumn(_OPEN, behind).withColumn(_SEG, F.when(F.col(_OPEN), F.col("_best.batch")))
    rows = _judged(rows, group, batch)
    # of a record and of a leader behind an inactive one; all others end with their own batch
    end = (
        F.when(~F.col(_LIVES), F.col(batch))
        .when(F.col("_record"), F.col(_NEXT))
        .when(F.col(_OPEN), _end_among_themselves(batch))
        .otherwise(F.col(batch))
    )
    history = rows.withColumn("_end", end)
    return history.select(
        *spec.schema.names,
        F.col(batch).alias(EFF_START),
        F.col("_end").alias(EFF_END),
        current_status(F.col("_end").isNull()).alias(STATUS),
        *carried,
    )


def _judged(rows: DataFrame, group: list[str], batch: str) -> DataFrame:
    """``_ends``: of the leaders behind the same inactive record, each one's batch and last day among themselves.

    Worked out once in such a group and then handed to all of its rows.
    """
    together = Window.partitionBy(*group, _SEG).orderBy(batch)
    whole = together.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leader = F.struct(F.col(batch).alias("batch"), F.col(_RANK).alias("rank"), F.col(_LIVES).alias("lives"))
    listed = F.collect_list(F.when(F.col(_OPEN), leader)).over(whole)
    first = F.col(_OPEN) & (F.row_number().over(together) == 1)
    rows = rows.withColumn("_leaders", F.when(first, listed))

    leaders = F.col("_leaders")
    newer = lambda x: F.filter(leaders, lambda y: (y["batch"] > x["batch"]) & (y["rank"] > x["rank"]))
    until = F.transform(
        leaders,
        lambda x: F.struct(x["batch"].alias("batch"), x["lives"].alias("lives"), F.array_min(F.transform(newer(x), lambda y: y["batch"])).alias("next")),
    )
    rows = rows.withColumn("_until", until)
    late = lambda x: F.exists(
        F.col("_until"),
        lambda e: e["lives"] & (e["batch"] < x["batch"]) & (e["next"].isNull() | (e["next"] > x["batch"])),
    )
    ends = F.transform("_until", lambda x: F.struct(x["batch"].alias("batch"), late(x).alias("late"), x["next"].alias("next")))
    return rows.withColumn(_ENDS, ends).withColumn(_ENDS, F.first(_ENDS, ignorenulls=True).over(whole))


def _end_among_themselves(batch: str) -> Column:
    mine = F.get(F.filter(_ENDS, lambda e: e["batch"] == F.col(batch)), F.lit(0))
    return F.when(mine["late"], F.col(batch)).otherwise(F.coalesce(mine["next"], F.col(_NEXT)))


def _in_lanes(versions: DataFrame, spec: Dataset, batch: str, hot: DataFrame, rows_per_task: int) -> DataFrame:
    """Rows with ``_part``: below 0 for rows of keys that fit a task and for the leaders of the others, one a batch."""
    listed = hot.columns[: len(spec.keys)]
    match = same_key(spec.keys, listed)
    cold = versions.join(F.broadcast(hot), match, "left_anti").withColumn(_PART, F.lit(-1).cast("long"))
    hot_rows = versions.join(F.broadcast(hot), match, "left_semi")
    day_keys = [*spec.keys, batch]
    hot_days = count_keys(hot_rows, day_keys).hot(rows_per_task)
    marked = mark_newest(hot_rows, day_keys, newest_first(spec, None), hot_days)
    parts = split_rows(marked.join(F.broadcast(hot), match, "inner").drop(*listed), versions.columns)
    lane = F.when(F.col(NEWEST), F.lit(-1).cast("long")).otherwise(F.col(_PART))
    return cold.unionByName(parts.withColumn(_PART, lane).drop(NEWEST, SPLITS))
