"""Sharding by balanced label propagation: linked documents move towards each other under quotas.

Documents with equal texts are linked. Groups larger than a share of a shard (``GROUP_PART``; fewer than
shards / ``GROUP_PART`` of them) start seated, largest first, each in the fullest shard that still holds
all of it. Only a group larger than a shard, or than the room left in any, is cut: it fills shards whole,
those with most room first. All other documents start evenly dealt over the room left. In each round every
linked document wants to be where most of its group is; documents move only as exchanges, so no shard's row
count ever changes: opposite wishes are exchanged, and unlinked documents go the other way for the rest.

The law is ``rows``: row counts of shards differ by at most one. Slots number a shard's rows from 0.

Defined results: null texts have size 1, crc32 0 and form one group; empty texts another. Repeated
rows and ids are rows of their own. Null ids are kept. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import running_number, stored, table
from tidemark.llm.registry import query

SHARDS = 8
ROUNDS = 4
GROUP_PART = 1 / 16  # of a shard


def exchange_plan(wishes: dict[tuple[int, int], int], free: dict[int, int], shards: int) -> tuple[dict, dict]:
    """Moves per (from, to) of wishing and of free documents, under which every shard keeps its size."""
    moves, fill, free = {}, {}, dict(free)
    for (a, b), n in sorted(wishes.items()):
        moves[a, b] = min(n, wishes.get((b, a), 0))
    for (a, b), n in sorted(wishes.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - moves[a, b], free.get(b, 0))
        if more > 0:
            moves[a, b] += more
            fill[b, a] = fill.get((b, a), 0) + more
            free[b] -= more
    return {k: n for k, n in moves.items() if n}, fill


def _ranges(plan: dict[tuple[int, int], int]) -> dict[int, list[tuple[int, int, int]]]:
    """Per source shard the (first, end, target) of its numbered free documents."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (a, b), n in sorted(plan.items()):
        at = out[a][-1][1] if out.get(a) else 0
        out.setdefault(a, []).append((at, at + n, b))
    return out


def seated(groups: list[tuple[str, int]], room: list[int]) -> tuple[dict[str, list[tuple[int, int, int]]], list[int]]:
    """Per group, given largest first, the (first, end, shard) of its numbered rows; and the room that is left."""
    seats, room = {}, list(room)
    for key, members in groups:
        whole = [s for s in range(len(room)) if room[s] >= members]
        order = [min(whole, key=lambda s: (room[s], s))] if whole else sorted(range(len(room)), key=lambda s: (-room[s], s))
        at, seats[key] = 0, []
        for s in order:
            if n := min(members - at, room[s]):
                seats[key].append((at, at + n, s))
                room[s] -= n
                at += n
    return seats, room


def _dealt(room: list[int]) -> Column:
    """The shard of the row numbered ``at``, dealt in turn to the shards that still have room."""
    shard, at, full = F.lit(0), 0, 0
    for level in sorted(set(room) - {0}):
        open_ = [s for s in range(len(room)) if room[s] >= level]
        turn = F.get(F.array(*map(F.lit, open_)), ((F.col("at") - at) % len(open_)).cast("int"))
        shard = F.when(F.col("at") >= at, turn).otherwise(shard)
        at += (level - full) * len(open_)
        full = level
    return shard.cast("int")


def propagate(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (id: unique long, key: group) with ``shard``: sizes at most one apart."""
    n = rows.count()
    room = [n // shards + (k < n % shards) for k in range(shards)]
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sizes = stored(sizes, "group-sizes")
    large = sizes.where(F.col("members") > max(2, int(n * GROUP_PART / shards))).orderBy(F.desc("members"), "key").collect()
    seats, room = seated([(r["key"], r["members"]) for r in large], room)
    rest = rows.select("id", "key")
    if seats:
        spark = rows.sparkSession
        ranges = spark.createDataFrame(
            [(key, first, end, shard) for key, some in seats.items() for first, end, shard in some],
            "key string, first long, end long, shard int",
        )
        keys = F.broadcast(ranges.select("key").distinct())
        numbered = running_number(rest.join(keys, "key", "left_semi"), ["key"], ["id"], "at", n)
        same = (numbered["key"] == ranges["key"]) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("end"))
        sitting = numbered.join(F.broadcast(ranges), same).select("id", numbered["key"], "shard")
        rest = rest.join(keys, "key", "left_anti")
    placed = running_number(rest, [], ["id"], "at", n) if n else rest.withColumn("at", F.lit(0))
    placed = placed.withColumn("shard", _dealt(room)).select("id", "key", "shard")
    placed = placed.unionByName(sitting) if seats else placed
    # only a group larger than a shard is of several parts, one for each shard that it fills
    part = F.when(F.col("members") > max(1, n // shards + (n % shards > 0)), F.col("shard")).otherwise(0)
    placed = placed.join(sizes, "key", "left").withColumn("part", F.when(F.col("members").isNotNull(), part))
    placed = stored(placed.select("id", "key", "part", "shard"), "shards-0")
    linked = F.col("part").isNotNull()
    for turn in range(1, rounds + 1):
        wished = stored(wishes(placed), f"wishes-{turn}")
        counts = wished.where(linked).groupBy("shard", "wish").agg(F.count(F.lit(1)).alias("n")).collect()
        wanted = {(r["shard"], r["wish"]): r["n"] for r in counts if r["shard"] != r["wish"]}
        free = {r["shard"]: r["n"] for r in placed.where(~linked).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        moves, fill = exchange_plan(wanted, free, shards)
        if not moves:
            break
        movers = running_number(wished.where(linked & (F.col("wish") != F.col("shard"))), ["shard", "wish"], ["gain", "key", "id"], "nth", n)
        quota = F.lit(0)
        for (a, b), most in moves.items():
            quota = F.when((F.col("shard") == a) & (F.col("wish") == b), most).otherwise(quota)
        moved = movers.where(F.col("nth") < quota).select("id", F.col("wish").alias("new"))
        fillers = running_number(placed.where(~linked), ["shard"], ["id"], "nth", n)
        target = F.lit(None).cast("int")
        for a, ranges in _ranges(fill).items():
            for first, end, b in ranges:
                inside = (F.col("shard") == a) & (F.col("nth") >= first) & (F.col("nth") < end)
                target = F.when(inside, b).otherwise(target)
        filled = fillers.withColumn("new", target).where("new IS NOT NULL").select("id", "new")
        new = moved.unionByName(filled)
        placed = stored(
            placed.join(new, "id", "left").withColumn("shard", F.coalesce("new", "shard").cast("int")).drop("new"),
            f"shards-{turn}",
        )
    return placed


def wishes(placed: DataFrame) -> DataFrame:
    """Every document with the shard where most of its part of a group is, and by how many more."""
    linked = placed.where("part IS NOT NULL")
    part = linked.groupBy("key", "part", "shard").agg(F.count(F.lit(1)).alias("here"))
    group = part.groupBy("key", "shard").agg(F.sum("here").alias("kin"))
    counted = part.join(group, ["key", "shard"])
    order = [F.desc("here"), F.desc("kin"), F.xxhash64("key", "part", "shard")]
    first = Window.partitionBy("key", "part").orderBy(*order)
    wish = counted.withColumn("nth", F.row_number().over(first)).where("nth = 1")
    wish = wish.select("key", "part", F.col("shard").alias("wish"), (-F.col("here")).alias("gain"))
    return placed.join(wish, ["key", "part"], "left")


def co_located(placed: DataFrame) -> float:
    """Share of linked documents that are with the largest piece of their group's part."""
    row = wishes(placed).where("wish IS NOT NULL").agg(F.avg((F.col("wish") == F.col("shard")).cast("double"))).first()
    return row[0] if row[0] is not None else 1.0


def together(placed: DataFrame) -> float:
    """Share of linked documents that are in the shard with most of their whole group."""
    return co_located(placed.withColumn("part", F.when(F.col("part").isNotNull(), 0)))


@query()
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("key"),
    )
    rows = stored(documents.withColumn("id", F.monotonically_increasing_id()), "shard-rows")
    placed = propagate(rows.select("id", "key"))
    whole = rows.drop("key").join(placed.select("id", "shard"), "id")
    slots = running_number(whole, ["shard"], ["doc_id", "id"], "slot", rows.count())
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
