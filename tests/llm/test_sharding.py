import zlib
from collections import Counter

from pyspark.sql import functions as F

from corpus import ODD, SF
from tidemark.llm import sharding
from tidemark.llm.registry import LLM_QUERIES
import tidemark.llm.queries  # noqa: F401


def rows_of(spark, keys):
    return spark.createDataFrame(list(enumerate(keys)), "id long, key string")


def sizes(placed):
    return Counter(r["shard"] for r in placed.collect())


def test_groups_meet_and_sizes_stay(spark):
    keys = [f"g{k % 41}" for k in range(120)] + [f"single{k}" for k in range(280)]
    before = sharding.propagate(rows_of(spark, keys), rounds=0)
    after = sharding.propagate(rows_of(spark, keys))
    for placed in (before, after):
        assert max(sizes(placed).values()) - min(sizes(placed).values()) <= 1
        assert placed.count() == len(keys)
    assert sharding.co_located(before) < 0.8 < 0.95 < sharding.co_located(after)


def test_group_larger_than_a_shard(spark):
    keys = ["hot"] * 150 + [f"single{k}" for k in range(290)] + ["a", "a", "b", "b", "b"]
    placed = sharding.propagate(rows_of(spark, keys))
    assert max(sizes(placed).values()) - min(sizes(placed).values()) <= 1
    assert sharding.co_located(placed) > 0.8


def test_few_and_no_rows(spark):
    assert sizes(sharding.propagate(rows_of(spark, ["a", "a", "b"]))).total() == 3
    assert sharding.propagate(rows_of(spark, [])).count() == 0


def test_exchange_plan_keeps_sizes():
    wishes = {(0, 1): 5, (1, 0): 3, (2, 1): 4, (0, 2): 1}
    moves, fill = sharding.exchange_plan(wishes, {0: 1, 1: 3, 2: 0}, 3)
    flow = Counter()
    for (a, b), n in [*moves.items(), *fill.items()]:
        flow[a] -= n
        flow[b] += n
    assert not any(flow.values()) and all(moves[k] <= wishes[k] for k in moves)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = LLM_QUERIES["op5_sharding"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    by_shard = Counter(r["shard"] for r in rows)
    assert set(by_shard) == set(range(8)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, k) for s, n in by_shard.items() for k in range(n)}


def test_odd_rows(spark, tmp_path):
    spark.createDataFrame(ODD, "doc_id long, text string").withColumn("shard", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = LLM_QUERIES["op5_sharding"](spark, str(tmp_path)).collect()
    assert len(rows) == len(ODD)
    null = next(r for r in rows if r["doc_id"] == 1)
    assert (null["size"], null["text_crc32"]) == (1, 0)


def test_large_groups_that_fit_stay_whole(spark):
    keys = [f"big{k}" for k in range(5) for _ in range((380, 300, 250, 100, 60)[k])]
    keys += [f"pair{k % 300}" for k in range(600)] + [f"single{k}" for k in range(1510)]
    placed = sharding.propagate(rows_of(spark, keys))
    assert placed.count() == len(keys) == placed.select("id").distinct().count()
    assert set(sizes(placed).values()) == {400}
    shards = Counter((r["key"], r["shard"]) for r in placed.where("key like 'big%'").collect())
    assert len(shards) == 5
    assert sharding.together(placed) > 0.95


def test_seats():
    seats, room = sharding.seated([("a", 25), ("b", 9), ("c", 5), ("d", 1)], [10, 10, 10, 10, 10])
    assert seats == {"a": [(0, 10, 0), (10, 20, 1), (20, 25, 2)], "b": [(0, 9, 3)], "c": [(0, 5, 2)], "d": [(0, 1, 3)]}
    assert room == [0, 0, 0, 0, 10]
    assert sharding.seated([("a", 6), ("b", 6), ("c", 6)], [9, 9]) == (
        {"a": [(0, 6, 0)], "b": [(0, 6, 1)], "c": [(0, 3, 0), (3, 6, 1)]}, [0, 0])
