"""Ranking with and without splitting of hot keys, and the whole-history rebuild."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, datetime, timedelta
from random import Random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of, users
from tidemark import operators as op
from tidemark.functions import newest_first
from tidemark.operators.hot_keys import SPLITS
from tidemark.operators.newest import NEWEST, split_rows
from tidemark.operators.touched import divide
from tidemark.specs import EFF_END, EFF_START, STATUS, USERS

DAY = date(2025, 1, 1)
START = datetime(2025, 1, 1)


def skewed_users(spark, seed, rows=300, in_order=True):
    """A third of the rows belong to one user, and a third of those are copies of one row."""
    random = Random(seed)
    out = []
    for number in range(rows):
        batch = number * 10 // rows
        user = random.choice([7, random.randrange(20), random.randrange(20)])
        minute = number if in_order else random.randrange(rows)
        active = random.random() < 0.7
        if user == 7 and random.random() < 0.33:
            minute, active = batch * rows // 10, True
        when = START + timedelta(days=batch, minutes=minute)
        out.append((user, f"u{user}", None, None, None, START, when, active, DAY + timedelta(days=batch)))
    schema = USERS.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    return spark.createDataFrame(out, f"{schema}, delivered date").repartition(6)


@pytest.mark.parametrize("seed", range(3))
def test_splitting_hot_keys_changes_nothing(spark, seed):
    rows = skewed_users(spark, seed)
    order = newest_first(USERS, None)
    counts = op.count_keys(rows, USERS.keys)
    hot = counts.hot(rows_per_task=20)
    assert hot.count() >= 1 and hot.agg(F.max(SPLITS)).first()[0] >= 3
    split = op.mark_newest(rows, USERS.keys, order, hot)
    assert rows_of(split) == rows_of(op.mark_newest(rows, USERS.keys, order))
    assert split.where(NEWEST).count() == counts.total_keys
    assert split.where(NEWEST).groupBy(*USERS.keys).count().where("count > 1").isEmpty()


def test_copies_of_a_hot_row_spread_over_parts(spark):
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    hot = op.count_keys(copies, ["k"]).hot(rows_per_task=500)
    parts = split_rows(copies.join(F.broadcast(hot), F.col("k") == F.col("_key_k")).drop("_key_k"), ["k", "v"])
    assert parts.groupBy("_part").count().agg(F.max("count")).first()[0] < 4000
    marked = op.mark_newest(copies, ["k"], [F.col("v").desc()], hot)
    assert [marked.where(NEWEST).count(), marked.count()] == [1, 4000]


def test_hot_keys_are_bounded(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("k"))
    counts = op.count_keys(rows, ["k"])
    assert (counts.total_rows, counts.total_keys, counts.largest) == (1000, 100, 10)
    assert counts.hot(10) is None
    assert counts.hot(9).count() == 100
    assert counts.fits_broadcast() and not counts.fits_broadcast(100)


def test_latest_and_superseded_divide_the_rows(spark):
    rows = skewed_users(spark, 5).drop("delivered")
    order = newest_first(USERS, None)
    latest = op.latest_per_key(rows, USERS.keys, order)
    older = op.superseded(rows, USERS.keys, order, op.count_keys(rows, USERS.keys))
    assert rows_of(latest.unionByName(older)) == rows_of(rows)
    assert latest.count() == rows.select("user_id").distinct().count()


def fold(spark, rows, **options):
    """One step per delivery; the plain way to a history."""
    current = op.stamp_open(rows.drop("delivered").limit(0), DAY)
    closed = []
    for day in sorted(r[0] for r in rows.select("delivered").distinct().collect()):
        incoming = rows.where(F.col("delivered") == F.lit(day)).drop("delivered")
        stepped = op.step(current, incoming, USERS, day, **options).collect()
        closed += [r for r in stepped if r[STATUS] == "closed"]
        left = [tuple(r)[:-1] for r in stepped if r[STATUS] == "current"]
        current = spark.createDataFrame(left, USERS.version_schema)
    return current, closed


def brute_force(rows):
    """The daily steps in plain Python, one key at a time."""
    per_key = defaultdict(lambda: defaultdict(list))
    for r in rows.collect():
        per_key[r.user_id][r.delivered].append(r)
    history = []
    for days in per_key.values():
        live = None
        for day in sorted(days):
            versions = [(r, day) for r in days[day]] + ([live] if live else [])
            top = max(versions, key=lambda v: (v[0].user_updated_timestamp, v[1], v[0].is_subs_active))
            versions.remove(top)
            history += [(r.user_id, r.user_updated_timestamp, start, day) for r, start in versions]
            live = top if top[0].is_subs_active else None
            if live is None:
                history.append((top[0].user_id, top[0].user_updated_timestamp, top[1], day))
        if live:
            history.append((live[0].user_id, live[0].user_updated_timestamp, live[1], None))
    return sorted(history, key=repr)


WHAT = ("user_id", "user_updated_timestamp", EFF_START, EFF_END)


OPTIONS = [{}, {"touched_only": True}, {"touched_only": True, "rows_per_task": 4}]
OPTIONS += [{"touched_only": True, "broadcast_bytes": 400}]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_steps_equal_brute_force_also_out_of_order(spark, options):
    rows = skewed_users(spark, 11, rows=120, in_order=False)
    rows = rows.dropDuplicates(["user_id", "user_updated_timestamp"]).cache()
    current, closed = fold(spark, rows, **options)
    found = rows_of(current, *WHAT) + [tuple(r[c] for c in WHAT) for r in closed]
    assert sorted(found, key=repr) == brute_force(rows)


@pytest.mark.parametrize("rows_per_task", [2_000_000, 8])
def test_rebuild_equals_brute_force(spark, rows_per_task):
    rows = skewed_users(spark, 3).dropDuplicates(["user_id", "user_updated_timestamp"]).cache()
    assert op.arrives_in_order(rows, USERS, "delivered")
    rebuilt = op.rebuild(rows, USERS, "delivered", rows_per_task)
    assert rows_of(rebuilt, *WHAT) == brute_force(rows)


@pytest.mark.parametrize("rows_per_task", [2_000_000, 6])
@pytest.mark.parametrize("seed", [21, 22, 23])
def test_rebuild_in_any_order_equals_the_daily_steps(spark, seed, rows_per_task):
    """Late rows, rows after a cancellation, and late rows behind several cancellations."""
    rows = skewed_users(spark, seed, rows=150, in_order=False)
    rows = rows.dropDuplicates(["user_id", "user_updated_timestamp"]).cache()
    rebuilt = op.rebuild(rows, USERS, "delivered", rows_per_task)
    assert rows_of(rebuilt, *WHAT) == brute_force(rows)


def test_rebuild_behind_nested_cancellations(spark):
    """Every order of active and inactive versions of one key, one a day."""
    from itertools import permutations, product

    rows, key = [], 0
    for order in permutations(range(1, 5)):
        for lives in product([True, False], repeat=4):
            key += 1
            for day, (version, active) in enumerate(zip(order, lives)):
                rows.append((key, DAY + timedelta(days=day), f"01-{version:02d}", active))
    # the day of a version is kept in the name
    frame = users(spark, *((k, v, a) for k, _, v, a in rows)).drop("user_name")
    days = spark.createDataFrame([(k, f"2025-{v}", str(d)) for k, d, v, _ in rows], "user_id int, v string, user_name string")
    days = days.select("user_id", F.col("v").cast("timestamp").alias("user_updated_timestamp"), "user_name")
    rows = frame.join(days, ["user_id", "user_updated_timestamp"]).select(*USERS.schema.names)
    rows = rows.withColumn("delivered", F.col("user_name").cast("date")).cache()
    assert rows_of(op.rebuild(rows, USERS, "delivered"), *WHAT) == brute_force(rows)


def test_rebuild_refuses_undated_rows(spark):
    rows = skewed_users(spark, 4).withColumn("delivered", F.when(F.col("user_id") > 1, F.col("delivered")))
    with pytest.raises(ValueError, match="have no delivered"):
        op.rebuild(rows, USERS, "delivered")


def test_rebuild_of_copies_with_hot_days(spark):
    rows = skewed_users(spark, 4)
    assert rows_of(op.rebuild(rows, USERS, "delivered", 5)) == rows_of(op.rebuild(rows, USERS, "delivered"))


@pytest.mark.parametrize("limit, way", [(10**9, "list"), (10_000, "bitmap"), (1_000, None)])
def test_division_by_delivered_keys(spark, limit, way):
    existing = spark.range(20_000).select(F.col("id").cast("int").alias("user_id"), F.lit("x").alias("payload"))
    delivered = spark.range(0, 20_000, 20).select(F.col("id").cast("int").alias("user_id"))
    divided = divide(existing, op.count_keys(delivered, USERS.keys), USERS, limit)
    if way is None:
        assert divided is None
        return
    untouched, touched = divided
    assert untouched.count() + touched.count() == 20_000
    assert untouched.where("user_id % 20 = 0").isEmpty()
    assert touched.where("user_id % 20 = 0").count() == 1000
    assert (touched.count() == 1000) if way == "list" else (1000 <= touched.count() < 5000)


def test_out_of_order_arrival_is_noticed(spark):
    rows = skewed_users(spark, 4)
    assert op.arrives_in_order(rows, USERS, "delivered")
    delivered = F.when(F.col("delivered") == F.lit(DAY), F.lit(date(2025, 2, 1))).otherwise(F.col("delivered"))
    late = rows.withColumn("delivered", delivered)
    assert not op.arrives_in_order(late, USERS, "delivered")


def test_intervals_hold_together(spark):
    history = op.rebuild(skewed_users(spark, 9), USERS, "delivered").cache()
    assert history.where("status = 'current'").groupBy("user_id").count().where("count > 1").isEmpty()
    assert history.where("(status = 'closed') != (eff_end_date IS NOT NULL)").isEmpty()
    lasting = history.where("eff_end_date IS NULL OR eff_end_date > eff_start_date")
    pairs = lasting.alias("a").join(lasting.alias("b"), "user_id").where(
        "a.eff_start_date < b.eff_start_date AND (a.eff_end_date IS NULL OR a.eff_end_date > b.eff_start_date)"
    )
    assert pairs.isEmpty()
    for offset in range(10):
        valid = op.as_of(history, DAY + timedelta(days=offset))
        assert valid.groupBy("user_id").count().where("count > 1").isEmpty()
