"""Hand-written scenarios of the type 2 step."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import TODAY, YESTERDAY, intervals, rows_of, stored_subs, subs, users
from tidemark.operators import stamp_open, step
from tidemark.specs import SUBSCRIPTIONS, USERS

CURRENT, CLOSED = "current", "closed"

SCENARIOS = {
    "new key": ([], [("01-21", None)], [(CURRENT, "01-21", "01-21", None)]),
    "changed": (
        [("01-20", None)],
        [("01-21", None)],
        [(CLOSED, "01-20", "01-20", "01-21"), (CURRENT, "01-21", "01-21", None)],
    ),
    "absent from the delivery": ([("01-20", None)], [], [(CURRENT, "01-20", "01-20", None)]),
    "cancelled, newer start": (
        [("01-20", None)],
        [("01-21", "01-21")],
        [(CLOSED, "01-20", "01-20", "01-21"), (CLOSED, "01-21", "01-21", "01-21")],
    ),
    "cancelled, same start": (
        [("01-20", None, "01-20")],
        [("01-20", "01-21", "01-21")],
        [(CLOSED, "01-20", "01-20", "01-21"), (CLOSED, "01-20", "01-21", "01-21")],
    ),
    "sent again": (
        [("01-20", None)],
        [("01-20", None)],
        [(CLOSED, "01-20", "01-20", "01-21"), (CURRENT, "01-20", "01-21", None)],
    ),
    "two rows in one delivery": (
        [],
        [("01-20", None), ("01-21", None)],
        [(CLOSED, "01-20", "01-21", "01-21"), (CURRENT, "01-21", "01-21", None)],
    ),
    "late row": (
        [("01-20", None)],
        [("01-10", None)],
        [(CLOSED, "01-10", "01-21", "01-21"), (CURRENT, "01-20", "01-20", None)],
    ),
    "late row after cancellation": ([], [("01-10", None)], [(CURRENT, "01-10", "01-21", None)]),
    "no start": (
        [("01-20", None)],
        [(None, None)],
        [(CLOSED, None, "01-21", "01-21"), (CURRENT, "01-20", "01-20", None)],
    ),
    "three copies in one delivery": (
        [("01-20", None)],
        [("01-21", None)] * 3,
        [
            (CLOSED, "01-20", "01-20", "01-21"),
            (CLOSED, "01-21", "01-21", "01-21"),
            (CLOSED, "01-21", "01-21", "01-21"),
            (CURRENT, "01-21", "01-21", None),
        ],
    ),
    "keys with NULL are one key": (
        [("01-20", None, None, None, 1)],
        [("01-21", None, None, None, 1)],
        [(CLOSED, "01-20", "01-20", "01-21"), (CURRENT, "01-21", "01-21", None)],
    ),
    "another subscription of the user": (
        [("01-20", None, None, 1, 1)],
        [("01-21", None, None, 1, 2)],
        [(CURRENT, "01-20", "01-20", None), (CURRENT, "01-21", "01-21", None)],
    ),
}


OPTIONS = [{}, {"rows_per_task": 1}, {"touched_only": True}, {"touched_only": True, "rows_per_task": 1}]
# Too little room for a list of keys, enough for a bitmap.
OPTIONS += [{"touched_only": True, "broadcast_bytes": 90}]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
@pytest.mark.parametrize("name", SCENARIOS)
def test_scenarios(spark, name, options):
    existing, incoming, expected = SCENARIOS[name]
    stepped = step(stored_subs(spark, *existing), subs(spark, *incoming), SUBSCRIPTIONS, TODAY, **options)
    assert intervals(stepped) == sorted(expected, key=str)


def test_unknown_activity_closes(spark):
    stepped = step(stamp_open(users(spark), YESTERDAY), users(spark, (1, "01-21", None)), USERS, TODAY)
    assert intervals(stepped, "user_updated_timestamp") == [(CLOSED, "01-21", "01-21", "01-21")]


def test_reactivated_user(spark):
    first = step(stamp_open(users(spark), YESTERDAY), users(spark, (1, "01-20", False)), USERS, YESTERDAY)
    assert [r.status for r in first.collect()] == [CLOSED]
    active = first.where("status = 'current'").drop("status")
    second = step(active, users(spark, (1, "01-21", True)), USERS, TODAY)
    assert intervals(second, "user_updated_timestamp") == [(CURRENT, "01-21", "01-21", None)]


def test_text_timestamps_are_cast_to_the_declared_type(spark):
    text = lambda value: subs(spark, ("01-21", None)).withColumn("subs_cancel_timestamp", F.lit(value).cast("string"))
    stepped = step(stored_subs(spark), text(None), SUBSCRIPTIONS, TODAY)
    assert intervals(stepped) == [(CURRENT, "01-21", "01-21", None)]
    with pytest.raises(Exception, match="does not fit"):  # NULL would open a cancelled subscription again
        step(stored_subs(spark), text("2025-01-21 25:61"), SUBSCRIPTIONS, TODAY).collect()
    large = subs(spark, ("01-21", None)).withColumn("user_id", F.lit(1 << 40))
    with pytest.raises(Exception, match="does not fit"):
        step(stored_subs(spark), large, SUBSCRIPTIONS, TODAY).collect()
    stepped = step(stored_subs(spark), text("2025-01-21 08:00:00"), SUBSCRIPTIONS, TODAY)
    assert intervals(stepped) == [(CLOSED, "01-21", "01-21", "01-21")]
    assert dict(stepped.dtypes)["subs_cancel_timestamp"] == "timestamp"


def test_missing_column_is_an_error(spark):
    with pytest.raises(Exception):
        step(stored_subs(spark), subs(spark).drop("create_timestamp"), SUBSCRIPTIONS, TODAY)


def test_tie_does_not_depend_on_row_order(spark):
    rows = [("01-21", None, None, 1, 1), ("01-21", "01-21", None, 1, 1)]
    forward = step(stored_subs(spark), subs(spark, *rows), SUBSCRIPTIONS, TODAY)
    backward = step(stored_subs(spark), subs(spark, *rows[::-1]), SUBSCRIPTIONS, TODAY)
    assert rows_of(forward) == rows_of(backward)
