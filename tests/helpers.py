from __future__ import annotations

from datetime import date, datetime

from tidemark.specs import EFF_END, EFF_START, STATUS, SUBSCRIPTIONS, USERS

YESTERDAY = date(2025, 1, 20)
TODAY = date(2025, 1, 21)


def day(text):
    return None if text is None else datetime.fromisoformat(f"2025-{text}")


def subs(spark, *versions):
    """Rows from (start, cancel[, update[, user, subs]])."""
    rows = []
    for version in versions:
        start, cancel, update, user, number = (*version, *(None, 1, 1)[len(version) - 2 :])
        rows.append((user, 1, number, day(start), None, None, day(update), day(cancel)))
    return spark.createDataFrame(rows, SUBSCRIPTIONS.schema)


def stored_subs(spark, *versions):
    from tidemark.operators import stamp_open

    return stamp_open(subs(spark, *versions), YESTERDAY)


def users(spark, *versions):
    """Rows from (user_id, updated, active)."""
    rows = [(u, f"u{u}", None, None, None, None, day(updated), active) for u, updated, active in versions]
    return spark.createDataFrame(rows, USERS.schema)


def intervals(stepped, order="subs_start_timestamp"):
    """(status, version, start, end) of every row, sorted."""
    short = lambda value: None if value is None else value.strftime("%m-%d")
    rows = stepped.select(STATUS, order, EFF_START, EFF_END).collect()
    return sorted(((r[0], short(r[1]), short(r[2]), short(r[3])) for r in rows), key=str)


def rows_of(df, *columns):
    names = columns or sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
