from tidemark.operators.by_key import step_by_key, touched_buckets
from tidemark.operators.changes import net_changes
from tidemark.operators.hot_keys import KeyCounts, count_keys
from tidemark.operators.newest import latest_per_key, mark_newest, superseded
from tidemark.operators.point_in_time import with_version
from tidemark.operators.rebuild import rebuild, survey
from tidemark.operators.rules import flag_repeated, flag_unknown
from tidemark.operators.union import conform, union_by_name, with_misfits
from tidemark.operators.versions import (
    active_rows,
    arrives_in_order,
    as_of,
    inactive_rows,
    stamp_open,
    step,
)

__all__ = [
    "KeyCounts",
    "active_rows",
    "arrives_in_order",
    "as_of",
    "conform",
    "count_keys",
    "flag_repeated",
    "flag_unknown",
    "inactive_rows",
    "latest_per_key",
    "mark_newest",
    "net_changes",
    "rebuild",
    "stamp_open",
    "step",
    "step_by_key",
    "superseded",
    "survey",
    "touched_buckets",
    "union_by_name",
    "with_misfits",
    "with_version",
]
