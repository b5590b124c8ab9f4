"""Column expressions shared by the version operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.specs import CLOSED, CURRENT, EFF_START, Dataset


def is_active(spec: Dataset) -> Column:
    """The activity condition with NULL read as false, so its negation is the exact complement."""
    return F.coalesce(F.expr(spec.active), F.lit(False))


def _age(spec: Dataset, arrived: str | None) -> list[Column]:
    ranks = [F.col(spec.version_order), *(F.col(name) for name in spec.ties)]
    if arrived is not None:
        ranks.append(F.col(arrived))
    return [*ranks, F.xxhash64(*spec.schema.names)]


def newest_first(spec: Dataset, arrived: str | None = EFF_START) -> list[Column]:
    """Total order of versions: version order, declared ties, later arrival, row hash.

    NULLs count as oldest.  The hash only separates rows that differ in nothing
    but payload, so that reruns pick the same one.
    """
    return [rank.desc_nulls_last() for rank in _age(spec, arrived)]


def oldest_first(spec: Dataset, arrived: str | None = EFF_START) -> list[Column]:
    """The exact reverse of :func:`newest_first`."""
    return [rank.asc_nulls_first() for rank in _age(spec, arrived)]


def current_status(current: Column) -> Column:
    return F.when(current, F.lit(CURRENT)).otherwise(F.lit(CLOSED))


def same_key(keys: Sequence[str], other: Sequence[str]) -> Column:
    """Null-safe equality: a window groups NULL keys together, so joins must too."""
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other)))
