"""Counting rows per key, and finding the few keys too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# Rows of one key that a single task may sort.
ROWS_PER_TASK = 2_000_000
# More keys than this are never called hot, so the list of them stays broadcastable.
MAX_HOT_KEYS = 100_000
# Largest estimated size of a key list that is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
_BYTES_PER_KEY = 96

SPLITS = "_splits"
_N = "_n"


@dataclass(frozen=True)
class KeyCounts:
    """Row counts per key with their totals; ``table`` is computed when used unless kept."""

    table: DataFrame
    keys: tuple[str, ...]
    total_rows: int
    total_keys: int
    largest: int
    key_bytes: int | None
    kept: bool = False

    def fits_broadcast(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.key_bytes is not None and self.key_bytes <= limit

    @property
    def slow(self) -> bool:
        """Whether counting again would take long."""
        return not self.kept and self.total_rows > ROWS_PER_TASK

    def keep(self) -> KeyCounts:
        """The same with its table checkpointed, if counting again would take long.

        Only for key lists of a checked size.
        """
        return replace(self, table=checkpointed(self.table), kept=True) if self.slow else self

    @classmethod
    def few(cls, df: DataFrame, keys: Sequence[str], rows: int, rows_per_task: int = ROWS_PER_TASK) -> KeyCounts:
        """Upper bounds for a frame known to have so few rows that no key can be hot; runs no job."""
        if rows > rows_per_task:
            raise ValueError(f"{rows} rows may hold a hot key, count them")
        return cls(per_key(df, keys), tuple(keys), rows, rows, rows, None)

    def names(self) -> list[str]:
        """Key columns under names that cannot clash with the counted frame."""
        return [f"_key_{k}" for k in self.keys]

    def key_columns(self) -> list[Column]:
        return [F.col(k).alias(n) for k, n in zip(self.keys, self.names())]

    def distinct_keys(self) -> DataFrame:
        return self.table.select(*self.key_columns())

    def hot(self, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
        """Keys with more rows than a task should sort, and into how many parts to split each.

        A hot key holds more than 1/MAX_HOT_KEYS of all rows, hence there are
        fewer than MAX_HOT_KEYS of them whatever the data.
        """
        if self.largest <= rows_per_task:
            return None
        floor = max(rows_per_task, self.total_rows // MAX_HOT_KEYS)
        parts = F.ceil(F.col(_N) / F.lit(rows_per_task)).cast("long").alias(SPLITS)
        listed = self.table.where(F.col(_N) > floor).select(*self.key_columns(), parts)
        return listed if self.kept else checkpointed(listed)


def count_keys(df: DataFrame, keys: Sequence[str]) -> KeyCounts:
    """Count rows per key and total the counts in one job.

    Reads the key columns only; partial aggregation reduces a hot key to one row per task.
    """
    table = per_key(df, keys)
    return counted(table, keys, table.agg(*key_totals(keys)).first())


def key_totals(keys: Sequence[str]) -> list[Column]:
    """Totals over a table of rows per key."""
    text = [F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys]
    return [
        F.coalesce(F.sum(_N), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.max(_N), F.lit(0)).alias("largest"),
        F.coalesce(F.sum(sum(text, F.lit(_BYTES_PER_KEY))), F.lit(0)).alias("bytes"),
    ]


def counted(table: DataFrame, keys: Sequence[str], totals: Row) -> KeyCounts:
    return KeyCounts(table, tuple(keys), totals["rows"], totals["keys"], totals["largest"], totals["bytes"])


def per_key(df: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N), *more)


def checkpointed(df: DataFrame) -> DataFrame:
    """A result of bounded size kept in the shared folder, so that no broadcast waits for its making."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
