"""Which stored rows a delivery can change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import same_key
from tidemark.operators.hot_keys import KeyCounts, checkpointed
from tidemark.specs import Dataset

# Bits of the bitmap per key: one stored row in eight then passes for touched though it is not.
_BITS_PER_KEY = 8
_WORD = 64
_BYTES_PER_WORD = 64


def divide(
    existing: DataFrame, counts: KeyCounts, spec: Dataset, limit: int
) -> tuple[DataFrame, DataFrame] | None:
    """Stored rows whose keys were not delivered, and those that may have been.

    Either a list of the delivered keys or a bitmap of their hashes is broadcast,
    whichever first stays below ``limit`` bytes; None if both are larger.  A bitmap lets some rows
    pass for touched, which costs their way through the shuffle and changes nothing.
    """
    if counts.fits_broadcast(limit):
        return _by_list(existing, counts.keep())
    if counts.total_keys * _BITS_PER_KEY // _WORD * _BYTES_PER_WORD <= limit:
        return _by_bitmap(existing, counts, spec)
    return None


def _by_list(existing: DataFrame, counts: KeyCounts) -> tuple[DataFrame, DataFrame]:
    touched = F.broadcast(counts.distinct_keys())
    match = same_key(counts.keys, counts.names())
    return existing.join(touched, match, "left_anti"), existing.join(touched, match, "left_semi")


def _by_bitmap(existing: DataFrame, counts: KeyCounts, spec: Dataset) -> tuple[DataFrame, DataFrame]:
    bits = F.lit(max(_WORD, counts.total_keys * _BITS_PER_KEY))
    position = F.pmod(F.xxhash64(*(F.col(k).cast(spec.schema[k].dataType) for k in spec.keys)), bits)
    words = (
        counts.table.select(position.alias("_position"))
        .groupBy(_word().alias("_word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(_position % {_WORD} AS INT))")).alias("_bits"))
    )
    if counts.slow:
        words = checkpointed(words)
    placed = existing.withColumn("_position", position).join(F.broadcast(words), _word() == F.col("_word"), "left")
    is_set = F.coalesce(F.getbit("_bits", (F.col("_position") % _WORD).cast("int")) == 1, F.lit(False))
    return placed.where(~is_set).select(existing.columns), placed.where(is_set).select(existing.columns)


def _word() -> Column:
    return F.shiftright("_position", 6)
