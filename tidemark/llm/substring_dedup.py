"""Removal of repeated byte strings, by suffix arrays of shards that hold all places of a string together.

Every ``LENGTH``-byte string of a text has an anchor: the ``GRAM`` bytes in it with the least hash,
leftmost first. Equal strings have equal anchors, so the strings around one anchor (a segment of the
text) need comparing only with segments of the same anchor:

1. Equal segments are repeats of the first of them in document order, whole.
2. Of the first ones, those whose anchor has different segments too go to a shard. There their suffix
   array is built by induced sorting, and permuted common prefixes tell which strings are equal; all but
   the first in document order repeat.

Anchors that a bounded sample shows to be very frequent are split: each of their strings goes by a hash of
its own and is compared as in step 1, so that no task gathers all places of such an anchor. Texts that
occur as a whole more than once are read once.

Order is by id, null ids first, then by a hash of the text. Defined results: null texts are empty.
Rows with equal id and text are one document; a copy of a text under a larger id is removed wholly if it
has ``LENGTH`` bytes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, small_batches, stored, table
from tidemark.llm.registry import query
from tidemark.llm.suffix_array import permuted_lcp, suffix_array

LENGTH = 100
GRAM = 32
CONTEXT = (LENGTH - GRAM) // 2  # a string has as many bytes on one side of its anchor at least
SHARD_BYTES = 1 << 20
SAMPLE_TEXTS = 2_000  # texts looked at for very frequent anchors
SAMPLE_CHARS = 16_000
HOT_SHARE = 0.02  # of these texts, from which on an anchor is split
BROADCAST_ROWS = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(size, _BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        _powers[:] = [(np.multiply.accumulate(up), np.multiply.accumulate(down))]
    return _powers[0]


def gram_hashes(raw: bytes) -> np.ndarray:
    """A hash of every ``GRAM`` bytes."""
    n = len(raw)
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    g = (total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    return g


def segments(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor place, first and last string start of every segment."""
    if len(raw) < LENGTH:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    least = gram_hashes(raw)
    g, at, span, wide = least, np.arange(len(least)), 1, LENGTH - GRAM + 1
    while span < wide:
        step = min(span, wide - span)
        right = least[step:] < least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.where(right, least[step:], least[:-step])
        span += step
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    return g[at[first]], at[first], first, last


def _packed(first: np.ndarray, last: np.ndarray, anchor: np.ndarray, split: np.ndarray) -> np.ndarray:
    """A segment as one number that rises with its place: start, strings - 1, anchor's distance, split or not."""
    return first << 15 | (last - first) << 8 | (anchor - first) << 1 | split


def _unpacked(column: str = "at"):
    at = F.col(column)
    first = F.shiftright(at, 15).alias("first")
    return first, (F.shiftright(at, 15) + F.shiftright(at, 8).bitwiseAND(127)).alias("last"), F.shiftright(at, 1).bitwiseAND(127).alias("distance")


def place_rows(number: int, raw: bytes, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, content hash and packed place of a text's segments; frequent anchors' strings one by one."""
    g, anchor, first, last = segments(raw)
    split = np.isin(g, hot) if len(hot) else np.zeros(len(g), bool)
    keep = ~split
    rows = list(zip(first[keep].tolist(), (last[keep] + LENGTH).tolist(), strict=True))
    content = np.fromiter((xxhash.xxh64_intdigest(raw[a:b]) for a, b in rows), np.uint64, len(rows))
    out = [(g[keep], content, _packed(first[keep], last[keep], anchor[keep], 0))]
    for a, f, e in zip(anchor[split].tolist(), first[split].tolist(), last[split].tolist(), strict=True):
        starts = np.arange(f, e + 1)
        strings = [raw[k : k + LENGTH] for k in starts.tolist()]
        one = np.array([xxhash.xxh64_intdigest(x, 1) for x in strings], np.uint64)
        two = np.array([xxhash.xxh64_intdigest(x, 2) for x in strings], np.uint64)
        out.append((one, two, _packed(starts, starts, np.maximum(a, starts), 1)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def texts_in_order(documents: DataFrame) -> DataFrame:
    """number, first_id, digest, copies of every distinct text; numbers rise in document order."""
    # a null text has the digest of an empty one
    digests = documents.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    firsts = digests.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    ordered = firsts.select("digest", F.col("first.doc_id").alias("first_id"), "copies").orderBy(F.asc_nulls_first("first_id"), "digest")
    return stored(ordered.withColumn("number", F.monotonically_increasing_id()), "texts")


def _few(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _numbered(documents: DataFrame, texts: DataFrame) -> DataFrame:
    """number and text of the first document of every text."""
    held = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = held.where(F.octet_length("text") >= LENGTH)
    firsts = _few(texts.select("number", "first_id", "digest"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.md5(F.col("text").cast("binary")) == F.col("digest"))
    return held.join(firsts, same).select("number", "text")


def frequent_anchors(documents: DataFrame) -> np.ndarray:
    """Anchors in ``HOT_SHARE`` of a bounded sample of texts, sorted: at most 100 / ``HOT_SHARE`` per text's anchors."""
    sample = (
        documents.where(F.octet_length("text").between(LENGTH, SAMPLE_CHARS))
        .select("text", F.xxhash64("doc_id").alias("by"))
        .orderBy("by", "text")
        .limit(SAMPLE_TEXTS)
        .repartition(12)
    )
    anchors = map_rows(
        sample.distinct(),
        lambda texts: {"anchor": [np.unique(segments(t.encode("utf-8", "surrogatepass"))[0]).view(np.int64).tolist() for t in texts]},
        "anchor array<long>",
        "text",
    )
    counted = anchors.select(F.explode("anchor").alias("anchor")).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.where(F.col("n") >= max(2, int(HOT_SHARE * SAMPLE_TEXTS))).select("anchor").collect()
    return np.sort(np.array([r["anchor"] for r in rows], np.int64).view(np.uint64))


def places(numbered: DataFrame, hot: np.ndarray) -> DataFrame:
    """anchor, content, number, at of every segment."""

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            numbers, out = [], []
            for number, text in zip(part.column("number").to_pylist(), part.column("text").to_pylist(), strict=True):
                rows = place_rows(number, text.encode("utf-8", "surrogatepass"), hot)
                out.append(rows)
                numbers.append(np.full(len(rows[0]), number, np.int64))
            if out:
                anchor, content, at = (np.concatenate(x) for x in zip(*out, strict=True))
                arrays = [anchor.view(np.int64), content.view(np.int64), np.concatenate(numbers), at]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["anchor", "content", "number", "at"])

    small_batches(numbered.sparkSession)
    return numbered.mapInArrow(made, "anchor long, content long, number long, at long")


def repeated_strings(parts: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
    """(number, start) of strings in the given pieces (number, start of the first string, bytes) that occur earlier.

    The pieces are laid one after another, each followed by symbol 1; their bytes are symbols from 2.
    """
    sizes = np.array([len(p[2]) for p in parts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    s = np.zeros(int(sizes.sum()) + len(parts) + 1, np.int64)
    s[:-1] = 1
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    body = np.frombuffer(b"\0".join(p[2] for p in parts) + b"\0", np.uint8).astype(np.int64) + 2
    body[begins + sizes] = 1
    s[:-1] = body
    order = suffix_array(s, 258)
    shared = permuted_lcp(s, order, 1)
    run = np.cumsum(shared[order] < LENGTH)  # equal strings have the same number
    whole = np.flatnonzero(np.bincount(run)[run] > 1)
    at, run = order[whole], run[whole]
    number = np.array([p[0] for p in parts], np.int64)[owner[at]]
    start = at - begins[owner[at]] + np.array([p[1] for p in parts], np.int64)[owner[at]]
    ranked = np.lexsort((start, number, run))
    again = ranked[np.flatnonzero(np.diff(run[ranked], prepend=-1) == 0)]
    return list(zip(number[again].tolist(), start[again].tolist(), strict=True))


def _joinable(parts: list[tuple[int, int, int, int, bytes]]) -> list[tuple[int, int, bytes]]:
    """Pieces (anchor, number, first, distance, bytes) of which a string may be equal to another's: it has at least
    ``CONTEXT`` bytes on one side of the anchor, so these and the anchor's occur again."""
    seen: dict[tuple, int] = {}
    sides = []
    for anchor, _, _, distance, raw in parts:
        left = raw[distance - CONTEXT : distance + GRAM] if distance >= CONTEXT else None
        right = raw[distance : distance + GRAM + CONTEXT] if len(raw) >= distance + GRAM + CONTEXT else None
        keys = [(anchor, k, x) for k, x in ((0, left), (1, right)) if x is not None]
        sides.append(keys)
        for key in keys:
            seen[key] = seen.get(key, 0) + 1
    return [(p[1], p[2], p[4]) for p, keys in zip(parts, sides, strict=True) if any(seen[k] > 1 for k in keys)]


def _shard(rows):
    parts = list(
        zip(*(rows[c].to_pylist() for c in ("anchor", "number", "first", "distance", "raw")), strict=True)
    )
    held = sorted(set(_joinable(parts)))
    found = repeated_strings(held) if held else []
    return pa.table({"number": pa.array([f[0] for f in found], pa.int64()), "first": pa.array([f[1] for f in found], pa.int64())})


def repeats(documents: DataFrame, texts: DataFrame) -> DataFrame:
    """number, begin, end: maximal byte ranges of first documents that earlier strings cover."""
    numbered = _numbered(documents, texts)
    same = Window.partitionBy("anchor", "content").orderBy("number", "at")
    one_anchor = Window.partitionBy("anchor")
    judged = (
        places(numbered, frequent_anchors(documents))
        .withColumn("first_place", F.first(F.struct("number", "at")).over(same))
        .withColumn("mixed", F.min("content").over(one_anchor) != F.max("content").over(one_anchor))
        .withColumn("again", F.col("first_place") != F.struct("number", "at"))
        .where(F.col("again") | (F.col("mixed") & (F.col("at").bitwiseAND(1) == 0)))
        .select("anchor", "number", "at", "again")
    )
    judged = stored(judged, "segments")
    first, last, distance = _unpacked()
    whole = judged.where("again").select("number", first, last)
    open_ = judged.where(~F.col("again")).select("anchor", "number", first, last, distance)
    sizes = open_.agg(F.sum(F.col("last") - F.col("first") + LENGTH + 1)).first()[0] or 0
    shards = max(1, -(-sizes // SHARD_BYTES))
    wanted = open_.groupBy("number").agg(F.collect_list(F.struct("anchor", "first", "last", "distance")).alias("wanted"))

    def cut(numbers, texts, wanted):
        out: dict[str, list] = {c: [] for c in ("anchor", "number", "first", "distance", "raw")}
        for number, text, some in zip(numbers, texts, wanted, strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            for w in some:
                piece = raw[w["first"] : w["last"] + LENGTH]
                for field, value in zip(out.values(), (w["anchor"], number, w["first"], w["distance"], piece), strict=True):
                    field.append(value)
        return out

    with_text = numbered.join(_few(stored(wanted, "wanted")), "number")
    pieces = map_rows(with_text, cut, "anchor long, number long, first long, distance long, raw binary", "number", "text", "wanted")
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    strings = pieces.groupBy("shard").applyInArrow(_shard, "number long, first long")
    ranges = whole.unionByName(strings.withColumn("last", F.col("first")))
    ranges = ranges.select("number", F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end")).distinct()
    in_order = Window.partitionBy("number").orderBy("begin", "end")
    before = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(before >= F.col("begin"), 0).otherwise(1)
    islands = ranges.withColumn("apart", apart).withColumn("island", F.sum("apart").over(in_order))
    merged = islands.groupBy("number", "island").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return merged.select("number", "begin", "end")


def kept_bytes(raw: bytes, ranges: list) -> bytes:
    out, at = [], 0
    for begin, end in sorted((r["begin"], r["end"]) for r in ranges):
        out.append(raw[at:begin])
        at = end
    return b"".join(out) + raw[at:]


def deduplicate(documents: DataFrame) -> DataFrame:
    """doc_id, text and removed (array of begin, end in bytes) of every document."""
    texts = texts_in_order(documents)
    found = repeats(documents, texts).groupBy("number").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    found = stored(found, "repeats")
    known = texts.join(found, "number", "left").select("digest", "first_id", "copies", "ranges")
    notable = _few(known.where("copies > 1 OR ranges IS NOT NULL").drop("copies"))  # the others lose nothing
    held = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.md5(F.col("text").cast("binary"))
    joined = held.withColumn("own", digest).join(notable, F.col("own") == F.col("digest"), "left")
    n = F.octet_length("text").cast("long")
    copy = F.col("digest").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("doc_id"))
    nothing = F.array().cast("array<struct<begin: long, end: long>>")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("begin"), n.alias("end")))
    removed = (
        F.when(copy & (n >= LENGTH), everything).when(copy, nothing).otherwise(F.coalesce("ranges", nothing))
    )
    return joined.select("doc_id", "text", removed.alias("removed"))


@query()
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"))

    def digested(ids, texts, removed):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        return {
            "doc_id": ids,
            "n_bytes": [len(r) for r in raw],
            "n_removed": [sum(x["end"] - x["begin"] for x in some) for some in removed],
            "n_spans": [len(some) for some in removed],
            "kept_sha256": [hashlib.sha256(kept_bytes(r, some)).hexdigest() for r, some in zip(raw, removed, strict=True)],
        }

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_rows(found, digested, schema, "doc_id", "text", "removed")
