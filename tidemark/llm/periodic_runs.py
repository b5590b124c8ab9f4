"""Stretches of words that repeat with a period, and texts without the repetitions.

A run is a stretch with smallest period q of at least max(LEAST, REPEATS * q) words that no neighbour extends.
Within it every word equals the one q further on, for at least (REPEATS - 1) * q places in a row; so a grid of
step q has REPEATS - 1 neighbouring points there.  For every q the grid of each text is looked at (n/1 + n/2 +
... points in all).  Where neighbouring points agree, the extension to the right, then that to the left from the
first point of a stretch, are asked for (``difference_cover``), which gives every run of that period once.  A
stretch found with several periods is a run of the smallest, which divides the others.

Texts are joined in batches of a bounded number of words, with a separator of its own after each, so that all
steps work on arrays; a text longer than a batch is a batch by itself.

Words are split at ASCII white space.  Defined results: a null or empty text has no runs and an empty collapsed
text; ids may be null or repeat, each row stands for itself.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, table
from tidemark.llm.difference_cover import Extensions
from tidemark.llm.registry import query

LEAST = 6  # words of a run
REPEATS = 4  # periods of a run
BATCH_WORDS = 1 << 18
GRID_POINTS = 1 << 17  # looked at together
_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _least_length(period):
    return np.maximum(LEAST, REPEATS * period)


def _grids(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, points) of every grid, a bounded number of points at a time."""
    text = np.repeat(np.arange(len(sizes)), most := sizes // REPEATS)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    able = sizes[text] >= _least_length(period)
    text, period = text[able], period[able]
    points = (sizes[text] - 1) // period
    part = np.cumsum(points) // GRID_POINTS
    for k in np.split(np.arange(len(text)), np.flatnonzero(np.diff(part)) + 1):
        yield text[k], period[k], points[k]


def _agreeing(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, period, at) of grid points from which enough points in a row equal the next one."""
    found = ([], [], [])
    for text, period, points in _grids(sizes):
        step = np.repeat(period, points)
        at = (np.arange(len(step)) - np.repeat(np.cumsum(points) - points, points)) * step + np.repeat(starts[text], points)
        equal = words[at] == words[at + step]
        row = equal.copy()
        for k in range(1, REPEATS - 1):
            row[:-k] &= equal[k:]
            row[-k:] = False
        hit = np.flatnonzero(row)
        # the points counted must be of one grid
        hit = hit[(hit + REPEATS - 2 < len(step))]
        grid = np.repeat(np.arange(len(text)), points)
        hit = hit[grid[hit] == grid[hit + REPEATS - 2]]
        for kept, x in zip(found, (text[grid[hit]], step[hit], at[hit]), strict=True):
            kept.append(x)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)


def _chosen(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the texts joined anew, each followed by its separator, and their new starts."""
    wide = sizes[texts] + 1
    begins = np.cumsum(wide) - wide
    at = np.arange(wide.sum()) - np.repeat(begins, wide) + np.repeat(starts[texts], wide)
    return words[at], begins


def runs_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` are numbers; text k stands from starts[k] on, sizes[k] long, with a number of its own after it.
    """
    text, period, at = _agreeing(words, starts, sizes)
    texts, where = np.unique(text, return_inverse=True)
    words, begins = _chosen(words, starts, sizes, texts)
    at = at - starts[text] + begins[where]
    right = Extensions(words)
    ahead = right(at, at + period)
    # a point that its grid's last one reaches is not the first of its stretch
    reached = np.zeros(len(at), bool)
    reached[1:] = (text[1:] == text[:-1]) & (period[1:] == period[:-1]) & (at[1:] - at[:-1] == period[1:]) & (ahead[:-1] >= period[1:])
    first = np.flatnonzero(~reached & (ahead >= _least_length(period) - 2 * period + 1))
    text, where, period, at, ahead = text[first], where[first], period[first], at[first], ahead[first]
    # to the left: the same on the words reversed
    left = Extensions(words[::-1])
    behind = np.zeros(len(at), np.int64)
    inner = at > 0
    behind[inner] = left(len(words) - at[inner], len(words) - at[inner] - period[inner])
    length = ahead + behind + period
    whole = (behind < period) & (length >= _least_length(period))
    text, start, length, period = text[whole], (at - behind - begins[where])[whole], length[whole], period[whole]
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.flatnonzero(new)
    order = order[np.lexsort((period[order], start[order], text[order]))]
    return text[order], start[order], length[order], period[order]


def _batches(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    """Words of some texts at a time."""
    batch, words = [], 0
    for text in texts:
        split = (text or b"").split()
        if batch and words + len(split) > BATCH_WORDS:
            yield batch
            batch, words = [], 0
        batch.append(split)
        words += len(split)
    if batch:
        yield batch


def runs_of_texts(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """For every text its words and its runs as rows of start, length, period."""
    for batch in _batches(texts):
        sizes = np.array([len(words) for words in batch], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        numbers = pa.array([word for words in batch for word in words], pa.binary()).dictionary_encode()
        codes = np.empty(int(sizes.sum()) + len(sizes), np.int64)
        own = np.zeros(len(codes), bool)
        own[starts + sizes] = True
        codes[own] = len(numbers.dictionary) + np.arange(len(sizes))
        codes[~own] = numbers.indices.to_numpy()
        text, *columns = runs_of(codes, starts, sizes)
        rows = np.stack(columns, axis=1)
        bounds = np.searchsorted(text, np.arange(len(batch) + 1))
        for k, words in enumerate(batch):
            yield words, rows[bounds[k] : bounds[k + 1]]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside runs and in each run's first period."""
    if not len(runs):
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int64)
    np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
    np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(dropped)
    return b" ".join(word for word, out in zip(words, gone.tolist(), strict=False) if not out)


def _found(keys: list, texts: list) -> dict[str, list]:
    runs, kept = [], []
    for words, rows in runs_of_texts(texts):
        runs.append([dict(zip(("start", "length", "period"), row, strict=True)) for row in rows.tolist()])
        kept.append(collapsed(words, rows))
    return {"key": keys, "runs": runs, "collapsed": kept}


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, runs (by start, then period) and collapsed (the text without them, words joined by one space)."""
    kind = docs.schema[key].dataType.simpleString()
    read = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    found = map_rows(read, _found, f"key {kind}, runs array<{_RUN}>, collapsed binary", "key", "text")
    return found.select(F.col("key").alias(key), "runs", F.col("collapsed").cast("string").alias("collapsed"))


def strongest(runs: Column) -> Column:
    """The run with the most periods by exact ratio, then the least start, then the least period; else null."""

    def better(best: Column, run: Column) -> Column:
        mine, its = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (mine > its), run).otherwise(best)  # runs come by start and period

    return F.aggregate(runs, F.lit(None).cast(_RUN), better)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth text by the checksum of its id is made periodic from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[ \t-\r]+", -1), lambda word: word != "")
    cut = docs.select("doc_id", "text", F.floor(checksum / 10).alias("g"), F.when(checksum % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.col("g")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    periodic = F.array_join(F.concat(F.slice("words", F.lit(1), a), F.slice(copies, F.lit(1), n - a)), " ")
    return cut.select("doc_id", F.when(n > 0, periodic).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(planted(docs))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
