"""Best-fit packing by bin completion with branch and bound.

Only lengths matter, and there are at most ``CAPACITY`` of them, so the plan is made from the counts of
pieces by length, however many pieces there are. Around the largest piece left, undominated fillings
of the rest are enumerated by rising waste, each when it is asked for (a filling is dominated if a piece
not in it could be added, or take the place of a shorter one); one is taken as often as the counts allow. Choices are
tried depth first; the best-fit-decreasing packing and every better one found are incumbents, and a
branch is pruned once its waste shows that it cannot use fewer sequences. The search ends at the lower
bound, or after ``NODES`` choices in all with the best incumbent.

A plan is a list of patterns with how often each is used. Pieces are numbered within their length and
take the place of that number, so that no group of equal lengths meets in one task.

Defined results: null and empty texts have the end id only. Repeated rows and ids are packed each.
Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, running_number, stored, table
from tidemark.llm.registry import query
from tidemark.llm.tokens import encoder

CAPACITY = 4096
NODES = 4000  # choices tried, each a pattern taken as often as the counts allow
TOKENIZER = "word_bpe_49k.json"
END = 1

Pattern = tuple[int, tuple[int, ...]]  # how often, lengths


def _reachable(counts: np.ndarray, rest: int) -> int:
    """The sums up to ``rest`` that pieces left can make, as bits."""
    mask, sums = (1 << (rest + 1)) - 1, 1
    for length in np.flatnonzero(counts[: rest + 1]):
        length = int(length)
        n, step = min(int(counts[length]), rest // length) if length else 0, 1
        while n > 0:
            step = min(step, n)
            sums |= (sums << (length * step)) & mask
            n -= step
            step *= 2
        if sums == mask:
            break
    return sums


def _sums_to(lengths: list[int], left: list[int], target: int, sums: int) -> Iterator[tuple[int, ...]]:
    """All choices among ``lengths`` (descending, ``left`` of each) that sum to ``target``, long ones first.

    ``sums`` are the sums that can be made of them at all; other targets are not followed.
    """
    chosen: list[int] = []
    at = [0]
    while at:
        k = at[-1]
        if k >= len(lengths):
            at.pop()
        else:
            length = lengths[k]
            if length <= target and left[k] and sums >> (target - length) & 1:
                at[-1] = k + 1  # tried next when this branch is done
                if length == target:
                    yield (*chosen, length)
                    continue
                left[k] -= 1
                chosen.append(length)
                target -= length
                at.append(k)
                continue
            # lengths beyond the target are passed over at once
            at[-1] = k + 1 if length <= target else max(k + 1, bisect_left(lengths, -target, key=lambda x: -x))
            continue
        if chosen:
            length = chosen.pop()
            left[bisect_left(lengths, -length, key=lambda x: -x)] += 1
            target += length


def fillings(counts: np.ndarray, rest: int) -> list[tuple[int, ...]]:
    """All undominated fillings of ``rest``, least waste first."""
    return list(each_filling(counts, rest))


def each_filling(counts: np.ndarray, rest: int) -> Iterator[tuple[int, ...]]:
    """The undominated fillings of ``rest``, least waste first; made one by one as they are asked for."""
    have = np.flatnonzero(counts[: rest + 1])[::-1]
    if rest == 0 or not len(have):
        yield ()
        return
    if have[0] == rest:
        yield (rest,)  # dominates every other filling
        return
    lengths, left = have.tolist(), counts[have].tolist()
    sums = _reachable(counts, rest)
    for target in range(rest, 0, -1):
        if not sums >> target & 1:
            continue
        waste = rest - target
        for filling in _sums_to(lengths, left.copy(), target, sums):
            if not waste or not _dominated(filling, waste, lengths, left):
                yield filling


def _dominated(filling: tuple[int, ...], waste: int, lengths: list[int], left: list[int]) -> bool:
    """Whether a piece not used could be added, or take the place of a shorter one."""
    used = Counter(filling)
    unused = [n for n, count in zip(lengths, left, strict=True) if count > used.get(n, 0)]
    if unused and unused[-1] <= waste:
        return True
    return any((k := bisect_left(unused, -(a + waste), key=lambda x: -x)) < len(unused) and unused[k] > a for a in used)


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """The first incumbent: each piece, longest first, where it leaves least room."""
    rooms: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(capacity + 1)]  # by room: how many, lengths
    for length in np.flatnonzero(counts)[::-1]:
        length, n = int(length), int(counts[length])
        room = length
        while n:
            while room <= capacity and not rooms[room]:
                room += 1
            if room > capacity:
                fit = min(capacity // length, n)
                bins, odd = divmod(n, fit)
                rooms[capacity - fit * length].append((bins, (length,) * fit))
                if odd:
                    rooms[capacity - odd * length].append((1, (length,) * odd))
                break
            bins, inside = rooms[room].pop()
            used = min(bins, n)
            if bins > used:
                rooms[room].append((bins - used, inside))
            rooms[room - length].append((used, (*inside, length)))
            n -= used
            if room - length >= length:
                room = length
    return [p for room in rooms for p in room]


def pack_counts(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold all pieces; ``counts[n]`` pieces have length n."""
    total = int(counts @ np.arange(len(counts)))
    if not total:
        return []
    bound = max(-(-total // capacity), int(counts[capacity // 2 + 1 :].sum()))
    best = best_fit_decreasing(counts, capacity)
    fewest = sum(n for n, _ in best)
    # a node: counts, tokens left, sequences so far, patterns (linked), fillings not tried yet
    lengths = np.arange(len(counts))

    def children(left: np.ndarray) -> tuple[int, Iterator[tuple[int, ...]]]:
        longest = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[longest] -= 1
        return longest, each_filling(rest, capacity - longest)

    stack = [(counts.astype(np.int64), total, 0, None, *children(counts))]
    while stack and nodes and fewest > bound:
        left, tokens, used, path, longest, choices = stack[-1]
        filling = next(choices, None)
        if filling is None:
            stack.pop()
            continue
        nodes -= 1
        inside, times = np.unique((longest, *filling), return_counts=True)
        often = int((left[inside] // times).min())
        after = left.copy()
        after[inside] -= often * times
        tokens, used, path = tokens - often * (longest + sum(filling)), used + often, (path, (often, (longest, *filling)))
        if not tokens:
            if used < fewest:
                fewest, best = used, []
                while path:
                    path, pattern = path
                    best.append(pattern)
        elif used + -(-tokens // capacity) < fewest:  # else too much is wasted already
            stack.append((after, tokens, used, path, *children(after)))
    assert np.array_equal(sum((n * np.bincount(p, minlength=len(counts)) for n, p in best), 0 * lengths), counts)
    return best


def places(patterns: list[Pattern], capacity: int = CAPACITY) -> dict[int, np.ndarray]:
    """Per length rows (first number, times in a sequence, first sequence, offset) that number the pieces."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for often, inside in patterns:
        offset = 0
        for length in sorted(set(inside), reverse=True):
            times = inside.count(length)
            out.setdefault(length, []).append((taken.get(length, 0), times, sequence, offset))
            taken[length] = taken.get(length, 0) + often * times
            offset += times * length
        sequence += often
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def place(by_length: dict[int, np.ndarray], length: int, number: int) -> tuple[int, int]:
    """Sequence and offset of the piece of that number among the pieces of its length."""
    sequence, offset = Places(by_length).find(np.array([length]), np.array([number]))
    return int(sequence[0]), int(offset[0])


class Places:
    """``places`` as arrays, for many pieces at a time."""

    def __init__(self, by_length: dict[int, np.ndarray]) -> None:
        lengths = sorted(by_length)
        rows = np.concatenate([by_length[n] for n in lengths]) if lengths else np.zeros((0, 4), np.int64)
        length = np.repeat(lengths, [len(by_length[n]) for n in lengths]).astype(np.int64)
        self.first, self.times, self.sequence, self.offset = rows.T
        self.key = self._key(length, self.first)  # ascending

    @staticmethod
    def _key(length: np.ndarray, number: np.ndarray) -> np.ndarray:
        return length.astype(np.int64) << 48 | number

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets of the pieces of these numbers among those of their lengths."""
        row = np.searchsorted(self.key, self._key(length, number), "right") - 1
        past = number - self.first[row]
        return self.sequence[row] + past // self.times[row], self.offset[row] + past % self.times[row] * length


def pieces(documents: DataFrame, tokenizer: str = TOKENIZER, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids cut into pieces of at most ``capacity``: doc_id, piece, start, length, ids_crc32."""
    last = np.array([end], "<u4").tobytes()

    def cut(doc_ids, texts):
        out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, ids in zip(doc_ids, encoder(tokenizer).encode(texts), strict=True):
            ids += last
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                for field, value in zip(out.values(), (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    field.append(value)
        return out

    return map_rows(documents, cut, "doc_id long, piece int, start long, length long, ids_crc32 long", "doc_id", "text")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    spark = cut.sparkSession
    cut = stored(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    shared = spark.sparkContext.broadcast(Places(places(pack_counts(counts, capacity), capacity)))
    numbered = running_number(cut, ["length"], ["row"], "number", int(counts.sum()))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def placed(*values):
        sequence, offset = shared.value.find(np.array(values[3], np.int64), np.array(values[5], np.int64))
        return dict(zip(columns, values, strict=False)) | {"sequence_id": sequence, "offset": offset}

    return map_rows(
        numbered,
        placed,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        *columns, "number",
    )


@query()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents")))
