import itertools
import random
import time
import zlib

import numpy as np

from corpus import ODD, SF, documents
from tidemark.llm import packing
from tidemark.llm.registry import LLM_QUERIES
from tidemark.llm.tokens import encoder
import tidemark.llm.queries  # noqa: F401


def counts_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1).astype(np.int64)


def fewest(lengths, capacity):
    """The least number of sequences, by trying."""
    lengths = sorted(lengths, reverse=True)
    for n in itertools.count(1):
        def fits(k, rooms):
            if k == len(lengths):
                return True
            for at, room in enumerate(rooms):
                if room >= lengths[k] and room not in rooms[:at]:
                    if fits(k + 1, (*rooms[:at], room - lengths[k], *rooms[at + 1 :])):
                        return True
            return False

        if fits(0, (capacity,) * n):
            return n


def test_plans_are_best_and_whole():
    rng = random.Random(9)
    better = 0
    for _ in range(150):
        capacity = rng.choice([10, 15, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
        counts = counts_of(lengths, capacity)
        plan = packing.pack_counts(counts, capacity)
        assert sum(n for n, _ in plan) == fewest(lengths, capacity)
        better += sum(n for n, _ in packing.best_fit_decreasing(counts, capacity)) > sum(n for n, _ in plan)
        by_length, seen = packing.places(plan, capacity), {}
        for length in range(1, capacity + 1):
            for k in range(counts[length]):
                sequence, offset = packing.place(by_length, length, k)
                seen.setdefault(sequence, []).append((offset, length))
        for inside in seen.values():
            ends = np.cumsum([0] + [n for _, n in sorted(inside)])
            assert [o for o, _ in sorted(inside)] == ends[:-1].tolist() and ends[-1] <= capacity


def test_completion_beats_best_fit():
    lengths = [6, 6, 5, 5, 4, 4, 3, 3, 3, 3, 2, 2, 2, 2]
    counts = counts_of(lengths, 10)
    assert sum(n for n, _ in packing.pack_counts(counts, 10)) == fewest(lengths, 10) == 5


def test_fillings_are_undominated():
    counts = counts_of([7, 5, 4, 3, 3, 2, 1], 10)
    assert packing.fillings(counts, 7) == [(7,)]
    assert packing.fillings(counts, 0) == [()]
    assert all(sum(f) == 6 for f in packing.fillings(counts, 6))


def test_fillings_against_all_choices():
    """Every undominated choice once, and no other, by rising waste."""
    rng = random.Random(5)
    for _ in range(200):
        lengths = [rng.randint(1, 9) for _ in range(rng.randint(0, 7))]
        rest = rng.randint(0, 14)
        choices = {tuple(sorted(c, reverse=True)) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= rest}

        def dominated(choice):
            left = list(lengths)
            for n in choice:
                left.remove(n)
            waste = rest - sum(choice)
            return any(n <= waste for n in left) or any(a < n <= a + waste for a in choice for n in left)

        found = packing.fillings(counts_of(lengths, 14), rest)
        wanted = {c for c in choices if not dominated(c)}
        if rest in lengths:
            wanted = {(rest,)}
        assert len(found) == len(set(found)) and set(found) == wanted
        assert [rest - sum(f) for f in found] == sorted(rest - sum(f) for f in found)


def test_search_is_bounded_in_time():
    """Three thousand pieces of which few fit together."""
    rng = np.random.default_rng(0)
    lengths = rng.integers(900, 1501, 3000)
    counts = counts_of(lengths, 4096)
    started = time.process_time()
    plan = packing.pack_counts(counts)
    assert time.process_time() - started < 10
    assert sum(n for n, _ in plan) <= sum(n for n, _ in packing.best_fit_decreasing(counts, 4096))


def check(rows, texts):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in texts.items():
        ids = np.array(encoder("word_bpe_49k.json").tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [r["start"] for r in pieces] == list(range(0, len(ids), 4096))
        for r in pieces:
            part = ids[r["start"] : r["start"] + 4096]
            assert (r["length"], r["ids_crc32"]) == (len(part), zlib.crc32(part.tobytes()))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for inside in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(inside)])
        assert [o for o, _ in sorted(inside)] == ends[:-1].tolist() and ends[-1] <= 4096
    return len(sequences)


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = LLM_QUERIES["op7_packing"](spark, SF).collect()
    assert check(rows, texts) == -(-sum(r["length"] for r in rows) // 4096)


def test_odd_rows_and_empty_table(spark):
    rows = packing.pack(packing.pieces(documents(spark, ODD))).collect()
    check(rows, {i: t for i, t in ODD if i != 5})
    assert sum(r["doc_id"] == 5 for r in rows) == 3
    assert packing.pack(packing.pieces(documents(spark, []))).count() == 0
