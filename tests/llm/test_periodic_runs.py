import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import difference_cover as dc
from tidemark.llm import periodic_runs as pr
from tidemark.llm.queries import LLM_QUERIES
from corpus import ODD, SF, documents


def brute_runs(words):
    """Every (start, length, period), by trying all stretches of equal words at every distance."""
    n, spans = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - i + q
            if length >= max(6, 4 * q):
                spans.setdefault((i, length), q)
            i = end
    return sorted((start, length, q) for (start, length), q in spans.items())


def brute(doc_id, text):
    words = [] if text is None else text.encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    best = (None, None, None, None)
    if runs:
        from fractions import Fraction

        s, l, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, l, q, 1000 * l // q)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def found(spark, frame, tmp_path):
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = LLM_QUERIES["op11_periodic_runs"](spark, str(tmp_path)).select(*NAMES).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def runs(texts):
    return [[tuple(r) for r in rows.tolist()] for _, rows in pr.runs_of_texts([t.encode() for t in texts])]


@given(st.integers(7, 40))
@settings(max_examples=10, deadline=None)
def test_cover_reaches_every_remainder(period):
    chosen = dc.cover(period).tolist()
    assert {(a - b) % period for a in chosen for b in chosen} == set(range(period))
    assert len(dc.COVER) <= 9


@given(st.lists(st.integers(0, 1), max_size=120), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_extensions(part, copies):
    words = np.array((part * copies)[:300], np.int64)
    n = len(words)
    if n < 2:
        return
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, n, 200), rng.integers(0, n, 200)
    a, b = a[a != b], b[a != b]

    def plain(x, y):
        k = 0
        while max(x, y) + k < n and words[x + k] == words[y + k]:
            k += 1
        return k

    assert dc.Extensions(words)(a, b).tolist() == [plain(x, y) for x, y in zip(a.tolist(), b.tolist())]


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=6), st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_runs_against_brute_force(parts, copies):
    texts = [" ".join(p * copies + ["c", "a"]) for p in parts]
    assert runs(texts) == [brute_runs(t.split()) for t in texts]


def test_runs_within_runs_and_across_batches(monkeypatch):
    rng = np.random.default_rng(3)
    texts = []
    for k in range(60):
        period = [f"w{x}" for x in rng.integers(0, 6, rng.integers(1, 40))]
        stem = [f"w{x}" for x in rng.integers(0, 3, rng.integers(0, 50))]
        texts.append(" ".join(stem + period * int(rng.integers(3, 9)) + period[: len(period) // 2] + stem + ["z"] * 9))
    wanted = [brute_runs(t.split()) for t in texts]
    assert runs(texts) == wanted
    monkeypatch.setattr(pr, "BATCH_WORDS", 100)
    monkeypatch.setattr(pr, "GRID_POINTS", 50)
    assert runs(texts) == wanted


def test_odd_rows(spark, tmp_path):
    assert found(spark, documents(spark, ODD), tmp_path) == sorted((brute(i, t) for i, t in ODD), key=repr)


def test_empty_table(spark, tmp_path):
    assert found(spark, documents(spark, []), tmp_path) == []


def test_white_space_and_null_ids(spark, tmp_path):
    """Only ASCII white space parts words; the least id of every tenth is periodic."""
    odd = "\x0b a\x0cb\r\nc d  e \x1ff  "
    rows = [(k, odd * (k % 7) + "x y " * (k % 5)) for k in range(200)] + [(None, "p q " * 9)]
    assert found(spark, documents(spark, rows), tmp_path) == sorted((brute(i, t) for i, t in rows), key=repr)


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in LLM_QUERIES["op11_periodic_runs"](spark, SF).select(*NAMES).collect())
    assert got == sorted(brute(i, t) for i, t in docs)


@pytest.mark.parametrize("size", [70_000])
def test_one_word_repeated(size):
    (found_,) = runs(["w " * size])
    assert found_ == [(0, size, 1)]
