import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import vector_search as vs


def brute(rows, top=10):
    vectors = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in vectors if i % 100 == 0}):
        mine = min(v for i, v in vectors if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in vectors if i != q)[:top]
        out += [(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    return out


def found(spark, rows):
    vectors = vs.integer_vectors(spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, bucket int, length string"))
    got = vs.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0)).collect()
    return sorted(tuple(r) for r in got)


def as_floats(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("rows_per_block", [16, 4096])
def test_against_brute_force(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(vs, "BLOCK_ROWS", rows_per_block)
    monkeypatch.setattr(vs, "SEED_ROWS", 12)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8))
    rows = [(k, (centres[k % 5] * rng.uniform(0.1, 3) + rng.normal(scale=0.05, size=8)).tolist()) for k in range(401)]
    rows += [(1000, [0.0] * 8), (1001, [-5.0] * 8), (1100, [0.001] * 8)]
    rows = as_floats(rows)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (200, None), (300, [float("nan"), 1.0]), (400, [None, 1.0]), (500, [float("inf"), 1.0])]
    rows += [(None, [9.0, 9.0]), (7, [3.0, 1.0]), (7, [3.0, 1.0]), (8, []), (9, [1.0])]
    wanted = brute([(i, v if v is None or len(v) == 2 else [*v, *([0.0] * (2 - len(v)))]) for i, v in rows])
    assert found(spark, rows) == wanted
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []


def test_rounds_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = as_floats([(k * 50, rng.normal(size=4).tolist()) for k in range(60)])
    monkeypatch.setattr(vs, "ROUND_BYTES", 400)
    assert found(spark, rows) == brute(rows)


def test_pruning_loses_nothing():
    rng = np.random.default_rng(4)
    for _ in range(50):
        vectors = rng.integers(-50, 50, (40, 5))
        lengths = np.sqrt((vectors**2).sum(1).astype(float))
        order = np.argsort(-lengths)
        vectors, lengths = vectors[order], lengths[order]
        q = rng.integers(-50, 50, 5)
        scores = vectors @ q
        bound = float(np.sort(scores)[-3])
        kept = vs.survivors(q, float(np.sqrt((q**2).sum())), bound, vectors / lengths[:, None], lengths)
        assert set(np.flatnonzero(scores >= bound)) <= set(kept.tolist())


def test_large_products_stay_exact():
    big = np.array([[1 << 30, 3]])
    assert vs.products(big, big)[0, 0] == (1 << 60) + 9
