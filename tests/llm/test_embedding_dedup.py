import math

import numpy as np
import pytest

from tidemark.llm import embedding_dedup as ed
from tidemark.llm import hnsw
from tidemark.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.01"
NAMES = ("vec_id", "n_links", "component_id", "kept")


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, least=0.95):
    dims = max((len(v) for _, v in rows if v), default=1)
    good = [k for k, (_, v) in enumerate(rows) if usable(v)]
    u = np.zeros((len(rows), dims))
    for k in good:
        x = np.array([*rows[k][1], *([0.0] * (dims - len(rows[k][1])))], float)
        x = x / np.abs(x).max()
        u[k] = x / np.linalg.norm(x)
    linked = u @ u.T >= least
    np.fill_diagonal(linked, False)
    component = list(range(len(rows)))
    for k in range(len(rows)):  # flood
        if component[k] == k:
            open_ = [k]
            while open_:
                x = open_.pop()
                for y in np.flatnonzero(linked[x]):
                    if component[y] != k and y != k:
                        component[y] = k
                        open_.append(y)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if component[j] == component[k] and rows[j][0] is not None]
        name = min(ids, default=None)
        out.append((i, int(linked[k].sum()), name, i == name))
    return sorted(out, key=repr)


def found(spark, rows, tmp_path, clash=True):
    frame = spark.createDataFrame([(i, v, 1, "x", 2.0, "y") for i, v in rows], "vec_id long, embedding array<double>, node int, v string, copies double, shard string")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = LLM_QUERIES["op12_embedding_dedup"](spark, str(tmp_path)).select(*NAMES).collect()
    return sorted((tuple(r) for r in got), key=repr)


def groups(rng, singles, sizes, dims=16, noise=0.05):
    """Vectors apart from each other, and groups around some centres, partly beyond the threshold."""
    parts = [rng.normal(size=(singles, dims))]
    for size in sizes:
        centre = rng.normal(size=dims)
        centre /= np.linalg.norm(centre)
        parts.append(centre + rng.normal(size=(size, dims)) * noise)
    vectors = np.vstack(parts)
    return vectors[rng.permutation(len(vectors))]


def test_odd_rows(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [1.0, inf]),
        (None, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0]), (9, [2.0, -0.0, 0.0]), (10, [1.0, 0.1]),
        (10, [0.0, 5.0]), (11, [0.0, -5.0]), (12, [1e200, 1e199]), (None, [0.0, 3e-320]), (None, [-1.0, -1.0, 9.0]),
    ]
    assert found(spark, rows, tmp_path) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_only_vectors_that_link_with_nothing(spark, tmp_path):
    rows = [(1, None), (2, [0.0])]
    assert found(spark, rows, tmp_path) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_against_brute_force(spark, tmp_path):
    """Groups from two to hundreds, chains beyond the threshold, copies."""
    vectors = groups(np.random.default_rng(5), 400, [2, 3, 5, 40, 300])
    vectors = np.vstack([vectors, vectors[:30], vectors[:1].repeat(50, axis=0)])
    rows = [(7 * k % 10_007, v.tolist()) for k, v in enumerate(vectors)]
    assert found(spark, rows, tmp_path) == brute(rows)


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = LLM_QUERIES["op12_embedding_dedup"](spark, SF).select(*NAMES).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


@pytest.mark.parametrize("exact_from", [17, 256])
def test_links_of_a_shard(monkeypatch, exact_from):
    """Recall over groups of every size; each pair is counted once whether scanned or found by beams."""
    monkeypatch.setattr(ed, "EXACT_FROM", exact_from)
    u = ed.unit(groups(np.random.default_rng(7), 3000, [2] * 100 + [3] * 30 + [9] * 10 + [200], dims=32, noise=0.03))
    u, other = u[:2500], u[2500:]
    copies, q_copies = np.arange(len(u)) % 3 + 1, np.arange(len(other)) % 2 + 1
    graph = hnsw.Graph(u)
    alone = ed.links(graph, u, copies, None, None, 0.95)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    assert (alone.hits <= near @ copies).all() and alone.hits.sum() >= 0.99 * (near @ copies).sum()
    two = ed.links(graph, u, copies, other, q_copies, 0.95)
    near = other @ u.T >= 0.95
    truth = np.concatenate([near.T @ q_copies, near @ copies])
    assert (two.hits <= truth).all() and two.hits.sum() >= 0.99 * truth.sum()
    beam, recall = ed.audited_beam(graph, u, other, 0.95)
    assert recall >= ed.RECALL or beam >= exact_from


def test_beam_widens_until_the_audit_passes(monkeypatch):
    """A graph without links finds nothing, so the beam ends where all is scanned."""
    u = ed.unit(groups(np.random.default_rng(8), 600, [2] * 50, dims=8))
    graph = hnsw.Graph(u)
    broken = hnsw.Graph(u, [np.full_like(layer, -1) for layer in graph.layers])
    assert ed.audited_beam(graph, u, u, 0.95)[0] < ed.EXACT_FROM
    assert ed.audited_beam(broken, u, u, 0.95)[0] >= ed.EXACT_FROM
    got = ed.links(broken, u, np.ones(len(u), np.int64), None, None, 0.95)
    near = u @ u.T >= 0.95
    assert got.hits.tolist() == (near.sum(axis=1) - 1).tolist()


def test_graph_survives_storage():
    u = ed.unit(np.random.default_rng(9).normal(size=(5000, 8)))
    graph = hnsw.Graph(u)
    links = [b"".join(layer[k].tobytes() for layer in graph.layers if k < len(layer)) for k in range(len(u))]
    again = ed._graph(links, u)
    assert len(graph.layers) > 1 and all(np.array_equal(a, b) for a, b in zip(graph.layers, again.layers, strict=True))


def test_labels():
    labels = np.arange(9)
    ed._merge(labels, np.array([1, 2, 8]), np.array([2, 3, 7]))
    ed._merge(labels, np.array([3, 5]), np.array([7, 4]))
    assert labels.tolist() == [0, 1, 1, 1, 4, 4, 6, 1, 1]
