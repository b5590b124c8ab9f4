import random

import numpy as np
import pytest

import corpus_pipeline
from corpus import ODD, SF, documents
from tidemark.llm import ngram_join as nj
from tidemark.llm.components import components
from tidemark.llm.registry import LLM_QUERIES
import tidemark.llm.queries  # noqa: F401


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 3]) for k in range(len(words) - 2)) if len(words) > 2 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs; rows have distinct ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                a_, b_ = sorted((root(a), root(b)))
                parent[b_] = a_
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def near_copies(seed=6):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    base, passage, rows = text(120), text(30), []
    for k in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append(copy)
    chain = text(90)
    for k in range(12):  # each is like the one before only
        chain = chain[3:] + text(3)
        rows.append(list(chain))
    rows += [text(rng.randint(20, 60)) + passage + text(20) for _ in range(25)]
    rows += [text(n) for n in (1, 2, 3, 8, 9, 10, 11, 12)]
    small = text(12)
    rows += [small, small[:-1], small[:-2]]
    rng.shuffle(rows)
    return [(k * 3 + 1, " ".join(r)) for k, r in enumerate(rows)]


@pytest.mark.parametrize("frequent", [1, 4, 16])
def test_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(nj, "FREQUENT", frequent)
    rows = near_copies()
    found = nj.join(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(nj, "BROADCAST_ROWS", 0)
    rows = near_copies(7)[:40]
    found = nj.join(documents(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in LLM_QUERIES["op10_ngram_join"](spark, SF).collect()) == brute(rows)


def test_similar_sets_share_an_entry():
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(9, 400))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = x.copy()
        for _ in range(int(rng.integers(1, max(2, n // 15)))):
            y = np.delete(y, rng.integers(len(y))) if rng.random() < 0.5 else np.append(y, rng.integers(0, 1 << 63).astype(np.uint64))
        y = np.unique(y)
        both = len(np.intersect1d(x, y))
        if 100 * both < 90 * (len(x) + len(y) - both):
            continue
        for share in (0.0, 0.3, 0.9, 1.0):
            often = np.sort(x[rng.random(len(x)) < share])
            found = [nj.entries(s, len(s), often) for s in (x, y)]
            assert len(np.intersect1d(*found)), (n, share)
        z = (nj.sketch(x), nj.sketch(y))
        if len(z[0]) == len(z[1]):
            cells = sum(int(a ^ b).bit_count() if a ^ b >= 0 else 64 - int(~(a ^ b)).bit_count() for a, b in zip(*map(np.ndarray.tolist, z)))
            assert cells <= len(x) + len(y) - 2 * both


def test_odd_rows(spark):
    found = nj.join(documents(spark, ODD)).collect()
    assert len(found) == len(ODD)
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by_id[1] == [(0, 1)] and by_id[2] == [(0, 2)] and by_id[3] == [(0, 3)] and by_id[4] == [(1, 4)]
    assert by_id[5] == [(7, 5)] * 3 and by_id[None][0][1] is None and by_id[7] == [(1, 7)]
    assert nj.join(documents(spark, [])).count() == 0


def test_one_of_each(spark):
    docs = documents(spark, [*ODD, (50, "the same row twice with some words in it")])
    kept = nj.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert [i for i, _ in rows] == [0, 1, 2, 3, 4, 5, 5, 6, 7] or [i for i, _ in rows] == [0, 1, 2, 3, 4, 5, 6, 7]
    assert ("the same row twice with some words in it") in {t for _, t in rows}
    near = near_copies()
    kept = {r["doc_id"] for r in nj.one_of_each(documents(spark, near)).collect()}
    assert kept == {c for _, _, c in brute(near)}


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 200), (200, 150), (300, 300)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert all(found[k] == 1 for k in range(1, 61)) and {found[k] for k in (100, 150, 200)} == {100}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_five_words(rows):
    """Least ids of the components of pairs with four fifths of their five-word shingles in common."""
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        sets[i] = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    group = {i: {i} for i in sets}
    for a in sets:
        for b in sets:
            if group[a] is not group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                group[a] |= group[b]
                for i in group[b]:
                    group[i] = group[a]
    return {min(g) for g in group.values()}


@pytest.mark.parametrize("frequent", [1, 16])
def test_stage_against_five_word_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(nj, "FREQUENT", frequent)
    base = [f"v{k}" for k in range(100)]
    other = [*base[:30], "x", *base[31:70], "y", *base[71:]]  # 0.82 on five words, 0.89 on three
    rows = [*near_copies(), (900, " ".join(base)), (901, " ".join(other))]
    wanted = brute_five_words(rows)
    assert 900 in wanted and 901 not in wanted
    kept = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), SF)
    assert {r["doc_id"] for r in kept.collect()} == wanted


def test_similar_sets_share_an_entry_at_other_shares():
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(5, 300))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        changed = rng.random(len(x)) < rng.uniform(0, 0.12)
        y = np.unique(np.where(changed, rng.integers(0, 1 << 63, len(x)).astype(np.uint64), x))
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        for share in (0.0, 0.5, 1.0):
            often = np.sort(x[rng.random(len(x)) < share])
            found = [nj.entries(s, len(s), often, (80, 100)) for s in (x, y)]
            assert not changed.any() or len(np.intersect1d(*found)), (n, share)


def test_one_of_each_with_null_and_repeated_ids(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 9) for _ in range(40))
    rows = [(None, text()) for _ in range(6)] + [(5, text()) for _ in range(6)] + [(k, text()) for k in range(10, 16)]
    copies = [rows[0], rows[6], rows[6], (20, rows[1][1]), (5, rows[2][1]), (21, rows[12][1])]
    odd = [(5, "  "), (5, "  "), (None, None), (None, None)]
    kept = nj.one_of_each(documents(spark, rows + copies + odd)).collect()
    wanted = [rows[0], (20, rows[1][1]), (5, rows[2][1]), *rows[3:], *odd]
    assert sorted(map(repr, wanted)) == sorted(repr((r["doc_id"], r["text"])) for r in kept)
    both = {r["text"] for r in nj.one_of_each(documents(spark, ODD)).where("doc_id = 5").collect()}
    assert both == {t for i, t in ODD if i == 5}
