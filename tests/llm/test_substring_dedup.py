import hashlib
import random

import numpy as np
import pytest

from corpus import ODD, SF, documents
from tidemark.llm import substring_dedup as sd
from tidemark.llm import suffix_array as sa
from tidemark.llm.registry import LLM_QUERIES
import tidemark.llm.queries  # noqa: F401


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) by looking at every string in order."""
    first, out = {}, []
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())
    for doc_id, text in sorted(rows, key=key):
        raw, me = (text or "").encode(), key((doc_id, text))
        mark = np.zeros(len(raw), bool)
        for k in range(len(raw) - sd.LENGTH + 1):
            if first.setdefault(raw[k : k + sd.LENGTH], (me, k)) < (me, k):
                mark[k : k + sd.LENGTH] = True
        spans = int((np.diff(mark.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~mark].tobytes()
        out.append((doc_id, len(raw), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [4, 1024])
def test_suffix_array_and_common_prefixes(monkeypatch, buckets):
    monkeypatch.setattr(sa, "MAX_BUCKETS", buckets)
    rng = random.Random(5)
    for _ in range(500):
        k = rng.choice([2, 3, 5, 20])
        s = [rng.randint(1, k) for _ in range(rng.randint(1, 50))] * rng.choice([1, 1, 3]) + [0]
        order = sa.suffix_array(np.array(s), k + 1)
        wanted = sorted(range(len(s)), key=lambda i: s[i:])
        assert order.tolist() == wanted
        shared = sa.permuted_lcp(np.array(s), order, 1)
        for a, b in zip(wanted, wanted[1:], strict=False):
            n = 0
            while s[a + n] == s[b + n] and s[b + n] > 1:
                n += 1
            assert shared[b] == n


def cases():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = text(40), "x" * 30 + "one very common line of text" + "y" * 60
    rows = [(k, text(20) + " " + passage + " " + text(10)) for k in range(6)]
    rows += [(10 + k, text(5) + line + text(25) + line) for k in range(12)]
    rows += [(30, "z" * 500), (31, "ab" * 200), (32, passage), (33, passage), (33, passage), (33, passage[:150]), (None, passage)]
    rows += [(40, text(60)), (41, "é" * 120)] + [(i, t) for i, t in ODD if i != 7]
    return rows


@pytest.mark.parametrize("split", [False, True])
def test_against_brute_force(spark, monkeypatch, split):
    rows = cases()
    if split:
        every = np.unique(np.concatenate([sd.segments((t or "").encode())[0] for _, t in rows]))
        monkeypatch.setattr(sd, "frequent_anchors", lambda _: every[::2])
    found = sd.deduplicate(documents(spark, rows)).collect()
    out = []
    for r in found:
        raw = r["text"].encode()
        kept = sd.kept_bytes(raw, r["removed"])
        out.append((r["doc_id"], len(raw), len(raw) - len(kept), len(r["removed"]), hashlib.sha256(kept).hexdigest()))
    wanted = brute(list(dict.fromkeys(rows)))
    repeated = [w for w in wanted if w[0] in (5, 33)]
    assert sorted(set(out), key=str) == sorted(set(wanted), key=str), (set(out) ^ set(wanted), repeated)
    assert len(out) == len(rows)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in LLM_QUERIES["op4_substring_dedup"](spark, SF).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert sd.deduplicate(documents(spark, [])).count() == 0


def test_frequent_anchors_are_found(spark):
    line = "this very line stands in each and every document of the whole collection, word for word, always"
    rows = [(k, f"{k} {k * 7} {line} and {k} ends here {'abc' * (k % 9)}{k}") for k in range(60)]
    hot = sd.frequent_anchors(documents(spark, rows))
    assert len(hot) and (np.diff(hot.view(np.int64)) != 0).all()
