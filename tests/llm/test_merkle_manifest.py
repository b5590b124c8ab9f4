import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle_manifest as mm
from tidemark.llm.queries import LLM_QUERIES

H = lambda text: hashlib.sha256(text.encode()).hexdigest()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, at string, nodes string, hash int, path string, carried int"


def leaf(row):
    return H("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def up(nodes, fan):
    """All levels above a list of nodes, the list itself first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[k : k + fan])) for k in range(0, len(last), fan)])
    return levels


def siblings(levels, k, fan):
    out = []
    for nodes in levels[:-1]:
        run = k - k % fan
        out.append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + fan])))
        k //= fan
    return out


def brute(rows, fan=16):
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = up([leaf(r) for r in by[s]], fan)
    top = up([trees[s][-1][0] for s in order], fan)
    out = []
    for place, s in enumerate(order):
        for k, row in enumerate(by[s]):
            path = siblings(trees[s], k, fan) + siblings(top, place, fan)
            bent = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                bent = (*row[:4], row[4].translate(LOWER))
            node = leaf(bent)
            for left, right in path:
                node = H(left + node + right)
            proof = H("".join(a + b for a, b in path))
            out.append((row[0], leaf(row), trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def found(spark, rows, tmp_path):
    spark.createDataFrame([(*r, "x", "x", 1, "x", 2) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = LLM_QUERIES["op13_merkle_manifest"](spark, str(tmp_path))
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in got.select(*names).collect()), key=repr)


ODD = [
    (1, None, None, None, None),
    (2, None, "en", 0, ""),
    (None, "b", "en", 3, "No Id"),
    (None, "b", None, 3, "No Id"),
    (5, "b", "en", 4, "Same"),
    (5, "b", "en", 4, "Same"),
    (5, "b", "en", 4, "Another"),
    (5, "", "de", -7, "ÄÖÜ ABC \U0001f600 \x00"),
    (6, "ü", "en", 4, "K İ only A-Z"),
    (7, "Z", "en", 200_000, "Long " * 40_000),
]


def test_odd_rows(spark, tmp_path):
    assert found(spark, ODD, tmp_path) == brute(ODD)


def test_one_row(spark, tmp_path):
    assert found(spark, ODD[:1], tmp_path) == brute(ODD[:1])


def test_empty(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


@pytest.mark.parametrize("fan", [2, 16])
def test_against_brute_force(spark, tmp_path, monkeypatch, fan):
    """Sources at every border of a block, a hot one, and with a small fan several passes and many sources."""
    monkeypatch.setattr(mm, "FAN", fan)
    monkeypatch.setattr(mm, "BLOCK", fan * fan)
    sizes = {f"s{n}": n for n in (1, 2, 3, 4, 5, 15, 16, 17, 31, 255, 256, 257, 600)}
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            k += 1
            rows.append((k * 7919 % 100_003, source, "en", k, f"Text {k}"))
    rows += [(9, "copies", "en", 1, "The same Row")] * 300
    assert found(spark, rows, tmp_path) == brute(rows, fan)


def test_tampering_is_seen(spark, tmp_path):
    rows = [(k, "a", "en", 1, "UPPER" if k % 2 else "lower") for k in range(100)]
    told = {r[0]: r[-1] for r in found(spark, rows, tmp_path)}
    assert told == {k: not (k % 2 and zlib.crc32(str(k).encode()) % 5 == 0) for k in range(100)}


def test_ascii_lower(spark):
    texts = ["ABC xyz", "ÀB K İ", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mm.ascii_lower(F.col("text")).alias("t")).collect()
    assert [r["t"] for r in got] == [t and t.translate(LOWER) for t in texts]
