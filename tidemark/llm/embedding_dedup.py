"""Near copies among embeddings: links by cosine found in graphs per shard, and their components.

Equal vectors are one class, weighted by its copies.  Classes are dealt to shards of bounded bytes by a hash, and
each shard gets a navigable small-world graph (``hnsw``).  Every class is looked up in its own shard's graph and
in those of all later shards, so that each pair is met once, in one task.  What a beam finds counts as a link
only after its cosine is verified in double precision.

Before a task looks up its queries it audits the beam: for some of the queries, and for vectors that stand at
the very threshold from some of the shard's, all links are known from a scan; the beam is doubled until RECALL of
them is found.  A query whose beam is filled half with links or more has its beam widened; from EXACT_FROM on it
is compared with the whole shard instead, so that no group is too large to be found whole.

A task returns no pairs: per class the links it found, and a root that joins the classes it found linked (at most
one edge for each).  The edges of all tasks are united by ``components``.

Defined results: one row per input row.  Vectors that are null, zero, or hold null or non-finite components link
with nothing; shorter vectors count as padded with zeros.  Rows are told apart by vector, not by id: an id may
repeat or be null.  A component is named by its smallest id (null if all are null); ``kept`` marks rows whose id
is that one.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.components import components
from tidemark.llm.hnsw import DEGREE, MOST, Graph
from tidemark.llm.registry import query

COSINE = 0.95
SHARDS = 4  # at least
SHARD_BYTES = 32 << 20  # of a shard's vectors in double precision, about
RECALL = 0.99
AUDITS = 128  # of each kind in a task
FIRST_BEAM = 16
EXACT_FROM = 256
SCAN = 256  # queries of a scan at a time
_SLACK = 1e-4  # of products in single precision
_NODE = "shard long, node long, copies long, v array<double>, place int, links binary"
_EDGE = "node long, hits long, root long"


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1; a row is scaled by its largest component first, so that no square overflows."""
    scaled = v / np.abs(v).max(axis=1, keepdims=True, initial=0)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def classes(embeddings: DataFrame) -> DataFrame:
    """v (padded), least id, copies and a number of each distinct vector that can link."""
    wide = F.col("embedding").cast("array<double>")
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists(wide, lambda x: x != 0)
    vectors = embeddings.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), trimmed(wide).alias("v"))
    grouped = vectors.groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    return grouped.withColumn("node", F.monotonically_increasing_id())


def trimmed(v):
    """Without zeros at the end, so that vectors that differ by padding are equal; zeros without a sign."""
    last = F.array_max(F.transform(v, lambda x, i: F.when(x != 0, i + 1).otherwise(0)))
    return F.transform(F.slice(v, F.lit(1), F.coalesce(last, F.lit(0))), lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of doubles as rows, padded with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _build(dims: int):
    def build(rows: pa.Table) -> pa.Table:
        # nodes in an order that has nothing to do with the vectors
        rows = rows.sort_by("node").take(np.random.default_rng(0).permutation(rows.num_rows))
        graph = Graph(unit(_matrix(rows["v"], dims)))
        links = [b"".join(layer[k].tobytes() for layer in graph.layers if k < len(layer)) for k in range(rows.num_rows)]
        made = rows.select(["shard", "node", "copies", "v"]).append_column("place", pa.array(range(rows.num_rows), pa.int32()))
        return made.append_column("links", pa.array(links, pa.binary()))

    return build


def _graph(links: list[bytes], vectors: np.ndarray) -> Graph:
    """The graph of a shard from the links of its nodes: those of the lowest layer, then of each above."""
    layers, start = [], 0
    while links:
        width = (DEGREE if start else MOST) * 4
        layers.append(np.frombuffer(b"".join(x[start : start + width] for x in links), np.int32).reshape(-1, width // 4))
        start += width
        links = [x for x in links if len(x) > start]
    return Graph(vectors, layers)


def scan(queries: np.ndarray, vectors: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, vector) of all products of at least ``least``, some queries at a time."""
    for start in range(0, len(queries), SCAN):
        some = queries[start : start + SCAN]
        near = some @ vectors.T
        at, found = np.nonzero(near >= least - 1e-9)
        border = np.flatnonzero(near[at, found] < least + 1e-9)
        good = np.ones(len(at), bool)
        good[border] = verified(some[at[border]], vectors[found[border]]) >= least
        yield at[good] + start, found[good]


def verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("kd,kd->k", a, b)


def _looked_up(graph: Graph, vectors: np.ndarray, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified (query, vector) from beams wide enough for each query, and the queries that need a scan."""
    open_, found = np.arange(len(queries)), ([], [])
    while len(open_) and beam < EXACT_FROM and beam < len(vectors):
        crowded = []
        for start in range(0, len(open_), 4096):
            some = open_[start : start + 4096]
            ids, sims = graph.search(queries[some], beam)
            maybe = (ids >= 0) & (sims >= least - _SLACK)
            full = 2 * maybe.sum(axis=1) >= beam
            crowded.append(some[full])
            at, column = np.nonzero(maybe & ~full[:, None])
            q, v = some[at], ids[at, column].astype(np.int64)
            good = verified(queries[q], vectors[v]) >= least
            found[0].append(q[good])
            found[1].append(v[good])
        open_, beam = np.concatenate(crowded), beam * 4
    q, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in found)
    return q, v, open_


def audited_beam(graph: Graph, vectors: np.ndarray, queries: np.ndarray, least: float) -> tuple[int, float]:
    """The first beam that finds RECALL of the links of a test set, and what it finds of them."""
    rng = np.random.default_rng(1)
    real = queries[rng.permutation(len(queries))[:AUDITS]]
    near = vectors[rng.permutation(len(vectors))[:AUDITS]]
    side = rng.normal(size=near.shape)
    side -= verified(side, near)[:, None] * near
    length = np.sqrt(verified(side, side))[:, None]
    at_border = np.where(length > 1e-9, near * least + side / np.maximum(length, 1e-9) * np.sqrt(1 - least * least), near)
    tests, border = np.vstack([real, at_border]), least - 1e-9
    codes = lambda pairs: [q.astype(np.int64) * len(vectors) + v for q, v in pairs]
    truth = np.concatenate(codes(scan(tests, vectors, border)))
    beam = FIRST_BEAM
    while True:
        q, v, rest = _looked_up(graph, vectors, tests, border, beam)
        seen = np.concatenate(codes([(q, v), *((rest[a], b) for a, b in scan(tests[rest], vectors, border))]))
        share = float(np.isin(truth, seen).mean()) if len(truth) else 1.0
        if share >= RECALL or beam >= min(EXACT_FROM, len(vectors)):
            return beam, share
        beam *= 2


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked places the same, least label; every label is a place with itself as label."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(jumped := labels[labels], labels):
            labels[:] = jumped


class Found:
    """Links of two sets of vectors, or of one with itself: a weighted count and a label for each vector."""

    def __init__(self, copies: np.ndarray, q_copies: np.ndarray | None):
        self.shift = 0 if q_copies is None else len(copies)  # where the queries' places start
        self.copies = copies if q_copies is None else np.concatenate([copies, q_copies])
        self.hits = np.zeros(len(self.copies), np.int64)
        self.labels = np.arange(len(self.copies))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of places, each once."""
        np.add.at(self.hits, a, self.copies[b])
        np.add.at(self.hits, b, self.copies[a])
        _merge(self.labels, a, b)


def links(graph: Graph, vectors: np.ndarray, copies: np.ndarray, queries: np.ndarray | None, q_copies: np.ndarray | None, least: float) -> Found:
    """All links of a shard's vectors with ``queries``, or with each other where there are none."""
    alone = queries is None
    queries = vectors if alone else queries
    found = Found(copies, None if alone else q_copies)
    beam, _ = audited_beam(graph, vectors, queries, least)
    q, v, rest = _looked_up(graph, vectors, queries, least, beam)
    if not alone:
        found.add(q + found.shift, v)
        for at, v in scan(queries[rest], vectors, least):
            found.add(rest[at] + found.shift, v)
        return found
    # a pair may be found from either end; those of scanned vectors come from their scans
    scanned = np.full(len(vectors), -1, np.int64)
    scanned[rest] = np.arange(len(rest))
    apart = (q != v) & (scanned[q] < 0) & (scanned[v] < 0)
    code = np.unique(np.minimum(q, v)[apart] * len(vectors) + np.maximum(q, v)[apart])
    found.add(code // len(vectors), code % len(vectors))
    for at, v in scan(vectors[rest], vectors, least):
        once = (scanned[v] < 0) | (scanned[v] > at)  # both scanned: counted from the first of them
        found.add(rest[at][once], v[once])
    return found


def _look_up(dims: int, least: float):
    def look_up(key, queries: pa.Table, rows: pa.Table) -> pa.Table:
        none = pa.table({n: pa.array([], pa.int64()) for n in ("node", "hits", "root")})
        if not queries.num_rows or not rows.num_rows:
            return none
        rows = rows.sort_by("place")
        vectors, copies = unit(_matrix(rows["v"], dims)), rows["copies"].to_numpy()
        graph, nodes = _graph(rows["links"].to_pylist(), vectors), rows["node"].to_numpy()
        if key[0].as_py() == key[1].as_py():
            found = links(graph, vectors, copies, None, None, least)
        else:
            queries = queries.sort_by("node")
            found = links(graph, vectors, copies, unit(_matrix(queries["v"], dims)), queries["copies"].to_numpy(), least)
            nodes = np.concatenate([nodes, queries["node"].to_numpy()])
        linked = np.flatnonzero(found.hits)
        columns = nodes[linked], found.hits[linked], nodes[found.labels[linked]]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("node", "hits", "root"), columns, strict=True)})

    return look_up


def class_links(found: DataFrame, least: float = COSINE) -> DataFrame:
    """node, hits (rows of other classes linked to it) and root, from one or more tasks; ``found`` as by ``classes``."""
    size = found.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("v")).alias("dims")).first()
    dims = max(1, size["dims"] or 0)
    shards = max(SHARDS, -(-size["rows"] * dims * 8 // SHARD_BYTES))
    dealt = found.select(F.pmod(F.xxhash64("node"), F.lit(shards)).alias("shard"), "node", "copies", "v")
    graphs = stored(dealt.groupBy("shard").applyInArrow(_build(dims), _NODE), "graphs")
    first, last = F.lit(0).cast("long"), F.lit(shards - 1).cast("long")
    to_graph = graphs.withColumn("asked", F.explode(F.sequence(first, F.col("shard"))))
    asking = dealt.where(F.col("shard") < last).withColumn("graph", F.explode(F.sequence(F.col("shard") + 1, last)))
    # a shard with itself needs its rows once
    itself = dealt.groupBy("shard").agg(F.min("node").alias("node")).select("shard", "node", F.lit(1).cast("long").alias("copies"), F.array().cast("array<double>").alias("v"), F.col("shard").alias("graph"))
    queries = asking.unionByName(itself)
    both = queries.groupBy("shard", "graph").cogroup(to_graph.groupBy("asked", "shard"))
    return both.applyInArrow(_look_up(dims, least), _EDGE)


def near_copies(embeddings: DataFrame, least: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    found = stored(classes(embeddings), "vector-classes")
    edges = stored(class_links(found, least), "vector-links")
    hits = edges.groupBy("node").agg(F.sum("hits").alias("hits"))
    joined = components(edges.where("node <> root"), "node", "root")
    named = found.join(hits, "node", "left").join(joined, "node", "left").select(
        "v", "least", (F.coalesce("hits", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")
    )
    named = stored(named.where("n_links > 0"), "vector-components")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select("v", "n_links", "component_id")
    wide = trimmed(F.col("embedding").cast("array<double>"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("v"))
    whole = rows.join(named, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return whole.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query()
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "embeddings"))
