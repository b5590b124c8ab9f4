"""Jaccard similarity join on word shingles by prefixes of token combinations.

Documents with equal shingle sets form one class; classes are joined. Tokens (64-bit hashes of shingles)
are ordered rare ones first: frequent tokens, which more than ``FREQUENT`` classes hold among their first
tokens, come last. Two sets of the wanted similarity must share much of what comes first, so a class is
indexed by a prefix only: by single rare tokens, and by pairs of frequent ones. Frequent tokens are
dealt into groups by hash, as many as suit the set's size; n common tokens of a group are only lost
by removing n - 1 of them, so the prefix is extended until

    rare tokens + sum over groups of (frequent tokens - 1)  >=  size - least overlap + 1.

Every pair of similar sets then shares a rare token or a pair. Links are verified with the whole sets.
Classes that share an entry are first compared with one of them, in ``STAR_ROUNDS`` rounds with other
centres; what that links is a component. Then every pair from different components that shares an entry
is compared, unless sketches of the sets rule it out, so that groups of copies never meet pairwise.
No list of partners is capped; which tokens count as frequent changes the cost, not the result.

Defined results: texts that are null or without words have no shingles and are linked with nothing.
Rows with equal words are one class whatever their ids; repeated ids and rows are kept. A component's
id is its smallest known document id; a row alone has its own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import discard, map_rows, stored, table
from tidemark.llm.components import components
from tidemark.llm.registry import query

# What op10 asks for; callers may give others.
WORDS = 3
SHARE = (90, 100)  # 100 * intersection >= 90 * union
FREQUENT = 16  # classes
FREQUENT_TOKENS = 1_000_000  # kept as frequent at most: the most frequent ones
SKETCH_BITS = (512, 8192)  # of sets of fewer than LARGE_SET tokens, and of larger ones
LARGE_SET = 1500
BROADCAST_ROWS = 1_000_000  # ids sent to every task at most; beyond, rows are shuffled

STAR_ROUNDS = 4
CENTRE_ORDERS = 4

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; A-Z lower-cased, words split at ASCII white space."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), seed=len(found))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    total = np.zeros(len(found) - words + 1, np.uint64)
    for k in range(words):
        total = _mixed((total + hashed[k : k + len(total)]) * _MIX[k % len(_MIX)])
    return np.unique(total)


def least_overlap(size: int, share: tuple[int, int] = SHARE) -> int:
    return -(-size * share[0] // share[1])


def needed(size: int, share: tuple[int, int] = SHARE) -> int:
    """Tokens of a prefix of which two similar sets must share one."""
    return size - least_overlap(size, share) + 1


def linkable(size: int, share: tuple[int, int] = SHARE) -> bool:
    """Whether a different set can be similar at all: it would have to hold one token more."""
    return share[1] * size >= share[0] * (size + 1)


def first_tokens(tokens: np.ndarray, share: tuple[int, int] = SHARE) -> np.ndarray:
    """The tokens in which frequency is counted and prefixes are looked for first."""
    return tokens[: 2 * needed(len(tokens), share) + 8] if linkable(len(tokens), share) else tokens[:0]


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity of the tokens dealt into cells: two sets with as many cells differ in at least as many tokens as cells."""
    bits = SKETCH_BITS[len(tokens) >= LARGE_SET]
    cells = np.bincount((_mixed(tokens * _MIX[2]) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def _step(share: tuple[int, int]) -> float:
    """Logarithm of the ratio of sizes from one class to the next, which is wider than ``share``."""
    return -np.log(share[0] / share[1] - 0.01)


def size_class(size: int, share: tuple[int, int] = SHARE) -> int:
    """Sets of the wanted similarity are in the same class or in neighbouring ones."""
    return int(np.floor(np.log(size) / _step(share)))


def groups_of(size_class_: int, share: tuple[int, int] = SHARE) -> int:
    """Groups that the frequent tokens of sets of a size class are dealt into."""
    return max(1, int(needed(int(np.exp(_step(share) * (size_class_ + 1))), share) / 1.2))


def _pairs(frequent: np.ndarray, groups: int, lack: int, salt: int) -> np.ndarray | None:
    """Entries for pairs of frequent tokens, taken in order until the groups make up for ``lack``."""
    group = (_mixed(frequent) % np.uint64(groups)).astype(np.int64)
    seen, gain, end = set(), 0, len(frequent)
    for k, g in enumerate(group.tolist()):
        if g in seen:
            gain += 1
            if gain >= lack:
                end = k + 1
                break
        seen.add(g)
    if gain < lack:
        return None
    out = []
    order = np.argsort(group[:end], kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    for a, b in zip(starts, [*starts[1:], end], strict=True):
        some = frequent[order[a:b]]
        i, j = np.triu_indices(len(some), 1)
        out.append(_mixed(some[i] * _MIX[0] + _mixed(some[j] + np.uint64(salt))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def entries(tokens: np.ndarray, size: int, frequent: np.ndarray, share: tuple[int, int] = SHARE) -> np.ndarray | None:
    """Index entries of a set of ``size`` by its first ``tokens``; None if these do not suffice.

    ``frequent`` is sorted. With all tokens given there is always an answer.
    """
    if not linkable(size, share):
        return np.zeros(0, np.uint64)
    want = needed(size, share)
    at = np.searchsorted(frequent, tokens)
    often = np.zeros(len(tokens), bool) if not len(frequent) else frequent[np.minimum(at, len(frequent) - 1)] == tokens
    rare = tokens[~often]
    if len(rare) >= want:
        return rare[:want]
    if len(tokens) < size:
        return None
    out = [rare]
    own = size_class(size, share)
    for c in (own, own + 1):
        out.append(_pairs(tokens[often], groups_of(c, share), want - len(rare), c + 1))
    return None if any(x is None for x in out) else np.concatenate(out)


def _signed(x: np.ndarray) -> list[int]:
    return x.view(np.int64).tolist()


def _key(tokens: np.ndarray) -> tuple[int, int]:
    high, low = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), "<i8").tolist()
    return high, low


def sets(documents: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """One row per document: row, doc_id, text_hash, k1 and k2 (key of its set), n, first (its first tokens), sketch."""

    def made(ids, hashes, texts):
        found = [shingles(t, words) for t in texts]
        keys = [_key(x) for x in found]
        return {
            "doc_id": ids,
            "text_hash": hashes,
            "k1": [k[0] for k in keys],
            "k2": [k[1] for k in keys],
            "n": [len(x) for x in found],
            "first": [_signed(first_tokens(x, share)) for x in found],
            "sketch": [sketch(x).tolist() for x in found],
        }

    schema = "doc_id long, text_hash long, k1 long, k2 long, n long, first array<long>, sketch array<long>"
    held = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    made_sets = map_rows(held, made, schema, "doc_id", "text_hash", "text")
    return stored(made_sets.withColumn("row", F.monotonically_increasing_id()), "shingles")


def _only(frame: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``frame`` with a key in ``ids``, nulls equal; the keys are broadcast if they are few."""
    few = ids.count() <= BROADCAST_ROWS
    wanted = ids.select(*(F.col(c).alias(f"_{c}") for c in on)).distinct()
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return frame.join(F.broadcast(wanted) if few else wanted, same, "left_semi")


def whole_sets(documents: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """cls, n, tokens (64-bit, packed) of the given classes, made again from their texts."""

    def made(texts):
        found = [shingles(t, words) for t in texts]
        keys = [_key(x) for x in found]
        return {"k1": [k[0] for k in keys], "k2": [k[1] for k in keys], "tokens": [x.tobytes() for x in found]}

    texts = _only(documents.select("doc_id", "text"), classes, ["doc_id"])
    again = map_rows(texts, made, "k1 long, k2 long, tokens binary", "text")
    keys = classes.select("cls", "n", "k1", "k2")
    keys = F.broadcast(keys) if classes.count() <= BROADCAST_ROWS else keys
    return again.join(keys, ["k1", "k2"]).dropDuplicates(["cls"]).select("cls", "n", "tokens")


def frequent_tokens(first: DataFrame) -> np.ndarray:
    """Tokens held by more than ``FREQUENT`` classes among their first ones, sorted."""
    counted = first.select(F.explode("first").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("classes"))
    often = counted.where(F.col("classes") > FREQUENT).orderBy(F.desc("classes"), "token").limit(FREQUENT_TOKENS)
    return np.sort(often.select("token").toArrow()["token"].to_numpy().astype(np.int64).view(np.uint64))


def index(documents: DataFrame, classes: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """entry, cls, n: what every class is found by."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(frequent_tokens(classes))

    def by_first(cls, n, first):
        found = [entries(np.array(f, np.int64).view(np.uint64), size, shared.value, share) for f, size in zip(first, n, strict=True)]
        return {"cls": cls, "n": n, "entries": [None if x is None else _signed(x) for x in found]}

    def by_all(cls, n, tokens):
        found = [entries(np.frombuffer(t, np.uint64), size, shared.value, share) for t, size in zip(tokens, n, strict=True)]
        return {"cls": cls, "n": n, "entries": [_signed(x) for x in found]}

    schema = "cls long, n long, entries array<long>"
    tried = stored(map_rows(classes, by_first, schema, "cls", "n", "first"), "entries")
    lacking = classes.join(tried.where("entries IS NULL").select("cls"), "cls", "left_semi")
    lacking = stored(lacking.drop("first", "sketch"), "lacking")
    rest = map_rows(whole_sets(documents, lacking, words), by_all, schema, "cls", "n", "tokens")
    flat = tried.where("entries IS NOT NULL").unionByName(rest)
    made = stored(flat.select("cls", "n", F.explode(F.array_distinct("entries")).alias("entry")), "index")
    discard(tried, lacking)
    return made


def _similar_sizes(a: str, b: str, share: tuple[int, int]) -> Column:
    return F.lit(share[1]) * F.least(a, b) >= F.lit(share[0]) * F.greatest(a, b)


def _differing_cells(a: str, b: str, longs: int) -> Column:
    """Cells in which two sketches differ, over their first ``longs`` numbers; 0 if they have not as many cells."""
    apart = sum((F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(longs)), F.lit(0))
    return F.when(F.size(a) == F.size(b), apart).otherwise(0)


def _may_be_similar(cells: Column, an: str, bn: str, share: tuple[int, int]) -> Column:
    """Whether sets of two sizes, whose sketches differ in so many cells, may be similar; true for every link."""
    both = F.col(an) + F.col(bn)
    # whole numbers: the least overlap, rounded up
    least = F.floor((both * share[0] + (share[0] + share[1] - 1)) / F.lit(share[0] + share[1]))
    return _similar_sizes(an, bn, share) & (cells <= both - 2 * least)


def _by_sketch(classes: DataFrame, pairs: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Pairs that whole sketches do not rule out."""
    for side in ("a", "b"):
        known = classes.select(F.col("cls").alias(side), F.col("n").alias(f"{side}n"), F.col("sketch").alias(f"{side}s"))
        pairs = pairs.join(known, side)
    longs = F.when(F.size("as") > SKETCH_BITS[0] // 64, F.aggregate(
        F.zip_with("as", "bs", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x
    )).otherwise(_differing_cells("as", "bs", SKETCH_BITS[0] // 64))
    cells = F.when(F.size("as") == F.size("bs"), longs).otherwise(0)
    return pairs.where(_may_be_similar(cells, "an", "bn", share)).select("a", "b")


def verified(documents: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """Pairs a, b of classes whose whole sets are similar."""
    pairs = stored(_by_sketch(classes, pairs, share), "candidates")
    involved = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    wanted = stored(classes.join(involved, "cls", "left_semi").drop("first", "sketch"), "involved")
    held = stored(whole_sets(documents, wanted, words).select("cls", "tokens"), "whole-sets")
    left = held.select(F.col("cls").alias("a"), F.col("tokens").alias("left"))
    right = held.select(F.col("cls").alias("b"), F.col("tokens").alias("right"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")

    def similar(a, b, left, right):
        keep = []
        for x, y in zip(left, right, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(share[1] * common >= share[0] * (len(x) + len(y) - common))
        return {"a": [v for v, k in zip(a, keep, strict=True) if k], "b": [v for v, k in zip(b, keep, strict=True) if k]}

    links = stored(map_rows(both, similar, "a long, b long", "a", "b", "left", "right"), "links")
    discard(pairs, wanted, held)
    return links


def _with_component(frame: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """``frame`` with the component of ``column``; a class without a link is its own."""
    known = found.withColumnRenamed("node", column)
    return frame.join(known, column, "left").withColumn("component", F.coalesce("component", column))


def _unsettled(held: DataFrame, found: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """Entries (with component, and what ``classes`` add) that classes of several components share; replaces ``held``."""
    placed = stored(_with_component(held.select("entry", "cls", "n"), found, "cls"), "placed-entries")
    mixed = placed.groupBy("entry").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ = placed.join(mixed.select("entry"), "entry", "left_semi")
    open_ = stored(open_ if classes is None else open_.join(classes, "cls"), "shared-entries")
    discard(placed, held)
    return open_


def _stars(held: DataFrame, turn: int, share: tuple[int, int]) -> DataFrame:
    """Pairs of each class with the centre of an entry they share, where they are of different components.

    Centres are the least classes in one of ``CENTRE_ORDERS`` orders, so that a group has few of them.
    """
    order = F.pmod(F.xxhash64("entry"), F.lit(CENTRE_ORDERS)) if turn else F.lit(0)
    ranked = held.withColumn("by", F.xxhash64("cls", order, F.lit(turn)) if turn else F.col("cls"))
    centre = ranked.groupBy("entry").agg(F.min(F.struct("by", "cls", "n", "component")).alias("c"))
    pairs = held.join(centre, "entry").where("component <> c.component").where(_similar_sizes("n", "c.n", share))
    return pairs.select(F.greatest("cls", "c.cls").alias("a"), F.least("cls", "c.cls").alias("b")).distinct()


def linked_classes(documents: DataFrame, classes: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """node, component of every class that is linked with another."""
    spark = documents.sparkSession
    found = spark.createDataFrame([], "node long, component long")
    links = spark.createDataFrame([], "a long, b long")
    held = index(documents, classes, words, share)
    tried = None
    for turn in range(STAR_ROUNDS):
        if not turn:
            shared = held.groupBy("entry").agg(F.count(F.lit(1)).alias("held")).where("held > 1").select("entry")
            # entries of a single class fall away here
            open_ = stored(held.join(shared, "entry", "left_semi").withColumn("component", F.col("cls")), "shared-entries")
            discard(held)
        else:
            open_ = _unsettled(open_, found)
        pairs = _stars(open_, turn, share)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "stars")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = stored(links.unionByName(verified(documents, classes, pairs, words, share)), "links")
        found = components(links, "a", "b")
    known = classes.select("cls", F.slice("sketch", 1, SKETCH_BITS[0] // 64).alias("s"), F.size("sketch").alias("z"))
    open_ = _unsettled(open_, found, known)
    other = open_.select("entry", *(F.col(c).alias(f"{c}2") for c in ("cls", "n", "component", "s", "z")))
    # every pair that is still open is compared, by its sketch first
    cells = F.when(F.col("z") == F.col("z2"), _differing_cells("s", "s2", SKETCH_BITS[0] // 64)).otherwise(0)
    meet = (open_["entry"] == other["entry"]) & (F.col("cls") > F.col("cls2")) & (F.col("component") != F.col("component2"))
    rest = open_.join(other, meet & _may_be_similar(cells, "n", "n2", share)).select(F.col("cls").alias("a"), F.col("cls2").alias("b"))
    rest = rest.distinct().join(tried, ["a", "b"], "left_anti")
    more = verified(documents, classes, rest, words, share)
    return components(links.unionByName(more), "a", "b")


def join(documents: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """doc_id, row, text_hash, n_shingles, component_id and component (a class of it; null without words) of every document."""
    rows = sets(documents, words, share)
    groups = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("row").alias("cls"), F.min("doc_id").alias("least_id"))
    members = stored(rows.drop("first", "sketch").join(groups, ["k1", "k2"], "left"), "members")
    reps = members.where("row = cls").select("cls")
    classes = stored(
        _only(rows.withColumn("cls", F.col("row")), reps, ["cls"]).select(
            "cls", "doc_id", "k1", "k2", "n", "first", "sketch"
        ),
        "classes",
    )
    discard(rows)
    found = linked_classes(documents, classes, words, share)
    placed = _with_component(members.where("n > 0").select("cls", "least_id").distinct(), found, "cls")
    ids = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = placed.select("cls", "component").join(ids, "component").select("cls", "component", "component_id")
    whole = members.select("doc_id", "row", "text_hash", "n", "cls").join(named, "cls", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return whole.select("doc_id", "row", "text_hash", F.col("n").alias("n_shingles"), own.alias("component_id"), "component")


def one_of_each(documents: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """``documents`` with one document of every component: the first row with the least known id. Rows without words all stay.

    Components are told apart by their classes, so null and repeated ids lose none. Rows with equal ids and texts are one.
    """
    found = stored(join(documents, words, share), "components")
    same_rows = ["component", "doc_id", "text_hash"]
    distinct = found.where("n_shingles > 0").groupBy(*same_rows).agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("rows"))
    head = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "text_hash", "rows")).alias("head")
    heads = stored(distinct.groupBy("component").agg(head).select("head.doc_id", "head.text_hash", "head.rows"), "heads")
    repeated = heads.where("rows > 1").count() > 0
    kept = heads.select("doc_id", "text_hash").unionByName(found.where("n_shingles = 0").select("doc_id", "text_hash"))
    wanted = kept.select(F.col("doc_id").alias("__kept_id"), F.col("text_hash").alias("__kept_hash")).distinct()
    few = wanted.count() <= BROADCAST_ROWS
    same = F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.xxhash64("text") == F.col("__kept_hash"))
    held = documents.join(F.broadcast(wanted) if few else wanted, same, "left_semi")
    if not repeated:
        return held
    held = stored(held.withColumn("__row", F.monotonically_increasing_id()), "repeated-rows")
    wordless = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) == ""
    own = F.when(wordless, F.col("__row"))
    first = held.groupBy("doc_id", F.xxhash64("text").alias("__hash"), own.alias("__own")).agg(F.min("__row").alias("__row"))
    return held.join(first.select("__row"), "__row", "left_semi").drop("__row")


@query()
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
