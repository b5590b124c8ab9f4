"""A Merkle manifest of a table: a leaf per row, a tree per source, one root, and a proof for every row.

Leaves of a source ascend by id.  Every ``FAN`` consecutive nodes become the hash of their joined digests,
until one is left, the source's subroot; the subroots, ordered by source, likewise give the root.

Digests are text of ``WIDTH`` characters.  An aligned block of FAN * FAN consecutive nodes is one row that
keeps each of its levels as one string: substrings of fixed width are hashed to the level above, and what
stands left and right of a node within its run are its siblings.  A block's top node is a node of the next
pass, so each pass has 256 times fewer.  What lies above a block is joined to the block, not to its rows.

Places come from rows sorted by range and counts by range, so that a source may hold any share of the rows.

Defined results: rows are kept whatever they hold.  A null value is ``-`` in a leaf, any other its byte count,
a colon and itself.  Null sources form one tree, the first.  Null ids come first in their source and are never
tampered with; rows of one id follow each other by leaf.  An empty table gives no rows.  Other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.registry import query

FAN = 16
WIDTH = 64  # characters of a digest
BLOCK = FAN * FAN  # nodes of a block, which has two levels
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _written(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The leaf of a row, with some columns' values exchanged."""
    return digest(*(_written(changed.get(name, F.col(name))) for name in FIELDS))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def numbered(frame: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``frame`` with ``at``, the place of each row in its group, and ``nodes``, the rows of the group.

    Rows are dealt by ranges of (group, order) and counted by range; equal rows spread by where they were read.
    """
    first = [F.col(g).asc_nulls_first() for g in group]
    spread = frame.withColumn("spread", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*first, *order, F.col("spread").asc())
    kept = stored(ranged.withColumn("range", F.spark_partition_id()), "merkle-ranges")
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy(*group, "range").agg(F.count(F.lit(1)).alias("rows")).select(
        F.col("range").alias("its_range"),
        *(F.col(g).alias(f"its_{g}") for g in group),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(whole).alias("nodes"),
    )
    own = Window.partitionBy(*group, "range").orderBy(*order, "spread")
    placed = kept.withColumn("own", F.row_number().over(own) - 1)
    joined = placed.join(starts, _same(group) & (F.col("range") == F.col("its_range")))
    return joined.withColumn("at", F.col("own") + F.col("start")).select(*frame.columns, "at", "nodes")


def _same(group: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"its_{g}")) for g in group), F.lit(True))


def _runs(level: Column, nodes: Column) -> Column:
    """A level's string cut into runs of FAN digests."""
    starts = F.sequence(F.lit(0), F.floor((nodes - 1) / FAN).cast("int"))
    return F.transform(starts, lambda k: F.substring(level, k * (FAN * WIDTH) + 1, F.lit(FAN * WIDTH)))


def _level_above(runs: Column) -> Column:
    return F.array_join(F.transform(runs, lambda run: F.sha2(run.cast("binary"), 256)), "")


def _flanks(run: Column, k: Column) -> Column:
    """What stands left and right of the run's digest number ``k``."""
    left = F.substring(run, F.lit(1), k * WIDTH)
    right = F.substring(run, (k + 1) * WIDTH + 1, F.lit(FAN * WIDTH))
    return F.struct(left.alias("left"), right.alias("right"))


def _blocks(nodes: DataFrame, group: list[str]) -> DataFrame:
    """One row per block: rows (at, carried) in order, low and high (its levels), top (the node above them).

    A group of one node has no level, one of up to FAN nodes one, every other both.
    """
    one = F.struct("at", "hash", "carried")
    gathered = nodes.groupBy(*group, F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(one)).alias("rows"), F.max("nodes").alias("nodes")
    )
    low = gathered.withColumn("low", F.array_join("rows.hash", "")).withColumn(
        "rows", F.transform("rows", lambda row: F.struct(row["at"].alias("at"), row["carried"].alias("carried")))
    )
    high = low.withColumn("high", F.when(F.col("nodes") > 1, _level_above(_runs(F.col("low"), F.size("rows")))))
    top = (
        F.when(F.col("nodes") == 1, F.col("low"))
        .when(F.col("nodes") <= FAN, F.col("high"))
        .otherwise(F.sha2(F.col("high").cast("binary"), 256))
    )
    return high.withColumn("top", top)


def _rows(blocks: DataFrame, group: list[str]) -> DataFrame:
    """The nodes of all blocks again, each with its siblings in the block, then those ``above``."""
    cut = blocks.withColumn("runs", _runs(F.col("low"), F.size("rows")))

    def opened(row: Column) -> Column:
        k = (row["at"] % BLOCK).cast("int")
        run, inside = F.get("runs", F.floor(k / FAN).cast("int")), k % FAN
        first, second = _flanks(run, inside), _flanks(F.col("high"), F.floor(k / FAN).cast("int"))
        steps = F.when(F.col("nodes") == 1, F.array().cast(_PATH)).when(F.col("nodes") <= FAN, F.array(first))
        return F.struct(
            row["at"].alias("at"),
            row["carried"].alias("carried"),
            F.substring(run, inside * WIDTH + 1, F.lit(WIDTH)).alias("hash"),
            F.concat(steps.otherwise(F.array(first, second)), F.col("above")).alias("path"),
        )

    return cut.select(*group, F.explode(F.transform("rows", opened)).alias("row")).select(*group, "row.*")


def trees(nodes: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
    """The root of every group (group, hash), and every node with its siblings by level (group, carried, hash, path).

    ``nodes`` has the columns of ``group``, at, nodes, hash and carried (anything that goes with a node).
    """
    kind = nodes.schema["carried"].dataType
    passes, now = [], nodes
    while True:
        kept = stored(_blocks(now, group), "merkle-blocks")
        passes.append(kept)
        if (kept.agg(F.max("nodes").alias("most")).first()["most"] or 0) <= BLOCK:
            break
        tops = F.ceil(F.col("nodes") / BLOCK)
        now = kept.select(
            *group, F.col("block").alias("at"), tops.alias("nodes"), F.col("top").alias("hash"), F.lit(None).cast(kind).alias("carried")
        )
    top, *lower = reversed(passes)
    found = _rows(top.withColumn("above", F.array().cast(_PATH)), group)
    for kept in lower:
        above = found.select(*(F.col(g).alias(f"its_{g}") for g in group), F.col("at").alias("its_block"), F.col("path").alias("above"))
        found = _rows(kept.join(above, _same(group) & (F.col("block") == F.col("its_block"))), group)
    return top.select(*group, F.col("top").alias("hash")), found.select(*group, "carried", "hash", "path")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def joined_siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(leaves: DataFrame) -> DataFrame:
    """carried, leaf, subroot, root and path: a leaf's siblings left and right by level, up to the root.

    ``leaves`` has source, doc_id, leaf and carried (anything that goes with a leaf).
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    placed = numbered(leaves.select("source", "doc_id", "leaf", "carried"), ["source"], order)
    subroots, paths = trees(placed.withColumnRenamed("leaf", "hash"), ["source"])
    nodes = subroots.select(F.col("source").alias("carried"), "hash")
    roots, tops = trees(numbered(nodes, [], [F.col("carried").asc_nulls_first()]), [])
    root = roots.first()
    above = tops.select(F.col("carried").alias("its_source"), F.col("hash").alias("subroot"), F.col("path").alias("above"))
    joined = paths.join(above, _same(["source"]))
    return joined.select(
        "carried", F.col("hash").alias("leaf"), "subroot", F.lit(root and root["hash"]).cast("string").alias("root"), F.concat("path", "above").alias("path")
    )


def tampered() -> Column:
    """Where 5 divides the checksum of the id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


@query(
    """
WITH RECURSIVE coded AS (
    SELECT *, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)))) AS c
    FROM documents
), fields AS (
    SELECT doc_id, source, text,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        CASE WHEN xor(c, 4294967295) % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS bent
    FROM coded
), leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(strlen(bent) || ':' || bent, '-')) AS start,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place
    FROM fields
), levels AS (
    SELECT source, 0 AS level, place, leaf AS hash FROM leaves
    UNION ALL
    SELECT source, any_value(level) + 1, place // 16, sha256(string_agg(hash, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM levels) WHERE n > 1 GROUP BY source, place // 16
), heights AS (
    SELECT source, max(level) AS height FROM levels GROUP BY source
), subroots AS (
    SELECT l.source, l.hash AS subroot, height, row_number() OVER (ORDER BY l.source NULLS FIRST) - 1 AS place
    FROM levels l JOIN heights h ON l.source IS NOT DISTINCT FROM h.source AND l.level = h.height
), tops AS (
    SELECT 0 AS level, place, subroot AS hash FROM subroots
    UNION ALL
    SELECT any_value(level) + 1, place // 16, sha256(string_agg(hash, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY place // 16
), runs AS (
    SELECT source, level, place // 16 AS run, list(hash ORDER BY place) AS hashes FROM levels GROUP BY source, level, place // 16
), top_runs AS (
    SELECT level, place // 16 AS run, list(hash ORDER BY place) AS hashes FROM tops GROUP BY level, place // 16
), steps AS (
    SELECT l.doc_id, h.level, l.place // CAST(pow(16, h.level) AS BIGINT) % 16 AS k, r.hashes
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
    JOIN (SELECT DISTINCT source, level FROM levels) h ON l.source IS NOT DISTINCT FROM h.source AND h.level < s.height
    JOIN runs r ON r.source IS NOT DISTINCT FROM l.source AND r.level = h.level AND r.run = l.place // CAST(pow(16, h.level + 1) AS BIGINT)
    UNION ALL
    SELECT l.doc_id, s.height + r.level, s.place // CAST(pow(16, r.level) AS BIGINT) % 16, r.hashes
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
    JOIN top_runs r ON r.run = s.place // CAST(pow(16, r.level + 1) AS BIGINT) AND r.level < (SELECT max(level) FROM tops)
), flanks AS (
    SELECT doc_id, list(struct_pack(l := array_to_string(hashes[1:k], ''), r := array_to_string(hashes[k + 2:], '')) ORDER BY level) AS path
    FROM steps GROUP BY doc_id
), whole AS (
    SELECT l.doc_id, l.leaf, s.subroot, t.hash AS root, l.start, coalesce(f.path, []) AS path
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
    JOIN tops t ON t.level = (SELECT max(level) FROM tops) LEFT JOIN flanks f ON f.doc_id = l.doc_id
), folds AS (
    SELECT doc_id, 0 AS step, start AS node, path FROM whole
    UNION ALL
    SELECT doc_id, step + 1, sha256(path[step + 1].l || node || path[step + 1].r), path FROM folds WHERE step < len(path)
)
SELECT w.doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(w.path, lambda x: x.l || x.r), '')) AS proof_sha256,
    f.node AS folded_root, f.node = root AS verified
FROM whole w JOIN folds f ON w.doc_id = f.doc_id AND f.step = len(w.path)
"""
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    bent = F.when(tampered(), leaf(text=ascii_lower(F.col("text"))))
    carried = F.struct(F.col("doc_id"), bent.alias("bent"))
    found = manifest(docs.select("source", "doc_id", leaf().alias("leaf"), carried.alias("carried")))
    start = F.coalesce(F.col("carried.bent"), F.col("leaf"))
    shown = found.select(
        F.col("carried.doc_id").alias("doc_id"), "leaf", "subroot", "root",
        digest(joined_siblings(F.col("path"))).alias("proof_sha256"), folded(start, F.col("path")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
