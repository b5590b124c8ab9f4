"""Benchmark decontamination by canonical templates: finds items also where their values were changed.

Numbers, names and units of a text are replaced by typed placeholders, which gives its template:
a run of digits is a number, a capitalised word (or several in a row) that does not begin a sentence is
a name, a unit word after a number is a unit; all other words are lower-cased. Windows of ``WORDS``
template words of items and documents are joined by hash, then compared word by word. The values that
stand in the slots must agree: within a document each value of an item is read as its most frequent
counterpart, and a window counts if all its slots follow that reading. An item is found in a document if
``SHARE`` of its windows count. Windows with fewer than ``LITERALS`` ordinary words are no evidence.

Every stretch of the document of about half the item's length is also read by itself, so that several copies
with different values do not hide each other; the best stretch counts. Windows that are the item's word by word
always count. A second template is compared as well, in which words that begin a sentence are names, unless they
are ordinary (``STARTERS``) and differ, and number words are numbers.

Items of ``SHORT`` to ``WORDS`` - 1 words are looked for as they are, whole and word by word.

Only DataFrame functions. Every document is read whole, once for the windows; documents with
candidates are read again for their values.

Defined results: null or short texts have no windows; items with fewer than ``SHORT`` words, or longer ones
without windows of ordinary words, are not looked for. Rows with the same id and text are one document; rows of one id with different texts are
judged apart. Null ids are kept. Items that repeat are each found. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.registry import query

WORDS = 5
SHARE = 0.8
LITERALS = 2
SHORT = 3
BROADCAST_ROWS = 1_000_000  # windows of items sent to every task at most; beyond, windows are shuffled

# Words that are read as units after a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs oz"
    " ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month"
    " months year years mph kmh c f k degree degrees percent dollar dollars cent cents euro euros pound pounds hz khz mhz"
    " ghz w kw mw v a j kj cal kcal kb mb gb tb bit bits byte bytes"
).split()

# Words that often begin a sentence and are nobody's name.
STARTERS = (
    "a about after all also an and another any are as at because before both but by can could did do does during each"
    " either every few find finally first for from given had has have he her here his how however i if in instead is it"
    " its last later let many more most my next no not now of on once one only or other our out over she should since"
    " so some soon still such than that the their them then there these they this those though through thus to today"
    " together tomorrow two under until was we were what when where whether which while who whose why will with would"
    " yesterday yet you your"
).split()
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()

_SENTENCE = r"(^|[.!?\n]\s*)(\p{Lu})"
_WORD = r"\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)+|~?\p{L}+|[0-9]+(?:[.,][0-9]+)*"
# The same for Java: a repeated group that may give words back calls itself for each, and long runs overflow the stack.
_JAVA_WORD = r"\p{Lu}\p{L}*(?: \p{Lu}\p{L}*)++|~?\p{L}+|[0-9]+(?:[.,][0-9]+)*+"


def raw_words(text: Column) -> Column:
    """Words, numbers and runs of capitalised words; ``~`` marks a word that begins a sentence."""
    return F.regexp_extract_all(F.regexp_replace(text, _SENTENCE, "$1~$2"), F.lit(_JAVA_WORD), F.lit(0))


def _canonical(wide: Column) -> Callable[[Column, Column], Column]:
    """What stands in a template for a word that follows another one; one rule for both, so that it is compiled once."""

    def canonical(word: Column, before: Column) -> Column:
        low, first = F.lower(word), F.substring(word, 1, 1)
        plain, plain_before = F.ltrim(low, F.lit("~")), F.ltrim(F.lower(before), F.lit("~"))
        is_number = first.between("0", "9") | (wide & plain.isin(NUMBERS))
        follows_number = F.coalesce(before.substr(1, 1).between("0", "9") | (wide & plain_before.isin(NUMBERS)), F.lit(False))
        return (
            F.when(is_number, F.lit("#num"))
            .when(follows_number & low.isin(UNITS), F.lit("#unit"))
            .when((wide & (first == "~")) | (first != F.substring(low, 1, 1)), F.lit("#name"))
            .otherwise(plain)
        )

    return canonical


def template(words: Column, wide: bool = False) -> Column:
    """The words with values replaced by ``#num``, ``#name`` and ``#unit``.

    ``wide`` takes words that begin a sentence for names, and number words for numbers.
    """
    canonical = _canonical(F.lit(wide))
    return F.transform(words, lambda word, at: canonical(word, F.get(words, at - 1)))


def window_hash(hashes: Callable[[int], Column]) -> Column:
    """One number for a window from those of its words."""
    return F.xxhash64(*(hashes(k) for k in range(WORDS)))


def window_words(raw: Column) -> Column:
    """For each word the one before it (``before``) and itself with those after it (``w0`` and on), NULL beyond the end.

    Read row by row: functions over the elements of an array are not compiled, those over columns are.
    """
    before = F.concat(F.array(F.lit(None).cast("string")), raw)
    after = (raw if k == 0 else F.slice(raw, k + 1, 1 << 30) for k in range(WORDS))
    return F.arrays_zip(before.alias("before"), *(w.alias(f"w{k}") for k, w in enumerate(after)))


def word_hashes(words: Column, wide: Column) -> Callable[[int], Column]:
    """The hash of what stands in the template for a word of a window, by its place there."""
    canonical = _canonical(wide)
    return lambda k: F.xxhash64(canonical(words[f"w{k}"], words[f"w{k - 1}" if k else "before"]))


def pair_hash(hashes: Callable[[int], Column]) -> Column:
    """One number for a window's first two words."""
    return F.xxhash64(hashes(0), hashes(1))


def document_windows(raw: Column) -> tuple[Column, Callable[[Column], Column]]:
    """The words of each window, and from these, at and the distinct hashes of both templates of every window."""

    def windows(words: Column) -> Column:
        of = lambda w: F.array_distinct(F.array(*(window_hash(word_hashes(w, F.lit(wide))) for wide in (False, True))))
        placed = F.transform(words, lambda w, at: F.struct(at.alias("at"), w[f"w{WORDS - 1}"].isNotNull().alias("whole"), of(w).alias("hashes")))
        return F.filter(placed, lambda w: w["whole"])

    return window_words(raw), windows


def window_hits(worded: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_hash, at and hash of the windows of documents that an item has, in either template.

    By their first two words most windows of documents are no item's; only the others are hashed whole.
    """
    placed = worded.select("doc_id", "text_hash", F.posexplode(window_words(F.col("raw"))).alias("at", "words"))
    placed = placed.where(F.col(f"words.w{WORDS - 1}").isNotNull())
    templates = F.array(F.lit(False), F.lit(True))
    pairs = items.select(pair_hash(lambda k: F.xxhash64(F.get("canon", F.lit(k)))).alias("pair")).distinct()
    if pairs.count() <= BROADCAST_ROWS:
        for name, wide in (("narrow", False), ("wide", True)):
            paired = placed.withColumn("pair", pair_hash(word_hashes(F.col("words"), F.lit(wide))))
            met = F.broadcast(pairs.withColumn(name, F.lit(wide)))
            placed = paired.join(met, "pair", "left").drop("pair")
        placed = placed.where(F.col("narrow").isNotNull() | F.col("wide").isNotNull())
        templates = F.filter(F.array("narrow", "wide"), lambda met: met.isNotNull())
    placed = placed.select("doc_id", "text_hash", "at", "words", F.explode(templates).alias("template"))
    hashed = placed.select("doc_id", "text_hash", "at", window_hash(word_hashes(F.col("words"), F.col("template"))).alias("hash"))
    return hashed.join(_few(items.select("hash").distinct()), "hash", "left_semi").distinct()


def _starts(words: Column) -> Column:
    """First positions of all windows, from 0."""
    none = F.array().cast("array<int>")
    return F.when(F.size(words) >= WORDS, F.sequence(F.lit(0), F.size(words) - WORDS)).otherwise(none)


def window_at(words: Column, at: Column) -> Column:
    return F.slice(words, at + 1, WORDS)


def _bare(words: Column) -> Column:
    """The words without the marks of words that begin a sentence."""
    return F.transform(words, lambda w: F.ltrim(w, F.lit("~")))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, item (a row of the benchmark), at, hash, template and values of every window, and the item's count."""
    texts = benchmark.select("item_id", "text").distinct().select("item_id", F.xxhash64("text").alias("item"), raw_words(F.col("text")).alias("raw"))
    made = texts.withColumn("canon", template(F.col("raw"))).withColumn("wide", template(F.col("raw"), True))
    made = made.withColumn("raw", _bare(F.col("raw")))
    placed = made.select("item_id", "item", "raw", "canon", "wide", F.explode(_starts(F.col("canon"))).alias("item_at"))
    windows = placed.select(
        "item_id",
        "item",
        "item_at",
        F.size("canon").alias("length"),
        window_at(F.col("canon"), F.col("item_at")).alias("canon"),
        window_at(F.col("raw"), F.col("item_at")).alias("item_raw"),
        window_at(F.col("wide"), F.col("item_at")).alias("wide"),
    )
    literal = F.size(F.filter("canon", lambda w: ~w.startswith("#")))
    windows = windows.where(literal >= LITERALS)
    all_windows = Window.partitionBy("item_id", "item")
    windows = windows.withColumn("n_windows", F.count(F.lit(1)).over(all_windows))
    # what the wide template says of the same places
    windows = windows.withColumn("canon", F.explode(F.array_distinct(F.array("canon", "wide")))).where(literal >= LITERALS)
    return windows.drop("wide").withColumn("hash", window_hash(lambda k: F.xxhash64(F.get("canon", F.lit(k)))))


def _few(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def _occurrences() -> Column:
    """What a window is judged with: the whole document, and stretches where it may be of the same copy of the item.

    Copies are an item's length apart; stretches of half of it, in two ways that overlap, allow for words put in.
    """
    off, wide = F.col("at") - F.col("item_at"), F.greatest(F.lit(1), F.floor(F.col("length") / 2))
    stretches = (F.lit(0).cast("long"), F.floor(off / wide), F.floor((off + F.floor(F.col("length") / 4)) / wide))
    return F.array(*(F.struct(F.lit(k).alias("turn"), x.alias("stretch")) for k, x in enumerate(stretches)))


def _equal(columns: list[str]) -> Column:
    """Null-safe equality with columns that have an underscore before their names."""
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns))


def _underscored(frame: DataFrame) -> DataFrame:
    return frame.select(*(F.col(c).alias(f"_{c}") for c in frame.columns))


def found_items(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document (doc_id and text_hash) and item found in it, with its counts of windows."""
    items = stored(item_windows(benchmark), "item-windows")
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    worded = texts.withColumn("raw", raw_words(F.col("text")))
    hits = stored(window_hits(worded, items), "window-hits")
    matched = hits.join(_few(items.select("hash", "item_id", "item", "item_at", "n_windows")), "hash")
    per_item = matched.groupBy("doc_id", "text_hash", "item_id", "item").agg(
        F.countDistinct("item_at").alias("n"), F.max("n_windows").alias("n_windows")
    )
    candidates = stored(per_item.where(F.col("n") >= SHARE * F.col("n_windows")).drop("n"), "candidates")
    wanted = _underscored(candidates.select("doc_id", "text_hash").distinct())
    same = _equal(["doc_id", "text_hash"])
    again = texts.join(_few(wanted), same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    words = again.withColumn("raw", raw_words(F.col("text"))).withColumn("canon", template(F.col("raw")))
    words = words.withColumn("wide", template(F.col("raw"), True)).withColumn("raw", _bare(F.col("raw")))
    words = _underscored(words.select("doc_id", "text_hash", "raw", "canon", "wide"))
    places = hits.join(wanted, same, "left_semi").join(words, same).select(
        "doc_id",
        "text_hash",
        "hash",
        "at",
        window_at(F.col("_canon"), F.col("at")).alias("doc_window"),
        window_at(F.col("_wide"), F.col("at")).alias("doc_wide"),
        window_at(F.col("_raw"), F.col("at")).alias("doc_raw"),
    )
    pairs = places.distinct().join(items, "hash").where("canon = doc_window OR canon = doc_wide").drop("doc_window", "doc_wide")
    ordinary = lambda s: F.lower(s["item_raw"]).isin(STARTERS) | F.lower(s["doc_raw"]).isin(STARTERS)
    renamed = F.filter(F.arrays_zip("canon", "item_raw", "doc_raw"), lambda s: s["canon"] == "#name")
    pairs = pairs.where(~F.exists(renamed, lambda s: ordinary(s) & (F.lower(s["item_raw"]) != F.lower(s["doc_raw"]))))
    found = ["doc_id", "text_hash", "item_id", "item"]
    key = [*found, "turn", "stretch"]
    chosen = _underscored(candidates.select(*found))
    pairs = pairs.join(chosen, _equal(found), "left_semi").withColumn("o", F.explode(_occurrences()))
    pairs = stored(pairs.select("*", "o.turn", "o.stretch").drop("o", "at").distinct(), "window-pairs")
    slots = F.filter(F.arrays_zip("canon", "item_raw", "doc_raw"), lambda s: s["canon"].startswith("#"))
    values = pairs.withColumn("slot", F.explode(slots)).select(
        *key, "item_at", "hash", "doc_raw", "slot.canon", F.col("slot.item_raw").alias("value"), F.col("slot.doc_raw").alias("reading")
    )
    readings = values.groupBy(*key, "canon", "value", "reading").agg(F.count(F.lit(1)).alias("n"))
    first = Window.partitionBy(*key, "canon", "value").orderBy(F.desc("n"), "reading")
    odd = readings.withColumn("nth", F.row_number().over(first)).where("nth > 1").select(*key, "canon", "value", "reading")
    against = values.join(_underscored(odd), _equal(odd.columns), "left_semi").select(*key, "item_at", "hash", "doc_raw").distinct()
    changed = ~F.col("item_raw").eqNullSafe(F.col("doc_raw"))
    agreeing = pairs.join(_underscored(against), _equal(against.columns) & changed, "left_anti")
    counted = agreeing.groupBy(*key).agg(
        F.max("n_windows").alias("n_windows"),
        F.countDistinct("item_at").alias("n_found"),
        F.countDistinct(F.when(~changed, F.col("item_at"))).alias("n_verbatim"),
    )
    best = counted.groupBy(*found).agg(*(F.max(n).alias(n) for n in ("n_windows", "n_found", "n_verbatim")))
    return best.where(F.col("n_found") >= SHARE * F.col("n_windows")).unionByName(found_short(texts, benchmark))


def found_short(texts: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items too short for a window that stand in a document as they are, as rows of ``found_items``."""
    words = lambda text: F.transform(_bare(raw_words(text)), lambda w: F.lower(w))
    items = benchmark.select("item_id", F.xxhash64("text").alias("item"), words(F.col("text")).alias("words")).distinct()
    items = stored(items.where(F.size("words").between(SHORT, WORDS - 1)), "short-items")
    sizes = sorted(r["n"] for r in items.select(F.size("words").alias("n")).distinct().collect())  # at most WORDS - SHORT
    counts = {n: F.lit(1).cast("long").alias(n) for n in ("n_windows", "n_found", "n_verbatim")}
    if not sizes:
        none = texts.limit(0).select("doc_id", "text_hash", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"))
        return none.select("*", F.lit(None).cast("long").alias("item"), *counts.values())
    worded = texts.select("doc_id", "text_hash", words(F.col("text")).alias("words"))

    def windows(n: int) -> Column:
        starts = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.slice("words", at + 1, n))

    parts = [windows(n) for n in sizes]
    placed = worded.select("doc_id", "text_hash", F.explode(F.array_distinct(F.concat(*parts))).alias("words"))
    met = placed.join(_few(items), "words").select("doc_id", "text_hash", "item_id", "item").distinct()
    return met.select("*", *counts.values())


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    leaked = found_items(documents, benchmark).select(F.col("doc_id").alias("__leaked_id"), F.col("text_hash").alias("__leaked_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__leaked_id")) & (F.xxhash64("text") == F.col("__leaked_hash"))
    return documents.join(_few(stored(leaked, "leaked")), same, "left_anti")


_BARE = "list_transform({}, lambda w: ltrim(w, '~'))"


@query(
    rf"""
WITH words AS (
    SELECT kind, id, text, regexp_extract_all(regexp_replace(text, '{_SENTENCE}', '\1~\2', 'g'), '{_WORD}') AS raw
    FROM (SELECT DISTINCT 'd' AS kind, doc_id AS id, text FROM documents
          UNION ALL SELECT DISTINCT 'i', item_id, text FROM benchmark) t
), templates AS (
    SELECT kind, id, text, {_BARE.format("raw")} AS raw, len(raw) AS length, list_transform(raw, lambda w, i:
        CASE WHEN w[1] = '~' THEN lower(w[2:])
             WHEN w[1] BETWEEN '0' AND '9' THEN '#num'
             WHEN i > 1 AND raw[i - 1][1] BETWEEN '0' AND '9'
                  AND lower(w) IN ({", ".join(f"'{u}'" for u in UNITS)}) THEN '#unit'
             WHEN w[1] <> lower(w)[1] THEN '#name' ELSE lower(w) END) AS canon,
      list_transform(raw, lambda w, i:
        CASE WHEN w[1] BETWEEN '0' AND '9' OR ltrim(lower(w), '~') IN ({", ".join(f"'{u}'" for u in NUMBERS)}) THEN '#num'
             WHEN i > 1 AND (raw[i - 1][1] BETWEEN '0' AND '9' OR ltrim(lower(raw[i - 1]), '~') IN ({", ".join(f"'{u}'" for u in NUMBERS)}))
                  AND lower(w) IN ({", ".join(f"'{u}'" for u in UNITS)}) THEN '#unit'
             WHEN w[1] = '~' OR w[1] <> lower(w)[1] THEN '#name' ELSE lower(w) END) AS wide
    FROM words
), placed AS (
    SELECT *, unnest(generate_series(1, length - {WORDS} + 1)) AS pos FROM templates WHERE length >= {WORDS}
), windows AS (
    SELECT kind, id, text, length, pos, canon[pos:pos + {WORDS - 1}] AS canon, wide[pos:pos + {WORDS - 1}] AS wide,
      raw[pos:pos + {WORDS - 1}] AS raw FROM placed
), counted_items AS (
    SELECT *, count(*) OVER (PARTITION BY id, text) AS n_windows FROM windows
    WHERE kind = 'i' AND len(list_filter(canon, lambda w: NOT starts_with(w, '#'))) >= {LITERALS}
), items AS (
    SELECT * FROM (SELECT * EXCLUDE (canon, wide), unnest(list_distinct([canon, wide])) AS canon FROM counted_items) x
    WHERE len(list_filter(canon, lambda w: NOT starts_with(w, '#'))) >= {LITERALS}
), doc_windows AS (
    SELECT id, text, pos, raw, unnest(list_distinct([canon, wide])) AS canon FROM windows WHERE kind = 'd'
), met AS (
    SELECT DISTINCT d.id AS doc_id, d.text AS doc_text, i.id AS item_id, i.text AS item_text, i.pos, i.n_windows,
           i.canon, i.raw AS item_raw, d.raw AS doc_raw, d.pos - i.pos AS off, i.length
    FROM items i JOIN doc_windows d ON i.canon = d.canon
    WHERE len(list_filter(generate_series(1, {WORDS}), lambda k: i.canon[k] = '#name' AND lower(i.raw[k]) <> lower(d.raw[k])
      AND (lower(i.raw[k]) IN ({", ".join(f"'{u}'" for u in STARTERS)}) OR lower(d.raw[k]) IN ({", ".join(f"'{u}'" for u in STARTERS)})))) = 0
), pairs AS (
    SELECT DISTINCT doc_id, doc_text, item_id, item_text, pos, n_windows, canon, item_raw, doc_raw, turn,
      CASE turn WHEN 0 THEN 0 WHEN 1 THEN floor(off / greatest(1, floor(length / 2)))
                ELSE floor((off + floor(length / 4)) / greatest(1, floor(length / 2))) END AS stretch
    FROM met, (VALUES (0), (1), (2)) t(turn)
), slot_values AS (
    SELECT doc_id, doc_text, item_id, item_text, turn, stretch, pos, canon, doc_raw, canon[k] AS kind, item_raw[k] AS value, doc_raw[k] AS reading
    FROM (SELECT *, unnest(generate_series(1, {WORDS})) AS k FROM pairs) s WHERE starts_with(canon[k], '#')
), counted_readings AS (
    SELECT doc_id, doc_text, item_id, item_text, turn, stretch, kind, value, reading, count(*) AS n FROM slot_values GROUP BY ALL
), readings AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, doc_text, item_id, item_text, turn, stretch, kind, value
                                 ORDER BY n DESC, reading) AS nth
    FROM counted_readings
), against AS (
    SELECT DISTINCT v.doc_id, v.doc_text, v.item_id, v.item_text, v.turn, v.stretch, v.pos, v.canon, v.doc_raw
    FROM slot_values v JOIN readings r USING (doc_id, doc_text, item_id, item_text, turn, stretch, kind, value, reading) WHERE r.nth > 1
), agreeing AS (
    SELECT p.* FROM pairs p LEFT JOIN against a USING (doc_id, doc_text, item_id, item_text, turn, stretch, pos, canon, doc_raw)
    WHERE a.doc_text IS NULL OR p.item_raw = p.doc_raw
), counted AS (
    SELECT doc_id, doc_text, item_id, item_text, max(n_windows) AS n_windows, count(DISTINCT pos) AS n_found,
           count(DISTINCT CASE WHEN item_raw = doc_raw THEN pos END) AS n_verbatim
    FROM agreeing GROUP BY doc_id, doc_text, item_id, item_text, turn, stretch
), best AS (
    SELECT doc_id, item_id, max(n_windows) AS n_windows, max(n_found) AS n_found, max(n_verbatim) AS n_verbatim
    FROM counted GROUP BY doc_id, doc_text, item_id, item_text
), short AS (
    SELECT DISTINCT d.id AS doc_id, d.text, i.id AS item_id, i.text AS item_text FROM templates i JOIN templates d
      ON i.kind = 'i' AND d.kind = 'd' AND i.length BETWEEN {SHORT} AND {WORDS - 1} AND list_contains(
        list_transform(generate_series(1, d.length - i.length + 1), lambda p: lower(array_to_string(d.raw[p:p + i.length - 1], chr(10)))),
        lower(array_to_string(i.raw, chr(10))))
)
SELECT doc_id, item_id, n_windows, n_found, n_verbatim, CAST(n_found AS DOUBLE) / n_windows AS share
FROM best WHERE n_found >= {SHARE} * n_windows
UNION ALL SELECT doc_id, item_id, 1, 1, 1, 1.0 FROM short
"""
)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = found_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", "n_windows", "n_found", "n_verbatim", (F.col("n_found") / F.col("n_windows")).alias("share")
    )
