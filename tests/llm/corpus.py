"""Small tables with the cases every operator must stand."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"

# Column names that operators use inside.
CLASHING = ("row", "at", "score", "predicted", "number", "hash", "cls", "n", "key", "shard", "length", "text_hash", "spans")


def documents(spark, rows):
    """doc_id, text and extra columns whose names clash."""
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *("x" for _ in CLASHING)) for i, t in rows], f"doc_id long, text string, {extra}")


ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (None, "no id here but words enough to count as text"),
    (4, "short"),
    (5, "the same row twice with some words in it"),
    (5, "the same row twice with some words in it"),
    (5, "the same id with quite another text in it"),
    (6, "Ünïcödé 漢字 ́ \U0001f600 \x00 text"),
    (7, "long " * 40_000),
]
