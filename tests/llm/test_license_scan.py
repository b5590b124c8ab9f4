import random

from corpus import ODD, documents
from tidemark.llm import license_scan as ls
from tidemark.llm.registry import LLM_QUERIES
import tidemark.llm.queries  # noqa: F401


def scanned(text):
    return ls.Scanner().scan(text)


def test_matches_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        templates = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 9))] for _ in range(3)]
        automaton = ls.Automaton()
        for t in templates:
            automaton.add(t)
        automaton.finish()
        text = [rng.choice([b"a", b"b", b"c", b"z"]) for _ in range(25)]

        def inside(run, templates=templates):
            return any(run == t[k : k + len(run)] for t in templates for k in range(len(t)))

        wanted = []
        for end in range(1, len(text) + 1):
            size = max((n for n in range(end + 1) if n == 0 or inside(text[end - n : end])))
            grows = end < len(text) and inside(text[end - size : end + 1])
            if size >= ls.MIN_MATCH and not grows:
                wanted.append((end - size, end))
        found = automaton.matches(text)
        assert [(a, b) for a, b, _ in found] == wanted
        for start, end, state in found:
            places = {(n, k + end - start) for n, t in enumerate(templates) for k in range(len(t)) if text[start:end] == t[k : k + end - start]}
            assert automaton.ends[state] == places


def test_base_places_follow_the_words():
    found = scanned("The MIT License, the mit-license; mit licensed. Apache  License general public\nLICENSE")
    assert [label for _, label in found.base] == ["mit", "mit", "apache", "gpl"]
    assert found.base[0][0] == 1 and found.n_words == 13


def test_edited_notice_is_covered():
    text = ls.TEMPLATES[1][1].replace("free of charge", "at no cost").replace("Software", "Program", 1)
    found = scanned("Some words before. " + text + " And some after.")
    assert found.spans and found.spans[0][0] == "mit" and 0.7 < found.score <= 1
    assert scanned("Nothing about the terms of this source or the rights of others.").spans == []


def test_notice_with_other_label():
    found = scanned("xyz Licensed under CC BY-NC 4.0. abc")
    assert [s[0] for s in found.spans] == ["cc-by-nc"] and found.base == [] and found.score == 1.0


def test_odd_rows_and_query(spark):
    found = {(r["doc_id"], r["n_words"]) for r in ls.scan(documents(spark, ODD)).collect()}
    assert {(1, 0), (2, 0), (3, 0), (7, 40_000)} <= found
    assert ls.scan(documents(spark, ODD)).count() == len(ODD)
    assert ls.scan(documents(spark, [])).count() == 0
    rows = LLM_QUERIES["op3_license_scan"](spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import re

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in rows:
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in texts[r["doc_id"]]))
        at = [(k, label) for phrase, label in ls.PHRASES for k in range(len(words)) if words[k : k + len(phrase)] == [p.decode() if isinstance(p, bytes) else p for p in phrase]]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at))
        assert r["first_word"] == min((k for k, _ in at), default=None) and r["last_word"] == max((k for k, _ in at), default=None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
