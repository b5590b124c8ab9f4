from pyspark.sql import functions as F

from compare import connect
from corpus import ODD, documents
from tidemark.llm import decontamination as dc
from tidemark.llm.queries import LLM_QUERIES, LLM_SQL

ITEM = "A train leaves Paris at 9 and travels 120 km to the city of Lyon. When does the train from Paris arrive if it needs 2 hours for the way to Lyon"


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, hash string")


def found(spark, docs, bench):
    return {(r["doc_id"], r["item_id"]): r for r in dc.found_items(documents(spark, docs), items(spark, bench)).collect()}


def test_verbatim_and_changed_values(spark):
    other = ITEM.replace("Paris", "New Berlin").replace("Lyon", "Hamburg").replace("120 km", "3,500 miles").replace("9", "11").replace("2", "5")
    item = "then Anna gives Bert three coins and Bert gives Anna five coins so that Anna and Bert have as many coins as Anna had"
    mixed = item
    for name in ("Dora", "Emil", "Fritz", "Gerda"):
        mixed = mixed.replace("Anna", name, 1)
    same = item.replace("Anna", "Dora").replace("Bert", "Emil")
    docs = [(1, "Before it. " + ITEM + ". After it."), (2, other), (3, mixed), (6, same), (4, "a train leaves at noon and that is all there is to it"), (5, ITEM[: len(ITEM) // 3])]
    got = found(spark, docs, [(10, ITEM), (13, item), (11, "no such item is in any of the documents at all"), (12, "too few words")])
    assert set(got) == {(1, 10), (2, 10), (6, 13)}
    one, two = got[1, 10], got[2, 10]
    assert one["n_verbatim"] == one["n_found"] == one["n_windows"]
    assert two["n_found"] == two["n_windows"] > two["n_verbatim"]


def test_template(spark):
    row = documents(spark, [(1, "He ran 5 km. Then Mary Ann Smith took 3.5 kg of m to it")])
    words = row.select(dc.template(dc.raw_words(row["text"])).alias("t")).first()["t"]
    assert words == "he ran #num #unit then #name took #num #unit of m to it".split()


def test_placeholders_alone_are_no_evidence(spark):
    table = " ".join(str(k) for k in range(40))
    assert found(spark, [(1, table)], [(1, table)]) == {}


def test_odd_rows(spark):
    assert found(spark, ODD, [(1, None), (2, ""), (3, "one two three four five six")]) == {}
    bench = items(spark, [(1, "the same row twice with some words in it")])
    docs = documents(spark, ODD)
    kept = dc.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.where("doc_id = 5").collect()) == ["the same id with quite another text in it"]
    assert kept.count() == len(ODD) - 2
    assert dc.clean_documents(documents(spark, []), bench).count() == 0
    assert dc.clean_documents(docs, items(spark, [])).count() == len(ODD)
    null_id = "no id here but words enough to count as text"
    assert set(found(spark, ODD, [(9, null_id)])) == {(None, 9)}


def test_windows_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    assert set(found(spark, [(1, "So: " + ITEM)], [(10, ITEM)])) == {(1, 10)}


def test_plan_is_native(spark):
    docs, bench = documents(spark, [(1, ITEM)]), items(spark, [(10, ITEM)])
    plan = dc.found_items(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


CLIPS = "the shop of Anna sold 48 clips to Bert in the month of May and then Anna sold 24 more clips to Carl so how many clips did Anna sell to Bert and to Carl in all"


def test_copies_with_other_values_in_one_text(spark):
    other = CLIPS.replace("Anna", "Dora").replace("Bert", "Adam").replace("Carl", "Fritz").replace("48", "7").replace("24", "100")
    third = CLIPS.replace("Anna", "Cleo").replace("Bert", "Yan").replace("Carl", "Abel").replace("48", "70").replace("24", "31").replace("May", "June")
    put_in = other.replace("then", "then one day later")
    docs = [(1, CLIPS + ". " + other), (2, other + ". " + CLIPS + "."), (3, other + ". " + third), (4, put_in + ". " + third), (5, other)]
    got = found(spark, docs, [(10, CLIPS)])
    assert {d for d, _ in got} == {1, 2, 3, 4, 5}
    assert got[1, 10]["n_verbatim"] == got[2, 10]["n_verbatim"] == got[1, 10]["n_windows"]
    assert dc.clean_documents(documents(spark, docs), items(spark, [(10, CLIPS)])).count() == 0


def test_changed_names_that_begin_sentences(spark):
    item = "Natalia sold clips to 48 of her friends in April. Natalia then sold half as many clips in May. Carl bought three clips from her. How many clips did she sell altogether in April and May?"
    other = item.replace("Natalia", "Susan").replace("48", "60").replace("Carl", "Peter").replace("three", "five")
    mixed = item.replace("Natalia", "Susan", 1).replace("Carl", "Susan").replace("Natalia", "Peter", 1)
    docs = [(1, item), (2, "Question: " + other + " Answer"), (3, "So it is said. " + item), (4, "Natalia sold a house in May. How many did she sell?")]
    got = found(spark, docs + [(5, mixed)], [(10, item)])
    assert {(1, 10), (2, 10), (3, 10)} <= set(got) and (4, 10) not in got
    assert got[1, 10]["n_verbatim"] == got[3, 10]["n_verbatim"] == got[1, 10]["n_windows"]
    assert got[2, 10]["n_found"] > got[2, 10]["n_verbatim"]


def test_the_query_finds_what_the_operator_finds(spark, tmp_path):
    """An item beside its variant, changed names that begin sentences, and short items, through the query."""
    other = CLIPS.replace("Anna", "Dora").replace("Bert", "Adam").replace("Carl", "Fritz").replace("48", "7").replace("24", "100")
    natalia = "Natalia sold clips to 48 of her friends in April. Natalia then sold half as many clips in May. How many did she sell altogether?"
    susan = natalia.replace("Natalia", "Susan").replace("48", "60")
    five = "Which river crosses the town"
    bench = [(10, CLIPS), (20, natalia), (30, five), (40, "Name three colours"), (50, "Why not")]
    docs = [
        (1, CLIPS + ". " + other), (2, other), (3, "Exercise. " + susan), (4, natalia), (5, "Question: " + five + " of Ulm?"),
        (6, "Please name three colours. Thanks"), (7, "three colours name"), (8, "Why not"), (9, "which river is it that crosses the town"), (None, five),
    ]
    documents(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, bench).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in LLM_QUERIES["op9_decontamination"](spark, str(tmp_path)).collect()}
    assert got == {(1, 10), (2, 10), (3, 20), (4, 20), (5, 30), (6, 40), (None, 30)}
    sql = connect("/nowhere")
    for name in ("documents", "benchmark"):
        sql.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert {r[:2] for r in sql.sql(LLM_SQL["op9_decontamination"]).fetchall()} == got


def test_window_hashes_are_the_items(spark):
    """Windows of documents are hashed word by word, as those of items."""
    text = "So Anna bought five apples for 3 dollars. Then Bert ate two of them. It was 9 km to go"
    row = documents(spark, [(1, text)]).select(dc.raw_words(F.col("text")).alias("raw"))
    hashed, windows = dc.document_windows(F.col("raw"))
    mine = row.withColumn("h", hashed).select(F.explode(windows(F.col("h"))).alias("w")).select("w.at", F.explode("w.hashes").alias("hash"))
    theirs = dc.item_windows(items(spark, [(1, text)])).select("item_at", "hash")
    assert {tuple(r) for r in theirs.collect()} <= {tuple(r) for r in mine.collect()}


def test_windows_are_hashed_by_compiled_code(spark, monkeypatch):
    """Words are looked at row by row, not by functions over arrays; the pair test loses no window."""
    docs = documents(spark, [(1, "So: " + ITEM), (2, CLIPS), (3, None), (4, "Anna and Bert sold 48 clips to Carl in May, to Bert")])
    worded = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), dc.raw_words(F.col("text")).alias("raw"))
    windows = dc.stored(dc.item_windows(items(spark, [(10, ITEM), (11, CLIPS)])), "items")
    hits = dc.window_hits(worded, windows)
    assert "transform(" not in hits._jdf.queryExecution().optimizedPlan().toString()
    near, all_windows = dc.document_windows(F.col("raw"))
    every = worded.select("doc_id", "text_hash", F.explode(all_windows(near)).alias("w")).select("doc_id", "text_hash", "w.at", F.explode("w.hashes").alias("hash"))
    wanted = sorted(every.join(windows.select("hash").distinct(), "hash", "left_semi").select("doc_id", "at", "hash").collect())
    assert len(wanted) > 40 and sorted(hits.select("doc_id", "at", "hash").collect()) == wanted
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    assert sorted(dc.window_hits(worded, windows).select("doc_id", "at", "hash").collect()) == wanted


LONG_NAME, LONG_NUMBER = " ".join(["Enung"] * 20_000), ",".join(["12"] * 20_000)


def test_long_runs_are_one_word(spark):
    """However many capitalised words or groups of digits follow each other, they take no stack."""
    docs = documents(spark, [(1, LONG_NAME + ". " + ITEM), (2, "It is " + LONG_NUMBER + " and no more of it"), (3, LONG_NAME), (4, ITEM + " " + LONG_NUMBER)])
    words = {r["doc_id"]: r["raw"] for r in docs.select("doc_id", dc.raw_words(F.col("text")).alias("raw")).collect()}
    assert [len(words[k]) for k in (2, 3)] == [8, 2] and LONG_NUMBER in words[2] and LONG_NAME[6:] in words[3]
    assert sorted(r["doc_id"] for r in dc.clean_documents(docs, items(spark, [(10, ITEM)])).collect()) == [2, 3]


def test_the_query_equals_its_sql_on_long_runs(spark, tmp_path):
    """Items of both kinds beside runs of capitalised words and of digits that are far longer than a stack."""
    other = CLIPS.replace("Anna", "Dora").replace("Bert", "Adam").replace("Carl", "Fritz").replace("48", "7").replace("24", "100")
    bench = [(10, CLIPS), (20, "Name three colours")]
    docs = [(1, LONG_NAME + ". " + CLIPS), (2, other + ". " + LONG_NUMBER), (3, "So name three colours. " + LONG_NAME), (4, LONG_NAME), (5, LONG_NUMBER)]
    documents(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, bench).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = LLM_QUERIES["op9_decontamination"](spark, str(tmp_path))
    sql = connect("/nowhere")
    for name in ("documents", "benchmark"):
        sql.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = sorted(tuple(r) for r in found.collect())
    assert got == sorted(sql.sql(f"SELECT {', '.join(found.columns)} FROM ({LLM_SQL['op9_decontamination']}) q").fetchall())
    assert [r[:2] for r in got] == [(1, 10), (2, 10), (3, 20)]
