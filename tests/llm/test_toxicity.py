import numpy as np
import pytest

from corpus import ODD, documents
from tidemark.llm import toxicity
from tidemark.llm.registry import LLM_QUERIES
import tidemark.llm.queries  # noqa: F401

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark):
    scored = LLM_QUERIES["op1_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    pos, neg = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc > 0.9
    wrong = sum((r["score"] >= 0.7) != r["toxic"] for r in rows)
    assert wrong / len(rows) < 0.05
    assert scored.where("predicted <> cast(score >= 0.7 AS int) OR score < 0 OR score > 1").count() == 0
    assert scored.count() == 1000


def test_odd_rows(spark, model):
    found = toxicity.score(documents(spark, ODD), model).collect()
    assert len(found) == len(ODD)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (1, 2)}) == 1
    kept = toxicity.without_toxic(documents(spark, ODD), model)
    assert kept.columns == documents(spark, ODD).columns
    assert kept.count() == len(ODD)


def test_empty_table_and_no_labels(spark, model):
    empty = documents(spark, [])
    assert toxicity.score(empty, model).count() == 0
    labels = spark.createDataFrame([(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    unfitted = toxicity.fit(documents(spark, ODD), labels)
    assert {r["score"] for r in toxicity.score(documents(spark, ODD), unfitted).collect()} == {0.0}


def test_disguised_words_count():
    lexicon = toxicity.Lexicon(frozenset({"idiot", "moron"}), frozenset())
    plain = toxicity.features("you are an idiot", lexicon)
    for text in ("you are an 1d10t", "you are an i d i o t", "you are an idi0t!", "you are an idiooot"):
        assert toxicity.features(text, lexicon)[0] == plain[0] == 1, text
    assert plain[4] == 1
    assert toxicity.features("the weather is fine", lexicon)[0] == 0


def test_trees_and_calibration():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    trees = toxicity.fit_trees(x, y, trees=40)
    assert ((trees.margin(x) > 0) == y).mean() > 0.97
    at, value = toxicity.fit_isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    assert value.tolist() == [0.0, 0.5, 1.0]


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(200).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)
    assert spark.sql("SELECT cast(null AS long) AS id").select(toxicity.held_out("id")).first()[0] is True
