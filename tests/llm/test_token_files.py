import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from corpus import ODD, SF, documents
from tidemark.llm import token_files, tokens
from tidemark.llm.registry import LLM_QUERIES
from tidemark.llm.tokens import encoder
from tidemark.session import work_folder
import tidemark.llm.queries  # noqa: F401


def wanted(rows):
    """What the files must hold for (doc_id, text) rows in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = encoder("byte_bpe_50k.json").tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_tokenizers_ids(name):
    rng = random.Random(3)
    parts = list("\x02ab  \n\t é'sÉ12,.!\x01 　ć<|>x") + ["'s", " 'll", "<|endoftext|>", "\r\n", " ́", "ß", "中", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", " ", "a ", " a", None]
    found = encoder(name).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder(name).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_look_up_stays_bounded(monkeypatch):
    """Two generations are kept; ids stay right while pieces come and go, whatever is merged or cut."""
    own = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for name, value in (("KEPT_PIECES", 50), ("MERGED_PIECES", 7), ("SLICE", 300), ("IDLE_PIECES", 20)):
        monkeypatch.setattr(tokens, name, value)
    rng = random.Random(4)
    for _ in range(40):
        texts = [" ".join(f"w{rng.randint(0, 400)}x" for _ in range(rng.randint(0, 60))) for _ in range(5)] + [None, ""]
        for text, ids in zip(texts, own.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == own.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert len(own.pieces) < 300
        if rng.random() < 0.2:
            own.pieces.shrink()
            assert len(own.pieces) <= 20  # at most what may wait


def test_the_sample_is_small_whatever_repeats(spark, monkeypatch):
    """Repeated texts count once, and no more texts reach the driver than asked for."""
    monkeypatch.setattr(token_files, "SAMPLE_TEXTS", 7)
    rows = [(1, "the same")] * 50 + [(k, f"text {k}") for k in range(2, 30)] + [(None, None), (40, "x" * 70_000)]
    got = token_files.sample(documents(spark, rows))
    assert len(got) == len(set(got)) == 7 and set(got) <= {t for _, t in rows[:-2]}
    assert token_files.sample(documents(spark, [])) == []


def test_query_round_trip(spark):
    texts = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(tuple(r) for r in LLM_QUERIES["op2_token_files"](spark, SF).collect()) == wanted(texts)


def test_odd_rows_and_single_documents(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_ROWS", 3)
    folder = work_folder(spark, "files")
    shards = token_files.encode_to_files(documents(spark, ODD), folder)
    found = token_files.read_files(shards, folder).collect()
    assert len(found) == len(ODD)
    by_place = sorted(found, key=lambda r: r["start"])
    assert by_place[0]["doc_id"] is None
    ids = [r["doc_id"] for r in by_place[1:]]
    assert ids == sorted(ids)
    assert [r["start"] for r in by_place] == np.cumsum([0] + [r["n_tokens"] for r in by_place[:-1]]).tolist()
    plain = {(r[0], r[2], r[3]) for r in wanted(ODD)}
    assert {(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found} == plain
    assert token_files.read_document(folder, 2).tolist() == [0]
    assert len(token_files.read_document(folder, 7)) == next(r[2] for r in wanted(ODD) if r[0] == 7)
    assert token_files.read_document(folder, 99) is None


def test_empty_table(spark):
    folder = work_folder(spark, "files")
    shards = token_files.encode_to_files(documents(spark, []), folder)
    assert token_files.read_files(shards, folder).count() == 0


def test_dictionary_shrinks_short_documents():
    samples = [np.arange(k, k + 50, dtype="<u2").tobytes() for k in range(400)]
    raw = token_files.train_dictionary(samples, 4096)
    import zstandard

    with_it = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)).compress(samples[7])
    assert raw and len(with_it) < len(zstandard.ZstdCompressor().compress(samples[7]))
    assert token_files.train_dictionary([]) == b""
