"""SentencePiece over distinct marked words against the library on whole texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import pieces, queries

MODEL = queries.tokenizer(queries.PIECE_MODEL)


def whole(text):
    sp = pieces.processor(MODEL)
    ids = sp.encode(text or "", add_bos=True, add_eos=True)
    return ids, sp.decode(ids)


def test_equals_the_library(docs, rows):
    got = pieces.encode_texts(docs, MODEL, keep=["doc_id", "n_chars"]).collect()
    got = sorted(((r.doc_id, r.n_chars, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in got), key=str)
    assert got == sorted(((r[0], r[4], *whole(r[1])) for r in rows), key=str)


def test_marked_words_of_odd_white_space():
    rng = random.Random(1)
    sp = pieces.processor(MODEL)
    lone = sp.piece_to_id(pieces.MARK)
    for _ in range(2000):
        text = "".join(rng.choice(" ▁\n\ta b.é中<s></s>\r\x00 ") for _ in range(rng.randrange(50)))
        words = pieces.marked_words(text)
        ids = [i for w in words for i in (sp.encode(w) if w else [lone])]
        assert ids == sp.encode(text), repr(text)


def test_small_blocks_and_batches():
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(30))) for _ in range(200)] + [None, "", " "]
    for block_words in (0, 20, 10**6):
        table = pieces.WordTable(MODEL, block_words)
        for at in range(0, len(texts), 7):
            assert [x.tolist() for x in table.encode(texts[at : at + 7])] == [whole(t)[0] for t in texts[at : at + 7]]
        assert len(table.number) <= 62


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    out = queries.op2_sentencepiece(spark, sf).collect()
    assert {r.doc_id for r in out} == set(texts) and len(out) == len(texts)
    for r in out:
        ids, decoded = whole(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_empty_table_and_clashing_names(empty, clashing, rows):
    assert pieces.encode_texts(empty, MODEL).count() == 0
    out = pieces.encode_texts(clashing, MODEL)
    assert out.count() == len(rows) and "block" in out.columns and out.select(F.max("block")).first()[0] == 13
    replaced = pieces.encode_texts(clashing.withColumns({"ids": F.lit(1), "decoded": F.lit(2)}), MODEL)
    assert replaced.columns.count("ids") == 1 and dict(replaced.dtypes)["ids"] == "binary"
    assert sorted(r.ids for r in replaced.collect()) == sorted(r.ids for r in out.collect())
