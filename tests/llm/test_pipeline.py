"""The corpus pipeline: each stage on its predecessor's rows, and its decisions."""

import hashlib
import importlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from strata.llm import mixing, pieces, quality, queries, simhash
from strata.llm.tables import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_stage_list():
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "mixing", "sentencepiece"]
    assert importlib.import_module("__spark_entry__").queries()["pipeline"] is queries.pipeline


def test_quality_stage_drops_what_the_classifier_rejects(spark, stages):
    weights, bias = queries.quality_model(spark, SF)
    scored = quality.score(stages[0], weights, bias).filter(F.col("score") >= 0.7)
    assert sorted(r.doc_id for r in stages[1].collect()) == sorted(r.doc_id for r in scored.collect())
    assert stages[1].columns == stages[0].columns and 0 < stages[1].count() < stages[0].count()


def test_one_document_of_each_group_stays(stages):
    found = simhash.near_duplicates(stages[1]).collect()
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({r.component_id for r in found})
    assert stages[2].columns == stages[0].columns and stages[2].count() < stages[1].count()


def test_mixing_stage_repeats_documents(stages):
    mixed = mixing.mix(stages[2], queries.MIX_WEIGHTS, 1.5, 2.0).collect()
    want = Counter({r.doc_id: int(r.taken / r.size + 0.5) if r.size else r.whole for r in mixed})
    got = Counter(r.doc_id for r in stages[3].collect())
    assert got == +want and stages[3].columns == stages[0].columns


def test_sentencepiece_stage(spark, stages):
    texts = {r.doc_id: r.text for r in stages[3].collect()}
    rows = stages[4].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stages[3].collect())
    sp = pieces.processor(queries.tokenizer(queries.PIECE_MODEL))
    for r in rows[:80]:
        ids = sp.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids == np.array(ids, "<u4").tobytes()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_run_is_the_stages_in_order(spark, stages):
    def digest(df):
        return sorted(map(tuple, df.select("doc_id", "n_tokens", "ids_sha256").collect()))

    assert digest(cp.run(spark, SF)) == digest(stages[4])


def test_stages_on_odd_rows(spark, docs, rows, empty, clashing):
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0
    kept = cp.keep_one_of_each_group(spark, docs, SF)
    groups = simhash.near_duplicates(docs).select("root").distinct().count()
    assert kept.count() == groups and kept.columns == docs.columns
    assert cp.keep_one_of_each_group(spark, clashing, SF).columns == clashing.columns
    assert cp.keep_good_quality(spark, clashing.withColumn("score", F.lit(1)), SF).columns == [*clashing.columns, "score"]
    assert cp.encode_pieces(spark, docs, SF).count() == len(rows)
