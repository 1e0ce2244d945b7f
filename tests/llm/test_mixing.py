"""Mixing sources to target weights against a plain computation."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing, queries


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_of(sizes, weights, ratio, cap):
    """Water-filling over {source: size}, sources by code point, None last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, clamped = ratio * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in clamped]
        level = (budget - sum(cap * sizes[s] for s in clamped)) / max(sum(weight[s] for s in free), 1e-300)
        over = {s for s in free if weight[s] * level > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in clamped else weight[s] * level for s in order}
        clamped |= over


def check(out, rows, weights, ratio, cap):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size_of(r[1])
    want = targets_of(sizes, weights, ratio, cap)
    taken = defaultdict(int)
    assert sorted(((r.doc_id, r.source, r.size) for r in out), key=str) == sorted(((r[0], r[3], size_of(r[1])) for r in rows), key=str)
    for r in out:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.taken <= cap * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert taken[s] == pytest.approx(t, abs=1.001)
    assert sum(want.values()) == pytest.approx(min(ratio, cap) * sum(sizes.values()))


@pytest.mark.parametrize("weights, ratio, cap", [([3, 1, 2], 1.5, 2.0), ([1], 0.3, 2.0), ([5, 1], 1.9, 2.0), ([1, 100], 1.0, 1.0)])
def test_targets_and_taken(docs, rows, weights, ratio, cap):
    check(mixing.mix(docs, weights, ratio, cap).collect(), rows, weights, ratio, cap)


def test_reruns_agree_and_seeds_differ(docs, clashing):
    def run(df, seed):
        return sorted((tuple(r) for r in mixing.mix(df, [3, 1, 2], seed=seed).select("doc_id", "size", "taken").collect()), key=str)

    assert run(docs, 42) == run(docs.repartition(7), 42) == run(clashing, 42)
    assert run(docs, 42) != run(docs, 43)


def test_empty_and_wordless_tables(spark, empty, docs):
    assert mixing.mix(empty, [3, 1, 2]).count() == 0
    blank = docs.withColumn("text", F.lit(" \n"))
    assert {(r.target, r.taken) for r in mixing.mix(blank, [3, 1, 2]).collect()} == {(0.0, 0)}


def test_repeated_documents(docs, clashing):
    mixed = mixing.mix(docs, [3, 1, 2])
    out = mixing.repeat_documents(docs, mixed)
    assert out.columns == docs.columns
    copies = defaultdict(int)
    for r in out.collect():
        copies[r.doc_id, r.text] += 1
    want = defaultdict(int)
    for r in mixing.mix(docs, [3, 1, 2]).collect():
        want[r.doc_id, r.place] += int(r.taken / r.size + 0.5) if r.size else r.whole
    assert sum(copies.values()) == sum(want.values())
    assert mixing.repeat_documents(clashing, mixing.mix(clashing, [3, 1, 2])).columns == clashing.columns


def test_native_plan(docs):
    for df in (mixing.mix(docs, [3, 1, 2]), mixing.repeat_documents(docs, mixing.mix(docs, [3, 1, 2]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop"))


def test_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    names = ["doc_id", "size", "source_size", "target", "taken"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op7_mixing']}) ORDER BY doc_id").fetchall()
    got = [tuple(r) for r in queries.op7_mixing(spark, sf).select(*names).orderBy("doc_id").collect()]
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and g[4] == w[4] and g[3] == pytest.approx(w[3])
