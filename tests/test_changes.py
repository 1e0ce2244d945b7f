"""Signed changes, and what they do to silver and gold."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators.changes import signed_changes
from strata.plans import jobs
from strata.plans import retail as lj
from strata.sources.snapshots import expire_snapshots, read_snapshot, replace_rows, snapshot_history, version_layout

SCHEMA = "k int, g string, v double, at timestamp"


def test_changes_turn_the_old_table_into_the_new(spark):
    rng = random.Random(2)
    row = lambda k: (k, rng.choice(["a", "b", None, "a||b", ""]), rng.choice([1.0, None, 2.5]), None)
    old = [row(rng.choice([None, *range(30)])) for _ in range(200)] + [(99, "same", 1.0, None)] * 50
    new = [r for r in old if rng.random() < 0.7] + [row(rng.choice([None, *range(40)])) for _ in range(40)]
    out = signed_changes(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["k"]).collect()
    net = Counter(old)
    for r in out:
        net[tuple(r)[:-1]] += r._sign
    assert {k: n for k, n in net.items() if n} == dict(Counter(new))
    assert len({tuple(r)[:-1] for r in out}) == len(out)


def test_columns_swapped_or_null_are_changes(spark):
    old = spark.createDataFrame([(1, "x", None), (2, "a", "b||c"), (3, "t", "u")], "k int, a string, b string")
    new = spark.createDataFrame([(1, None, "x"), (2, "a||b", "c"), (3, "t", "u")], "k int, a string, b string")
    out = sorted(map(tuple, signed_changes(old, new, ["k"]).collect()), key=str)
    assert out == sorted([(1, "x", None, -1), (1, None, "x", 1), (2, "a", "b||c", -1), (2, "a||b", "c", 1)], key=str)
    assert signed_changes(new, new, ["k"]).count() == 0
    assert signed_changes(old.limit(0), new, ["k"]).agg(F.sum("_sign")).first()[0] == 3


def raw(spark, rows):
    """(id, date, product, quantity, client) -> raw sales."""
    full = [(i, d, "08:00:00", c, 1, p, 2.0, q, 2.0 * q, "pix", "x", "SP") for i, d, p, q, c in rows]
    schema = (
        "id_pedido bigint, data_pedido string, hora_pedido string, cliente_id bigint, loja_id bigint, produto string, "
        "preco_unitario double, quantidade bigint, valor_total double, metodo_pagamento string, cidade string, estado string"
    )
    return spark.createDataFrame(full, schema)


@pytest.fixture()
def landings():
    first = [(i, f"2024-0{1 + i % 3}-10", f"p{i % 4}", 1 + i % 5, None if i % 6 == 0 else i) for i in range(40)] + [(None, "2024-01-05", "n", 2, 1)]
    changed = [(i, d, p, q + 1, c) if i == 3 else (i, d, p, q, c) for i, d, p, q, c in first if i not in (6, 9)]
    moved = [(i, "2024-03-20" if i == 12 else d, p, q, c) for i, d, p, q, c in changed] + [(77, "2024-01-02", "new", 4, None)]
    emptied = [r for r in moved if r[2] != "new" and r[0] is not None]
    return [first, changed, moved, moved, emptied]


def test_gold_follows_every_landing(spark, tmp_dir, landings):
    versions = []
    for rows in landings:
        df = raw(spark, rows)
        paths = jobs.run_retail(spark, df, tmp_dir)
        want = sorted(map(tuple, lj.product_month(lj.silver_retail(df)).collect()), key=str)
        assert sorted(map(tuple, read_snapshot(spark, paths["gold"]).collect()), key=str) == want
        versions.append(snapshot_history(spark, paths["gold"]).first().version)
    assert versions[2] == versions[3]  # nothing new, nothing written
    silver = {v: {p.values: p.location for p in version_layout(spark, paths["silver"], v)[1]} for v in (0, 1)}
    assert [m for m in silver[0] if silver[0][m] != silver[1][m]] == [("2024", "1")]
    assert snapshot_history(spark, paths["silver"]).count() == 4  # five landings, one without a change
    for v in range(4):
        assert read_snapshot(spark, paths["silver"], v).count() == snapshot_history(spark, paths["silver"]).filter(f"version = {v}").first().num_rows
    # Landing 2 changes orders 3, 6 and 9, all of one month: the other months keep their directories.
    before, after = [{p.values: p.location for p in version_layout(spark, paths["gold"], v)[1]} for v in versions[:2]]
    assert [m for m in before if before[m] != after[m]] == [("2024", "1")]


def test_changes_of_an_interrupted_run_are_made_good(spark, tmp_dir, landings):
    from strata.sources.snapshots import write_snapshot

    paths = jobs.run_retail(spark, raw(spark, landings[0]), tmp_dir)
    write_snapshot(lj.silver_retail(raw(spark, landings[1])), paths["silver"], partition_by=["ano", "mes"])  # and then it ended
    jobs.run_retail(spark, raw(spark, landings[2]), tmp_dir)
    want = sorted(map(tuple, lj.product_month(lj.silver_retail(raw(spark, landings[2]))).collect()), key=str)
    assert sorted(map(tuple, read_snapshot(spark, paths["gold"]).collect()), key=str) == want


def test_replaced_rows_and_expired_versions(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    make = lambda rows: spark.createDataFrame(rows, "p string, k int, v int, _n int")
    gone = F.col("_n") == 0
    put = lambda rows, txn=None: replace_rows(make(rows), path, ["p", "k"], ["p"], gone, txn=txn)
    assert put([("a", 1, 1, 1), ("b", 1, 2, 1), (None, 5, 3, 1), ("a", 2, 9, 0)]) == 0
    assert put([("a", 1, 10, 1), ("a", None, 4, 1), (None, 5, 0, 0)], "t1") == 1
    assert put([("a", 1, 11, 1)], "t1") == 1 and put([]) == 1
    rows = lambda v=None: sorted(map(tuple, read_snapshot(spark, path, v).collect()), key=str)
    assert rows() == sorted([("a", 1, 10), ("a", None, 4), ("b", 1, 2)], key=str)
    assert rows(0) == sorted([("a", 1, 1), ("b", 1, 2), (None, 5, 3)], key=str)
    assert snapshot_history(spark, path).first().num_rows == 3
    assert put([("c", 1, 1, 1)]) == 2
    assert expire_snapshots(spark, path, 2) == 2 and expire_snapshots(spark, path, 2) == 0  # a and NULL of version 0; b is still listed
    assert len(rows()) == 4 and len(rows(1)) == 3
    with pytest.raises(ValueError):
        replace_rows(make([]), path, ["k"], ["p"])


def test_a_merge_rewrites_the_files_it_touches(spark, tmp_dir):
    from strata.operators.upsert import MergeConflictError
    from strata.sources.catalog import register_layers
    from strata.sources.snapshots import merge_snapshot

    path = f"{tmp_dir}/orders"
    merge_snapshot(spark.range(40).select("id", F.lit(0).alias("v")).repartitionByRange(4, "id"), path, ["id"], files=None)
    one = spark.createDataFrame([(3, 7), (100, 8), (None, 9)], "id long, v int")
    assert merge_snapshot(one, path, ["id"]) == 1
    first = {p.location for p in version_layout(spark, path, 1)[1]}
    assert len([x for x in first if "snapshot_version=0/" in x]) == 3  # one of four files was touched
    rows = {(r.id, r.v) for r in read_snapshot(spark, path).collect()}
    assert rows == {(i, 7 if i == 3 else 0) for i in range(40)} | {(100, 8), (None, 9)}
    assert snapshot_history(spark, path).first().num_rows == 42 and read_snapshot(spark, path, 0).count() == 40
    assert merge_snapshot(spark.createDataFrame([(39, 1), (200, 2)], "id long, v int"), path, ["id"]) == 2
    assert {(39, 1), (200, 2), (3, 7), (5, 0)} <= {(r.id, r.v) for r in read_snapshot(spark, path).collect()}
    with pytest.raises(MergeConflictError):
        merge_snapshot(spark.createDataFrame([(5, 1), (5, 2)], "id long, v int"), path, ["id"])
    assert expire_snapshots(spark, path, 1) == 2  # the two files of version 0 that were rewritten
    assert read_snapshot(spark, path).count() == 43
    register_layers(spark, {"merged_files": {"orders": path}})
    assert spark.table("merged_files.orders").count() == 43
    assert snapshot_history(spark, path).first().operation == "COMPACT"


def test_changes_of_dealt_tables_need_no_other_shuffle(spark, landings):
    old, new = [lj.silver_retail(raw(spark, rows)) for rows in landings[:2]]
    out = signed_changes(old, new, ["id_pedido"])
    assert sorted((r.id_pedido, r._sign) for r in out.collect()) == [(3, -1), (3, 1), (6, -1), (9, -1)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan  # one a table


def test_silver_folds_where_the_rows_lie_by_order(spark, landings):
    plan = lj.silver_retail(raw(spark, landings[0]))._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(id_pedido")
    assert 0 < plan.index("partial_min") < exchange and "Sort" not in plan[exchange:]  # no sort of an input split


def test_partitions_named_are_replaced(spark, tmp_dir):
    from strata.sources.snapshots import replace_partitions, write_snapshot

    path = f"{tmp_dir}/t"
    make = lambda rows: spark.createDataFrame(rows, "p string, k int")
    write_snapshot(make([("a", 1), ("b", 2), ("c", 3), (None, 4)]), path, partition_by=["p"])
    new = make([("a", 10), ("a", 11), ("c", 99), (None, 5)])
    assert replace_partitions(new, path, ["p"], make([])) == 0
    assert replace_partitions(new, path, ["p"], make([("a", 0), ("b", 0), (None, 0), (None, 1)])) == 1
    rows = lambda v: sorted(map(tuple, read_snapshot(spark, path, v).collect()), key=str)
    assert rows(1) == sorted([("a", 10), ("a", 11), ("c", 3), (None, 5)], key=str) and len(rows(0)) == 4
    assert snapshot_history(spark, path).first().num_rows == 4
    places = [{p.values: p.location for p in version_layout(spark, path, v)[1]} for v in (0, 1)]
    assert [m for m in places[0] if places[0][m] == places[1].get(m)] == [("c",)]


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_a_landing_leaves_no_shuffle_and_no_scratch(spark, tmp_dir, landings):
    import os
    import time

    from strata.session import scratch_dir

    jobs.run_retail(spark, raw(spark, landings[0]), tmp_dir)
    root = scratch_dir(spark).removeprefix("file:")
    scratch = {f for f in os.listdir(root) if not f.startswith("replace-source")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(setting)
    paths = jobs.run_retail(spark, raw(spark, landings[2]), tmp_dir)
    assert spark.conf.get(setting) == was
    assert {f for f in os.listdir(root) if not f.startswith("replace-source")} <= scratch
    end = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < end:  # they go in the background
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    want = sorted(map(tuple, lj.product_month(lj.silver_retail(raw(spark, landings[2]))).collect()), key=str)
    assert sorted(map(tuple, read_snapshot(spark, paths["gold"]).collect()), key=str) == want
