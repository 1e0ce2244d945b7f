"""Loads through constraints."""

import pytest
from pyspark.sql import functions as F

from strata.operators import gates
from strata.sources.snapshots import latest_version, merge_snapshot, read_snapshot, snapshot_history

SCHEMA = "id int, parent int, v double"


@pytest.fixture()
def rules(spark):
    parents = spark.createDataFrame([(1,), (2,), (None,), (1,)], "key int")
    return [
        gates.not_null("v"),
        gates.check("v not negative", F.col("v") >= 0),
        gates.foreign_key("parent", parents, "key"),
        gates.unique("id"),
    ]


ROWS = [(1, 1, 1.0), (2, None, 2.0), (3, 9, -1.0), (4, 2, None), (5, 1, 5.0), (5, 1, 6.0), (None, 1, 0.0), (None, 2, 0.0)]
REASONS = {
    (3, 9, -1.0): ["v not negative", "parent has no parent"],
    (4, 2, None): ["v is null"],
    (5, 1, 5.0): ["id not unique"],
    (5, 1, 6.0): ["id not unique"],
}


def test_rows_are_diverted_with_their_reasons(spark, tmp_dir, rules):
    path = f"{tmp_dir}/t"
    counts = gates.load_gated(spark.createDataFrame(ROWS, SCHEMA), path, rules)
    assert counts == {"accepted": 4, "rejected": 4, "v is null": 1, "v not negative": 1, "parent has no parent": 1, "id not unique": 2}
    assert sorted(map(tuple, read_snapshot(spark, path).collect()), key=str) == sorted((r for r in ROWS if r not in REASONS), key=str)
    assert {tuple(r)[:3]: r[3] for r in gates.read_rejected(spark, path).collect()} == REASONS
    assert snapshot_history(spark, path).first().num_rows == 4


def test_a_refused_load_leaves_the_table(spark, tmp_dir, rules):
    path = f"{tmp_dir}/t"
    good = spark.createDataFrame(ROWS[:2], SCHEMA)
    assert gates.load_gated(good, path, rules, divert=False)["rejected"] == 0
    with pytest.raises(gates.GateError) as e:
        gates.load_gated(spark.createDataFrame(ROWS, SCHEMA), path, rules, divert=False)
    assert e.value.counts["id not unique"] == 2 and latest_version(spark, path) == 0
    assert read_snapshot(spark, path).count() == 2 and gates.read_rejected(spark, path).count() == 0
    gates.load_gated(spark.createDataFrame(ROWS[2:4], SCHEMA), path, rules)
    assert read_snapshot(spark, path).count() == 0 and latest_version(spark, path) == 1
    assert merge_snapshot(good, path, ["id"]) == 2 and read_snapshot(spark, path).count() == 2


def test_the_rows_are_written_in_one_pass(spark, tmp_dir, rules):
    judged = gates.judged(spark.createDataFrame(ROWS, SCHEMA), rules[:3])
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2  # the rows once, the parents once
