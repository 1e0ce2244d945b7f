"""Plan guards over every registered query: no operator that grows with the
square of the data, no row-at-a-time Python, and Python only where the
recurrence needs it (Arrow batches over partitions Spark has shuffled)."""

import pytest

import __spark_entry__ as entry
from strata.plans.queries import QUERIES

from conftest import SF_SMALL

# Operators a registered query must never plan.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")

# Queries allowed to run Python in tasks, and the operators they use.
PYTHON_OPERATORS = ("MapInPandas", "FlatMapGroupsInPandasWithState", "ArrowEvalPython")
PYTHON_QUERIES = {"smoothed_position", "stream_smoothed_position"}


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + "\n" + qe.executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"
    if name not in PYTHON_QUERIES:
        for op in PYTHON_OPERATORS:
            assert op not in plan, f"{name} runs Python ({op})"


def test_smoothing_runs_python_over_shuffled_partitions(spark):
    plan = _plan(entry.queries()["smoothed_position"](spark, SF_SMALL))
    assert "MapInPandas" in plan and "Exchange hashpartitioning(subject" in plan


def _folded_before_shuffle(plan: str, agg_prefix: str, key: str) -> bool:
    """A partial aggregate sits under the exchange on ``key``: children print
    after their parent in the tree string."""
    exchange = plan.find(f"Exchange hashpartitioning({key}")
    return exchange >= 0 and plan.find(agg_prefix, exchange) > exchange


def test_hot_keys_fold_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    from strata.operators.clean import dedupe
    from strata.operators.upsert import check_single_match
    from strata.plans import retail, sales

    # One key holds a third of the rows; every aggregation over it must be
    # partial on the map side, so the hot key costs one row per map task.
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 13 % 1000).alias("v"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("s"),
    )
    deduped = dedupe(rows, ["k"])
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert _folded_before_shuffle(plan, "partial_min", "k")
    assert deduped.count() == 20_001

    fact = spark.range(30_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("data_venda"),
        (F.col("id") % 5).alias("cliente_id"),
        F.when(F.col("id") % 3 == 0, F.lit(2)).otherwise(F.col("id") % 100).alias("produto_id"),
        F.col("id").alias("venda_id"),
        F.lit(1).alias("quantidade"),
        F.lit(10.0).alias("valor_total"),
    )
    daily = sales.daily_sales(fact)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert _folded_before_shuffle(plan, "partial_sum", "data_venda")
    assert daily.agg(F.sum("qtd_vendas_dia")).collect()[0][0] == 30_000

    silver = rows.select(
        (F.lit(2024) + F.col("k") % 2).alias("ano"), (F.col("v") % 12 + 1).alias("mes"),
        F.when(F.col("k") < 0, F.lit("arroz")).otherwise(F.lit("cafe")).alias("produto"),
        F.col("v").cast("decimal(10,2)").alias("valor_total"), F.lit(1).alias("quantidade"),
        F.col("k").alias("cliente_id"),
    )
    plan = retail.product_month(silver)._jdf.queryExecution().executedPlan().toString()
    assert _folded_before_shuffle(plan, "partial_sum", "ano")

    # The MERGE duplicate check: repeated source keys are counted partially.
    target = spark.range(10).withColumnRenamed("id", "k")
    check_single_match(target, rows.filter("k >= 0").select("k"), ["k"])
