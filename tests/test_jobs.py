"""End-to-end runs of the three domains on the smallest test tables."""

from strata.plans import bindings as B
from strata.plans import jobs
from strata.sources.snapshots import read_snapshot, snapshot_history

from conftest import SF_SMALL


def test_run_orders_twice_merges(spark, tmp_dir):
    c, o = B.lh_customers(spark, SF_SMALL), B.lh_orders(spark, SF_SMALL)
    paths = jobs.run_orders(spark, c, o, tmp_dir, as_of="2002-01-01")
    jobs.run_orders(spark, c, o, tmp_dir, as_of="2002-01-01")
    ops = [r.operation for r in snapshot_history(spark, paths["silver"]).collect()]
    assert ops == ["MERGE", "WRITE"]
    silver = read_snapshot(spark, paths["silver"])
    assert silver.count() == silver.select("id").distinct().count()  # a re-run adds no duplicate
    assert read_snapshot(spark, paths["gold"]).count() > 0


def test_run_daily_sales_and_retail(spark, tmp_dir):
    paths = jobs.run_daily_sales(
        spark, B.pm_clientes(spark, SF_SMALL), B.pm_produtos(spark, SF_SMALL), B.pm_vendas(spark, SF_SMALL), tmp_dir
    )
    assert spark.read.parquet(paths["gold/vendas_diarias"]).count() > 0
    rp = jobs.run_retail(spark, B.lj_vendas_raw(spark, SF_SMALL), f"{tmp_dir}/retail")
    first = sorted(map(tuple, read_snapshot(spark, rp["gold"]).collect()))
    n = read_snapshot(spark, rp["silver"]).count()
    jobs.run_retail(spark, B.lj_vendas_raw(spark, SF_SMALL), f"{tmp_dir}/retail")
    assert read_snapshot(spark, rp["silver"]).count() == n  # a second run adds nothing
    assert sorted(map(tuple, read_snapshot(spark, rp["gold"]).collect())) == first and first
