"""Orders pipeline on the seed rows of the source database, and the upsert."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators.upsert import MergeConflictError, merge_into_layer, upsert
from strata.plans import orders as lh
from strata.sources import snapshots as snap

CUSTOMERS = [
    (1, "Alice Silva", "alice@demo.com", "Brazil"),
    (2, "Bob Santos", "bob@demo.com", "Brazil"),
    (3, "Carol Oliveira", "carol@demo.com", "Argentina"),
    (4, "Dave Lima", "dave@demo.com", "Brazil"),
]
ORDERS = [
    (1, 1, "Laptop", Decimal("4500.00"), "completed", dt.date(2024, 1, 10)),
    (2, 1, "Mouse", Decimal("89.90"), "completed", dt.date(2024, 1, 11)),
    (3, 2, "Monitor", Decimal("1200.00"), "pending", dt.date(2024, 1, 12)),
    (4, 3, "Keyboard", Decimal("350.00"), "completed", dt.date(2024, 1, 13)),
    (5, 4, "Headphones", Decimal("299.90"), "cancelled", dt.date(2024, 1, 14)),
]
C_SCHEMA = "id long, name string, email string, country string"
O_SCHEMA = "id long, customer_id long, product string, amount decimal(10,2), status string, order_date date"


@pytest.fixture()
def seeds(spark):
    return spark.createDataFrame(CUSTOMERS, C_SCHEMA), spark.createDataFrame(ORDERS, O_SCHEMA)


def test_country_kpis_from_seeds(spark, seeds):
    customers, orders = seeds
    silver = lh.enrich_orders(orders, lh.clean_customers(customers), as_of="2024-02-01")
    kpis = {r.country: r for r in lh.country_kpis(silver).collect()}
    assert set(kpis) == {"Brazil", "Argentina"}
    br = kpis["Brazil"]
    assert (br.total_orders, br.total_revenue, br.avg_order_value, br.max_order_value, br.completed_orders) == (
        4, Decimal("6089.80"), Decimal("1522.450000"), Decimal("4500.00"), 2,
    )
    ar = kpis["Argentina"]
    assert (ar.total_orders, ar.total_revenue, ar.completed_orders) == (1, Decimal("350.00"), 1)
    flags = {r.id: r.is_high_value for r in silver.collect()}
    assert [k for k, v in flags.items() if v] == [1, 3]  # Laptop and Monitor
    assert {r.id: r.order_age_days for r in silver.collect()}[1] == 22


def test_kpis_count_completed_as_zero_and_skip_null_amounts(spark):
    rows = [(11, "Peru", 40.5, "cancelled"), (12, "Peru", None, "pending"), (13, None, 7.0, "completed"), (14, "Chile", 1.0, "completed")]
    gold = {r.country: r for r in lh.country_kpis(spark.createDataFrame(rows, "id long, country string, amount double, status string")).collect()}
    assert set(gold) == {"Peru", None, "Chile"}
    assert (gold["Peru"].total_orders, gold["Peru"].max_order_value, gold["Peru"].completed_orders) == (2, 40.5, 0)
    assert gold[None].completed_orders == 1


def test_enrich_drops_null_email_customers_and_null_keys(spark, seeds):
    customers, orders = seeds
    customers = customers.union(spark.createDataFrame([(5, " Zed ", None, "Chile")], C_SCHEMA))
    orders = orders.union(
        spark.createDataFrame(
            [(6, 5, "Pen", Decimal("1.00"), "completed", None), (7, None, "Cup", Decimal("2.00"), None, None)], O_SCHEMA
        )
    )
    silver = lh.enrich_orders(orders, lh.clean_customers(customers), as_of="2024-02-01")
    assert sorted(r.id for r in silver.collect()) == [1, 2, 3, 4, 5]
    assert "email" not in silver.columns and silver.columns[:7] == [
        "id", "customer_id", "order_date", "amount", "status", "customer_name", "country",
    ]


def test_order_defaults(spark):
    df = spark.createDataFrame([(1, None, None)], "id long, status string, order_date date")
    row = lh.fill_order_defaults(df, as_of="2024-03-03").collect()[0]
    assert row.status == "pending" and row.order_date == dt.date(2024, 3, 3)


T_SCHEMA = "id long, country string, amount decimal(10,2), status string"


def test_upsert_cases(spark):
    target = spark.createDataFrame(
        [(1, "Brazil", Decimal("10.00"), "pending"), (2, "Brazil", Decimal("20.00"), "pending"),
         (3, "Chile", Decimal("30.00"), "done"), (None, "Peru", Decimal("1.00"), "x")],
        T_SCHEMA,
    )
    source = spark.createDataFrame(
        [(1, "Brazil", None, "completed"),  # matched, NULL overwrites
         (2, "Argentina", Decimal("21.00"), "pending"),  # matched, changed country
         (9, "Uruguay", Decimal("90.00"), "new"),  # inserted
         (None, "Peru", Decimal("2.00"), "y")],  # NULL key never matches: inserted
        T_SCHEMA,
    )
    out = upsert(target, source, ["id"]).collect()
    rows = {(r.id, r.country, r.amount, r.status) for r in out}
    assert rows == {
        (1, "Brazil", None, "completed"),
        (2, "Argentina", Decimal("21.00"), "pending"),
        (3, "Chile", Decimal("30.00"), "done"),
        (9, "Uruguay", Decimal("90.00"), "new"),
        (None, "Peru", Decimal("1.00"), "x"),
        (None, "Peru", Decimal("2.00"), "y"),
    }


def test_upsert_update_cols_limit_what_changes(spark):
    target = spark.createDataFrame([(1, "Brazil", Decimal("10.00"), "pending")], T_SCHEMA)
    source = spark.createDataFrame([(1, "Chile", Decimal("99.00"), "completed")], T_SCHEMA)
    row = upsert(target, source, ["id"], update_cols=["status"]).collect()[0]
    assert (row.country, row.amount, row.status) == ("Brazil", Decimal("10.00"), "completed")


def test_upsert_two_source_rows_for_one_target_row_raise(spark):
    target = spark.createDataFrame([(1, "Brazil", Decimal("10.00"), "pending")], T_SCHEMA)
    source = spark.createDataFrame(
        [(1, "Brazil", Decimal("1.00"), "a"), (1, "Brazil", Decimal("2.00"), "b")], T_SCHEMA
    )
    with pytest.raises(MergeConflictError):
        upsert(target, source, ["id"])
    # Repeated keys that match nothing are inserted, as MERGE does.
    other = spark.createDataFrame([(7, "X", None, "a"), (7, "X", None, "b")], T_SCHEMA)
    assert upsert(target, other, ["id"]).count() == 3


def test_upsert_properties_random(spark):
    import random

    rnd = random.Random(7)
    t_rows = [(k, "c", Decimal(rnd.randint(1, 99)), "s") for k in rnd.sample(range(200), 80)]
    s_rows = [(k, "d", Decimal(rnd.randint(1, 99)), "u") for k in rnd.sample(range(200), 60)]
    t = spark.createDataFrame(t_rows, T_SCHEMA)
    s = spark.createDataFrame(s_rows, T_SCHEMA)
    once = upsert(t, s, ["id"])
    assert once.count() == len({r[0] for r in t_rows} | {r[0] for r in s_rows})
    twice = upsert(once, s, ["id"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))  # idempotent


def test_merge_into_layer_versions_and_time_travel(spark, tmp_dir, seeds):
    customers, orders = seeds
    path = f"{tmp_dir}/silver_orders"
    silver = lh.enrich_orders(orders, lh.clean_customers(customers), as_of="2024-02-01")
    assert merge_into_layer(silver.filter("id <= 3"), path, ["id"], partition_by=["country"]) == 0
    changed = silver.filter("id >= 3").withColumn("status", F.lit("completed"))
    assert merge_into_layer(changed, path, ["id"], partition_by=["country"]) == 1
    latest = snap.read_snapshot(spark, path)
    assert latest.columns == silver.columns  # partition column back in place
    assert latest.count() == 5 and latest.filter("status = 'cancelled'").count() == 0
    assert snap.read_snapshot(spark, path, version=0).count() == 3
    hist = [(r.version, r.operation, r.num_rows) for r in snap.snapshot_history(spark, path).collect()]
    assert hist == [(1, "MERGE", 5), (0, "WRITE", 3)]
    with pytest.raises(ValueError):
        snap.read_snapshot(spark, path, version=7)
    # Partition directories exist and a filter on them prunes.
    plan = snap.read_snapshot(spark, path).filter("country = 'Argentina'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(country" in plan


def test_snapshot_schema_replacement(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    snap.write_snapshot(spark.createDataFrame([(1, "a")], "id long, v string"), path)
    snap.write_snapshot(spark.createDataFrame([(1, 2.5, True)], "id long, x double, f boolean"), path, operation="OVERWRITE")
    assert snap.read_snapshot(spark, path).columns == ["id", "x", "f"]
    assert snap.read_snapshot(spark, path, version=0).columns == ["id", "v"]


def test_a_write_named_twice_is_committed_once(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.createDataFrame([(1,)], "id long")
    assert snap.write_snapshot(df, path, txn="q/0") == 0
    assert snap.write_snapshot(df.union(df), path, txn="q/0") == 0  # a replay changes nothing
    assert snap.write_snapshot(df.union(df), path, txn="other/0") == 1
    assert snap.read_snapshot(spark, path, 0).count() == 1 and snap.read_snapshot(spark, path).count() == 2


def test_merge_rewrites_only_touched_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/layer"
    rows = [(i, ["AR", "BR", "CL", None][i % 4], i * 10) for i in range(40)] + [(None, "AR", 1), (None, "CL", 2)]
    schema = "id long, country string, v long"
    merge_into_layer(spark.createDataFrame(rows, schema), path, ["id"], partition_by=["country"])
    # id 1 moves from BR to PE, id 4 stays in AR, 100 is new, a NULL id matches nothing.
    change = [(1, "PE", -1), (4, "AR", -4), (100, "PE", -100), (None, "AR", 3)]
    assert merge_into_layer(spark.createDataFrame(change, schema), path, ["id"], partition_by=["country"]) == 1
    want = {r for r in rows if r[0] not in (1, 4)} | set(change)
    got = [tuple(r) for r in snap.read_snapshot(spark, path).collect()]
    assert set(got) == want and len(got) == len(want) == 44
    assert [r.num_rows for r in snap.snapshot_history(spark, path).collect()] == [44, 42]
    assert snap.read_snapshot(spark, path, 0).count() == 42
    places = {p.values[0]: p.location for p in snap.version_layout(spark, path, 1)[1]}
    assert {k for k, v in places.items() if "snapshot_version=0" in v} == {"CL", None}
    assert {k for k, v in places.items() if "snapshot_version=1" in v} == {"AR", "BR", "PE"}
