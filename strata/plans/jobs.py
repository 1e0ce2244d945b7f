"""Bronze -> silver -> gold as one run per domain: plain functions calling the
operators in order, each layer written under ``base`` (a shared folder in a
cluster). Inputs are DataFrames, so any source (JDBC, CSV, Parquet) feeds
them. Every layer is a versioned snapshot table (``strata.sources.snapshots``)
or a plain Parquet layer, written once; counts come from the write itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strata.operators.changes import compared, signed_changes
from strata.operators.upsert import merge_into_layer
from strata.plans import orders as lh
from strata.plans import retail as lj
from strata.plans import sales as pm
from strata.session import freed_shuffles, scratch_dir, scratch_run
from strata.sources.files import PARQUET_CODEC, write_layer
from strata.sources.snapshots import latest_version, path_exists, read_snapshot, replace_partitions, write_snapshot
from strata.streaming import streams as st


def run_orders(
    spark: SparkSession, customers: DataFrame, orders: DataFrame, base: str, as_of: str | None = None
) -> dict[str, str]:
    """Orders: bronze snapshots (customers, orders partitioned by status),
    silver orders merged on id (partitioned by country), gold country KPIs."""
    paths = {
        "bronze_customers": f"{base}/bronze/customers",
        "bronze_orders": f"{base}/bronze/orders",
        "silver": f"{base}/silver/orders_enriched",
        "gold": f"{base}/gold/country_kpis",
    }
    write_snapshot(lh.bronze(customers), paths["bronze_customers"])
    write_snapshot(lh.bronze(orders), paths["bronze_orders"], partition_by=["status"])
    bronze_c = read_snapshot(spark, paths["bronze_customers"]).drop("_ingestion_ts", "_source", "_row_hash")
    bronze_o = read_snapshot(spark, paths["bronze_orders"]).drop("_ingestion_ts", "_source", "_row_hash")
    silver = lh.enrich_orders(bronze_o, lh.clean_customers(bronze_c), as_of=as_of, stamp=True)
    merge_into_layer(silver, paths["silver"], ["id"], lh.ORDER_UPDATE_COLS, partition_by=["country"])
    write_snapshot(lh.country_kpis(read_snapshot(spark, paths["silver"]), stamp=True), paths["gold"])
    return paths


def run_daily_sales(
    spark: SparkSession, clientes: DataFrame, produtos: DataFrame, vendas: DataFrame, base: str, nanos: bool = False
) -> dict[str, str]:
    """Daily sales: bronze Parquet, silver dimensions and enriched fact, gold
    daily fact with growth."""
    paths = {name: f"{base}/{name}" for name in (
        "bronze/clientes", "bronze/produtos", "bronze/vendas",
        "silver/clientes", "silver/produtos", "silver/vendas_enriquecidas", "gold/vendas_diarias",
    )}
    for name, df in (("clientes", clientes), ("produtos", produtos), ("vendas", vendas)):
        write_layer(df, paths[f"bronze/{name}"])
    c = pm.silver_dimension(spark.read.parquet(paths["bronze/clientes"]), "clientes", nanos=nanos)
    p = pm.silver_dimension(spark.read.parquet(paths["bronze/produtos"]), "produtos", nanos=nanos)
    write_layer(c, paths["silver/clientes"])
    write_layer(p, paths["silver/produtos"])
    fact = pm.enrich_sales(spark.read.parquet(paths["bronze/vendas"]), c, p)
    write_layer(fact, paths["silver/vendas_enriquecidas"])
    gold = pm.daily_growth(pm.daily_sales(spark.read.parquet(paths["silver/vendas_enriquecidas"])))
    write_layer(gold, paths["gold/vendas_diarias"])
    return paths


GOLD_VERSIONS = 10  # versions of the retail gold whose data is kept


def _append_changes(spark: SparkSession, silver: str, changes: str, version: int) -> None:
    """Write the signed rows between each silver version and the one before it,
    for every version that has none yet (a run that ended between the two writes
    is made good by the next one)."""
    pending = []
    while version >= 0 and not path_exists(spark, f"{changes}/versao={version}/_SUCCESS"):
        pending.append(version)
        version -= 1
    for v in reversed(pending):
        new = read_snapshot(spark, silver, v)
        rows = new.withColumn("_sign", F.lit(1)) if v == 0 else signed_changes(read_snapshot(spark, silver, v - 1), new, ["id_pedido"])
        write_layer(rows, f"{changes}/versao={v}")


def _land_silver(spark: SparkSession, silver: DataFrame, path: str, changes: str) -> None:
    """Bring the silver table to ``silver`` and append its changes. After the first
    load the new rows are evaluated once and compared with the table as they come;
    what the comparison gives is written once, into the scratch folder, unchanged rows
    apart. Its signed rows are the changes, and the months they name are written again
    from its other rows; then the scratch table goes."""
    months = ["ano", "mes"]
    latest = latest_version(spark, path)
    if latest is None:
        _append_changes(spark, path, changes, write_snapshot(silver, path, partition_by=months))
        return
    _append_changes(spark, path, changes, latest)
    with scratch_run(spark, "silver-landing"):
        place = scratch_dir(spark, "compared")
        both = compared(read_snapshot(spark, path), silver, ["id_pedido"])
        both = both.withColumn("_same", F.col("_sign") == 0)
        both.write.partitionBy("_same").option("compression", PARQUET_CODEC).parquet(place)
        rows = spark.read.schema(both.schema).parquet(place)
        write_layer(rows.filter("NOT _same").select(*silver.columns, "_sign"), f"{changes}/versao={latest + 1}")
        signed = spark.read.schema(_signed(silver.schema)).parquet(f"{changes}/versao={latest + 1}")
        replace_partitions(rows.filter("_same OR _sign > 0").select(*silver.columns), path, months, signed.select(*months))


def _signed(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("_sign", IntegerType())])


def run_retail(
    spark: SparkSession, raw: DataFrame, base: str, trigger: dict | None = None, wait: bool = True
) -> dict[str, str]:
    """Retail: bronze snapshot of the raw sales, silver snapshot partitioned by
    (ano, mes), its changes as signed rows, gold product-month kept by an
    update-mode stream of the changes.

    Repeatable: corrected, new and vanished orders reach gold through their signed
    rows, which rewrite only their months; a run on the same input changes nothing.
    Each step's shuffle files go when it ends.
    """
    paths = {
        "bronze": f"{base}/bronze/vendas",
        "silver": f"{base}/silver/vendas_silver",
        "changes": f"{base}/silver/vendas_mudancas",
        "gold": f"{base}/gold/vendas_produto_mensal",
        "checkpoint": f"{base}/checkpoints/gold_vendas_produto_mensal",
    }
    with freed_shuffles(spark):
        write_snapshot(raw, paths["bronze"], operation="WRITE")
        silver = lj.silver_retail(read_snapshot(spark, paths["bronze"]))
        _land_silver(spark, silver, paths["silver"], paths["changes"])
        schema = StructType([*_signed(silver.schema).fields, StructField("versao", IntegerType())])
        stream = st.table_stream(spark, paths["changes"], schema)
        query = st.start_update(
            lj.product_month_changes(stream),
            paths["gold"],
            paths["checkpoint"],
            keys=["ano", "mes", "produto"],
            partition_by=["ano", "mes"],
            gone=F.col("_linhas") == 0,
            keep_versions=GOLD_VERSIONS,
            trigger=trigger or {"availableNow": True},
        )
        if wait:
            st.run_until_done(query)
    return paths
