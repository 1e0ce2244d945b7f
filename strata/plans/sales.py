"""Daily sales pipeline: clientes, produtos, vendas -> enriched sales fact ->
daily fact per (day, client, product) with day-on-day growth per product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import nanos_to_timestamp, safe_ratio
from strata.operators.clean import ordered_columns

# Column order of the enriched sales fact.
SALES_COLUMN_ORDER = [
    "venda_id",
    "data_venda",
    "cliente_id",
    "cliente_nome",
    "cliente_email",
    "produto_id",
    "produto_nome",
    "produto_categoria",
    "quantidade",
    "valor_total",
    "produto_preco",
    "cliente_criado_em",
    "produto_criado_em",
]

# Fixed values: (source column, silver name, cast) of the two dimensions.
DIMENSIONS = {
    "clientes": [
        ("id", "cliente_id", None),
        ("nome", "cliente_nome", None),
        ("email", "cliente_email", None),
        ("criado_em", "cliente_criado_em", "stamp"),
    ],
    "produtos": [
        ("id", "produto_id", None),
        ("nome", "produto_nome", None),
        ("categoria", "produto_categoria", None),
        ("preco", "produto_preco", "double"),
        ("criado_em", "produto_criado_em", "stamp"),
    ],
}


def silver_dimension(df: DataFrame, name: str, nanos: bool = False) -> DataFrame:
    """The dimension ``name`` of ``DIMENSIONS`` with its silver names and casts;
    ``nanos`` when its time stamps are longs of nanoseconds."""
    out = []
    for source, silver, cast in DIMENSIONS[name]:
        value = F.col(source)
        if cast == "stamp":
            value = nanos_to_timestamp(source) if nanos else value
        elif cast:
            value = value.try_cast(cast)
        out.append(value.alias(silver))
    return df.select(*out)


def _dim_join(fact: DataFrame, dim: DataFrame, key: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return fact.join(dim, on=key, how="left")
    renamed = dim.withColumnRenamed(key, f"_dim_{key}")
    joined = fact.join(renamed, fact[key].eqNullSafe(renamed[f"_dim_{key}"]), "left")
    return joined.drop(f"_dim_{key}")


def enrich_sales(
    vendas: DataFrame,
    clientes_sl: DataFrame,
    produtos_sl: DataFrame,
    null_safe: bool = False,
) -> DataFrame:
    """Sales fact with both dimensions, left-joined.

    No hint: Catalyst and AQE broadcast a dimension when its bytes are under the
    session's threshold and shuffle both sides beyond it. ``null_safe`` matches
    NULL keys to NULL keys (the pandas-merge behaviour).
    """
    df = vendas.select(
        F.col("id").alias("venda_id"),
        "cliente_id",
        "produto_id",
        F.col("quantidade").try_cast("int").alias("quantidade"),
        F.col("valor_total").try_cast("double").alias("valor_total"),
        F.try_to_date(F.col("data_venda")).alias("data_venda"),
    )
    df = _dim_join(df, clientes_sl, "cliente_id", null_safe)
    df = _dim_join(df, produtos_sl, "produto_id", null_safe)
    return ordered_columns(df, SALES_COLUMN_ORDER)


def daily_sales(silver: DataFrame, dealt: bool = False) -> DataFrame:
    """One row per (data_venda, cliente_id, produto_id): total, items, distinct
    sales and average ticket (NULL when there is no sale).

    Money is summed as decimal and cast back to double: the exact sum, the
    same whatever order the rows arrive in. An amount that is no such decimal
    (too large, NaN, infinite) counts as NULL.

    ``dealt`` is for facts with few sales a row: they are dealt by the row's key once,
    where the distinct count would otherwise shuffle them by sale and again by row.
    """
    if dealt:
        silver = silver.repartition("data_venda", "cliente_id", "produto_id")
    base = silver.groupBy("data_venda", "cliente_id", "produto_id").agg(
        F.sum(F.col("valor_total").try_cast("decimal(18,2)")).cast("double").alias("total_vendas_dia"),
        F.sum("quantidade").cast("bigint").alias("qtd_itens_dia"),
        F.countDistinct("venda_id").alias("qtd_vendas_dia"),
    )
    return base.withColumn(
        "ticket_medio_dia",
        F.when(F.col("qtd_vendas_dia") > 0, safe_ratio("total_vendas_dia", "qtd_vendas_dia")),
    )


def daily_growth(fact: DataFrame) -> DataFrame:
    """Previous row's total per product, in (data_venda, cliente_id) order,
    and the growth against it (NULL when there is no previous row or it is 0).
    A NULL product is a product of its own, and so is a NULL day a day.

    The lag is split in two so no task holds a whole product: inside a
    product-day a window gives the previous client's total; the first row of a
    day takes the last total of the product's previous day. Those day totals
    come from a partial aggregate with one row per product-day (bounded by the
    calendar, not by the data). Window, aggregate and join share the hash
    partitioning on the product-day, which is why NULLs are made plain keys
    first.
    """
    keyed = fact.withColumns(
        {
            "_no_p": F.col("produto_id").isNull(),
            "_p": F.coalesce("produto_id", F.lit(0)),
            "_no_d": F.col("data_venda").isNull(),
            "_d": F.coalesce("data_venda", F.lit("1970-01-01").cast("date")),
        }
    )
    day = ["_no_p", "_p", "_no_d", "_d"]
    last_client = F.struct(F.col("cliente_id").isNotNull(), "cliente_id")
    totals = keyed.groupBy(*day).agg(F.max_by("total_vendas_dia", last_client).alias("_total"))
    per_product = Window.partitionBy("_no_p", "_p").orderBy(F.col("_no_d").desc(), "_d")
    before = totals.select(*day, F.lag("_total").over(per_product).alias("_day_before"))
    in_day = Window.partitionBy(*day).orderBy(F.col("cliente_id").asc_nulls_first())
    placed = keyed.withColumns(
        {"_client_before": F.lag("total_vendas_dia").over(in_day), "_place": F.row_number().over(in_day)}
    )
    joined = placed.join(before, day)
    previous = F.when(F.col("_place") == 1, F.col("_day_before")).otherwise(F.col("_client_before"))
    return _with_growth(joined.withColumn("total_vendas_dia_anterior", previous), fact.columns)


def daily_growth_after(fact: DataFrame, carry: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Growth of the days in ``fact`` and the next carry, without reading history.

    ``carry`` holds the columns of the fact for one row per product: its last one
    before these days (None before the first load). It takes part as the row
    before each product's first new one. The next carry is a partial aggregate.
    Days are loaded in order, each whole.
    """
    cols = list(fact.columns)
    old = fact.limit(0) if carry is None else carry.select(*cols)
    both = fact.withColumn("_new", F.lit(True)).unionByName(old.withColumn("_new", F.lit(False)))
    grown = daily_growth(both).filter("_new").drop("_new")
    place = F.struct(F.col("data_venda").isNotNull(), "data_venda", F.col("cliente_id").isNotNull(), "cliente_id")
    last = both.groupBy(F.col("produto_id").alias("_of")).agg(F.max_by(F.struct(*cols), place).alias("r"))
    return grown, last.select("r.*")


def _with_growth(df: DataFrame, columns: list[str]) -> DataFrame:
    before = F.col("total_vendas_dia_anterior")
    growth = safe_ratio(F.col("total_vendas_dia") - before, before)
    return df.select(*columns, before, growth.alias("crescimento_vs_dia_anterior"))


def daily_growth_single_window(fact: DataFrame) -> DataFrame:
    """The same result with one window over the whole product (the plain
    form: fewer stages, but a product's rows all go to one task)."""
    w = Window.partitionBy("produto_id").orderBy("data_venda", F.col("cliente_id").asc_nulls_first())
    return _with_growth(
        fact.withColumn("total_vendas_dia_anterior", F.lag("total_vendas_dia").over(w)), fact.columns
    )
