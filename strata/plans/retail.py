"""Retail pipeline: sales CSV -> cleaned, deduplicated silver -> product-month
gold (batch or stream) -> the dashboard's slices, series, totals and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import format_card_int, format_card_money
from strata.operators.clean import cast_columns, dedupe, filter_not_null, filter_positive

# Casts of the silver step.
SILVER_CASTS = {
    "data_pedido": "date:yyyy-MM-dd",
    "preco_unitario": "decimal(10,2)",
    "valor_total": "decimal(10,2)",
    "quantidade": "int",
    "cliente_id": "int",
    "loja_id": "int",
}

# Texts of the dashboard's two cards.
CARD_REVENUE = "Receita total no período: R$ "
CARD_ITEMS = "Quantidade total de itens vendidos: "


def silver_retail(raw: DataFrame) -> DataFrame:
    """cast -> amount/quantity > 0, date and product not NULL -> one row per
    id_pedido -> year, month, weekday (1 = Sunday) -> upper payment ->
    lower(trim(product)). The NULL test comes before the trim, so a blank
    product survives as ''. An order has few copies, so the rows are dealt by
    id_pedido and lie by it afterwards."""
    df = cast_columns(raw, SILVER_CASTS)
    df = filter_positive(df, ["valor_total", "quantidade"])
    df = filter_not_null(df, ["data_pedido", "produto"])
    df = dedupe(df, ["id_pedido"], dealt=True)
    return df.withColumns(
        {
            "ano": F.year("data_pedido"),
            "mes": F.month("data_pedido"),
            "dia_semana": F.dayofweek("data_pedido"),
            "metodo_pagamento": F.upper(F.col("metodo_pagamento")),
            "produto": F.lower(F.trim(F.col("produto"))),
        }
    )


def product_month(silver: DataFrame) -> DataFrame:
    """Revenue, quantity and non-NULL client count per (year, month, product).
    The same function serves the batch and the streaming gold."""
    return silver.groupBy("ano", "mes", "produto").agg(
        F.sum("valor_total").alias("receita_total"),
        F.sum("quantidade").cast("bigint").alias("quantidade_total"),
        F.count("cliente_id").alias("qtd_linhas"),
    )


def product_month_changes(changes: DataFrame, sign: str = "_sign") -> DataFrame:
    """``product_month`` from signed silver rows: corrections and deletions take
    off what they had added. ``_linhas`` counts the rows of a group; at 0 the group
    is gone."""
    by = F.col(sign)
    return changes.groupBy("ano", "mes", "produto").agg(
        F.sum(F.col("valor_total") * by).cast("decimal(20,2)").alias("receita_total"),
        F.sum(F.col("quantidade") * by).cast("bigint").alias("quantidade_total"),
        F.sum(F.when(F.col("cliente_id").isNotNull(), by).otherwise(0)).cast("bigint").alias("qtd_linhas"),
        F.sum(by).cast("bigint").alias("_linhas"),
    )


def _newest(gold: DataFrame, col: str) -> Column:
    """Scalar subquery for the newest value of a column (the dashboard default)."""
    return gold.select(F.max(col)).scalar()


def month_slice(gold: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Rows of one (year, month); defaults to the newest year and month."""
    y = F.lit(year) if year is not None else _newest(gold, "ano")
    m = F.lit(month) if month is not None else _newest(gold, "mes")
    return gold.filter((F.col("ano") == y) & (F.col("mes") == m))


def ranked_products(gold: DataFrame, year: int | None, month: int | None, metric: str) -> DataFrame:
    """Products of one month by ``metric`` descending (ties by name)."""
    return month_slice(gold, year, month).select("produto", metric).orderBy(F.desc(metric), "produto")


def monthly_revenue(gold: DataFrame, year: int | None = None) -> DataFrame:
    """Revenue per month of one year, ordered by month."""
    y = F.lit(year) if year is not None else _newest(gold, "ano")
    return (
        gold.filter(F.col("ano") == y)
        .groupBy("mes")
        .agg(F.sum("receita_total").alias("receita_total"))
        .orderBy("mes")
    )


def period_totals(gold: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Revenue and items of one month; an empty month gives 0, not NULL."""
    return month_slice(gold, year, month).agg(
        F.coalesce(F.sum("receita_total"), F.lit(0).cast("decimal(30,2)")).alias("receita_total"),
        F.coalesce(F.sum("quantidade_total"), F.lit(0).cast("bigint")).alias("quantidade_total"),
    )


def period_cards(gold: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """The two card texts: ``1,234.50`` money and ``1,234`` item count."""
    t = period_totals(gold, year, month)
    return t.select(
        format_card_money("receita_total", CARD_REVENUE).alias("card_receita"),
        format_card_int("quantidade_total", CARD_ITEMS).alias("card_quantidade"),
    )


ROLLUP_LEVELS = {"produto": ["ano", "mes", "produto"], "mes": ["ano", "mes"], "ano": ["ano"]}


def rollup_layer(gold: DataFrame) -> DataFrame:
    """The product-month gold with its monthly and yearly totals, from one pass over
    it: rows of ``nivel`` produto, mes and ano (columns above a row's level are
    NULL). Written partitioned by ``nivel``, a slice reads one level of it."""
    grouped = gold.groupingSets(list(ROLLUP_LEVELS.values()), "ano", "mes", "produto").agg(
        F.grouping_id().alias("_id"),
        F.sum("receita_total").cast("decimal(30,2)").alias("receita_total"),
        F.sum("quantidade_total").cast("bigint").alias("quantidade_total"),
        F.sum("qtd_linhas").cast("bigint").alias("qtd_linhas"),
    )
    level = F.when(F.col("_id") == 0, "produto").when(F.col("_id") == 1, "mes").otherwise("ano")
    return grouped.withColumn("nivel", level).drop("_id")


def rollup_slice(layer: DataFrame, level: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """One level of the rollup layer, of one year or month; both filters reach the
    scan, the level's as a partition filter."""
    out = layer.filter(F.col("nivel") == level)
    if year is not None:
        out = out.filter(F.col("ano") == year)
    if month is not None:
        out = out.filter(F.col("mes") == month)
    return out.select(*ROLLUP_LEVELS[level], "receita_total", "quantidade_total", "qtd_linhas")


def filter_values(gold: DataFrame, cols: tuple[str, ...] = ("ano", "mes")) -> DataFrame:
    """Sorted distinct values of the filter columns, with the default flag
    (newest value) the dashboard preselects. One pass over the gold table:
    the (column, value) pairs are aggregated, then flagged per column."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("filtro"), F.col(c).cast("int").alias("valor")) for c in cols])
    )
    values = gold.select(pairs.alias("p")).select("p.*").distinct()
    newest = F.max("valor").over(Window.partitionBy("filtro"))
    return values.withColumn("padrao", F.col("valor") == newest).orderBy("filtro", "valor")


def layer_counts(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """Row counts of the bronze, silver and gold tables, with the silver
    computed once: the gold grouping also counts the silver rows it folds."""
    bronze = raw.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("bronze").alias("layer"), "n_rows")
    groups = silver.groupBy("ano", "mes", "produto").agg(F.count(F.lit(1)).alias("_n"))
    both = groups.agg(F.sum("_n").cast("bigint").alias("silver"), F.count(F.lit(1)).alias("gold"))
    rest = both.select(
        F.inline(
            F.array(
                F.struct(F.lit("silver").alias("layer"), F.coalesce("silver", F.lit(0).cast("bigint")).alias("n_rows")),
                F.struct(F.lit("gold").alias("layer"), F.col("gold").alias("n_rows")),
            )
        )
    )
    return bronze.unionByName(rest)


def top_products(gold: DataFrame, year: int | None = None, n: int = 10) -> DataFrame:
    """``ORDER BY mes, receita_total DESC LIMIT n`` within one year (top-k:
    each task keeps its best ``n`` rows, then one merge)."""
    y = F.lit(year) if year is not None else _newest(gold, "ano")
    return (
        gold.filter(F.col("ano") == y)
        .select("ano", "mes", "produto", "receita_total")
        .orderBy("mes", F.desc("receita_total"), "produto")
        .limit(n)
    )
