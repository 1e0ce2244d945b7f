"""Retail pipeline: silver cleaning order, product-month gold, dashboard
queries, top-k and partitioned layout."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.plans import retail as lj
from strata.sources.files import read_sales_csv, write_layer

RAW = (
    "id_pedido long, data_pedido string, hora_pedido string, cliente_id long, loja_id long, produto string, "
    "preco_unitario double, quantidade long, valor_total double, metodo_pagamento string, cidade string, estado string"
)


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_silver_steps(spark):
    rows = [
        (1, "2024-01-07", "08:00:00", 5, 1, " Arroz_5kg ", 20.0, 2, 40.0, "pix", "A", "SP"),
        (1, "2024-01-07", "09:00:00", 5, 1, " Arroz_5kg ", 20.0, 2, 40.0, "pix", "A", "SP"),  # duplicate id
        (2, "2024-13-01", "08:00:00", 5, 1, "cafe", 10.0, 1, 10.0, "pix", "A", "SP"),  # bad date
        (3, "2024-01-08", "08:00:00", 5, 1, "cafe", 10.0, 0, 10.0, "pix", "A", "SP"),  # zero quantity
        (4, "2024-01-08", "08:00:00", 5, 1, "cafe", 10.0, 1, -1.0, "pix", "A", "SP"),  # negative total
        (5, "2024-01-08", "08:00:00", 5, 1, None, 10.0, 1, 10.0, "pix", "A", "SP"),  # NULL product
        (6, "2024-01-08", "08:00:00", None, 1, "   ", 10.0, 1, None, "pix", "A", "SP"),  # NULL total
        (7, "2024-02-29", "08:00:00", None, 1, "   ", 10.0, 1, 10.0, "dinheiro", "A", "SP"),  # blank product kept
        (None, "2024-01-09", "08:00:00", 1, 1, "x", 1.0, 1, 1.0, "pix", "A", "SP"),
        (None, "2024-01-09", "07:00:00", 1, 1, "x", 1.0, 1, 1.0, "pix", "A", "SP"),  # NULL ids: one group
    ]
    out = {r.id_pedido: r for r in lj.silver_retail(_raw(spark, rows)).collect()}
    assert set(out) == {1, 7, None}
    assert out[1].hora_pedido == "08:00:00" and out[1].produto == "arroz_5kg" and out[1].metodo_pagamento == "PIX"
    assert (out[1].ano, out[1].mes, out[1].dia_semana) == (2024, 1, 1)  # 2024-01-07 is a Sunday
    assert out[1].valor_total == Decimal("40.00")
    assert out[7].produto == ""
    assert out[None].hora_pedido == "07:00:00"


@pytest.fixture()
def gold(spark):
    return spark.createDataFrame(
        [(2024, 1, "a", Decimal("10.00"), 3, 3), (2024, 1, "b", Decimal("30.00"), 1, 1),
         (2024, 2, "a", Decimal("5.00"), 9, 2), (2023, 12, "c", Decimal("1.00"), 1, 1)],
        "ano int, mes int, produto string, receita_total decimal(20,2), quantidade_total long, qtd_linhas long",
    )


def test_product_month_counts_non_null_clients(spark):
    silver = spark.createDataFrame(
        [(2024, 1, "a", Decimal("1.00"), 1, 5), (2024, 1, "a", Decimal("2.00"), 2, None)],
        "ano int, mes int, produto string, valor_total decimal(10,2), quantidade int, cliente_id int",
    )
    r = lj.product_month(silver).collect()[0]
    assert (r.receita_total, r.quantidade_total, r.qtd_linhas) == (Decimal("3.00"), 3, 1)


def test_dashboard_queries(spark, gold):
    assert [r.produto for r in lj.ranked_products(gold, 2024, 1, "receita_total").collect()] == ["b", "a"]
    assert [r.produto for r in lj.ranked_products(gold, 2024, 1, "quantidade_total").collect()] == ["a", "b"]
    assert [(r.mes, r.receita_total) for r in lj.monthly_revenue(gold, 2024).collect()] == [
        (1, Decimal("40.00")), (2, Decimal("5.00"))
    ]
    t = lj.period_totals(gold, 2024, 1).collect()[0]
    assert (t.receita_total, t.quantidade_total) == (Decimal("40.00"), 4)
    empty = lj.period_totals(gold, 2022, 5).collect()[0]
    assert (empty.receita_total, empty.quantidade_total) == (Decimal("0.00"), 0)  # empty month -> 0
    cards = lj.period_cards(gold, 2024, 1).collect()[0]
    assert cards.card_receita == "Receita total no período: R$ 40.00"
    assert cards.card_quantidade == "Quantidade total de itens vendidos: 4"
    # Defaults: newest year and newest month over all rows (2024, 12) -> empty slice.
    assert lj.month_slice(gold).count() == 0
    vals = [(r.filtro, r.valor, r.padrao) for r in lj.filter_values(gold).collect()]
    assert vals == [("ano", 2023, False), ("ano", 2024, True), ("mes", 1, False), ("mes", 2, False), ("mes", 12, True)]


def test_top_products_is_top_k(spark, gold):
    top = lj.top_products(gold, 2024, n=2)
    assert [(r.mes, r.produto) for r in top.collect()] == [(1, "b"), (1, "a")]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_csv_roundtrip_partitioned_layout_and_pruning(spark, tmp_dir):
    rows = [(i, f"2024-0{1 + i % 3}-0{1 + i % 9}", "08:00:00", i, 1, "cafe", 1.5, 1, 1.5, "pix", "A", "SP") for i in range(30)]
    raw = _raw(spark, rows)
    raw.coalesce(1).write.option("header", "true").csv(f"{tmp_dir}/raw")
    typed = read_sales_csv(spark, f"{tmp_dir}/raw", RAW)
    inferred = read_sales_csv(spark, f"{tmp_dir}/raw")
    assert typed.count() == 30 and inferred.count() == 30 and dict(inferred.dtypes)["id_pedido"] == "int"
    silver = lj.silver_retail(typed)
    write_layer(silver, f"{tmp_dir}/silver", partition_by=["ano", "mes", "nope"], files=2)
    import os

    assert sorted(os.listdir(f"{tmp_dir}/silver/ano=2024")) == ["mes=1", "mes=2", "mes=3"]
    back = spark.read.parquet(f"{tmp_dir}/silver").filter("ano = 2024 AND mes = 2")
    assert "PartitionFilters: [isnotnull(ano" in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == 10


def test_newest_month_is_that_of_all_sales(spark, tmp_dir):
    from strata.plans.queries import ORACLES, QUERIES

    line = "CAST(id AS BIGINT) l_orderkey, 7L l_partkey, 3L l_suppkey, 1 l_linenumber, 20.0D l_quantity, 10.0D l_extendedprice"
    day = "CASE WHEN id < 5 THEN TIMESTAMP '1997-12-03' ELSE TIMESTAMP '1999-12-04' END l_shipdate"
    spark.range(8).selectExpr(*line.split(", "), "'A' l_returnflag", "'F' l_linestatus", day).write.parquet(f"{tmp_dir}/lineitem.parquet")
    rows = QUERIES["month_slice_newest"](spark, tmp_dir).collect()
    assert [(r.ano, r.mes, r.quantidade_total) for r in rows] == [(1999, 12, 60)]
    assert "1998-01-01" not in ORACLES["month_slice_newest"]
