"""Daily sales pipeline: dimensions, joins (plain and NULL-safe), daily fact
and day-on-day growth."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.plans import sales as pm

D = dt.date
TS = dt.datetime(2024, 1, 1, 12, 0)


@pytest.fixture()
def dims(spark):
    clientes = spark.createDataFrame(
        [(1, "Cliente 1", "cliente1@example.com", TS), (2, "Cliente 2", "cliente2@example.com", TS),
         (None, "Sem id", None, TS)],
        "id long, nome string, email string, criado_em timestamp_ntz",
    )
    produtos = spark.createDataFrame(
        [(1, "Produto A", "Categoria 1", Decimal("100.00"), TS), (2, "Produto B", "Categoria 2", Decimal("150.00"), TS)],
        "id long, nome string, categoria string, preco decimal(10,2), criado_em timestamp_ntz",
    )
    return pm.silver_dimension(clientes, "clientes"), pm.silver_dimension(produtos, "produtos")


V_SCHEMA = "id long, cliente_id long, produto_id long, quantidade int, valor_total decimal(10,2), data_venda date"


def test_enrich_seed_rows(spark, dims):
    vendas = spark.createDataFrame(
        [(1, 1, 1, 2, Decimal("200.00"), D(2024, 1, 1)), (2, 2, 2, 1, Decimal("150.00"), D(2024, 1, 1)),
         (3, 7, 1, 1, Decimal("100.00"), D(2024, 1, 2)), (4, None, 2, 1, Decimal("150.00"), D(2024, 1, 2))],
        V_SCHEMA,
    )
    out = pm.enrich_sales(vendas, *dims)
    assert out.columns == pm.SALES_COLUMN_ORDER
    rows = {r.venda_id: r for r in out.collect()}
    assert rows[1].cliente_nome == "Cliente 1" and rows[1].produto_preco == 100.0 and rows[1].valor_total == 200.0
    assert rows[3].cliente_nome is None  # no matching client: NULL, row kept
    assert rows[4].cliente_nome is None  # NULL key never matches in a plain join
    nullsafe = {r.venda_id: r for r in pm.enrich_sales(vendas, *dims, null_safe=True).collect()}
    assert nullsafe[4].cliente_nome == "Sem id"  # NULL matches NULL (pandas merge)


def test_dimension_joins_carry_no_hint(spark, dims):
    vendas = spark.createDataFrame([(1, 1, 1, 2, Decimal("200.00"), D(2024, 1, 1))], V_SCHEMA)
    plan = pm.enrich_sales(vendas, *dims)._jdf.queryExecution().analyzed().toString()
    assert "UnresolvedHint" not in plan and "ResolvedHint" not in plan


def test_money_that_is_no_decimal_counts_as_null(spark):
    silver = spark.createDataFrame(
        [(1, D(2024, 1, 1), 1, 1, 2, 1e30), (2, D(2024, 1, 1), 1, 1, 1, float("nan")), (3, D(2024, 1, 1), 1, 1, 1, 2.5)],
        "venda_id long, data_venda date, cliente_id long, produto_id long, quantidade int, valor_total double",
    )
    assert pm.daily_sales(silver).first().total_vendas_dia == 2.5


def _fact(spark, rows):
    return spark.createDataFrame(
        rows,
        "data_venda date, cliente_id long, produto_id long, total_vendas_dia double, qtd_itens_dia long, "
        "qtd_vendas_dia long, ticket_medio_dia double",
    )


def test_daily_sales_aggregates(spark):
    silver = spark.createDataFrame(
        [(1, D(2024, 1, 1), 1, 1, 2, 100.10), (1, D(2024, 1, 1), 1, 1, 1, 0.20), (2, D(2024, 1, 1), 1, 1, 3, 50.0)],
        "venda_id long, data_venda date, cliente_id long, produto_id long, quantidade int, valor_total double",
    )
    r = pm.daily_sales(silver).collect()[0]
    assert (r.total_vendas_dia, r.qtd_itens_dia, r.qtd_vendas_dia) == (150.3, 6, 2)
    assert r.ticket_medio_dia == pytest.approx(75.15)


def test_growth_ties_first_rows_and_zero(spark):
    rows = [
        (D(2024, 1, 1), 2, 1, 10.0, 1, 1, 10.0),
        (D(2024, 1, 1), 1, 1, 0.0, 1, 1, 0.0),   # same day, client 1 comes first
        (D(2024, 1, 2), None, 1, 5.0, 1, 1, 5.0),  # NULL client sorts first within the day
        (D(2024, 1, 2), 3, 1, 20.0, 1, 1, 20.0),
        (D(2024, 1, 1), 1, 2, 7.0, 1, 1, 7.0),
    ]
    out = {(r.data_venda, r.cliente_id, r.produto_id): r for r in pm.daily_growth(_fact(spark, rows)).collect()}
    a = out[(D(2024, 1, 1), 1, 1)]
    assert a.total_vendas_dia_anterior is None and a.crescimento_vs_dia_anterior is None
    b = out[(D(2024, 1, 1), 2, 1)]
    assert b.total_vendas_dia_anterior == 0.0 and b.crescimento_vs_dia_anterior is None  # previous 0 -> NULL
    c = out[(D(2024, 1, 2), None, 1)]
    assert c.total_vendas_dia_anterior == 10.0 and c.crescimento_vs_dia_anterior == pytest.approx(-0.5)
    d = out[(D(2024, 1, 2), 3, 1)]
    assert d.total_vendas_dia_anterior == 5.0 and d.crescimento_vs_dia_anterior == pytest.approx(3.0)
    assert out[(D(2024, 1, 1), 1, 2)].total_vendas_dia_anterior is None


def test_two_level_lag_equals_single_window_on_skewed_data(spark):
    # Product 1 holds most rows, a fifth have no product; gaps between days; several clients per day.
    base = spark.range(0, 3000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 97 * 3).cast("int")).alias("data_venda"),
        (F.col("id") % 13).alias("cliente_id"),
        F.when(F.col("id") % 10 < 6, F.lit(1)).when(F.col("id") % 10 > 7, F.col("id") % 5).cast("long").alias("produto_id"),
        (F.col("id") * 1.5).alias("total_vendas_dia"),
    ).dropDuplicates(["data_venda", "cliente_id", "produto_id"])
    fact = base.select("*", F.lit(1).cast("long").alias("qtd_itens_dia"), F.lit(1).cast("long").alias("qtd_vendas_dia"),
                       F.col("total_vendas_dia").alias("ticket_medio_dia"))
    a = sorted(map(tuple, pm.daily_growth(fact).collect()), key=str)
    b = sorted(map(tuple, pm.daily_growth_single_window(fact).select(*pm.daily_growth(fact).columns).collect()), key=str)
    assert a == b


def test_dealt_sales_are_shuffled_once(spark):
    import datetime as dt

    day = dt.date(2024, 1, 2)
    rows = [(day, c, p, v, 1, 10.0) for c, p, v in [(1, 1, 1), (1, 1, 1), (1, 1, 2), (None, 2, 3), (1, None, 4)]]
    silver = spark.createDataFrame(rows, "data_venda date, cliente_id long, produto_id long, venda_id long, quantidade int, valor_total double")
    out = pm.daily_sales(silver, dealt=True)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, pm.daily_sales(silver).collect()), key=str)
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange") == 1
