"""Registered queries: one per operator of the inventory, each with its DuckDB
twin. Every query reads the test tables through ``strata.plans.bindings`` and
runs over whole tables.

``register(name, sql)`` pairs a Spark callable ``(spark, sf_dir) -> DataFrame``
with its oracle SQL (``None`` where SQL cannot express the operator).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from strata.plans import bindings as B
from strata.plans import orders as lh
from strata.plans.oracle import with_bindings

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None, extra_ctes: dict[str, str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_bindings(sql, extra_ctes)
        return fn

    return deco


# Fixed "today" of the registered order queries, so ages are reproducible.
AS_OF = "2002-01-01"

# --- Orders pipeline --------------------------------------------------------

_SQL_CUSTOMERS_CLEAN = """
SELECT id, trim(name) AS name, trim(upper(email)) AS email, trim(country) AS country
FROM lh_customers WHERE trim(upper(email)) IS NOT NULL
"""

_SQL_ORDERS_ENRICHED = f"""
SELECT o.id, o.customer_id, o.order_date, o.amount, o.status,
       c.name AS customer_name, c.country,
       CAST(date_diff('day', o.order_date, DATE '{AS_OF}') AS INTEGER) AS order_age_days,
       COALESCE(o.amount > 1000, false) AS is_high_value
FROM lh_orders o JOIN customers_clean c ON o.customer_id = c.id
"""

_ORDERS_CTES = {"customers_clean": _SQL_CUSTOMERS_CLEAN, "orders_enriched": _SQL_ORDERS_ENRICHED}


def _orders_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = lh.clean_customers(B.lh_customers(spark, sf_dir))
    return lh.enrich_orders(B.lh_orders(spark, sf_dir), customers, as_of=AS_OF)


@register("silver_customers_clean", "SELECT * FROM customers_clean", _ORDERS_CTES)
def q_silver_customers_clean(spark, sf_dir):
    return lh.clean_customers(B.lh_customers(spark, sf_dir))


@register("silver_orders_enriched", "SELECT * FROM orders_enriched", _ORDERS_CTES)
def q_silver_orders_enriched(spark, sf_dir):
    return _orders_enriched(spark, sf_dir)


@register(
    "gold_country_kpis",
    """
SELECT country, count(id) AS total_orders,
       CAST(sum(amount) AS DECIMAL(20,2)) AS total_revenue,
       CAST(avg(amount) AS DECIMAL(14,6)) AS avg_order_value,
       max(amount) AS max_order_value,
       CAST(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) AS BIGINT) AS completed_orders
FROM orders_enriched GROUP BY country
""",
    _ORDERS_CTES,
)
def q_gold_country_kpis(spark, sf_dir):
    return lh.country_kpis(_orders_enriched(spark, sf_dir))


@register(
    "bronze_row_hash",
    """
SELECT id, customer_id, product, amount, status, order_date, 'postgres' AS _source,
       sha256(concat_ws('||', CAST(id AS VARCHAR), CAST(customer_id AS VARCHAR), product,
                        CAST(amount AS VARCHAR), status, CAST(order_date AS VARCHAR))) AS _row_hash
FROM lh_orders
""",
)
def q_bronze_row_hash(spark, sf_dir):
    return lh.bronze(B.lh_orders(spark, sf_dir)).drop("_ingestion_ts")


@register(
    "orders_defaults",
    f"""
SELECT id, customer_id, product, amount, COALESCE(status, 'pending') AS status,
       COALESCE(order_date, DATE '{AS_OF}') AS order_date
FROM lh_orders
""",
)
def q_orders_defaults(spark, sf_dir):
    return lh.fill_order_defaults(B.lh_orders(spark, sf_dir), as_of=AS_OF)


# --- Daily sales pipeline ---------------------------------------------------

from strata.plans import sales as pm  # noqa: E402

_SQL_DIM_CLIENTES = """
SELECT id AS cliente_id, nome AS cliente_nome, email AS cliente_email, criado_em AS cliente_criado_em
FROM pm_clientes
"""
_SQL_DIM_PRODUTOS = """
SELECT id AS produto_id, nome AS produto_nome, categoria AS produto_categoria,
       CAST(preco AS DOUBLE) AS produto_preco, criado_em AS produto_criado_em
FROM pm_produtos
"""


def _sql_sales_enriched(null_safe: bool) -> str:
    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    return f"""
SELECT v.id AS venda_id, v.data_venda, v.cliente_id, c.cliente_nome, c.cliente_email,
       v.produto_id, p.produto_nome, p.produto_categoria, v.quantidade,
       CAST(v.valor_total AS DOUBLE) AS valor_total, p.produto_preco,
       c.cliente_criado_em, p.produto_criado_em
FROM pm_vendas v
LEFT JOIN dim_clientes c ON v.cliente_id {eq} c.cliente_id
LEFT JOIN dim_produtos p ON v.produto_id {eq} p.produto_id
"""


_SQL_DAILY = """
SELECT data_venda, cliente_id, produto_id,
       CAST(sum(CAST(valor_total AS DECIMAL(18,2))) AS DOUBLE) AS total_vendas_dia,
       CAST(sum(quantidade) AS BIGINT) AS qtd_itens_dia,
       count(DISTINCT venda_id) AS qtd_vendas_dia,
       CASE WHEN count(DISTINCT venda_id) > 0
            THEN CAST(sum(CAST(valor_total AS DECIMAL(18,2))) AS DOUBLE) / count(DISTINCT venda_id) END
         AS ticket_medio_dia
FROM sales_enriched GROUP BY data_venda, cliente_id, produto_id
"""

_SALES_CTES = {
    "dim_clientes": _SQL_DIM_CLIENTES,
    "dim_produtos": _SQL_DIM_PRODUTOS,
    "sales_enriched": _sql_sales_enriched(False),
    "sales_nullsafe": _sql_sales_enriched(True),
    "daily": _SQL_DAILY,
}


def _dims(spark, sf_dir):
    clientes = pm.silver_dimension(B.pm_clientes(spark, sf_dir), "clientes")
    return clientes, pm.silver_dimension(B.pm_produtos(spark, sf_dir), "produtos")


def _sales_enriched(spark, sf_dir, null_safe=False):
    clientes, produtos = _dims(spark, sf_dir)
    return pm.enrich_sales(B.pm_vendas(spark, sf_dir), clientes, produtos, null_safe=null_safe)


@register("dim_clientes", "SELECT * FROM dim_clientes", _SALES_CTES)
def q_dim_clientes(spark, sf_dir):
    return _dims(spark, sf_dir)[0]


@register("dim_produtos", "SELECT * FROM dim_produtos", _SALES_CTES)
def q_dim_produtos(spark, sf_dir):
    return _dims(spark, sf_dir)[1]


@register("silver_sales_enriched", "SELECT * FROM sales_enriched", _SALES_CTES)
def q_silver_sales_enriched(spark, sf_dir):
    return _sales_enriched(spark, sf_dir)


@register("silver_sales_nullsafe", "SELECT * FROM sales_nullsafe", _SALES_CTES)
def q_silver_sales_nullsafe(spark, sf_dir):
    return _sales_enriched(spark, sf_dir, null_safe=True)


@register("gold_daily_sales", "SELECT * FROM daily", _SALES_CTES)
def q_gold_daily_sales(spark, sf_dir):
    return pm.daily_sales(_sales_enriched(spark, sf_dir))


_SQL_GROWTH = """
SELECT *,
       lag(total_vendas_dia) OVER w AS total_vendas_dia_anterior,
       (total_vendas_dia - lag(total_vendas_dia) OVER w) / NULLIF(lag(total_vendas_dia) OVER w, 0)
         AS crescimento_vs_dia_anterior
FROM daily
WINDOW w AS (PARTITION BY produto_id ORDER BY data_venda, cliente_id NULLS FIRST)
"""


@register("gold_daily_growth", _SQL_GROWTH, _SALES_CTES)
def q_gold_daily_growth(spark, sf_dir):
    return pm.daily_growth(pm.daily_sales(_sales_enriched(spark, sf_dir)))


# --- Audits -----------------------------------------------------------------

from strata.operators import audit  # noqa: E402

_ORDER_COLS = ["id", "customer_id", "product", "amount", "status", "order_date"]


@register(
    "audit_not_null",
    " UNION ALL ".join(
        f"SELECT 'orders' AS table_name, '{c}' AS column_name, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS null_rows, count(*) AS total_rows FROM lh_orders"
        for c in _ORDER_COLS
    ),
)
def q_audit_not_null(spark, sf_dir):
    return audit.audit_not_null(B.lh_orders(spark, sf_dir), _ORDER_COLS, table="orders")


@register(
    "audit_unique",
    "SELECT id, count(*) AS n_rows FROM pm_vendas WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1",
)
def q_audit_unique(spark, sf_dir):
    return audit.audit_unique(B.pm_vendas(spark, sf_dir), ["id"])


@register(
    "audit_fk",
    """
SELECT v.* FROM pm_vendas v
WHERE v.cliente_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM pm_clientes c WHERE c.id = v.cliente_id)
""",
)
def q_audit_fk(spark, sf_dir):
    return audit.audit_foreign_key(B.pm_vendas(spark, sf_dir), "cliente_id", B.pm_clientes(spark, sf_dir), "id")


# --- Retail pipeline --------------------------------------------------------

from strata.operators.clean import dedupe, head_rows  # noqa: E402
from strata.plans import retail as lj  # noqa: E402

_RAW_COLS = [
    "id_pedido", "data_pedido", "hora_pedido", "cliente_id", "loja_id", "produto",
    "preco_unitario", "quantidade", "valor_total", "metodo_pagamento", "cidade", "estado",
]
_RAW_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _RAW_COLS[1:])

_SQL_RETAIL_TYPED = """
SELECT id_pedido,
       CAST(try_strptime(data_pedido, '%Y-%m-%d') AS DATE) AS data_pedido,
       hora_pedido,
       TRY_CAST(cliente_id AS INTEGER) AS cliente_id,
       TRY_CAST(loja_id AS INTEGER) AS loja_id,
       produto,
       TRY_CAST(preco_unitario AS DECIMAL(10,2)) AS preco_unitario,
       TRY_CAST(quantidade AS INTEGER) AS quantidade,
       TRY_CAST(valor_total AS DECIMAL(10,2)) AS valor_total,
       metodo_pagamento, cidade, estado
FROM lj_vendas_raw
"""
_SQL_RETAIL_SILVER = f"""
SELECT id_pedido, data_pedido, hora_pedido, cliente_id, loja_id, lower(trim(produto)) AS produto,
       preco_unitario, quantidade, valor_total, upper(metodo_pagamento) AS metodo_pagamento,
       cidade, estado,
       CAST(year(data_pedido) AS INTEGER) AS ano, CAST(month(data_pedido) AS INTEGER) AS mes,
       CAST(dayofweek(data_pedido) + 1 AS INTEGER) AS dia_semana
FROM retail_typed
WHERE valor_total > 0 AND quantidade > 0 AND data_pedido IS NOT NULL AND produto IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY id_pedido ORDER BY {_RAW_ORDER}) = 1
"""
_SQL_RETAIL_GOLD = """
SELECT ano, mes, produto,
       CAST(sum(valor_total) AS DECIMAL(20,2)) AS receita_total,
       CAST(sum(quantidade) AS BIGINT) AS quantidade_total,
       count(cliente_id) AS qtd_linhas
FROM retail_silver GROUP BY ano, mes, produto
"""
_RETAIL_CTES = {
    "retail_typed": _SQL_RETAIL_TYPED,
    "retail_silver": _SQL_RETAIL_SILVER,
    "retail_gold": _SQL_RETAIL_GOLD,
}

# Dashboard selection of the registered slice queries.
YEAR, MONTH = 1998, 6


def _retail_silver(spark, sf_dir):
    return lj.silver_retail(B.lj_vendas_raw(spark, sf_dir))


def _retail_gold(spark, sf_dir):
    return lj.product_month(_retail_silver(spark, sf_dir))


_LAYERS: dict[tuple[str, str], str] = {}


def _gold_layer(spark, sf_dir) -> DataFrame:
    """The retail gold with its rollups, written once a session as a layer that the
    dashboard's slices read, as the jobs and the dashboard do."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAYERS or not snap.path_exists(spark, _LAYERS[key]):
        path = scratch_dir(spark, "gold_vendas_rollup")
        write_layer(lj.rollup_layer(_retail_gold(spark, sf_dir)), path, partition_by=["nivel"])
        _LAYERS[key] = path
    return spark.read.parquet(_LAYERS[key])


def _gold_slices(spark, sf_dir) -> DataFrame:
    """Product-month rows of the gold layer."""
    gold = lj.rollup_slice(_gold_layer(spark, sf_dir), "produto")
    return gold.withColumn("receita_total", F.col("receita_total").cast("decimal(20,2)"))


def _month_totals(spark, sf_dir) -> DataFrame:
    """Monthly rows of the gold layer, money as in the gold."""
    months = lj.rollup_slice(_gold_layer(spark, sf_dir), "mes")
    return months.withColumn("receita_total", F.col("receita_total").cast("decimal(20,2)"))


@register("silver_retail_clean", "SELECT * FROM retail_silver", _RETAIL_CTES)
def q_silver_retail_clean(spark, sf_dir):
    return _retail_silver(spark, sf_dir)


@register(
    "dedupe_sales",
    f"SELECT * FROM lj_vendas_raw QUALIFY row_number() OVER (PARTITION BY id_pedido ORDER BY {_RAW_ORDER}) = 1",
)
def q_dedupe_sales(spark, sf_dir):
    return dedupe(B.lj_vendas_raw(spark, sf_dir), ["id_pedido"])


@register("gold_product_month", "SELECT * FROM retail_gold", _RETAIL_CTES)
def q_gold_product_month(spark, sf_dir):
    return _retail_gold(spark, sf_dir)


@register("month_slice", f"SELECT * FROM retail_gold WHERE ano = {YEAR} AND mes = {MONTH}", _RETAIL_CTES)
def q_month_slice(spark, sf_dir):
    return lj.month_slice(_gold_slices(spark, sf_dir), YEAR, MONTH)


@register(
    "products_by_revenue",
    f"SELECT produto, receita_total FROM retail_gold WHERE ano = {YEAR} AND mes = {MONTH}",
    _RETAIL_CTES,
)
def q_products_by_revenue(spark, sf_dir):
    return lj.ranked_products(_gold_slices(spark, sf_dir), YEAR, MONTH, "receita_total")


@register(
    "products_by_quantity",
    f"SELECT produto, quantidade_total FROM retail_gold WHERE ano = {YEAR} AND mes = {MONTH}",
    _RETAIL_CTES,
)
def q_products_by_quantity(spark, sf_dir):
    return lj.ranked_products(_gold_slices(spark, sf_dir), YEAR, MONTH, "quantidade_total")


@register(
    "monthly_revenue",
    f"SELECT mes, CAST(sum(receita_total) AS DECIMAL(30,2)) AS receita_total FROM retail_gold "
    f"WHERE ano = {YEAR} GROUP BY mes",
    _RETAIL_CTES,
)
def q_monthly_revenue(spark, sf_dir):
    months = lj.rollup_slice(_gold_layer(spark, sf_dir), "mes", YEAR)
    return months.select("mes", "receita_total").orderBy("mes")


_SQL_PERIOD = f"""
SELECT COALESCE(CAST(sum(receita_total) AS DECIMAL(30,2)), 0) AS receita_total,
       COALESCE(CAST(sum(quantidade_total) AS BIGINT), 0) AS quantidade_total
FROM retail_gold WHERE ano = {YEAR} AND mes = {MONTH}
"""


@register("period_totals", _SQL_PERIOD, _RETAIL_CTES)
def q_period_totals(spark, sf_dir):
    return lj.period_totals(_month_totals(spark, sf_dir), YEAR, MONTH)


@register(
    "period_cards",
    """
SELECT 'Receita total no período: R$ ' || format('{:,.2f}', receita_total) AS card_receita,
       'Quantidade total de itens vendidos: ' || format('{:,}', quantidade_total) AS card_quantidade
FROM period
""",
    {**_RETAIL_CTES, "period": _SQL_PERIOD},
)
def q_period_cards(spark, sf_dir):
    return lj.period_cards(_month_totals(spark, sf_dir), YEAR, MONTH)


@register(
    "filter_values",
    """
SELECT 'ano' AS filtro, CAST(ano AS INTEGER) AS valor, ano = (SELECT max(ano) FROM retail_gold) AS padrao
FROM retail_gold GROUP BY ano
UNION ALL
SELECT 'mes' AS filtro, CAST(mes AS INTEGER) AS valor, mes = (SELECT max(mes) FROM retail_gold) AS padrao
FROM retail_gold GROUP BY mes
""",
    _RETAIL_CTES,
)
def q_filter_values(spark, sf_dir):
    return lj.filter_values(_month_totals(spark, sf_dir))


@register(
    "top_products",
    f"SELECT ano, mes, produto, receita_total FROM retail_gold WHERE ano = {YEAR} "
    f"ORDER BY mes, receita_total DESC, produto LIMIT 10",
    _RETAIL_CTES,
)
def q_top_products(spark, sf_dir):
    return lj.top_products(_gold_slices(spark, sf_dir), YEAR, 10)


# Fixed value: rows kept by the CSV reduction step.
HEAD_ROWS = 300_000


def _sql_head(n: int) -> str:
    return f"SELECT * FROM lj_vendas_raw ORDER BY id_pedido, {_RAW_ORDER} LIMIT {n}"


@register("head_rows", _sql_head(HEAD_ROWS))
def q_head_rows(spark, sf_dir):
    return head_rows(B.lj_vendas_raw(spark, sf_dir), HEAD_ROWS, _RAW_COLS)


# A cut inside every test table, and the preview of five rows.
HEAD_CUT, PREVIEW_ROWS = 3_000, 5


@register("head_rows_cut", _sql_head(HEAD_CUT))
def q_head_rows_cut(spark, sf_dir):
    return head_rows(B.lj_vendas_raw(spark, sf_dir), HEAD_CUT, _RAW_COLS)


@register("preview_rows", _sql_head(PREVIEW_ROWS))
def q_preview_rows(spark, sf_dir):
    return head_rows(B.lj_vendas_raw(spark, sf_dir), PREVIEW_ROWS, _RAW_COLS)


@register(
    "row_counts",
    """
SELECT 'bronze' AS layer, count(*) AS n_rows FROM lj_vendas_raw
UNION ALL SELECT 'silver' AS layer, count(*) AS n_rows FROM retail_silver
UNION ALL SELECT 'gold' AS layer, count(*) AS n_rows FROM retail_gold
""",
    _RETAIL_CTES,
)
def q_row_counts(spark, sf_dir):
    raw = B.lj_vendas_raw(spark, sf_dir)
    return lj.layer_counts(raw, lj.silver_retail(raw))


# Tables, keys and amounts of the three-table scan.
SCANNED = {
    "customer": ("c_custkey", "c_acctbal"),
    "orders": ("o_orderkey", "o_totalprice"),
    "lineitem": ("l_orderkey", "l_extendedprice"),
}


@register(
    "scan_parquet",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {k} AS row_key, {v} AS amount FROM {t}" for t, (k, v) in SCANNED.items()
    ),
)
def q_scan_parquet(spark, sf_dir):
    """Three whole tables, two columns read of each."""
    from functools import reduce

    from strata.sources.files import read_layer

    scans = [
        read_layer(spark, sf_dir, f"{t}.parquet").select(
            F.lit(t).alias("table_name"), F.col(k).alias("row_key"), F.col(v).alias("amount")
        )
        for t, (k, v) in SCANNED.items()
    ]
    return reduce(DataFrame.unionByName, scans)


# --- Upsert and versioned layers ---------------------------------------------

from strata.operators.upsert import merge_into_layer, upsert  # noqa: E402
from strata.session import scratch_dir  # noqa: E402
from strata.sources import snapshots as snap  # noqa: E402

# The silver table is loaded twice: orders up to 1998, then a later extract
# from 1998 on where pending orders were completed and orders without a status
# lost their amount. 1998 is in both loads, so those ids are matched.
FIRST_LOAD_BEFORE = "1999-01-01"
SECOND_LOAD_FROM = "1998-01-01"

_SQL_LOADS = {
    "load_first": f"""
SELECT * REPLACE (CASE WHEN customer_id % 97 = 0 THEN NULL ELSE id END AS id)
FROM orders_enriched WHERE order_date < DATE '{FIRST_LOAD_BEFORE}'
""",
    "load_second": f"""
SELECT CASE WHEN customer_id % 97 = 0 THEN NULL ELSE id END AS id, customer_id, order_date,
       CASE WHEN status IS NULL THEN NULL ELSE amount END AS amount,
       CASE WHEN status = 'pending' THEN 'completed' ELSE status END AS status,
       customer_name, country, order_age_days, is_high_value
FROM orders_enriched WHERE order_date >= DATE '{SECOND_LOAD_FROM}' OR order_date IS NULL
""",
    "merged": """
SELECT COALESCE(t.id, s.id) AS id,
       CASE WHEN s._in THEN s.customer_id ELSE t.customer_id END AS customer_id,
       CASE WHEN s._in THEN s.order_date ELSE t.order_date END AS order_date,
       CASE WHEN s._in THEN s.amount ELSE t.amount END AS amount,
       CASE WHEN s._in THEN s.status ELSE t.status END AS status,
       CASE WHEN s._in THEN s.customer_name ELSE t.customer_name END AS customer_name,
       CASE WHEN s._in THEN s.country ELSE t.country END AS country,
       CASE WHEN s._in THEN s.order_age_days ELSE t.order_age_days END AS order_age_days,
       CASE WHEN s._in THEN s.is_high_value ELSE t.is_high_value END AS is_high_value
FROM load_first t FULL OUTER JOIN (SELECT *, true AS _in FROM load_second) s ON t.id = s.id
""",
}
_LOAD_CTES = {**_ORDERS_CTES, **_SQL_LOADS}


def _order_loads(spark, sf_dir):
    enriched = _orders_enriched(spark, sf_dir)
    # Some ids are NULL: such rows match nothing and must survive.
    enriched = enriched.withColumn("id", F.when(F.col("customer_id") % 97 != 0, F.col("id")))
    first = enriched.filter(F.col("order_date") < F.lit(FIRST_LOAD_BEFORE).cast("date"))
    second = enriched.filter(
        (F.col("order_date") >= F.lit(SECOND_LOAD_FROM).cast("date")) | F.col("order_date").isNull()
    ).withColumns(
        {
            "amount": F.when(F.col("status").isNull(), F.lit(None)).otherwise(F.col("amount")),
            "status": F.when(F.col("status") == "pending", "completed").otherwise(F.col("status")),
        }
    )
    return first, second


def _update_cols(df):
    return [c for c in lh.ORDER_UPDATE_COLS if c in df.columns]


@register("upsert_orders", "SELECT * FROM merged", _LOAD_CTES)
def q_upsert_orders(spark, sf_dir):
    first, second = _order_loads(spark, sf_dir)
    return upsert(first, second, ["id"], _update_cols(first))


def _orders_layer(spark, sf_dir) -> str:
    """Write the two loads into a fresh versioned silver table (partitioned by
    country) through ``merge_into_layer``; return its path."""
    path = scratch_dir(spark, "silver_orders_enriched")
    first, second = _order_loads(spark, sf_dir)
    merge_into_layer(first, path, ["id"], _update_cols(first), partition_by=["country"])
    merge_into_layer(second, path, ["id"], _update_cols(first), partition_by=["country"])
    return path


@register("scan_snapshot", "SELECT * FROM merged", _LOAD_CTES)
def q_scan_snapshot(spark, sf_dir):
    return snap.read_snapshot(spark, _orders_layer(spark, sf_dir))


@register("snapshot_v0", "SELECT * FROM load_first", _LOAD_CTES)
def q_snapshot_v0(spark, sf_dir):
    return snap.read_snapshot(spark, _orders_layer(spark, sf_dir), version=0)


@register(
    "snapshot_history",
    """
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, (SELECT count(*) FROM load_first) AS num_rows
UNION ALL
SELECT CAST(1 AS BIGINT) AS version, 'MERGE' AS operation, (SELECT count(*) FROM merged) AS num_rows
""",
    _LOAD_CTES,
)
def q_snapshot_history(spark, sf_dir):
    return snap.snapshot_history(spark, _orders_layer(spark, sf_dir)).select("version", "operation", "num_rows")


# --- Streams -------------------------------------------------------------------

from strata.sources.files import write_json_lines, write_layer  # noqa: E402
from strata.streaming import streams as st  # noqa: E402

# Landing layout of the order stream: JSON files landed (more than one
# trigger's worth, so the files-per-trigger limit is exercised).
LANDING_FILES = 24


@register(
    "stream_orders_append",
    """
SELECT event_id AS order_id, user_id AS customer_id, event_type AS product,
       CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount,
       CASE WHEN event_type = 'purchase' THEN 'completed' ELSE 'pending' END AS status,
       ts AS event_time, 'stream' AS _source
FROM events
""",
)
def q_stream_orders_append(spark, sf_dir):
    """JSON order files -> stamped, watermarked stream -> Parquet append sink
    (10 files per trigger, drained with availableNow)."""
    landing = scratch_dir(spark, "landing_orders")
    sink = scratch_dir(spark, "bronze_orders_stream")
    write_json_lines(B.order_event_lines(spark, sf_dir), landing, files=LANDING_FILES)
    query = st.start_append(
        st.orders_stream(spark, landing), sink, f"{sink}_checkpoint", trigger={"availableNow": True}
    )
    st.run_until_done(query)
    out = spark.read.schema(query_schema_of_sink()).parquet(sink)
    return st.event_time_ntz(out).drop("_ingestion_ts")


def query_schema_of_sink():
    return StructType(
        list(st.ORDER_EVENT_SCHEMA.fields)
        + [StructField("_ingestion_ts", TimestampType(), True), StructField("_source", StringType(), True)]
    )


@register("stream_product_month", "SELECT * FROM retail_gold", _RETAIL_CTES)
def q_stream_product_month(spark, sf_dir):
    """Silver retail rows appended as files -> streaming product-month
    aggregate in complete mode -> one gold snapshot per batch; returns the
    newest snapshot."""
    silver_path = scratch_dir(spark, "silver_vendas")
    gold_path = scratch_dir(spark, "gold_vendas_produto_mensal")
    silver = _retail_silver(spark, sf_dir)
    write_layer(silver, silver_path, partition_by=["ano", "mes"])
    stream = st.table_stream(spark, silver_path, silver.schema)
    query = st.start_complete(
        lj.product_month(stream), gold_path, f"{gold_path}_checkpoint", trigger={"availableNow": True}
    )
    st.run_until_done(query)
    return snap.read_snapshot(spark, gold_path)


# --- Synthetic sales -------------------------------------------------------------

from strata.sources import synthetic as syn  # noqa: E402


def _sql_synthetic(key: str = "o_orderkey", seed: int = 42) -> str:
    def d(stream: int) -> str:
        block, place = divmod(stream - 1, syn.DRAWS_A_HASH)
        return f"CAST('0x' || substr(sha256(concat_ws(':', CAST({key} AS VARCHAR), '{seed}', '{block}')), {1 + 8 * place}, 8) AS BIGINT)"

    def lst(vals) -> str:
        return "[" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in vals) + "]"

    lo = lst([round(p[1] * 100) for p in syn.PRODUCTS])
    hi = lst([round(p[2] * 100) for p in syn.PRODUCTS])
    prod = f"({d(1)} % {len(syn.PRODUCTS)})"
    price = f"({lo}[{prod} + 1] + {d(2)} % ({hi}[{prod} + 1] - {lo}[{prod} + 1] + 1))"
    qty = f"({d(3)} % 10 + 1)"
    return f"""
SELECT {key} AS id_pedido,
       strftime(DATE '{syn.FIRST_DAY}' + CAST({d(5)} % {syn.N_DAYS} AS INTEGER), '%Y-%m-%d') AS data_pedido,
       lpad(CAST({d(6)} % 15 + 8 AS VARCHAR), 2, '0') || ':' || lpad(CAST({d(7)} % 60 AS VARCHAR), 2, '0') || ':00'
         AS hora_pedido,
       {d(8)} % {syn.N_CLIENTS} + 1 AS cliente_id,
       {d(9)} % {syn.N_SHOPS} + 1 AS loja_id,
       {lst([p[0] for p in syn.PRODUCTS])}[{prod} + 1] AS produto,
       CAST(CAST({price} AS DECIMAL(10,0)) * 0.01 AS DECIMAL(10,2)) AS preco_unitario,
       {qty} AS quantidade,
       CAST(CAST({price} * {qty} AS DECIMAL(12,0)) * 0.01 AS DECIMAL(12,2)) AS valor_total,
       {lst(syn.PAYMENT_METHODS)}[{d(4)} % {len(syn.PAYMENT_METHODS)} + 1] AS metodo_pagamento,
       'Cidade ' || CAST({d(10)} % {syn.N_CITIES} + 1 AS VARCHAR) AS cidade,
       {lst(syn.STATES)}[{d(11)} % {len(syn.STATES)} + 1] AS estado
FROM orders
"""


@register("synthetic_sales", _sql_synthetic())
def q_synthetic_sales(spark, sf_dir):
    """One synthetic retail sale per order key."""
    return syn.synthetic_sales(B.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", seed=42)


# --- Landmarks -------------------------------------------------------------------

from strata.operators import landmarks as lm  # noqa: E402


def _features(spark, sf_dir):
    return lm.frame_features(B.landmark_frames(spark, sf_dir), B.landmarks(spark, sf_dir))


def _sql_features() -> str:
    cols = [
        "COALESCE(bool_or(l.part = 'pose'), false) AS has_pose",
        "COALESCE(bool_or(l.part = 'face'), false) AS has_face",
        "COALESCE(bool_or(l.part = 'hand' AND l.label = 'Left'), false) AS has_left",
        "COALESCE(bool_or(l.part = 'hand' AND l.label = 'Right'), false) AS has_right",
    ]
    for lid in lm._POSE_IDS:
        cols += [f"max(l.{c}) FILTER (WHERE l.part = 'pose' AND l.landmark_id = {lid}) AS pose_{lid}_{c}" for c in "xy"]
    for lid in lm._FACE_IDS:
        cols += [f"max(l.{c}) FILTER (WHERE l.part = 'face' AND l.landmark_id = {lid}) AS face_{lid}_{c}" for c in "xy"]
    for side, ids, label in (("left", lm._LEFT_IDS, "Left"), ("right", lm._RIGHT_IDS, "Right")):
        for lid in ids:
            cols += [
                f"arg_min(l.{c}, l.detection_idx) FILTER (WHERE l.part = 'hand' AND l.label = '{label}' "
                f"AND l.landmark_id = {lid}) AS {side}_{lid}_{c}"
                for c in "xy"
            ]
    return (
        "SELECT f.subject, f.frame_no, f.w, f.h, " + ",\n       ".join(cols) + "\n"
        "FROM landmark_frames f LEFT JOIN landmarks l ON f.subject = l.subject AND f.frame_no = l.frame_no\n"
        "GROUP BY f.subject, f.frame_no, f.w, f.h"
    )


def _sql_dist(pa, a, pb, b, truncate=True):
    if truncate:
        dx = f"(trunc({pb}_{b}_x * w) - trunc({pa}_{a}_x * w))"
        dy = f"(trunc({pb}_{b}_y * h) - trunc({pa}_{a}_y * h))"
    else:
        dx = f"(({pa}_{a}_x - {pb}_{b}_x) * w)"
        dy = f"(({pa}_{a}_y - {pb}_{b}_y) * h)"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


_W = _sql_dist("face", lm.MOUTH_LEFT, "face", lm.MOUTH_RIGHT)
_H = _sql_dist("face", lm.MOUTH_TOP, "face", lm.MOUTH_BOTTOM)
_FINGERS = (
    "CASE WHEN has_left THEN "
    + " + ".join(f"CASE WHEN left_{t}_y < left_{j}_y THEN 1 ELSE 0 END" for t, j in lm.FINGER_PAIRS)
    + " ELSE 0 END"
)
_SQL_VISIBLE = f"""
SELECT subject, frame_no, visivel,
       CASE WHEN visivel THEN CAST(trunc(left_{lm.MIDDLE_MCP}_x * w) AS INTEGER) END AS cx_raw,
       CASE WHEN visivel THEN CAST(trunc(left_{lm.MIDDLE_MCP}_y * h) AS INTEGER) END AS cy_raw
FROM (SELECT *, has_left AND ({_FINGERS}) >= {lm.OPEN_HAND_FINGERS} AS visivel FROM features)
"""
_SQL_SMOOTH = """-- recursive
SELECT subject, frame_no, cx_raw AS cx, cy_raw AS cy, run_start, rn FROM runs WHERE rn = 1
UNION ALL
SELECT q.subject, q.frame_no,
       CAST(trunc(0.25 * q.cx_raw + 0.75 * sm.cx) AS INTEGER),
       CAST(trunc(0.25 * q.cy_raw + 0.75 * sm.cy) AS INTEGER),
       q.run_start, q.rn
FROM smooth sm JOIN runs q
  ON q.subject = sm.subject AND q.run_start IS NOT DISTINCT FROM sm.run_start AND q.rn = sm.rn + 1
"""
_SQL_RUNS = """
SELECT subject, frame_no, cx_raw, cy_raw, run_start,
       row_number() OVER (PARTITION BY subject, run_start ORDER BY frame_no) AS rn
FROM (SELECT *, max(CASE WHEN NOT visivel THEN frame_no END)
                  OVER (PARTITION BY subject ORDER BY frame_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                  AS run_start
      FROM visible) WHERE visivel
"""
_LM_CTES = {"features": _sql_features(), "visible": _SQL_VISIBLE, "runs": _SQL_RUNS, "smooth": _SQL_SMOOTH}


@register(
    "first_hand_per_label",
    "SELECT subject, frame_no, label, min(detection_idx) AS detection_idx FROM landmarks "
    "WHERE part = 'hand' GROUP BY subject, frame_no, label",
)
def q_first_hand_per_label(spark, sf_dir):
    return lm.first_hand_per_label(B.landmarks(spark, sf_dir))


@register(
    "pixel_distance",
    f"SELECT subject, frame_no, {_W} AS largura_boca, {_H} AS altura_boca FROM features WHERE has_face",
    _LM_CTES,
)
def q_pixel_distance(spark, sf_dir):
    return lm.mouth_distances(_features(spark, sf_dir))


@register(
    "expression_label",
    f"""
SELECT subject, frame_no,
       CASE WHEN NOT has_face THEN '{lm.NO_FACE}'
            WHEN {_W} = 0 THEN '{lm.NEUTRAL}'
            WHEN {_H} / {_W} > {lm.SURPRISE_RATIO} THEN '{lm.SURPRISED}'
            WHEN {_W} > {lm.SMILE_WIDTH_PX} AND {_H} / {_W} > {lm.SMILE_RATIO} THEN '{lm.HAPPY}'
            ELSE '{lm.NEUTRAL}' END AS expressao
FROM features
""",
    _LM_CTES,
)
def q_expression_label(spark, sf_dir):
    return lm.expression_label(_features(spark, sf_dir))


def _sql_movements() -> str:
    checks = [
        (f"pose_{lm.LEFT_WRIST}_y < pose_{lm.LEFT_SHOULDER}_y", lm.LEFT_HAND_UP),
        (f"pose_{lm.RIGHT_WRIST}_y < pose_{lm.RIGHT_SHOULDER}_y", lm.RIGHT_HAND_UP),
        (f"{_sql_dist('pose', lm.LEFT_WRIST, 'pose', lm.RIGHT_WRIST)} > w * {lm.ARMS_OPEN_FRACTION}", lm.ARMS_OPEN),
        (f"{_sql_dist('pose', lm.LEFT_WRIST, 'pose', lm.RIGHT_SHOULDER)} < w * {lm.ARM_CROSSED_FRACTION}",
         lm.LEFT_ARM_CROSSED),
        (f"{_sql_dist('pose', lm.RIGHT_WRIST, 'pose', lm.LEFT_SHOULDER)} < w * {lm.ARM_CROSSED_FRACTION}",
         lm.RIGHT_ARM_CROSSED),
    ]
    arr = "[" + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in checks) + "]"
    return f"""
SELECT subject, frame_no,
       CASE WHEN NOT has_pose THEN ['{lm.NO_BODY}']
            WHEN len(found) = 0 THEN ['{lm.NEUTRAL_POSE}'] ELSE found END AS movimentos
FROM (SELECT *, list_filter({arr}, lambda v: v IS NOT NULL) AS found FROM features)
"""


@register("movement_labels", _sql_movements(), _LM_CTES)
def q_movement_labels(spark, sf_dir):
    return lm.movement_labels(_features(spark, sf_dir))


@register(
    "raised_fingers",
    f"SELECT subject, frame_no, {_FINGERS} AS dedos_levantados, ({_FINGERS}) >= {lm.OPEN_HAND_FINGERS} AS mao_aberta "
    f"FROM features",
    _LM_CTES,
)
def q_raised_fingers(spark, sf_dir):
    return lm.raised_fingers(_features(spark, sf_dir))


_PINCH = _sql_dist("right", lm.THUMB_TIP, "right", lm.INDEX_TIP, truncate=False)


@register(
    "pinch_scale",
    f"""
SELECT subject, frame_no,
       CASE WHEN has_right THEN greatest({lm.PINCH_MIN}, least({_PINCH} / {lm.PINCH_DIVISOR}, {lm.PINCH_MAX}))
            ELSE {lm.PINCH_DEFAULT} END AS escala
FROM features
""",
    _LM_CTES,
)
def q_pinch_scale(spark, sf_dir):
    return lm.pinch_scale(_features(spark, sf_dir))


@register("visible_frames", "SELECT * FROM visible", _LM_CTES)
def q_visible_frames(spark, sf_dir):
    return lm.visible_frames(_features(spark, sf_dir))


@register("smoothed_position", "SELECT subject, frame_no, cx, cy FROM smooth", _LM_CTES)
def q_smoothed_position(spark, sf_dir):
    return lm.smoothed_position(lm.visible_frames(_features(spark, sf_dir)))


def _sql_pairs() -> str:
    parts = [
        f"SELECT subject, frame_no, {t} AS landmark_id, "
        f"CAST(trunc(left_{t}_x * w) AS INTEGER) AS x1, CAST(trunc(left_{t}_y * h) AS INTEGER) AS y1, "
        f"CAST(trunc(right_{t}_x * w) AS INTEGER) AS x2, CAST(trunc(right_{t}_y * h) AS INTEGER) AS y2 "
        f"FROM features WHERE has_left AND has_right"
        for t in lm.TIPS
    ]
    return "\nUNION ALL\n".join(parts)


@register("fingertip_pairs", _sql_pairs(), _LM_CTES)
def q_fingertip_pairs(spark, sf_dir):
    return lm.fingertip_pairs(_features(spark, sf_dir))


# --- API responses ------------------------------------------------------------------

from strata.operators import responses as rs  # noqa: E402

_SQL_QUOTE_SRC = """
SELECT event_id AS response_id, event_type, value, ts, json_extract_string(props, '$.k') AS k FROM events
"""
_QUOTE_CTES = {"quote_src": _SQL_QUOTE_SRC}


@register(
    "quotes_parsed",
    """
SELECT response_id,
       CASE WHEN event_type = 'click' THEN 'EUR' ELSE 'USD' END AS base,
       'BRL' AS moeda,
       CAST(value AS DECIMAL(18,6)) AS taxa,
       date_trunc('second', ts) AS data_referencia
FROM quote_src
WHERE k <> '0' AND event_type IN ('signup', 'click', 'purchase')
""",
    _QUOTE_CTES,
)
def q_quotes_parsed(spark, sf_dir):
    return rs.quotes_parsed(B.quote_bodies(spark, sf_dir))


@register(
    "quotes_rejected",
    f"""
SELECT response_id,
       CASE WHEN k = '0' THEN '{rs.NOT_JSON}'
            WHEN event_type = 'error' THEN '{rs.MISSING_PAIR.replace("'", "''")}'
            ELSE '{rs.MISSING_FIELDS.replace("'", "''")}' END AS motivo
FROM quote_src
WHERE k = '0' OR event_type IN ('error', 'view')
""",
    _QUOTE_CTES,
)
def q_quotes_rejected(spark, sf_dir):
    return rs.quotes_rejected(B.quote_bodies(spark, sf_dir))


@register(
    "issues_flat",
    f"""
SELECT conv_id, turn, CAST(i AS INTEGER) AS posicao, CAST(i + 1 AS VARCHAR) AS numero,
       CASE WHEN line = '' THEN '{rs.DEFAULT_TITLE}' ELSE line END AS titulo,
       CASE WHEN role = 'user' THEN 'user_' || CAST(conv_id AS VARCHAR) ELSE '{rs.DEFAULT_AUTHOR}' END AS autor,
       'https://issues.example/' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) || '/'
         || CAST(i + 1 AS VARCHAR) AS url
FROM (SELECT conv_id, turn, role,
             unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS i
      FROM conversations WHERE role <> 'system' AND text IS NOT NULL)
""",
)
def q_issues_flat(spark, sf_dir):
    return rs.issues_flat(B.issue_bodies(spark, sf_dir))


@register(
    "issues_rejected",
    "SELECT conv_id, turn, 'Bad credentials' AS motivo FROM conversations WHERE role = 'system'",
)
def q_issues_rejected(spark, sf_dir):
    return rs.issues_rejected(B.issue_bodies(spark, sf_dir))


@register(
    "issues_summary",
    """
SELECT conv_id, turn,
       CASE WHEN role = 'system' THEN NULL ELSE CAST(len(string_split(text, chr(10))) AS INTEGER) END AS total,
       CASE WHEN role = 'system' THEN 'Bad credentials' END AS erro
FROM conversations
""",
)
def q_issues_summary(spark, sf_dir):
    return rs.issues_summary(B.issue_bodies(spark, sf_dir))


# --- Streaming smoothing -------------------------------------------------------

from strata.session import ensure_checkpoint_dir  # noqa: E402
from strata.sources.files import append_layer  # noqa: E402
from strata.streaming import ordering  # noqa: E402
from strata.streaming import smoothing as sm  # noqa: E402

# The frames' clock, files that land in no order, and how far they may be out of it.
FRAME_MS, SMOOTH_LANDING_FILES, SMOOTH_DELAY = 40, 6, "1 day"


@register("stream_smoothed_position", "SELECT subject, frame_no, cx, cy FROM smooth", _LM_CTES)
def q_stream_smoothed_position(spark, sf_dir):
    """Visible frames land shuffled over files, whatever their order; the stream
    holds each until the watermark passes and smooths in frame order. A last row
    without a frame moves the watermark past all of them. Equals the batch
    ``smoothed_position``."""
    ensure_checkpoint_dir(spark)
    landing = scratch_dir(spark, "landing_visible_frames")
    sink = scratch_dir(spark, "smoothed_position_stream")
    visible = lm.visible_frames(_features(spark, sf_dir)).withColumn("at", F.timestamp_millis(F.col("frame_no") * FRAME_MS))
    write_layer(visible.repartition(SMOOTH_LANDING_FILES, F.xxhash64("subject", "frame_no")), landing)
    end = visible.agg(F.max("at").alias("at")).select((F.col("at") + F.expr("INTERVAL 2 DAYS")).alias("at"))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in visible.schema.fields if f.name != "at"]
    append_layer(end.select(*blank, "at").select(*visible.columns), landing)
    with ordering.rocksdb_state(spark):
        smoothed = ordering.smooth_in_order(st.table_stream(spark, landing, visible.schema), "at", SMOOTH_DELAY)
        query = st.start_append(smoothed.filter("NOT late").drop("late"), sink, f"{sink}_checkpoint", trigger={"availableNow": True})
    st.run_until_done(query)
    return spark.read.schema(sm.OUTPUT_SCHEMA).parquet(sink)


# --- File formats and appends ---------------------------------------------------

from strata.functions.columns import nanos_to_timestamp  # noqa: E402
from strata.sources.files import append_layer, read_layer, read_sales_csv, write_sales_csv  # noqa: E402

# Columns of the raw sales CSV, read with this schema instead of inferring one.
RAW_SALES_CSV_SCHEMA = (
    "id_pedido bigint, data_pedido string, hora_pedido string, cliente_id bigint, loja_id bigint, "
    "produto string, preco_unitario double, quantidade bigint, valor_total double, "
    "metodo_pagamento string, cidade string, estado string"
)


@register("csv_sales", "SELECT * FROM lj_vendas_raw")
def q_csv_sales(spark, sf_dir):
    """The raw sales land as CSV files with a header and are read back with
    the explicit schema (the retail bronze's source)."""
    path = scratch_dir(spark, "vendas_csv")
    write_sales_csv(B.lj_vendas_raw(spark, sf_dir), path)
    return read_sales_csv(spark, path, RAW_SALES_CSV_SCHEMA)


@register("nanos_timestamps", "SELECT event_id, ts FROM events")
def q_nanos_timestamps(spark, sf_dir):
    """Event times stored as longs of nanoseconds since the epoch (how files
    with nanosecond timestamps read with ``nanosAsLong``), converted back to
    timestamps."""
    path = scratch_dir(spark, "events_nanos")
    events = B.table(spark, sf_dir, "events")
    nanos = F.unix_micros(F.col("ts").cast("timestamp")) * F.lit(1000)
    events.select("event_id", nanos.alias("ts_ns")).write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.select("event_id", nanos_to_timestamp("ts_ns").cast("timestamp_ntz").alias("ts"))


# Quotes up to this day are appended first; later ones come with a new column.
QUOTE_APPEND_CUT = "2024-01-16"
QUOTE_SOURCE = "api"


@register(
    "quotes_appended",
    f"""
SELECT response_id, base, moeda, taxa, data_referencia,
       CASE WHEN data_referencia >= TIMESTAMP '{QUOTE_APPEND_CUT}' THEN '{QUOTE_SOURCE}' END AS fonte
FROM (
SELECT response_id,
       CASE WHEN event_type = 'click' THEN 'EUR' ELSE 'USD' END AS base,
       'BRL' AS moeda,
       CAST(value AS DECIMAL(18,6)) AS taxa,
       date_trunc('second', ts) AS data_referencia
FROM quote_src
WHERE k <> '0' AND event_type IN ('signup', 'click', 'purchase')
)
""",
    _QUOTE_CTES,
)
def q_quotes_appended(spark, sf_dir):
    """Valid quotes appended to one table in two loads; the second load adds
    a column, and the read merges the schemas (earlier rows get NULL)."""
    path = scratch_dir(spark, "cotacoes")
    quotes = rs.quotes_parsed(B.quote_bodies(spark, sf_dir))
    early = F.col("data_referencia") < F.lit(QUOTE_APPEND_CUT).cast("timestamp_ntz")
    append_layer(quotes.filter(early), path)
    append_layer(quotes.filter(~early).withColumn("fonte", F.lit(QUOTE_SOURCE)), path)
    base, name = path.rsplit("/", 1)
    return read_layer(spark, base, name, merge_schema=True)


# --- Schema replacement and SQL over the catalog -------------------------------

from strata.sources.catalog import layer_tables, register_layers  # noqa: E402


@register("overwrite_new_schema", "SELECT * FROM retail_silver", _RETAIL_CTES)
def q_overwrite_new_schema(spark, sf_dir):
    """A sales table first written with the raw CSV columns, then overwritten
    by its cleaned rows (other columns and types, partitioned by year and
    month). The newest version carries the new schema."""
    path = scratch_dir(spark, "vendas")
    snap.write_snapshot(B.lj_vendas_raw(spark, sf_dir), path, operation="WRITE")
    silver = lj.silver_retail(snap.read_snapshot(spark, path))
    snap.write_snapshot(silver, path, operation="OVERWRITE", partition_by=["ano", "mes"])
    return snap.read_snapshot(spark, path)


# The dashboard's top-10 as SQL text over a temporary view of the gold table.
TOP_VIEW = "vw_vendas_produto_mensal"
_SQL_TOP_ON_VIEW = (
    "SELECT ano, mes, produto, receita_total FROM {table} WHERE ano = {year} "
    "ORDER BY mes, receita_total DESC, produto LIMIT 10"
)


@register("top_products_sql", _SQL_TOP_ON_VIEW.format(table="retail_gold", year=YEAR), _RETAIL_CTES)
def q_top_products_sql(spark, sf_dir):
    """The gold table is written, registered in the ``gold`` database,
    exposed as a temporary view and queried with SQL text."""
    path = scratch_dir(spark, "gold_vendas_produto_mensal")
    write_layer(_retail_gold(spark, sf_dir), path)
    _register_fresh(spark, "gold", {"vendas_produto_mensal": path})
    spark.table("gold.vendas_produto_mensal").createOrReplaceTempView(TOP_VIEW)
    return spark.sql(_SQL_TOP_ON_VIEW.format(table=TOP_VIEW, year=YEAR))


def _register_fresh(spark, db: str, tables: dict[str, str]) -> None:
    """Register tables under fixed names, in place of an earlier call's."""
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{name}") if spark.catalog.databaseExists(db) else None
    register_layers(spark, {db: tables})


@register(
    "catalog_layers",
    """
SELECT 'versioned' AS layer, country AS part, count(*) AS n_rows FROM merged GROUP BY country
UNION ALL
SELECT 'partitioned' AS layer, CAST(ano AS VARCHAR) AS part, count(*) AS n_rows FROM retail_silver GROUP BY ano
""",
    {**_LOAD_CTES, **_RETAIL_CTES},
)
def q_catalog_layers(spark, sf_dir):
    """A versioned layer of two versions and a partitioned one, read through the
    catalog with SQL."""
    parted = scratch_dir(spark, "vendas_silver")
    write_layer(_retail_silver(spark, sf_dir), parted, partition_by=["ano", "mes"])
    tables = {"pedidos_enriquecidos": _orders_layer(spark, sf_dir), "vendas_silver": parted}
    _register_fresh(spark, "silver", tables)
    return spark.sql(
        "SELECT 'versioned' AS layer, country AS part, count(*) AS n_rows FROM silver.pedidos_enriquecidos GROUP BY country "
        "UNION ALL SELECT 'partitioned', CAST(ano AS STRING), count(*) FROM silver.vendas_silver GROUP BY ano"
    )


@register(
    "catalog_listing",
    "SELECT 'listing' AS database, t AS table_name, 'EXTERNAL' AS table_type FROM (VALUES ('lineitem'), ('orders')) v(t)",
)
def q_catalog_listing(spark, sf_dir):
    """The test tables registered as layers of one database, and its listing."""
    base = sf_dir.rstrip("/")
    _register_fresh(spark, "listing", {t: f"{base}/{t}.parquet" for t in ("lineitem", "orders")})
    return layer_tables(spark, ["listing"])


# --- Newest-month defaults, stamps, required columns, file counts ----------------

_SQL_NEWEST = "ano = (SELECT max(ano) FROM retail_gold) AND mes = (SELECT max(mes) FROM retail_gold)"


@register("month_slice_newest", f"SELECT * FROM retail_gold WHERE {_SQL_NEWEST}", _RETAIL_CTES)
def q_month_slice_newest(spark, sf_dir):
    """The default slice (newest year, newest month) of the whole gold. The two are
    taken each by itself, as the dashboard does, so it may be empty."""
    return lj.month_slice(_retail_gold(spark, sf_dir))


STAMP = "2024-05-06 07:08:09"


@register("layer_stamps", f"SELECT *, TIMESTAMP '{STAMP}' AS _silver_ts FROM orders_enriched", _ORDERS_CTES)
def q_layer_stamps(spark, sf_dir):
    """Enriched orders with the layer's stamp at a fixed time, and the columns
    that the next layer requires checked."""
    from strata.operators.clean import require_columns

    customers = lh.clean_customers(B.lh_customers(spark, sf_dir))
    stamp = F.lit(STAMP).cast("timestamp_ntz")
    out = lh.enrich_orders(B.lh_orders(spark, sf_dir), customers, as_of=AS_OF, stamp=stamp)
    return require_columns(out, [*lh.ENRICHED_COLUMNS, "_silver_ts"])


LAYER_FILES = 3


@register(
    "layer_files",
    f"SELECT CAST({LAYER_FILES} AS BIGINT) AS n_files, (SELECT count(*) FROM orders) AS n_rows",
)
def q_layer_files(spark, sf_dir):
    """Orders written with a fixed number of files, counted from what lies there."""
    path = scratch_dir(spark, "pedidos_arquivos")
    write_layer(B.table(spark, sf_dir, "orders"), path, files=LAYER_FILES)
    back = spark.read.parquet(path)
    return back.agg(
        F.countDistinct(F.col("_metadata.file_path")).alias("n_files"), F.count(F.lit(1)).alias("n_rows")
    )


@register(
    "retail_runs_twice",
    "SELECT produto, ano, mes, quantidade_total FROM retail_gold",
    _RETAIL_CTES,
)
def q_retail_runs_twice(spark, sf_dir):
    """The retail job run twice on the same input: its gold is that of one run."""
    from strata.plans import jobs

    base, raw = scratch_dir(spark, "retail_job"), B.lj_vendas_raw(spark, sf_dir)
    jobs.run_retail(spark, raw, base)
    paths = jobs.run_retail(spark, raw, base)
    return snap.read_snapshot(spark, paths["gold"]).select("produto", "ano", "mes", "quantidade_total")


# --- Corrections through silver and gold -----------------------------------------

# The second landing of the sales: one order more in each row of quantity 10,
# quantity 11 vanished, quantity 12 new, and quantity 13 moved to another month.
_SQL_RAW_FIRST = "SELECT * FROM lj_vendas_raw WHERE quantidade <> 12"
_SQL_RAW_SECOND = """
SELECT * REPLACE (CASE WHEN quantidade = 10 THEN 11 ELSE quantidade END AS quantidade,
                  CASE WHEN quantidade = 13 THEN '1999-01-15' ELSE data_pedido END AS data_pedido)
FROM lj_vendas_raw WHERE quantidade <> 11
"""


def _raw_landings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw, q = B.lj_vendas_raw(spark, sf_dir), F.col("quantidade")
    second = raw.filter(q != 11).withColumns(
        {
            "data_pedido": F.when(q == 13, "1999-01-15").otherwise(F.col("data_pedido")),
            "quantidade": F.when(q == 10, F.lit(11).cast("bigint")).otherwise(q),
        }
    )
    return raw.filter(q != 12), second


_CORRECTED_CTES = {
    "retail_typed": _SQL_RETAIL_TYPED.replace("FROM lj_vendas_raw", f"FROM ({_SQL_RAW_SECOND})"),
    "retail_silver": _SQL_RETAIL_SILVER,
    "retail_gold": _SQL_RETAIL_GOLD,
}


@register("retail_corrections", "SELECT * FROM retail_gold", _CORRECTED_CTES)
def q_retail_corrections(spark, sf_dir):
    """The retail job on two landings of the sales with changed, new, vanished
    and moved orders: its gold is that of a full rebuild on the second."""
    from strata.plans import jobs

    base = scratch_dir(spark, "retail_corrected")
    for raw in _raw_landings(spark, sf_dir):
        paths = jobs.run_retail(spark, raw, base)
    return snap.read_snapshot(spark, paths["gold"])


_SILVER_OF = {
    name: _SQL_RETAIL_SILVER.replace("retail_typed", "(" + _SQL_RETAIL_TYPED.replace("FROM lj_vendas_raw", f"FROM ({raw})") + ")")
    for name, raw in (("first_silver", _SQL_RAW_FIRST), ("second_silver", _SQL_RAW_SECOND))
}


@register(
    "signed_changes",
    """
SELECT *, CAST(-1 AS INTEGER) AS _sign FROM (SELECT * FROM first_silver EXCEPT ALL SELECT * FROM second_silver)
UNION ALL
SELECT *, CAST(1 AS INTEGER) AS _sign FROM (SELECT * FROM second_silver EXCEPT ALL SELECT * FROM first_silver)
""",
    _SILVER_OF,
)
def q_signed_changes(spark, sf_dir):
    """The signed silver rows between the two landings."""
    from strata.operators.changes import signed_changes

    first, second = [lj.silver_retail(raw) for raw in _raw_landings(spark, sf_dir)]
    return signed_changes(first, second, ["id_pedido"])


# --- Rollups, replaced months, growth by load, gated loads, evolving streams --------


@register(
    "gold_rollup",
    """
SELECT 'produto' AS nivel, ano, mes, produto, CAST(receita_total AS DECIMAL(30,2)) AS receita_total, quantidade_total, qtd_linhas FROM retail_gold
UNION ALL
SELECT 'mes', ano, mes, NULL, CAST(sum(receita_total) AS DECIMAL(30,2)), CAST(sum(quantidade_total) AS BIGINT), CAST(sum(qtd_linhas) AS BIGINT)
FROM retail_gold GROUP BY ano, mes
UNION ALL
SELECT 'ano', ano, NULL, NULL, CAST(sum(receita_total) AS DECIMAL(30,2)), CAST(sum(quantidade_total) AS BIGINT), CAST(sum(qtd_linhas) AS BIGINT)
FROM retail_gold GROUP BY ano
""",
    _RETAIL_CTES,
)
def q_gold_rollup(spark, sf_dir):
    """All levels of the rollup layer."""
    return _gold_layer(spark, sf_dir).select("nivel", "ano", "mes", "produto", "receita_total", "quantidade_total", "qtd_linhas")


@register(
    "rewrite_month",
    f"SELECT ano, mes, id_pedido, CASE WHEN ano = {YEAR} AND mes = {MONTH} THEN 2 ELSE 1 END * quantidade AS quantidade FROM retail_silver",
    _RETAIL_CTES,
)
def q_rewrite_month(spark, sf_dir):
    """One month of a partitioned layer written again, with its quantities doubled;
    the other months stay as they are."""
    path = scratch_dir(spark, "vendas_por_mes")
    silver = _retail_silver(spark, sf_dir).select("ano", "mes", "id_pedido", "quantidade")
    write_layer(silver, path, partition_by=["ano", "mes"])
    month = spark.read.schema(silver.schema).parquet(path).filter((F.col("ano") == YEAR) & (F.col("mes") == MONTH))
    write_layer(month.withColumn("quantidade", F.col("quantidade") * 2), path, partition_by=["ano", "mes"], present_only=True)
    return spark.read.schema(silver.schema).parquet(path).select("ano", "mes", "id_pedido", "quantidade")


@register("growth_by_load", _SQL_GROWTH, _SALES_CTES)
def q_growth_by_load(spark, sf_dir):
    """Daily growth loaded year by year, each load reading its own days and the
    carry of the one before. Equals the full run."""
    base = scratch_dir(spark, "gold_vendas_diarias")
    daily = pm.daily_sales(_sales_enriched(spark, sf_dir), dealt=True).withColumn("_y", F.year("data_venda"))
    write_layer(daily, f"{base}/fato", partition_by=["_y"])
    stored = spark.read.schema(daily.schema).parquet(f"{base}/fato")
    carry = None
    years = stored.select("_y").distinct().orderBy(F.col("_y").asc_nulls_first())
    for i, row in enumerate(years.collect()):  # one row a year
        days = stored.filter(F.col("_y").eqNullSafe(row._y)).drop("_y")
        grown, last = pm.daily_growth_after(days, carry)
        write_layer(grown, f"{base}/gold/carga={i}")
        write_layer(last, f"{base}/carry/{i}")
        carry = spark.read.schema(last.schema).parquet(f"{base}/carry/{i}")
    return spark.read.schema(grown.schema).parquet(f"{base}/gold").select(*grown.columns)


_GATED_REASONS = """
    CASE WHEN cliente_id IS NULL THEN ['cliente_id is null'] ELSE [] END
    || CASE WHEN NOT (quantidade < 50) THEN ['quantidade under 50'] ELSE [] END
    || CASE WHEN cliente_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pm_clientes c WHERE c.id = v.cliente_id) THEN ['cliente_id has no parent'] ELSE [] END
    || CASE WHEN (SELECT n FROM (SELECT cliente_id AS a, produto_id AS b, data_venda AS d, count(*) AS n FROM pm_vendas GROUP BY ALL) r
                  WHERE r.a = v.cliente_id AND r.b = v.produto_id AND r.d = v.data_venda) > 1
            THEN ['cliente_id, produto_id, data_venda not unique'] ELSE [] END
"""


@register(
    "gated_load",
    f"""
SELECT id, array_to_string(reasons, '; ') AS reasons, CASE WHEN len(reasons) = 0 THEN 'accepted' ELSE 'rejected' END AS verdict
FROM (SELECT id, {_GATED_REASONS} AS reasons FROM pm_vendas v)
""",
)
def q_gated_load(spark, sf_dir):
    """Sales loaded through their constraints: accepted rows are the version,
    rejected ones lie beside it with their reasons."""
    from strata.operators import gates

    path = scratch_dir(spark, "vendas_conferidas")
    rules = [
        gates.not_null("cliente_id"),
        gates.check("quantidade under 50", F.col("quantidade") < 50),
        gates.foreign_key("cliente_id", B.pm_clientes(spark, sf_dir), "id"),
        gates.unique("cliente_id", "produto_id", "data_venda"),
    ]
    gates.load_gated(B.pm_vendas(spark, sf_dir), path, rules)
    accepted = snap.read_snapshot(spark, path).select("id", F.lit("").alias("reasons"), F.lit("accepted").alias("verdict"))
    rejected = gates.read_rejected(spark, path)
    return accepted.unionByName(rejected.select("id", F.array_join(gates.REASONS, "; ").alias("reasons"), F.lit("rejected").alias("verdict")))


@register(
    "stream_schema_grows",
    """
SELECT event_id AS order_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount, ts AS event_time,
       CASE WHEN event_type = 'purchase' THEN 'app' END AS channel
FROM events
""",
)
def q_stream_schema_grows(spark, sf_dir):
    """Order events of two landings; the second one's carry a field more. The stream
    is restarted on its checkpoint with the wider schema and goes on in its sink."""
    landing, sink = scratch_dir(spark, "landing_wider"), scratch_dir(spark, "orders_wider")
    lines = B.order_event_lines(spark, sf_dir)
    late = F.col("value").contains('"product": "purchase"')
    wider = F.regexp_replace("value", '"status":', '"channel": "app", "status":').alias("value")
    for schema, rows in (
        (st.ORDER_EVENT_SCHEMA, lines.filter(~late)),
        (StructType([*st.ORDER_EVENT_SCHEMA.fields, StructField("channel", StringType())]), lines.filter(late).select(wider)),
    ):
        rows.write.mode("append").text(landing)
        stream = st.orders_stream(spark, landing, schema=schema, watermark=None).drop("_ingestion_ts", "_source")
        st.run_until_done(st.start_evolving_append(stream, sink, f"{sink}_checkpoint", trigger={"availableNow": True}))
    out = st.read_evolved(spark, sink)
    return st.event_time_ntz(out).select("order_id", "amount", "event_time", "channel")


@register("stream_orders_deduped", "SELECT event_id AS order_id, user_id AS customer_id, ts AS event_time FROM events")
def q_stream_orders_deduped(spark, sf_dir):
    """Every order event lands twice, in files of its own and again in a second
    landing that a restarted stream reads; one of each reaches the sink."""
    landing, sink = scratch_dir(spark, "landing_repeated"), scratch_dir(spark, "orders_deduped")
    lines = B.order_event_lines(spark, sf_dir)
    for _ in range(2):
        write_layer(lines.unionAll(lines), f"{landing}/new", fmt="text", mode="append")
        stream = st.orders_stream(spark, f"{landing}/new", max_files=10_000)
        query = st.start_append(
            st.one_per_key(stream, ["order_id"]), sink, f"{sink}_checkpoint", trigger={"availableNow": True}
        )
        st.run_until_done(query)
    out = spark.read.schema(query_schema_of_sink()).parquet(sink)
    return st.event_time_ntz(out).select("order_id", "customer_id", "event_time")
