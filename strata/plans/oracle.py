"""DuckDB SQL twins of the bindings and queries (the correctness oracle).

``BINDINGS`` holds one CTE per domain table of ``strata.plans.bindings``;
``with_bindings(sql)`` prefixes a query with all of them (DuckDB only
evaluates the CTEs a query references).
"""

from __future__ import annotations

BINDINGS: dict[str, str] = {}

BINDINGS["lh_customers"] = """
SELECT c_custkey AS id,
       ' ' || c_name || ' ' AS name,
       CASE WHEN c_acctbal < 0 THEN NULL
            ELSE ' ' || lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
       n_name AS country
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

BINDINGS["lh_orders"] = """
SELECT o_orderkey AS id,
       CASE WHEN o_totalprice < 5000 THEN NULL ELSE o_custkey END AS customer_id,
       o_orderpriority AS product,
       CASE WHEN o_totalprice > 499000 THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.01 AS DECIMAL(10,2)) END AS amount,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN NULL
            WHEN o_orderstatus = 'F' THEN 'completed'
            WHEN o_orderstatus = 'O' THEN 'pending'
            ELSE 'processing' END AS status,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
            ELSE CAST(o_orderdate AS DATE) END AS order_date
FROM orders
"""

BINDINGS["pm_clientes"] = """
SELECT CASE WHEN s_suppkey = 0 THEN NULL ELSE s_suppkey END AS id,
       s_name AS nome,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE lower(replace(s_name, '#', '.')) || '@loja.test' END AS email,
       TIMESTAMP '2020-01-01 00:00:00' + to_minutes(s_suppkey) AS criado_em
FROM supplier
"""

BINDINGS["pm_produtos"] = """
SELECT p_partkey AS id, p_name AS nome, p_type AS categoria,
       CAST(p_retailprice AS DECIMAL(10,2)) AS preco,
       TIMESTAMP '2020-01-01 00:00:00' + to_minutes(p_partkey) AS criado_em
FROM part
"""

BINDINGS["pm_vendas"] = """
SELECT l_orderkey * 10 + l_linenumber AS id,
       CASE WHEN l_quantity = 50 AND l_linenumber = 7 THEN NULL ELSE l_suppkey END AS cliente_id,
       CASE WHEN l_quantity = 49 AND l_linenumber = 6 THEN NULL ELSE l_partkey END AS produto_id,
       CAST(l_quantity AS INTEGER) AS quantidade,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS valor_total,
       CAST(l_shipdate AS DATE) AS data_venda
FROM lineitem
"""

BINDINGS["lj_vendas_raw"] = """
SELECT l_orderkey * 10 + l_linenumber AS id_pedido,
       CASE WHEN l_quantity = 2 THEN 'not-a-date' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS data_pedido,
       lpad(CAST(l_linenumber + 7 AS VARCHAR), 2, '0') || ':00:00' AS hora_pedido,
       CASE WHEN l_quantity = 8 THEN NULL ELSE l_partkey END AS cliente_id,
       l_suppkey AS loja_id,
       CASE WHEN l_quantity = 6 THEN NULL
            WHEN l_quantity = 7 THEN '  '
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN ' Arroz_5kg '
            WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'FEIJAO_1KG'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'acucar_1kg '
            WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '  Oleo_Soja_900ml'
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'cafe_500g'
            WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Detergente_500ml' END AS produto,
       l_extendedprice AS preco_unitario,
       CASE WHEN l_quantity = 3 THEN 0 WHEN l_quantity = 4 THEN -1
            ELSE CAST(l_quantity AS BIGINT) END AS quantidade,
       CASE WHEN l_quantity = 5 THEN -(l_extendedprice * l_quantity)
            ELSE l_extendedprice * l_quantity END AS valor_total,
       CASE WHEN l_linenumber IN (1, 5) THEN 'pix'
            WHEN l_linenumber IN (2, 6) THEN 'cartao_credito'
            WHEN l_linenumber IN (3, 7) THEN 'cartao_debito'
            ELSE 'dinheiro' END AS metodo_pagamento,
       'Cidade ' || CAST(l_suppkey AS VARCHAR) AS cidade,
       CASE WHEN l_linestatus = 'F' THEN 'SP' ELSE 'RJ' END AS estado
FROM lineitem
"""

BINDINGS["landmark_frames"] = """
SELECT CAST(label AS BIGINT) AS subject, vec_id AS frame_no, 640 AS w, 480 AS h
FROM embeddings
"""

# Slot k (0..30) of an embedding row is the point (e[2k], e[2k+1]) + 0.5;
# DuckDB lists are 1-based.
BINDINGS["landmarks"] = """
SELECT subject, frame_no, part,
       CASE WHEN detection_idx = 0 THEN label0 WHEN detection_idx = 1 THEN label1 END AS label,
       detection_idx, landmark_id, x, y
FROM (
  SELECT CAST(label AS BIGINT) AS subject, vec_id AS frame_no, k,
         CASE WHEN k < 5 THEN 'pose' WHEN k < 27 THEN 'hand' ELSE 'face' END AS part,
         CASE WHEN k BETWEEN 5 AND 15 THEN 0 WHEN k BETWEEN 16 AND 26 THEN 1 END AS detection_idx,
         [0, 11, 12, 15, 16,
          3, 4, 6, 8, 9, 10, 12, 14, 16, 18, 20,
          3, 4, 6, 8, 9, 10, 12, 14, 16, 18, 20,
          13, 14, 61, 291][k + 1] AS landmark_id,
         0.5 + CAST(embedding[2 * k + 1] AS DOUBLE) AS x,
         0.5 + CAST(embedding[2 * k + 2] AS DOUBLE) AS y,
         CAST(embedding[63] AS DOUBLE) > -0.2 AS has_pose,
         CAST(embedding[64] AS DOUBLE) > -0.15 AS has_face,
         CAST(embedding[61] AS DOUBLE) > -0.12 AS has_det0,
         CAST(embedding[62] AS DOUBLE) > -0.12 AS has_det1,
         CASE WHEN CAST(embedding[60] AS DOUBLE) > 0.12 THEN 'Right' ELSE 'Left' END AS label0,
         CASE WHEN CAST(embedding[59] AS DOUBLE) > 0.12 THEN 'Left' ELSE 'Right' END AS label1
  FROM (SELECT *, unnest(range(0, 31)) AS k FROM embeddings)
)
WHERE (part = 'pose' AND has_pose) OR (part = 'face' AND has_face)
   OR (detection_idx = 0 AND has_det0) OR (detection_idx = 1 AND has_det1)
"""


def with_bindings(sql: str, extra: dict[str, str] | None = None) -> str:
    ctes = {**BINDINGS, **(extra or {})}
    parts = ",\n".join(f"{name} AS ({body.strip()})" for name, body in ctes.items())
    recursive = "RECURSIVE " if any(body.lstrip().startswith("-- recursive") for body in ctes.values()) else ""
    return f"WITH {recursive}{parts}\n{sql.strip()}"
