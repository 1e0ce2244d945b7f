"""Domain tables derived from the driver's test tables.

The pipelines we rebuild read shop tables (customers, orders, sales, a sales
CSV, an order event stream, landmark frames, API response bodies). Here each
is derived from the test tables with plain column expressions, so its size
grows with the scale factor. The test tables hold no NULLs, no bad text and no
non-positive amounts; the bindings inject such values by fixed rules on the
row's own columns so the cleaning steps have work to do. No row is dropped.

Every binding has a twin CTE in ``strata.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one test table, as it lies: splits are the reader's (``bench.py`` and
    the session set its options), and no plan depends on the table's size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- Orders pipeline: customers, orders ------------------------------------


def lh_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers(id, name, email, country). E-mail is NULL for customers with a
    negative balance; names and e-mails carry blanks for the trim step."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("name"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")))
        .alias("email"),
        F.col("n_name").alias("country"),
    )


def lh_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders(id, customer_id, product, amount decimal(10,2), status, order_date).

    amount = o_totalprice / 100 (so it spans the 1000 threshold); status from
    o_orderstatus F/O/P; NULL customer for orders under 5000, NULL amount over
    499000, NULL status for P/3-MEDIUM, NULL date for P/4-NOT SPECIFIED.
    """
    o = table(spark, sf_dir, "orders")
    amount = (F.col("o_totalprice").cast("decimal(12,2)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("processing")
    )
    is_p = F.col("o_orderstatus") == "P"
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_totalprice") < 5000, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias(
            "customer_id"
        ),
        F.col("o_orderpriority").alias("product"),
        F.when(F.col("o_totalprice") > 499000, F.lit(None).cast("decimal(10,2)")).otherwise(amount).alias("amount"),
        F.when(is_p & (F.col("o_orderpriority") == "3-MEDIUM"), F.lit(None).cast("string"))
        .otherwise(status)
        .alias("status"),
        F.when(is_p & (F.col("o_orderpriority") == "4-NOT SPECIFIED"), F.lit(None).cast("date"))
        .otherwise(F.to_date("o_orderdate"))
        .alias("order_date"),
    )


# --- Daily sales pipeline: clientes, produtos, vendas -----------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ '2020-01-01 00:00:00'"


def pm_clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clientes(id, nome, email, criado_em) from supplier. Supplier 0 gets a NULL
    id (for the NULL-safe join); negative balance gives a NULL e-mail."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.when(F.col("s_suppkey") == 0, F.lit(None).cast("bigint")).otherwise(F.col("s_suppkey")).alias("id"),
        F.col("s_name").alias("nome"),
        F.when(F.col("s_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lower(F.regexp_replace("s_name", "#", ".")), F.lit("@loja.test")))
        .alias("email"),
        F.expr(f"timestampadd(MINUTE, s_suppkey, {_EPOCH_NTZ})").alias("criado_em"),
    )


def pm_produtos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """produtos(id, nome, categoria, preco decimal(10,2), criado_em) from part."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("nome"),
        F.col("p_type").alias("categoria"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("preco"),
        F.expr(f"timestampadd(MINUTE, p_partkey, {_EPOCH_NTZ})").alias("criado_em"),
    )


def pm_vendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vendas(id, cliente_id, produto_id, quantidade, valor_total, data_venda)
    from lineitem: id = orderkey*10 + linenumber (the test data repeats some),
    client = supplier, product = part; NULL client for quantity 50 on line 7,
    NULL product for quantity 49 on line 6."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.when((F.col("l_quantity") == 50) & (F.col("l_linenumber") == 7), F.lit(None).cast("bigint"))
        .otherwise(F.col("l_suppkey"))
        .alias("cliente_id"),
        F.when((F.col("l_quantity") == 49) & (F.col("l_linenumber") == 6), F.lit(None).cast("bigint"))
        .otherwise(F.col("l_partkey"))
        .alias("produto_id"),
        F.col("l_quantity").cast("int").alias("quantidade"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("valor_total"),
        F.to_date("l_shipdate").alias("data_venda"),
    )


# --- Retail pipeline: the raw sales CSV -------------------------------------

# Product names of the retail catalogue (written here with the
# case and blanks the silver step normalises away).
RETAIL_PRODUCTS = {
    ("A", "F"): " Arroz_5kg ",
    ("A", "O"): "FEIJAO_1KG",
    ("N", "F"): "acucar_1kg ",
    ("N", "O"): "  Oleo_Soja_900ml",
    ("R", "F"): "cafe_500g",
    ("R", "O"): "Detergente_500ml",
}


def lj_vendas_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales rows with the CSV's columns, from lineitem.

    Injected by l_quantity: 2 bad date text, 3 quantity 0, 4 quantity -1,
    5 negative total, 6 NULL product, 7 blank product, 8 NULL client.
    """
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    product = None
    for (flag, status), name in RETAIL_PRODUCTS.items():
        cond = (F.col("l_returnflag") == flag) & (F.col("l_linestatus") == status)
        product = F.when(cond, name) if product is None else product.when(cond, name)
    line = F.col("l_linenumber")
    total = F.col("l_extendedprice") * q
    return li.select(
        (F.col("l_orderkey") * 10 + line).alias("id_pedido"),
        F.when(q == 2, F.lit("not-a-date")).otherwise(F.to_date("l_shipdate").cast("string")).alias("data_pedido"),
        F.concat(F.lpad((line + 7).cast("string"), 2, "0"), F.lit(":00:00")).alias("hora_pedido"),
        F.when(q == 8, F.lit(None).cast("bigint")).otherwise(F.col("l_partkey")).alias("cliente_id"),
        F.col("l_suppkey").alias("loja_id"),
        F.when(q == 6, F.lit(None).cast("string")).when(q == 7, F.lit("  ")).otherwise(product).alias("produto"),
        F.col("l_extendedprice").alias("preco_unitario"),
        F.when(q == 3, F.lit(0).cast("bigint"))
        .when(q == 4, F.lit(-1).cast("bigint"))
        .otherwise(q.cast("bigint"))
        .alias("quantidade"),
        F.when(q == 5, -total).otherwise(total).alias("valor_total"),
        F.when(line.isin(1, 5), "pix")
        .when(line.isin(2, 6), "cartao_credito")
        .when(line.isin(3, 7), "cartao_debito")
        .otherwise("dinheiro")
        .alias("metodo_pagamento"),
        F.concat(F.lit("Cidade "), F.col("l_suppkey").cast("string")).alias("cidade"),
        F.when(F.col("l_linestatus") == "F", "SP").otherwise("RJ").alias("estado"),
    )


# --- Order event stream (JSON lines) ----------------------------------------


def order_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text line per event: the order stream's records. Error events
    carry a malformed amount ("n/a"); every line has an extra ``props`` field."""
    e = table(spark, sf_dir, "events")
    amount = F.when(F.col("event_type") == "error", F.lit('"n/a"')).otherwise(F.col("value").cast("string"))
    status = F.when(F.col("event_type") == "purchase", "completed").otherwise("pending")
    line = F.concat(
        F.lit('{"order_id": '), F.col("event_id").cast("string"),
        F.lit(', "customer_id": '), F.col("user_id").cast("string"),
        F.lit(', "product": "'), F.col("event_type"),
        F.lit('", "amount": '), amount,
        F.lit(', "status": "'), status,
        F.lit('", "event_time": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.lit('", "props": '), F.col("props"),
        F.lit("}"),
    )
    return e.select(line.alias("value"))


# --- Landmark frames (from embeddings) --------------------------------------

FRAME_W, FRAME_H = 640, 480

# Landmark numbering of the public pose / hand / face-mesh models.
POSE_IDS = [0, 11, 12, 15, 16]  # nose, left/right shoulder, left/right wrist
HAND_IDS = [3, 4, 6, 8, 9, 10, 12, 14, 16, 18, 20]  # thumb IP/tip, finger PIPs/tips, middle MCP
FACE_IDS = [13, 14, 61, 291]  # mouth top, bottom, left corner, right corner

# Slot k of an embedding is the point (e[2k], e[2k+1]) shifted by 0.5.
_SLOT_PART = ["pose"] * 5 + ["hand"] * 22 + ["face"] * 4
_SLOT_LANDMARK = POSE_IDS + HAND_IDS + HAND_IDS + FACE_IDS
_SLOT_DETECTION = [None] * 5 + [0] * 11 + [1] * 11 + [None] * 4


def _e(i: int):
    return F.col("embedding").getItem(i).cast("double")


def landmark_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frames(subject, frame_no, w, h): one per embedding row, subject = label."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("label").cast("bigint").alias("subject"),
        F.col("vec_id").alias("frame_no"),
        F.lit(FRAME_W).alias("w"),
        F.lit(FRAME_H).alias("h"),
    )


def landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long landmark table (subject, frame_no, part, label, detection_idx,
    landmark_id, x, y).

    Presence per frame: pose when e[62] > -0.2, face when e[63] > -0.15, hand
    detection 0 when e[60] > -0.12, detection 1 when e[61] > -0.12. Detection 0
    is 'Left' unless e[59] > 0.12; detection 1 is 'Right' unless e[58] > 0.12.
    """
    emb = table(spark, sf_dir, "embeddings")
    parts = F.array(*[F.lit(p) for p in _SLOT_PART])
    ids = F.array(*[F.lit(i) for i in _SLOT_LANDMARK])
    dets = F.array(*[F.lit(d).cast("int") for d in _SLOT_DETECTION])
    slots = F.expr(
        "transform(sequence(0, 30), k -> named_struct('k', k, "
        "'x', 0.5D + cast(embedding[2 * k] as double), 'y', 0.5D + cast(embedding[2 * k + 1] as double)))"
    )
    base = emb.select(
        F.col("label").cast("bigint").alias("subject"),
        F.col("vec_id").alias("frame_no"),
        (_e(62) > -0.2).alias("has_pose"),
        (_e(63) > -0.15).alias("has_face"),
        (_e(60) > -0.12).alias("has_det0"),
        (_e(61) > -0.12).alias("has_det1"),
        F.when(_e(59) > 0.12, "Right").otherwise("Left").alias("label0"),
        F.when(_e(58) > 0.12, "Left").otherwise("Right").alias("label1"),
        F.inline(slots),
    )
    k1 = F.col("k") + 1
    out = base.select(
        "subject",
        "frame_no",
        F.element_at(parts, k1).alias("part"),
        F.element_at(dets, k1).alias("detection_idx"),
        F.element_at(ids, k1).alias("landmark_id"),
        "x",
        "y",
        "has_pose",
        "has_face",
        "has_det0",
        "has_det1",
        "label0",
        "label1",
    )
    present = (
        ((F.col("part") == "pose") & F.col("has_pose"))
        | ((F.col("part") == "face") & F.col("has_face"))
        | ((F.col("detection_idx") == 0) & F.col("has_det0"))
        | ((F.col("detection_idx") == 1) & F.col("has_det1"))
    )
    label = (
        F.when(F.col("detection_idx") == 0, F.col("label0"))
        .when(F.col("detection_idx") == 1, F.col("label1"))
    )
    return out.filter(present).select(
        "subject", "frame_no", "part", label.alias("label"), "detection_idx", "landmark_id", "x", "y"
    )


# --- API response bodies ----------------------------------------------------


def quote_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(response_id, body): one exchange-quote response per event.

    props k = 0 -> not JSON; error -> no USDBRL; view -> no bid; signup -> no
    code/codein; click -> EUR; purchase -> complete USD/BRL quote.
    """
    e = table(spark, sf_dir, "events")
    bid = F.col("value").cast("string")
    cd = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    t = F.col("event_type")

    def quote(*fields):
        return F.concat(F.lit('{"USDBRL": {'), *fields, F.lit("}}"))

    body = (
        F.when(F.get_json_object("props", "$.k") == "0", F.concat(F.lit("<html>error "), F.col("event_id").cast("string"), F.lit("</html>")))
        .when(t == "error", F.lit('{"message": "rate limit"}'))
        .when(t == "view", quote(F.lit('"code": "USD", "codein": "BRL", "create_date": "'), cd, F.lit('"')))
        .when(t == "signup", quote(F.lit('"bid": "'), bid, F.lit('", "create_date": "'), cd, F.lit('"')))
        .when(
            t == "click",
            quote(F.lit('"code": "EUR", "codein": "BRL", "bid": "'), bid, F.lit('", "create_date": "'), cd, F.lit('"')),
        )
        .otherwise(
            quote(F.lit('"code": "USD", "codein": "BRL", "bid": "'), bid, F.lit('", "create_date": "'), cd, F.lit('"'))
        )
    )
    return e.select(F.col("event_id").alias("response_id"), body.alias("body"))


def issue_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, body): one issue-list response per conversation turn.

    System turns are error bodies. Otherwise every line of the turn's whole text
    is one issue: number = line number, title = the line (omitted when empty),
    user.login only on user turns, html_url from the ids.
    """
    c = table(spark, sf_dir, "conversations")
    issues = F.expr(
        "transform(split(text, '\\n'), (l, i) -> named_struct("
        "'number', i + 1, "
        "'title', nullif(l, ''), "
        "'user', CASE WHEN role = 'user' THEN named_struct('login', concat('user_', cast(conv_id as string))) END, "
        "'html_url', concat('https://issues.example/', cast(conv_id as string), '/', cast(turn as string), '/', cast(i + 1 as string))))"
    )
    body = F.when(F.col("role") == "system", F.lit('{"message": "Bad credentials"}')).otherwise(F.to_json(issues))
    return c.select("conv_id", "turn", body.alias("body"))
