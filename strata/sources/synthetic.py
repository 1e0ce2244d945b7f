"""Synthetic retail sales rows, one per key of an input frame.

Every field is a draw by md5 from the row's key, a seed and the field's number
(no driver loop, no random state), so the generator runs on all executors, is
reproducible, and can be re-computed in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Catalogue of the retail generator, price ranges in reais.
PRODUCTS = [
    ("arroz_5kg", 18.0, 30.0),
    ("feijao_1kg", 6.0, 12.0),
    ("acucar_1kg", 4.0, 9.0),
    ("oleo_soja_900ml", 6.0, 15.0),
    ("cafe_500g", 10.0, 25.0),
    ("detergente_500ml", 2.5, 6.0),
    ("sabao_po_1kg", 10.0, 25.0),
    ("refrigerante_2l", 7.0, 15.0),
    ("agua_1_5l", 2.0, 5.0),
    ("biscoito_200g", 3.0, 8.0),
]
PAYMENT_METHODS = ["pix", "cartao_credito", "cartao_debito", "dinheiro"]
# The 27 Brazilian federative units.
STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]
FIRST_DAY = "2023-01-01"
N_DAYS = 731  # 2023-01-01 .. 2024-12-31
N_CLIENTS = 50_000
N_SHOPS = 50
N_CITIES = 500



DRAWS_A_HASH = 8


def draw_hash(key_col: str, seed: int, block: int) -> Column:
    """Eight draws for the key: the SHA-256 of key, seed and block."""
    return F.sha2(F.concat_ws(":", F.col(key_col).cast("string"), F.lit(str(seed)), F.lit(str(block))), 256)


def draw(stream: int) -> Column:
    """Pseudo-random draw number ``stream`` (from 1) of a row with the hash columns
    ``_hash_0``, ``_hash_1``...: 32 bits (0 to 2^32 - 1), so that draws of one key, and
    of neighbouring keys, are independent."""
    block, place = divmod(stream - 1, DRAWS_A_HASH)
    return F.conv(F.substring(F.col(f"_hash_{block}"), 1 + 8 * place, 8), 16, 10).cast("bigint")


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def synthetic_sales(keys: DataFrame, key_col: str, seed: int = 42) -> DataFrame:
    """Sales rows with the retail CSV's columns, ``id_pedido`` = the key. Two hashes
    a row give its eleven draws."""
    k = F.col(key_col)
    keys = keys.select(k, *[draw_hash(key_col, seed, b).alias(f"_hash_{b}") for b in (0, 1)])
    prod = draw(1) % len(PRODUCTS)
    lo = _pick([round(p[1] * 100) for p in PRODUCTS], prod)
    hi = _pick([round(p[2] * 100) for p in PRODUCTS], prod)
    price_cents = lo + draw(2) % (hi - lo + 1)
    qty = draw(3) % 10 + 1
    cents = F.lit(0.01).cast("decimal(2,2)")
    return keys.select(
        k.alias("id_pedido"),
        F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (draw(5) % N_DAYS).cast("int")), "yyyy-MM-dd").alias(
            "data_pedido"
        ),
        F.format_string("%02d:%02d:00", draw(6) % 15 + 8, draw(7) % 60).alias("hora_pedido"),
        (draw(8) % N_CLIENTS + 1).alias("cliente_id"),
        (draw(9) % N_SHOPS + 1).alias("loja_id"),
        _pick([p[0] for p in PRODUCTS], prod).alias("produto"),
        (price_cents.cast("decimal(10,0)") * cents).cast("decimal(10,2)").alias("preco_unitario"),
        qty.alias("quantidade"),
        ((price_cents * qty).cast("decimal(12,0)") * cents).cast("decimal(12,2)").alias("valor_total"),
        _pick(PAYMENT_METHODS, draw(4) % len(PAYMENT_METHODS)).alias("metodo_pagamento"),
        F.concat(F.lit("Cidade "), (draw(10) % N_CITIES + 1).cast("string")).alias("cidade"),
        _pick(STATES, draw(11) % len(STATES)).alias("estado"),
    )
