"""Operators over tables of API response bodies (JSON text columns).

Bodies that the request scripts would have fetched one at a time are a column
here; parsing is ``from_json`` with an explicit schema, so it runs in the JVM
over every partition. Where the scripts stop with an error, the row is kept
and routed to a rejected frame with the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import to_timestamp_ntz_safe

# Messages and defaults of the quote ingest.
NOT_JSON = "resposta não é JSON"
MISSING_PAIR = "Resposta da API não contém chave 'USDBRL'"
MISSING_FIELDS = "Campos 'bid' ou 'create_date' ausentes na resposta da API"
BAD_BID = "bid inválido"
BAD_DATE = "create_date inválido"
PAIR_KEY = "USDBRL"
DEFAULT_BASE, DEFAULT_QUOTE = "USD", "BRL"
QUOTE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

_QUOTE_SCHEMA = (
    f"{PAIR_KEY} struct<code: string, codein: string, bid: string, create_date: string>, _corrupt string"
)


def parse_quotes(df: DataFrame, body: str = "body") -> DataFrame:
    """All rows with the parsed quote fields and ``motivo`` (NULL when valid):
    ``base, moeda`` default to USD / BRL, ``taxa`` is decimal(18,6),
    ``data_referencia`` the quote's wall-clock time.

    The body is parsed once per row, inside a one-element ``inline``: a filter
    on ``motivo`` stays above the generator. Over a plain projection Catalyst
    would push that filter down with the parse inlined into each of its
    conditions (several ``from_json`` calls per row, outside codegen).
    """
    parsed = F.from_json(
        F.col(body), _QUOTE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    keep = [c for c in df.columns if c != body]
    once = df.select(
        *keep, F.inline(F.array(F.struct(F.col(body).isNull().alias("_no_body"), parsed.alias("_p"))))
    )
    q = F.col("_p").getField(PAIR_KEY)
    bid, created = q.getField("bid"), q.getField("create_date")
    taxa = bid.try_cast("decimal(18,6)")
    ts = to_timestamp_ntz_safe(created, QUOTE_TS_FORMAT)
    reason = (
        F.when(F.col("_no_body") | F.col("_p").getField("_corrupt").isNotNull(), NOT_JSON)
        .when(q.isNull(), MISSING_PAIR)
        .when(bid.isNull() | created.isNull(), MISSING_FIELDS)
        .when(taxa.isNull(), BAD_BID)
        .when(ts.isNull(), BAD_DATE)
    )
    return once.select(
        *keep,
        F.coalesce(q.getField("code"), F.lit(DEFAULT_BASE)).alias("base"),
        F.coalesce(q.getField("codein"), F.lit(DEFAULT_QUOTE)).alias("moeda"),
        taxa.alias("taxa"),
        ts.alias("data_referencia"),
        reason.alias("motivo"),
    )


def quotes_parsed(df: DataFrame, body: str = "body") -> DataFrame:
    """Valid quotes, one row each: the rows the ingest would insert."""
    return parse_quotes(df, body).filter(F.col("motivo").isNull()).drop("motivo")


def quotes_rejected(df: DataFrame, body: str = "body", keys: Sequence[str] | None = None) -> DataFrame:
    """Bodies the ingest would stop on, with the reason."""
    p = parse_quotes(df, body).filter(F.col("motivo").isNotNull())
    ids = list(keys) if keys is not None else [c for c in df.columns if c != body]
    return p.select(*ids, "motivo")


# Defaults of the issue listing.
DEFAULT_NUMBER = "N/A"
DEFAULT_TITLE = "Sem título"
DEFAULT_AUTHOR = "Desconhecido"
DEFAULT_URL = ""

_ISSUES_SCHEMA = "array<struct<number: bigint, title: string, user: struct<login: string>, html_url: string>>"


def _issue_array(body: str):
    """The body's issue array; NULL unless the body is a JSON array (an array
    schema would otherwise wrap a lone object, such as an error body)."""
    return F.when(F.ltrim(F.col(body)).startswith("["), F.from_json(F.col(body), _ISSUES_SCHEMA))


def issues_flat(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per issue of every array body: position, number, title,
    author and URL with the listing's defaults. Other bodies give no rows here
    and one in ``issues_rejected``."""
    issues = _issue_array(body)
    keep = [c for c in df.columns if c != body]
    exploded = df.select(*keep, F.posexplode(issues).alias("posicao", "issue"))
    i = F.col("issue")
    return exploded.select(
        *keep,
        "posicao",
        F.coalesce(i.getField("number").cast("string"), F.lit(DEFAULT_NUMBER)).alias("numero"),
        F.coalesce(i.getField("title"), F.lit(DEFAULT_TITLE)).alias("titulo"),
        F.coalesce(i.getField("user").getField("login"), F.lit(DEFAULT_AUTHOR)).alias("autor"),
        F.coalesce(i.getField("html_url"), F.lit(DEFAULT_URL)).alias("url"),
    )


# Reasons of the rejected issue listings.
ISSUES_NOT_JSON = "resposta não é JSON"
ISSUES_NO_LIST = "Resposta da API não contém lista de issues"


def _issues_reason(body: str):
    """Why a body has no issue list (NULL when it has one): the API's own
    message, no JSON at all, or JSON that is no list. ``variant`` parsing tells
    malformed text from other JSON."""
    text = F.col(body)
    message = F.get_json_object(text, "$.message")
    return (
        F.when(text.isNull() | F.try_parse_json(text).isNull(), ISSUES_NOT_JSON)
        .when(_issue_array(body).isNotNull(), F.lit(None).cast("string"))
        .otherwise(F.coalesce(message, F.lit(ISSUES_NO_LIST)))
    )


def issues_rejected(df: DataFrame, body: str = "body") -> DataFrame:
    """Bodies without an issue list, with the reason ``motivo``."""
    keep = [c for c in df.columns if c != body]
    return df.select(*keep, _issues_reason(body).alias("motivo")).filter(F.col("motivo").isNotNull())


def issues_summary(df: DataFrame, body: str = "body") -> DataFrame:
    """Per body: the issue count, or the reason why there is none."""
    reason = _issues_reason(body)
    keep = [c for c in df.columns if c != body]
    return df.select(
        *keep,
        F.when(reason.isNull(), F.size(_issue_array(body))).alias("total"),
        reason.alias("erro"),
    )
