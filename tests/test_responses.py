"""API response tables: quote bodies and issue lists."""

import datetime as dt
import json
from decimal import Decimal

from strata.operators import responses as rs


def test_quotes(spark):
    bodies = [
        (1, json.dumps({"USDBRL": {"code": "USD", "codein": "BRL", "bid": "5.10", "create_date": "2026-04-19 16:54:00"}})),
        (2, json.dumps({"USDBRL": {"bid": "5.1234567", "create_date": "2026-04-19 16:54:00"}})),  # defaults
        (3, json.dumps({"other": {}})),
        (4, json.dumps({"USDBRL": {"code": "USD", "create_date": "2026-04-19 16:54:00"}})),
        (5, json.dumps({"USDBRL": {"bid": "5.1"}})),
        (6, "<html>not json</html>"),
        (7, json.dumps({"USDBRL": {"bid": "abc", "create_date": "2026-04-19 16:54:00"}})),
        (8, json.dumps({"USDBRL": {"bid": "5", "create_date": "19/04/2026"}})),
        (9, None),
    ]
    df = spark.createDataFrame(bodies, "response_id long, body string")
    ok = {r.response_id: r for r in rs.quotes_parsed(df).collect()}
    assert set(ok) == {1, 2}
    assert (ok[1].base, ok[1].moeda, ok[1].taxa) == ("USD", "BRL", Decimal("5.100000"))
    assert ok[1].data_referencia == dt.datetime(2026, 4, 19, 16, 54)
    assert (ok[2].base, ok[2].moeda, ok[2].taxa) == ("USD", "BRL", Decimal("5.123457"))
    bad = {r.response_id: r.motivo for r in rs.quotes_rejected(df).collect()}
    assert bad == {
        3: rs.MISSING_PAIR, 4: rs.MISSING_FIELDS, 5: rs.MISSING_FIELDS, 6: rs.NOT_JSON,
        7: rs.BAD_BID, 8: rs.BAD_DATE, 9: rs.NOT_JSON,
    }


def test_issues(spark):
    bodies = [
        (1, json.dumps([{"number": 7, "title": "Bug", "user": {"login": "ana"}, "html_url": "https://x/7"}, {}])),
        (2, "[]"),
        (3, json.dumps({"message": "Bad credentials"})),
        (4, "not json"),
        (5, "{}"),
        (6, None),
    ]
    df = spark.createDataFrame(bodies, "rid long, body string")
    rows = [(r.rid, r.posicao, r.numero, r.titulo, r.autor, r.url) for r in rs.issues_flat(df).orderBy("rid", "posicao").collect()]
    assert rows == [(1, 0, "7", "Bug", "ana", "https://x/7"), (1, 1, "N/A", "Sem título", "Desconhecido", "")]
    summary = {r.rid: (r.total, r.erro) for r in rs.issues_summary(df).collect()}
    assert summary == {1: (2, None), 2: (0, None), 3: (None, "Bad credentials"), 4: (None, rs.ISSUES_NOT_JSON), 5: (None, rs.ISSUES_NO_LIST), 6: (None, rs.ISSUES_NOT_JSON)}
    rejected = {r.rid: r.motivo for r in rs.issues_rejected(df).collect()}
    assert rejected == {k: why for k, (n, why) in summary.items() if n is None}


def test_quote_body_parsed_once(spark):
    """The validity filter sits above the parse: no ``from_json`` in a Filter,
    and one parse per row in the plan."""
    df = spark.createDataFrame([(1, '{"USDBRL": {"bid": "5.1", "create_date": "2026-04-19 16:54:00"}}')],
                               "response_id long, body string")
    plan = rs.quotes_parsed(df)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("from_json" in line for line in filters)
    assert plan.count("from_json") == 1
