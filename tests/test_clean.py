"""Row-level operators: NULL, tie and edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import high_value_flag, nanos_to_timestamp, row_hash, to_date_safe
from strata.operators.clean import (
    bronze_stamp,
    cast_columns,
    dedupe,
    fill_defaults,
    filter_not_null,
    filter_positive,
    head_rows,
    normalize_text,
    ordered_columns,
    rename_select,
    require_columns,
)


def test_filter_not_null_keeps_blank_and_needs_every_column(spark):
    df = spark.createDataFrame(
        [("k1", "", "z"), ("k2", None, "z"), ("k3", "v", None), ("k4", "v", "z")], "k string, a string, b string"
    )
    assert {r.k for r in filter_not_null(df, ["a"]).collect()} == {"k1", "k3", "k4"}
    assert {r.k for r in filter_not_null(df, ["a", "b"]).collect()} == {"k1", "k4"}


@pytest.mark.parametrize("amount, flag", [(41.0, False), (42.0, False), (42.01, True), (None, False), (float("inf"), True)])
def test_high_value_flag_is_strict_and_false_on_null(spark, amount, flag):
    df = spark.createDataFrame([(amount,)], "amount double")
    assert df.select(high_value_flag("amount", 42)).first()[0] is flag


def test_filter_positive_is_strict_over_every_column(spark):
    rows = [(n, q, v) for n, (q, v) in enumerate([(7, 0.01), (0, 3.0), (4, -0.01), (None, 8.0), (9, None), (1, 1.0)])]
    df = spark.createDataFrame(rows, "n int, q int, v double")
    assert [r.n for r in filter_positive(df, ["q", "v"]).orderBy("n").collect()] == [0, 5]


def test_normalize_text_applies_steps_in_order(spark):
    df = spark.createDataFrame([("  ÁbC ", " MiXed"), (None, "")], "a string, b string")
    out = normalize_text(df, {"a": ["trim", "upper"], "b": ["lower"]}).collect()
    assert [tuple(r) for r in out] == [("ÁBC", " mixed"), (None, "")]


def test_require_columns_returns_the_frame_or_names_all_missing(spark):
    df = spark.range(2).withColumn("v", F.lit(1))
    assert require_columns(df, ["v"]) is df
    with pytest.raises(ValueError, match="w, x"):
        require_columns(df, ["w", "id", "x"])


def test_row_hash_skips_nulls_like_concat_ws(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    hashes = [r.h for r in df.select(row_hash(["x", "y", "z"]).alias("h")).collect()]
    assert hashes[0] == hashes[1]  # (a, NULL, b) == (a, b, NULL): NULLs are skipped
    import hashlib

    assert hashes[0] == hashlib.sha256(b"a||b").hexdigest()
    distinct = df.select(row_hash(["x", "y", "z"], null_token="\\N").alias("h")).distinct().count()
    assert distinct == 2


def test_bronze_stamp_hashes_raw_columns_only(spark):
    df = spark.createDataFrame([(1, "x")], "id long, v string")
    out = bronze_stamp(df, "postgres", ts=F.lit("2024-01-01 00:00:00").cast("timestamp")).collect()[0]
    assert out._source == "postgres"
    import hashlib

    assert out._row_hash == hashlib.sha256(b"1||x").hexdigest()


def test_cast_columns_bad_values_become_null(spark):
    df = spark.createDataFrame(
        [("2024-01-05", "12.345", "7", "x"), ("2024-13-01", "abc", "9999999999", "2024-02-30")],
        "d string, m string, q string, e string",
    )
    out = cast_columns(df, {"d": "date:yyyy-MM-dd", "m": "decimal(10,2)", "q": "int", "e": "date:yyyy-MM-dd"}).collect()
    assert out[0].d == dt.date(2024, 1, 5) and out[0].m == Decimal("12.35") and out[0].q == 7 and out[0].e is None
    assert out[1].d is None and out[1].m is None and out[1].q is None and out[1].e is None


def test_iso_date_fast_path_matches_pattern_parse(spark):
    vals = ["2024-01-05", "2024-1-05", "2024-02-30", " 2024-01-05", "2024-01-05T10:00", "0024-01-05", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    rows = df.select(to_date_safe("s", "yyyy-MM-dd").alias("a"), F.try_to_date("s", "yyyy-MM-dd").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_nanos_to_timestamp(spark):
    df = spark.createDataFrame([(1_700_000_000_123_456_789,)], "t long")
    got = df.select(nanos_to_timestamp("t").cast("timestamp_ntz").alias("ts")).collect()[0].ts
    assert got == dt.datetime(2023, 11, 14, 22, 13, 20, 123456)


def test_nanos_to_timestamp_is_exact_and_floors(spark):
    # 19-digit values a double cannot hold exactly, and one before 1970.
    df = spark.createDataFrame([(1, 1_704_078_023_688_080_000), (2, 1_704_078_023_688_080_999), (3, -1)], "k int, t long")
    got = dict(df.select("k", nanos_to_timestamp("t").cast("timestamp_ntz").alias("ts")).collect())
    assert got[1] == got[2] == dt.datetime(2024, 1, 1, 3, 0, 23, 688080)
    assert got[3] == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)


def test_dedupe_fixed_survivor_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 9), (1, None, 5), (None, "x", 1), (None, "y", 0), (2, "z", 3)],
        "k long, v string, n long",
    )
    out = {(r.k, r.v, r.n) for r in dedupe(df, ["k"]).collect()}
    # NULLs sort first in the survivor order; NULL keys form one group.
    assert out == {(1, None, 5), (None, "x", 1), (2, "z", 3)}


def test_fill_defaults_and_projection(spark):
    df = spark.createDataFrame([(1, None, None), (2, "done", dt.date(2024, 1, 1))], "id long, status string, d date")
    out = fill_defaults(df, {"status": "pending", "d": F.lit("2024-06-01").cast("date")}).orderBy("id").collect()
    assert out[0].status == "pending" and out[0].d == dt.date(2024, 6, 1) and out[1].status == "done"
    renamed = rename_select(df, {"id": "venda_id", "status": "estado"})
    assert renamed.columns == ["venda_id", "estado"]
    assert ordered_columns(df, ["d", "missing", "id"]).columns == ["d", "id"]


def test_head_rows_explicit_order(spark):
    df = spark.range(100).withColumn("k", 99 - F.col("id"))
    assert [r.k for r in head_rows(df, 5, ["k"]).collect()] == [0, 1, 2, 3, 4]
    assert head_rows(df, 0, ["k"]).count() == 0


@pytest.mark.parametrize("top_rows", [100_000, 1_000])
def test_head_rows_is_exact_for_every_n(spark, top_rows):
    # NULL keys sort first; one value holds a third of the rows.
    df = spark.range(50_000).select(
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    for n in (1, 7_143, 20_000, 60_000):
        got = head_rows(df, n, ["k", "v"], top_rows=top_rows)
        ref = df.orderBy("k", "v").limit(n)
        assert got.count() == min(n, 50_000)
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


@pytest.mark.parametrize(
    "kind, values",
    [
        ("int", [-(2**31), 2**31 - 1, 0, None]),
        ("bigint", [-(2**63), 2**63 - 1, 0, None]),
        ("string", ["", "z", "é", None]),
        ("date", [dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(2024, 1, 1), None]),
    ],
)
def test_head_rows_lead_types(spark, kind, values):
    df = spark.createDataFrame([(v, i) for i in range(50) for v in values], f"k {kind}, i int")
    want = sorted(((v is not None, v, i) for i in range(50) for v in values), key=lambda r: (r[0], r[1] or values[2], r[2]))
    got = [(r.k, r.i) for r in head_rows(df, 120, ["k", "i"]).collect()]
    assert got == [(r.k, r.i) for r in head_rows(df, 120, ["k", "i"], top_rows=9).collect()]
    ref = [(r.k, r.i) for r in df.orderBy("k", "i").limit(120).collect()]
    assert got == ref and len(want) == 200


def test_head_rows_narrows_without_a_write(spark, monkeypatch):
    from strata.operators import clean

    monkeypatch.setattr(clean, "scratch_dir", None)  # a write would fail
    df = spark.range(200_000).select(F.xxhash64("id").alias("k"), F.col("id").alias("v")).repartition(4)
    for n in (3_000, 77_000, 199_999, 200_000, 300_000):
        got = head_rows(df, n, ["k", "v"], top_rows=2_000)
        want = [r.v for r in df.orderBy("k", "v").limit(n).collect()]
        assert [r.v for r in got.collect()] == want
    plan = head_rows(df, 5, ["k", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange range" not in plan
