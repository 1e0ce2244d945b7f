"""Row-level cleaning operators: projections, casts, normalisation, filters,
stamps, hashes, defaults and deduplication."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import row_hash, to_date_safe, to_timestamp_ntz_safe
from strata.session import scratch_dir


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Keep the listed columns, renamed ``old -> new``, in mapping order."""
    return df.select([F.col(old).alias(new) for old, new in mapping.items()])


def ordered_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Select the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select([c for c in order if c in present])


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` naming the missing columns; return ``df`` unchanged."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def with_ingest_meta(
    df: DataFrame, source: str, ts: Column | None = None, ts_col: str = "_ingestion_ts"
) -> DataFrame:
    """Ingestion stamp and source label. ``ts`` is injectable for tests."""
    stamp = ts if ts is not None else F.current_timestamp()
    return df.withColumn(ts_col, stamp).withColumn("_source", F.lit(source))


def with_row_hash(
    df: DataFrame, cols: Sequence[str] | None = None, name: str = "_row_hash",
    null_token: str | None = None,
) -> DataFrame:
    """Hash of the source columns (all current columns by default)."""
    return df.withColumn(name, row_hash(list(cols or df.columns), null_token=null_token))


def bronze_stamp(
    df: DataFrame, source: str, ts: Column | None = None, null_token: str | None = None
) -> DataFrame:
    """Bronze landing: stamp, source label and a hash of the raw columns only."""
    raw_cols = list(df.columns)
    out = with_ingest_meta(df, source, ts)
    return with_row_hash(out, raw_cols, null_token=null_token)


_CASTS = {
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "bigint": "bigint",
    "double": "double",
    "string": "string",
}


def cast_expr(c: Column, spec: str) -> Column:
    """NULL-on-failure cast. ``spec``: a type name, ``decimal(p,s)``,
    ``date`` / ``date:<pattern>`` or ``timestamp_ntz:<pattern>``."""
    if spec.startswith("date"):
        _, _, fmt = spec.partition(":")
        return to_date_safe(c, fmt or None)
    if spec.startswith("timestamp_ntz:"):
        return to_timestamp_ntz_safe(c, spec.split(":", 1)[1])
    return c.try_cast(_CASTS.get(spec, spec))


def cast_columns(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast columns in place; bad values become NULL (the ANSI-off behaviour)."""
    return df.withColumns({name: cast_expr(F.col(name), s) for name, s in spec.items()})


_NORMALISERS = {
    "trim": F.trim,
    "upper": F.upper,
    "lower": F.lower,
}


def normalize_text(df: DataFrame, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """Apply ``trim``/``upper``/``lower`` steps in order, per column."""
    out = {}
    for name, steps in spec.items():
        c = F.col(name)
        for step in steps:
            c = _NORMALISERS[step](c)
        out[name] = c
    return df.withColumns(out)


def filter_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def filter_positive(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Strictly positive; NULL fails the test and is dropped."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) > 0)
    return df.filter(cond)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``coalesce(col, default)``; a default may be a literal or a Column."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), v if isinstance(v, Column) else F.lit(v))
            for name, v in defaults.items()
        }
    )


def dedupe(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None, dealt: bool = False
) -> DataFrame:
    """One row per key (NULL keys form one group, as ``dropDuplicates`` does).

    The survivor is fixed: the row whose remaining columns (``order_by``, default
    all non-key columns in schema order) are smallest, NULLs first. Built as
    ``min(struct(...))`` so a key holding millions of copies is folded map-side
    before the shuffle, never gathered into one task.

    ``dealt`` is for keys with few copies: the rows are dealt by key as they are and
    folded there, so no task sorts the rows of its input split, and what follows may
    use that the rows lie by key. A key's rows then meet in one task.
    """
    if dealt:
        df = df.repartition(*keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by is not None else rest
    carried = order + [c for c in rest if c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in carried])).alias("_keep")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_keep.{c}").alias(c) for c in carried]).select(
        *df.columns
    )


# Rows that one task may hold in order: a head of up to so many is a plain top-n.
TOP_ROWS = 100_000
_SKETCH_ERROR = 0.03  # of the rows sketched; twice the usual rank error of the sketch's default size


def head_rows(df: DataFrame, n: int, order_by: Sequence[str | Column], top_rows: int = TOP_ROWS) -> DataFrame:
    """First ``n`` rows in an explicit order (Spark has no file order), NULLs first.

    Up to ``top_rows`` a bounded top-n: each task keeps its ``n`` best. Beyond it the
    place of rank ``n`` is bracketed by quantile sketches of the leading key, one
    column read each time, and checked by exact counts; rows below the bracket are a
    pushed-down filter, and only those inside it are put in order. Nothing is
    written. Where a bracket cannot be made small (a leading key that many rows
    share, or one that is no number, date or timestamp), the rows inside it are
    dealt into ranges of the whole key. Rows that tie in the whole key may stand
    for each other.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if n <= top_rows:
        return df.orderBy(*order).limit(n)
    rank = _rank_key(df, order_by[0])
    below, inside, need = None, df, n
    if rank is not None:
        key, lowest = rank
        low, high, need, size = _bracket(df.select(key.alias("key")), n, top_rows, lowest)
        if low is None and high is None and size <= need:  # the whole table
            return df.orderBy(*order)
        at = key if low is None and high is None else F.coalesce(key, F.lit(lowest))
        if low is not None:
            below, inside = df.filter(at < low), inside.filter(at >= low)
        if high is not None:
            inside = inside.filter(at <= high)
        kept = inside.orderBy(*order).limit(need) if size <= top_rows else _head_by_ranges(inside, need, order)
    else:
        kept = _head_by_ranges(inside, need, order)
    return (kept if below is None else below.unionByName(kept)).orderBy(*order)


def _rank_key(df: DataFrame, leading: str | Column) -> tuple[Column, int] | None:
    """A long that orders as the leading column does, and the value that stands
    for its NULLs."""
    if not isinstance(leading, str):
        return None
    kind, c = df.schema[leading].dataType.typeName(), F.col(leading)
    if kind in ("byte", "short", "integer", "long"):
        return c.cast("bigint"), -(2**63)
    if kind == "date":
        return F.unix_date(c).cast("bigint"), -(2**63)
    if kind == "timestamp":
        return F.unix_micros(c), -(2**63)
    return None


def _bracket(keys: DataFrame, n: int, top_rows: int, lowest: int) -> tuple[int | None, int | None, int, int]:
    """(low, high, need, size): the row of rank ``n`` is the one of rank ``need``
    among the ``size`` rows whose key is from low to high (None: no bound). Keys
    that are NULL count as ``lowest``."""
    key = F.coalesce(F.col("key"), F.lit(lowest)).alias("key")
    keys, low, high, need = keys.select(key), None, None, n
    while True:
        part = keys
        if low is not None:
            part = part.filter(F.col("key") >= low)
        if high is not None:
            part = part.filter(F.col("key") <= high)
        rows, grid = part.agg(
            F.count(F.lit(1)),
            F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint("key"), F.array(*[F.lit(i / 100) for i in range(101)])),
        ).first()
        if rows <= top_rows or rows <= need:
            return low, high, need, rows
        place = need / rows
        a = grid[max(0, math.floor(100 * (place - _SKETCH_ERROR)))]
        b = grid[min(100, math.ceil(100 * (place + _SKETCH_ERROR)))]
        before, between = part.agg(F.count_if(F.col("key") < a), F.count_if(F.col("key").between(a, b))).first()
        if not before < need <= before + between:  # the sketch was further off than it says
            return low, high, need, rows
        low, high, need = a, b, need - before
        if between <= top_rows or between > rows // 2:
            return low, high, need, between


def _head_by_ranges(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows by ranges of the whole ordering key: the rows are written
    with their range's number, the ranges counted, and a row stays when the ranges
    before its own and its place inside it reach at most ``n``. No task holds
    more than a range."""
    spark = df.sparkSession
    path = scratch_dir(spark, "head_rows")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    before = counts.select("_range", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_before"))
    needed = dealt.join(before.filter(F.col("_before") < n), "_range")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    kept = needed.withColumn("_place", place).filter(F.col("_before") + F.col("_place") <= n)
    return kept.select(*df.columns)
