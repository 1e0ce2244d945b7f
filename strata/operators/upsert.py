"""Upsert (MERGE) of a source frame into a target frame, on Parquet snapshots.

Semantics of ``MERGE ... WHEN MATCHED UPDATE SET <cols> WHEN NOT MATCHED INSERT *``:
matched rows take every listed column from the source, NULLs included; other
target rows stay as they are; unmatched source rows are inserted; keys that
are NULL never match; two source rows for one target row are an error.

One full outer join on the keys does all of it: presence flags tell matched,
target-only and source-only rows apart (``coalesce`` alone would let a NULL in
the source keep the old value). Rows with a NULL key match nothing; they stay
out of the join, where they would all meet in one task, and are added after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MergeConflictError(ValueError):
    """Two or more source rows match the same target row."""


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeated in the source also exists in the target.

    The repeated keys come from a partial aggregation, so a hot key costs one
    row per map task in the shuffle; only those keys meet the target.
    """
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    repeated = (
        source.select(*keys).filter(not_null).groupBy(*keys).count().filter(F.col("count") > 1).select(*keys)
    )
    hit = repeated.join(target.select(*keys), list(keys), "left_semi").limit(1).collect()
    if hit:
        raise MergeConflictError(f"several source rows match target key {tuple(hit[0])}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    check: bool = True,
) -> DataFrame:
    """Return the merged table in the target's column order."""
    keys = list(keys)
    if update_cols is None:
        update_cols = [c for c in target.columns if c not in keys and c in source.columns]
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns for INSERT *: {missing}")
    if check:
        check_single_match(target, source, keys)

    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    t = target.filter(~no_key).select(*[F.col(c).alias(f"t__{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = source.filter(~no_key).select(*[F.col(c).alias(f"s__{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    cond = None
    for k in keys:
        eq = F.col(f"t__{k}") == F.col(f"s__{k}")
        cond = eq if cond is None else cond & eq
    joined = t.join(s, cond, "full_outer")

    in_t = F.col("_in_t").isNotNull()
    in_s = F.col("_in_s").isNotNull()
    out = []
    for c in target.columns:
        tc, sc = F.col(f"t__{c}"), F.col(f"s__{c}")
        if c in keys:
            expr = F.when(in_t, tc).otherwise(sc)
        elif c in update_cols:
            expr = F.when(in_s, sc).otherwise(tc)
        else:
            expr = F.when(in_t, tc).otherwise(sc)
        out.append(expr.alias(c))
    unmatched = target.filter(no_key).unionByName(source.filter(no_key).select(*target.columns))
    return joined.select(*out).unionByName(unmatched)


def merge_into_layer(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
) -> int:
    """First load writes version 0; later loads upsert into the newest version
    and write the result as the next version. Returns the version written."""
    from strata.sources.snapshots import merge_snapshot

    return merge_snapshot(df, path, keys, update_cols, partition_by=partition_by)
