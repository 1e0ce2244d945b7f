"""Constraint audits: the declared NOT NULL / UNIQUE / FOREIGN KEY rules of the
source schemas, checked as Spark aggregations instead of enforced on write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_not_null(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """One row per column: ``(table_name, column_name, null_rows, total_rows)``.

    A single pass with conditional sums (partial aggregation), then an unpivot.
    """
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"_n{i}") for i, c in enumerate(cols)
    ]
    counts = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return counts.selectExpr(
        f"'{table}' AS table_name", f"stack({len(cols)}, {pairs}) AS (column_name, null_rows)", "_total AS total_rows"
    ).select(
        "table_name", "column_name", F.col("null_rows").cast("bigint").alias("null_rows"), "total_rows"
    )


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count.

    As in SQL UNIQUE, rows with a NULL in any key column are exempt.
    """
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    return (
        df.filter(not_null)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def audit_foreign_key(
    child: DataFrame, fk: str, parent: DataFrame, pk: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (``left_anti``)."""
    parent_keys = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    return child.filter(F.col(fk).isNotNull()).join(
        parent_keys, F.col(fk) == F.col("_pk"), "left_anti"
    )
