"""What changed between two states of a table, as signed rows.

A changed row is its old form with a minus sign and its new form with a plus
sign, so aggregates that add (sums and counts) follow corrections and deletions
from the changes alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compared(old: DataFrame, new: DataFrame, keys: Sequence[str], sign: str = "_sign") -> DataFrame:
    """Every row of either table once, with ``sign``, the difference of its numbers
    in ``new`` and ``old``, and ``<sign>_new``, its number in ``new``.

    Both tables are dealt by ``keys`` (not again where they lie so already, as after
    ``dedupe(..., dealt=True)``) and their whole rows counted in one aggregate, so each
    is evaluated once, no row is fetched a second time and equality is exact. NULLs
    are equal to each other. The rows of one key meet in one task.
    """
    cols = list(new.columns)

    def side(df: DataFrame, by: int) -> DataFrame:
        return df.select(*cols).repartition(*keys).select(*cols, F.lit(by).alias("_by"))

    both = side(old, -1).unionByName(side(new, 1))
    return both.groupBy(*cols).agg(
        F.sum("_by").cast("int").alias(sign), F.count_if(F.col("_by") > 0).alias(f"{sign}_new")
    )


def signed_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], sign: str = "_sign") -> DataFrame:
    """The columns of ``new`` and ``sign``: the rows to take from ``old`` (negative)
    and to add to it (positive) to get ``new``.

    NULL keys are keys like any other. Copies of a row count: ``sign`` is the
    difference of their numbers.
    """
    return compared(old, new, keys, sign).filter(F.col(sign) != 0).drop(f"{sign}_new")
