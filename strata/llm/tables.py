"""Helpers shared by the corpus operators: stored tables, global order, running sums."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_dir


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage, so what is derived twice is computed once and a lost
    executor costs only the tasks it held.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def range_dealt(df: DataFrame, order: list[Column], name: str, part: str = "_part") -> DataFrame:
    """``df`` stored with the number of its range in the global order ``order``.

    Ranges are cut on the whole ordering key, so a value that a third of the
    rows share is spread over many ranges as long as later keys differ. The
    number is written with the row: what is computed from it does not change
    when a task is run again.
    """
    return stored(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), name)


def with_running_sum(
    df: DataFrame, group: list[str], order: list[Column], value: Column, out: str, name: str
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group up to and
    including this one, in the global order (group, ``order``).

    Two-level prefix sum: inside each range, then over one row per (range,
    group). NULL groups count as a group of their own.
    """
    dealt = range_dealt(df.withColumn("_value", value.cast("long")), [F.col(g) for g in group] + order, name)
    sums = dealt.groupBy("_part", *group).agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = dealt.withColumn("_inside", F.sum("_value").over(inside))
    keys = [rows["_part"] == offsets["_part"]] + [rows[g].eqNullSafe(offsets[g]) for g in group]
    cond = keys[0]
    for k in keys[1:]:
        cond = cond & k
    kept = [rows[c] for c in rows.columns if c not in ("_part", "_inside", "_value")]
    return rows.join(offsets, cond, "inner").select(*kept, (rows["_inside"] + offsets["_before"]).alias(out))


def located(path: str) -> str:
    """The place of a tokenizer file on this machine: ``path``, or the public
    tokenizer of that file name where an executor has it elsewhere."""
    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(os.path.basename(path))


def words_count(text: Column) -> Column:
    """Number of maximal runs of characters other than U+0020 and U+0009 to
    U+000D (NULL: 0)."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+", "w")
    return F.length(F.translate(squeezed, " \t\n\x0b\x0c\r", "")).cast("long")
