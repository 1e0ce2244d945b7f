"""Constraints as gates on a load: rows are judged while they are written.

``load_gated`` writes its input once. Every row carries the names of the rules that
it breaks; the write splits accepted from rejected rows by directory and counts
both, and each rule, as observed metrics. The version is committed with the
accepted rows, the rejected ones lie beside them with their reasons, or the commit
is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from strata.sources import snapshots

REASONS, REJECTED = "_reasons", "_rejected"


class GateError(ValueError):
    """A load that breaks its rules and may not divert rows."""

    def __init__(self, counts: Mapping[str, int]):
        super().__init__("rows break rules: " + ", ".join(f"{k} {n}" for k, n in counts.items() if n))
        self.counts = dict(counts)


@dataclass(frozen=True)
class Rule:
    """A named rule: ``broken`` is a condition on the row, or the rule looks the
    row's ``columns`` up: as a key that only it has (``unique``) or in ``parent``."""

    name: str
    broken: Column | None = None
    columns: tuple[str, ...] = ()
    parent: DataFrame | None = None


def not_null(col: str) -> Rule:
    return Rule(f"{col} is null", F.col(col).isNull())


def check(name: str, holds: Column) -> Rule:
    """As SQL CHECK: broken where the condition is false, not where it is NULL."""
    return Rule(name, ~F.coalesce(holds, F.lit(True)))


def unique(*cols: str) -> Rule:
    """As SQL UNIQUE; all rows of a repeated key break it, rows with a NULL none."""
    return Rule(f"{', '.join(cols)} not unique", columns=cols)


def foreign_key(col: str, parent: DataFrame, key: str) -> Rule:
    """As SQL REFERENCES: a NULL breaks nothing."""
    keys = parent.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    return Rule(f"{col} has no parent", columns=(col,), parent=keys)


def judged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with ``_reasons``: the names of the rules that each row breaks.

    Conditions are evaluated in the row's own task. A foreign key is a left join
    to the distinct parent keys. For a unique key the repeated values are counted
    first (partial aggregate, key columns only) and met by a left join, so a key
    that a third of the rows share is never gathered.
    """
    cols, broken = list(df.columns), []
    out = df
    for i, rule in enumerate(rules):
        flag = f"_rule_{i}"
        if rule.broken is not None:
            broken.append(rule.broken)
            continue
        if rule.parent is not None:
            met = rule.parent.select(F.col("_key").alias(f"_key_{i}"), F.lit(True).alias(flag))
            out = out.join(met, F.col(rule.columns[0]) == F.col(f"_key_{i}"), "left")
            broken.append(F.col(rule.columns[0]).isNotNull() & F.col(flag).isNull())
            continue
        whole = reduce(and_, [F.col(c).isNotNull() for c in rule.columns])
        counts = df.filter(whole).groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        met = counts.select(*[F.col(c).alias(f"_key_{i}_{c}") for c in rule.columns], F.lit(True).alias(flag))
        out = out.join(met, reduce(and_, [F.col(c) == F.col(f"_key_{i}_{c}") for c in rule.columns]), "left")
        broken.append(F.col(flag).isNotNull())
    names = [F.when(b, F.lit(r.name)) for b, r in zip(broken, rules)]
    return out.select(*cols, F.array_compact(F.array(*names)).alias(REASONS))


def load_gated(df: DataFrame, path: str, rules: Sequence[Rule], divert: bool = True) -> dict[str, int]:
    """Write ``df`` as the next version of the snapshot table at ``path``; returns
    the numbers of accepted and rejected rows and of breaches of each rule.

    With ``divert`` the rejected rows lie with their reasons in the same version
    (``read_rejected``); without it one rejected row refuses the commit with a
    ``GateError``, and the table stays as it was.
    """
    spark = df.sparkSession
    latest = snapshots.latest_version(spark, path)
    version = 0 if latest is None else latest + 1
    rows = judged(df, rules).withColumn(REJECTED, F.size(REASONS) > 0)
    seen = Observation(f"gate_{uuid.uuid4().hex[:12]}")
    rules_broken = [F.count_if(F.array_contains(REASONS, r.name)).alias(f"rule_{i}") for i, r in enumerate(rules)]
    place = snapshots.version_path(path, version)
    observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(REJECTED).alias("rejected"), *rules_broken)
    observed.write.mode("overwrite").partitionBy(REJECTED).parquet(place)
    found = seen.get
    broken = {r.name: int(found[f"rule_{i}"]) for i, r in enumerate(rules)}
    counts = {"accepted": int(found["rows"]) - int(found["rejected"]), "rejected": int(found["rejected"]), **broken}
    if counts["rejected"] and not divert:
        raise GateError(broken)
    accepted = f"{place}/{REJECTED}=false"
    if not counts["accepted"]:
        spark.createDataFrame([], rows.drop(REJECTED).schema).write.mode("overwrite").parquet(accepted)
    part = snapshots.Part((), (), f"snapshot_version={version}/{REJECTED}=false")
    snapshots.commit_version(spark, path, version, "GATED LOAD", counts["accepted"], df.schema, parts=[part])
    return counts


def read_rejected(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rejected rows of the newest gated load, or of ``version``, with ``_reasons``."""
    version = snapshots.latest_version(spark, path) if version is None else version
    schema, _, place = snapshots.version_layout(spark, path, version)
    schema = StructType([*schema.fields, StructField(REASONS, ArrayType(StringType()))])
    if not snapshots.path_exists(spark, f"{place}/{REJECTED}=true"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{place}/{REJECTED}=true")
