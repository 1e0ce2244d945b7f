"""Versioned layer tables on plain Parquet.

A table at ``path`` holds one directory per version, ``snapshot_version=<n>``,
and a small append-only history table ``_history`` with one row per commit:
``version, committed_at, operation, num_rows, schema_json, txn, parts_json``.
The data is written first and the history row after it, so the history row is
the commit mark: a version whose write failed half-way is never visible. Each
version keeps its own schema (schema replacement on overwrite).

A partitioned version also lists its partitions' directories (``parts_json``), and
an unpartitioned one that a merge made lists its files. A merge rewrites only the
partitions or files it touches; for the others the new version lists what an older
version wrote. ``expire_snapshots`` removes what only old versions list.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.upsert import check_single_match, upsert
from strata.session import scratch_dir
from strata.sources.files import write_layer

HISTORY_DIR = "_history"

_HISTORY_SCHEMA = (
    "version bigint, committed_at timestamp, operation string, num_rows bigint, schema_json string, "
    "txn string, parts_json string"
)


@dataclass(frozen=True)
class Part:
    """One partition directory: its columns, their values as text (None: NULL)
    and its location below the table's path."""

    columns: tuple[str, ...]
    values: tuple[str | None, ...]
    location: str


@dataclass(frozen=True)
class Commit:
    version: int
    num_rows: int
    schema: StructType
    parts: tuple[Part, ...]


def _history_path(path: str) -> str:
    return f"{path.rstrip('/')}/{HISTORY_DIR}"


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/snapshot_version={version}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system the URI names."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def snapshot_history(spark: SparkSession, path: str) -> DataFrame:
    """The commit history, newest first (``DESCRIBE HISTORY``)."""
    hist_path = _history_path(path)
    if path_exists(spark, hist_path):
        hist = spark.read.schema(_HISTORY_SCHEMA).parquet(hist_path)
    else:
        hist = spark.createDataFrame([], _HISTORY_SCHEMA)
    return hist.orderBy(F.col("version").desc())


def _commit(spark: SparkSession, path: str, version: int | None = None, txn: str | None = None) -> Commit | None:
    """The newest commit, or that of ``version`` or ``txn``; ``None`` when there
    is none. One small job over the history table, whose size is the number
    of commits, not of data rows."""
    if not path_exists(spark, _history_path(path)):
        return None
    hist = snapshot_history(spark, path)
    if version is not None:
        hist = hist.filter(F.col("version") == version)
    if txn is not None:
        hist = hist.filter(F.col("txn") == txn)
    rows = hist.select("version", "num_rows", "schema_json", "parts_json").limit(1).collect()
    if not rows:
        return None
    r = rows[0]
    parts = [Part(tuple(p["columns"]), tuple(p["values"]), p["location"]) for p in json.loads(r["parts_json"] or "[]")]
    return Commit(int(r["version"]), int(r["num_rows"]), StructType.fromJson(json.loads(r["schema_json"])), tuple(parts))


def has_snapshot(spark: SparkSession, path: str) -> bool:
    return _commit(spark, path) is not None


def latest_version(spark: SparkSession, path: str) -> int | None:
    row = _commit(spark, path)
    return None if row is None else row.version


def _written_parts(spark: SparkSession, path: str, version: int) -> list[Part]:
    """The partition directories of a version just written, from its folder
    names (as many as there are partitions)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(version_path(path, version))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found: list[Part] = []

    def walk(folder, part: Part) -> None:
        below = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory() and "=" in s.getPath().getName()]
        if not below and part.columns:
            found.append(part)
        for child in below:
            name, _, value = child.getName().partition("=")
            text = None if value == "__HIVE_DEFAULT_PARTITION__" else unescape(value)
            walk(child, Part((*part.columns, unescape(name)), (*part.values, text), f"{part.location}/{child.getName()}"))

    walk(root, Part((), (), f"snapshot_version={version}"))
    return found


def _data_files(spark: SparkSession, path: str, version: int) -> list[Part]:
    """The data files of an unpartitioned version."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(version_path(path, version))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return [Part((), (), f"snapshot_version={version}/{n}") for n in names if n.endswith(".parquet") and n[0] not in "._"]


def _write_version(
    df: DataFrame,
    path: str,
    version: int,
    operation: str,
    partition_by: Sequence[str] | None,
    files: int | None,
    txn: str | None = None,
    kept: Sequence[Part] = (),
    kept_rows: int = 0,
) -> int:
    """Write the data of ``version``, then append its history row (the commit
    mark). The row count comes from an observed metric of the write itself,
    so the data is computed once. ``kept`` are partitions of older versions,
    with ``kept_rows`` rows, that belong to this one unchanged."""
    spark = df.sparkSession
    obs = Observation(f"snapshot_{version}_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("num_rows"))
    write_layer(observed, version_path(path, version), partition_by=partition_by, files=files)
    num_rows = int(obs.get["num_rows"]) + kept_rows
    written = _written_parts(spark, path, version) if partition_by else _data_files(spark, path, version) if kept else []
    parts = [*kept, *written]
    return commit_version(spark, path, version, operation, num_rows, df.schema, txn, parts)


def commit_version(
    spark: SparkSession,
    path: str,
    version: int,
    operation: str,
    num_rows: int,
    schema: StructType,
    txn: str | None = None,
    parts: Sequence[Part] = (),
) -> int:
    """Append the history row that makes a written version visible."""
    commit = spark.createDataFrame(
        [(version, operation, num_rows, schema.json(), txn, json.dumps([asdict(p) for p in parts]))],
        "version bigint, operation string, num_rows bigint, schema_json string, txn string, parts_json string",
    ).select(
        "version", F.current_timestamp().alias("committed_at"), "operation", "num_rows", "schema_json", "txn", "parts_json"
    )
    commit.coalesce(1).write.mode("append").parquet(_history_path(path))
    return version


def write_snapshot(
    df: DataFrame,
    path: str,
    operation: str = "WRITE",
    partition_by: Sequence[str] | None = None,
    files: int | None = None,
    txn: str | None = None,
) -> int:
    """Write ``df`` as the next version and commit it; returns the version.

    ``txn`` names the write. One that is already committed under that name is
    evaluated and thrown away (a replayed stream batch has to be consumed, or
    its state is not stored), and its version is returned.
    """
    spark = df.sparkSession
    if txn is not None:
        done = _commit(spark, path, txn=txn)
        if done is not None:
            df.write.format("noop").mode("overwrite").save()
            return done.version
    latest = latest_version(spark, path)
    version = 0 if latest is None else latest + 1
    return _write_version(df, path, version, operation, partition_by, files, txn)


def _read_commit(spark: SparkSession, path: str, commit: Commit, parts: Sequence[Part] | None = None) -> DataFrame:
    """The rows of a commit, or of some of its partitions."""
    if parts is None and not commit.parts:
        df = spark.read.schema(commit.schema).parquet(version_path(path, commit.version))
    else:
        places = [f"{path.rstrip('/')}/{p.location}" for p in (commit.parts if parts is None else parts)]
        if not places:
            return spark.createDataFrame([], commit.schema)
        df = spark.read.schema(commit.schema).option("basePath", path).parquet(*places)
    return df.select(*commit.schema.fieldNames())


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Read the newest committed version, or ``version`` (time travel).

    The stored schema restores column order and types, partition columns
    included.
    """
    row = _commit(spark, path, version)
    if row is None:
        if version is None:
            raise FileNotFoundError(f"no committed snapshot at {path}")
        raise ValueError(f"version {version} is not in the history of {path}")
    return _read_commit(spark, path, row)


def version_layout(spark: SparkSession, path: str, version: int) -> tuple[StructType, list[Part], str]:
    """Schema, partitions (absolute locations) and folder of a committed version."""
    row = _commit(spark, path, version)
    if row is None:
        raise ValueError(f"version {version} is not in the history of {path}")
    base = path.rstrip("/")
    return row.schema, [replace(p, location=f"{base}/{p.location}") for p in row.parts], version_path(path, version)


def merge_snapshot(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    operation: str = "MERGE",
    partition_by: Sequence[str] | None = None,
    files: int | None = None,
) -> int:
    """First load writes version 0; later loads upsert ``df`` into the newest
    version and commit the result as the next one.

    The source is evaluated once, into the shared scratch folder. One join of its
    counted keys with the target's key columns finds what is touched, and whether
    several source rows match one target row. Of a partitioned table only the
    partitions that a matched row lies in, or that a source row goes to, are read
    and written again, of an unpartitioned one only the files that hold a matched
    row; the next version takes the rest as they are. What reaches the driver is a
    list of partitions or files.
    """
    spark = df.sparkSession
    keys = list(keys)
    commit = _commit(spark, path)
    if commit is None:
        return _write_version(df, path, 0, "WRITE", partition_by, files)
    place = scratch_dir(spark, "merge-source")
    df.write.parquet(place)
    source = spark.read.schema(df.schema).parquet(place)
    parts, columns = list(commit.parts), tuple(partition_by or ())
    if not columns and not parts:
        parts = _data_files(spark, path, commit.version)
    known = bool(parts) and all(p.columns == columns and (columns or p.location.endswith(".parquet")) for p in parts)
    if columns:
        where = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    else:
        where = F.struct(F.regexp_extract("_metadata.file_path", "snapshot_version=.*$", 0).alias("file"))
    counted = source.filter(reduce(and_, [F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    matched = _read_commit(spark, path, commit).select(*keys, where.alias("_where")).join(counted, keys)
    found = matched.groupBy("_where").agg(F.max("_n").alias("n")).collect()
    if any(r.n > 1 for r in found):
        check_single_match(_read_commit(spark, path, commit), source, keys)
    kept: list[Part] = []
    if known:
        hit = {tuple(r["_where"]) for r in found}
        if columns:
            hit |= {tuple(r) for r in source.select(*[F.col(c).cast("string") for c in columns]).distinct().collect()}
        kept = [p for p in parts if (p.values if columns else (p.location,)) not in hit]
    touched = [p for p in parts if p not in kept]
    target = _read_commit(spark, path, commit, touched) if known else _read_commit(spark, path, commit)
    rows_kept = commit.num_rows - target.count() if kept else 0  # from the files' footers
    merged = upsert(target, source, keys, update_cols, check=False)
    return _write_version(merged, path, commit.version + 1, operation, partition_by, files, None, kept, rows_kept)


def replace_rows(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    gone: Column | None = None,
    operation: str = "REPLACE ROWS",
    txn: str | None = None,
) -> int:
    """Commit a version in which the rows of ``df`` stand for the rows that had
    their keys; where ``gone`` holds, the old row only goes.

    The keys include the partition columns, so only the partitions that ``df``
    names are read and written; the version lists the directories of the rest as
    they are. ``df`` holds a key once and is evaluated once, into the scratch
    folder; NULL keys are keys like any other. A ``txn`` that is committed already
    changes nothing, nor does an empty ``df`` on a table that exists.
    """
    spark = df.sparkSession
    if not set(partition_by) <= set(keys):
        raise ValueError("the keys must include the partition columns")
    place = scratch_dir(spark, "replace-source")
    df.write.parquet(place)
    source = spark.read.schema(df.schema).parquet(place)
    if txn is not None:
        done = _commit(spark, path, txn=txn)
        if done is not None:
            return done.version
    fresh = source if gone is None else source.filter(~gone)
    commit = _commit(spark, path)
    if commit is None:
        columns = [c for c in df.columns if gone is None or not c.startswith("_")]
        return _write_version(fresh.select(*columns), path, 0, operation, partition_by, None, txn)
    names = commit.schema.fieldNames()
    hit = {tuple(r) for r in source.select(*[F.col(c).cast("string") for c in partition_by]).distinct().collect()}
    if not hit:
        return commit.version
    touched = [p for p in commit.parts if p.values in hit]
    kept = [p for p in commit.parts if p.values not in hit]
    target = _read_commit(spark, path, commit, touched)
    rows_kept = commit.num_rows - target.count() if kept else 0
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"s__{k}")) for k in keys])
    left = target.join(source.select(*[F.col(k).alias(f"s__{k}") for k in keys]), same, "left_anti")
    merged = left.select(*names).unionByName(fresh.select(*names))
    return _write_version(merged, path, commit.version + 1, operation, partition_by, None, txn, kept, rows_kept)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], named: DataFrame, operation: str = "REPLACE PARTITIONS"
) -> int:
    """Commit a version in which the partitions that rows of ``named`` lie in hold
    the rows that ``df`` has of them; the version lists the directories of the rest
    as they are. ``df`` has the table's columns. A partition named that ``df`` has no
    row of is gone. An empty ``named`` changes nothing."""
    spark, columns = df.sparkSession, list(partition_by)
    values = named.select(*columns).distinct()  # as many as there are partitions
    hit = {tuple(r) for r in values.select(*[F.col(c).cast("string") for c in columns]).collect()}
    commit = _commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"no committed snapshot at {path}")
    if not hit:
        return commit.version
    touched = [p for p in commit.parts if p.values in hit]
    kept = [p for p in commit.parts if p.values not in hit]
    rows_kept = commit.num_rows - _read_commit(spark, path, commit, touched).count() if kept else 0
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"n__{c}")) for c in columns])
    wanted = F.broadcast(values.select(*[F.col(c).alias(f"n__{c}") for c in columns]))
    fresh = df.join(wanted, same, "left_semi").select(*commit.schema.fieldNames())
    return _write_version(fresh, path, commit.version + 1, operation, partition_by, None, None, kept, rows_kept)


def expire_snapshots(spark: SparkSession, path: str, keep: int) -> int:
    """Remove the data that only versions before the newest ``keep`` list; returns
    the number of directories and files removed. Those versions stay in the history
    but can no longer be read."""
    commits = snapshot_history(spark, path).select("version", "parts_json").collect()  # one row a commit
    listed = [{p["location"] for p in json.loads(c["parts_json"] or "[]")} or {f"snapshot_version={c['version']}"} for c in commits]
    needed = set().union(*listed[:keep])
    jvm = spark.sparkContext._jvm
    removed = 0
    for commit, places in zip(commits[keep:], listed[keep:]):
        own = f"snapshot_version={commit['version']}"
        if any(n.startswith(own + "/") for n in needed) and own in places:  # a newer version keeps some of its files
            places = {p.location for p in _data_files(spark, path, commit["version"])}
        for place in places - needed:
            if place == own or place.startswith(own + "/"):
                folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{place}")
                fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
                removed += int(fs.delete(folder, True))
    return removed
