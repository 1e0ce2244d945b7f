"""Catalog registration of layer tables (bronze / silver / gold databases)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from strata.sources.snapshots import HISTORY_DIR, latest_version, path_exists, read_snapshot, version_layout, write_snapshot


def register_layers(
    spark: SparkSession, tables: Mapping[str, Mapping[str, str]], source: str = "parquet"
) -> list[str]:
    """Create the layer databases and register existing table directories.

    ``tables`` maps a database (``bronze``, ``silver``, ``gold``) to
    ``{table_name: path}``. Missing directories are skipped; any other error
    (permissions, damaged files) is raised. The call can be repeated: a plain
    layer keeps its table and has its partitions recovered again, a versioned
    layer (``strata.sources.snapshots``) gets a table over its newest committed
    version, replaced when there is a newer one. Returns the qualified names
    that this call registered or replaced.
    """
    created = []
    for db, entries in tables.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        for name, path in entries.items():
            if not path_exists(spark, path):
                continue
            qualified = f"`{db}`.`{name}`"
            version = latest_version(spark, path) if path_exists(spark, f"{path.rstrip('/')}/{HISTORY_DIR}") else None
            if version is not None:
                new = _register_version(spark, db, name, path, version)
            else:
                new = not spark.catalog.tableExists(f"{db}.{name}")
                if new:
                    spark.catalog.createTable(f"{db}.{name}", path=path, source=source)
                if any(c.isPartition for c in spark.catalog.listColumns(f"{db}.{name}")):
                    spark.catalog.recoverPartitions(qualified)
            if new:
                created.append(f"{db}.{name}")
    return created


VERSION_PROPERTY = "strata.snapshot_version"
PARTITIONS_A_STATEMENT = 500


def _register_version(spark: SparkSession, db: str, name: str, path: str, version: int) -> bool:
    """A table over the newest version of a versioned layer; True when it is new.
    It lists that version's directories, so readers see one version only."""
    qualified = f"`{db}`.`{name}`"
    if spark.catalog.tableExists(f"{db}.{name}"):
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {qualified}").collect()}
        if properties.get(VERSION_PROPERTY) == str(version):
            return False
        spark.sql(f"DROP TABLE {qualified}")
    schema, parts, folder = version_layout(spark, path, version)
    if len(parts) > 1 and not parts[0].columns:
        # Files of several versions have no common folder: the newest version is written out.
        version = write_snapshot(read_snapshot(spark, path), path, operation="COMPACT")
        schema, parts, folder = version_layout(spark, path, version)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if len(parts) == 1 and not parts[0].columns:  # the accepted rows of a gated load
        folder = parts[0].location
    partitioned = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in parts[0].columns)})" if parts and parts[0].columns else ""
    spark.sql(
        f"CREATE TABLE {qualified} ({columns}) USING parquet {partitioned} "
        f"LOCATION '{folder}' TBLPROPERTIES ('{VERSION_PROPERTY}' = '{version}')"
    )
    # Many partitions a statement: the catalog is asked once for each batch.
    for at in range(0, len(parts) if partitioned else 0, PARTITIONS_A_STATEMENT):
        specs = []
        for part in parts[at : at + PARTITIONS_A_STATEMENT]:
            spec = ", ".join(f"`{c}` = {_sql_literal(v)}" for c, v in zip(part.columns, part.values))
            specs.append(f"PARTITION ({spec}) LOCATION '{part.location}'")
        spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS {' '.join(specs)}")
    return True


def _sql_literal(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def layer_tables(spark: SparkSession, databases: Iterable[str] | None = None) -> DataFrame:
    """``(database, table_name, table_type)`` for every listed database."""
    dbs = list(databases) if databases is not None else [d.name for d in spark.catalog.listDatabases()]
    rows = [
        (db, t.name, t.tableType) for db in dbs for t in spark.catalog.listTables(db) if not t.isTemporary
    ]
    return spark.createDataFrame(rows, "database string, table_name string, table_type string")
