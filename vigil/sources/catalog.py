"""Catalog statements: schema, external table over the curated zone, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.config import DEFAULT_DATABASE, DEFAULT_TABLE
from vigil.operators.rules import conform
from vigil.schema import VISIT, ddl
from vigil.session import path_exists, qualified
from vigil.loads import current_versions
from vigil.sources.files import BATCH, STREAM


def _quote(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, database: str = DEFAULT_DATABASE, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` with an optional location."""
    loc = f" LOCATION {_quote(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")


def _table_location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _external(spark: SparkSession, database: str, table: str, columns: str, partitions: str, location: str,
              replace: bool) -> str:
    """External Parquet table over ``location``; an existing one over another place is an error unless replaced."""
    name = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(f"{database}.{table}"):
        current = qualified(spark, _table_location(spark, name) or location)
        if current != qualified(spark, location):
            if not replace:
                raise ValueError(f"{name} already points at {current}, not {location}")
            spark.sql(f"DROP TABLE {name}")  # external: the files stay
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({partitions}) LOCATION {_quote(location)}")
    return name


def register_table(
    spark: SparkSession,
    location: str,
    database: str = DEFAULT_DATABASE,
    table: str = DEFAULT_TABLE,
    replace: bool = False,
) -> str:
    """The curated zone as a table: one external table a writer, and a view of both under the table's name.

    The batch table is partitioned by load, version and ``visit_date``; its
    partitions follow the folders, and the view takes the current version of
    each load. The stream's output is served from its sink's commit log. Idempotent: existing tables over the same location are only
    refreshed. Call it (or ``refresh_table``) after each new load.
    """
    name = f"`{database}`.`{table}`"
    create_schema(spark, database)
    root = location.rstrip("/")
    batch = _external(spark, database, f"{table}_{BATCH}", ddl(VISIT) + ", `load` STRING, `version` STRING",
                      "load, version, visit_date", f"{root}/{BATCH}", replace)
    if path_exists(spark, f"{root}/{BATCH}"):
        spark.sql(f"MSCK REPAIR TABLE {batch} SYNC PARTITIONS")
    # Stamps are unique over all loads; a filter on a partition column prunes the versions that do not count.
    versions = ", ".join(f"'{v}'" for v in current_versions(spark, f"{root}/{BATCH}").values()) or "''"
    parts = [batch]
    if spark.catalog.tableExists(f"{database}.{table}_{STREAM}") or path_exists(spark, f"{root}/{STREAM}"):
        parts.append(_external(spark, database, f"{table}_{STREAM}", ddl(VISIT), "visit_date", f"{root}/{STREAM}",
                               replace))
    columns = ", ".join(f"`{f.name}`" for f in VISIT.fields)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + " UNION ALL ".join(
        f"SELECT {columns} FROM {p}" + (f" WHERE `version` IN ({versions})" if p == batch else "") for p in parts))
    for part in parts:
        spark.catalog.refreshTable(part)
    return name


def refresh_table(spark: SparkSession, name: str) -> None:
    """Pick up new loads, a stream's first output, and files written since the last read."""
    database, table = name.replace("`", "").split(".")
    batch = _table_location(spark, f"`{database}`.`{table}_{BATCH}`")
    register_table(spark, batch.rstrip("/").removesuffix(f"/{BATCH}"), database, table)


def scan_table(spark: SparkSession, name: str = f"{DEFAULT_DATABASE}.{DEFAULT_TABLE}") -> DataFrame:
    """The table in canonical column order (the partition column is stored last)."""
    return conform(spark.table(name), VISIT)


def list_catalogs(spark: SparkSession) -> list[str]:
    return [c.name for c in spark.catalog.listCatalogs()]


def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))
