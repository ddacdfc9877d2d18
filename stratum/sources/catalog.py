"""Catalog-level helpers: schemas (databases), table listing, column lists,
materialising a frame as a table, loading a set of tables, exporting a schema.

All of them go through ``spark.catalog`` / ``DataFrameWriter``; no SQL text is
generated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def base_tables(spark: SparkSession, schema: str) -> list[str]:
    """Names of the stored tables of ``schema`` (temporary views left out)."""
    return sorted(t.name for t in spark.catalog.listTables(schema)
                  if not t.isTemporary and t.tableType in ("MANAGED", "EXTERNAL"))


def table_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names of a catalog table in ordinal order."""
    return [c.name for c in spark.catalog.listColumns(table)]


def all_columns(spark: SparkSession, schema: str) -> list[tuple[str, str, str]]:
    """(table, column, type) for every base table of ``schema``."""
    out = []
    for t in base_tables(spark, schema):
        for c in spark.catalog.listColumns(f"{schema}.{t}"):
            out.append((t, c.name, c.dataType))
    return out


def materialize(df: DataFrame, name: str, schema: str | None = None,
                path: str | None = None, partition_by: list[str] | None = None) -> None:
    """Full-refresh a model: overwrite table ``schema.name`` (or ``path``)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w.parquet(path)
    else:
        if schema:
            create_schema(df.sparkSession, schema)
        w.saveAsTable(f"{schema}.{name}" if schema else name)


def load_tables(spark: SparkSession, names: list[str], schema: str | None = None,
                root: str | None = None) -> dict[str, DataFrame]:
    """name -> DataFrame for a list of tables (catalog tables or parquet
    folders under ``root``).  Frames are lazy; cache only what is reused."""
    if root:
        return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}
    return {n: spark.table(f"{schema}.{n}" if schema else n) for n in names}


def export_schema(spark: SparkSession, schema: str, destination: str) -> list[str]:
    """Copy every base table of ``schema`` to ``destination/<table>`` (parquet,
    overwrite); returns the tables copied."""
    tables = base_tables(spark, schema)
    for t in tables:
        spark.table(f"{schema}.{t}").write.mode("overwrite").parquet(f"{destination.rstrip('/')}/{t}")
    return tables


def export_folder(spark: SparkSession, names: list[str], source_root: str, destination: str) -> list[str]:
    """Same as ``export_schema`` for tables stored as parquet folders."""
    for t in names:
        spark.read.parquet(f"{source_root.rstrip('/')}/{t}").write.mode("overwrite").parquet(
            f"{destination.rstrip('/')}/{t}")
    return list(names)
