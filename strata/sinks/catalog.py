"""Managed tables and views, and merges that a catalog with row-level operations does itself."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.merge import SET_ALL, Clause


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> bool:
    """Create the database if it is missing and use it; True if it was created."""
    missing = not spark.catalog.databaseExists(name)
    if missing:
        at = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")
    spark.sql(f"USE {name}")
    return missing


def ensure_tables(
    spark: SparkSession, tables: Mapping[str, str], database: str, provider: str = "parquet",
    partitioned: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Create the declared tables that are missing; returns the names of those created."""
    if not spark.catalog.databaseExists(database):
        raise ValueError(f"database {database} does not exist; create it before its tables")
    created = []
    for name, schema in tables.items():
        if spark.catalog.tableExists(f"{database}.{name}"):
            continue
        by = (partitioned or {}).get(name)
        clause = f" PARTITIONED BY ({', '.join(by)})" if by else ""
        spark.sql(f"CREATE TABLE {database}.{name} ({schema}) USING {provider}{clause}")
        created.append(name)
    return created


def recreate_table(
    spark: SparkSession, name: str, schema: str, database: str, provider: str = "parquet",
) -> None:
    """Replace a table by an empty one of the declared schema."""
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    ensure_tables(spark, {name: schema}, database, provider)


def set_up_once(spark: SparkSession, database: str, location: str | None, tables: Mapping[str, str]) -> bool:
    """Create database and tables if the database is missing; True if this call did it."""
    if not ensure_database(spark, database, location):
        return False
    spark.catalog.clearCache()
    ensure_tables(spark, tables, database)
    return True


def save_table(df: DataFrame, name: str, mode: str = "overwrite", provider: str = "parquet") -> None:
    """Write a result as a managed table."""
    df.write.format(provider).mode(mode).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Write a large dimension as a managed table whose files are laid out and sorted by its join keys.

    A join on these keys reads the table as it lies and shuffles the other side only, which for a stream is each micro-batch.
    Choose ``buckets`` as the shuffle width of the queries that join it.
    """
    laid_out = df.repartition(buckets, *keys)  # one file for each bucket
    laid_out.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def overwrite_rows(df: DataFrame, table: str) -> None:
    """Replace the rows of an existing table, matching columns by name."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.insertInto(table, overwrite=True)


def external_table(spark: SparkSession, name: str, schema: StructType, location: str, partitions: Sequence[str]) -> None:
    """A table of that name over Parquet folders that others write, with the partitions that are there by now.

    Dropping the table leaves the folders alone.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
              f" PARTITIONED BY ({', '.join(partitions)}) LOCATION '{location}'")
    recover_partitions(spark, name)


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Tell the catalog of all folders below an external table."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _spec(values: Mapping[str, str | int]) -> str:
    return ", ".join(f"{k} = '{v}'" if isinstance(v, str) else f"{k} = {v}" for k, v in values.items())


def add_partition(spark: SparkSession, name: str, values: Mapping[str, str | int], location: str | None = None) -> None:
    """Tell the catalog of a folder that was added to an external table; a known one changes nothing."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({_spec(values)}){at}")


def drop_partition(spark: SparkSession, name: str, values: Mapping[str, str | int]) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec(values)})")


def lasting_view(spark: SparkSession, name: str, statement: str) -> None:
    """A view that the catalog keeps: every session sees it, and it reads its tables anew each time."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {statement}")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Name a result for SQL in this session, replacing an earlier one of that name."""
    df.createOrReplaceTempView(name)
    return df


def merge_into_catalog(source: DataFrame, table: str, keys: Sequence[str], matched: Sequence[Clause] = ()) -> None:
    """The same merge as the staged tables', run by the catalog of ``table``.

    For formats with row-level operations; plain Parquet tables refuse it. Conditions and
    assignments name the stored row ``t`` and the source row ``s``, as elsewhere.
    """
    aliased = source.alias("s")
    on = F.lit(True)
    for key in keys:
        on = on & (F.expr(f"{table}.{key}") == F.col(f"s.{key}"))
    writer = aliased.mergeInto(table, on)
    for condition, assignments in matched:
        when = writer.whenMatched(F.expr(_qualify(condition, table))) if condition else writer.whenMatched()
        if assignments == SET_ALL:
            writer = when.updateAll()
        else:
            writer = when.update({c: F.expr(_qualify(e, table)) for c, e in assignments.items()})
    writer.whenNotMatched().insertAll().merge()


def _qualify(sql: str, table: str) -> str:
    """The stored row's columns by the table's name; text in quotes stays as it is."""
    return re.sub(r"'(?:[^'\\]|\\.)*'|\bt\.", lambda m: m[0] if m[0][0] == "'" else f"{table}.", sql)
