"""Catalog tables: targets, control logs and status logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.checkpoints import lenient_rows, ordered_listing, purge_summary, required_columns


def table_name(database: str, schema: str, table: str) -> str:
    """Name of a database.schema.table triple in a catalog that has one level of databases."""
    parts = [p.strip() for p in (database, schema, table)]
    if not all(parts):
        raise ValueError(f"database, schema and table must all be given: {parts}")
    return f"`{parts[0]}__{parts[1]}`.`{parts[2]}`"


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: list[str] | None = None, location: str | None = None
) -> str:
    """Create database and Parquet table where absent; leave an existing table alone."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    at = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitioned} {at}")
    return name


def create_target_table(spark: SparkSession, database: str, schema: str, table: str, location: str | None = None) -> str:
    """Target table of a mapping."""
    return create_table(spark, table_name(database, schema, table), schemas.TARGET, location=location)


def create_control_table(spark: SparkSession, database: str, schema: str, table: str, location: str | None = None) -> str:
    """Control table, strict: ``append_control`` refuses rows that lack a required value."""
    return create_table(spark, table_name(database, schema, table), schemas.CONTROL, location=location)


def create_status_table(
    spark: SparkSession, database: str, schema: str, table: str = "ingestion_status", location: str | None = None
) -> str:
    """Status table, lenient: any value may be NULL, the insert time defaults to now."""
    return create_table(spark, table_name(database, schema, table), schemas.CONTROL, location=location)


def append_target(name: str, rows: DataFrame) -> None:
    """Append target rows; an empty batch writes no rows."""
    rows.select(*schemas.TARGET.names).write.insertInto(name)


def append_control(name: str, rows: DataFrame) -> None:
    """Append control rows of all partitions in one write."""
    required_columns(rows).select(*schemas.CONTROL.names).write.insertInto(name)


def append_status(name: str, rows: DataFrame) -> None:
    lenient_rows(rows).write.insertInto(name)


def purge_control(spark: SparkSession, name: str) -> DataFrame:
    """Remove all rows of a control table and return the count left, to be zero.

    ``ordered_listing(spark.table(name))`` shows them beforehand.
    """
    # An empty overwrite, since TRUNCATE refuses tables with a location of their own.
    spark.createDataFrame([], schemas.CONTROL).write.insertInto(name, overwrite=True)
    return purge_summary(spark.table(name))


def list_control(spark: SparkSession, name: str) -> DataFrame:
    return ordered_listing(spark.table(name))
