"""File sinks and whole-database export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def copy_to(df: DataFrame, path: str, format: str = "parquet", partition_by: list[str] | None = None, order_by: list[str] | None = None, rows_per_file: int | None = None, mode: str = "errorifexists", **options: str) -> None:
    """COPY ... TO.  order_by sorts the whole (each file holds a range); rows_per_file starts new files."""
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.format(format).save(path)


def export_database(spark: SparkSession, tables: list[str], path: str) -> None:
    for t in tables:
        spark.table(t).write.parquet(f"{path}/{t}.parquet")


def import_database(spark: SparkSession, tables: list[str], path: str) -> None:
    for t in tables:
        spark.read.parquet(f"{path}/{t}.parquet").createOrReplaceTempView(t)
