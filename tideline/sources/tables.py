"""Table scans, batch and streaming (Parquet by default, any registered format otherwise)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_scan(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """``spark.read.format(fmt).options(**o).load(path)``.

    Projections and filters applied to the result reach the scan (column
    pruning, ``PushedFilters``), so callers select what they need afterwards.
    """
    return spark.read.format(fmt).options(**(options or {})).load(path)


def table_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The files of a table as a stream, with the schema that the table has now.

    Every file that is there when the query first starts is read, then those that are added. ``files_per_batch`` bounds a
    micro-batch. Projections and filters reach the scan as in :func:`table_scan`. A path may name a single file.
    """
    table = table_scan(spark, path, fmt, options)
    reader = spark.readStream.schema(table.schema).format(fmt).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    first = table.select("_metadata.file_path").first()
    if first and first[0].rstrip("/").endswith("/" + path.rstrip("/").rsplit("/", 1)[-1]):
        # The stream source takes folders and patterns: a pattern with one match stands for a single file.
        path = f"{path[:-1]}[{path[-1]}]"
    return reader.load(path)
