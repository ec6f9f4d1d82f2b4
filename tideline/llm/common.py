"""Shared helpers of the training-data operators: staged tables, safe names, skew-safe lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.session import scratch_path, ship

__all__ = ["ROW", "col", "fresh", "numbered", "once", "salted_lookup", "ship", "staged", "table", "text_of"]

ROW = "row_no"


def col(name: str) -> Column:
    """A column by its exact name (dots and other signs are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(col(name), F.lit(""))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def once(value: Column, name: str) -> Column:
    """A generator column with one row: what stands above reads ``name`` instead of computing it again."""
    return F.explode(F.array(value)).alias(name)


def staged(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, executors may be lost.

    Row numbers made before the write are fixed by it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{kind}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """A unique number per row; only stable once written by :func:`staged`."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def salted_lookup(rows: DataFrame, mapping: DataFrame, keys: list[str], salts: int = 64) -> DataFrame:
    """Add the columns of ``mapping`` (one row per key) to every row of ``rows``.

    A key may hold a third of all rows: rows carry a salt, the distinct (key, salt)
    pairs fetch the value first (at most ``salts`` per key, pre-aggregated), and the
    rows then join on (key, salt). Keys must not be null; rows need ``row_no``.
    """
    salt = F.pmod(F.xxhash64(ROW), F.lit(salts)).cast("int")
    rows = rows.withColumn("salt", salt)
    spread = rows.select(*keys, "salt").distinct().join(mapping, keys)
    return rows.join(spread, [*keys, "salt"]).drop("salt")
