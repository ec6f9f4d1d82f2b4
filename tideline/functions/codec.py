"""Decoding of Kafka-shaped records and JSON payloads.

All work is done by built-in expressions (``cast``, ``from_json``, ``to_json``),
so Catalyst prunes the parsed struct to the fields a query uses and everything
stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed value: the transaction record declared by the original workload.
TRANSACTION_DDL = "timestamp DOUBLE, user_id INT, item STRING, quantity INT"
# The same with the user id as wide as the table's.
WIDE_DDL = TRANSACTION_DDL.replace("user_id INT", "user_id BIGINT")


def decode(df: DataFrame, key: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """``CAST(key AS STRING) AS key, CAST(value AS STRING) AS value`` (+ ``keep`` columns).

    ``from_json`` refuses BINARY input, so this step must come first.
    """
    cols: list[Column] = []
    if key:
        cols.append(F.col("key").cast("string").alias("key"))
    cols.append(F.col("value").cast("string").alias("value"))
    cols.extend(F.col(c) for c in keep)
    return df.select(*cols)


def _schema(ddl: str | StructType) -> StructType:
    if isinstance(ddl, StructType):
        return ddl
    return StructType.fromDDL(ddl)


def parse_json(
    df: DataFrame,
    schema: str | StructType = TRANSACTION_DDL,
    column: str = "value",
    alias: str = "data",
    expand: bool = True,
    corrupt_column: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse a JSON string column with a declared schema (PERMISSIVE).

    Malformed text or NULL gives a struct of NULLs and the row is kept; a field
    of the wrong JSON type becomes NULL. With ``corrupt_column`` the raw text of
    malformed records is kept in that column (for quarantine). ``expand``
    flattens the struct as ``select("data.*")``.
    """
    st = _schema(schema)
    options: dict[str, str] = {"mode": "PERMISSIVE"}
    if corrupt_column:
        st = StructType(st.fields + [_schema(f"{corrupt_column} STRING").fields[0]])
        options["columnNameOfCorruptRecord"] = corrupt_column
    parsed = df.select(
        *(F.col(c) for c in keep),
        F.from_json(F.col(column), st, options).alias(alias),
    )
    if not expand:
        return parsed
    return parsed.select(*(F.col(c) for c in keep), f"{alias}.*")


def to_kv_json(
    df: DataFrame,
    key: str,
    value_columns: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Kafka-sink record shape: ``key STRING, value STRING`` (JSON of ``value_columns``).

    ``to_json`` omits NULL fields.
    """
    return df.select(
        *(F.col(c) for c in keep),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*value_columns)).alias("value"),
    )
