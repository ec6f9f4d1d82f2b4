"""Record validation: split into good rows and a quarantine with reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``valid`` and ``reasons``: the names of the failed rules, comma-separated, in rule order.

    A row is valid iff every rule is TRUE (NULL fails). One projection of plain
    expressions (inside whole-stage codegen), so one pass serves a sink that is
    partitioned by ``valid``.
    """
    failed = {n: ~F.coalesce(c, F.lit(False)) for n, c in rules.items()}
    reasons = F.concat_ws(",", *[F.when(f, F.lit(n)) for n, f in failed.items()])
    return df.withColumn("reasons", reasons).withColumn("valid", F.col("reasons") == "")


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``, the quarantine with ``reasons``; together exactly the input."""
    tagged = with_reasons(df, rules)
    return tagged.where("valid").drop("reasons", "valid"), tagged.where(~F.col("valid")).drop("valid")
