"""Exact duplicates by a tree-merge of sorted digest runs.

Every partition turns its rows into a *run*: entries sorted by the digest of the
normalised text, one per digest, each with the best row seen and a count. Runs are
then exchanged in rounds. With a fan of 2 the rounds are the binomial exchange of
recursive halving; a larger fan exchanges among ``fan`` partitions per round and
merges that many runs at once. In round r a partition keeps the entries whose digest
has its own r-th digit and sends the others to the partner with that digit, so no
task ever holds more than its share of the digest space, and a digest with a third
of all rows is one entry per run. At every level two entries meet only if the
SHA-256, an independent 64-bit hash and the length of the normalised text agree;
the entry with the longest original text, then the smallest id, is retained.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, col, fresh, numbered, salted_lookup, staged, text_of

#: The characters that do not count: space and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"
KEYS = ["digest", "verify", "norm_len"]


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    norm = normalised(text)
    return docs.select(
        col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("n_points"),
        F.unhex(F.sha2(norm.cast("binary"), 256)).alias("digest"),
        F.xxhash64(norm).alias("verify"),
        F.length(norm).cast("long").alias("norm_len"),
    )


def _sorted(runs: DataFrame) -> DataFrame:
    """Runs in order; of one digest the entry that stays comes first."""
    return runs.sortWithinPartitions(*KEYS, F.desc("n_points"), F.asc_nulls_last("doc_id"), ROW)


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One entry per digest from sorted entries, in a stream; the first of equal ones is the best."""
    held: pa.Table | None = None
    for batch in batches:
        entries = pa.Table.from_batches([batch])
        if held is not None:
            entries = pa.concat_tables([held, entries])
        entries = entries.combine_chunks()
        if not entries.num_rows:
            continue
        n = entries.num_rows
        new = np.zeros(n, bool)
        new[0] = True
        for name in KEYS:
            c = entries.column(name)
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy()
        first = np.flatnonzero(new)
        at = entries.schema.get_field_index("n_rows")
        counts = np.add.reduceat(entries.column(at).to_numpy(), first)
        entries = entries.take(pa.array(first)).set_column(at, entries.schema.field(at), pa.array(counts))
        held = entries.slice(len(first) - 1)
        yield from entries.slice(0, len(first) - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def tree_merge(rows: DataFrame, fan: int = 8) -> DataFrame:
    """One entry per digest of ``rows`` (doc_id, n_points, digest, verify, norm_len, row_no).

    ``n_points``, ``doc_id`` and ``row_no`` are those of the row that stays, ``n_rows`` is the
    size of the group. The number of run partitions is the least power of ``fan`` that is not
    under ``spark.sql.shuffle.partitions``.
    """
    if fan < 2:
        raise ValueError("fan must be 2 or more")
    spark = rows.sparkSession
    parts, rounds = fan, 1
    while parts < int(spark.conf.get("spark.sql.shuffle.partitions")):
        parts, rounds = parts * fan, rounds + 1
    runs = rows.withColumn("n_rows", F.lit(1).cast("long")).withColumn(
        "place", F.pmod(F.spark_partition_id(), F.lit(parts)).cast("int")
    )
    schema = runs.schema
    runs = _sorted(runs).mapInArrow(_merge_runs, schema)
    home = F.pmod(F.xxhash64("digest"), F.lit(parts))
    for r in range(rounds):
        step = fan**r
        digit = lambda c: F.floor(c / F.lit(step)) % F.lit(fan)  # noqa: E731, B023
        to = (F.col("place") + (digit(home) - digit(F.col("place"))) * F.lit(step)).cast("int")
        sent = runs.withColumn("place", to).repartitionById(parts, F.col("place"))
        runs = _sorted(sent).mapInArrow(_merge_runs, schema)
    return runs.drop("place")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = 8) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after every blank of ``[\\x20\\x09-\\x0D]`` is deleted; a
    null text counts as empty. The row with the most code points in its original text stays,
    then the one with the smallest id (null ids last). Of rows that repeat in id and text
    exactly one is ``kept``. An empty table gives an empty result; other columns are ignored.
    """
    rows = staged(numbered(_digests(docs, id_col, text_col)), "digests")
    best = tree_merge(rows, fan).select(
        *KEYS, F.col("doc_id").alias("keep_id"), F.col("n_rows").alias("group_size"), F.col(ROW).alias("keep_row")
    )
    return salted_lookup(rows, best, KEYS).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col(ROW) == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = 8) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns.

    Rows that repeat in id and text collapse to one of them.
    """
    digest, keep, sha = fresh(docs, "digest", "keep_id", "text_sha256")
    kept = exact_dedup(docs, id_col, text_col, fan).where("kept")
    kept = kept.select(F.col("text_sha256").alias(sha), F.col("keep_id").alias(keep))
    marked = docs.withColumn(digest, F.sha2(normalised(text_of(text_col)).cast("binary"), 256))
    joined = marked.join(
        kept.hint("shuffle_merge"), (marked[digest] == kept[sha]) & marked[id_col].eqNullSafe(kept[keep])
    )
    return joined.drop(sha, keep).dropDuplicates([digest, id_col]).drop(digest)
