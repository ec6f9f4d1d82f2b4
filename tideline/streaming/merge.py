"""Keyed merge (upsert) of a batch into a table.

``merge`` is a pure function of two DataFrames. ``merge_into`` runs the same clauses on a
table of an installed format with row-level operations (Spark's ``MERGE INTO``), which is the
way for large tables: the format rewrites only the files it must. Two writers are for the
streams of this library where no such format is installed. ``MergeWriter`` keeps the merged result as plain Parquet, one
folder per micro-batch, so each batch rewrites the whole result, which suits results with few keys.
``PartitionMergeWriter`` keeps a partitioned table and reads and rewrites the partitions of a batch's keys alone.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tideline.streaming.files import list_names, remove
from tideline.streaming.sinks import batch_dir, completed_batches, read_latest_batch

Clauses = Mapping[str, str]


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _condition(on: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"target.`{k}`"), F.col(f"source.`{k}`")) for k in on]
    same = [t.eqNullSafe(s) if null_safe else t == s for t, s in pairs]
    return functools.reduce(Column.__and__, same)


def _checked(on: Sequence[str], update: Clauses | None) -> None:
    if not on:
        raise ValueError("a merge needs key columns")
    changed = [k for k in on if k in (update or {})]
    if changed:
        raise ValueError(f"a merge may not update the key columns {changed}")


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Clauses | None = None,
    insert: Clauses | None = None,
    null_safe: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """``target`` after an upsert of ``source`` on the columns ``on``.

    ``update`` maps columns of matched rows to SQL expressions over ``target.`` and ``source.`` (other
    columns keep their values), ``insert`` those of unmatched source rows to expressions over ``source.``
    (``None``: no inserts). Target rows without a source row are kept. A NULL key matches nothing, or with
    ``null_safe`` another NULL. Two source rows with one key that can match fail the job: which of
    them holds is undefined. Key columns may not be updated. ``observation`` gets ``rows_inserted`` and ``rows_updated``, counted
    by the plan itself, when the result is written.
    """
    _checked(on, update)
    update = update or {}
    keyed = functools.reduce(Column.__and__, [_col(k).isNotNull() for k in on])
    again = F.count(F.lit(1)).over(Window.partitionBy(*map(_col, on))) > 1
    twice = F.raise_error(F.concat(F.lit(f"more than one source row for a key of {list(on)}: "), F.to_json(F.struct(*map(_col, on)))))
    # Without null_safe, rows with a NULL key meet nothing: they go round the join, however many they are.
    joining = source if null_safe else source.where(keyed)
    joining = joining.withColumn("__source", F.when(again, twice.cast("boolean")).otherwise(F.lit(True)))
    kept = target if null_safe else target.where(keyed)
    joined = (
        kept.withColumn("__target", F.lit(True)).alias("target")
        .join(joining.alias("source"), _condition(on, null_safe), "full_outer")
    )
    if insert is None:
        joined = joined.where("target.__target")
    matched, new = F.col("source.__source") & F.col("target.__target"), F.col("target.__target").isNull()
    out = [F.when(new, "insert").when(matched & F.lit(bool(update)), "update").alias("__action")]
    for f in target.schema.fields:
        old = F.col(f"target.`{f.name}`")
        value = F.when(matched, F.expr(update[f.name]) if f.name in update else old)
        value = value.when(new, _inserted(insert, f.name)).otherwise(old)
        out.append(value.cast(f.dataType).alias(f.name))
    merged = joined.select(*out)
    if not null_safe:
        merged = merged.unionByName(target.where(~keyed).withColumn("__action", F.lit(None).cast("string")))
        if insert is not None:
            loose = source.where(~keyed).alias("source")
            values = [_inserted(insert, f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
            merged = merged.unionByName(loose.select(F.lit("insert").alias("__action"), *values))
    if observation is not None:
        did = lambda action: F.count_if(F.col("__action") == action)
        merged = merged.observe(observation, did("insert").alias("rows_inserted"), did("update").alias("rows_updated"))
    return merged.drop("__action")


def _inserted(insert: Clauses | None, name: str) -> Column:
    return F.expr(insert[name]) if insert and name in insert else F.lit(None)


def merge_into(
    table: str,
    source: DataFrame,
    on: Sequence[str],
    update: Clauses | None = None,
    insert: Clauses | None = None,
    null_safe: bool = False,
) -> None:
    """The same clauses as ``MERGE INTO`` on a catalogue table whose format has row-level operations."""
    _checked(on, update)
    spark = source.sparkSession
    view = f"merge_{uuid.uuid4().hex}"
    source.createTempView(view)
    sign = "<=>" if null_safe else "="
    sql = f"MERGE INTO {table} AS target USING {view} AS source ON " + " AND ".join(
        f"target.`{k}` {sign} source.`{k}`" for k in on
    )
    if update:
        sql += " WHEN MATCHED THEN UPDATE SET " + ", ".join(f"target.`{c}` = {e}" for c, e in update.items())
    if insert is not None:
        columns = ", ".join(f"`{c}`" for c in insert)
        sql += f" WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({', '.join(insert.values())})"
    try:
        spark.sql(sql)
    finally:
        spark.catalog.dropTempView(view)


class MergeWriter:
    """``foreachBatch`` callback: merges each batch into the result of the one before.

    Batch b writes ``merge(result before b, batch)`` to its own folder and removes folders older than the
    one before, so a replayed batch starts from the same rows and gives the same result. ``writer`` names
    the one streaming query of the table, for example by its checkpoint. A batch older than the newest,
    or another writer, is refused.
    """

    def __init__(
        self,
        path: str,
        writer: str,
        on: Sequence[str],
        update: Clauses | None = None,
        insert: Clauses | None = None,
        null_safe: bool = False,
    ):
        if not writer:
            raise ValueError("a merge needs the writer whose batches it gets")
        _checked(on, update)
        self.root = path.rstrip("/")
        self.path = f"{self.root}/{_owner(writer)}"
        self.on, self.update, self.insert, self.null_safe = list(on), update, insert, null_safe

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        others = [n for n in list_names(self.root) if f"{self.root}/{n}" != self.path]
        if others:
            raise RuntimeError(f"the table at {self.root} belongs to another writer")
        done = sorted(completed_batches(self.path))
        if done and done[-1] > batch_id:
            raise RuntimeError(f"batch {batch_id} comes after batch {done[-1]} of {self.root}")
        before = [b for b in done if b < batch_id]
        if before:
            target = spark.read.parquet(batch_dir(self.path, before[-1]))
        elif self.insert is None:
            raise ValueError("the table does not exist and no insert clause was given")
        else:
            first = batch_df.alias("source").select(*[F.expr(e).alias(c) for c, e in self.insert.items()])
            target = spark.createDataFrame([], first.schema)
        seen = Observation()
        merged = merge(target, batch_df, self.on, self.update, self.insert, self.null_safe, seen)
        merged.write.mode("overwrite").parquet(batch_dir(self.path, batch_id))
        _note(spark, self.root, batch_id, seen)
        for old in before[:-1]:
            remove(batch_dir(self.path, old))


def _note(spark: SparkSession, path: str, batch_id: int, seen: Observation) -> None:
    """What a batch's merge did, as observed in its write; a replayed batch replaces its note."""
    told = seen.get
    row = [(batch_id, "MERGE", told["rows_inserted"], told["rows_updated"])]
    fields = "batch_id BIGINT, operation STRING, rows_inserted BIGINT, rows_updated BIGINT"
    spark.createDataFrame(row, fields).coalesce(1).write.mode("overwrite").parquet(batch_dir(f"{path}-history", batch_id))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, operation, rows_inserted, rows_updated`` of every merge into the table at ``path`` (kept beside it)."""
    return spark.read.parquet(f"{path.rstrip('/')}-history/batch-*")


def _owner(writer: str) -> str:
    return "writer-" + hashlib.sha256(writer.encode()).hexdigest()[:16]


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The newest completed result of a :class:`MergeWriter`."""
    owners = list_names(path.rstrip("/"))
    if len(owners) != 1:
        raise RuntimeError(f"{path} has {len(owners)} writers, not one")
    return read_latest_batch(spark, f"{path.rstrip('/')}/{owners[0]}")


class PartitionMergeWriter:
    """``foreachBatch`` callback: merges each batch into the partitions that its keys are in, and leaves all others as they are.

    ``part`` is an expression over key columns (a natural partition such as a date, or :func:`hash_part`), so a key is always in
    the same partition. A batch reads the newest version of its partitions, merges, and writes them with dynamic partition overwrite
    as ``part=P/batch=N``; a replayed batch starts from the versions before it and replaces its own. A version is removed when
    a newer one than its successor is written, so every partition keeps at most two. ``writer`` names the one streaming
    query of the table. Readers that look while a batch is written may see some of its partitions before others. The partitions that a batch touches are
    listed on the driver, a name each.
    """

    def __init__(
        self,
        path: str,
        writer: str,
        on: Sequence[str],
        part: str,
        update: Clauses | None = None,
        insert: Clauses | None = None,
        null_safe: bool = False,
    ):
        if not writer:
            raise ValueError("a merge needs the writer whose batches it gets")
        _checked(on, update)
        self.root = path.rstrip("/")
        self.path = f"{self.root}/{_owner(writer)}"
        self.on, self.part, self.update, self.insert, self.null_safe = list(on), part, update, insert, null_safe

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        others = [n for n in list_names(self.root) if f"{self.root}/{n}" != self.path]
        if others:
            raise RuntimeError(f"the table at {self.root} belongs to another writer")
        source = batch_df.withColumn("part", _part_name(self.part))
        touched = [r["part"] for r in source.select("part").distinct().collect()]  # a name for each partition of the batch
        versions = {p: _versions(self.path, p) for p in touched}
        late = [p for p, found in versions.items() if found and found[-1] > batch_id]
        if late:
            raise RuntimeError(f"batch {batch_id} comes after a later one in partitions {sorted(late)[:5]} of {self.root}")
        before = {p: [v for v in found if v < batch_id] for p, found in versions.items()}
        paths = [_version_dir(self.path, p, found[-1]) for p, found in before.items() if found]
        if paths:
            target = spark.read.parquet(*paths)
        elif self.insert is None:
            return
        else:
            first = batch_df.alias("source").select(*[F.expr(e).alias(c) for c, e in self.insert.items()])
            target = spark.createDataFrame([], first.schema)
        seen = Observation()
        merged = merge(target, batch_df, self.on, self.update, self.insert, self.null_safe, seen)
        (
            merged.withColumn("part", _part_name(self.part))
            .withColumn("batch", F.lit(batch_id).cast("long"))
            .repartition("part")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("part", "batch")
            .parquet(self.path)
        )
        _note(spark, self.root, batch_id, seen)
        for p, found in before.items():
            for old in found[:-1]:
                remove(_version_dir(self.path, p, old))


def hash_part(on: Sequence[str], buckets: int) -> str:
    """Partition expression: one of ``buckets`` by the hash of the key columns."""
    return f"pmod(xxhash64({', '.join('`' + c + '`' for c in on)}), {int(buckets)})"


def _part_name(part: str) -> Column:
    """A partition's folder name: the value as text, every sign that could mean something else to a path as its hex code."""
    text = F.coalesce(F.expr(part).cast("string"), F.lit("none"))
    signs = F.transform(
        F.split(text, ""),
        lambda c: F.when(c.rlike("^[A-Za-z0-9.-]*$"), c).otherwise(F.concat(F.lit("_"), F.lower(F.hex(F.encode(c, "utf-8"))))),
    )
    return F.concat(F.lit("p"), F.array_join(signs, ""))


def _version_dir(path: str, part: str, batch_id: int) -> str:
    return f"{path}/part={part}/batch={batch_id}"


def _versions(path: str, part: str) -> list[int]:
    """The batches that wrote a partition, in order."""
    return sorted(int(n[6:]) for n in list_names(f"{path}/part={part}") if n.startswith("batch="))


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """The table of a :class:`PartitionMergeWriter`, with ``last_batch``: the batch that last wrote the row's partition.

    Each partition's newest version is taken, by a join with the newest batch of each folder name; file statistics
    do not have to be read for it.
    """
    owners = list_names(path.rstrip("/"))
    if len(owners) != 1:
        raise RuntimeError(f"{path} has {len(owners)} writers, not one")
    table = f"{path.rstrip('/')}/{owners[0]}"
    if not any(n.startswith("part=") for n in list_names(table)):
        raise FileNotFoundError(f"no completed batch under {path}")
    rows = spark.read.parquet(table)
    newest = rows.groupBy("part").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["part", "batch"]).drop("part").withColumn("last_batch", F.col("batch").cast("long")).drop("batch")
