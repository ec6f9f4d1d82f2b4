"""A Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf. The leaves of a group ascend by id and are reduced pairwise, level by level, to the
group's root; the group roots, in the order of their names, are reduced alike to the root of the dataset.

The tree is cut into superblocks of ``2 ** depth`` neighbouring nodes of one tier:

* Up: each superblock is reduced in one task of its own to one node of the next tier, until a group has one
  node. Then the group roots are the lowest tier of the tree above.
* Down: the siblings above a superblock (its outer nodes) are few, about one for each level. From the top,
  each tier's nodes are cogrouped by superblock with the outer nodes that their superblock got, and hand the path of
  every node on to the superblock below it.
* At the leaves one cogroup by superblock finishes the local reduction, joins each leaf's local siblings with the
  outer ones to its proof, and folds a claimed leaf along it up to the root.

A task holds one superblock and its outer nodes, however large a group is. Positions come from a
range partitioning by (group, id) and the row counts of its partitions, so no task sees a whole group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, col, numbered, staged

LONE, LEFT, RIGHT = 0, 1, 2  # no sibling at this level, or the side on which it stands
NODE = "grp string, pos long, n long, digest binary"
STEP = "grp string, block long, step int, side int, across boolean, digest binary"


def digest_of(*parts: bytes) -> bytes:
    """SHA-256 over digests given and returned as lowercase hex text."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def field(value: Column) -> Column:
    """A value as leaf input: ``-`` for null, else the number of its UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def reduce_levels(nodes: list[bytes], whole: bool, depth: int) -> list[list[bytes]]:
    """The nodes and the levels above them, pairwise; a last one without partner is digested alone.

    ``whole``: until one node remains. Otherwise the nodes are a part of a longer row, and ``depth`` levels follow.
    """
    levels = [nodes]
    while len(levels[-1]) > 1 or (not whole and len(levels) <= depth):
        below = levels[-1]
        levels.append([digest_of(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def local_path(levels: list[list[bytes]], at: int) -> list[tuple[int, bytes]]:
    """(side, sibling) for each level from the node ``at`` to the top of ``levels``."""
    out = []
    for level in levels[:-1]:
        other = at ^ 1
        out.append((LONE, b"") if other >= len(level) else (LEFT if at & 1 else RIGHT, level[other]))
        at >>= 1
    return out


def fold(node: bytes, path: Sequence[tuple[int, bytes]]) -> bytes:
    for side, sibling in path:
        node = digest_of(sibling, node) if side == LEFT else digest_of(node, sibling) if side == RIGHT else digest_of(node)
    return node


def _hex(values: pd.Series) -> list[bytes]:
    return [v.hex().encode() for v in values]


def _outer(steps: pd.DataFrame) -> tuple[list[tuple[int, bytes]], int]:
    """The path above a superblock, and how many of its steps are inside the group."""
    steps = steps.sort_values("step")
    path = [(s, b"" if s == LONE else d.hex().encode()) for s, d in zip(steps["side"], steps["digest"], strict=True)]
    return path, int((~steps["across"].to_numpy(bool)).sum())


def _placed(rows: DataFrame, order: Sequence[str], kind: str) -> DataFrame:
    """``rows`` with pos, the place in the order within ``grp``, and n, the number of rows of ``grp``."""
    ranged = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    fixed = staged(numbered(ranged.withColumn("part", F.spark_partition_id())), kind)
    runs = fixed.groupBy("grp", "part").agg(F.min(ROW).alias("first"), F.count(F.lit(1)).alias("rows"))
    group = Window.partitionBy("grp")
    runs = runs.select(
        "grp",
        "part",
        (F.sum("rows").over(group.orderBy("part")) - F.col("rows") - F.col("first")).alias("shift"),
        F.sum("rows").over(group).alias("n"),
    )
    placed = fixed.join(runs, ["grp", "part"])
    return placed.withColumn("pos", F.col(ROW) + F.col("shift")).drop("part", ROW, "shift")


def _blocked(nodes: DataFrame, depth: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", depth))


def _reduced(nodes: DataFrame, depth: int, kind: str) -> DataFrame:
    """The next tier: one node for each superblock of ``nodes`` (grp, pos, n, digest)."""

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        top = reduce_levels(_hex(rows["digest"]), n <= 1 << depth, depth)[-1][0]
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "n": [-(-n >> depth)], "digest": [bytes.fromhex(top.decode())]})

    narrow = _blocked(nodes.select("grp", "pos", "n", "digest"), depth)
    return staged(narrow.groupBy("grp", "block").applyInPandas(reduce, NODE), kind)


def _tiers(nodes: DataFrame, depth: int, kind: str) -> list[DataFrame]:
    """``nodes`` and the tiers above them, up to the first in which every group has one node."""
    tiers = [nodes]
    while len(tiers) == 1 or (tiers[-1].agg(F.max("n")).first()[0] or 1) > 1:
        tiers.append(_reduced(tiers[-1], depth, f"{kind}-{len(tiers)}"))
    return tiers


def _paths(nodes: DataFrame, outer: DataFrame, depth: int, across: bool, goes: tuple[str, Column]) -> DataFrame:
    """The whole path of every node, as outer nodes of the superblock (``goes``: its group and number) below it."""

    def join(key: tuple, rows: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
        above, inside = _outer(steps)
        rows = rows.sort_values("pos")
        levels = reduce_levels(_hex(rows["digest"]), rows["n"].iloc[0] <= 1 << depth, depth)
        out = []
        for i, (grp, block) in enumerate(zip(rows["to_grp"], rows["to_block"], strict=True)):
            local = local_path(levels, i)
            for step, (side, sibling) in enumerate([*local, *above]):
                far = across or step >= len(local) + inside
                out.append((grp, block, step, side, far, None if side == LONE else bytes.fromhex(sibling.decode())))
        return pd.DataFrame(out, columns=["grp", "block", "step", "side", "across", "digest"])

    wanted = nodes.select("grp", "pos", "n", "digest", col(goes[0]).alias("to_grp"), goes[1].alias("to_block"))
    return _blocked(wanted, depth).groupBy("grp", "block").cogroup(outer.groupBy("grp", "block")).applyInPandas(join, STEP)


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    claims: Mapping[str, Column] | None = None,
    depth: int = 10,
    proofs: bool = False,
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the SHA-256 of the fields of ``columns`` (see :func:`field`). Leaves of a group ascend by id (null first),
    then by leaf, so rows that repeat are interchangeable and all of them are leaves. A null group is a group,
    before all others; names order by their UTF-8 bytes. ``proof_sha256`` is the digest of the leaf's siblings up to the
    root. ``claims`` gives values (of ``docs``' columns) that replace columns in the row that is verified: its leaf is folded with the
    original siblings to ``folded_root``, and ``verified`` says whether that is the root. ``proofs`` adds the proof itself
    (``proof``, siblings from the leaf up, with side). An empty table gives an empty result; other columns are ignored. A superblock
    has ``2 ** depth`` nodes.
    """
    claims = dict(claims or {})
    values = [col(c) for c in columns]
    claimed = [claims.get(c, col(c)) for c in columns]
    changed = F.lit(False)
    for c in columns:
        if c in claims:
            changed = changed | ~claims[c].eqNullSafe(col(c))
    group = col(group_col).cast("string")
    leaves = staged(
        docs.select(
            F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("grp"),
            col(id_col).alias("doc_id"),
            leaf_digest(values).alias("digest"),
            F.when(changed, leaf_digest(claimed)).alias("claim"),
        ),
        "merkle-leaves",
    )
    leaves = _placed(numbered(leaves).withColumnRenamed(ROW, "tie"), ["doc_id", "digest", "tie"], "merkle-order")
    leaves = staged(leaves.drop("tie"), "merkle-placed")
    tiers = _tiers(leaves, depth, "merkle-tier")
    tops = tiers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    above = _tiers(_placed(tops, ["name"], "merkle-groups"), depth, "merkle-above")

    spark = docs.sparkSession
    outer = spark.createDataFrame([], STEP)
    for tier in reversed(above[1:-1]):
        outer = _paths(tier, outer, depth, True, ("grp", F.col("pos")))
    outer = _paths(above[0], outer, depth, True, ("name", F.lit(0).cast("long")))
    for tier in reversed(tiers[1:-1]):
        outer = _paths(tier, outer, depth, False, ("grp", F.col("pos")))
    outer = staged(outer, "merkle-outer")

    def finish(key: tuple, rows: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
        above, inside = _outer(steps)
        rows = rows.sort_values("pos")
        own = _hex(rows["digest"])
        levels = reduce_levels(own, rows["n"].iloc[0] <= 1 << depth, depth)
        subroot = fold(levels[-1][0], above[:inside])
        root = fold(subroot, above[inside:])
        far = b"".join(s for _, s in above)
        out = []
        for i, claim in enumerate(rows["claim"]):
            path = local_path(levels, i)
            proof = digest_of(*(s for _, s in path), far)
            folded = fold(own[i] if claim is None else claim.hex().encode(), path)
            out.append((proof.decode(), fold(folded, above).decode()))
            if proofs:
                out[-1] += ([f"{'-<>'[side]}{s.decode()}" for side, s in [*path, *above] if side != LONE],)
        made = pd.DataFrame(out, columns=["proof_sha256", "folded_root", *(["proof"] if proofs else [])], index=rows.index)
        made["no_id"], made["doc_id"] = rows["no_id"], rows["doc_id"]
        made["leaf"] = [d.decode() for d in own]
        made["subroot"], made["root"] = subroot.decode(), root.decode()
        return made

    given = _blocked(leaves, depth).withColumn("no_id", F.col("doc_id").isNull())
    id_type = leaves.schema["doc_id"].dataType.simpleString()
    # Pandas has no null among integers: missing ids travel as 0 and a flag.
    given = given.withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast(id_type)))
    schema = f"doc_id {id_type}, no_id boolean, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    done = given.groupBy("grp", "block").cogroup(outer.groupBy("grp", "block"))
    done = done.applyInPandas(finish, schema + (", proof array<string>" if proofs else ""))
    return done.select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
        *(["proof"] if proofs else []),
    )
