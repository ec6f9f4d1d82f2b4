"""Exact top-k inner products by MaxScore.

Vectors become integers floor(1024 x); a vector is a document whose terms are the dimensions. Each shard
holds its vectors' postings term by term with the least and greatest value of each term. For a query every term's
contribution lies between two bounds; what a term gives above its lower bound is its (non-negative) impact.
Terms are ordered by greatest impact and split: the *non-essential* ones at the end cannot together lift a
document over the threshold (the k-th best score known), so documents are found by traversing the postings
of the essential terms only. Non-essential terms are then probed one group at a time for documents that are
still competitive. Each shard returns its exact k best, which are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROW, col, numbered, staged

_FIRST = 512  # documents scored in full to get a first threshold
_GROUP = 8  # terms probed at a time
_EXACT = float(1 << 53)


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, as doubles (whole numbers)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))


def usable(vector: Column) -> Column:
    """Neither null nor with a null, NaN or infinite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


class Postings:
    """A shard's vectors by term, with each term's least and greatest value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.terms = ids[order], np.ascontiguousarray(vectors[order].T)
        self.least = self.terms.min(axis=1) if len(ids) else np.zeros(len(self.terms))
        self.most = self.terms.max(axis=1) if len(ids) else np.zeros(len(self.terms))

    def own(self, vec_id: int, query: np.ndarray) -> int:
        """The place of the row with this id and vector, -1 if there is none."""
        width = len(self.terms)
        for at in range(*np.searchsorted(self.ids, [vec_id, vec_id + 1])):
            longer = max(width, len(query))
            if (np.pad(self.terms[:, at], (0, longer - width)) == np.pad(query, (0, longer - len(query)))).all():
                return at
        return -1

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best (score, then smaller id), the place ``own`` left out (-1: none)."""
        d = len(self.terms)
        q = np.zeros(d)
        q[: min(d, len(query))] = query[:d]
        both = np.stack([q * self.least, q * self.most])
        low, impact = both.min(axis=0), np.abs(both[1] - both[0])
        terms = np.argsort(-impact, kind="stable")
        # what the terms from each place on can still give: above their lower bound, and at least
        more = np.r_[np.cumsum(impact[terms][::-1])[::-1], 0.0]
        floor = np.r_[np.cumsum(low[terms][::-1])[::-1], 0.0]
        docs = np.delete(np.arange(len(self.ids)), own) if own >= 0 else np.arange(len(self.ids))
        if len(docs) <= k:
            return self._best(docs, q @ self.terms[:, docs], k)
        head = q @ self.terms[:, docs[:_FIRST]]
        threshold = np.sort(head)[-k] if len(head) >= k else -np.inf
        # essential: terms before the point from which on the rest cannot lift a document that has no impact so far
        split = int(np.searchsorted(-(more + floor[0]), -threshold, side="left"))
        split = max(1, min(d, split))
        partial = q[terms[:split]] @ self.terms[terms[:split]][:, docs]
        at = split
        while True:
            if len(docs) > k:
                threshold = max(threshold, np.partition(partial, -k)[-k] + floor[at])
            keep = partial + floor[at] + more[at] >= threshold
            docs, partial = docs[keep], partial[keep]
            if at == d:
                break
            some = terms[at : at + _GROUP]
            partial = partial + q[some] @ self.terms[some][:, docs]
            at = min(d, at + _GROUP)
        return self._best(docs, partial, k)

    def _best(self, docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[docs], -scores))[:k]
        return docs[order], scores[order]


def _exact_scores(query: np.ndarray, vectors: np.ndarray) -> list[int]:
    whole = [int(x) for x in query]
    return [sum(a * int(b) for a, b in zip(whole, v, strict=False)) for v in vectors]


def _rows(column: pa.Array) -> list[np.ndarray]:
    flat = column.values.to_numpy(zero_copy_only=False)
    ends = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _searcher(k: int):
    """Arrow mapper over (shard, kind, vec_id, vec, copies) sorted by shard and kind: vectors first, then queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, copies, vectors, shard = None, [], [], [], None

        def built() -> tuple[Postings, np.ndarray]:
            width = max(map(len, vectors), default=0)
            m = np.zeros((len(vectors), width))
            for i, v in enumerate(vectors):
                m[i, : len(v)] = v
            keys = np.array(ids, np.int64)
            return Postings(keys, m), np.array(copies, np.int64)[np.argsort(keys, kind="stable")]

        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            names = ("shard", "kind", "vec_id", "copies", "number")
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            for at, kind, vec_id, n, number, vec in zip(*columns, _rows(batch.column(batch.schema.get_field_index("vec"))), strict=True):
                if at != now:
                    now, ids, copies, vectors, shard = at, [], [], [], None
                if kind == 0:
                    ids.append(vec_id)
                    copies.append(n)
                    vectors.append(np.array(vec))
                    continue
                if shard is None:
                    shard, times = built()
                    vectors = []
                if not len(shard.ids):
                    continue
                # a query is one of the copies of its row: alone it is no candidate, of several it counts once less
                own = shard.own(vec_id, vec)
                alone = own if own >= 0 and times[own] == 1 else -1
                most = np.abs(shard.terms).max(initial=0.0)
                if np.abs(vec).sum() * most < _EXACT:
                    docs, scores = shard.top(vec, alone, k)
                else:  # too large for exact doubles: whole numbers without bound, held to the range of a long
                    docs = np.array([i for i in range(len(shard.ids)) if i != alone], np.int64)
                    got = zip(_exact_scores(vec, shard.terms[:, docs].T), docs.tolist(), strict=True)
                    best = sorted((-s, d) for s, d in got)[:k]
                    docs, scores = [d for _, d in best], [max(-(2**63), min(2**63 - 1, -s)) for s, _ in best]
                out += [
                    (number, vec_id, int(shard.ids[d]), int(s), int(times[d] - (d == own))) for d, s in zip(docs, scores, strict=True)
                ]
            if out:
                arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["number", "query_id", "vec_id", "score", "copies"])

    return run


def exact_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    shard_vectors: int = 131_072,
    least_shard: int = 8192,
) -> DataFrame:
    """Each query's k highest scores among ``vectors``: query_id, rank (from 1), vec_id, score.

    ``queries`` are rows of ``vectors`` or others. Candidates are all rows but the query's own: of rows that repeat its
    id and vector one does not count, the others do. Rows that repeat are searched once and count as often as they occur; queries that
    repeat are answered each. Ties go to the smaller vec_id. Vectors that are null or hold a
    null or non-finite component, and rows without id, take no part. A component that the shorter of two
    vectors lacks counts as zero. A query with no candidate gives no row, as does an empty table.

    Every query visits every shard, so the rows shuffled are the vectors and, for each shard, the queries: shards are as large as
    a task's memory allows (``shard_vectors`` rows), and smaller, down to ``least_shard``, only where the cluster would have idle cores.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        picked = df.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).alias("vec"))
        picked = picked.where("vec_id is not null").where(usable(F.col("vec")))
        return picked.select("vec_id", quantised(F.col("vec"), scale).alias("vec")).groupBy("vec_id", "vec").agg(F.count(F.lit(1)).alias("copies"))

    rows = staged(clean(vectors), "topk-vectors")
    asked = staged(numbered(clean(queries)).withColumnRenamed(ROW, "number"), "topk-queries")
    count = rows.count()
    shards = max(1, -(-count // shard_vectors), min(spark.sparkContext.defaultParallelism, -(-count // least_shard)))
    dealt = rows.select(
        F.pmod(F.xxhash64("vec_id", "vec"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"),
        "vec_id", "vec", "copies", F.lit(None).cast("long").alias("number"),
    )
    sent = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", "vec", "copies", "number"
    )
    found = (
        dealt.union(sent)
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "kind", "vec_id")
        .mapInArrow(_searcher(k), "number long, query_id long, vec_id long, score long, copies long")
    )
    best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    each = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy("place", "copy"))).where(F.col("rank") <= k)
    answers = ranked.join(asked.select("number", F.col("copies").alias("times")), "number")
    return answers.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
