"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64-bit majorities over the XXH64 hashes of a text's word shingles; two
fingerprints link when at most ``max_bits`` bits differ. Links are found at anchors:

* The 64 bits are two halves. Of ``max_bits`` (at most 5) differing bits some half holds
  two or fewer.
* The anchors of a half are the words of a covering code: the (31, 26) Hamming code on its low
  31 bits times the free top bit. Every half lies within the covering radius 1 of an anchor.
* A fingerprint is copied to every anchor within the covering radius plus half the half's
  threshold, that is 1 + 1 = 2: 17 or 2 anchors a half, given by its syndrome. If two halves
  differ in two bits or fewer, some word m is within 1 of both, and the anchor within 1 of m
  is within 2 of both. So no link is lost, with far fewer copies than one side's full
  radius plus threshold would need.
* At each anchor the fingerprints are compared exactly on all 64 bits.

Equal fingerprints are one node from the start, so groups of exact copies cost nothing. An anchor
returns a spanning forest of its links, not all pairs; an anchor with more than ``block``
fingerprints is compared block against block in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import ROW, col, fresh, numbered, salted_lookup, staged, text_of
from .components import components

SEED = 42
_SLICE = 1 << 16
HALF = 0xFFFFFFFF


def fingerprint_of(text: str, words: int) -> int:
    """The signed 64-bit fingerprint of one text; hashes are gathered in slices of bounded size."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    n = max(1, len(parts) - words + 1)
    starts, ends = starts[:n].tolist(), ends[min(words, len(parts)) - 1 :].tolist()
    h64, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        hashes = [h64(line[a:b], SEED) for a, b in zip(starts[at : at + _SLICE], ends[at : at + _SLICE], strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * ones > n, bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprint(text: Column, words: int = 4) -> Column:
    """The fingerprint of a text column (null: empty, which is zero) as a signed long."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t or "", words) for t in texts], dtype="int64")

    return of(text)


def _covering_masks() -> list[list[int]]:
    """For each syndrome of a half: what to flip to reach each anchor within two bits."""
    bit = lambda p: 1 << (p - 1)  # noqa: E731  position 1 to 31
    top, out = 1 << 31, []
    for s in range(32):
        if s == 0:
            out.append([0, top])
            continue
        pairs = [bit(p) | bit(p ^ s) for p in range(1, 32) if p < p ^ s]
        out.append([bit(s), bit(s) | top, *pairs])
    return out


def _anchors(half: Column) -> Column:
    """The anchors (32-bit words as longs) within two bits of a half."""
    syndrome = F.lit(0)
    for j in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)
        syndrome = syndrome + F.bit_count(half.bitwiseAND(F.lit(mask))) % 2 * (1 << j)
    masks = F.array(*[F.array(*[F.lit(m).cast("long") for m in row]) for row in _covering_masks()])
    return F.transform(F.element_at(masks, syndrome.cast("int") + 1), lambda m: half.bitwiseXOR(m))


def at_anchors(prints: DataFrame) -> DataFrame:
    """Copies of each distinct fingerprint ``fp`` at its anchors: anchor (half in bit 32), fp."""
    low = F.col("fp").bitwiseAND(F.lit(HALF))
    high = F.shiftrightunsigned("fp", 32)
    both = F.concat(_anchors(low), F.transform(_anchors(high), lambda a: a.bitwiseOR(F.lit(1 << 32))))
    return prints.select(F.explode(both).alias("anchor"), "fp")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _forest(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that join within each group what at most ``max_bits`` apart joins; rows sorted by group.

    Each step compares every row with the k-th after it. Rows already joined are not compared
    again, and a group that is joined as a whole is left.
    """
    n, left, right = len(fp), [], []
    label = np.arange(n)  # least row known to be joined to each
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, int)
    member = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
    rows = np.arange(n)
    for k in range(1, n):
        rows = rows[rows + k < n]
        rows = rows[member[rows] == member[rows + k]]
        if not len(rows):
            break
        apart = rows[label[rows] != label[rows + k]]
        near = apart[_popcount(fp[apart] ^ fp[apart + k]) <= max_bits]
        if not len(near):
            continue
        for i in near.tolist():
            x, y = i, i + k
            while label[x] != x:
                x = label[x]
            while label[y] != y:
                y = label[y]
            if x != y:
                label[max(x, y)] = min(x, y)
                left.append(i)
                right.append(i + k)
        while (label[label] != label).any():
            label = label[label]
        whole = np.minimum.reduceat(label, starts) == np.maximum.reduceat(label, starts)
        rows = rows[~whole[member[rows]]]
    return fp[left], fp[right]


def _compare(max_bits: int, block: int, key: str, flag_large: bool):
    """Arrow mapper over rows sorted by ``key``: links, and with ``flag_large`` the rows of larger groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind: int, a: np.ndarray, b: np.ndarray, c: np.ndarray | int) -> pa.RecordBatch:
            c = np.broadcast_to(np.asarray(c, np.int64), len(a))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(a), kind, np.int32)), *(pa.array(np.asarray(x, np.int64)) for x in (a, b, c))],
                names=["kind", "a", "b", "c"],
            )

        def links(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            a, b = _forest(k, f, max_bits)
            if len(a):
                yield out(0, a, b, 0)

        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, np.int64)
        large, seen = None, 0  # the group now known to be large, and how many of its rows went out
        for batch in batches:
            k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            f = batch.column(batch.schema.get_field_index("fp")).to_numpy(zero_copy_only=False)
            k, f = np.concatenate([held_k, k]), np.concatenate([held_f, f])
            if large is not None:
                n = int(np.searchsorted(k != large, True)) if (k != large).any() else len(k)
                if n:
                    yield out(1, k[:n], f[:n], (seen + np.arange(n)) // block)
                    seen += n
                k, f = k[n:], f[n:]
                if not len(k):
                    held_k, held_f = k, f
                    continue
                large = None
            if not len(k):
                continue
            first = int(np.flatnonzero(k == k[-1])[0]) if k[0] != k[-1] else 0
            if flag_large:
                starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
                sizes = np.diff(np.r_[starts, len(k)])
                big = np.repeat(sizes > block, sizes)
                pos = np.arange(len(k)) - np.repeat(starts, sizes)
                if big.any():
                    yield out(1, k[big], f[big], pos[big] // block)
                    if big[-1]:
                        large, seen = k[-1], int(sizes[-1])
                keep = ~big[:first]
                yield from links(k[:first][keep], f[:first][keep])
                tail = ~big[first:]
                held_k, held_f = k[first:][tail], f[first:][tail]
            else:
                yield from links(k[:first], f[:first])
                held_k, held_f = k[first:], f[first:]
        yield from links(held_k, held_f)

    return run


def near_links(prints: DataFrame, max_bits: int = 4, block: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join all that are ``max_bits`` or fewer apart."""
    if not 0 <= max_bits <= 5:
        raise ValueError("max_bits must be 0 to 5: a half then holds two differing bits or fewer")
    kinds = "kind int, a long, b long, c long"
    found = staged(
        at_anchors(prints)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "fp")
        .mapInArrow(_compare(max_bits, block, "anchor", True), kinds),
        "simhash-anchors",
    )
    links = found.where("kind = 0").select("a", "b")
    large = found.where("kind = 1").select(F.col("a").alias("anchor"), F.col("b").alias("fp"), F.col("c").alias("blk"))
    last = large.groupBy("anchor").agg(F.max("blk").alias("last"))
    pairs = large.join(last, "anchor").select(
        "fp", "anchor", "blk", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("other")
    )
    unit = F.xxhash64("anchor", F.least("blk", "other"), F.greatest("blk", "other")).alias("unit")
    more = (
        pairs.select(unit, "fp")
        .repartition("unit")
        .sortWithinPartitions("unit", "fp")
        .mapInArrow(_compare(max_bits, block, "unit", False), kinds)
        .select("a", "b")
    )
    return links.union(more).distinct()


def _members(rows: DataFrame, max_bits: int, block: int) -> DataFrame:
    """fp -> root (a fingerprint) and component_id (least doc_id reachable; null ids do not count)."""
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-prints")
    roots = components(near_links(prints.select("fp"), max_bits, block), "a", "b")
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return salted_lookup(rooted.select("fp", "root", F.col("fp").alias(ROW)), least, ["root"]).drop(ROW)


def _prints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    return staged(
        numbered(docs.select(col(id_col).alias("doc_id"), fingerprint(col(text_col), words).alias("fp"))), "simhash"
    )


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    max_bits: int = 4,
    block: int = 4096,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``; shingles of ``words`` words count as
    often as they occur; a shorter text is one shingle; an empty or null text has fingerprint
    zero and links like any other. ``component_id`` is the smallest doc_id reachable over links;
    null ids get a component but never name one (null if it has no other). Repeated rows all
    return. An empty table gives an empty result; other columns are ignored.
    """
    rows = _prints(docs, id_col, text_col, words)
    return salted_lookup(rows, _members(rows, max_bits, block), ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    max_bits: int = 4,
    block: int = 4096,
) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component, with all its columns.

    Of a component without ids, one row stays; rows that repeat in id and fingerprint collapse.
    """
    fp, keep, keep_fp = fresh(docs, "fp", "component_id", "keep_fp")
    rows = _prints(docs, id_col, text_col, words)
    stay = (
        salted_lookup(rows, _members(rows, max_bits, block), ["fp"])
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("component_id").alias(keep), F.min("fp").alias(keep_fp))
        .drop("root")
    )
    marked = docs.withColumn(fp, fingerprint(col(text_col), words))
    joined = marked.join(
        stay.hint("shuffle_merge"), (marked[fp] == stay[keep_fp]) & marked[id_col].eqNullSafe(stay[keep])
    )
    return joined.drop(keep, keep_fp).dropDuplicates([fp, id_col]).drop(fp)
