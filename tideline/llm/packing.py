"""Best-fit packing into sequences of several permitted lengths.

Texts are cut into pieces of at most the longest permitted length. Pieces are dealt by a hash
into shards of bounded size, and each shard is packed by itself: longest piece first, into the
open bin that it fits most tightly. Where none fits, a new bin of the least-cost size is opened:
the cost of a sequence (linear plus attention share) divided by the tokens that the remaining
pieces of the shard can bring to it. At last each bin is cut down to the shortest permitted length
that holds its contents. The lengths are thus chosen jointly while packing, not one after another.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW, col, numbered, staged, text_of
from .token_ids import token_counts

LENGTHS = (512, 1024, 2048, 4096)
#: A sequence of this many tokens costs twice its linear share (attention).
ATTENTION_EVEN = 16384
SCHEMA = "doc_id long, row_no long, piece int, start long, n_tokens int, shard int, bin int, bin_length int, offset int"


def sequence_cost(length: int) -> float:
    return length * (1 + length / ATTENTION_EVEN)


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit of one shard: for each size its bin, its offset there and the bin's final length."""
    lengths = tuple(sorted(lengths))
    order = np.argsort(-sizes, kind="stable")
    n = len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    falling = sizes[order]
    # total[i]: tokens of all pieces from the i-th longest on
    total = np.r_[np.cumsum(falling[::-1])[::-1], 0]
    rising = (-falling).tolist()
    room_of: list[list[int]] = [[] for _ in range(lengths[-1] + 1)]  # open bins by room left
    rooms: list[int] = []  # the rooms that have bins, sorted
    used: list[int] = []
    cap: list[int] = []
    cost = {c: sequence_cost(c) for c in lengths}
    for i, at in enumerate(order.tolist()):
        size = int(falling[i])
        j = bisect_left(rooms, size)
        if j < len(rooms):
            room = rooms[j]
            b = room_of[room].pop()
            if not room_of[room]:
                rooms.pop(j)
        else:
            best, room = float("inf"), lengths[-1]
            for c in lengths:
                if c >= size:
                    # pieces that fit beside this one: those no longer than what is left
                    first = max(i + 1, bisect_left(rising, -(c - size)))
                    fill = size + min(c - size, int(total[first]))
                    if cost[c] / max(fill, 1) < best:
                        best, room = cost[c] / max(fill, 1), c
            b = len(used)
            used.append(0)
            cap.append(room)
        bins[at], offsets[at] = b, used[b]
        used[b] += size
        left = room - size
        if left > 0:
            if not room_of[left]:
                rooms.insert(bisect_right(rooms, left), left)
            room_of[left].append(b)
    held = np.array(used, np.int64)
    final = np.array(lengths)[np.searchsorted(lengths, held)] if n else np.zeros(0, np.int64)
    return bins, offsets, final[bins] if n else final


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text: the places where one begins."""
    return F.when(F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     ")) == "", F.lit(0)).otherwise(
        F.size(F.split(F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     ")), " +"))
    )


def _packer(lengths: tuple[int, ...]):
    """Arrow mapper over a partition that is one shard, sorted by row and piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        sizes = rows.column(rows.schema.get_field_index("n_tokens")).to_numpy()
        bins, offsets, final = pack(sizes, lengths)
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, *(pa.array(x.astype(np.int32)) for x in (bins, final, offsets))],
            names=[*rows.schema.names, "bin", "bin_length", "offset"],
        )

    return run


def best_fit_packing(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens_col: str | None = None,
    tokenizer: str | None = None,
    lengths: tuple[int, ...] = LENGTHS,
    shard_pieces: int = 16384,
) -> DataFrame:
    """One row per piece of a document: where its tokens start, and its bin and offset there.

    Columns: doc_id, row_no (the document's row; repeated rows are packed each), piece, start and
    n_tokens (a range of the document's tokens), shard, bin (number within the shard), bin_length
    (one of ``lengths``), offset (in the bin). With ``tokenizer`` (a vocabulary file) tokens are the ids that
    ``token_ids.write_ids`` writes for the document, end id included, so a range is one of the stored ids; otherwise they are the numbers in
    ``tokens_col`` (null or negative: 0), or the text's words plus one end mark. A document without tokens
    is one piece of none. A shard has about ``shard_pieces`` pieces, which bounds a task's memory at every
    input size; each shard leaves at most a few bins unfilled. Nulls and empty texts have the end token alone. An empty table gives an
    empty result; other columns, whatever their names, are ignored.
    """
    lengths = tuple(sorted(set(lengths)))
    if not lengths or lengths[0] < 1:
        raise ValueError("lengths must be positive")
    top = lengths[-1]
    doc = col(id_col).cast("long").alias("doc_id")
    if tokenizer is not None:
        counted = token_counts(docs.select(doc, text_of(text_col).alias("text")), tokenizer, "text", "n")
    else:
        tokens = word_count(text_of(text_col)) + 1 if tokens_col is None else F.greatest(F.coalesce(col(tokens_col), F.lit(0)), F.lit(0))
        counted = docs.select(doc, tokens.cast("long").alias("n"))
    rows = staged(numbered(counted), "packing")
    last = F.greatest(F.ceil(F.col("n") / top) - 1, F.lit(0))
    pieces = rows.select(
        "doc_id", ROW, "n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece")
    ).select(
        "doc_id",
        ROW,
        F.col("piece").cast("int").alias("piece"),
        (F.col("piece") * top).alias("start"),
        F.least(F.col("n") - F.col("piece") * top, F.lit(top)).cast("int").alias("n_tokens"),
    )
    count = rows.agg(F.sum(last + 1)).first()[0] or 0
    shards = max(1, -(-int(count) // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(ROW, "piece"), F.lit(shards)).cast("int"))
    return dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions(ROW, "piece").mapInArrow(_packer(lengths), SCHEMA)
