"""Near-duplicates by a chosen-path set similarity join.

A text is the set of its distinct word shingles. Texts with equal sets are one node from the start. Every set has
``COORDINATES`` minwise tokens (for each of as many hash functions the shingle with the least hash).

* Branch. The root of each tree picks one or two of the coordinates (on average 1 / similarity), and a set
  goes to the child named by its token there. A child with up to ``limit`` sets is a leaf; a larger one picks
  coordinates of its own and branches again, all trees level by level. Sets that share a child by
  chance alone are parted by the next level.
* Compare. The sets of a leaf are compared exhaustively by their minwise tokens. In a node that still has to branch, all sets are
  compared with one of them (the pivot); those near it are joined to it and need no comparison with one another, so a node that
  is one group of near copies ends there. What is still large after ``max_depth`` levels is compared block by block.
* Repeat. A pair at the least similarity shares a leaf of one tree with a probability that follows from the similarity and the depth;
  ``recall`` sets the number of independent trees.
* Confirm. The joins so far form candidate groups. The full shingle sets of their members are made from the texts again, and within
  a group all pairs that no link joins yet are compared exactly; only these links count.

A comparison returns a spanning forest, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, col, numbered, salted_lookup, staged, text_of
from .components import components

COORDINATES = 128
_SLICE = 1 << 11
_MANY = 1 << 18


def _constants(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, np.uint64)


_PLACES = _constants(1, 64) | np.uint64(1)
_FUNCTIONS = _constants(2, COORDINATES) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit word for each one."""
    x = np.array(x, np.uint64)
    with np.errstate(over="ignore"):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str, words: int = 5) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a shorter text is one shingle, a blank one none."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), len(parts))], np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    n = len(parts) - words + 1
    made = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(words):
            made += each[j : j + n] * _PLACES[j]
    return np.unique(_mix(made))


def minwise(hashes: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), _SLICE):
            np.minimum(least, (hashes[at : at + _SLICE, None] * _FUNCTIONS).min(axis=0), out=least)
    return least


def tokens_of(least: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set in 16 bits each."""
    return (_mix(least) >> np.uint64(48)).astype(np.uint16)


def picked(nodes: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The coordinates that each node picks: one, and a second (-1: none) as often as makes 1 / ``least`` on average."""
    nodes = np.asarray(nodes, np.uint64)
    with np.errstate(over="ignore"):
        first = (_mix(nodes + np.uint64(1)) % np.uint64(COORDINATES)).astype(np.int64)
        second = (_mix(nodes + np.uint64(2)) % np.uint64(COORDINATES)).astype(np.int64)
        chance = _mix(nodes + np.uint64(3)) >> np.uint64(11)
    taken = chance < np.uint64(int(min(1.0, 1 / least - 1) * 2**53))
    return first, np.where(taken & (second != first), second, -1)


def child(nodes: np.ndarray, coordinate: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(nodes * np.uint64(0x9E3779B97F4A7C15) + _mix(token) + coordinate.astype(np.uint64))


def roots(trees: int) -> np.ndarray:
    return _mix(np.arange(1, trees + 1, dtype=np.uint64) << np.uint64(32))


def survival(similarity: float, depth: int, least: float) -> float:
    """The probability that a pair shares a node ``depth`` levels down in one tree."""
    two, p = min(1.0, 1 / least - 1) * (1 - 1 / COORDINATES), 1.0
    for _ in range(depth):
        p = (1 - two) * similarity * p + two * (1 - (1 - similarity * p) ** 2)
    return p


def trees_for(recall: float, least: float, depth: int = 3) -> int:
    """How many trees find a pair of the least similarity with probability ``recall`` if leaves lie ``depth`` levels down."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival(least, depth, least))))


def likely(least: float) -> int:
    """Least number of equal tokens of a pair to be compared in full: 4.5 standard deviations under the expectation."""
    return math.floor(COORDINATES * (least - 4.5 * math.sqrt(least * (1 - least) / COORDINATES)))


def _describe(words: int, trees: int, least: float) -> Callable:
    """Arrow mapper (doc_id, text, text_hash) -> the set's size, 128-bit name, tokens and root children."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = roots(trees)
        one, two = picked(top, least)
        nodes = np.r_[top, top[two >= 0]]
        coordinate = np.r_[one, two[two >= 0]]
        for batch in batches:
            size, name, tokens, keys = [], [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), words)
                size.append(len(found))
                if not len(found):
                    for c in (name, tokens, keys):
                        c.append(None)
                    continue
                least_of = minwise(found)
                name.append(xxhash.xxh3_128_digest(found.tobytes()))
                tokens.append(tokens_of(least_of).tobytes())
                keys.append(child(nodes, coordinate, least_of[coordinate]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(name, pa.binary()),
                    pa.array(tokens, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set_name", "tokens", "keys"],
            )

    return run


class _Labels:
    """Which of a few items are joined."""

    def __init__(self, given: np.ndarray):
        self.of = np.unique(given, return_inverse=True)[1].reshape(-1)

    def join(self, i: int, j: int) -> None:
        self.of[self.of == self.of[j]] = self.of[i]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)


def _pairs(first: list, second: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["a", "b"])


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each value of a column by which they are sorted."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
        for a, b in zip(cuts, [*cuts[1:], len(values)], strict=True):
            if held and values[a] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = values[a]
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield pa.Table.from_batches(held)


def _near(enough: int) -> Callable:
    """Arrow mapper over rows sorted by node: a forest of the pairs with ``enough`` equal tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for rows in _groups(batches, "node"):
            rep = rows.column("rep").to_numpy()
            tokens = _matrix(rows.column("tokens"), COORDINATES)
            labels = _Labels(rows.column("label").to_numpy())
            for i in range(len(rep) - 1):
                other = i + 1 + np.flatnonzero(labels.of[i + 1 :] != labels.of[i])
                for j in other[(tokens[other] == tokens[i]).sum(axis=1) >= enough]:
                    if labels.of[i] != labels.of[j]:
                        labels.join(i, j)
                        left.append(rep[i])
                        right.append(rep[j])
            if len(left) > _MANY:
                yield _pairs(left, right)
                left, right = [], []
        yield _pairs(left, right)

    return run


def _branch(enough: int, least: float) -> Callable:
    """Arrow mapper (node, rep, label, tokens, pivot, pivot_label, pivot_tokens): joins to the pivot, and children."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda n: batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            node, rep, pivot = get("node").view(np.uint64), get("rep"), get("pivot")
            tokens = _matrix(batch.column(batch.schema.get_field_index("tokens")), COORDINATES)
            other = _matrix(batch.column(batch.schema.get_field_index("pivot_tokens")), COORDINATES)
            near = (tokens == other).sum(axis=1) >= enough
            label = np.where(near, get("pivot_label"), get("label"))
            one, two = picked(node, least)
            rows = np.arange(len(rep))
            more = np.flatnonzero(two >= 0)
            at, coordinate = np.r_[rows, more], np.r_[one, two[more]]
            key = child(node[at], coordinate, tokens[at, coordinate].astype(np.uint64)).view(np.int64)
            joined = near & (rep != pivot)
            kind = np.r_[np.zeros(joined.sum(), np.int32), np.ones(len(at), np.int32)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kind),
                    pa.array(np.r_[pivot[joined], key]),
                    pa.array(np.r_[rep[joined], rep[at]]),
                    pa.array(np.r_[rep[joined], label[at]]),
                ],
                names=["kind", "node", "rep", "label"],
            )

    return run


def _blocks(rows: DataFrame, size: str, block: int, keys: list[str]) -> DataFrame:
    """Rows of large groups, once for every pair of blocks that they are part of, as rows of a unit ``node``."""
    count = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = rows.withColumn("blk", F.pmod(F.xxhash64("rep"), count).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    unit = F.xxhash64(*keys, F.least("blk", "other"), F.greatest("blk", "other"))
    return other.withColumn("node", unit).drop("blk", "other")


def candidate_links(reps: DataFrame, least: float, limit: int = 4096, max_depth: int = 8, block: int = 2048) -> DataFrame:
    """Links (a, b) that join all sets of ``reps`` (rep, tokens, keys) which the trees find near one another."""
    enough = likely(least)
    tokens = reps.select("rep", "tokens")
    rows = reps.select(F.explode("keys").alias("node"), "rep", F.col("rep").alias("label"))
    found: list[DataFrame] = []

    def compare(some: DataFrame) -> DataFrame:
        known = some.select("node", "rep", "label").join(tokens, "rep")
        return known.repartition("node").sortWithinPartitions("node", "rep").mapInArrow(_near(enough), "a long, b long")

    for depth in range(max_depth + 1):
        pivot = F.min_by(F.struct("rep", "label"), F.xxhash64("rep", "node"))
        nodes = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("size"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("content"),
            pivot.alias("pivot"),
        )
        nodes = staged(nodes.where("low != high"), "path-nodes")
        leaves = nodes.where(F.col("size") <= limit).dropDuplicates(["size", "content", "low", "high"])
        large = nodes.where(F.col("size") > limit)
        open_nodes = leaves.unionByName(large).select("node", "size", "pivot")
        kept = salted_lookup(rows.withColumn(ROW, F.col("rep")), open_nodes, ["node"]).drop(ROW)
        kept = staged(kept, "path-rows")
        found.append(compare(kept.where(F.col("size") <= limit)))
        big = kept.where(F.col("size") > limit)
        if big.isEmpty():
            break
        if depth == max_depth:
            found.append(compare(_blocks(big, "size", block, ["node"])))
            break
        pivots = large.select("node", F.col("pivot.rep").alias("rep")).join(tokens, "rep")
        pivots = pivots.select("node", F.col("tokens").alias("pivot_tokens"))
        flat = big.select(
            "node", "rep", "label", F.col("pivot.rep").alias("pivot"), F.col("pivot.label").alias("pivot_label")
        ).join(tokens, "rep")
        flat = salted_lookup(flat.withColumn(ROW, F.col("rep")), pivots, ["node"]).drop(ROW)
        flat = flat.mapInArrow(_branch(enough, least), "kind int, node long, rep long, label long")
        made = staged(flat, "path-branches")
        found.append(made.where("kind = 0").select(F.col("node").alias("a"), F.col("rep").alias("b")))
        rows = made.where("kind = 1").drop("kind")
    links = found[0]
    for more in found[1:]:
        links = links.unionAll(more)
    return links


def _linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * intersection >= num * union of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if den * len(a) < num * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return den * both >= num * (len(a) + len(b) - both)


def _confirm(num: int, den: int, enough: int) -> Callable:
    """Arrow mapper over rows (node, rep, label, tokens, elements) sorted by node: a forest of the exact links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "node"):
            left, right = [], []
            rep = rows.column("rep").to_numpy()
            tokens = _matrix(rows.column("tokens"), COORDINATES)
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("elements").to_pylist()]
            sizes = np.array(list(map(len, sets)))
            labels = _Labels(rows.column("label").to_numpy())
            for i in range(len(rep) - 1):
                other = i + 1 + np.flatnonzero(labels.of[i + 1 :] != labels.of[i])
                short, long = np.minimum(sizes[other], sizes[i]), np.maximum(sizes[other], sizes[i])
                other = other[den * short >= num * long]
                for j in other[(tokens[other] == tokens[i]).sum(axis=1) >= enough]:
                    if labels.of[i] != labels.of[j] and _linked(sets[i], sets[j], num, den):
                        labels.join(i, j)
                        left.append(rep[i])
                        right.append(rep[j])
            yield _pairs(left, right)

    return run


def _star(num: int, den: int) -> Callable:
    """Arrow mapper (rep, elements, pivot, pivot_elements): is each row linked with the pivot of its group?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: E731, B023
            same = [
                _linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), num, den)
                for a, b in zip(get("elements").to_pylist(), get("pivot_elements").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([get("rep"), get("pivot"), pa.array(same, pa.bool_())], names=["rep", "pivot", "linked"])

    return run


def _elements(words: int) -> Callable:
    """Arrow mapper (rep, root, size, text) -> the text's full set and its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py(), words) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array([tokens_of(minwise(m)).tobytes() for m in made], pa.binary()),
                    pa.array([m.tobytes() for m in made], pa.binary()),
                ],
                names=["rep", "root", "size", "tokens", "elements"],
            )

    return run


def confirmed_links(
    docs: DataFrame, members: DataFrame, words: int, num: int, den: int, block: int = 2048
) -> DataFrame:
    """Links (a, b) within candidate groups whose full sets have den * intersection >= num * union.

    ``docs``: doc_id, text, text_hash; ``members``: rep, root, size (of the group), doc_id and text_hash of one row with the set.
    """
    # Always by a sorted join: the members grow with the documents, and a switch of plan at some size would hide what it costs.
    texts = docs.alias("d").join(
        members.hint("shuffle_merge").alias("m"),
        F.col("d.text_hash").eqNullSafe(F.col("m.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")),
    )
    texts = texts.select("m.rep", "m.root", "m.size", "d.text").dropDuplicates(["rep"])
    fields = "rep long, root long, size long, tokens binary, elements binary"
    sets = staged(texts.mapInArrow(_elements(words), fields), "path-sets")
    enough = likely(num / den)
    own = F.col("rep").alias("label")

    def compare(rows: DataFrame) -> DataFrame:
        sorted_rows = rows.select("node", "rep", "label", "tokens", "elements").repartition("node")
        return sorted_rows.sortWithinPartitions("node", "rep").mapInArrow(_confirm(num, den, enough), "a long, b long")

    small = sets.where(F.col("size") <= block).select(F.col("root").alias("node"), "rep", own, "tokens", "elements")
    links = compare(small)
    large = sets.where(F.col("size") > block)
    if large.isEmpty():
        return links
    # In a large group one set is compared with all others first; those linked with it need no comparison with one another.
    pivots = large.groupBy("root").agg(F.min_by("rep", F.xxhash64("rep")).alias("rep"))
    pivots = pivots.join(large.select("rep", F.col("elements").alias("pivot_elements")), "rep")
    pivots = pivots.withColumnRenamed("rep", "pivot")
    met = salted_lookup(large.select("rep", "root", "elements", F.col("rep").alias(ROW)), pivots, ["root"]).drop(ROW)
    met = staged(met.mapInArrow(_star(num, den), "rep long, pivot long, linked boolean"), "path-stars")
    links = links.unionAll(met.where("linked and rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")))
    tagged = large.join(met, "rep").withColumn("label", F.when(F.col("linked"), F.col("pivot")).otherwise(F.col("rep")))
    counts = tagged.groupBy("root").agg(F.count_if("linked").alias("near"), F.count_if(~F.col("linked")).alias("rest"))
    tagged = salted_lookup(tagged.withColumn(ROW, F.col("rep")), counts.where("rest > 0"), ["root"]).drop(ROW)
    blocks = lambda n: F.ceil(F.col(n) / F.lit(block)).cast("int")
    # all of one type: a hash of 1 as int is not that of 1 as long
    rest_block = F.pmod(F.xxhash64("rep"), F.greatest(blocks("rest"), F.lit(1))).cast("int")
    near_block = F.pmod(F.xxhash64("rep"), F.greatest(blocks("near"), F.lit(1))).cast("int")
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), blocks(n) - 1)).otherwise(F.array().cast("array<int>"))
    rest, near = tagged.where("not linked"), tagged.where("linked")
    pair = F.xxhash64(F.lit(0), "root", F.least(rest_block, "o"), F.greatest(rest_block, "o"))
    among = rest.withColumn("o", F.explode(upto("rest"))).withColumn("node", pair)
    beside = rest.withColumn("o", F.explode(upto("near"))).withColumn("node", F.xxhash64(F.lit(1), "root", rest_block, "o"))
    facing = near.withColumn("o", F.explode(upto("rest"))).withColumn("node", F.xxhash64(F.lit(1), "root", "o", near_block))
    return links.unionAll(compare(among)).unionAll(compare(beside.unionByName(facing)))


def chosen_path_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: tuple[int, int] = (85, 100),
    recall: float = 0.9999,
    limit: int = 4096,
    max_depth: int = 8,
    block: int = 2048,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, a set holds the distinct shingles of ``words`` words;
    a text with fewer words is one shingle. Documents link when den * intersection >= num * union (``similarity``: num, den),
    confirmed on full sets. A null, empty or blank text has no shingles and links with nothing: its component is its own id.
    ``component_id`` is the smallest doc_id reachable over links; null ids never name a component (null if it has
    no other). ``kept``: the id is the component's (a null id is not kept). Repeated rows all return; an empty
    table gives an empty result; other columns are ignored. ``recall`` is the least probability with which the trees find a pair of the least
    similarity if leaves lie three levels down; nodes of up to ``limit`` sets are leaves.
    """
    num, den = similarity
    least = num / den
    text = text_of(text_col)
    source = docs.select(col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    fields = "doc_id long, text_hash long, n_shingles long, set_name binary, tokens binary, keys array<long>"
    rows = staged(numbered(source.mapInArrow(_describe(words, trees_for(recall, least), least), fields)), "path-rows")
    filled = rows.where("n_shingles > 0")
    shown = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    reps = filled.groupBy("set_name").agg(
        shown.alias("shown"), F.min("tokens").alias("tokens"), F.min("keys").alias("keys")
    )
    reps = staged(numbered(reps).withColumnRenamed(ROW, "rep"), "path-sets")
    groups = components(candidate_links(reps, least, limit, max_depth, block), "a", "b").select(F.col("node").alias("rep"), "root")
    groups = staged(groups, "path-groups")
    sized = salted_lookup(groups.withColumn(ROW, F.col("rep")), groups.groupBy("root").agg(F.count(F.lit(1)).alias("size")), ["root"])
    members = sized.drop(ROW).join(reps.select("rep", "shown.doc_id", "shown.text_hash"), "rep")
    links = confirmed_links(source, staged(members, "path-members"), words, num, den, block)
    joined = components(links, "a", "b").select(F.col("node").alias("rep"), "root")
    ids = reps.select("rep", "set_name", F.col("shown.doc_id").alias("least_id")).join(joined, "rep", "left")
    ids = ids.withColumn("root", F.coalesce("root", "rep"))
    named = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = salted_lookup(ids.select("set_name", "root", F.col("rep").alias(ROW)), named, ["root"]).select("set_name", "component_id")
    found = salted_lookup(filled.select("doc_id", "n_shingles", "set_name", ROW), named, ["set_name"])
    found = found.select("doc_id", "n_shingles", "component_id")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionAll(empty).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
