"""Token-id shards with a minimal perfect hash index.

Documents are dealt into shards by ranges of their id and written in ascending id order as raw
little-endian ids. Each document's key (id, and which of its repetitions) is mapped by a minimal
perfect hash to a slot with a stored fingerprint and the document's shard, offset and length, so
one document is found in constant time and read with one range request.

Shard file: 8 bytes magic, 8 bytes id width in bytes (2 or 4), then the ids. Index file: a numpy
archive. Files carry a unique name per task attempt; a written table names those that count, so a
task that is run again or twice leaves no trace in the result. Paths go through ``pyarrow.fs`` (local or
shared mounts, HDFS, object stores).
"""

from __future__ import annotations

import ctypes
import io
import itertools
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tideline.session import scratch_path

from .common import col, staged, text_of

MAGIC = b"IDSHARD1"
HEAD = 16
MOST_FILES = 20_000
ENTRY = "doc_id long, occ long, key long, mark long, shard int, file string, at long, n_tokens long"

# --- encoding -------------------------------------------------------------------------------

SPACES = b" \t\n\r\x0b\x0c"
_SPACE = np.isin(np.arange(256), list(SPACES))
_PLAIN = re.compile(rb" [^" + re.escape(SPACES) + rb"]+")
_OTHER_SPACE = re.compile(rf"[^\S{re.escape(SPACES.decode())}]")
_GROUP = 8 << 20  # bytes of texts that are cut at a time,
_GROUP_COUNTS = 2 << 20  # where only numbers of ids are wanted
_CHUNK = 1 << 20  # segments whose ids are put together at a time
_JOINED = 64
_KEPT = 300_000  # segments of a generation,
_KEPT_COUNTS = 100_000  # where only their numbers of ids are kept,
_HELD = 16 << 20  # and their bytes
_LOADED: dict = {}  # (path, special_as_text, kind) -> Encoder
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


class _Memory(dict):
    """Ids of segments seen of late; with the generation before it, so that what is used again stays and rare segments go."""

    def __init__(self, old: dict[bytes, bytes | None]):
        self.old = old
        self.new: list[bytes] = []
        self.held = 0  # bytes of the segments

    def __missing__(self, segment: bytes) -> bytes | None:
        self.held += len(segment)
        if segment in self.old:
            found = self[segment] = self.old[segment]
            return found
        self.new.append(segment)
        return None

    def rest(self, most: int) -> _Memory:
        """This generation, or the next one if it is full; nothing is copied, the one before it goes."""
        if len(self) <= most and self.held <= _HELD:
            return self
        self.old = {}
        return _Memory(self)


class Encoder:
    """Whole-text ids by the tokenizers library, with a memory of segments.

    Byte-level BPE splits before every run of white space that follows another sign, so a text's
    ids are those of its segments (white space and the signs up to the next) in a row. The texts of an Arrow batch are cut into
    segments by their bytes, the distinct segments are looked up or encoded together, and the ids are gathered
    from them, without a step for each document. A text with white space outside ASCII is encoded in one piece.
    """

    kept, group = _KEPT, _GROUP

    def __init__(self, path: str, special_as_text: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.opens = np.zeros(max(vocab.values()) + 1, bool)  # ids that begin with a space
        for piece, i in vocab.items():
            self.opens[i] = piece.startswith("Ġ")
        self.known = _Memory({})  # a segment's ids; None where it has white space outside ASCII

    def _direct(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.kind)

    def _cut(self, segments: list[bytes], coded: list) -> bool:
        """Keep the ids of segments encoded in joined texts, if as many ids begin with a space as there are segments."""
        ids = np.fromiter(itertools.chain.from_iterable(c.ids for c in coded), self.kind)
        first = np.flatnonzero(self.opens[ids])
        if len(first) != len(segments):
            return False
        raw, ends = ids.tobytes(), (np.append(first, len(ids)) * self.width).tolist()
        self.known.update(zip(segments, map(raw.__getitem__, map(slice, ends[:-1], ends[1:])), strict=True))
        return True

    def _alone(self, segment: bytes) -> bytes:
        return self._direct(segment).tobytes()

    def _learn(self) -> None:
        """Ids of all new segments; those of one space and other signs are encoded in joined texts."""
        new, self.known.new = self.known.new, []
        plain = [s for s in new if _PLAIN.fullmatch(s)]
        joined = [plain[at : at + _JOINED] for at in range(0, len(plain), _JOINED)]
        coded = self.tokenizer.encode_batch_fast([b"".join(some).decode() for some in joined], add_special_tokens=False)
        if not self._cut(plain, coded):
            for some, one in zip(joined, coded, strict=True):
                self._cut(some, [one])
        for s in new:
            if not s.isascii() and _OTHER_SPACE.search(s.decode()):
                self.known[s] = None
            elif s not in self.known:
                self.known[s] = self._alone(s)

    def _pool(self, segments: list[bytes]) -> list[bytes | None]:
        got = list(map(self.known.__getitem__, segments))
        if self.known.new:
            self._learn()
            for i in [i for i, ids in enumerate(got) if ids is None]:
                got[i] = self.known[segments[i]]
        self.known = self.known.rest(self.kept)
        return got

    def _ids(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of segments in a row, how many each has, and which have white space outside ASCII."""
        distinct = segments.dictionary_encode()
        at = distinct.indices.to_numpy()
        pool = self._pool(distinct.dictionary.to_pylist())
        other = np.fromiter((p is None for p in pool), bool, len(pool))
        pool = [p or b"" for p in pool]
        sizes = np.fromiter(map(len, pool), np.int32, len(pool)) // self.width
        begin, ids = np.cumsum(sizes, dtype=np.int32) - sizes, np.frombuffer(b"".join(pool), self.kind)
        counts = sizes[at]
        ends = np.cumsum(counts, dtype=np.int32)
        take = np.repeat(begin[at] - (ends - counts), counts)
        take += np.arange(len(take), dtype=np.int32)
        return ids[take], counts, other[at]

    @staticmethod
    def _segments(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The segments of the texts that lie in ``data`` at ``offsets``, and the place of each text's first one."""
        space = _SPACE[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = space[1:] & ~space[:-1]
        begins[offsets] = True
        starts = np.flatnonzero(begins[: len(data)])
        bounds = np.append(starts, len(data)).astype(np.int32)
        first = np.searchsorted(starts, offsets)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.binary(), len(starts), buffers), first

    def _group(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts that lie in ``data`` at ``offsets``, each with the end id, and their numbers of ids."""
        n = len(offsets) - 1
        segments, first = self._segments(data, offsets)
        done = [self._ids(segments.slice(at, _CHUNK)) for at in range(0, len(segments), _CHUNK)]
        ids, counts, other = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, self.kind), np.zeros(0, np.int32), np.zeros(0, bool))
        ends = np.r_[0, np.cumsum(counts, dtype=np.int64)][first]
        strange = np.diff(np.r_[0, np.cumsum(other)][first]) > 0
        if not strange.any():
            return np.insert(ids, ends[1:], end_id), np.diff(ends) + 1
        texts = [
            self._direct(data[offsets[i] : offsets[i + 1]].tobytes()) if strange[i] else ids[ends[i] : ends[i + 1]] for i in range(n)
        ]
        sizes = np.fromiter(map(len, texts), np.int64, n)
        return np.insert(np.concatenate(texts), np.cumsum(sizes), end_id), sizes + 1

    def _groups(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Groups of texts: their bytes and where each begins."""
        texts = texts.cast(pa.string())
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + self.group, "right")) - 1)
            yield data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            a = b

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[pa.Array]:
        """The ids of each text with the end id, as binary values of ``width`` bytes an id, in arrays of groups of texts."""
        for data, offsets in self._groups(texts):
            ids, sizes = self._group(data, offsets, end_id)
            ends = (np.r_[0, np.cumsum(sizes)] * self.width).astype(np.int32)
            yield pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids, self.kind))])


class IdCounter(Encoder):
    """How many ids the whole texts have: as :class:`Encoder`, but of a segment only the number of its ids is kept."""

    kept, group = _KEPT_COUNTS, _GROUP_COUNTS

    def _cut(self, segments: list[bytes], coded: list) -> bool:
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.fromiter(itertools.chain.from_iterable(c.ids for c in coded), self.kind, int(sizes.sum()))
        first = np.flatnonzero(self.opens[ids])
        if len(first) != len(segments):
            return False
        self.known.update(zip(segments, np.diff(np.append(first, len(ids))).tolist(), strict=True))
        return True

    def _alone(self, segment: bytes) -> int:
        return len(self._direct(segment))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text, without an end id."""
        out = [np.zeros(0, np.int64)]
        for data, offsets in self._groups(texts):
            segments, first = self._segments(data, offsets)
            done = [self._sizes(segments.slice(at, _CHUNK)) for at in range(0, len(segments), _CHUNK)]
            sizes = np.concatenate(done) if done else np.zeros(0, np.int32)
            strange = np.flatnonzero(np.diff(np.r_[0, np.cumsum(sizes < 0)][first]))
            sums = np.diff(np.r_[0, np.cumsum(sizes, dtype=np.int64)][first])
            for i in strange.tolist():
                sums[i] = self._alone(data[offsets[i] : offsets[i + 1]].tobytes())
            out.append(sums)
        return np.concatenate(out)

    def _sizes(self, segments: pa.Array) -> np.ndarray:
        """How many ids each segment has; -1 where it has white space outside ASCII."""
        distinct = segments.dictionary_encode()
        pool = self._pool(distinct.dictionary.to_pylist())
        return np.fromiter((-1 if n is None else n for n in pool), np.int32, len(pool))[distinct.indices.to_numpy()]


def give_back() -> None:
    """Return freed memory to the system: a Python worker stays for other stages, and what it keeps is the executor's."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def encoder(path: str, special_as_text: bool = False, kind: type[Encoder] = Encoder) -> Encoder:
    """One encoder of a kind per Python worker; its memory of segments serves all tasks of the worker."""
    key = (path, special_as_text, kind.__name__)
    if key not in _LOADED:
        _LOADED[key] = kind(path, special_as_text)
    return _LOADED[key]


# --- minimal perfect hash --------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def key_of(ids: np.ndarray, missing: np.ndarray, occ: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key and an independent 32-bit fingerprint of (id or null, repetition)."""
    with np.errstate(over="ignore"):
        seed = _mix(occ.astype(np.uint64) * np.uint64(2) + missing.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        raw = np.where(missing, np.uint64(0), ids.astype(np.int64).view(np.uint64))
        key = _mix(raw ^ seed)
        mark = _mix(raw + seed * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)
    return key.view(np.int64), mark.astype(np.int64)


class PerfectHash:
    """Levels of bit arrays: a key sits at the first level where no other key shares its place."""

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.rank = np.concatenate([[0], np.cumsum(np.unpackbits(bits, bitorder="little"))]).astype(np.uint32)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = _mix(keys.view(np.uint64) + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15))
        return (h % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, load: float = 1.5, levels: int = 40) -> PerfectHash:
        sizes, bits, left = [], [], keys
        while len(left) and len(sizes) < levels:
            size = -(-max(8, int(len(left) * load)) // 8) * 8
            at = cls._place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            sizes.append(size)
            left = left[~alone[at]]
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        return cls(sizes, np.packbits(flat, bitorder="little"), np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, 0 to n - 1; for a key that was not built in, any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._place(keys[left], level, size)
            hit = (self.bits[at >> 3] >> (at & 7) & 1).astype(bool)
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        if len(left) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            hit = self.rest[at] == keys[left]
            out[left[hit]] = self.rank[-1] + at[hit]
        return out


# --- files -----------------------------------------------------------------------------------


def _at(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Spark-style URI (``s3a`` and ``s3n`` are ``s3`` to Arrow)."""
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3://" + uri.split("://", 1)[1]
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class _ShardWriter:
    def __init__(self, folder: str, shard: int, width: int):
        self.shard, self.at, self.width = shard, 0, width
        self.name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"
        system, path = _at(self.name)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(path)
        self.out.write(MAGIC + width.to_bytes(8, "little"))


def _encode(tokenizer: str, special_as_text: bool, end_id: int):
    """Arrow mapper (doc_id, text) -> doc_id and all ids of the text with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, special_as_text)
        for batch in batches:
            at = 0
            for ids in enc.encode(batch.column(1), end_id):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), ids], names=["doc_id", "ids"])
                at += len(ids)
            ids = None
            give_back()

    return run


def token_counts(docs: DataFrame, tokenizer: str, text_col: str, name: str, special_as_text: bool = False, end_id: int = 2) -> DataFrame:
    """``docs`` without its text but with ``name``: the number of ids of the whole text with the end id, as :func:`write_ids` writes them."""
    kept = [c for c in docs.columns if c != text_col]
    rows = docs.select(*map(col, kept), text_of(text_col).alias(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(tokenizer, special_as_text, IdCounter)
        for batch in batches:
            counts = pa.array(counter.counts(batch.column(len(kept))) + 1)
            give_back()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], counts], names=[*kept, name])

    schema = StructType([*(rows.schema[c] for c in kept), StructField(name, LongType())])
    return rows.mapInArrow(run, schema)


def _write_shards(folder: str, width: int):
    """Arrow mapper (shard, doc_id, ids) in order -> an entry for each document; the ids of a shard go to its file as they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, occ = None, None, 0
        for batch in batches:
            shards = batch.column(0).to_numpy()
            given = batch.column(1)
            missing = given.is_null().to_numpy(zero_copy_only=False)
            ids = given.fill_null(0).to_numpy()
            raw = batch.column(2)
            offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
            data = raw.buffers()[2]
            counts = np.diff(offsets) // width
            at = np.zeros(len(raw), np.int64)
            files: list[str] = []
            cuts = np.flatnonzero(np.r_[True, shards[1:] != shards[:-1]]) if len(shards) else []
            for a, b in zip(cuts, [*cuts[1:], len(shards)], strict=True):
                if out is None or out.shard != shards[a]:
                    if out is not None:
                        out.out.close()
                    out = _ShardWriter(folder, int(shards[a]), width)
                out.out.write(data.slice(int(offsets[a]), int(offsets[b] - offsets[a])))
                at[a:b] = out.at + np.r_[0, np.cumsum(counts[a:b])[:-1]]
                out.at += int(counts[a:b].sum())
                files += [out.name] * int(b - a)
            if not len(shards):
                continue
            # the how-manieth row of its id in its shard each row is; the last row's count goes on in the next batch
            same = np.r_[last == (shards[0], missing[0], ids[0]), (shards[1:] == shards[:-1]) & (missing[1:] == missing[:-1]) & (ids[1:] == ids[:-1])]
            place = np.arange(len(ids))
            begin = np.maximum.accumulate(np.where(same, 0, place))
            times = place - begin + np.where(np.cumsum(~same) == 0, occ + 1, 0)
            last, occ = (shards[-1], missing[-1], ids[-1]), int(times[-1])
            key, mark = key_of(ids, missing, times)
            yield pa.RecordBatch.from_arrays(
                [
                    given, pa.array(times), pa.array(key), pa.array(mark), batch.column(0), pa.array(files, pa.string()),
                    pa.array(at), pa.array(counts),
                ],
                names=["doc_id", "occ", "key", "mark", "shard", "file", "at", "n_tokens"],
            )
        if out is not None:
            out.out.close()

    return run


def _write_index(folder: str):
    """Arrow mapper over rows sorted by ``part``: an index file for each part."""

    def save(part: int, rows: pa.Table) -> pa.RecordBatch:
        get = {n: rows.column(n).to_numpy() for n in ("key", "mark", "shard", "at", "n_tokens")}
        hashed = PerfectHash.build(get["key"])
        slot = hashed.slots(get["key"])
        put = lambda n, kind: _scatter(slot, get[n].astype(kind))
        buffer = io.BytesIO()
        np.savez(
            buffer, sizes=np.array(hashed.sizes, np.int64), bits=hashed.bits, rest=hashed.rest,
            mark=put("mark", "<u4"), shard=put("shard", "<u4"), at=put("at", "<u8"), n_tokens=put("n_tokens", "<u8"),
        )
        name = f"{folder}/index-{part:06d}-{uuid.uuid4().hex}.npz"
        system, path = _at(name)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(path) as out:
            out.write(buffer.getvalue())
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([name]), pa.array([len(slot)], pa.int64())], names=["part", "file", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _runs(batches, "part"):
            yield save(part, rows)

    return run


def _scatter(slot: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[slot] = values
    return out


def _runs(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each value of a column by which they are sorted."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else []
        for a, b in zip(cuts, [*cuts[1:], len(values)], strict=True):
            if held and values[a] != now:
                yield int(now), pa.Table.from_batches(held)
                held = []
            now = values[a]
            held.append(batch.slice(int(a), int(b - a)))
    if held:
        yield int(now), pa.Table.from_batches(held)


class IndexPart:
    """An index file in memory."""

    def __init__(self, uri: str):
        system, path = _at(uri)
        with system.open_input_file(path) as f:
            got = np.load(io.BytesIO(f.read()))
            self.columns = {n: got[n] for n in ("mark", "shard", "at", "n_tokens")}
            self.hash = PerfectHash(got["sizes"].tolist(), got["bits"], got["rest"])

    def find(self, keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, ...]:
        """found, shard, at, n_tokens for each key; a fingerprint that differs means absent."""
        slot = self.hash.slots(keys)
        n = len(self.columns["mark"])
        safe = np.where((slot >= 0) & (slot < n), slot, 0)
        if not n:
            z = np.zeros(len(keys), np.int64)
            return z.astype(bool), z, z, z
        found = (slot >= 0) & (self.columns["mark"][safe] == marks.astype(np.uint64))
        return found, *(self.columns[c][safe].astype(np.int64) for c in ("shard", "at", "n_tokens"))


class ShardReader:
    """Range reads from a shard file."""

    def __init__(self, uri: str):
        system, path = _at(uri)
        self.file = system.open_input_file(path)
        head = self.file.read_at(HEAD, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"not a shard of ids: {uri}")
        self.width = int.from_bytes(head[8:], "little")

    def ids(self, at: int, n: int) -> np.ndarray:
        raw = self.file.read_at(n * self.width, HEAD + at * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


@dataclass(frozen=True)
class IdStore:
    """What was written: shard and index files by number, and the ids before each shard.

    One entry per shard and index part; ``docs_per_shard`` and ``keys_per_part`` set how many.
    """

    shards: dict[int, tuple[str, int]]
    parts: dict[int, str]

    def get(self, doc_id: int | None, occ: int = 0) -> np.ndarray | None:
        """The ids of one document in constant time; None if it is not in the store."""
        key, mark = key_of(np.array([doc_id or 0], np.int64), np.array([doc_id is None]), np.array([occ], np.int64))
        if not self.parts:
            return None
        index = IndexPart(self.parts[int(key.view(np.uint64)[0] % np.uint64(len(self.parts)))])
        found, shard, at, n = index.find(key, mark)
        return ShardReader(self.shards[int(shard[0])][0]).ids(int(at[0]), int(n[0])) if found[0] else None


def write_ids(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    special_as_text: bool = False,
    docs_per_shard: int = 8192,
    keys_per_part: int = 65_536,
    folder: str | None = None,
) -> IdStore:
    """Encode every whole text and write shards and index; ``tokenizer`` is a vocabulary file.

    Null and empty texts have only the end id. Ids ascend over the shards, null ids come last;
    rows that repeat an id are written each and get repetition numbers 0, 1, ... Names of special tokens
    in a text are taken as such unless ``special_as_text``. Other columns are ignored. Texts are encoded where they are read;
    only ids are dealt to shards. There are at most ``MOST_FILES`` shards and index parts, so shards of
    large tables hold more than ``docs_per_shard`` documents; the names of the files are what the driver keeps.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "llm-ids")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    count = rows.select("doc_id").count()
    docs_per_shard = max(docs_per_shard, -(-count // MOST_FILES))
    keys_per_part = max(keys_per_part, -(-count // MOST_FILES))
    shards = max(1, -(-count // docs_per_shard))
    ids = rows.select(F.col("doc_id").cast("double").alias("d"))
    edges = ids.approxQuantile("d", [i / shards for i in range(1, shards)], 0.1 / shards) if shards > 1 else []
    edges = sorted(set(edges))
    coded = rows.mapInArrow(_encode(tokenizer, special_as_text, end_id), "doc_id long, ids binary")
    dealt = coded.withColumn("d", F.col("doc_id").cast("double"))
    if edges:
        cut = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol="d", outputCol="s", handleInvalid="keep")
        dealt = cut.transform(dealt)
    else:
        dealt = dealt.withColumn("s", F.lit(0.0))
    entries = staged(
        dealt.select(F.coalesce("s", F.lit(len(edges) + 1.0)).cast("int").alias("shard"), "doc_id", "ids")
        .repartitionById(len(edges) + 2, F.col("shard"))
        .sortWithinPartitions("shard", F.asc_nulls_last("doc_id"))
        .mapInArrow(_write_shards(folder, encoder(tokenizer, special_as_text).width), ENTRY),
        "id-entries",
    )
    files: dict[int, tuple[str, int]] = {}
    base = 0
    sums = entries.groupBy("shard").agg(F.max("file").alias("file"), F.sum("n_tokens").alias("n")).orderBy("shard")
    for r in sums.collect():  # a row per shard
        files[r["shard"]] = (r["file"], base)
        base += r["n"]
    parts = max(1, -(-count // keys_per_part))
    index = (
        entries.withColumn("part", _part("key", parts))
        .select("part", "key", "mark", "shard", "at", "n_tokens")
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part")
        .mapInArrow(_write_index(folder), "part int, file string, n long")
    )
    named = {r["part"]: r["file"] for r in staged(index, "id-index").collect()}  # a row per part
    return IdStore(files, named)


def _part(name: str, parts: int):
    """key modulo parts, the key read as unsigned."""
    k = F.col(name).cast("decimal(20,0)")
    return F.pmod(F.when(k < 0, k + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(k), F.lit(parts)).cast("int")


def read_ids(keys: DataFrame, store: IdStore, id_col: str = "doc_id") -> DataFrame:
    """Read documents back by key: doc_id, start, n_tokens, ids_crc32 for each row of ``keys``.

    The index gives shard, offset and length; the ids come from the shard file. A repeated key
    reads its repetitions in turn; a key that is not in the store gives no row.
    """
    counted = keys.groupBy(col(id_col).cast("long").alias("doc_id")).count()
    wanted = counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("occ"))
    n_parts = len(store.parts)

    def add_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, occ = b.column(0), b.column(1).to_numpy()
            key, mark = key_of(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), occ)
            part = (key.view(np.uint64) % np.uint64(n_parts)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(key), pa.array(mark), pa.array(part)], names=["doc_id", "key", "mark", "part"]
            )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, now = None, None
        for b in batches:
            parts = b.column(3).to_numpy()
            for part in np.unique(parts):
                if part != now:
                    index, now = IndexPart(store.parts[int(part)]), part
                some = b.filter(pa.array(parts == part))
                found, shard, at, n = index.find(some.column(1).to_numpy(), some.column(2).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(shard.astype(np.int32)), pa.array(at), pa.array(n)],
                    names=["doc_id", "shard", "at", "n_tokens"],
                ).filter(pa.array(found))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now = None, None
        for b in batches:
            start, crc = [], []
            for shard, at, n in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if shard != now:
                    reader, now = ShardReader(store.shards[shard][0]), shard
                start.append(store.shards[shard][1] + at)
                crc.append(zlib.crc32(reader.ids(at, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(start, pa.int64()), b.column(3), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    if not n_parts:
        return keys.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return (
        wanted.mapInArrow(add_key, "doc_id long, key long, mark long, part int")
        .repartitionById(n_parts, F.col("part"))
        .sortWithinPartitions("part")
        .mapInArrow(find, "doc_id long, shard int, at long, n_tokens long")
        .repartitionById(max(store.shards, default=0) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "at")
        .mapInArrow(fetch, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )
