"""Fill-in-the-middle rewriting with compressed sets of token boundaries.

A text's tokens are its runs of ASCII letters and its other signs one by one. The offsets (in code
points) at which a token ends, and offset 0, form its boundary set. Cutting after k tokens is
``select(k)`` on that set, so both cut offsets come from the set alone.

The set is kept as roaring bitmaps keep theirs: offsets are grouped by their high 16 bits, and each group's
low 16 bits are held in the smallest of three containers: a sorted array, a bitmap with ranks for each
word, or runs of consecutive offsets. The cardinalities of the containers are kept as running sums;
``select`` finds the container by binary search and then the offset inside it. Containers are built one after
another from slices of the text, so the working memory does not grow with the length of the text.

Python sees each text once and returns three numbers; the rewritten text is put together by the JVM.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import col, text_of

SPAN = 1 << 16  # offsets of a container


class _Array:
    """Sorted low halves."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class _Bitmap:
    """A bit for each low half, with the number of bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.flatnonzero(np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little"))
        return word * 64 + int(bits[k - self.before[word]])


class _Runs:
    """First low half of each run of consecutive ones, with the number of offsets before each run."""

    def __init__(self, first: np.ndarray, lengths: np.ndarray):
        self.first = first.astype(np.uint16)
        self.before = np.r_[0, np.cumsum(lengths)]

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def _container(low: np.ndarray) -> _Array | _Bitmap | _Runs:
    """The container that takes the fewest bytes (2 an offset, 8 KiB, or 4 a run)."""
    starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1] + 1])
    if 4 * len(starts) < min(2 * len(low), SPAN // 8):
        return _Runs(low[starts], np.diff(np.r_[starts, len(low)]))
    return _Array(low) if 2 * len(low) <= SPAN // 8 else _Bitmap(low)


def _letters(text: str) -> np.ndarray:
    """Which code points are ASCII letters."""
    points = np.frombuffer(text.encode("latin-1" if text.isascii() else "utf-32-le", "surrogatepass"), "u1" if text.isascii() else "<u4")
    lower = points | 0x20
    return (lower >= 97) & (lower <= 122)


class BoundarySet:
    """The token boundaries of one text: ``len`` of it, and ``select`` of the k-th smallest offset."""

    def __init__(self, text: str):
        self.high: list[int] = []
        self.containers: list[_Array | _Bitmap | _Runs] = []
        sizes = []
        for lo in range(0, len(text) + 1, SPAN):
            hi = min(lo + SPAN, len(text) + 1)  # offsets lo to hi - 1
            around = _letters(text[max(0, lo - 1) : hi])  # the signs before and after each of them
            before = around if lo else np.r_[False, around]
            after = np.r_[around[1 if lo else 0 :], np.zeros(int(hi > len(text)), bool)]
            low = np.flatnonzero(~(before[: hi - lo] & after[: hi - lo]))
            if len(low):
                self.high.append(lo)
                self.containers.append(_container(low))
                sizes.append(len(low))
        self.before = np.r_[0, np.cumsum(sizes, dtype=np.int64)]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return self.high[at] + self.containers[at].select(k - int(self.before[at]))


def _cuts(text: Column, one: Column, two: Column) -> Column:
    """Tokens of each text and the offsets after ``one`` and ``two`` (modulo tokens + 1) of them, the lesser first."""

    @pandas_udf("n long, first long, second long")
    def of(texts: pd.Series, ones: pd.Series, twos: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(texts), 3), np.int64)
        for i, (t, a, b) in enumerate(zip(texts, ones.to_numpy(), twos.to_numpy(), strict=True)):
            found = BoundarySet(t or "")
            n = len(found)
            out[i] = n - 1, *sorted((found.select(int(a % n)), found.select(int(b % n))))
        return pd.DataFrame(out, columns=["n", "first", "second"])

    return of(text, one, two)


MARKS = ("<P>", "<S>", "<M>")


def _checked(marks: tuple[str, str, str]) -> None:
    """No mark may begin inside another one or itself: a rewritten text can then be read in one way only."""
    for i, a in enumerate(marks):
        for j, b in enumerate(marks):
            inside = range(int(i == j), len(a))
            if not a or any(a.startswith(b[: len(a) - k], k) for k in inside):
                raise ValueError(f"marks {marks} overlap")


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    marks: tuple[str, str, str] = MARKS,
    percent: int = 90,
    spm_percent: int = 20,
    seed: str = "1",
) -> DataFrame:
    """One row per document: doc_id, n (tokens), form, cut_a, cut_b (code points, null if plain), output.

    Four unsigned numbers are the first 8-digit groups of the SHA-256 of ``seed``, a colon and the decimal id (a
    null id: nothing). The prefix ends after the lesser, the middle after the greater of the first two modulo n + 1 tokens.
    A text is plain if it is empty or null, has a mark in it, or the third number modulo 100 is ``percent`` or
    more; otherwise spm (suffix, prefix, middle) if the fourth modulo 100 is under ``spm_percent``, else psm.
    The ``marks`` stand before prefix, suffix and middle; no mark may overlap with another. Whole texts are used, of any
    length. Repeated rows all return, alike; an empty table gives an empty result; other columns are ignored.
    """
    _checked(marks)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(col(id_col).cast("string"), F.lit(""))), 256)
    group = lambda i: F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long")
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"), digest.alias("digest"))
    rows = rows.withColumn("cuts", _cuts(F.col("text"), group(0), group(1)))
    marked = [F.contains("text", F.lit(m)) for m in marks]
    plain = (F.col("text") == "") | marked[0] | marked[1] | marked[2] | (group(2) % 100 >= percent)
    rows = rows.select(
        "doc_id",
        "text",
        F.col("cuts.n").alias("n"),
        F.when(plain, "plain").when(group(3) % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.col("cuts.first").alias("a"),
        F.col("cuts.second").alias("b"),
    )
    part = lambda start, size: F.substring(F.col("text"), (start + 1).cast("int"), size.cast("int"))
    a, b = F.col("a"), F.col("b")
    prefix, middle, suffix = part(F.lit(0), a), part(a, b - a), part(b, F.length("text"))
    p, s, m = map(F.lit, marks)
    is_plain = F.col("form") == "plain"
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.when(~is_plain, a).alias("cut_a"),
        F.when(~is_plain, b).alias("cut_b"),
        F.when(is_plain, F.col("text"))
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
        .alias("output"),
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from a rewritten one and its form, by the places of the marks alone."""
    p, s, m = marks

    def pieces(one: str, two: str) -> tuple[Column, Column, Column]:
        at_two, at_m = F.instr(output, two), F.instr(output, m)
        cut = lambda start, end: F.substring(output, start, F.greatest(end - start, F.lit(0)))
        return (
            cut(F.lit(len(one) + 1), at_two),
            cut(at_two + len(two), at_m),
            cut(at_m + len(m), F.length(output) + 1),
        )

    prefix, suffix, middle = pieces(p, s)
    back = F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix))
    suffix, prefix, middle = pieces(s, p)
    return back.otherwise(F.concat(prefix, middle, suffix))
