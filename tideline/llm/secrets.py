"""Secret scans: known formats, and random-looking tokens found by a battery of randomness tests.

Candidates are the maximal runs of encoding signs in a text. For each the narrowest encoding that it fits is inferred,
and three tests ask whether its signs look drawn at random from that alphabet: chi-squared uniformity, a runs test about the
alphabet's middle, and lag-1 serial correlation. Fisher's method joins the three p-values.

Ordinary tokens have small p-values, random ones uniform ones, and the share of ordinary tokens depends on
length and encoding. So in each stratum of encoding and length (powers of two) the p-values are taken as a mixture of uniform
ones (random tokens) and of ones that lean to zero (ordinary tokens, a beta distribution), and the least cut is taken at which the share of
ordinary tokens above it is at most ``fdr`` under every mixture that the stratum's histogram does not refute. Thin strata of one encoding
are taken together with their neighbours in length; where the tokens are too few to refute that they are all ordinary, nothing is
reported. Only DataFrame functions are used.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, staged, text_of


@dataclass(frozen=True)
class Kind:
    """A known format: a pattern, and the least code points of a match or of one of its groups."""

    name: str
    pattern: str
    group: int
    least: int


# The known formats, in the order in which kinds are listed.
BASE = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24),
)
RANDOM = "random"
_RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from narrow to wide: name, pattern of the whole token, alphabet in its order.
ENCODINGS = (
    ("decimal", r"^[0-9]+$", _DIGITS),
    ("hex", r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("lower", r"^[a-z]+$", _LOWER),
    ("upper", r"^[A-Z]+$", _UPPER),
    ("base32", r"^[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", r"^[0-9a-z]+$", _DIGITS + _LOWER),
    ("BASE36", r"^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("base62", r"^[0-9A-Za-z]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", r"^[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", r"^[0-9A-Za-z_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", r"", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
BINS = 100
BLOCK = 256  # spans walked together


def _blocks(items: Column) -> Column:
    """The array as arrays of ``BLOCK`` items, so that a walk copies a block at a time and never all before it."""

    def cut(a: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * BLOCK + 1, BLOCK))

    return F.transform(F.array(items), cut)[0]


def spans_of(text: Column, kind: str, pattern: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (kind, start, stop, token), in code points.

    The pieces between the matches give the places: a match starts where all pieces up to it and all
    matches before it end. The walk goes by blocks, whose starts are summed first.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.arrays_zip(found.alias("a"), held.alias("b")),
        lambda gap, m: F.struct(F.coalesce(F.length(gap), F.lit(0)).alias("gap"), m["a"].alias("token"), F.length(m["b"]).alias("n")),
    )
    empty = F.array().cast("array<struct<kind:string,start:int,stop:int,token:string>>")

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        stop = start + F.length(p["token"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), p["token"].alias("token"))
        spans = F.when(p["n"] >= least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(F.coalesce(stop, start).alias("at"), spans.alias("spans"))

    def following(acc: Column, block: Column) -> Column:
        width = F.aggregate(block, F.lit(0), lambda n, p: n + p["gap"] + F.coalesce(F.length(p["token"]), F.lit(0)))
        return F.struct((acc["at"] + width).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts"))

    def walked(blocks: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(blocks, none, following, lambda acc: acc["starts"])
        return F.flatten(F.zip_with(
            blocks, starts,
            lambda b, at: F.aggregate(b, F.struct(at.alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"]),
        ))

    spans = F.transform(F.array(_blocks(pieces)), walked)[0]
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _free_of(tokens: Column, known: Column) -> Column:
    """The tokens that overlap no known span; blocks of known spans are passed over by their ends."""

    def ends(block: Column) -> Column:
        lo, hi = F.array_min(F.transform(block, lambda s: s["start"])), F.array_max(F.transform(block, lambda s: s["stop"]))
        return F.struct(lo.alias("lo"), hi.alias("hi"), block.alias("spans"))

    def free(blocks: Column) -> Column:
        meets = lambda t, start, stop: (start < t["stop"]) & (t["start"] < stop)
        return F.filter(tokens, lambda t: ~F.exists(
            blocks, lambda b: F.coalesce(meets(t, b["lo"], b["hi"]) & F.exists(b["spans"], lambda s: meets(t, s["start"], s["stop"])), F.lit(False))
        ))

    return F.transform(F.array(F.transform(_blocks(known), ends)), free)[0]


def _normal_sf2(z: Column) -> Column:
    """Two-sided normal p-value (Abramowitz and Stegun 26.2.17 has an error under 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.least(F.lit(1.0), 2 * F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly)


def battery(spans: Column) -> Column:
    """Adds to each span (kind, start, stop, token) its encoding (place in ENCODINGS), length n and p-value."""

    def encode(s: Column) -> Column:
        place = F.lit(len(ENCODINGS) - 1)
        for i in range(len(ENCODINGS) - 2, -1, -1):
            place = F.when(s["token"].rlike(ENCODINGS[i][1]), i).otherwise(place)
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["token"].alias("token"), place.alias("enc"))

    def code(s: Column) -> Column:
        alphabet = F.element_at(F.array(*[F.lit(e[2]) for e in ENCODINGS]), s["enc"] + 1)
        x = F.transform(F.regexp_extract_all(s["token"], F.lit("."), F.lit(0)), lambda c: F.instr(alphabet, c).cast("double") - 1)
        return F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["token"].alias("token"), s["enc"].alias("enc"),
            x.alias("x"), F.length(alphabet).cast("double").alias("k"), F.length(s["token"]).cast("double").alias("n"),
            F.split(alphabet, "").alias("signs"),
        )

    def sums(s: Column) -> Column:
        squares = F.aggregate(
            s["signs"], F.lit(0.0),
            lambda acc, c: acc + F.when(c == "", 0.0).otherwise(F.pow(s["n"] - F.length(F.replace(s["token"], c, F.lit(""))), F.lit(2.0))),
        )
        mean = F.aggregate(s["x"], F.lit(0.0), lambda a, v: a + v, lambda a: a / s["n"])
        high = F.aggregate(s["x"], F.lit(0.0), lambda a, v: a + F.when(v * 2 >= s["k"], 1.0).otherwise(0.0))
        return F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["enc"].alias("enc"), s["x"].alias("x"), s["k"].alias("k"),
            s["n"].alias("n"), squares.alias("squares"), mean.alias("mean"), high.alias("high"),
        )

    def series(s: Column) -> Column:
        first = F.struct(F.lit(None).cast("double").alias("last"), F.lit(1.0).alias("runs"), F.lit(0.0).alias("var"), F.lit(0.0).alias("cov"))

        def step(a: Column, v: Column) -> Column:
            turn = (a["last"] * 2 >= s["k"]) != (v * 2 >= s["k"])
            return F.struct(
                v.alias("last"),
                (a["runs"] + F.when(turn, 1.0).otherwise(0.0)).alias("runs"),
                (a["var"] + (v - s["mean"]) * (v - s["mean"])).alias("var"),
                (a["cov"] + F.coalesce((a["last"] - s["mean"]) * (v - s["mean"]), F.lit(0.0))).alias("cov"),
            )

        got = F.aggregate(s["x"], first, step)
        return F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), s["enc"].alias("enc"), s["k"].alias("k"), s["n"].alias("n"),
            s["squares"].alias("squares"), s["high"].alias("high"), got.alias("t"),
        )

    def tests(s: Column) -> Column:
        n, k, df = s["n"], s["k"], s["k"] - 1
        chi = s["squares"] * k / n - n
        # chi-squared to a normal by its cube root, with the variance that a sum over n signs has
        even = F.greatest(chi, F.lit(0.0)) / df
        spread = F.sqrt(2 * (n - 1) / (9 * df * n))
        uniform = _normal_sf2((F.cbrt(even) - (1 - 2 / (9 * df))) / spread)
        low = n - s["high"]
        expected = 2 * s["high"] * low / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(variance > 0, _normal_sf2((s["t"]["runs"] - expected) / F.sqrt(variance))).otherwise(F.lit(1e-12))
        serial = F.when(s["t"]["var"] > 0, _normal_sf2((s["t"]["cov"] / s["t"]["var"] + 1 / n) * F.sqrt(n))).otherwise(F.lit(1e-12))
        half = -(F.log(F.greatest(uniform, F.lit(1e-30))) + F.log(F.greatest(runs, F.lit(1e-30))) + F.log(F.greatest(serial, F.lit(1e-30))))
        return F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["enc"].alias("enc"), n.alias("n"), half.alias("half"))

    def joined(s: Column) -> Column:
        # Fisher: twice the sum of -log p is chi-squared with 6 degrees of freedom
        p = F.exp(-s["half"]) * (1 + s["half"] + s["half"] * s["half"] / 2)
        return F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"),
            (s["enc"] * 64 + F.floor(F.log2(s["n"]))).cast("int").alias("stratum"), F.least(p, F.lit(1.0)).alias("p"),
        )

    for f in (encode, code, sums, series, tests, joined):
        spans = F.transform(spans, f)
    return spans


#: Mixtures that are looked at: the share of random tokens, and the exponent of the ordinary ones' distribution p ** a. Ordinary
#: tokens are held to have p-values at least as low as with the last exponent; without such a bound they could not be told from random ones.
SHARES = [i / 100 for i in range(101)]
EXPONENTS = [i / 50 for i in range(1, 26)]
UNREFUTED = 3.0  # log likelihood under the best mixture's: the 95 % region of two parameters


@functools.cache
def _logs() -> dict[tuple[float, float], list[float]]:
    """The log probability of each bin under each mixture."""
    out = {}
    for a in EXPONENTS:
        mass = [((i + 1) / BINS) ** a - (i / BINS) ** a for i in range(BINS)]
        out |= {(w, a): [math.log(w / BINS + (1 - w) * m) for m in mass] for w in SHARES}
    return out


def _pools(counts: dict[int, list[int]], evidence: int) -> list[tuple[list[int], list[int]]]:
    """(strata, histogram): strata of ``evidence`` tokens by themselves, thinner ones of one encoding with their neighbours in length."""
    pools: list[tuple[list[int], list[int]]] = []
    thin: tuple[list[int], list[int]] = ([], [])
    for stratum in sorted(counts):
        if thin[0] and (thin[0][-1] // 64 != stratum // 64 or sum(counts[stratum]) >= evidence):
            pools.append(thin)
            thin = ([], [])
        if sum(counts[stratum]) >= evidence:
            pools.append(([stratum], counts[stratum]))
        else:
            thin = ([*thin[0], stratum], [a + b for a, b in zip(thin[1] or [0] * BINS, counts[stratum], strict=True)])
    return [*pools, thin] if thin[0] else pools


def cuts(counts: dict[int, list[int]], fdr: float, highest: float = 0.5, evidence: int = 1000) -> dict[int, float]:
    """The least p-value to report in each stratum, from its histogram of p-values over [0, 1]; strata without one are left out.

    For each mixture of ``SHARES`` and ``EXPONENTS`` that the histogram does not refute (its likelihood is within
    ``UNREFUTED`` of the best one's) the share of ordinary tokens above a cut follows; the largest of these shares has to be at most ``fdr``.
    """
    out = {}
    for strata, bins in _pools(counts, evidence):
        held = [(i, n) for i, n in enumerate(bins) if n]
        likely = {m: sum(n * logs[i] for i, n in held) for m, logs in _logs().items()}
        best = max(likely.values(), default=0.0)
        open_to = [m for m, value in likely.items() if value >= best - UNREFUTED]

        def ordinary(cut: float, open_to: list[tuple[float, float]] = open_to) -> float:
            shares = ((1 - w) * (1 - cut**a) for w, a in open_to)
            return max(x / (x + w * (1 - cut)) for x, (w, _) in zip(shares, open_to, strict=True))

        found = next((b / BINS for b in range(1, int(highest * BINS) + 1) if ordinary(b / BINS) <= fdr), None)
        if found is not None:
            out |= dict.fromkeys(strata, found)
    return out


def secret_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: tuple[Kind, ...] = BASE,
    fdr: float = 0.05,
    least_signs: int = 16,
) -> DataFrame:
    """One row per document: doc_id, and spans, an array of (kind, start, stop) in code points, stop exclusive.

    ``fdr`` bounds the share of ordinary tokens among the random ones of a stratum. Runs of fewer than ``least_signs`` signs are not
    tested: they carry too little to be told from words. In a table with few tokens no cut has evidence, and only known formats are found.

    Spans are ordered by start, then kind as listed in ``base``, ``random`` last; a random token that overlaps
    a known span is not added. Null and empty texts have no spans; repeated rows all return; an empty table gives an
    empty result. The estimates behind the cuts read the tokens of all documents.
    """
    text = text_of(text_col)
    known = F.concat(*[spans_of(F.col("text"), k.name, k.pattern, k.group, k.least) for k in base])
    rows = docs.select(col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id",
        F.transform(known, lambda s: F.struct(s["kind"], s["start"], s["stop"])).alias("known"),
        battery(spans_of(F.col("text"), RANDOM, _RUN % least_signs)).alias("tokens"),
    )
    rows = staged(rows, "secret-spans")
    token = rows.select(F.explode("tokens").alias("t"))
    by_bin = token.groupBy(
        F.col("t.stratum").alias("stratum"), F.least(F.floor(F.col("t.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")
    ).count()
    counts: dict[int, list[int]] = {}
    for r in by_bin.collect():  # encodings x powers of two x bins
        counts.setdefault(r["stratum"], [0] * BINS)[r["bin"]] = r["count"]
    cut = cuts(counts, fdr)
    least = F.create_map(*[F.lit(x) for pair in cut.items() for x in pair]) if cut else None
    none = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
    if least is None:
        random = none
    else:
        kept = F.filter("tokens", lambda t: F.coalesce(t["p"] >= least[t["stratum"]], F.lit(False)))
        random = F.transform(_free_of(kept, F.col("known")), lambda t: F.struct(F.lit(RANDOM).alias("kind"), t["start"].alias("start"), t["stop"].alias("stop")))
    names = [*(k.name for k in base), RANDOM]
    place = lambda s: F.array_position(F.array(*map(F.lit, names)), s["kind"])
    ordered = F.transform(
        F.array_sort(F.transform(F.concat("known", random), lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["stop"].alias("stop"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")),
    )
    return rows.select("doc_id", ordered.alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
