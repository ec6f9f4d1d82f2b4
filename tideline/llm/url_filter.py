"""URL rules and exact list membership by a cascade of Bloom filters.

Level 1 is a Bloom filter of the listed keys. Level 2 holds those unlisted keys of the corpus that level 1
wrongly claims, level 3 the listed keys that level 2 wrongly claims, and so on until a level claims nothing wrongly.
The first level that does not claim a key decides: an odd one means unlisted, an even one listed; a key that all levels
claim is listed if their number is odd. As the levels are built over all keys of the corpus, the answer is exact
for each of them, and no row is joined with the list.

Keys are dealt into slices by a hash, and each slice has its own filters of bounded size, so a filter row is small
at every size of the list. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Filters up to this many bytes in all are broadcast; beyond, pages meet them by a shuffle on the slice.
SALTS = 16
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where ``://`` is missing."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = rest.substr(F.length(raw) + 1, F.length(rest))
    return F.translate(raw, UPPER, LOWER), F.regexp_extract(after, r"^[^?#]*", 0)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits a host (or its parent) and path; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _positions(key: Column, level: Column, bits: Column, hashes: int) -> Column:
    """Bit places of a key at a level (double hashing)."""
    a, b = F.xxhash64(key, level), F.xxhash64(level, key, F.lit("step"))
    wide = lambda h: F.pmod(h, bits)
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda i: F.pmod(wide(a) + i * (wide(b) + 1), bits))


def _claims(words: Column, key: Column, level: Column, bits: Column, hashes: int) -> Column:
    """Whether the filter (array of 64-bit words) claims the key; an empty filter claims none."""
    def has(p: Column) -> Column:
        word = F.element_at(words, (F.floor(p / 64) + 1).cast("int"))
        return F.getbit(word, (p % 64).cast("int")) == 1

    return F.when(F.size(words) > 0, F.forall(_positions(key, level, bits, hashes), has)).otherwise(F.lit(False))


class Cascade:
    """Filters by slice: a row for each slice with an array of levels."""

    def __init__(self, filters: DataFrame, slices: int, levels: int, bits: list[int], hashes: int):
        self.filters, self.slices, self.levels, self.bits, self.hashes = filters, slices, levels, bits, hashes

    def slice_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(self.slices)).cast("int")

    def mark(self, rows: DataFrame, key: str, out: str) -> DataFrame:
        """Add the boolean ``out``: whether the key column's value is listed. Null keys are not."""
        at, words, at2, salt, salt2 = fresh(rows, "slice", "levels", "slice2", "salt", "salt2")
        filters = self.filters.select(F.col("slice").alias(at2), F.col("levels").alias(words))
        dealt = rows.withColumn(at, F.coalesce(self.slice_of(col(key)), F.lit(0)))
        if self.slices * sum(b // 8 for b in self.bits) <= BROADCAST_BYTES:
            filters = F.broadcast(filters.withColumn(salt2, F.lit(0)))
            dealt = dealt.withColumn(salt, F.lit(0))
        else:
            # a key may hold a third of the rows: its slice is copied for every salt
            filters = filters.withColumn(salt2, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            dealt = dealt.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        joined = dealt.join(filters, (dealt[at] == filters[at2]) & (dealt[salt] == filters[salt2]), "left")
        verdict = F.lit(self.levels % 2 == 1)
        for level in range(self.levels, 0, -1):
            claimed = _claims(col(words)[level - 1], col(key), F.lit(level), F.lit(self.bits[level - 1]).cast("long"), self.hashes)
            verdict = F.when(~claimed, F.lit(level % 2 == 0)).otherwise(verdict)
        return joined.withColumn(out, F.coalesce(verdict & col(key).isNotNull(), F.lit(False))).drop(at, at2, words, salt, salt2)


def build_cascade(listed: DataFrame, universe: DataFrame, key: str, keys_per_slice: int = 16_384, bits_per_key: int = 10, hashes: int = 7) -> Cascade:
    """A cascade that is exact for every key of ``universe`` (and every listed key).

    Both tables need the column ``key``; repeats and nulls do not matter. Each level is one pass over the keys that
    the level before claims; their number falls by the rate of false claims (about 1 in 100) every time.
    """
    keys = universe.select(col(key).alias("k"), F.lit(0).alias("l")).union(listed.select(col(key).alias("k"), F.lit(1).alias("l")))
    keys = keys.where("k is not null").groupBy("k").agg(F.max("l").alias("l"))
    n = listed.select(F.approx_count_distinct(col(key))).first()[0]
    slices = max(1, -(-int(n * 1.1) // keys_per_slice))
    made = Cascade(None, slices, 0, [], hashes)
    # "odd" keys are those that level 1 encodes, "in" tells whether the level at hand encodes the key
    left = staged(keys.withColumn("slice", made.slice_of(F.col("k"))), "cascade-keys")
    levels: list[DataFrame] = []
    for level in range(1, 65):
        inside = F.col("l") == F.lit(level % 2)
        most = left.where(inside).groupBy("slice").count().agg(F.max("count")).first()[0]
        if not most:
            break
        bits = max(64, -(-most * bits_per_key // 64) * 64)
        spots = left.where(inside).select(
            "slice", F.explode(_positions(F.col("k"), F.lit(level), F.lit(bits).cast("long"), hashes)).alias("p")
        )
        spots = spots.groupBy("slice", F.floor(F.col("p") / 64).cast("int").alias("w")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("v")
        )
        # at most bits / 64 words a slice
        given = spots.groupBy("slice").agg(F.map_from_entries(F.collect_list(F.struct("w", "v"))).alias("m"))
        words = F.transform(F.sequence(F.lit(0), F.lit(bits // 64 - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long")))
        filters = staged(given.select("slice", words.alias("words")), "cascade-level")
        levels.append(filters)
        made.bits.append(bits)
        made.levels = level
        small = F.broadcast(filters) if slices * bits // 8 <= BROADCAST_BYTES else filters
        claimed = _claims(F.col("words"), F.col("k"), F.lit(level), F.lit(bits).cast("long"), hashes)
        # the next level's keys: wrongly claimed here; and those that it must tell apart: encoded here
        left = staged(left.join(small, "slice", "left").where(inside | F.coalesce(claimed, F.lit(False))).select("k", "l", "slice"), "cascade-keys")
    else:
        raise RuntimeError("the cascade still has wrong claims after 64 levels: give it more bits a key")
    empty = F.array().cast("array<bigint>")
    rows = listed.sparkSession.range(slices).select(F.col("id").cast("int").alias("slice"))
    names = []
    for i, filters in enumerate(levels):
        names.append(f"w{i}")
        rows = rows.join(filters.withColumnRenamed("words", names[-1]), "slice", "left")
    made.filters = staged(
        rows.select("slice", (F.array(*[F.coalesce(F.col(x), empty) for x in names]) if names else F.array(empty)).alias("levels")),
        "cascade",
    )
    return made


def url_filter(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    listed_hosts: DataFrame | None = None,
    blocked_share: float = 0.5,
    keys_per_slice: int = 16_384,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block).

    The longest fitting rule decides. Where none fits, the page is blocked if its host is listed: in
    ``listed_hosts`` (column host) or, without it, if block rules decide at least ``blocked_share`` of the host's pages.
    The list is asked through a cascade built over all hosts of ``pages``. A null url, or one without ``://``, has empty
    host and path, fits no rule with a host, and its empty host is never listed. Repeated rows all return.
    """
    host, path = host_and_path(col(url_col))
    parts = pages.select(col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = staged(parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule")), "pages")
    if listed_hosts is None:
        shares = judged.where("host != ''").groupBy("host").agg(
            F.sum(F.when(F.col("by_rule") == "block", 1).otherwise(0)).alias("blocked"), F.count(F.lit(1)).alias("n")
        )
        listed_hosts = shares.where((F.col("blocked") > 0) & (F.col("blocked") >= F.col("n") * blocked_share)).select("host")
    listed_hosts = staged(listed_hosts.select("host").where("host != ''").distinct(), "listed-hosts")
    cascade = build_cascade(listed_hosts, judged.select("host").distinct(), "host", keys_per_slice)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return cascade.mark(judged, "host", "listed").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict")
    )
