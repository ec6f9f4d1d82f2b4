"""Registered queries of the training-data operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chosen_path import chosen_path_components
from .common import ship, table
from .exact_dedup import exact_dedup
from .fill_middle import fill_in_middle, restored
from .licenses import all_templates, license_scan
from .merkle import merkle_manifest
from .mixing import TARGETS, domain_label, mix
from .packing import best_fit_packing
from .quality import fit_quality, score_quality
from .secrets import BASE, secret_scan, span_text
from .simhash import simhash_components
from .token_ids import read_ids, write_ids
from .topk import exact_topk
from .url_filter import Rule, url_filter

#: The vocabulary file that the contract names; operators take its path as a parameter.
TOKENIZER = "byte_bpe_50k.json"

RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    names = [k.name for k in BASE]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    known = F.filter("spans", lambda s: s["kind"].isin(*names))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in names],
        F.sha2(span_text(known).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a fan of 8: a round exchanges runs among eight partners, which is three binomial rounds (fan 2) in one shuffle."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_ids(docs, write_ids(docs, tokenizer_file()))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"), templates=all_templates(), windows=True)


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return labels.select("doc_id", domain_label(F.col("quality"), F.col("toxic")).alias("domain"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), domain_labels(spark, sf_dir), TARGETS)


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer=tokenizer_file())


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), RULES)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        F.col("cut_a").alias("prefix_chars"),
        (F.col("cut_b") - F.col("cut_a")).alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row (by the crc32 of its id) claims one more character than it has."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claim = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle_manifest(table(spark, sf_dir, "documents"), claims={"n_chars": claim})


def op13_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path_components(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (
        op1_secret_scans, op2_exact_dedup, op3_quality, op4_token_ids, op5_license_scans,
        op6_mixing, op7_exact_topk, op8_best_fit_packing, op9_simhash, op10_url_filters,
        op11_fill_middle, op12_merkle_manifest, op13_chosen_path,
    )
}

_OP2 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM w
"""

_OP7 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_OP10 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM h),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p),
b AS (SELECT *, coalesce(rule IN ('example.com/en/', 'net/es/', 'net/fr/'), false) AS blocked FROM r),
l AS (SELECT host FROM b WHERE host <> '' GROUP BY host HAVING sum(blocked::INT) > 0 AND sum(blocked::INT) >= count(*) * 0.5)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN CASE WHEN blocked THEN 'block' ELSE 'allow' END
            WHEN host IN (SELECT host FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM b
"""

_OP11 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
g AS (
  SELECT *, len(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(t) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(t) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT doc_id, text, n, form, array_to_string(t[1:least(x, y)], '') AS p,
         array_to_string(t[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(t[greatest(x, y) + 1:], '') AS s
  FROM g)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""

_H = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR END"
_LEAF = " || ".join(_H.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_CLAIM = " || ".join(_H.format(c) for c in ("doc_id", "source", "lang", "claimed", "text"))
# crc32 by its definition: a step for each bit of each digit of the decimal id
_OP12 = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, doc_id::VARCHAR AS digits, 1 AS digit, 0 AS bit, xor(4294967295, ascii(substr(doc_id::VARCHAR, 1, 1))::BIGINT) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, digits, digit + (bit = 7)::INT, (bit + 1) % 8,
         xor(xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END),
             CASE WHEN bit = 7 AND digit < length(digits) THEN ascii(substr(digits, digit + 1, 1))::BIGINT ELSE 0 END)
  FROM crc WHERE digit <= length(digits)),
hit AS (SELECT doc_id FROM crc WHERE digit > length(digits) AND xor(c, 4294967295) % 7 = 0),
claims AS (SELECT d.*, n_chars + (doc_id IN (SELECT doc_id FROM hit) AND doc_id IS NOT NULL)::INT AS claimed FROM documents d),
leaves AS (SELECT doc_id, lang, sha256({_LEAF}) AS leaf, sha256({_CLAIM}) AS claim FROM claims),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place FROM leaves),
-- every level of every group's tree, and of the tree over the groups (group -1)
lower_levels AS (
  SELECT place, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY place
  UNION ALL
  SELECT place, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM lower_levels WHERE len(nodes) > 1),
tops AS (SELECT place, arg_max(nodes, level)[1] AS subroot, max(level) AS levels FROM lower_levels GROUP BY place),
upper_levels AS (
  SELECT -1 AS place, 0 AS level, list(subroot ORDER BY place) AS nodes FROM tops
  UNION ALL
  SELECT place, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM upper_levels WHERE len(nodes) > 1),
roots AS (SELECT arg_max(nodes, level)[1] AS root FROM upper_levels),
trees AS (SELECT * FROM lower_levels UNION ALL SELECT * FROM upper_levels),
steps AS (
  SELECT p.place, p.pos, t.level AS step, (p.pos >> t.level) AS spot, t.nodes FROM placed p JOIN trees t ON t.place = p.place AND len(t.nodes) > 1
  UNION ALL
  SELECT p.place, p.pos, o.levels + t.level, (p.place >> t.level), t.nodes
  FROM placed p JOIN tops o USING (place) JOIN trees t ON t.place = -1 AND len(t.nodes) > 1),
path AS (SELECT place, pos, step, spot % 2 = 1 AS odd, nodes[xor(spot, 1) + 1] AS sibling FROM steps),
folds AS (
  SELECT place, pos, 0 AS step, claim AS node FROM placed
  UNION ALL
  SELECT f.place, f.pos, f.step + 1,
         sha256(CASE WHEN sibling IS NULL THEN node WHEN odd THEN sibling || node ELSE node || sibling END)
  FROM folds f JOIN path p ON p.place = f.place AND p.pos = f.pos AND p.step = f.step),
folded AS (SELECT place, pos, arg_max(node, step) AS folded_root FROM folds GROUP BY place, pos),
proofs AS (SELECT place, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM path GROUP BY place, pos)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN tops USING (place) JOIN folded USING (place, pos) LEFT JOIN proofs USING (place, pos), roots
"""

_OP13 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
  FROM d),
n AS (SELECT r, doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
x AS (SELECT r, unnest(g) AS g FROM s),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS both_have FROM x a JOIN x b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * both_have >= 85 * (na.n + nb.n - both_have)),
e AS (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT r AS u, r AS v FROM n UNION SELECT c.u, e.v FROM c JOIN e ON c.v = e.u),
m AS (SELECT u, min(doc_id) AS component_id FROM c JOIN n ON n.r = c.v GROUP BY u)
SELECT doc_id, n AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept FROM n JOIN m ON m.u = n.r
"""

ORACLES: dict[str, str] = {
    "op2_exact_dedup": _OP2,
    "op7_exact_topk": _OP7,
    "op10_url_filters": _OP10,
    "op11_fill_middle": _OP11,
    "op12_merkle_manifest": _OP12,
    "op13_chosen_path": _OP13,
}
