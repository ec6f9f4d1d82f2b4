"""Fill-in-the-middle, Merkle manifest and chosen-path join against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from fixture_docs import make  # noqa: F401
from tideline.llm import chosen_path as C
from tideline.llm import fill_middle as M
from tideline.llm import merkle as T
from tideline.llm import queries as REG
from tideline.llm.common import table

SF = "/root/testdata/sf0.01"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# --- fill in the middle ----------------------------------------------------------------------

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def test_boundary_sets_select_what_tokens_end():
    rng, kinds = random.Random(1), set()
    texts = ["", "a", " ", "é", "a" * 70_000, "\x00" * 70_000, "a b" * 30_000 + "é🙂z" * 30_000]
    texts += ["".join(rng.choices(rng.choice(["ab ", "aé🙂 \n", "abcdefghij "]), k=n)) for n in (65_534, 65_535, 65_536, 65_537)]
    texts += ["".join(rng.choices("abc é\n", k=rng.randint(0, 300))) for _ in range(100)]
    for text in texts:
        ends = np.r_[0, np.cumsum([len(t) for t in TOKEN.findall(text)])].astype(int)
        found = M.BoundarySet(text)
        assert len(found) == len(ends)
        assert all(found.select(k) == ends[k] for k in {0, len(ends) - 1, *(rng.randrange(len(ends)) for _ in range(40))})
        kinds |= {type(c).__name__ for c in found.containers}
        with pytest.raises(IndexError):
            found.select(len(ends))
    assert kinds == {"_Array", "_Bitmap", "_Runs"}


def brute_fim(doc, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    h = sha(f"1:{'' if doc is None else doc}")
    a, b, c, d = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    lo, hi = sorted((a % (len(tokens) + 1), b % (len(tokens) + 1)))
    p, m, s = ("".join(x) for x in (tokens[:lo], tokens[lo:hi], tokens[hi:]))
    if not text or any(x in text for x in M.MARKS) or c % 100 >= 90:
        return len(tokens), "plain", None, None, text
    if d % 100 < 20:
        return len(tokens), "spm", len(p), len(p) + len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(tokens), "psm", len(p), len(p) + len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_rows(spark, make):
    rng = random.Random(2)
    pairs = [(i, "".join(rng.choices("ab cé🙂\n<SPM>", k=rng.randint(0, 60)))) for i in range(300)]
    pairs += [(1, None), (2, ""), (None, "word one two"), (None, "word one two"), (5, "x <M> y"), (6, "y " * 200_000), (-3, "minus one")]
    got = M.fill_in_middle(make(pairs)).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert Counter((r.doc_id, r.n, r.form, r.cut_a, r.cut_b, r.output) for r in got) == Counter(
        (i, *brute_fim(i, t)) for i, t in pairs
    )
    assert Counter((r.doc_id, r.back) for r in got) == Counter((i, t or "") for i, t in pairs)
    assert M.fill_in_middle(make([])).collect() == []
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_marks(spark, make):
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "ba", "c"), ("aa", "b", "c")):
        with pytest.raises(ValueError, match="overlap"):
            M.fill_in_middle(make([]), marks=bad)


# --- Merkle manifest -------------------------------------------------------------------------


def brute_leaf(values):
    put = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(map(put, values)))


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def brute_manifest(rows, tampered):
    """(id, leaf, subroot, root, proof, folded) of each row (id, source, lang, n_chars, text)."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    names = sorted(by_lang, key=lambda n: (n is not None, (n or "").encode()))
    trees = {}
    for n in names:
        by_lang[n].sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        trees[n] = brute_levels([brute_leaf(r) for r in by_lang[n]])
    above = brute_levels([trees[n][-1][0] for n in names])
    out = []
    for g, n in enumerate(names):
        for i, r in enumerate(by_lang[n]):
            path = []
            for levels, at in ((trees[n], i), (above, g)):
                for level in levels[:-1]:
                    path.append((at & 1, level[at ^ 1] if (at ^ 1) < len(level) else None))
                    at >>= 1
            node = brute_leaf(tampered(r))
            for odd, sibling in path:
                node = sha(node if sibling is None else sibling + node if odd else node + sibling)
            proof = sha("".join(s for _, s in path if s is not None))
            out.append((r[0], brute_leaf(r), trees[n][-1][0], above[-1][0], proof, node))
    return out


def claim(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
    return (*r[:3], r[3] + 1, r[4]) if hit else r


MERKLE = "doc_id long, source string, lang string, n_chars long, text string, grp string, pos long, digest string"


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_manifest_equals_brute_force(spark, depth):
    rng = random.Random(depth)
    langs = [None, "", "en", "é", "z"] + [f"l{i}" for i in range(9)]
    rows = [(i, f"s{i % 3}", rng.choice(langs[2:]) if i % 3 else "en", i, f"text é {i}") for i in range(150)]
    rows += [(None, None, None, None, None)] * 3 + [(7, "s", "en", 3, "same")] * 4 + [(900, "s", "lone", None, "x" * 100_000)]
    rows += [(None, "a", "en", 1, ""), (2**60, "a", "", 1, "1:a")]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], MERKLE)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claims = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    got = T.merkle_manifest(docs, claims=claims, depth=depth, proofs=True).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter(brute_manifest(rows, claim))
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    assert sum(not r.verified for r in got) == sum(claim(r) != r for r in rows) > 0
    assert all(sha("".join(p[1:] for p in r.proof)) == r.proof_sha256 for r in got)


def test_manifest_small_and_empty(spark):
    one = spark.createDataFrame([(1, "s", "en", 3, "abc", "x", 1, "y")], MERKLE)
    (r,) = T.merkle_manifest(one).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root == brute_leaf((1, "s", "en", 3, "abc")) and r.verified
    assert r.proof_sha256 == sha("")
    assert T.merkle_manifest(one.where("doc_id = 2")).collect() == []


# --- chosen-path join ------------------------------------------------------------------------


def brute_sets(pairs, words=5):
    out = []
    for _, text in pairs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        out.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    return out


def brute_components(pairs, num=85, den=100):
    sets = brute_sets(pairs)
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [
        (doc, len(sets[i]), least.get(find(i)) if sets[i] else doc, doc is not None and (not sets[i] or least.get(find(i)) == doc))
        for i, (doc, _) in enumerate(pairs)
    ]


def near_copies(rng, base, share):
    """A copy with single words changed, each of which costs up to five shingles."""
    words = base.split()
    for _ in range(max(1, round(len(words) * share / 10))):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def planted(rng, families=30, copies=6, words=120):
    vocabulary = [f"v{i}" for i in range(3000)]
    shared = " ".join(rng.choices(vocabulary, k=60))
    pairs = []
    for f in range(families):
        base = " ".join(rng.choices(vocabulary, k=words))
        if f % 5 == 0:
            base += " " + shared
        for c in range(copies):
            share = rng.choice([0.0, 0.1, 0.2, 0.3, 0.4])
            text = near_copies(rng, base, share) if share else base
            pairs.append((1000 * f + c, text.upper() if c == 1 else text.replace(" ", " \n") if c == 2 else text))
    rng.shuffle(pairs)
    return pairs


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"), (None, None),
    (4, "one two"), (7, "a b c d e"), (8, "a b c d e f"), (None, "null only text of more than five words"),
    (None, "null only text of more than five words"), (9, "é É x y z"), (10, "é É X y z"), (11, "word " * 50_000), (12, "word " * 3),
]


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_chosen_path_equals_brute_force(spark, make):
    pairs = planted(random.Random(3)) + [(i and i + 10**6, t) for i, t in EDGES]
    assert rows_of(C.chosen_path_components(make(pairs))) == Counter(brute_components(pairs))
    assert C.chosen_path_components(make([])).collect() == []


@pytest.mark.parametrize("sizes", [dict(limit=4, max_depth=1, block=8), dict(limit=3, max_depth=6, block=5)])
def test_chosen_path_branches_and_blocks(spark, make, sizes):
    """Leaves, levels and blocks that are too small for their groups: nothing is lost."""
    rng = random.Random(4)
    base = " ".join(f"b{rng.randrange(2000)}" for _ in range(150))
    pairs = planted(rng, families=8) + [(50_000 + i, near_copies(rng, base, rng.choice([0.05, 0.1, 0.3]))) for i in range(60)]
    assert rows_of(C.chosen_path_components(make(pairs), **sizes)) == Counter(brute_components(pairs))


def test_chosen_path_recall_of_pairs_at_the_border(spark, make):
    """Pairs alone in the table, of a similarity just over the least: the trees have to find them."""
    rng, pairs = random.Random(5), []
    for i in range(400):
        words = [f"x{rng.randrange(10**9)}" for _ in range(200)]
        other = [*words]
        for at in rng.sample(range(20, 180), 3):
            other[at] = "changed"  # 15 shingles of 196 and 15 new ones: 181 / 211
        pairs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    want = Counter(brute_components(pairs))
    got = rows_of(C.chosen_path_components(make(pairs)))
    linked = sum(n for r, n in want.items() if not r[3])
    assert linked > 300 and sum(n for r, n in got.items() if not r[3]) >= 0.999 * linked


def test_trees_follow_the_recall():
    assert C.survival(1.0, 5, 0.85) == 1.0
    assert 0 < C.survival(0.85, 4, 0.85) < C.survival(0.85, 1, 0.85) < 1
    assert C.trees_for(0.99, 0.85) < C.trees_for(0.9999, 0.85)
    one, two = C.picked(np.arange(100_000, dtype=np.uint64), 0.85)
    assert abs((two >= 0).mean() - (1 / 0.85 - 1)) < 0.01 and one.min() == 0 and one.max() == C.COORDINATES - 1


def test_round_queries_match_sql(spark):
    for name in ("op11_fill_middle",):
        ok, said = compare(REG.QUERIES[name](spark, SF), duck(SF), REG.ORACLES[name])
        assert ok, said


def test_merkle_query_on_the_table(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = REG.op12_merkle_manifest(spark, SF).collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter(brute_manifest(docs, claim))


def test_chosen_path_query_on_the_table(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert rows_of(REG.op13_chosen_path(spark, SF)) == Counter(brute_components(docs))
