"""Quality, token ids, mixing, top-k, packing, URL filters and the pipeline."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, duck
from fixture_docs import make  # noqa: F401
from tideline.llm import mixing as M
from tideline.llm import packing as P
from tideline.llm import quality as Q
from tideline.llm import queries as REG
from tideline.llm import token_ids as T
from tideline.llm import topk as K
from tideline.llm import url_filter as U
from tideline.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck_mid():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(REG.ORACLES))
def test_queries_match_sql(spark, duck_mid, name):
    ok, said = compare(REG.QUERIES[name](spark, SF), duck_mid, REG.ORACLES[name])
    assert ok, said


# --- quality ---------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    scored = REG.op3_quality(spark, SF)
    rows = scored.collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = scored.where("held_out").join(table(spark, SF, "labels"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in judged) / len(judged) > 0.9


def test_quality_reads_no_held_out_label(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    other = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.fit_quality(docs, labels), Q.fit_quality(docs, other)
    assert np.allclose(a.ridge, b.ridge) and np.allclose(a.levels, b.levels)


def test_quality_edges(spark, make):
    docs = make([(1, None), (2, ""), (3, "word " * 90_000), (None, "x"), (3, "word"), (4, "\n \n")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = Q.score_quality(docs, Q.fit_quality(docs, none)).collect()
    assert len(rows) == 6 and all(r.score == 1.0 for r in rows)
    one = spark.createDataFrame([(1, 0), (None, 1), (2, None), (4, 0)], "doc_id long, quality int")
    assert all(r.score == 0.0 for r in Q.score_quality(docs, Q.fit_quality(docs, one)).collect())
    assert Q.score_quality(make([]), Q.fit_quality(make([]), one)).collect() == []


def test_quality_fit_equals_plain_numpy(spark):
    """Ridge by stacked least squares and the isotonic curve by the min-max formula, over collected rows."""
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    label = {r.doc_id: float(r.quality) for r in table(spark, SF, "labels").collect()}
    rest = lambda i: zlib.crc32(str(i).encode()) % 4
    ids = [i for i in docs if i in label and rest(i) != 2]
    stats, y = np.array([Q.statistics(docs[i] or "") for i in ids], float), np.array([label[i] for i in ids])
    model = Q.fit_quality(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert np.allclose(model.mean, stats.mean(axis=0)) and np.allclose(model.scale, np.where(stats.std(axis=0) > 1e-9, stats.std(axis=0), 1))
    z, cal = model.features(stats), np.array([rest(i) == 3 for i in ids])
    eye = np.eye(z.shape[1])
    stacked = np.vstack([z[~cal], math.sqrt(1e-3 * (~cal).sum()) * eye[1:], math.sqrt(1e-9) * eye])
    ridge = np.linalg.lstsq(stacked, np.r_[y[~cal], np.zeros(2 * len(eye) - 1)], rcond=None)[0]
    assert np.allclose(z @ ridge, z @ model.ridge, atol=1e-5)
    raw = z[cal] @ model.ridge
    slot = np.floor(np.clip(raw, -0.5, 1.5) * 200)
    bins = sorted((raw[slot == b].mean(), y[cal][slot == b].mean(), (slot == b).sum()) for b in np.unique(slot))
    _, means, weights = map(np.array, zip(*bins, strict=True))
    mean = lambda a, b: np.average(means[a : b + 1], weights=weights[a : b + 1])
    n = len(bins)
    curve = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    assert np.allclose(np.unique(np.round(curve, 9)), model.levels)


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    x = np.arange(50.0)
    knots, levels = Q.isotonic(x, np.clip(x / 50 + rng.normal(0, 0.2, 50), 0, 1), np.ones(50))
    assert (np.diff(knots) > 0).all() and (np.diff(levels) > 0).all()


# --- token ids -------------------------------------------------------------------------------

IDS = [
    (7, "Hello  world \n\n two\u00a0three é🙂"), (3, None), (3, ""), (9, "a" * 5000), (None, "tail"), (None, "tail"),
    (1, "<|endoftext|> x <|endoftext|>"), (2, " \t "), (5, "don't they'll 123 4 5.6 !!! \r\n x\x1cy"), (8, "word other " * 150_000),
    (-4, "İstanbul ﬁ  \x0b\x0c z"),
]


def test_ids_round_trip(spark, make):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    pairs = IDS + [(100 + i, " ".join(rng.choice(["ab", "Ça", "x1", "\n", "--", "日本 語"]) for _ in range(rng.randint(0, 40)))) for i in range(200)]
    docs = make(pairs).repartition(4)
    store = T.write_ids(docs, REG.tokenizer_file(), docs_per_shard=37, keys_per_part=50)
    assert len(store.shards) > 3 and len(store.parts) > 3
    plain = Tokenizer.from_file(REG.tokenizer_file())
    direct = {}
    for i, t in pairs:
        direct.setdefault(i, []).append([*plain.encode(t or "", add_special_tokens=False).ids, 2])
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in T.read_ids(docs, store).collect())
    assert [g[1] for g in got] == sorted((i for i, _ in pairs), key=lambda i: (i is None, i or 0))
    at = 0
    for start, doc, n, crc in got:
        assert start == at
        want = {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in direct[doc]}
        assert (n, crc) in want
        at += n
    assert store.get(7).tolist() == direct[7][0] and store.get(None, 1) is not None
    assert {tuple(store.get(3, k).tolist()) for k in (0, 1)} == {tuple(x) for x in direct[3]}
    assert store.get(3, 2) is None and store.get(12345) is None
    assert T.read_ids(spark.createDataFrame([(99999,), (1,)], "doc_id long"), store).count() == 1


def test_special_names_as_text(make):
    enc = T.encoder(REG.tokenizer_file(), True)
    assert 50256 not in np.frombuffer(next(enc.encode(pa.array(["a <|endoftext|> b"]), 2))[0].as_py(), enc.kind)


def test_the_memory_of_segments_is_bounded_by_their_bytes(monkeypatch):
    monkeypatch.setattr(T, "_HELD", 1 << 18, raising=False)
    texts = [f"{i:06d}" * 500 + f" and {i} more" for i in range(700)]  # words of 3,000 signs, each once
    plain = T.encoder(REG.tokenizer_file()).tokenizer
    want = [[*plain.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    enc = T.Encoder(REG.tokenizer_file(), False)
    got = [x.as_py() for at in range(0, 700, 20) for part in enc.encode(pa.array(texts[at : at + 20]), 2) for x in part]
    assert [np.frombuffer(x, enc.kind).tolist() for x in got] == want
    held = lambda e: sum(map(len, e.known)) + sum(map(len, e.known.old))
    assert 0 < held(enc) < 3 << 18 < sum(map(len, texts))
    counter = T.IdCounter(REG.tokenizer_file(), False)
    assert [n + 1 for at in range(0, 700, 20) for n in counter.counts(pa.array(texts[at : at + 20]))] == [len(x) for x in want]
    assert 0 < held(counter) < 3 << 18


def test_counted_ids_are_those_of_the_tokenizer():
    counter = T.IdCounter(REG.tokenizer_file(), False)
    texts = ["", " a", "a b  c\n\nd", "x y", "x\u2003 y z", "<|endoftext|> a", "  ", "\u65e5\u672c \u3000 b", "tail \u00a0"] * 2
    want = [len(counter.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counter.counts(pa.array(texts)).tolist() == want
    assert counter.counts(pa.array(texts).slice(3, 9)).tolist() == want[3:12]
    assert counter.counts(pa.array([], pa.string())).tolist() == []
    # of a segment no more than a number is kept
    assert {type(n) for n in counter.known.values()} <= {int, type(None)}


def test_ids_of_an_empty_table(make):
    store = T.write_ids(make([]), REG.tokenizer_file())
    assert T.read_ids(make([]), store).collect() == [] and store.get(1) is None


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 20_000)
    slots = T.PerfectHash.build(keys).slots(keys)
    assert sorted(slots) == list(range(20_000))


# --- mixing ----------------------------------------------------------------------------------


def test_totals_meet_targets(spark):
    rows = REG.op6_mixing(spark, "/root/testdata/sf0.1").collect()  # enough labels to tell the domains apart
    total = sum(r.n_tokens for r in rows)
    for d, share in M.TARGETS.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) / total - share) < 1e-3
    assert all(r.rate >= 0 and abs(r.p_good + r.p_poor + r.p_toxic - 1) < 1e-9 for r in rows)
    assert all(abs(r.copies - r.rate) < 1 + 1e-6 for r in rows)


def test_rates_of_projected_gradient(spark):
    rng = np.random.default_rng(2)
    n, p = rng.integers(1, 500, 400), rng.dirichlet([2, 0.5, 0.2], 400)
    members = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n long, p array<double>")
    for goal in ([0.5, 0.3, 0.2], [0.05, 0.05, 0.9], [0.98, 0.02, 0.0]):
        steps = M.fit_rates(members, goal)
        rate = np.array([r.r for r in members.select(M.rate_of(F.col("p"), steps).alias("r")).collect()])
        gap = (rate * n) @ p / n.sum() - goal
        assert (rate >= 0).all() and np.abs(gap).max() < np.abs(n @ p / n.sum() - goal).max() + 1e-9
    assert np.abs(gap).max() < 0.05


def nonnegative_least_squares(a, g):
    """Lawson and Hanson's active-set method: the least |a r - g| over r >= 0."""
    n = a.shape[1]
    r, free = np.zeros(n), np.zeros(n, bool)
    while True:
        slope = a.T @ (g - a @ r)
        if free.all() or slope[~free].max() <= 1e-9 * np.abs(a).max() * max(1, np.abs(g).max()):
            return r
        free[np.where(~free, slope, -np.inf).argmax()] = True
        while True:
            z = np.zeros(n)
            z[free] = np.linalg.lstsq(a[:, free], g, rcond=None)[0]
            low = free & (z <= 1e-12)
            if not low.any():
                r = z
                break
            step = (r[low] / np.maximum(r[low] - z[low], 1e-300)).min()
            r = r + step * (z - r)
            free &= r > 1e-12
            r[~free] = 0


@pytest.mark.parametrize("goal", [[0.5, 0.3, 0.2], [0.4, 0.3, 0.3], [0.05, 0.05, 0.9]])
@pytest.mark.filterwarnings("ignore:the domains' totals")
def test_rates_against_the_active_set(spark, goal):
    """400 rows against an independent solver: targets that it meets nearly at once are met; far ones are approached, never left behind."""
    rng = np.random.default_rng(3)
    n, p = rng.integers(1, 500, 400), rng.dirichlet([2, 0.7, 0.5], 400)
    members = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n long, p array<double>").coalesce(1)
    rate = np.array([r.r for r in members.select(M.rate_of(F.col("p"), M.fit_rates(members, goal, rounds=8)).alias("r")).collect()])
    a, g = (p * n[:, None]).T / n.sum(), np.array(goal)
    least, start, now = (np.linalg.norm(a @ r - g) for r in (nonnegative_least_squares(a, g), np.ones(400), rate))
    assert (rate >= 0).all() and now < start and (goal[2] > 0.5 or now <= least + 0.002)


def test_unmet_targets_are_told(spark):
    members = spark.createDataFrame([(10, [0.5, 0.5]), (20, [0.4, 0.6])], "n long, p array<double>")
    with pytest.warns(UserWarning, match="differ from their targets"):
        M.fit_rates(members, [0.99, 0.01])


def test_posteriors_on_labels_that_were_not_fitted(spark):
    """A quarter of the labels is kept back: posteriors over their words sum to the labelled shares, and toxic words stay rare after mixing."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), REG.domain_labels(spark, "/root/testdata/sf0.1")
    back = F.pmod(F.xxhash64("doc_id", F.lit("t")), F.lit(4)) == 0
    rows = M.mix(docs, labels.where(~back), M.TARGETS).join(labels.where(back), "doc_id").collect()
    words = {d: sum(r.n_tokens for r in rows if r.domain == d) for d in M.TARGETS}
    for d, n in words.items():
        assert abs(sum(r.n_tokens * r[f"p_{d}"] for r in rows) - n) < 0.15 * n
        told = [r for r in rows if r.domain == d]
        assert sum(r[f"p_{d}"] for r in told) / len(told) > 0.5
    toxic = sum(r.rate * r.n_tokens for r in rows if r.domain == "toxic") / sum(r.rate * r.n_tokens for r in rows)
    assert 0.005 < toxic < 0.03


def test_calibration_mends_odds_that_are_too_sure():
    rng = np.random.default_rng(5)
    x = rng.normal(-1, 1.5, (4000, 2))
    e = np.exp(np.c_[np.zeros(4000), x])
    p = e / e.sum(axis=1, keepdims=True)
    rows = [(int(rng.choice(3, p=q)), 1.0, [4 * a - 2, 2 * b + 1]) for q, (a, b) in zip(p, x.tolist(), strict=True)]
    scale, shift = M._calibration(rows, 3)
    assert np.allclose(scale, [0.25, 0.5], atol=0.06) and np.allclose(shift, [0.5, -0.5], atol=0.2)
    assert M._calibration([], 3) == ([1.0, 1.0], [0.0, 0.0])


def test_mixing_edges(spark, make):
    docs = make([(1, None), (2, ""), (3, "a b " * 60_000), (None, "c"), (3, "a b")])
    none = spark.createDataFrame([], "doc_id long, domain string")
    rows = M.mix(docs, none, {"x": 1.0, "y": 1.0}).collect()
    assert len(rows) == 5 and all(r.p_x == 0.5 and r.rate == 1.0 and r.copies == 1 for r in rows)
    same = M.mixed(docs, none, {"x": 1.0, "y": 1.0})
    assert same.columns == docs.columns and same.count() == 5
    assert M.mix(make([]), none, {"x": 1.0}).collect() == []
    with pytest.raises(ValueError):
        M.mix(docs, none, {})


def test_domains_are_counted_over_the_rows_that_are_there(spark, make):
    label = lambda i: "poor" if i % 3 == 0 else "good"
    labelled = spark.createDataFrame([(i, label(i)) for i in range(600)], "doc_id long, domain string")
    kept = [(i, f"plain text of {i % 7}") for i in range(600) if label(i) == "good" or i % 30 == 0]
    sizes = {d: sum(label(i) == d for i, _ in kept) for d in ("good", "poor")}
    model = M.fit_domains(make(kept), labelled, ("good", "poor"))
    assert model.weights == {}  # all texts are alike
    assert abs(model.prior[1] - math.log((sizes["poor"] + 1) / (sizes["good"] + 1))) < 0.1
    small = M.fit_domains(make(kept), labelled, ("good", "poor"), sample=100)  # ids that are missing take no place in it
    assert math.exp(small.prior[1]) < 0.2
    often = [(0, "bad words")] * 500 + [(i, "bad words" if i < 30 else "fine words") for i in range(1, 600) if label(i) == "good"]
    model = M.fit_domains(make(often), labelled, ("good", "poor"))
    assert model.weights  # the rows of a repeated id never outnumber their domain
    rows = M.mix(make(often), labelled, {"good": 1.0, "poor": 1.0}).collect()
    assert all((r.p_poor > 0.9) == (r.doc_id == 0 or r.doc_id < 30) for r in rows)


def test_a_word_of_one_domain_alone_is_taken(spark, make):
    pairs = [(i, "trash plain words" if i % 10 == 0 else "plain words") for i in range(1000)]
    labelled = spark.createDataFrame([(i, "toxic" if i % 10 == 0 else "good") for i in range(1000)], "doc_id long, domain string")
    rows = M.mix(make(pairs), labelled, {"good": 0.9, "toxic": 0.1}).collect()
    assert all((r.p_toxic > 0.5) == (r.doc_id % 10 == 0) for r in rows)
    assert M._surety(131, 449, 0, 3027) > 7 and M._surety(0, 449, 131, 3027) > 1 and M._surety(5, 50, 10, 100) < 1e-6
    assert M._surety(0, 0, 5, 10) == 0.0


# --- top-k -----------------------------------------------------------------------------------


def brute_topk(pairs, queries, k):
    """Every row is a query or candidate of its own; a query's own row is told by its place in the list."""
    use = [(i, [math.floor(1024 * x) for x in v]) for i, v in pairs if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (qi, q) in enumerate(use):
        if qi in queries:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for n, (i, v) in enumerate(use) if n != at)[:k]
            out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard", [101, 8192])
def test_topk_matches_brute_force(spark, shard):
    rng = np.random.default_rng(4)
    pairs = [(i, rng.normal(0, 0.2, 16).round(2).tolist()) for i in range(900)]
    pairs += [(2000 + i, [0.5] * 16) for i in range(40)] + [(3000, [0.0] * 16), (3001, []), (3002, [1.0, -1.0])]
    pairs += [(3003, None), (3004, [None] * 16), (3005, [float("nan")] * 16), (3006, [float("inf")] * 16), (None, [1.0] * 16), (5, pairs[5][1])]
    pairs += [(3007, [1e9] * 16), (3008, [-1e9] * 16)]
    pairs += [(100, pairs[100][1])] * 2 + [(4000, [0.9] * 16)] * 25 + [(4000, [0.1] * 16), (4001, [0.9] * 16)]  # repeats count each
    df = spark.createDataFrame([(i, v, "z", 1) for i, v in pairs], "vec_id long, embedding array<double>, vec string, shard int")
    ask = [0, 5, 100, 2000, 4000, 2039, 3000, 3001, 3002, 3003, 3006, 3007]
    got = K.exact_topk(df, df.where(F.col("vec_id").isin(ask)), shard_vectors=shard, least_shard=shard).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute_topk(pairs, set(ask), 10)


def test_topk_with_few_vectors(spark):
    df = spark.createDataFrame([(100, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in K.exact_topk(df, df.where("vec_id = 100")).collect()] == [(100, 1, 1, 2 * 1024 * 1024)]
    assert K.exact_topk(df.limit(0), df).collect() == [] and K.exact_topk(df, df.limit(0)).collect() == []


# --- packing ---------------------------------------------------------------------------------


@pytest.mark.parametrize("lengths", [(8,), (4, 8, 32), P.LENGTHS])
def test_pack_fills_bins(lengths):
    rng = np.random.default_rng(len(lengths))
    sizes = np.minimum(rng.geometric(4 / max(lengths), 3000), max(lengths))
    bins, offsets, final = P.pack(sizes, lengths)
    for b in np.unique(bins):
        of = np.flatnonzero(bins == b)
        order = of[np.argsort(offsets[of])]
        assert (offsets[order] == np.r_[0, np.cumsum(sizes[order])[:-1]]).all()
        held = sizes[of].sum()
        assert set(final[of]) == {min(c for c in lengths if c >= held)}
    used = sum(final[bins == b][0] for b in np.unique(bins))
    assert sizes.sum() / used > 0.9


def best_cost(sizes, lengths):
    """The least cost of any packing, over all ways to part the sizes."""
    best = [math.inf]

    def go(i, bins):
        if i == len(sizes):
            best[0] = min(best[0], sum(P.sequence_cost(min(c for c in lengths if c >= b)) for b in bins))
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= lengths[-1]:
                go(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1 :]])
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return best[0]


def cost_of(sizes, lengths):
    bins, _, final = P.pack(sizes, lengths)
    return sum(P.sequence_cost(int(final[bins == b][0])) for b in np.unique(bins))


def test_pack_is_near_the_optimum():
    rng, ratios = np.random.default_rng(8), []
    for _ in range(150):
        lengths = ((512, 1024, 2048, 4096), (8, 12, 32), (100, 1000))[rng.integers(3)]
        sizes = np.minimum(rng.geometric(3 / lengths[-1], rng.integers(1, 8)), lengths[-1])
        ratios.append(cost_of(sizes, lengths) / best_cost(sorted(sizes.tolist(), reverse=True), lengths))
    assert min(ratios) >= 1 - 1e-9 and np.mean(ratios) < 1.06 and max(ratios) < 1.6


def test_joint_lengths_cost_less_than_any_one_length():
    rng = np.random.default_rng(9)
    sizes = np.minimum(rng.geometric(1 / 700, 4000), 4096)
    joint = cost_of(sizes, P.LENGTHS)
    assert joint < cost_of(sizes, (4096,)) and joint >= sizes.sum()


def test_packing_by_the_encoder(spark, make):
    pairs = [(1, None), (2, ""), (3, "無空白" * 4000), (4, "x" * 30_000), (5, "word " * 3000), (None, "a b")]
    got = P.best_fit_packing(make(pairs), tokenizer=REG.tokenizer_file()).collect()
    plain = T.encoder(REG.tokenizer_file()).tokenizer
    want = sorted(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in pairs)
    rows = {}
    for r in got:
        rows[r.row_no] = rows.get(r.row_no, 0) + r.n_tokens
    assert sorted(rows.values()) == want


def test_packing_covers_every_document(spark, make):
    pairs = [(1, None), (2, ""), (3, "w " * 9000), (4, " a\tb\n"), (4, " a\tb\n"), (None, "x")] + [(10 + i, "t " * i) for i in range(300)]
    got = P.best_fit_packing(make(pairs), shard_pieces=64).collect()
    by_row, by_bin = {}, {}
    for r in got:
        by_row.setdefault(r.row_no, []).append((r.start, r.n_tokens))
        by_bin.setdefault((r.shard, r.bin, r.bin_length), []).append((r.offset, r.n_tokens))
    assert len(by_row) == len(pairs) and len({r.shard for r in got}) > 3
    want = sorted(len((t or "").split()) + 1 for _, t in pairs)
    assert sorted(sum(n for _, n in parts) for parts in by_row.values()) == want
    for parts in [*by_row.values(), *by_bin.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
    assert all(sum(n for _, n in x) <= k[2] and k[2] in P.LENGTHS for k, x in by_bin.items())
    assert P.best_fit_packing(make([])).collect() == []
    counted = spark.createDataFrame([(1, 5000), (2, None), (3, -4)], "doc_id long, n long")
    assert sorted((r.doc_id, r.n_tokens) for r in P.best_fit_packing(counted, tokens_col="n").collect()) == [(1, 904), (1, 4096), (2, 0), (3, 0)]


# --- URL filters -----------------------------------------------------------------------------


def test_urls_and_rules(spark):
    urls = [
        (1, "https://WWW.Example.com/en/x?y#z", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (2, "http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        (3, "http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
        (4, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        (5, "ftp://x.net/es/a", "x.net", "/es/a", "net/es/", "block"),
        (6, "ftp://x.net/de/a", "x.net", "/de/a", None, "block"),  # half of x.net is blocked
        (7, "http://y.net/de", "y.net", "/de", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "no scheme", "", "", None, "allow"),
        (10, "://?q", "", "", None, "allow"),
        (11, "http://com#/", "com", "", None, "allow"),
        (12, "http://ÄB.net/fr/é?", "Äb.net", "/fr/é", "net/fr/", "block"),
        (12, "http://ÄB.net/fr/é?", "Äb.net", "/fr/é", "net/fr/", "block"),
        (None, "a://b://c/d", "b:", "//c/d", None, "allow"),
    ]
    df = spark.createDataFrame([(u[0], u[1], "x", "y", 1) for u in urls], "page_id long, url string, host string, listed string, slice int")
    got = U.url_filter(df, REG.RULES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((u[0], *u[2:])) for u in urls)
    assert U.url_filter(df.limit(0), REG.RULES).collect() == []


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where(F.xxhash64("key") % 5 == 0)
    cascade = U.build_cascade(listed, universe, "key", keys_per_slice=500, bits_per_key=4, hashes=3)
    assert cascade.levels > 3 and cascade.slices > 4
    marked = cascade.mark(universe.withColumn("slice", F.lit("s")), "key", "hit")
    assert marked.where(F.col("hit") != (F.xxhash64("key") % 5 == 0)).count() == 0
    assert marked.columns == ["key", "slice", "hit"]


def test_cascade_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(U, "BROADCAST_BYTES", 0)
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where(F.xxhash64("key") % 5 == 0)
    cascade = U.build_cascade(listed, universe, "key", keys_per_slice=200)
    rows = universe.unionAll(spark.range(2000).select(F.lit("k7").alias("key"))).unionAll(spark.createDataFrame([(None,)], "key string"))
    marked = cascade.mark(rows.withColumn("salt", F.lit(1)), "key", "hit")
    assert marked.count() == 5001 and marked.columns == ["key", "salt", "hit"]
    assert marked.where(F.col("hit") != F.coalesce(F.xxhash64("key") % 5 == 0, F.lit(False)) & F.col("key").isNotNull()).count() == 0


def test_cascade_that_cannot_end_is_an_error(spark):
    """One bit's filter claims every key, so the wrongly claimed ones never get fewer."""
    universe = spark.range(40).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(RuntimeError, match="64 levels"):
        U.build_cascade(universe.where("id % 2 = 0"), universe, "key", keys_per_slice=1000, bits_per_key=1, hashes=200)


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), f"test-{name}")
        kept.append(docs)
    assert all(d.columns == columns for d in kept[:-1])
    counts = [d.count() for d in kept]
    assert 1000 > counts[0] > counts[1] >= counts[2] > 0
    model = Q.fit_quality(table(spark, SF, "documents"), table(spark, SF, "labels"))
    scored = Q.score_quality(table(spark, SF, "documents"), model)
    assert sorted(r.doc_id for r in kept[0].collect()) == sorted(r.doc_id for r in scored.where("predicted = 1").collect())
    plain = T.encoder(REG.tokenizer_file()).tokenizer
    tokens = sum(len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in kept[3].select("text").collect())
    assert kept[4].agg(F.sum("n_tokens")).first()[0] == tokens


ODD = [(1, None), (1, None), (None, "x y"), (None, "x y"), (3, ""), (4, "word " * 40_000), (5, "the same text here"), (6, "the same  text here"), (None, None)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
@pytest.mark.filterwarnings("ignore:the domains' totals")
def test_each_stage_takes_any_rows(spark, make, name):
    """Nulls in every column, repeats, empty and long texts, columns named as those that operators use inside; then no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = make(ODD)
    rows = stage(spark, docs, SF).collect()
    if name == "pack":
        assert len({r.row_no for r in rows}) == len(ODD) and {r.doc_id for r in rows} == {i for i, _ in ODD}
    else:
        assert stage(spark, docs, SF).columns == docs.columns
        assert {(r.doc_id, r.text) for r in rows} <= set(ODD)
    if name in ("exact", "near"):
        norm = ["".join((r.text or "").split()) for r in rows]
        assert len(norm) == len(set(norm)) and (name == "near" or set(norm) == {"".join((t or "").split()) for _, t in ODD})
    assert stage(spark, make([]), SF).collect() == []


def test_entry_has_every_query():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(REG.ORACLES) <= set(entry.oracle_sql())
