"""Soft-membership mixing of documents to target weights.

A naive Bayes classifier, fitted on a bounded sample of the labelled table, gives every document odds of the
domains; a logistic fit on rows that it was not fitted on (cross-fitting over folds of the sample) turns them into calibrated posteriors. Each document gets a rate r >= 0: how often it is to be seen. The expected tokens of domain k are the sum over
documents of r * tokens * posterior(k). Projected-gradient least squares brings these totals to the targets: each round
one distributed sum gives the domain residuals, and every rate moves against its gradient and is cut off at zero. Only
DataFrame functions are used; the driver sees numbers per domain alone.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, fresh, once, staged, text_of

#: Domains of the labelled table and the share of all tokens that each is to have.
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}
#: What separates words, which count in lower case.
BREAKS = "[ \t\n\x0b\x0c\r.,;:!?()\"]+"
SHARES = 10  # steps of a feature that is a share
FOLDS = 4  # of the sample, for calibration


def domain_label(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor")


def _features(text: Column, buckets: int) -> Column:
    """Struct of n (words of the text; the empty text has one) and slots (features, from 1).

    Slots are the hashed distinct words, one for the share of distinct words and one for the share of signs that
    are neither letters, digits, blanks nor full stops and commas.
    """
    signs = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s.,]+", "")) / (F.length(text) + 1)

    def of(words: Column) -> Column:
        own = F.array_distinct(words)
        varied = F.floor(F.size(own) / F.size(words) * (SHARES - 1))
        # by powers of two, from 1 in 512
        odd = F.least(F.floor(F.log2(signs * 512 + 1)), F.lit(SHARES - 1))
        extra = F.array(varied + (buckets + 1), odd + (buckets + SHARES + 1))
        hashed = F.transform(own, lambda w: (F.pmod(F.hash(w), F.lit(buckets)) + 1).cast("long"))
        return F.struct(F.size(words).cast("long").alias("n"), F.concat(hashed, extra).alias("slots"))

    return F.transform(F.array(F.split(F.lower(text), BREAKS)), of)[0]


@dataclass(frozen=True)
class DomainModel:
    """Log odds of each domain against the first for the few features that tell them apart."""

    domains: tuple[str, ...]
    prior: tuple[float, ...]
    weights: dict[int, tuple[float, ...]]  # by slot, for the domains after the first
    buckets: int

    def calibrated(self, scale: list[float], shift: list[float]) -> DomainModel:
        """The model with every domain's odds d turned into scale * d + shift (for the domains after the first)."""
        prior = (self.prior[0], *(a * p + b for a, b, p in zip(scale, shift, self.prior[1:], strict=True)))
        weights = {s: tuple(a * x for a, x in zip(scale, w, strict=True)) for s, w in self.weights.items()}
        return DomainModel(self.domains, prior, weights, self.buckets)

    def scored(self, text: Column, raw: bool = False) -> Column:
        """Struct of n (words of the text) and p (posteriors in the order of ``domains``, of sum 1; ``raw``: their log odds)."""
        after = range(1, len(self.domains))
        zero = F.struct(*[F.lit(self.prior[i]).alias(f"d{i}") for i in after], F.lit(0.0).alias("d0"))
        known = F.array(*[F.lit(s).cast("long") for s in self.weights]) if self.weights else F.array().cast("array<long>")
        tables = [
            F.create_map(*[x for s, w in self.weights.items() for x in (F.lit(s).cast("long"), F.lit(w[i - 1]))]) for i in after
        ]

        def step(acc: Column, s: Column) -> Column:
            moved = [(acc[f"d{i}"] + tables[i - 1][s]).alias(f"d{i}") for i in after]
            return F.struct(*moved, acc["d0"].alias("d0"))

        def odds(acc: Column) -> Column:
            if raw:
                return F.array(*[acc[f"d{i}"] for i in range(len(self.domains))])
            return F.array(*[F.exp(F.least(F.greatest(acc[f"d{i}"], F.lit(-50.0)), F.lit(50.0))) for i in range(len(self.domains))])

        def share(f: Column) -> Column:
            def scaled(o: Column) -> Column:
                total = F.aggregate(o, F.lit(0.0), lambda x, y: x + y)
                return F.transform(o, lambda x: x / total)

            told = F.aggregate(F.array_intersect(f["slots"], known), zero, step, odds) if self.weights else odds(zero)
            p = told if raw else F.transform(F.array(told), scaled)[0]
            return F.struct(f["n"].alias("n"), p.alias("p"))

        return F.transform(F.array(_features(text, self.buckets)), share)[0]


def _surety(x: int, n: int, y: int, m: int) -> float:
    """Root of the likelihood ratio G2 for a feature that x of n rows have in one domain and y of m in the other."""
    cells = [(x, n, x + y), (n - x, n, n + m - x - y), (y, m, x + y), (m - y, m, n + m - x - y)]
    return math.sqrt(max(0.0, 2 * sum(o * math.log(o * (n + m) / (a * b)) for o, a, b in cells if o)))


def _bayes(
    domains: tuple[str, ...], size: list[int], number: dict[int, list[int]], buckets: int, least_z: float, most: int
) -> DomainModel:
    """Naive Bayes from the rows of each domain and, by feature, how many of them have it."""
    prior = [math.log((n + 1) / (sum(size) + len(domains))) for n in size]
    weights: dict[int, list[float]] = {}
    for i in range(1, len(domains)):
        n, none, found = size[i], 0.0, []
        for s, has in number.items():
            z = _surety(has[i], n, has[0], size[0])
            if z >= least_z:
                found.append((-z, s, (has[i] + 0.5) / (n + 1), (has[0] + 0.5) / (size[0] + 1)))
        for _, s, p, q in sorted(found)[:most]:
            without = math.log((1 - p) / (1 - q))  # what a text tells that has not the feature
            weights.setdefault(s, [0.0] * (len(domains) - 1))[i - 1] = math.log(p / q) - without
            none += without
        prior[i] += none
    return DomainModel(domains, tuple(p - prior[0] for p in prior), {s: tuple(w) for s, w in weights.items()}, buckets)


def _calibration(rows: list[tuple[int, float, list[float]]], k: int, rounds: int = 50) -> tuple[list[float], list[float]]:
    """Scale and shift of the domains' odds by Newton steps of a logistic fit to ``rows`` (domain, weight, odds after the first domain).

    A weak pull to scale 1 and shift 0, of the weight of one row, decides where rows are missing.
    """
    m = k - 1
    at = [1.0] * m + [0.0] * m
    total = sum(w for _, w, _ in rows)
    rows = [(d, w * len(rows) / total, x) for d, w, x in rows] if total else []

    def loss(at: list[float]) -> float:
        out = sum((a - 1) ** 2 for a in at[:m]) / 2 + sum(b * b for b in at[m:]) / 2
        for d, w, x in rows:
            z = [0.0, *(at[i] * x[i] + at[m + i] for i in range(m))]
            top = max(z)
            out += w * (top + math.log(sum(math.exp(v - top) for v in z)) - z[d])
        return out

    now = loss(at)
    for _ in range(rounds):
        slope = [a - 1 for a in at[:m]] + at[m:]
        curve = [[float(i == j) for j in range(2 * m)] for i in range(2 * m)]
        for d, w, x in rows:
            z = [0.0, *(at[i] * x[i] + at[m + i] for i in range(m))]
            top = max(z)
            e = [math.exp(v - top) for v in z]
            p = [v / sum(e) for v in e[1:]]
            for i in range(m):
                off = w * (p[i] - (d == i + 1))
                slope[i] += off * x[i]
                slope[m + i] += off
                for j in range(m):
                    c = w * p[i] * ((i == j) - p[j])
                    curve[i][j] += c * x[i] * x[j]
                    curve[i][m + j] += c * x[i]
                    curve[m + i][j] += c * x[j]
                    curve[m + i][m + j] += c
        step, size = _solve(curve, slope), 1.0
        while size > 1e-6 and loss([a - size * t for a, t in zip(at, step, strict=True)]) > now:
            size /= 2
        at = [a - size * t for a, t in zip(at, step, strict=True)]
        before, now = now, loss(at)
        if before - now < 1e-7 * max(1.0, now):
            break
    return at[:m], at[m:]


def fit_domains(
    docs: DataFrame,
    labelled: DataFrame,
    domains: tuple[str, ...],
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    sample: int = 8_000,
    buckets: int = 1 << 16,
    least_z: float = 4.0,
    most: int = 128,
) -> DomainModel:
    """Naive Bayes (features present or absent) on the rows of at most ``sample`` labelled ids that ``docs`` has, those of least hash, calibrated.

    Labels of ids that ``docs`` lacks count nowhere; an id's rows each count, for features as for the size of its domain.

    Features count whose likelihood ratio G2 is at least the square of ``least_z``, whether both domains have them or one only: the
    ``most`` surest of a domain. As words are not independent the odds are too sure of themselves; so every row of the sample is scored by a
    model fitted on the other folds (``FOLDS``, by a hash of the id), and scale and shift of each domain's odds are fitted to these scores by
    logistic regression, weighed by words: the sum of the posteriors over the words of a domain's rows is then the domain's share. Null ids
    and unknown domains are left out; of several labels of an id the least name counts. A domain without rows keeps smoothed odds, and without
    any label all documents have the same posteriors.
    """
    ids = labelled.select(col(id_col).alias("doc_id"), col(domain_col).alias("domain")).dropna()
    ids = ids.where(F.col("domain").isin(*domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    # rows of an id are counted before they meet its label, so that one with many rows does not make a large join group
    seen = docs.select(col(id_col).alias("doc_id")).dropna().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    ids = seen.join(ids, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    ids = ids.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    ids = staged(ids, "mix-sample")  # bounded: ids, names and numbers only
    place = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")).cast("int") - 1
    cell = F.col("fold") * len(domains) + place
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text")).join(F.broadcast(ids.drop("n")), "doc_id")
    rows = staged(rows.select(cell.alias("cell"), "fold", place.alias("place"), "text"), "mix-labelled")
    cells = range(FOLDS * len(domains))
    slots = rows.select("cell", F.explode(F.array_distinct(_features(F.col("text"), buckets)["slots"])).alias("s"))
    counted = slots.groupBy("s").agg(*[F.count_if(F.col("cell") == c).alias(f"n{c}") for c in cells], F.count(F.lit(1)).alias("n"))
    number = {r["s"]: [r[f"n{c}"] for c in cells] for r in counted.where("n >= 4").collect()}  # a row per feature, of which there are few
    of = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def model(without: int | None) -> DomainModel:
        folds = [f for f in range(FOLDS) if f != without]
        pick = lambda of_cell: [sum(of_cell(f * len(domains) + d) for f in folds) for d in range(len(domains))]
        return _bayes(tuple(domains), pick(lambda c: of.get(c, 0)), {s: pick(lambda c, h=has: h[c]) for s, has in number.items()}, buckets, least_z, most)

    raw = F.when(F.lit(False), model(0).scored(F.col("text"), raw=True))
    for f in range(FOLDS):
        raw = raw.when(F.col("fold") == f, model(f).scored(F.col("text"), raw=True))
    told = rows.select("place", once(raw, "m")).groupBy("place", "m").agg(F.count(F.lit(1)).alias("times"))
    held_out = [(r["place"], float(r["m"]["n"] * r["times"]), list(r["m"]["p"][1:])) for r in told.collect()]  # of the bounded sample
    # a domain whose rows are all in one fold was never seen by the model that scored them: its odds stay as they are
    seen_in = [sum(bool(of.get(f * len(domains) + d)) for f in range(FOLDS)) for d in range(len(domains))]
    scale, shift = _calibration([r for r in held_out if seen_in[r[0]] > 1], len(domains))
    told_of = [n > 1 and seen_in[0] > 1 for n in seen_in[1:]]
    return model(None).calibrated(
        [a if ok else 1.0 for a, ok in zip(scale, told_of, strict=True)], [b if ok else 0.0 for b, ok in zip(shift, told_of, strict=True)]
    )


def _solve(gram: list[list[float]], right: list[float]) -> list[float]:
    """Gauss elimination for a few domains; directions without weight get zero."""
    n = len(right)
    m = [[*row, b] for row, b in zip(gram, right, strict=True)]
    scale = max((abs(x) for row in gram for x in row), default=0.0) or 1.0
    for i in range(n):
        m[i][i] += 1e-9 * scale
    for i in range(n):
        p = max(range(i, n), key=lambda r: abs(m[r][i]))
        m[i], m[p] = m[p], m[i]
        for r in range(n):
            if r != i and m[i][i]:
                f = m[r][i] / m[i][i]
                m[r] = [a - f * b for a, b in zip(m[r], m[i], strict=True)]
    return [m[i][n] / m[i][i] if m[i][i] else 0.0 for i in range(n)]


def fit_rates(
    members: DataFrame, targets: list[float], rounds: int = 25, tolerance: float = 1e-6, report: float = 1e-3
) -> list[list[float]]:
    """The steps of the projected gradient for ``members`` (n tokens, p posteriors).

    Least squares of the domain totals: every round moves the rates against the gradient and cuts them at zero. A step is
    first tried in the metric of the documents that it can move (their Gram matrix), so that few rounds are needed whatever the domains'
    sizes, then a quarter of it if the totals do not come nearer to their targets; failing that, a plain gradient step is taken,
    short enough to come nearer always, if slowly: targets far from what the documents hold are approached, not always reached. Every trial is one distributed sum of numbers per domain. A document's rate is found by :func:`rate_of` from the
    steps and its own posteriors. Ends when the totals are within ``tolerance`` of their targets (relative to all tokens), when no step comes
    nearer by a thousandth, or after ``rounds`` rounds; if the totals are then off by more than ``report`` of all tokens, which is so where no
    rates meet the targets, a warning tells by how much.
    """
    k = len(targets)
    p = [F.col("p")[i] for i in range(k)]
    n = F.col("n").cast("double")
    cells = [(i, j) for i in range(k) for j in range(i + 1)]

    def totals(steps: list[list[float]]) -> list[float]:
        rate = rate_of(F.col("p"), steps)
        return [x or 0.0 for x in members.agg(F.sum(n), *[F.sum(rate * n * x) for x in p]).first()]

    def metric(steps: list[list[float]], gap: list[float]) -> list[list[float]]:
        """The Gram matrix of the documents with a rate over zero or a gradient that raises it."""
        slope = sum((x * F.lit(g) for x, g in zip(p, gap, strict=True)), F.lit(0.0))
        live = n * F.when((rate_of(F.col("p"), steps) > 0) | (slope < 0), 1.0).otherwise(0.0)
        now = members.agg(*[F.sum(live * p[i] * p[j]).alias(f"g{i}_{j}") for i, j in cells]).first()
        return [[now[f"g{max(i, j)}_{min(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]

    everything, *now = totals([])
    if not everything:
        return []
    goal = [t / sum(targets) * everything for t in targets]
    away = lambda now: math.sqrt(sum((t - g) ** 2 for t, g in zip(now, goal, strict=True))) / everything
    steps: list[list[float]] = []
    off = away(now)
    longest = max(map(sum, metric([], [0.0] * k)))  # a bound on the curvature over all documents, whose rates start at 1
    for _ in range(rounds):
        if off <= tolerance:
            break
        gap = [t - g for t, g in zip(now, goal, strict=True)]
        whole = _solve(metric(steps, gap), gap)
        trials = [(whole, 0.02), ([0.25 * x for x in whole], 0.02), ([g / longest for g in gap], 1e-3)]
        for step, gain in trials:
            _, *then = totals([*steps, step])
            if away(then) < off * (1 - gain):
                steps, now, off = [*steps, step], then, away(then)
                break
        else:
            break
    if off > report:
        warnings.warn(f"the domains' totals differ from their targets by {off:.3%} of all tokens", stacklevel=2)
    return steps


def rate_of(posteriors: Column, steps: list[list[float]]) -> Column:
    """The rate after all steps: from 1, each step is followed by the cut at zero."""
    rate = F.lit(1.0)
    for step in steps:
        move = F.lit(0.0)
        for i, s in enumerate(step):
            move = move + posteriors[i] * F.lit(s)
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate


def copies_of(rate: Column, doc_id: Column) -> Column:
    """How often a document is taken: the rate's whole part, and once more with its fraction as chance (by a hash)."""
    rate = F.round(rate, 9)  # sums differ in their last digits from run to run
    chance = F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def _members(docs: DataFrame, model: DomainModel, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(col(id_col).alias("doc_id"), model.scored(text_of(text_col)).alias("m"))
    return staged(rows.select("doc_id", F.col("m.n").alias("n"), F.col("m.p").alias("p")), "mix-members")


def _checked(targets: dict[str, float]) -> tuple[str, ...]:
    if not targets or min(targets.values()) < 0 or not sum(targets.values()):
        raise ValueError("targets need weights that are not negative")
    return tuple(targets)


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    sample: int = 8_000,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, a posterior column p_<domain> for each, rate, copies.

    ``targets`` maps domains to weights (not negative; they are scaled to sum to 1). Tokens are a text's words, 1 for
    an empty or null text. Repeated rows have equal rates. An empty table gives an empty result.
    """
    domains = _checked(targets)
    model = fit_domains(docs, labelled, domains, id_col, text_col, domain_col, sample)
    members = _members(docs, model, id_col, text_col)
    rate = rate_of(F.col("p"), fit_rates(members, [float(targets[d]) for d in domains]))
    return members.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)],
        rate.alias("rate"),
    ).withColumn("copies", copies_of(F.col("rate"), F.col("doc_id")))


def mixed(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    sample: int = 8_000,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as :func:`mix` says (``copies``; 0: not at all)."""
    domains = _checked(targets)
    model = fit_domains(docs, labelled, domains, id_col, text_col, domain_col, sample)
    steps = fit_rates(_members(docs, model, id_col, text_col), [float(targets[d]) for d in domains])
    member, copies, copy = fresh(docs, "member", "copies", "copy")
    rows = docs.select("*", once(model.scored(text_of(text_col)), member))
    rows = rows.select("*", once(copies_of(rate_of(rows[member]["p"], steps), col(id_col)), copies))
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(1), col(copies)))).drop(member, copies, copy)
