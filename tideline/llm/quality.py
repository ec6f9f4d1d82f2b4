"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Each text becomes a short vector of document statistics. Random Fourier features of the standardised
vector approximate a Gaussian kernel; the normal equations of a ridge regression on them are summed
over partitions; a pool-adjacent-violators fit on rows that the ridge has not seen turns its scores
into probabilities. The fit reads a bounded sample of labelled rows; every document is scored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import col, staged, text_of

#: The statistics, in the order of the vector.
STATS = (
    "log_words", "log_chars", "mean_word", "long_words", "distinct", "top_word", "repeats", "line_repeats",
    "capitals", "all_capitals", "digits", "other_signs", "sign_words", "bare_signs", "doubled_signs", "sentence_ends",
)
_HEX = "0123456789"


def statistics(text: str) -> list[float]:
    """The vector of one whole text; an empty text has zeros."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(STATS)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    alpha = [w for w in counts if w.isalpha()]
    n_alpha = sum(counts[w] for w in alpha)
    upper_words = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    tails = [(w[-1:], w[-2:-1], c) for w, c in counts.items()]
    sign_ends = sum(c for a, _, c in tails if not a.isalnum() and a not in ".,")
    doubled = sum(c for a, b, c in tails if a == b and not a.isalnum())
    bare = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    ends = sum(c for a, _, c in tails if a in ".?")
    capitals = sum(c for w, c in counts.items() if w[0].isupper())
    digits = sum(c for w, c in counts.items() if any(x in _HEX for x in w))
    same = sum(map(str.__eq__, words, words[1:]))
    return [
        math.log1p(n),
        math.log1p(chars),
        letters / n,
        sum(c for w, c in counts.items() if len(w) > 14) / n,
        len(counts) / n,
        max(counts.values()) / n,
        same / n,
        1 - len(set(lines)) / len(lines),
        capitals / n,
        upper_words / n,
        digits / n,
        1 - n_alpha / n,
        sign_ends / n,
        bare / n,
        doubled / n,
        ends / n,
    ]


@dataclass(frozen=True)
class QualityModel:
    """What scoring needs: a few hundred kB at most, whatever the input's size."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the Fourier features: STATS x features
    phases: np.ndarray
    ridge: np.ndarray
    knots: np.ndarray  # of the isotonic curve: raw score and probability
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = (stats - self.mean) / self.scale
        z = np.cos(np.clip(x, -8, 8) @ self.weights + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([np.ones((len(z), 1)), z])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.ridge

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted x; knots at the blocks' mean x, so the curve is continuous."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x.tolist(), y.tolist(), w.tolist(), strict=True):
        blocks.append([xi * wi, yi * wi, wi])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def _stats_col(text: Column) -> Column:
    @pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: statistics(t or ""))

    return of(text)


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may read; a null id is not held out and has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _sums(model: QualityModel):
    """Arrow mapper: the partition's part of the normal equations, one row per cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                stats = np.array(batch.column(0).to_pylist(), float)
                z = model.features(stats)
                part = z.T @ np.hstack([z, np.array(batch.column(1).to_pylist(), float)[:, None]])
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel().astype("int32")), pa.array(j.ravel().astype("int32")), pa.array(total.ravel())],
                names=["i", "j", "v"],
            )

    return run


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = 24_000,
    features: int = 160,
    width: float = 3.0,
    penalty: float = 1e-3,
    partitions: int = 12,
    bins: int = 400,
    seed: int = 7,
) -> QualityModel:
    """Fit on at most ``sample`` labelled rows: those with the least hash of their id.

    Rows whose crc32(doc_id as text) mod 4 is 2 are never read; of the others, remainder 3
    calibrates and the rest fits. Null labels and ids are left out; of several labels of an id the
    largest counts. Without labels of both kinds every document scores the share of label 1 (1.0
    without any label).
    """
    ids = labels.select(col(id_col).alias("doc_id"), col(label_col).cast("int").alias("y")).dropna()
    ids = ids.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("y").alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded: ids and labels only
    few = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = (
        few.join(F.broadcast(ids), "doc_id")
        .select(_stats_col(F.col("text")).alias("stats"), F.col("y").cast("double").alias("y"),
                (F.crc32(F.col("doc_id").cast("string")) % 4 == 3).alias("cal"), "doc_id")
    )
    rows = staged(rows, "quality-sample")
    d = len(STATS)
    aggs = [f(F.col("stats")[i]).alias(f"{n}{i}") for i in range(d) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"), *aggs).first()
    rng = np.random.default_rng(seed)
    mean = np.array([first[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([first[f"s{i}"] or 0.0 for i in range(d)])
    model = QualityModel(
        mean,
        np.where(scale > 1e-9, scale, 1.0),
        rng.standard_normal((d, features)) / width,
        rng.uniform(0, 2 * math.pi, features),
        np.zeros(features + 1),
        np.array([0.0]),
        np.array([1.0 if not first["n"] else first["y"]]),
    )
    if not first["n"] or first["y"] in (0.0, 1.0):
        return model
    cells = (
        rows.where("not cal")
        .select("stats", "y", "doc_id")
        .repartition(partitions, "doc_id")
        .select("stats", "y")
        .mapInArrow(_sums(model), "i int, j int, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
    )
    normal = np.zeros((features + 1, features + 2))
    got = cells.toPandas()  # (features + 1) x (features + 2) numbers
    if not len(got):
        return model
    normal[got["i"], got["j"]] = got["v"]
    gram, right = normal[:, :-1], normal[:, -1]
    ridge = np.linalg.solve(gram + penalty * gram[0, 0] * np.diag(np.r_[0.0, np.ones(features)]) + 1e-9 * np.eye(features + 1), right)
    model = QualityModel(**{**model.__dict__, "ridge": ridge})

    raw = _apply(model, "raw", "stats")
    scored = rows.where("cal").select(raw(F.col("stats")).alias("r"), "y")
    slot = F.floor(F.least(F.greatest(F.col("r"), F.lit(-0.5)), F.lit(1.5)) * (bins / 2))
    got = scored.groupBy(slot.alias("b")).agg(F.avg("r").alias("x"), F.avg("y").alias("y"), F.count("y").alias("w"))
    got = got.toPandas().sort_values("x")  # at most ``bins`` rows
    if len(got):
        knots, levels = isotonic(got["x"].to_numpy(), got["y"].to_numpy(), got["w"].to_numpy(float))
        model = QualityModel(**{**model.__dict__, "knots": knots, "levels": levels})
    return model


def _apply(model: QualityModel, how: str, over: str):
    @pandas_udf("double")
    def of(values: pd.Series) -> pd.Series:
        if over == "text":
            values = [statistics(t or "") for t in values]
        stats = np.array(list(values), float).reshape(-1, len(STATS))
        return pd.Series(getattr(model, how)(stats), dtype="float64")

    return of


def quality_score(model: QualityModel, text: Column) -> Column:
    """The score of a text column, 0 to 1; null counts as empty."""
    return _apply(model, "score", "text")(text)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Repeated rows score alike."""
    return docs.select(
        col(id_col).alias("doc_id"),
        held_out(col(id_col)).alias("held_out"),
        quality_score(model, text_of(text_col)).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= threshold, F.lit(1)).otherwise(F.lit(0)))
