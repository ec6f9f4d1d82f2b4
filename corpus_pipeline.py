"""A training corpus from the table documents: five stages, each by one operator of ``tideline.llm``.

1. quality: documents that the quality classifier rejects go.
2. exact: one row of every group of equal texts stays.
3. near: one document of every SimHash component stays.
4. mix: documents are taken as often as their rates say, so that expected domain totals match the targets.
5. pack: the texts are cut and packed into sequences of the permitted lengths.

Stages take the documents that the one before kept, with all their columns; the last returns a row
for each packed piece. Null texts count as empty; rows with a null doc_id are documents too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.common import ship, staged, table, text_of
from tideline.llm.exact_dedup import keep_first
from tideline.llm.mixing import mixed
from tideline.llm.packing import best_fit_packing
from tideline.llm.quality import fit_quality, quality_score
from tideline.llm.queries import domain_labels, tokenizer_file
from tideline.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The least quality score of a document that stays.
THRESHOLD = 0.7
#: Shares of tokens after mixing; few poor documents are left by then, and toxic ones are to be rare.
TARGETS = {"good": 0.97, "poor": 0.01, "toxic": 0.02}


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text scores at least ``THRESHOLD``; a null text scores as the empty one, repeated rows each, none of none."""
    ship(spark)
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_score(model, text_of()) >= THRESHOLD)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (null and blank ones are a group); rows without id stay if no other has the text."""
    ship(spark)
    return keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, that of the least id; null and empty texts have fingerprint zero and link like any other."""
    ship(spark)
    return keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as their rates say; null and empty texts count as one token, labels of ids that are not there count nowhere."""
    return mixed(docs, domain_labels(spark, sf_dir), TARGETS)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences; a null or empty text is its end token, each repeated row is packed."""
    ship(spark)
    return best_fit_packing(docs, tokenizer=tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("mix", mix_stage),
    ("pack", pack_stage),
]

#: None of the stages but the second can be said in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
