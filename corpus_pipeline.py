"""Corpus preparation: rules, classifier, line dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of documents; the last returns the
pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ospara.llm import lines, minhash, packing, quality, rules
from ospara.llm.graph import written
from ospara.plans.base import Tables

#: The stages hold a learned model and estimates over the corpus, which SQL
#: cannot express; tests compare them with plain versions.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return rules.accepted(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the model learns from labels of kept documents."""
    return quality.good_documents(docs, quality.train(docs, Tables(spark, sf_dir).labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; documents of which nothing is left go."""
    left = lines.without_repeats(docs)
    empty = (F.col("_n_removed") > 0) & (F.col("_n_removed") >= F.col("_n_lines"))
    return left.filter(~empty).drop("_n_lines", "_n_removed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of one document each, of power-of-two lengths."""
    return packing.piece_digests(packing.pack_pieces(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return docs
