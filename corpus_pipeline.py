"""Documents to training sequences: language ID, quality, exact and near dedup, packing.

Every stage takes what its predecessor kept and returns the columns of documents,
the last one the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm.common import free_name, lacks_remainder, materialise, read_table
from ontime.llm.exact_dedup import drop_exact_copies
from ontime.llm.language import UNKNOWN, identify_language
from ontime.llm.packing import pack
from ontime.llm.quality import score_quality
from ontime.llm.queries import VOCABULARY
from ontime.llm.simhash import drop_near_copies

# A document goes if its language is unknown or less likely than this.
LEAST_LANGUAGE = 0.5
# A document goes if its text is further from its language than this: prose of a
# learned language is seldom below -0.7; random letters, code and Russian are below
# -1 with sf0.1 learned. A close relative of a learned language may pass.
LEAST_FIT = -1.0
# A document goes if quality 1 is less likely than this.
LEAST_QUALITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    predicted, score, fit = free_name(docs, "lang_pred"), free_name(docs, "lang_score"), free_name(docs, "lang_fit")
    told = identify_language(docs, lacks_remainder("doc_id", 4, 2), predicted=predicted, score=score, fit=fit)
    sure = (F.col(predicted) != UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE) & (F.col(fit) >= LEAST_FIT)
    return told.filter(sure).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = free_name(docs, "quality_score")
    labels = read_table(spark, sf_dir, "labels")
    scored = score_quality(docs, labels, lacks_remainder("doc_id", 4, 2), score=score)
    return scored.filter(F.col(score) >= LEAST_QUALITY).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, VOCABULARY)


STAGES = [
    ("language_id", language),
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("packing", packing),
]

# The learned stages and the fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
