"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on
all rows that the stage before it kept. All but the last return the columns
of ``documents``. ``run`` writes every stage's result under the shared
folder and reads it again as the next one's input; what a stage wrote on its
way goes once its result is there.

Empty tables give empty results in every stage; null texts count as empty;
further columns, whatever their names, are carried along untouched up to
the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup as exact
from tidemark.llm import packing, quality, simhash, substrings
from tidemark.llm.common import free_name, intermediates, store, table
from tidemark.llm.queries import WORD_BPE, vocabulary

#: SQL cannot express the classifier, so there is no statement for the whole
ORACLE_SQL = None
LEAST_QUALITY = 0.3
#: bytes of a string whose repeats go in ``suffix_array_dedup``: less than 51 short words take, so that
#: passages of over 50 words are found wherever they begin. (op2's own 400 bytes are its contract's.)
PASSAGE_BYTES = 240


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at least ``LEAST_QUALITY``; labels learnt as in op10."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id")))
    score = free_name(docs, "_score")
    scored = quality.quality_scores(docs, quality.train(docs, labels), carry=True, added=score)
    return scored.filter(F.col(score) >= LEAST_QUALITY).select(*_columns(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for A-Z/a-z, the row of largest doc_id."""
    kept = free_name(docs, "_kept")
    return exact.exact_dedup(docs, keep="largest", carry=True, added=kept).filter(kept).select(*_columns(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of fingerprints within 3 bits, the row of smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the bytes in strings of ``PASSAGE_BYTES`` that occur
    elsewhere; n_chars follows the text."""
    cut = substrings.remove_repeats(docs, length=PASSAGE_BYTES, carry=True, added=free_name(docs, "_removed"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 2048 ids, as op5."""
    return packing.pack(docs, vocabulary(WORD_BPE))


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with intermediates(spark):
            docs = store(stage(spark, docs, sf_dir), name, keep=True)
    return docs
