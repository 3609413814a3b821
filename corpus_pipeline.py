"""A training corpus out of ``documents``: rules, classifier, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on, with the columns of
``documents``; the last one returns the packed pieces. ``run`` writes every stage's result to the
shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aulario.llm import fertility, importance, ngram_join, packing, suffix_dedup
from aulario.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain rules and the fertility bands."""
    judged = fertility.quality_rules(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return judged.filter("kept").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return importance.resample(docs, table(spark, sf_dir, "labels")).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by four fifths of their five-word shingles."""
    return ngram_join.one_of_each(docs, percent=80, words=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 100 bytes that start earlier; ``n_chars`` follows the text.

    Where a cut splits a character, its remaining bytes become one replacement character.
    """
    cut = suffix_dedup.remove_repeats(docs, length=100)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    values = {"text": text, "n_chars": F.length(text).cast("long")}
    return cut.select(*[values.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]

# Tokenisers, a drawn sample and packing have no SQL form. The join, the cuts and packing are tested against brute force as
# operators; of run() the tests only check columns and bounds on what is left.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
