"""A cleaning pipeline over ``documents`` made of the operators in ``staykit.llm``.

Each stage is ``(name, function)``; a function takes the session, the documents
that the stage before kept and the folder of the tables, and returns the
documents it keeps.  Every stage's result is written as Parquet in the shared
scratch folder and read again, so a stage never recomputes the one before and a
lost executor costs part of one stage only.

1. quality rules: documents that the rules reject go;
2. n-gram Jaccard join: one document of each class stays, that with the least id;
3. personal data: spans in texts are replaced by their kind, n_chars follows;
4. mixing: documents are repeated or dropped towards the sources' target weights;
5. piece encoding: per document its ids and, decoded from them, its text.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staykit.llm import mixing, ngram_join, pii, piece_bpe, quality_rules
from staykit.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_documents(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixture),
    ("piece_bpe", encoding),
]

# Learned rules, a trained tagger and a tokenizer can't be said in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
