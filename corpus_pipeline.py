"""A corpus pipeline of five stages; each calls one operator of ``locusdeck.llm``.

A stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``: toxic documents
go, recurring lines go, one document of each group of near copies stays, documents that hold
benchmark items go. The last gives the token digests of what is left. Stages are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusdeck.llm import pieces, seeds, simhash, templates, toxicity
from locusdeck.llm.queries import model_file
from locusdeck.llm.shared import read, remainder
from locusdeck.session import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model learns from labels of two thirds of the ids."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    scored = toxicity.scored(named, model, ("row",))
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.without_recurring(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return seeds.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, model_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: SQL has neither the toxicity model nor the tokenizer. Tests hold templates, groups of near copies, overlaps and ids
#: against brute force, and run every stage over odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
