"""The training-data pipeline over ``documents``: filter, dedup and pack, one written table per stage.

Every stage works on all rows that the stage before it kept and carries their columns along, whatever
their names; rows with null texts or ids go through.  Only toxic documents and near duplicates are
dropped; a document whose lines or passages all go stays with an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import carry, packing, sketch, suffix, templates, toxicity
from strata.llm.queries import read, tokenizer_path
from strata.session import shared_table_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that score 0.7 or more for toxicity; learned from labelled documents among ``docs``."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.drop_toxic(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines whose template recurs in ten documents or more."""
    return carry.unpack(templates.drop_template_lines(docs, min_docs=10), docs, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked by five-word shingles with a similarity of 0.8 or more."""
    groups = sketch.near_duplicates(docs, k=5, num=80, den=100)
    return docs.join(groups.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without words in passages of 50 words or more that also start earlier in the corpus."""
    out = suffix.remove_repeats(docs, window=50)
    return carry.unpack(out, docs, "text", "kept_text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 2048."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_duplicates),
          ("substring_dedup", drop_passages), ("packing", pack)]

# Trained scores, connected components over sketches and tokens can't be expressed in SQL: the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_table_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
