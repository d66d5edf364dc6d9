"""The corpus pipeline: language ID, near-dedup, decontamination, tokenization.

Each stage takes (spark, docs, sf_dir), works on all of `docs` and returns a table that is
written and reread as the next one's `docs`. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebar.llm.decontaminate import without_items
from tidebar.llm.language_id import fit, predict
from tidebar.llm.minhash import near_duplicates
from tidebar.llm.pieces import encode
from tidebar.llm.queries import piece_model
from tidebar.session import materialize, scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; it learns from the labels of `docs`."""
    marked = predict(docs, fit(docs))
    return marked.where("likeness >= 1").drop("lang_pred", "score", "likeness")


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates.

    Groups are linked by 0.8 of five-word shingles or more. Of rows with equal id and text the
    least by their other columns stays; documents with a null id all stay. Texts are shuffled
    once, theirs never.
    """
    gone = near_duplicates(docs, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    known = docs.where(F.col("doc_id").isNotNull())
    # a merge join keeps the partitions by id, in which repeated rows meet as well
    kept = known.join(gone.hint("merge"), "doc_id", "left_anti")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    kept = kept.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("rest")) if rest else kept.distinct()
    kept = kept.select("doc_id", "text", *(["rest.*"] if rest else [])).select(*(f"`{c}`" for c in docs.columns))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, as `without_items` finds them."""
    return without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their SentencePiece ids as column token_ids."""
    return encode(docs, piece_model())


STAGES = [
    ("language_id", language_id),
    ("minhash_dedup", minhash_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", tokenize),
]

#: Kernels, MinHash, edit distances and pieces are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table over `documents`; the others' are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), scratch_dir(spark, name))
    return STAGES[-1][1](spark, docs, sf_dir)
