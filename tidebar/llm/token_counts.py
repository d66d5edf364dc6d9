"""Token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebar.llm.units import SPACE, Units
from tidebar.session import materialize, scratch_dir

CACHE_SCHEMA = "digest binary, n_tokens long"
LIMIT = 4096


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def apart(model: str) -> bool:
    """Whether a text's units may be encoded one by one: no piece holds a space after another
    character, and the normaliser keeps all spaces, adding one in front."""
    library = _processor(model)
    names = (library.id_to_piece(i) for i in range(len(library)) if not library.is_control(i))
    probe = "  a  b "
    return library.normalize(probe) == f" {probe}".replace(" ", SPACE) and not any(
        SPACE in name.lstrip(SPACE) for name in names
    )


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _unit_lengths(model: str, units: list[str]) -> np.ndarray:
    """Tokens of each unit by the library, which adds the first space again; a bare one is one."""
    coded = _processor(model).encode([u[1:] for u in units], num_threads=1)
    lengths = np.fromiter(map(len, coded), np.int64, len(units))
    return np.where([len(u) == 1 for u in units], 1, lengths)


def _counter(model: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not apart(model):
            for batch in batches:
                coded = _processor(model).encode(batch.column(1).to_pylist(), num_threads=1)
                yield pa.record_batch([batch.column(0), pa.array(map(len, coded), pa.int64())], ["digest", "n_tokens"])
            return
        known: list[np.ndarray] = []
        units = Units(lambda new: known.append(_unit_lengths(model, new)), known.clear)
        for batch in batches:
            for row, each in units.slices(batch.column(1)):
                known[:] = [np.concatenate([np.empty(0, np.int64), *known])]
                totals = [int(known[0][numbers].sum()) for numbers in each]
                digests = batch.column(0).slice(row, len(each))
                yield pa.record_batch([digests, pa.array(totals, pa.int64())], ["digest", "n_tokens"])

    return count


def token_counts(docs: DataFrame, model: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit (more than `limit`).

    `model` is the path of a SentencePiece model, the same on every executor. `cache` is a
    folder that all executors reach; counts are kept there by tokenizer digest, in one table
    each, under the SHA-256 of the text with the tokenizer's own space sign as a space (the
    two encode alike). Only distinct texts that the table lacks are encoded and appended.
    Counts are the library's, without begin or end tokens; special strings inside texts are
    plain text. Words are encoded apart, each distinct one once per task, if the model allows
    it (`apart`), else texts whole. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and ids keep
    their rows; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(model)}"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    normal = F.translate(text, SPACE, " ")
    digest = F.unhex(F.sha2(normal, 256)).alias("digest")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    known = spark.read.schema(CACHE_SCHEMA).parquet(path)
    distinct = docs.select(digest, normal.alias("text")).groupBy("digest")
    distinct = distinct.agg(F.any_value("text").alias("text"))
    misses = distinct.join(known, "digest", "left_anti").mapInArrow(_counter(model), CACHE_SCHEMA)
    misses.write.mode("append").parquet(path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path)
    stored = stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    # a table, so that the join can split the rows of a text that very many documents share
    stored = materialize(stored, scratch_dir(spark, "counts"))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), digest)
    return rows.join(stored, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
