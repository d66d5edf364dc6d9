"""The pipeline's rows by brute force, stage by stage."""

import public_tokenizers
import sentencepiece
from test_decontaminate import sellers
from test_minhash import components

import corpus_pipeline
from tidebar.llm.decontaminate import normal
from tidebar.llm.language_id import fit, presence
from tidebar.llm.minhash import near_duplicates

SF = "/root/testdata/sf0.001"


def holds(text, item):
    """Whether a stretch of text is within a tenth of an item's length; some piece of it must fit."""
    most = int(len(item) * 0.1)
    size = len(item) // (most + 1)
    return any(item[i : i + size] in text for i in range(0, len(item) - size + 1)) and sellers(item, text, most)


def test_rows_are_those_of_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    model = fit(docs)
    marks, letters = presence([r.text for r in rows])
    _, _, like = model.predict(marks)
    rows = [r for r, ok, x in zip(rows, letters, like, strict=True) if ok and x >= 1]
    assert 0.95 * docs.count() < len(rows)
    root = components([(r.doc_id, r.text) for r in rows], 80)
    rows = [r for r in rows if root[r.doc_id] == r.doc_id]
    items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(holds(normal(r.text), p) for p in items)]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((*r, library.encode(r.text or "")) for r in rows)
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "token_ids"]
    assert sorted(map(tuple, got.collect())) == want


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stages_keep_columns_and_rows_with_nulls(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, "the and of that", None, None, None)], base.schema)
    docs = base.unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == base.columns
    assert docs.where("doc_id is null").count() == 1


def test_rows_with_null_ids_are_near_nothing(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    text = "one two three four five six seven eight nine ten"
    odd = [(None, text), (None, text), (-5, text), (-5, text), (-4, text)]
    docs = base.unionByName(spark.createDataFrame(odd, "doc_id long, text string"), allowMissingColumns=True)
    rows = near_duplicates(docs, percent=80).where("doc_id is null or doc_id < 0").collect()
    want = [(-5, -5, True)] * 2 + [(-4, -5, False)] + [(None, None, True)] * 2
    got = [(r.doc_id, r.component_id, r.kept) for r in rows]
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0)) == want
    out = corpus_pipeline.minhash_dedup(spark, docs, SF)
    ids = [r.doc_id for r in out.where("doc_id is null or doc_id < 0").collect()]
    assert sorted(ids, key=str) == [-5, None, None]
