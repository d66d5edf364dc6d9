"""Language ID: the kernel by brute force, odd texts, held-out accuracy."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebar.llm import language_id
from tidebar.llm.language_id import fit, identify, kernel, predict, presence
from tidebar.llm.queries import op7_language_id

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def grams(text):
    points = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    return {points[i : i + n] for n in (1, 2, 3) for i in range(len(points) - n + 1)}


def test_kernel_is_shared_over_mean_number():
    texts = ["Abc abd, é!", "abc", "xyz", "", "ÄÖ" * 5]
    rows, letters = presence(texts)
    sets = [grams(t) for t in texts]
    want = [[len(a & b) / max(1, len(a)) ** 0.5 / max(1, len(b)) ** 0.5 for b in sets] for a in sets]
    assert np.allclose(kernel(rows, rows), want)
    assert letters.tolist() == [True, True, True, False, True]


def test_long_texts_in_windows(monkeypatch):
    text = "The quick brown für 日本 " * 50
    whole = presence([text])[0]
    monkeypatch.setattr(language_id, "_WINDOW", 7)
    assert (presence([text])[0] == whole).all()


def test_accuracy_on_held_out_documents(spark, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = op7_language_id(spark, SF).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    asked = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in asked) >= 0.97 * len(asked)


def test_held_out_labels_are_not_learned(spark, docs):
    away = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, "zz").otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, identify(d).collect())) for d in (docs, away))
    assert a == b


def test_odd_rows(spark, docs):
    schema = "doc_id int, text string, lang string, score string, `lang.pred` int"
    rows = [(None, None, "en", "x", 1), (1, "", None, "x", 1), (2, "123 !", "en", "x", 1), (3, "the and of", "en", "x", 1)]
    df = spark.createDataFrame(rows, schema)
    model = fit(docs)
    got = predict(df, model)
    assert got.columns == ["doc_id", "text", "lang", "lang.pred", "lang_pred", "score", "likeness"]
    assert [(r.doc_id, r.lang_pred) for r in got.collect()] == [(None, "und"), (1, "und"), (2, "und"), (3, "en")]
    assert [r.lang_pred for r in predict(df, None).collect()] == ["und"] * 4
    assert identify(df.limit(0)).collect() == []
    assert fit(df.where("doc_id = 3").withColumn("lang", df.text.substr(1, 0))) is not None


def test_every_text_with_a_letter_gets_a_learned_language(spark, docs):
    rows = [(i, t) for i, t in enumerate([*UNLEARNED, "ok", "x" * 100_000, "é 1"])]
    got = predict(spark.createDataFrame(rows, "doc_id long, text string"), fit(docs)).collect()
    assert {r.lang_pred for r in got} <= set(fit(docs).languages)
    assert all(0 <= r.score <= 1 for r in got)


def test_fit_and_predict_are_the_dense_solution(spark, docs):
    """Features K_nm K_mm^-1/2 and the weighted normal equations, solved by least squares."""
    rows = docs.where("lang is not null and text is not null").where(~language_id.held_out(docs.doc_id))
    rows = rows.select("lang", F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)).alias("place"), "text")
    by = {}
    for lang, _, text in sorted(map(tuple, rows.collect())):
        if any(c.isalpha() for c in text):
            by.setdefault(lang, []).append(text)
    by = {k: v[: language_id.PER_LANGUAGE] for k, v in by.items()}
    languages = sorted(by)
    each = language_id.LANDMARKS // len(languages)
    marks = presence([t for k in languages for t in by[k][:each]])[0]
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    use = values > 1e-8 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])
    x = np.concatenate([kernel(presence(by[k])[0], marks) @ root for k in languages])
    owner = np.concatenate([np.full(len(by[k]), i) for i, k in enumerate(languages)])
    y = np.where(owner[:, None] == np.arange(len(languages)), 1.0, -1.0)
    size = np.bincount(owner)
    w = np.sqrt(len(owner) / (len(languages) * size))[owner][:, None]
    ridge = np.sqrt(language_id.RIDGE) * np.eye(x.shape[1])
    beta = np.linalg.lstsq(np.vstack([w * x, ridge]), np.vstack([w * y, np.zeros((len(ridge), y.shape[1]))]))[0]
    model = fit(docs)
    assert model.languages == languages
    asked = [r.text for r in docs.where("text is not null").limit(200).collect()] + UNLEARNED
    want = kernel(presence(asked)[0], marks) @ root @ beta
    best, score, _ = model.predict(presence(asked)[0])
    close = np.sort(want, 1)[:, -1] - np.sort(want, 1)[:, -2] < 1e-6
    assert ((best == want.argmax(1)) | close).all()
    assert np.allclose(score, np.clip((want.max(1) + 1) / 2, 0, 1), atol=1e-6)


UNLEARNED = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا",
    "xkcdq wrtzp bnmvk qwrtp lkjhg fdszx " * 4,
]


def test_unlearned_languages_go_and_held_out_documents_stay(spark, docs):
    import corpus_pipeline

    rows = [(-1 - i, t) for i, t in enumerate(UNLEARNED)] + [(-100 - i, t * 400) for i, t in enumerate(UNLEARNED)]
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    both = docs.unionByName(odd, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, both, SF).select("doc_id").collect()}
    assert not [i for i in kept if i < 0]
    held = {r.doc_id for r in docs.where(language_id.held_out(docs.doc_id) & docs.lang.isNotNull()).collect()}
    assert held and held <= kept
