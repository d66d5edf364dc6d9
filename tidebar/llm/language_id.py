"""Language ID by a blended-spectrum string kernel with Nystroem landmarks and ridge regression.

A text is the set of its n-grams of 1 to `ORDERS` characters, over lower-case letters with
everything else as a space, hashed to `DIMENSIONS`. The kernel of two texts is the number of
n-grams they share over the geometric mean of their own numbers. Landmark texts stand for the
kernel matrix; one ridge regression per language, against the rest, is solved in their space.
The regression only tells languages apart. Whether a text is in one at all is a question of its own,
which `likeness` answers: the likeness to that language's landmarks over the least that counts as the
language, half-way (by ratio) between texts that just are in it and texts of the other languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebar.llm.frames import appended, map_batches, place

ORDERS = 3
DIMENSIONS = 1 << 14
#: Bounds of the sample fitted on: rows of each language, and landmarks of all together.
PER_LANGUAGE = 250
LANDMARKS = 96
RIDGE = 0.1
#: Languages learned at most, those with the most labelled rows.
MOST_LANGUAGES = 200
#: A text that just is in a language has this quantile of the likeness of its labelled texts.
LEAST_QUANTILE = 0.01
NO_LANGUAGE = "und"

_WINDOW = 1 << 20
_ROWS = 128


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """For each code point the one it counts as: lower-case letters, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x33480):  # the letters of Unicode end below
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def _mark(text: str, row: np.ndarray) -> bool:
    """Set the text's n-grams in a row of zeros; whether it has a letter."""
    letters = False
    for at in range(0, len(text), _WINDOW):
        part = text[at : at + _WINDOW + ORDERS - 1].encode("utf-32-le", "replace")
        points = _folded()[np.frombuffer(part, np.uint32)]
        letters = letters or bool((points != 32).any())
        gram = np.zeros(len(points), np.uint32)
        for order in range(ORDERS):
            tail = points[order:]
            if not len(tail):
                break
            gram = gram[: len(tail)] * np.uint32(0x01000193) + (tail + np.uint32(order + 1))
            row[(gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)] = 1
    return letters


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram presence of each text as 0 and 1, and whether it has a letter."""
    rows = np.zeros((len(texts), DIMENSIONS), np.float32)
    letters = np.array([_mark(t or "", rows[i]) for i, t in enumerate(texts)], bool)
    return rows, letters


@dataclass
class Model:
    """Landmark presence as bits, the index of each one's language, weights of kernel values
    by language, and each language's least likeness."""

    languages: list[str]
    landmarks: np.ndarray
    owners: np.ndarray
    weights: np.ndarray
    least: np.ndarray

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score from 0 to 1, likeness) of each presence row."""
        marks = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        shared = kernel(rows, marks)
        values = shared @ self.weights
        best = values.argmax(1)
        at = np.arange(len(best)), best
        like = likeness(rows, marks, shared, self.owners)[at] / self.least[best]
        return best, np.clip((values[at] + 1) / 2, 0, 1), like


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None, :]
    return (a @ b.T).astype(np.float64) / size


def likeness(rows: np.ndarray, marks: np.ndarray, shared: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Mean likeness of each row to each language's landmarks; `shared` are the kernel values.

    It is the kernel value, but for a text of fewer n-grams than a landmark the share of the
    text's own n-grams, which does not fall with the text's length.
    """
    own, size = np.maximum(rows.sum(1), 1), np.maximum(marks.sum(1), 1)
    like = shared * np.sqrt(np.maximum(size[None, :] / own[:, None], 1))
    return np.stack([like[:, owners == i].mean(1) for i in range(owners.max() + 1)], axis=1)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            rows, letters = presence(part.column(2).to_pylist())
            packed = [x.tobytes() for x in np.packbits(rows.astype(bool), axis=1)]
            yield pa.record_batch(
                [part.column(0), part.column(1), pa.array(packed, pa.binary()), pa.array(letters)],
                names=["lang", "place", "bits", "letters"],
            )


def held_out(key: Column) -> Column:
    """Documents never learned from: the CRC-32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame) -> Model | None:
    """Fit on at most `PER_LANGUAGE` labelled rows of each of `MOST_LANGUAGES`, chosen by a hash of the id.

    Only rows with a non-null `lang` that are not held out count. The driver gets the number
    of rows per language and the n-gram bits of the chosen rows. None if there are no such rows.
    """
    place = F.xxhash64(F.col("doc_id").cast("string"), F.lit(7))
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = dict(counts.collect())
    if not counts:
        return None
    limit = F.lit(None).cast("double")
    for lang, n in counts.items():
        share = min(1.0, 1.5 * PER_LANGUAGE / n + 30 / n)
        limit = F.when(F.col("lang") == lang, F.lit(share)).otherwise(limit)
    chosen = known.where((place.cast("double") / 2.0**64 + 0.5) <= limit)
    rows = chosen.select("lang", place.alias("place"), "text").mapInArrow(
        _bits, "lang string, place long, bits binary, letters boolean"
    )
    by_language: dict[str, list] = {}
    for row in sorted(rows.where("letters").select("lang", "place", "bits").collect()):
        own = by_language.setdefault(row.lang, [])
        if len(own) < PER_LANGUAGE:
            own.append(np.frombuffer(row.bits, np.uint8))
    if not by_language:
        return None
    languages = sorted(by_language)
    each = max(1, LANDMARKS // len(languages))
    landmarks = np.stack([x for lang in languages for x in by_language[lang][:each]])
    owners = np.array([i for i, lang in enumerate(languages) for _ in by_language[lang][:each]])
    marks = np.unpackbits(landmarks, axis=1).astype(np.float32)
    values, vectors = np.linalg.eigh(kernel(marks, marks))
    use = values > 1e-8 * values.max()
    whiten = vectors[:, use] / np.sqrt(values[use])
    square = np.zeros((whiten.shape[1],) * 2)
    cross = np.zeros((whiten.shape[1], len(languages)))
    inside, outside = np.ones(len(languages)), [[] for _ in languages]
    total = sum(len(x) for x in by_language.values())
    for i, lang in enumerate(languages):
        own = by_language[lang]
        rows = np.unpackbits(np.stack(own), axis=1).astype(np.float32)
        shared = kernel(rows, marks)
        mapped = shared @ whiten
        # landmarks are like themselves, so they count only if there are no other rows
        rest = slice(each if len(own) > each else 0, None)
        like = likeness(rows[rest], marks, shared[rest], owners)
        inside[i] = np.quantile(like[:, i], LEAST_QUANTILE)
        for j in range(len(languages)):
            if j != i:
                outside[j].append(like[:, j])
        weight = total / (len(languages) * len(own))  # as if languages were of equal number
        target = np.where(np.arange(len(languages)) == i, 1.0, -1.0)
        square += weight * mapped.T @ mapped
        cross += weight * mapped.sum(0)[:, None] * target
    # with one language alone, half of what its own texts have
    others = [np.median(np.concatenate(x)) if x else own / 4 for x, own in zip(outside, inside, strict=True)]
    least = np.maximum(np.sqrt(inside * others), 1e-9)
    solved = np.linalg.solve(square + RIDGE * np.eye(len(square)), cross)
    return Model(languages, landmarks, owners, whiten @ solved, least)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with lang_pred, score and likeness as last columns, from the whole text alone.

    lang_pred is a learned value of `lang`, the alphabetically first of equal ones, or `und` with
    score and likeness 0 if the text is null or has no letter, or if there is no model. A
    likeness below 1 says that the text is in none of the learned languages, as far as n-grams
    tell. Columns of the three names are replaced; all others and repeated rows are kept.
    """
    names = ("lang_pred", "score", "likeness")
    types = (T.StringType(), T.DoubleType(), T.DoubleType())
    added = [T.StructField(n, t) for n, t in zip(names, types, strict=True)]
    at = place(docs, "text", names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                lang = [NO_LANGUAGE] * part.num_rows
                score = like = np.zeros(part.num_rows)
                if model:
                    rows, letters = presence(part.column(at).to_pylist())
                    best, score, like = model.predict(rows)
                    lang = [model.languages[b] if ok else NO_LANGUAGE for b, ok in zip(best, letters, strict=True)]
                    score, like = np.where(letters, score, 0.0), np.where(letters, like, 0.0)
                yield appended(part, pa.array(lang, pa.string()), pa.array(score), pa.array(like))

    return map_batches(docs, run, added)


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score, likeness. See `fit` and `predict`.

    A null doc_id is not held out. An empty table gives an empty result.
    """
    model = fit(docs)
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "likeness")
