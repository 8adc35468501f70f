"""Language identification with string kernels.

The kernel of two texts is the blended-spectrum presence kernel: the number of
distinct letter n-grams, n = 1 to `LONGEST`, that both hold, over the geometric
mean of the numbers each holds.  Training texts of each language serve as
Nystroem landmarks: with K the kernel matrix of the landmarks, a text has the
features k(text, landmarks) K^(-1/2), on which one-versus-rest ridge regression
is fitted.  Scoring is batched matrix products: a block of texts as 0/1 rows
over the landmarks' n-grams, times the landmarks' 0/1 columns, times the
regression.

The classifier is fitted on a bounded sample of labelled rows: at most
`PER_LANGUAGE` texts of each language and `TRAINING_TEXTS` in all, those with the
lowest hashes of their ids, the first `LANDMARKS` of a language and
`LANDMARK_TEXTS` in all as landmarks.  Every language that has a labelled text is
learned: many languages have fewer texts and landmarks each, but one at least.  Whole texts are used for fitting and
scoring; a text is read once and nothing is shuffled.

Texts that are null or have no letter are ``und`` with score 0, and so is every
text if no labelled row has a letter.  Ties go to the language that sorts first.
Repeated rows score alike; extra columns are ignored; an empty table gives no
rows.
"""
from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.storage import settle

LONGEST = 3
PER_LANGUAGE = 200
TRAINING_TEXTS = 4_000
LANDMARKS = 32
LANDMARK_TEXTS = 1_024
RIDGE = 1e-3
UNDETERMINED = "und"
_BLOCK = 64  # texts of a matrix product


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    grams: np.ndarray  # sorted n-grams of the landmarks
    columns: np.ndarray  # n-gram x landmark, 0 or 1
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmark x language


@cache
def _letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_set(text: str | None) -> np.ndarray:
    """Sorted distinct n-grams of the lower-cased letters, with one mark for each gap between words; empty without
    letters.  Three code points of 21 bits fill an integer."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letter_table()[c]
    if not letter.any():
        return np.empty(0, np.int64)
    c = np.r_[1, np.where(letter, c, 1), 1]
    c = c[np.r_[True, (c[1:] != 1) | (c[:-1] != 1)]]
    parts = [c]
    for n in range(2, LONGEST + 1):
        if len(c) >= n:
            parts.append((parts[-1][: len(c) - n + 1] << 21) | c[n - 1 :])
    return np.unique(np.concatenate(parts))


def kernel_rows(sets: list[np.ndarray], grams: np.ndarray, columns: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Normalised kernel of some texts with the landmarks, by one matrix product."""
    present = np.zeros((len(sets), len(grams)), np.float32)
    for i, s in enumerate(sets):
        at = np.searchsorted(grams, s)
        at[at == len(grams)] = 0
        present[i, at[grams[at] == s]] = 1
    own = np.array([max(len(s), 1) for s in sets], float)
    return (present @ columns) / np.sqrt(np.outer(own, sizes))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    sets = [(i, s) for i, t in enumerate(texts) if len(s := gram_set(t))] if model.languages else []
    for k in range(0, len(sets), _BLOCK):
        block = sets[k : k + _BLOCK]
        values = kernel_rows([s for _, s in block], model.grams, model.columns, model.sizes) @ model.weights
        best = values.argmax(axis=1)
        for (i, _), b, v in zip(block, best.tolist(), values.max(axis=1).tolist(), strict=True):
            languages[i], scores[i] = model.languages[b], min(1.0, max(0.0, (1 + v) / 2))
    return languages, scores


def fit_sets(sets: dict[str, list[np.ndarray]]) -> Model:
    """Model of the n-gram sets of each language's training texts."""
    languages = tuple(sorted(sets))
    each = max(1, min(LANDMARKS, LANDMARK_TEXTS // max(len(languages), 1)))
    marks = [s for x in languages for s in sets[x][:each]]
    if not marks:
        return Model((), np.empty(0, np.int64), np.empty((0, 0), np.float32), np.empty(0), np.empty((0, 0)))
    grams = np.unique(np.concatenate(marks))
    columns = np.zeros((len(grams), len(marks)), np.float32)
    for k, s in enumerate(marks):
        columns[np.searchsorted(grams, s), k] = 1
    sizes = np.array([len(s) for s in marks], float)
    rows = lambda some: np.concatenate([kernel_rows(some[k : k + _BLOCK], grams, columns, sizes) for k in range(0, len(some), _BLOCK)])
    value, vector = np.linalg.eigh(rows(marks))
    keep = value > 1e-6 * value[-1]
    root = vector[:, keep] / np.sqrt(value[keep])
    texts = [(x, s) for x in languages for s in sets[x]]
    features = rows([s for _, s in texts]) @ root
    target = np.array([[1.0 if x == y else -1.0 for y in languages] for x, _ in texts])
    weight = np.sqrt(np.array([1 / len(sets[x]) for x, _ in texts]))[:, None]  # each language counts alike
    a = features * weight
    ridge = np.linalg.solve(a.T @ a + RIDGE * np.eye(a.shape[1]), a.T @ (target * weight))
    return Model(languages, grams, columns, sizes, root @ ridge)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on the rows of *labelled* that have an id and a language."""
    rows = labelled.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("body"))
    spark = labelled.sparkSession
    counts = settle(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")  # a row for each language
    languages = counts.count()
    if not languages:
        return fit_sets({})
    per = max(1, min(PER_LANGUAGE, TRAINING_TEXTS // languages))
    # hashes below a language's share: about four times as many ids as needed, the rest is cut here
    limit = counts.select("lang", F.least(F.lit(1.0), 4.0 * per / F.col("n") + 16.0 / F.col("n")).alias("share"))
    spot = F.pmod(F.xxhash64("doc"), F.lit(1 << 30))
    some = rows.select("doc", "lang", spot.alias("spot")).join(F.broadcast(limit), "lang").where(F.col("spot") < F.col("share") * (1 << 30))
    first = Window.partitionBy("lang").orderBy("spot", "doc")
    some = some.select("lang", "spot", "doc").distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= per)
    chosen = defaultdict(set)
    for r in some.select("lang", "doc").collect():  # at most so many a language
        chosen[r.lang].add(r.doc)
    ids = spark.sparkContext.broadcast(np.unique(np.array([d for x in chosen.values() for d in x], np.int64)))

    def sets(batches):
        for batch in batches:
            batch = batch.filter(pa.array(np.isin(np.asarray(batch.column(0)), ids.value)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([gram_set(t.as_py()).tobytes() for t in batch.column(2)], pa.binary())],
                                             names=["doc", "lang", "grams"])

    by_language = defaultdict(list)
    for r in sorted(rows.mapInArrow(sets, "doc long, lang string, grams binary").collect(), key=lambda r: (r.doc, bytes(r.grams))):
        if r.doc in chosen[r.lang] and len(r.grams) and len(by_language[r.lang]) < per:
            by_language[r.lang].append(np.frombuffer(bytes(r.grams), np.int64))
    return fit_sets(by_language)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of *docs*: the id, lang_pred and score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            languages, scores = predict(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=["doc", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    return rows.mapInArrow(run, "doc long, lang_pred string, score double").withColumnRenamed("doc", id_col)
