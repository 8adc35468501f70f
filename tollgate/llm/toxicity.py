"""Toxic passages as maximal scoring segments of token log-odds.

**Fit** (on at most `TRAIN_PER_CLASS` labelled texts of each class, a documented
bound): for every word, and for its first `STEMS` letters, the log-odds of its
rates in toxic and clean texts, with an informative Dirichlet prior that is
proportional to its pooled rate and `PRIOR` times as strong as the toxic class
is large.  A word counts once for each distinct pair of neighbours, so that
copies of a text add nothing.  The weight is the end of the interval of `Z`
standard errors that is nearer to 0, and nothing if that interval holds 0.  A
word takes the weight of its longest form that has one, and every token pays
`DRIFT`, so that the expected score of clean text is negative.

**Score**: one linear scan (Ruzzo and Tompa) finds every maximal scoring
segment of the whole text.  A segment of score s in a text of n tokens has the
expected count E = K * n * exp(-lambda * s) under the clean tokens, where lambda
solves sum p_i * exp(lambda * s_i) = 1 (extreme-value statistics); segments with
E < 1 are passages, and the text's evidence is the sum of -ln(E) over them.  A
logistic curve over ln(1 + evidence) gives the probability; it is fitted on the training texts,
each scored with weights learned from the other folds (`FOLDS`, by a hash of the
text, so copies of a text share one).

Texts are null, empty or any length; without a passage the evidence is 0.
Repeated rows score alike; extra columns are ignored; an empty table gives no
rows; without labels of both classes every score is the share of toxic labels
(0 if there are none), held below the threshold.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.rows import keep_rows, released
from tollgate.llm.storage import settle

TRAIN_PER_CLASS = 4_000
FOLDS = 8
STEMS = (6, 5, 4)
Z = 2.0
PRIOR = 0.1
DRIFT = 0.05
K = 0.1
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
_REMEMBERED = 100_000
_CONTEXTS = 1 << 15  # contexts that a task holds before it hands them on


@dataclass(frozen=True)
class Model:
    """Token weights, the extreme-value lambda, and the logistic curve over evidence."""

    weights: dict
    lam: float
    slope: float
    level: float


def forms(word: str) -> list[str]:
    """The word and its stems, longest first; stems end in an asterisk."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) in one pass, in time linear in the tokens.

    A candidate remembers the last earlier one that begins at a lower total, so no candidate is looked at twice for
    the same reason; when a token's total lies below all candidates, they are final and leave."""
    final: list[tuple[int, int, float]] = []
    held: list[tuple[int, int, float, float, int]] = []  # begin, end, total before, total at the end, last lower one
    spots = np.flatnonzero(scores > 0)
    ends = np.cumsum(scores)[spots].tolist()
    for i, s, total in zip(spots.tolist(), scores[spots].tolist(), ends, strict=True):
        begin, left = i, total - s
        k = len(held) - 1
        while k >= 0 and held[k][2] >= left:
            k = held[k][4]
        while k >= 0 and held[k][3] < total:  # reaches higher from there: one segment with all between
            begin, _, left, _, lower = held[k]
            del held[k:]
            k = lower
        if k < 0 and held:
            final += [(b, e, r - x) for b, e, x, r, _ in held]
            held.clear()
        held.append((begin, i + 1, left, total, k))
    return final + [(b, e, r - x) for b, e, x, r, _ in held]


class Scorer:
    """Segments and evidence of whole texts; remembers the scores of words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def word(self, w: str) -> float:
        s = self.known.get(w)
        if s is None:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            table = self.model.weights
            s = self.known[w] = next((table[f] for f in forms(w) if f in table), 0.0) - DRIFT
        return s

    def passages(self, text: str | None) -> list[tuple[int, int, float, float]]:
        """(begin, end, score, -ln E) of the significant passages, in code points of the lower-cased text."""
        low = (text or "").lower()
        words = _WORD.findall(low)
        if not words or not self.model.weights:
            return []
        scores = np.fromiter(map(self.word, words), float, len(words))
        if scores.max() <= 0:
            return []
        out, spans = [], None
        for b, e, s in segments(scores):
            significance = self.model.lam * s - math.log(K * len(words))
            if significance > 0:
                spans = spans or [m.span() for m in _WORD.finditer(low)]
                out.append((spans[b][0], spans[e - 1][1], s, significance))
        return out

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.model.level + self.model.slope * math.log1p(evidence)))))


def _contexts(batches):
    """(word, hash of the word with its neighbours, label, fold as a bit), each once or more."""

    def out(seen):
        keys = [int.from_bytes(blake2b("\0".join(k[:3]).encode(), digest_size=8).digest(), "little", signed=True) for k in seen]
        return pa.RecordBatch.from_arrays([pa.array([k[1] for k in seen], pa.string()), pa.array(keys, pa.int64()), pa.array([k[3] for k in seen], pa.int32()),
                                           pa.array([1 << k[4] for k in seen], pa.int32())], names=["word", "context", "label", "folds"])

    seen = set()
    for batch in batches:
        for text, label, fold in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = ["", *_WORD.findall((text.as_py() or "").lower()), ""]
            for k in range(0, len(words) - 2, _CONTEXTS):
                part = words[k : k + _CONTEXTS + 2]
                seen.update((before, word, after, label, fold) for before, word, after in zip(part, part[1:], part[2:], strict=False))
                if len(seen) >= _CONTEXTS:
                    yield out(seen)
                    seen.clear()
    if seen:
        yield out(seen)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int) -> DataFrame:
    """(text, label) of at most *per_class* labelled texts of each class, lowest hashes first.  The chosen ids are a
    list of bounded size; ids labelled both ways are left out."""
    spark = docs.sparkSession
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc"))
             .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("hi")).where("label = hi"))
    chosen = [r for k in (0, 1) for r in known.where(F.col("label") == k).orderBy(F.xxhash64("doc"), "doc").limit(per_class).collect()]
    chosen.sort()
    table = spark.sparkContext.broadcast((np.array([r.doc for r in chosen], np.int64), np.array([r.label for r in chosen], np.int32)))

    def pick(batches):
        ids, marks = table.value
        for batch in batches:
            doc = np.asarray(batch.column(0))
            if not len(ids) or not len(doc):
                continue
            at = np.minimum(np.searchsorted(ids, doc), len(ids) - 1)
            hit = ids[at] == doc
            if hit.any():
                text = batch.column(1).filter(pa.array(hit))
                yield pa.RecordBatch.from_arrays([text, pa.array(marks[at][hit])], names=["body", "label"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    return rows.mapInArrow(released(pick), "body string, label int")


def solve_lambda(probability: np.ndarray, score: np.ndarray) -> float:
    """The positive root of sum p * exp(lambda * s) = 1 (mean score below 0, some score above 0)."""
    value = lambda x: float((probability * np.exp(np.minimum(x * score, 700))).sum()) - 1
    if (probability * score).sum() >= 0:
        return 1e-3
    low, high = 0.0, 1.0
    while value(high) < 0:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def fit_logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and level of a ridge-penalised logistic curve (Newton steps)."""
    a = np.stack([x, np.ones(len(x))], 1)
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        penalty = np.array([0.01, 0.01])
        step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + np.diag(penalty), a.T @ (weight * (label - p)) - penalty * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _learn(counts: DataFrame) -> Model | None:
    """Weights and lambda from (word, k1, k0): in how many contexts each word stands, of toxic and of clean texts."""
    whole = counts.agg(F.sum("k1").alias("k1"), F.sum("k0").alias("k0")).first()
    if not whole.k1 or not whole.k0:
        return None
    n1, n0 = whole.k1, whole.k0
    stems = F.array(F.col("word"), *(F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS))
    features = counts.select(F.explode(stems).alias("feature"), "k1", "k0").where("feature IS NOT NULL").groupBy("feature").agg(
        F.sum("k1").alias("k1"), F.sum("k0").alias("k0"))
    strength = PRIOR * min(n1, n0)
    prior = (F.col("k1") + F.col("k0")) * (strength / (n1 + n0))
    odds = F.log((F.col("k1") + prior) / (n1 + strength)) - F.log((F.col("k0") + prior) / (n0 + strength))
    error = F.sqrt(1 / (F.col("k1") + prior) + 1 / (F.col("k0") + prior))
    scored = features.select("feature", "k0", (F.signum(odds) * F.greatest(F.lit(0.0), F.abs(odds) - Z * error)).alias("odds"))
    top = scored.where("odds != 0").orderBy(F.desc(F.abs("odds")), "feature").collect()
    weights = {r.feature: r.odds for r in top}

    # score distribution of clean tokens, with half a count for each weight that no clean text has
    bare = Scorer(Model(weights, 1.0, 0.0, 0.0))
    seen = Counter()
    for r in top:
        if not r.feature.endswith("*"):
            seen[bare.word(r.feature)] += max(r.k0, 0.5)
    rest = max(n0 - sum(seen.values()), 1.0)
    score = np.array([-DRIFT, *seen], float)
    probability = np.array([rest, *seen.values()], float)
    lam = solve_lambda(probability / probability.sum(), score) if score.max() > 0 else 1.0
    return Model(weights, lam, 0.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *,
        per_class: int = TRAIN_PER_CLASS) -> Model:
    rows = training_rows(docs, labels, id_col, text_col, label_col, per_class).withColumn("fold", F.expr(f"cast(pmod(xxhash64(body), {FOLDS}) as int)"))
    rows = settle(rows, "toxic-training")
    words = (rows.mapInArrow(released(_contexts), "word string, context long, label int, folds int")
             .groupBy("word", "context", "label").agg(F.bit_or("folds").alias("folds")))
    of = lambda label, folds: F.count_if((F.col("label") == label) & (F.col("folds").bitwiseAND(folds) != 0))
    others = [(1 << FOLDS) - 1 - (1 << k) for k in range(FOLDS)]
    words = words.groupBy("word").agg(of(1, -1).alias("k1"), of(0, -1).alias("k0"),
                                      *(of(label, others[k]).alias(f"k{label}_{k}") for k in range(FOLDS) for label in (0, 1)))
    words = settle(words, "toxic-words")
    share = rows.agg(F.avg("label").alias("toxic")).first().toxic
    whole = _learn(words.select("word", "k1", "k0"))
    if whole is None:
        return Model({}, 1.0, 0.0, -30.0 if not share else math.log(min(share, 0.6) / (1 - min(share, 0.6))))
    # too few texts of a class for a fold to lack: scored with all weights
    folds = [_learn(words.select("word", F.col(f"k1_{k}").alias("k1"), F.col(f"k0_{k}").alias("k0")).where("k1 + k0 > 0")) or whole for k in range(FOLDS)]
    shared = docs.sparkSession.sparkContext.broadcast(folds)

    def evidence(batches):
        scorers = [Scorer(model) for model in shared.value]
        for batch in batches:
            x = [round(20 * math.log1p(sum(p[3] for p in scorers[fold].passages(t.as_py())))) / 20
                 for t, fold in zip(batch.column(0), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], names=["x", "label"])

    bins = rows.mapInArrow(released(evidence), "x double, label int").groupBy("x", "label").count().orderBy("x", "label").collect()
    x, label, weight = (np.array([r[i] for r in bins], float) for i in range(3))
    return Model(whole.weights, whole.lam, *fit_logistic(x, label, weight))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of *docs*: the id, score (0 to 1), evidence and passages (begin, end, score, significance;
    code points of the lower-cased text, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    struct = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("significance", pa.float64())]))

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.passages(t.as_py()) for t in batch.column(1)]
            evidence = [sum(p[3] for p in f) for f in found]
            passages = [[dict(zip(("begin", "end", "score", "significance"), p, strict=True)) for p in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.score(e) for e in evidence], pa.float64()),
                                              pa.array(evidence, pa.float64()), pa.array(passages, struct)],
                                             names=["doc", "score", "evidence", "passages"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    out = rows.mapInArrow(run, "doc long, score double, evidence double, passages array<struct<begin:int,end:int,score:double,significance:double>>")
    return out.withColumnRenamed("doc", id_col)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of *docs* that score under *threshold* (all columns, in one pass over the table)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        scorer = Scorer(shared.value)
        return lambda texts: [scorer.score(sum(p[3] for p in scorer.passages(t.as_py()))) < threshold for t in texts]

    return keep_rows(docs, text_col, judge)
