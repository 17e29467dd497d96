"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A rated document has grade ``quality + (1 - toxic)``: 0 worst, 2 best. The model
has one shared weight per hashed text feature and ordered thresholds:
P(grade > g) = sigmoid(score - threshold[g]). It gives the expected grade and
the tail probability P(grade = best), by which documents are selected.

Features of a text, from all its words: the presence of each lower-cased word
and of each word beginning; the share of words of each form (letters and digits
reduced to their kind) and of words that repeat their predecessor, as a square
root.

Features are computed by Spark. The fit runs on the driver over a sample of at
most ``FIT_ROWS`` rated documents, those with the smallest hash of their id.
Scoring is one narrow pass over all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from voltframe.llm.common import by_value, table

#: Bound on the rated documents that the driver fits the model on.
FIT_ROWS = 5000
HASH_BITS = 18
MIN_TAIL = 0.5
STEPS = 200
RIDGE = 1e-3
POWER_STEPS = 15
THRESHOLD_RATE = 1.0
MIN_GAP = 0.1
SMOOTHING = 2.0
#: A hashed feature needs this many sampled documents.
MIN_DOCUMENTS = 5
PREFIX_CHARS = 4
SHARE_SCALE = 10.0
MEMO_WORDS = 50_000

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def _bucket(kind: str, of: str) -> int:
    return zlib.crc32(f"{kind} {of}".encode("utf-8", "replace")) & ((1 << HASH_BITS) - 1)


def _word_features(word: str) -> tuple[int, int, int]:
    """Hash buckets of the bare word, of its beginning and of its form."""
    bare = word.lower().strip(".,;:!?\"'()[]*#$%&|")
    form = _DIGITS.sub("9", _LETTERS.sub(lambda m: "X" if m[0].isupper() and len(m[0]) > 1 else "x", word))
    return _bucket("word", bare), _bucket("start", bare[:PREFIX_CHARS]), _bucket("form", form)


_MEMO: dict[str, tuple[int, int, int]] = {}


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values of one text."""
    words = (text or "").split()
    n = len(words)
    shares: dict[int, float] = {}
    marks = {_bucket("bias", "")}
    if len(_MEMO) > MEMO_WORDS:
        _MEMO.clear()
    for word, count in Counter(words).items():
        got = _MEMO.get(word)
        if got is None:
            got = _MEMO[word] = _word_features(word)
        marks.update(got[:2])
        shares[got[2]] = shares.get(got[2], 0.0) + count
    again = sum(a == b for a, b in zip(words, words[1:]))
    if again:
        shares[_bucket("repeat", "")] = float(again)
    at = np.fromiter([*marks, *shares], dtype=np.int32, count=len(marks) + len(shares))
    values = np.ones(len(at), dtype=np.float32)
    values[len(marks):] = SHARE_SCALE * np.sqrt(np.fromiter(shares.values(), dtype=np.float64) / max(n, 1))
    return at, values


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > g) for each g, a column each."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))

    def score(self, text: str | None) -> float:
        at, values = features(text)
        return float(self.weights[at] @ values)


def _ordered(cuts: np.ndarray) -> np.ndarray:
    """Each threshold at least ``MIN_GAP`` above the one before."""
    step = MIN_GAP * np.arange(len(cuts))
    return np.maximum.accumulate(cuts - step) + step


def fit_ordinal(rows: np.ndarray, at: np.ndarray, values: np.ndarray, grades: np.ndarray,
                size: int = 1 << HASH_BITS, steps: int = STEPS, ridge: float = RIDGE,
                min_documents: int = MIN_DOCUMENTS, smoothing: float = SMOOTHING) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model by accelerated full-batch gradient
    steps, whose size follows from the largest curvature.

    ``rows``, ``at`` and ``values`` are the nonzero features, ``grades`` the
    rating of each row. Thresholds are projected to stay ordered."""
    top = int(grades.max()) if len(grades) else 1
    top = max(top, 1)
    known = np.bincount(at, minlength=size)[at] >= min_documents
    rows, at, values = rows[known], at[known], values[known].astype(np.float64)
    buckets, at = np.unique(at, return_inverse=True)
    n = max(len(grades), 1)
    # features count by how differently often the best and the other grades have them
    best = grades == top
    part = [np.bincount(at[k], values[k], minlength=len(buckets)) + smoothing for k in (best[rows], ~best[rows])]
    scale = np.abs(np.log(part[0] / (best.sum() + 2 * smoothing)) - np.log(part[1] / ((~best).sum() + 2 * smoothing)))
    values = values * scale[at]
    w = np.zeros(len(buckets))
    share = np.array([np.clip((grades > g).mean() if len(grades) else 0.5, 1e-3, 1 - 1e-3) for g in range(top)])
    start = -np.log(share / (1 - share))
    theta = _ordered(start)
    probe = np.ones(len(w))
    for _ in range(POWER_STEPS):  # the largest curvature of the loss bounds the step
        probe = probe / max(np.linalg.norm(probe), 1e-12)
        probe = np.bincount(at, values * np.bincount(rows, values * probe[at], minlength=n)[rows], minlength=len(w))
    rate = 1.0 / (np.linalg.norm(probe) / (2 * n) + ridge)
    ahead, last, ahead_t, last_t = w, w, theta, theta
    pick = np.arange(len(grades))
    for step in range(1, steps + 1):
        cuts = _ordered(ahead_t)
        score = np.bincount(rows, values * ahead[at], minlength=len(grades))
        above = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -30, 30)))
        full = np.hstack((np.ones((len(grades), 1)), above, np.zeros((len(grades), 1))))
        slope = full * (1 - full)
        p = np.maximum(full[pick, grades] - full[pick, grades + 1], 1e-9)
        d_score = (slope[pick, grades] - slope[pick, grades + 1]) / p / n
        d_cuts = np.zeros((len(grades), top + 2))
        d_cuts[pick, grades] -= slope[pick, grades] / p / n
        d_cuts[pick, grades + 1] += slope[pick, grades + 1] / p / n
        w = ahead + rate * (np.bincount(at, values * d_score[rows], minlength=len(w)) - ridge * ahead)
        theta = _ordered(cuts + THRESHOLD_RATE * d_cuts.sum(axis=0)[1:-1])
        push = (step - 1) / (step + 2)
        ahead, ahead_t = w + push * (w - last), theta + push * (theta - last_t)
        last, last_t = w, theta
    weights = np.zeros(size)
    weights[buckets] = w * scale
    return OrdinalModel(weights, theta)


_FEATURES = StructType([StructField("at", ArrayType(IntegerType())), StructField("values", ArrayType(FloatType()))])


def _feature_rows(texts: list) -> pa.Array:
    got = [features(t) for t in texts]
    return pa.array([{"at": g[0], "values": g[1]} for g in got],
                    pa.struct([("at", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))]))


def _grades(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)`` of the complete ratings; of several ratings of a
    document the lowest grade counts."""
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
            .groupBy("doc_id").agg(F.min(F.col("quality") + 1 - F.col("toxic")).cast("int").alias("grade")))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, grade)`` of documents that have a complete rating."""
    return docs.select("doc_id", "text").join(_grades(labels), "doc_id")


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> OrdinalModel:
    """Fit on the ``fit_rows`` documents with the smallest id hash of those that
    are there and have a complete rating. The sample is chosen on ids alone, so
    only its texts move."""
    ids = (_grades(labels).join(docs.select("doc_id"), "doc_id", "left_semi")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    got = (sample.select("doc_id", "grade", F.arrow_udf(by_value(_feature_rows), _FEATURES)("text").alias("f"))
           .select("doc_id", "grade", "f.at", "f.values").toPandas().sort_values("doc_id", kind="stable"))
    sizes = got["at"].map(len).to_numpy(dtype=np.int64)
    rows = np.repeat(np.arange(len(got), dtype=np.int32), sizes)
    at = np.concatenate([np.zeros(0, np.int32), *got["at"]]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.float32), *got["values"]]).astype(np.float32)
    grades = got["grade"].to_numpy(dtype=np.int64)
    del got, sizes
    return fit_ordinal(rows, at, values, grades)


_GRADED = StructType([StructField("expected_grade", DoubleType()), StructField("tail_probability", DoubleType())])


def graded(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` (of the best grade)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts: list) -> pa.Array:
        tails = shared.value.tails(np.array([shared.value.score(t) for t in texts]).reshape(-1))
        return pa.StructArray.from_arrays([pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])], _GRADED.names)

    got = docs.withColumn("__graded", F.arrow_udf(by_value(scores), _GRADED)(F.col(text_col)))
    return got.withColumns({c: F.col(f"__graded.{c}") for c in _GRADED.names}).drop("__graded")


def quality_filter(docs: DataFrame, model: OrdinalModel, min_tail: float = MIN_TAIL) -> DataFrame:
    """The documents whose probability of the best grade is at least ``min_tail``."""
    return (graded(docs, model).where(F.col("tail_probability") >= min_tail)
            .drop("expected_grade", "tail_probability"))


def op10_ordinal_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's expected grade, tail probability and whether it is kept.

    A null text is scored as an empty one. Without any rating all documents
    get the same middling score. Repeated rows get equal scores."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return (graded(docs, model).select("doc_id", "expected_grade", "tail_probability",
                                       (F.col("tail_probability") >= MIN_TAIL).alias("kept")))
