"""Quality grades by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from clickloom.llm.tokens import Words, hashed_words, mix, sliced, windows

#: Labelled rows that the model is fitted on, at most: the first by a hash of the id.
SAMPLE_ROWS = 8_000
BUCKETS = 1 << 15
#: Grades of ``graded``: low quality, good but toxic, good.
GRADES = 3
#: A document is kept if it has at least this grade with at least this probability.
KEEP_GRADE, KEEP_PROBABILITY = 1, 0.5

# Kinds of bytes in a word, one bit each: a-z, A-Z, digit, sentence mark, other sign, other.
_KIND = np.full(256, 16, dtype=np.uint8)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 4
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 8
_KIND[128:] = 32
_SPACES = {"word": 1, "shape": 2, "repeat": 3, "length": 4}


def _bucket(space: str, value: np.ndarray) -> np.ndarray:
    salt = np.uint64(_SPACES[space] * 0x9E3779B97F4A7C15 % (1 << 64))
    return (mix(value.astype(np.uint64) ^ salt) % np.uint64(BUCKETS)).astype(np.int64)


def _repeats(words: Words, text: np.ndarray) -> np.ndarray:
    """For each word 0, or 1 if its three words occur again in its text, 2 if it is doubled."""
    if not len(text):
        return np.zeros(0, dtype=np.int64)
    own = mix(windows(words, 3) + mix(text.astype(np.uint64)))
    _, inverse, count = np.unique(own, return_inverse=True, return_counts=True)
    out = (count[inverse] > 1).astype(np.int64)
    doubled = np.zeros(len(text), dtype=bool)
    doubled[1:] = (words.hash[1:] == words.hash[:-1]) & (text[1:] == text[:-1])
    return np.where(doubled, 2, out)


def token_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, buckets of each word as rows of three, length bucket of each text)."""
    words = hashed_words(column)
    text = words.text_of()
    n = np.diff(words.first)
    if len(text):
        # Bytes between words are blanks; they must not count in a word's shape.
        edges = np.empty(2 * len(words.start), dtype=np.int64)
        edges[0::2], edges[1::2] = words.start, words.end
        kinds = np.append(_KIND[words.data], np.uint8(0))
        shape = np.bitwise_or.reduceat(kinds, edges)[0::2].astype(np.uint64)
    else:
        shape = np.zeros(0, dtype=np.uint64)
    size = np.minimum((words.end - words.start) // 8, 7).astype(np.uint64)
    buckets = np.stack(
        [
            _bucket("word", words.hash),
            _bucket("shape", shape * np.uint64(8) + size),
            _bucket("repeat", _repeats(words, text)),
        ],
        axis=1,
    )
    length = _bucket("length", np.floor(np.log2(n + 1)).astype(np.uint64))
    return n, buckets, length


@dataclass
class OrdinalModel:
    """Weights of buckets, shared by all grades, and the rising thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def signals(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(score, number of words) of each text: mean weight of its words plus its length's."""
        n, buckets, length = token_buckets(column)
        per_word = self.weights[buckets].sum(axis=1)
        sums = np.concatenate([[0.0], np.cumsum(per_word)])
        ends = np.cumsum(n)
        total = sums[ends] - sums[ends - n]
        return total / np.maximum(n, 1) + self.weights[length], n

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a row for each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        n, buckets, length = token_buckets(batch.column("text"))
        ends = np.cumsum(n)
        rows_b, rows_v = [], []
        for end, k, own in zip(ends.tolist(), n.tolist(), length.tolist()):
            found, count = np.unique(buckets[end - k : end], return_counts=True)
            rows_b.append(np.append(found, own).astype(np.int32))
            rows_v.append(np.append(count / max(k, 1), 1.0).astype(np.float32))
        yield pa.record_batch(
            {
                "grade": batch.column("grade"),
                "b": pa.array(rows_b, pa.list_(pa.int32())),
                "v": pa.array(rows_v, pa.list_(pa.float32())),
            }
        )


def fit(rows: pa.Table, grades: int = GRADES, steps: int = 300, decay: float = 1e-6) -> OrdinalModel:
    """The model of highest likelihood (Adam) for rows of (grade, b, v).

    P(grade >= k) is logistic in score - threshold k. Thresholds are kept in order by
    being sums of a first one and positive gaps.
    """
    grade = rows.column("grade").to_numpy().astype(np.int64)
    size = np.array([len(x) for x in rows.column("b").to_pylist()], dtype=np.int64)
    b = np.concatenate([c.flatten().to_numpy() for c in rows.column("b").chunks]).astype(np.int64)
    v = np.concatenate([c.flatten().to_numpy() for c in rows.column("v").chunks]).astype(np.float64)
    row = np.repeat(np.arange(len(grade)), size)
    used, b = np.unique(b, return_inverse=True)
    count = np.bincount(grade, minlength=grades).astype(float) + 1.0
    above = 1 - np.cumsum(count)[:-1] / count.sum()
    theta = -np.log(above / (1 - above))
    params = np.concatenate([np.zeros(len(used)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    m, s = np.zeros_like(params), np.zeros_like(params)
    k, n = len(used), len(grade)
    cut = np.arange(1, grades)
    for step in range(1, steps + 1):
        w, gaps = params[:k], np.exp(np.clip(params[k + 1 :], -10, 5))
        thresholds = np.concatenate([params[k : k + 1], params[k] + np.cumsum(gaps)])
        score = np.bincount(row, weights=v * w[b], minlength=n)
        tail = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -30, 30)))
        padded = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        p = np.maximum(padded[at, grade] - padded[at, grade + 1], 1e-9)
        # d p / d score: the density at the lower threshold less that at the upper one.
        density = padded * (1 - padded)
        d_score = -(density[at, grade] - density[at, grade + 1]) / p / n
        d_theta = np.zeros(grades - 1)
        for j in range(grades - 1):
            d_theta[j] = (
                (density[grade == j + 1, j + 1] / p[grade == j + 1]).sum()
                - (density[grade == j, j + 1] / p[grade == j]).sum()
            ) / n
        grad_w = np.bincount(b, weights=v * d_score[row], minlength=k) + decay * w
        grad_gaps = np.array([d_theta[cut > j + 1].sum() * gaps[j] for j in range(grades - 2)])
        grad = np.concatenate([grad_w, [d_theta.sum()], grad_gaps])
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        rate = 0.3 * (1 - 0.9 * step / steps)
        params -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-10)
    weights = np.zeros(BUCKETS)
    weights[used] = params[:k]
    gaps = np.exp(np.clip(params[k + 1 :], -10, 5))
    return OrdinalModel(weights, np.concatenate([params[k : k + 1], params[k] + np.cumsum(gaps)]))


def graded(quality: Column, toxic: Column) -> Column:
    """0 for low quality, 1 for good but toxic, 2 for good; null for other labels."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2)


def trained(docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """The model of ``ratings`` (doc_id, grade) of ``docs`` (doc_id, text).

    Fitted on at most ``sample_rows`` rated documents, also where a doc_id is repeated; rows
    without a grade are not used. Without any rated row the model gives every text the
    highest grade.
    """
    known = ratings.filter(F.col("grade").isNotNull() & F.col("doc_id").isNotNull())
    chosen = known.select("doc_id", F.col("grade").cast("int").alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rated = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    order = F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "grade"
    text = rated.orderBy(*order).limit(sample_rows).select("grade", "text")
    rows = text.mapInArrow(_features, "grade int, b array<int>, v array<float>").toArrow()
    if rows.num_rows == 0:
        return OrdinalModel(np.zeros(BUCKETS), np.full(GRADES - 1, -30.0))
    return fit(rows.sort_by([("grade", "ascending")]))


def graded_documents(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of ``docs`` with ``_grade``, ``_tail`` and ``_kept`` added.

    ``_grade`` is the expected grade and ``_tail`` the probability of KEEP_GRADE or more.
    A null text or one without words has grade 0. Whole texts are read, however long; equal
    texts have equal grades. Columns of these three names are not allowed in ``docs``.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights, model.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = OrdinalModel(*shared.value)
        for batch in sliced(batches):
            score, n = fitted.signals(batch.column("text"))
            tails = np.where((n > 0)[:, None], fitted.tails(score), 0.0)
            tail = tails[:, KEEP_GRADE - 1]
            yield (
                batch.append_column("_grade", pa.array(tails.sum(axis=1), pa.float64()))
                .append_column("_tail", pa.array(tail, pa.float64()))
                .append_column("_kept", pa.array(tail >= KEEP_PROBABILITY, pa.bool_()))
            )

    schema = StructType(list(docs.schema.fields))
    schema = schema.add("_grade", DoubleType()).add("_tail", DoubleType())
    return docs.mapInArrow(run, schema.add("_kept", BooleanType()))


def quality_grades(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_grade, tail_probability and kept of every document."""
    ratings = labels.select("doc_id", graded(F.col("quality"), F.col("toxic")).alias("grade"))
    found = graded_documents(docs.select("doc_id", "text"), trained(docs, ratings))
    return found.select(
        "doc_id",
        F.col("_grade").alias("expected_grade"),
        F.col("_tail").alias("tail_probability"),
        F.col("_kept").alias("kept"),
    )
