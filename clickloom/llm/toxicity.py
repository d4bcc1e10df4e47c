"""Toxicity scores from a weighted lexicon matched by Aho-Corasick."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.tokens import sliced
from clickloom.session import materialize


#: Labelled rows that the lexicon is learned from, at most: the first by a hash of the id.
SAMPLE_ROWS = 8_000
LEXICON_WORDS = 400
PHRASES = 400
#: Log odds that a text loses at least for each e-fold of its words.
LENGTH_SLOPE = -0.1
MIN_ROWS = 3
# Lengths of the beginnings of words that are candidates.
_SHORTEST, _LONGEST = 4, 8
_PLAIN_WORD = re.compile(r"[^\W_]+")

# Characters that look like a Latin letter, and digits and signs that stand for one.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s",
    "ј": "j", "ԁ": "d", "һ": "h", "ո": "n", "ο": "o", "α": "a", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "к": "k", "м": "m", "т": "t", "в": "b",
    "н": "h", "ı": "i", "ł": "l", "ø": "o", "ß": "ss",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "i", "+": "t", "€": "e",
    "​": "", "‌": "", "‍": "", "­": "", "﻿": "",
}
_PLAIN_SIGNS = "!|+"


def _letters() -> dict[int, str]:
    """Lower case of every single character, accents off, full-width forms made plain."""
    import unicodedata

    table = {}
    for code in [*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        decomposed = unicodedata.normalize("NFKD", chr(code)).lower()
        table[code] = "".join(
            _LOOKALIKES.get(c, c) for c in decomposed if not unicodedata.combining(c)
        )
    return table | {ord(c): plain for c, plain in _LOOKALIKES.items()}


_FOLD = _letters()


def folded(text: str) -> str:
    """Lower-case text with look-alike letters, digits and signs made plain letters.

    A sign that also ends sentences (!, |, +) counts as a letter only inside a word; digits
    and signs are folded everywhere, so a number becomes a meaningless word.
    """
    lower = text.lower()
    for sign in _PLAIN_SIGNS:
        if sign in lower:
            parts = lower.split(sign)
            out = [parts[0]]
            for before, after in zip(parts, parts[1:]):
                inside = before[-1:].isalnum() and after[:1].isalnum()
                out.append((sign if inside else " ") + after)
            lower = "".join(out)
    return lower.translate(_FOLD)


@dataclass
class Lexicon:
    """Weighted terms, phrases in which they do not count, and a calibration.

    A term that ends with ``$`` is a whole word, any other is the beginning of words. The
    probability is logistic in log(1 + weight found) and, if any is found, the logarithm
    of the number of words: a long text needs more.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    calibration: tuple[float, float, float] = (-4.0, 2.0, 0.0)
    _matcher: object = field(default=None, repr=False)

    def __reduce__(self):
        return Lexicon, (self.weights, self.exceptions, self.calibration)

    def matcher(self):
        if self._matcher is None:
            terms: dict[str, list[tuple[bool, float | None]]] = {}
            for phrase in self.exceptions:
                terms.setdefault(phrase, []).append((True, None))
            for term, weight in self.weights.items():
                terms.setdefault(term.removesuffix("$"), []).append((term.endswith("$"), weight))
            self._matcher = ahocorasick.Automaton()
            for term, uses in terms.items():
                self._matcher.add_word(term, (len(term), uses))
            if terms:
                self._matcher.make_automaton()
        return self._matcher

    def matches(self, plain: str) -> list[tuple[int, int, float]]:
        """(begin, end, weight) of the terms in a folded text, without excepted ones."""
        matcher = self.matcher()
        if not len(matcher):
            return []
        found, covered = [], []
        for last, (length, uses) in matcher.iter(plain):
            begin, end = last - length + 1, last + 1
            if begin and plain[begin - 1].isalnum():
                continue
            ends = not plain[end : end + 1].isalnum()
            for whole, weight in uses:
                if ends or not whole:
                    if weight is None:
                        covered.append((begin, end))
                    else:
                        found.append((begin, end, weight))
        if covered:
            covered.sort()
            begins = [a for a, _ in covered]
            reach = list(accumulate((b for _, b in covered), max))
            found = [
                f for f in found
                if not (i := bisect_right(begins, f[0])) or reach[i - 1] <= f[0]
            ]
        return found

    def features(self, text: str) -> tuple[float, float]:
        total = sum(weight for _, _, weight in self.matches(folded(text)))
        if total <= 0.0:
            return 0.0, 0.0
        return math.log1p(total), math.log1p(len(text.split()))

    def score(self, text: str) -> float:
        bias, by_weight, by_length = self.calibration
        weight, length = self.features(text)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, bias + by_weight * weight + by_length * length))))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 40) -> tuple[float, ...]:
    """A bias, a slope by weight and one by length, which is never above LENGTH_SLOPE.

    Newton's method, lightly regularised; where it would let long texts need no more than
    short ones, the slope by length is LENGTH_SLOPE and the rest is fitted beside it.
    """
    fitted = _newton(x, y, np.zeros(len(x)), steps)
    if fitted[2] <= LENGTH_SLOPE:
        return fitted
    return (*_newton(x[:, :1], y, LENGTH_SLOPE * x[:, 1], steps), LENGTH_SLOPE)


def _newton(x: np.ndarray, y: np.ndarray, given: np.ndarray, steps: int) -> tuple[float, ...]:
    """Bias and slopes of a logistic model whose log odds have ``given`` added."""
    features = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(features.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ w + given, -30, 30)))
        gradient = features.T @ (p - y) + 1e-2 * w
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return tuple(float(v) for v in w)


def _counted_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row the words and word beginnings in it, each counted up to five times."""
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
            count: Counter[str] = Counter()
            for word in _PLAIN_WORD.findall(folded(text or "")):
                count[word + "$"] += 1
                count.update(word[:k] for k in range(_SHORTEST, min(_LONGEST, len(word)) + 1))
            yield pa.record_batch(
                {
                    "term": pa.array(count.keys(), pa.string()),
                    "toxic": pa.array([toxic] * len(count), pa.int32()),
                    "n": pa.array([min(n, 5) for n in count.values()], pa.int32()),
                }
            )


def _chosen_terms(rows: list, bad: int, good: int) -> dict[str, float]:
    """Of terms with (term, bad, good, score), the best that do not contain each other."""
    chosen: dict[str, float] = {}
    for row in sorted(rows, key=lambda r: (-round(r["score"], 6), -len(r["term"]), r["term"])):
        base = row["term"].removesuffix("$")
        kept = [term.removesuffix("$") for term in chosen]
        if len(chosen) < LEXICON_WORDS and not any(
            base.startswith(other) or other.startswith(base) for other in kept
        ):
            chosen[row["term"]] = float(row["weight"])
    return chosen


def learned(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """A lexicon from documents (doc_id, text) with labels (doc_id, toxic), not held out.

    Candidates are folded words and beginnings of words. A term's weight is the logarithm
    of its rate in toxic documents to its rate in others; it is a candidate if it occurs
    in enough toxic documents and more often than chance lets it (``score`` is in standard
    deviations). A term with a neighbouring word is an exception if that pair is found in
    other documents at least as often as in toxic ones. Labels other than 0 and 1 are not
    used, and at most ``sample_rows`` rows. Without rows of both kinds no term is learned.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).select("doc_id", "toxic")
    known = known.withColumn("toxic", F.col("toxic").cast("int"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rated = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # A doc_id may be repeated: the bound holds for the documents as well.
    order = F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "toxic"
    text = rated.orderBy(*order).limit(sample_rows).select("toxic", "text")
    text = materialize(text, "toxic-sample")
    totals = dict(text.groupBy("toxic").count().collect())
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Lexicon({})
    in_bad, in_good = F.col("toxic") * F.col("n"), (1 - F.col("toxic")) * F.col("n")
    share = (F.col("bad") + F.col("good")) * F.lit(bad / (bad + good))
    rated = (
        text.mapInArrow(_counted_terms, "term string, toxic int, n int")
        .groupBy("term")
        .agg(F.sum(in_bad).alias("bad"), F.sum(in_good).alias("good"), F.sum("toxic").alias("rows"))
        .filter(F.col("rows") >= max(MIN_ROWS, 0.02 * bad))
        .withColumn("score", (F.col("bad") - share) / F.sqrt(share + 1))
        .withColumn(
            "weight", F.log((F.col("bad") + 0.5) / bad) - F.log((F.col("good") + 0.5) / good)
        )
        .filter((F.col("score") > 6) & (F.col("weight") > 1))
    )
    best = rated.orderBy(F.desc("score"), "term").limit(10 * LEXICON_WORDS).collect()
    plain = Lexicon(_chosen_terms(best, bad, good))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for toxic, value in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                folded_text = folded(value or "")
                words = [(m.start(), m.group()) for m in _PLAIN_WORD.finditer(folded_text)]
                hits = {begin for begin, _, _ in plain.matches(folded_text)}
                pairs = {
                    folded_text[a : b + len(second)]
                    for (a, _), (b, second) in zip(words, words[1:])
                    if a in hits or b in hits
                }
                yield pa.record_batch(
                    {
                        "phrase": pa.array(pairs, pa.string()),
                        "toxic": pa.array([toxic] * len(pairs), pa.int32()),
                    }
                )

    harmless = (
        text.mapInArrow(neighbours, "phrase string, toxic int")
        .groupBy("phrase")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .filter((F.col("good") >= MIN_ROWS) & (F.col("good") * bad >= F.col("bad") * good))
    )
    phrases = harmless.orderBy(F.desc("good"), "phrase").limit(PHRASES).collect()
    lexicon = Lexicon(plain.weights, tuple(row["phrase"] for row in phrases))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {
                    "toxic": batch.column("toxic"),
                    "weight": pa.array([f[0] for f in found], pa.float64()),
                    "length": pa.array([f[1] for f in found], pa.float64()),
                }
            )

    points = text.mapInArrow(features, "toxic int, weight double, length double").collect()
    x = np.array([(p["weight"], p["length"]) for p in points])
    y = np.array([float(p["toxic"]) for p in points])
    return Lexicon(lexicon.weights, lexicon.exceptions, _logistic(x, y))


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text).

    The score depends on the text alone: a null or empty one has that of no match. Long
    texts are matched as wholes. Repeated rows are scored each; a null doc_id is never
    held out.
    """

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            score = [lexicon.score(t) for t in texts]
            yield batch.drop_columns(["text"]).append_column("score", pa.array(score, pa.float64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        scores, f"doc_id {kind}, held_out boolean, score double"
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all ``docs`` by a lexicon learned from ``labels``."""
    return scored(docs, learned(docs, labels))
