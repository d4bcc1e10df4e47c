"""Spelling variants against comparing all pairs of words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import spelling

DOCS = "doc_id long, text string, word string, n int, prefix string"
VOCABULARY = "word string, n long"


def _words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(words, ratio=5):
    forms, rows = {}, {}
    for word, n in words.items():
        near = [w for w in words if _near(word, w)]
        best = min(near, key=lambda w: (-words[w], w), default=None)
        forms[word] = best if best is not None and words[best] >= ratio * n else None
        rows[word] = (n, len(near))
    for word in words:
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        rows[word] += (form, words[form] if form else None, root)
    return rows


def _found(frame):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


def _near_counts(spark, words):
    frame = spark.createDataFrame(sorted(words.items()), VOCABULARY)
    found = spelling.neighbours(frame).collect()
    return {r.word: (r.n_near, -r.best.minus_n, r.best.word) for r in found}


def _want(words):
    out = {}
    for word in words:
        near = [w for w in words if _near(word, w)]
        if near:
            best = min(near, key=lambda w: (-words[w], w))
            out[word] = (len(near), words[best], best)
    return out


@settings(max_examples=12, deadline=None)
@given(
    st.dictionaries(
        st.text(alphabet="abé", min_size=1, max_size=6), st.integers(1, 4), min_size=1, max_size=60
    )
)
def test_neighbours_of_any_words(spark, words):
    """Few letters make long runs of equal ones, where a deletion can be made in many places."""
    assert _near_counts(spark, words) == _want(words)


def test_a_run_of_rotations_is_as_long_as_the_alphabet(spark):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]
    words = {f"foo{c}bar": i + 1 for i, c in enumerate(letters)} | {"foobar": 500}
    assert _near_counts(spark, words) == _want(words)
    frame = spark.createDataFrame(sorted(words.items()), VOCABULARY)
    longest = spelling.rotations(frame).groupBy("prefix").count().agg(F.max("count")).first()[0]
    assert longest == len(letters) + 1


def _corpus():
    texts = []
    for doc in range(60):
        words = ["Colourful", "colorful", "MODERNE", "Ébauché", "ébauché", "harbour", "harborr"]
        texts.append((doc, " ".join(w for i, w in enumerate(words) for _ in range(1 + 3 * i))))
    texts.append((100, "harbou " * 5 + "harbor " * 6 + "harbours " * 30 + "short a-b_c " * 9))
    return texts


EDGES = [
    (None, "nullid " * 7),
    (None, None),
    (1, ""),
    (1, "twice " * 6 + "twiced " * 6),
    (1, "twice " * 6 + "twiced " * 6),
    (2, "ÀÉÎÕÜß×÷ÿ " * 6),
    (3, "İstanbul Kelvinia " * 6),
    (4, "x" * 20_000 + " " + "x" * 20_000),
    (5, "tab\tand wide　spaces日本languages " * 8),
]


def test_whole_query_by_hand(spark):
    docs = _corpus() + EDGES
    frame = spark.createDataFrame([(i, t, "w", 1, "p") for i, t in docs], DOCS)
    want = _variants(_words(docs))
    assert _found(spelling.spelling_variants(frame)) == want
    assert sum(row[2] is not None for row in want.values()) > 3


def test_slips_are_those_of_the_rule(spark):
    docs = [(i, "Misspelling " * 2) for i in range(3_000)]
    frame = spark.createDataFrame([(i, t, "w", 1, "p") for i, t in docs], DOCS)
    found = {r.word: r.n for r in spelling.vocabulary(frame).collect()}
    want = _words(docs)
    assert found == want
    assert 2_900 < found["misspelling"] / 2 < 3_000


def test_chain_of_forms_leads_to_its_end(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb", "bbbbbb"]
    docs = [(7, " ".join(" ".join([w] * 5 ** (i + 1)) for i, w in enumerate(words)))]
    frame = spark.createDataFrame([(i, t, "w", 1, "p") for i, t in docs], DOCS)
    found = _found(spelling.spelling_variants(frame))
    assert found == _variants(_words(docs))
    assert found["aaaaaa"][-1] == "bbbbbb"


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).collect() == []


def test_words_are_counted_before_the_shuffle(spark):
    docs = spark.createDataFrame([(1, "words " * 9, "w", 1, "p")], DOCS)
    plan = spelling.vocabulary(docs)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Python" not in plan
