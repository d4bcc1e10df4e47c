"""The filter audit against counting by hand."""

from __future__ import annotations

import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import filter_audit

DOCS = "doc_id long, text string, source string, word string, part string, good int, first int"
LABELS = "doc_id long, quality int, toxic int, part string"


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_popcount_of_every_bit(values):
    found = filter_audit.positional_popcount(np.array(values, dtype=np.uint32))
    assert found.tolist() == [sum(v >> i & 1 for v in values) for i in range(32)]


def test_popcount_of_many_equal_words():
    words = np.full(1_000_003, 0xFFFFFFFF, dtype=np.uint32)
    assert filter_audit.positional_popcount(words).tolist() == [1_000_003] * 32


def _fails(text, doc_id, docs):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    key = -(2**63) if doc_id is None else doc_id
    smaller = [-(2**63) if i is None else i for i, t, _ in docs if (t or "") == text]
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": min(smaller) < key,
    }


def _audit(docs, labels):
    """Rows as the operator gives them, every order run step by step."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = {}
    for part in {s or "" for _, _, s in docs}:
        own = [(i, _fails(t or "", i, docs)) for i, t, s in docs if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, start=1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                shapley[letter] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f[letter] for _, f in own) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                    letter,
                ]
        for (p, *_), row in rows.items():
            if p == part:
                row[-1] = shapley[row[-1]] if isinstance(row[-1], str) else row[-1]
    return rows


PLAIN = " ".join(f"word{i}" for i in range(220))
EDGES = [
    (1, PLAIN, "a"),
    (2, PLAIN, "b"),
    (2, PLAIN, "b"),
    (None, PLAIN, None),
    (None, None, None),
    (3, "", ""),
    (4, None, "a"),
    (5, "SHOUT " * 300, "a"),
    (5, "#" * 10, "a"),
    (6, "A" + "x" * 49, "b"),
    (7, "A" + "x" * 48, "b"),
    (8, " \t\x0b ", "b"),
    (9, PLAIN + " $", "b"),
    (10, " ".join(f"a{i % 110}" for i in range(220)), "c"),
    (11, " ".join(f"a{i % 109}" for i in range(220)), "c"),
    (12, "日本 " * 250, "c"),
    (13, " ".join(f"w{i}" for i in range(60_000)), "c"),
]
RATED = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, None, 1), (10, 0, None), (None, 1, 1), (99, 1, 1)]


def _frames(spark, docs, labels):
    rows = [(i, t, s, "x", "y", 1, 2) for i, t, s in docs]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(
        [(*row, "z") for row in labels], LABELS
    )


def _found(frame):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in frame.collect()}


def test_every_order_by_hand(spark):
    found = _found(filter_audit.filter_audit(*_frames(spark, EDGES, RATED)))
    assert found == _audit(EDGES, RATED)
    assert len(found) == 4 * 120 * 5


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(0, 6)),
            st.sampled_from([None, "", "A b", "a b c", "x $", PLAIN, PLAIN + " PLAIN" * 20]),
            st.sampled_from([None, "", "s", "t"]),
        ),
        min_size=1,
        max_size=30,
    ),
    st.lists(st.tuples(st.integers(0, 6), st.sampled_from([None, 0, 1]), st.sampled_from([None, 0, 1])), max_size=8),
)
def test_any_documents_by_hand(spark, docs, labels):
    assert _found(filter_audit.filter_audit(*_frames(spark, docs, labels))) == _audit(docs, labels)


def test_empty_tables(spark):
    docs, labels = _frames(spark, [], [])
    assert filter_audit.filter_audit(docs, labels).collect() == []


def test_own_filters(spark):
    docs, labels = _frames(spark, EDGES, RATED)
    own = {"S": F.length("text") < 5, "N": F.col("source").isNull()}
    found = _found(filter_audit.filter_audit(docs, labels, own))
    assert len({order for _, order, _ in found}) == 6
    # A null text is no failure of the length, a null source is one of N.
    assert found["", "NSE", 1][:2] == [1, 2]
    with pytest.raises(ValueError):
        filter_audit.filter_audit(docs, labels, {"E": F.lit(True)})


def test_hot_text_is_spread(spark):
    """A text held by a third of the rows is no key of a join or an exchange by itself."""
    docs = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("s").alias("source"),
    )
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    words = filter_audit.survival_words(docs, labels)
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "(digest" in plan
    found = _found(filter_audit.filter_audit(docs, labels))
    assert found["s", "EABCD", 1][:2] == [2_001, 999]
