"""Operators without SQL against plain implementations."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import mixing, packing, quality, sharding, toxicity

xxhash = pytest.importorskip("xxhash")


def _hash(*values):
    """Spark's xxhash64 of longs (Python ints) and ints (numpy int32); None leaves the seed."""
    seed = 42
    for value in values:
        if value is not None:
            size = 4 if isinstance(value, np.int32) else 8
            data = int(value).to_bytes(size, "little", signed=True)
            seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def _winner(key, shards):
    def score(shard):
        return -1 / math.log(((_hash(key, np.int32(shard)) >> 11) + 0.5) / 2**53)

    return max(range(shards), key=score)


def test_shards_by_hand(spark):
    rng = random.Random(6)
    texts = ["", None, "ß 日本", "same", "same", "x" * 5_000]
    docs = [(rng.choice([None, rng.randrange(-50, 50), rng.randrange(2**62)]), rng.choice(texts)) for _ in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = sharding.sharded_documents(frame, 7).collect()
    want = Counter()
    for doc_id, text in docs:
        data = (text or "").encode()
        want[doc_id, len(data) + 16, zlib.crc32(data), "key", _winner(doc_id, 7), _winner(doc_id, 8)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def _naive_matches(lexicon, plain):
    def found(term, whole):
        for i in range(len(plain) - len(term) + 1):
            end = i + len(term)
            if plain[i:end] != term or (i and plain[i - 1].isalnum()):
                continue
            if not whole or not plain[end : end + 1].isalnum():
                yield i, end

    covered = [c for phrase in lexicon.exceptions for c in found(phrase, True)]
    return sorted(
        (a, b, weight)
        for term, weight in lexicon.weights.items()
        for a, b in found(term.removesuffix("$"), term.endswith("$"))
        if not any(c <= a < d for c, d in covered)
    )


WORDS = st.text(alphabet="ab", min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.tuples(WORDS, st.booleans()), st.floats(0.5, 4), max_size=5),
    st.lists(st.lists(WORDS, min_size=1, max_size=3), max_size=4),
    st.text(alphabet="aab -", max_size=60),
)
def test_matcher_by_hand(terms, phrases, text):
    weights = {term + "$" * whole: weight for (term, whole), weight in terms.items()}
    lexicon = toxicity.Lexicon(weights, tuple({" ".join(p) for p in phrases}))
    assert sorted(lexicon.matches(text)) == _naive_matches(lexicon, text)


def test_many_matches_and_exceptions_take_no_square():
    lexicon = toxicity.Lexicon({"bad$": 1.0}, ("bad luck",))
    text = "bad luck bad " * 100_000
    assert len(lexicon.matches(text)) == 100_000


@pytest.mark.parametrize("towards", [1.0, 0.0, -1.0])
def test_length_always_lowers_the_score(towards):
    rng = np.random.default_rng(3)
    x = np.stack([rng.uniform(0, 3, 500), rng.uniform(0, 6, 500)], axis=1)
    odds = 3 * x[:, 0] - 4 + towards * x[:, 1]
    y = (rng.random(500) < 1 / (1 + np.exp(-odds))).astype(float)
    fitted = toxicity._logistic(x, y)
    assert fitted[2] <= toxicity.LENGTH_SLOPE and fitted[1] > 0
    lexicon = toxicity.Lexicon({"bad$": 2.0}, (), fitted)
    scores = [lexicon.score("bad " + "word " * n) for n in (0, 10, 100, 1_000)]
    assert scores == sorted(scores, reverse=True) and len(set(scores)) == 4


def _loss(weights, thresholds, rows, decay=1e-6):
    """Mean negative log-likelihood of the cumulative-link model, by its definition."""
    total = 0.0
    for grade, features in rows:
        score = sum(v * weights[b] for b, v in features)

        def tail(k):
            if k == 0:
                return 1.0
            return 0.0 if k > len(thresholds) else 1 / (1 + math.exp(thresholds[k - 1] - score))

        total -= math.log(tail(grade) - tail(grade + 1))
    return total / len(rows) + decay / 2 * sum(w * w for w in weights.values())


def test_grades_are_fitted_to_the_likelihood():
    rng = np.random.default_rng(9)
    true = {0: 2.0, 1: -1.0, 2: 0.5, 3: 0.0}
    rows = []
    for _ in range(400):
        features = [(b, float(rng.random())) for b in range(4)]
        score = sum(v * true[b] for b, v in features) + rng.logistic()
        rows.append((int(score > 0) + int(score > 1.5), features))
    table = pa.table(
        {
            "grade": pa.array([g for g, _ in rows], pa.int32()),
            "b": pa.array([[b for b, _ in f] for _, f in rows], pa.list_(pa.int32())),
            "v": pa.array([[v for _, v in f] for _, f in rows], pa.list_(pa.float32())),
        }
    )
    model = quality.fit(table)
    weights, thresholds = {b: model.weights[b] for b in range(4)}, model.thresholds.tolist()
    best = _loss(weights, thresholds, rows)
    # No step in any direction improves on it: the gradient by finite differences is nothing.
    for b in range(4):
        ends = [_loss(weights | {b: weights[b] + d}, thresholds, rows) for d in (-1e-3, 1e-3)]
        assert abs(ends[1] - ends[0]) / 2e-3 < 2e-3 and min(ends) > best - 1e-6
    for k in range(2):
        moved = [[t + d * (i == k) for i, t in enumerate(thresholds)] for d in (-1e-3, 1e-3)]
        ends = [_loss(weights, t, rows) for t in moved]
        assert abs(ends[1] - ends[0]) / 2e-3 < 2e-3
    assert best < _loss(true, [0.0, 1.5], rows)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(-20, 20), min_size=1, max_size=9), st.lists(st.floats(-5, 5), min_size=1, max_size=4))
def test_tails_by_their_formula(scores, thresholds):
    thresholds = sorted(thresholds)
    found = quality.OrdinalModel(np.zeros(1), np.array(thresholds)).tails(np.array(scores))
    want = [[1 / (1 + math.exp(t - s)) for t in thresholds] for s in scores]
    assert np.allclose(found, want)


def test_blocks_of_the_mix_hold_its_words(spark):
    """The written shards against the pieces: every slot once, whole blocks, the stated words."""
    rng = random.Random(12)
    docs = [
        (i, " ".join(f"{i}_{j}" for j in range(rng.randrange(0, 300))), rng.choice(["hot", "hot", "a", None]))
        for i in range(120)
    ]
    docs.append((None, "no id here", "a"))
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    amounts = mixing.mixed_amounts(frame).collect()
    rows = mixing.mixed_blocks(frame.repartition(3)).collect()
    slots = sorted(r.shard * mixing.SHARD_BLOCKS + r.place for r in rows)
    assert slots == list(range(len(rows)))
    source = {f"{i}_{j}": (s, i) for i, t, s in docs if i is not None for j in range(len(t.split()))}
    words, times = Counter(), Counter()
    for r in rows:
        own = r.text.split()
        assert 0 < len(own) <= mixing.BLOCK
        named = [source[w] for w in own if w in source]
        assert len({s for s, _ in named}) <= 1  # a block is of one source
        assert [i for _, i in named] == [d for d in r.doc_ids if d is not None for w in own if w.startswith(f"{d}_")]
        words.update(i for _, i in named)
        times.update(r.doc_ids)
    assert words == Counter({r.doc_id: r.taken for r in amounts if r.doc_id is not None and r.taken})
    assert times == Counter({r.doc_id: r.n_blocks for r in amounts if r.n_blocks})
    assert all((r.first_shard is None) == (r.taken == 0) for r in amounts)


def test_a_document_that_is_packed_twice_has_two_rows(spark):
    frame = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "x")], "doc_id long, text string")
    rows = packing.packed(frame, buckets=2, max_words=2, batch_words=4).collect()
    assert len({(r.row, r.piece) for r in rows}) == len(rows) == 7
    assert len({r.row for r in rows if r.doc_id == 1}) == 2
