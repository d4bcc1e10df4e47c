"""Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from clickloom.llm import (
    embeddings,
    line_quality,
    mixing,
    packing,
    quality,
    sharding,
    shingles,
    substrings,
    toxicity,
    urls,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, shard string,"
    " n_words int, epoch string, kept string, score double, id string, block int, path string"
)
LONG = " ".join(f"w{i % 701}x{i}" for i in range(30_000))
TEXTS = [
    (1, LONG, "s"),
    (2, "", "s"),
    (3, None, None),
    (4, " \t\n ", "s"),
    (None, "a null id with some words of its own", "s"),
    (None, None, None),
    (5, "same words here " * 20, "t"),
    (5, "same words here " * 20, "t"),
    (5, "other words under the same id", None),
    (6, "same words here " * 20, ""),
    (7, "ß ünïcode \x00 wörds \u2003 not a gap 日本", "s"),
    (8, "two words", "s"),
    (9, "two words", "u"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, s, None, 1, "x", 2, "e", None, 0.5, "q", None, "p") for i, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (5, None, None), (6, 0, 0), (7, 1, 1), (8, 1, 0), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


OPERATORS = {
    "lines": lambda d, x: line_quality.quality_verdicts(d),
    "shards": lambda d, x: sharding.sharded_documents(d),
    "passages": lambda d, x: substrings.digests(d),
    "copies": lambda d, x: shingles.near_copies(d),
    "toxicity": lambda d, x: toxicity.toxicity_scores(d, x),
    "mix": lambda d, x: mixing.mixed_amounts(d),
    "quality": lambda d, x: quality.quality_grades(d, x),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(odd, labels, name):
    assert len(OPERATORS[name](odd, labels).collect()) == len(TEXTS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(odd, labels, name):
    assert OPERATORS[name](odd.limit(0), labels.limit(0)).collect() == []


def test_long_text_is_packed_whole(odd):
    rows = [r for r in packing.packed(odd).collect() if r.doc_id == 1]
    assert sum(r.n_words for r in rows) == 30_000
    assert packing.packed(odd.limit(0)).collect() == []


def test_shards_keep_the_columns_given(odd):
    shown = sharding.shard_records(odd.drop("shard"), "doc_id", [1.0, 2.0])
    assert set(odd.columns) <= set(shown.columns)
    assert len({r.shard for r in shown.filter("doc_id IS NULL").collect()}) == 1


def test_copies_of_an_id_that_stays(odd):
    found = shingles.near_copies(odd).collect()
    same = [r for r in found if r.n_links == 2]
    assert sorted(r.doc_id for r in same) == [5, 5, 6]
    assert {r.component_id for r in same} == {5}
    pair = [r for r in found if r.doc_id in (8, 9)]
    assert [(r.class_id, r.n_links) for r in pair] == [(8, 1), (8, 1)]


def test_repeated_rows_lose_their_words(odd):
    found = substrings.digests(odd).filter("doc_id IN (5, 6) AND n_words = 60").collect()
    assert sorted(r.n_removed for r in found) == [57, 60, 60]


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_stages_return_the_columns_of_documents(spark, odd, labels, stage, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, odd.limit(0)):
        out = stage[1](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.collect()


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://A.Net?x#y"), (5, "x://b.net/p#q"), (5, "x://b.net/p#q"), (None, "x://www.c.com/a/?ref=1")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "'k' AS key")
    listed = spark.createDataFrame([("y://c.com/a.html",), (None,)], "url string")
    found = urls.judged(pages, listed).collect()
    got = sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in found)
    assert got == [
        (0, "www.c.com", "/a/", None, "block"),
        (1, "", "", None, "allow"),
        (2, "", "", None, "allow"),
        (3, "", "", None, "allow"),
        (4, "a.net", "", None, "allow"),
        (5, "b.net", "/p", "net/", "block"),
        (5, "b.net", "/p", "net/", "block"),
    ]
    assert urls.judged(pages.limit(0), listed.limit(0)).collect() == []
    assert len(urls.judged(pages, listed.limit(0)).collect()) == len(rows)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, []),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [0.9, 0.3]),
        (12, [-1.0, 0.0]), (None, [0.0, -1.0]), (None, [0.0, -1.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS block", "1 AS size")
    found = {r.vec_id: r for r in embeddings.embedding_links(frame).collect() if r.vec_id}
    assert {i: r.n_links for i, r in found.items() if r.n_links} == {1: 3, 2: 3, 3: 3, 11: 3}
    assert {r.component_id for i, r in found.items() if i in (1, 2, 3, 11)} == {1}
    assert all(r.kept == (i == r.component_id) for i, r in found.items())
    assert embeddings.embedding_links(frame).count() == len(rows)
    assert embeddings.embedding_links(frame.limit(0)).collect() == []
