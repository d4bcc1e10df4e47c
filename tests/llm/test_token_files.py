"""Token files: exact round trips, and ids against encoding each text as a whole."""

from __future__ import annotations

import io
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import token_files
from clickloom.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, start string, n_tokens int, salt int, file string"


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(PATH)


@pytest.mark.parametrize("kind", token_files.PLANES)
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=70))
def test_planes_and_back(kind, values):
    ids = np.array(values, dtype=np.uint32)
    planes = token_files.PLANES[kind](ids)
    assert token_files.joined_planes(planes, len(ids)).tolist() == values
    empty = [plane if any(plane) else None for plane in planes]
    assert token_files.joined_planes(empty, len(ids)).tolist() == values


@pytest.mark.parametrize("kind", token_files.PLANES)
def test_file_and_any_range_of_it(kind):
    rng = np.random.default_rng(3)
    counts = np.array([5, 1, 0, 1_000, 1, 64, 64, 333])
    ids = rng.integers(0, 49_408, counts.sum()).astype(np.uint32)
    out = io.BytesIO()
    writer = token_files.PlaneWriter(out, kind, block=64)
    doc_ids = pa.array([None, 1, 2, 2, 3, 4, 5, 9], pa.int64())
    ends = np.cumsum(counts)
    for low, high in ((0, 3), (3, 4), (4, 8)):  # documents arrive in parts
        first = ends[low] - counts[low]
        writer.add(doc_ids[low:high], ids[first : ends[high - 1]], counts[low:high])
    writer.close()
    reader = token_files.PlaneReader(io.BytesIO(out.getvalue()))
    assert (reader.ids, reader.without_id, reader.counts.tolist()) == (len(ids), 1, counts.tolist())
    assert reader.doc_ids.tolist()[1:] == [1, 2, 2, 3, 4, 5, 9]
    for start, end in ((0, len(ids)), (0, 1), (63, 65), (64, 128), (700, 1_300), (5, 5)):
        got = [*np.concatenate([*reader.range(start, end), np.zeros(0, np.uint32)])]
        assert got == ids[start:end].tolist()
    with pytest.raises(ValueError):
        token_files.PlaneReader(io.BytesIO(out.getvalue()[:-1]))


SPICE = [
    "<|endoftext|>", "<|startoftext|>x", "it's'll", "́", "é", " ", " ", "\x1c",
    "\x85", "İ", "K", "ẞ", "ﬁ", "日本", "🙂", "12 3", "'S", "...!?", "Σας", " ",
]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.text(max_size=30),
            st.lists(
                st.one_of(st.sampled_from([*SPICE, " ", "\n", "\t", "\x0b"]), st.text(max_size=3)),
                max_size=12,
            ).map("".join),
        ),
        min_size=1,
        max_size=6,
    )
)
def test_ids_are_those_of_whole_texts(whole, encoder, texts):
    ids, counts = encoder.encoded(pa.array(texts, pa.string()))
    want = [whole(text) for text in texts]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


LONG = " ".join(f"Word{i % 977} and number {i}," for i in range(40_000))
TEXTS = [
    (9, "The last one."),
    (3, "Same text"),
    (3, "Same text"),
    (3, "Other text under the same id"),
    (1, LONG),
    (2, ""),
    (4, None),
    (5, " \t\n "),
    (None, "No id, some words"),
    (None, None),
    (-7, "A negative id"),
    (2**40, "<|endoftext|> in the text İ"),
]


def _brute(whole, texts):
    """doc_id, start, n_tokens and checksum of documents in order."""
    rows, start = [], 0
    for doc_id, text in texts:
        ids = whole(text)
        code = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        rows.append((doc_id, start, len(ids), code))
        start += len(ids)
    return rows


def _order(spark, texts):
    """The documents in the order the docstring states."""
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    text_key = F.xxhash64(F.coalesce("text", F.lit("")))
    ordered = frame.orderBy(F.col("doc_id").asc_nulls_first(), text_key)
    return [tuple(r) for r in ordered.collect()]


@pytest.mark.parametrize("planes", token_files.PLANES)
@pytest.mark.parametrize("file_bytes", [100_000, 1 << 30])
def test_written_and_read_back(spark, whole, planes, file_bytes, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", file_bytes)
    docs = spark.createDataFrame([(i, t, "x", 1, 2, "f") for i, t in TEXTS], DOCS).repartition(3)
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(docs, folder, PATH, planes, block=1_000)
    found = token_files.read_token_files(manifest, folder).collect()
    got = sorted(tuple(r) for r in found if r.start is not None and r.doc_id is not None)
    want = _brute(whole, _order(spark, TEXTS))
    assert got == sorted(r for r in want if r[0] is not None)
    assert sorted(r[1:] for r in map(tuple, found)) == sorted(r[1:] for r in want)
    files = manifest.collect()
    assert sum(r.n_docs for r in files) == len(TEXTS)
    assert sorted(os.listdir(folder)) == sorted(r.file for r in files)
    for r in files:
        with open(f"{folder}/{r.file}", "rb") as source:
            reader = token_files.PlaneReader(source)
            assert (reader.ids, len(reader.counts)) == (r.n_ids, r.n_docs)
            assert os.path.getsize(source.name) == r.n_bytes


def test_many_documents_over_many_files(spark, whole, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 2_000)
    # A third of the rows have one id, and another third one text.
    texts = [(7, f"same id {i}") if i % 3 == 0 else (i, "same text" if i % 3 == 1 else f"text {i * i}") for i in range(900)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    folder = scratch_path(spark, "token-files")
    manifest = token_files.write_token_files(docs, folder, PATH, block=128)
    assert manifest.count() > 4
    found = token_files.read_token_files(manifest, folder).collect()
    assert sorted(tuple(r) for r in found) == sorted(_brute(whole, _order(spark, texts)))


def test_equal_rows_may_lie_in_several_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 2_000)
    docs = spark.range(0, 2_000, 1, 4).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    manifest = token_files.write_token_files(docs, scratch_path(spark, "token-files"), PATH).collect()
    assert len(manifest) > 4
    assert max(r.n_docs for r in manifest) < 1_000


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert token_files.token_digests(spark, docs, PATH).collect() == []


def test_files_of_lost_attempts_are_not_read(spark, whole):
    """What another attempt left in the folder is in no manifest."""
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, folder, PATH)
    manifest = token_files.write_token_files(docs, folder, PATH)
    assert len(os.listdir(folder)) == 2
    assert [tuple(r) for r in token_files.read_token_files(manifest, folder).collect()] == _brute(
        whole, [(1, "some text")]
    )
