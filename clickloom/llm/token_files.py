"""Token ids as binary files of compressed planes, with an index of their chunks.

A file holds the ids of its documents one after the other, cut into blocks of a fixed
number of ids. The ids of a block are 32-bit numbers; they are transposed into 4 byte planes
or 32 bit planes, and each plane is a zstandard frame. Small ids leave the upper planes all
zero; such a plane has no bytes. Then follow the index and the tail:

    magic | plane, plane, ... | index (zstandard) | length of the index (8 bytes) | magic

The index holds, as 64-bit little-endian numbers, six of a header (ids per block, planes per
block, blocks, ids, documents, documents without id), the place of each plane of each
block and the end of the last, and the doc_id and number of ids of each document.
Documents without doc_id come first.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import file_system, groups_of
from clickloom.llm.tokens import sliced
from clickloom.session import materialize, scratch_path

MAGIC = b"CLPLANE1"
BLOCK = 1 << 16
END_ID = 1
#: Bytes of text that go to one file.
FILE_BYTES = 32 << 20
#: Strings a worker keeps the ids of.
CACHE = 800_000


def byte_planes(ids: np.ndarray) -> list[bytes]:
    """The 4 bytes of all ids (uint32), lowest first, each in a row."""
    return [row.tobytes() for row in ids.astype("<u4").view(np.uint8).reshape(-1, 4).T]


def bit_planes(ids: np.ndarray) -> list[bytes]:
    """The 32 bits of all ids, lowest first, eight ids to a byte."""
    bits = np.unpackbits(
        ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little"
    )
    return [row.tobytes() for row in np.packbits(bits.T, axis=1, bitorder="little")]


def joined_planes(planes: list[bytes | None], n: int) -> np.ndarray:
    """The ``n`` ids of 4 or 32 planes; None is a plane of zeros."""
    if len(planes) == 4:
        rows = np.zeros((4, n), dtype=np.uint8)
        for row, plane in zip(rows, planes):
            if plane is not None:
                row[:] = np.frombuffer(plane, dtype=np.uint8)
        return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)
    bits = np.zeros((32, n), dtype=np.uint8)
    for row, plane in zip(bits, planes):
        if plane is not None:
            row[:] = np.unpackbits(
                np.frombuffer(plane, dtype=np.uint8), count=n, bitorder="little"
            )
    rows = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).view("<u4").reshape(-1)


PLANES = {"byte": byte_planes, "bit": bit_planes}


class Encoder:
    """Ids of whole texts by a tokenizer that never joins text over white space.

    The blanks space, tab, LF, VT, FF and CR part a text into strings that the tokenizer
    treats by themselves: its normalizer maps characters or composes them with marks, which
    a blank stops, and its words hold no blank. So every different string of a batch is
    encoded once, which is what makes it fast; the ids are those of the whole text. Many
    strings go into one call, with a special token between them that marks the ends of their
    ids; strings that hold its text go by themselves.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().items()
        self.mark = next(
            (
                (number, token.content)
                for number, token in added
                if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word)
            ),
            None,
        )
        # A string's number leads to the place of its ids in the pool.
        self.known: dict[str, int] = {"": 0}
        self.pool = np.zeros(0, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)

    def _alone(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _run(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all strings, how many each has)."""
        number, text = self.mark
        ids = np.array(self._alone([text.join(strings)])[0], dtype=np.uint32)
        marks = ids == number
        ends = np.append(np.flatnonzero(marks), len(ids))
        return ids[~marks], np.diff(ends, prepend=-1) - 1

    def _codes(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of each string, pool, ends in the pool) with all strings in the pool."""
        known = self.known.get
        codes = np.array([known(s, -1) for s in strings], dtype=np.int64)
        missing = np.flatnonzero(codes < 0).tolist()
        odd = [i for i in missing if not self.mark or self.mark[1] in strings[i]]
        if odd:
            missing = sorted(set(missing) - set(odd))
        new = [strings[i] for i in missing]
        runs = [self._run(new[i : i + 4096]) for i in range(0, len(new), 4096)]
        for ids in self._alone([strings[i] for i in odd]):
            runs.append((np.array(ids, dtype=np.uint32), np.array([len(ids)])))
        if not runs:
            return codes, self.pool, self.ends
        first = len(self.ends)
        pool = np.concatenate([self.pool, *[ids for ids, _ in runs]])
        sizes = np.concatenate([counts for _, counts in runs])
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        codes[missing + odd] = np.arange(first, len(ends))
        if len(self.known) < CACHE:
            self.known.update(zip(new + [strings[i] for i in odd], range(first, len(ends))))
            self.pool, self.ends = pool, ends
        return codes, pool, ends

    def encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has), END_ID after each text; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        parts = pc.ascii_split_whitespace(texts)
        words = parts.flatten().dictionary_encode()
        numbers, pool, pool_ends = self._codes(words.dictionary.to_pylist())
        # The end of each text is one more string.
        pool = np.append(pool, np.uint32(END_ID))
        pool_ends = np.append(pool_ends, pool_ends[-1] + 1)
        ends = np.cumsum(parts.value_lengths().to_numpy()).astype(np.int64)
        codes = np.insert(numbers[words.indices.to_numpy()], ends, len(pool_ends) - 1)
        begins = pool_ends[codes - 1] * (codes > 0)
        lengths = pool_ends[codes] - begins
        upto = np.cumsum(lengths)[ends + np.arange(len(ends))] if len(ends) else ends
        out = []
        for i in range(0, len(codes), 1 << 15):  # small enough to stay in the processor's cache
            out.append(pool[_ranges(begins[i : i + (1 << 15)], lengths[i : i + (1 << 15)])])
        return np.concatenate([*out, pool[:0]]), np.diff(upto, prepend=0)


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of the ranges (begin, length), one after the other."""
    some = lengths > 0
    begins, lengths = begins[some], lengths[some]
    if not len(begins):
        return np.zeros(0, dtype=np.int64)
    steps = np.ones(lengths.sum(), dtype=np.int64)
    steps[0] = begins[0]
    steps[np.cumsum(lengths)[:-1]] = begins[1:] - (begins[:-1] + lengths[:-1] - 1)
    return np.cumsum(steps)


def _encoder(path: str) -> Encoder:
    """The encoder of this worker process, with what earlier tasks have encoded."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_clickloom_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


class PlaneWriter:
    """Writes ids block by block, the index at the end."""

    def __init__(self, out, planes: str = "byte", block: int = BLOCK):
        self.out, self.block = out, block
        self.planes, self.width = PLANES[planes], {"byte": 4, "bit": 32}[planes]
        self.compress = zstandard.ZstdCompressor(level=3).compress
        self.rest: list[np.ndarray] = []
        self.waiting = self.ids = self.blocks = 0
        self.places = [len(MAGIC)]
        self.doc_ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.without_id = 0
        out.write(MAGIC)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        """More documents: their ids in a row and how many each has."""
        self.without_id += doc_ids.null_count
        self.doc_ids.append(doc_ids.fill_null(0).to_numpy().astype("<i8"))
        self.counts.append(counts.astype("<i8"))
        self.rest.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= self.block:
            ids = np.concatenate(self.rest)
            whole = len(ids) - len(ids) % self.block
            for i in range(0, whole, self.block):
                self._write(ids[i : i + self.block])
            self.rest, self.waiting = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray) -> None:
        for plane in self.planes(ids):
            data = self.compress(plane) if any(plane) else b""
            self.out.write(data)
            self.places.append(self.places[-1] + len(data))
        self.blocks += 1

    def close(self) -> None:
        if self.waiting:
            self._write(np.concatenate(self.rest))
        docs = np.concatenate([*self.doc_ids, np.zeros(0, "<i8")])
        header = [self.block, self.width, self.blocks, self.ids, len(docs), self.without_id]
        numbers = np.concatenate(
            [np.array(header, "<i8"), np.array(self.places, "<i8"), docs, *self.counts]
        )
        index = self.compress(numbers.tobytes())
        self.out.write(index + len(index).to_bytes(8, "little") + MAGIC)


class PlaneReader:
    """Reads a file of planes: its documents, and any range of ids by the blocks it touches."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        tail = self._bytes(size - 8 - len(MAGIC), 8 + len(MAGIC))
        if tail[8:] != MAGIC or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a file of token planes")
        length = int.from_bytes(tail[:8], "little")
        index = self._bytes(size - len(tail) - length, length)
        numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(index), "<i8")
        self.block, self.width, blocks, self.ids, docs, self.without_id = numbers[:6].tolist()
        end = 6 + blocks * self.width + 1
        self.places = numbers[6:end]
        self.doc_ids, self.counts = numbers[end : end + docs], numbers[end + docs :]

    def _bytes(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def block_ids(self, i: int) -> np.ndarray:
        """All ids of block ``i``."""
        places = self.places[i * self.width : (i + 1) * self.width + 1].tolist()
        data = self._bytes(places[0], places[-1] - places[0])
        n = min(self.block, self.ids - i * self.block)
        planes = []
        for low, high in zip(places, places[1:]):
            frame = data[low - places[0] : high - places[0]]
            planes.append(zstandard.ZstdDecompressor().decompress(frame) if frame else None)
        return joined_planes(planes, n)

    def range(self, start: int, end: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` to before ``end``, a block's at a time."""
        for i in range(start // self.block, -(-end // self.block)):
            low = i * self.block
            yield self.block_ids(i)[max(start - low, 0) : end - low]


def _written(folder: str, tokenizer: str, planes: str, block: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        writer = out = None
        number = TaskContext.get().partitionId()
        # Every attempt writes its own file; the manifest lists those of attempts that ended.
        name = f"part-{number:06d}-{uuid.uuid4().hex}.planes"
        for batch in batches:
            for part in sliced([batch], size=8 << 20):
                if writer is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}")
                    writer, encoder = PlaneWriter(out, planes, block), _encoder(tokenizer)
                writer.add(part.column("doc_id"), *encoder.encoded(part.column("text")))
        if writer is not None:
            writer.close()
            out.close()
            docs = sum(map(len, writer.counts))
            size = system.get_file_info(f"{path}/{name}").size
            row = dict(number=number, file=name, n_docs=docs, n_ids=writer.ids, n_bytes=size)
            yield pa.RecordBatch.from_pylist([row], schema=_MANIFEST_ARROW)

    return run


_MANIFEST = "number long, file string, n_docs long, n_ids long, n_bytes long"
_MANIFEST_ARROW = pa.schema(
    [("number", pa.int64()), ("file", pa.string())]
    + [(name, pa.int64()) for name in ("n_docs", "n_ids", "n_bytes")]
)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, planes: str = "byte", block: int = BLOCK
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``folder``; returns their manifest.

    ``tokenizer`` is a file of the tokenizers library that every executor can read, of a
    kind that ``Encoder`` describes. Documents go by ascending doc_id over the files and
    within them, null ids first, rows of one id by their text; equal rows may lie in several
    files. A null text is empty, and every text ends with END_ID. The manifest has number,
    file, n_docs, n_ids, n_bytes and start, the ids of all files before it; it is a written
    table, so that a file which a lost attempt left behind is in no manifest. ``folder``
    is one that executors share, of a file system that Arrow can open.
    """
    files = groups_of(docs, FILE_BYTES)
    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        text_key.alias("text_key"),
        # Lets a range end between equal rows.
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    )
    sorted_docs = keyed.repartitionByRange(files, "doc_id", "text_key", "salt")
    sorted_docs = sorted_docs.sortWithinPartitions("doc_id", "text_key").select("doc_id", "text")
    manifest = sorted_docs.mapInArrow(_written(folder, tokenizer, planes, block), _MANIFEST)
    return _with_starts(materialize(manifest, "token-manifest"))


def _with_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``start``. Sums run over runs of 1,000 files, then over the runs."""
    manifest = manifest.withColumn("run", F.expr("number div 1000"))
    sums = manifest.groupBy("run").agg(F.sum("n_ids").alias("run_ids"))
    runs = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("run", F.coalesce(F.sum("run_ids").over(runs), F.lit(0)).alias("run_start"))
    inner = Window.partitionBy("run").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_ids").over(inner), F.lit(0))
    return (
        manifest.withColumn("within", within)
        .join(sums, "run")
        .withColumn("start", F.col("run_start") + F.col("within"))
        .drop("run", "within", "run_start")
    )


_DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def _read(folder: str):
    def documents(reader: PlaneReader, start: int) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(reader.counts)
        codes = np.zeros(len(ends), dtype=np.int64)
        doc, at = 0, 0
        for i in range(-(-reader.ids // reader.block)):
            data = memoryview(reader.block_ids(i).tobytes())
            low, high = at, at + len(data) // 4
            while at < high:
                upto = min(int(ends[doc]), high)
                part = data[4 * (at - low) : 4 * (upto - low)]
                codes[doc] = zlib.crc32(part, int(codes[doc]))
                at = upto
                doc += at == ends[doc]
        without = np.arange(len(ends)) < reader.without_id
        columns = [
            pa.array(reader.doc_ids, mask=without),
            pa.array(start + ends - reader.counts),
            pa.array(reader.counts),
            pa.array(codes),
        ]
        whole = pa.RecordBatch.from_arrays(columns, schema=_DOCUMENTS)
        for i in range(0, whole.num_rows, 10_000):
            yield whole.slice(i, 10_000)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{path}/{row['file']}") as source:
                    yield from documents(PlaneReader(source), row["start"])

    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document in the files of ``manifest``.

    One task reads one file, a block at a time.
    """
    files = max(1, manifest.count())
    listed = manifest.select("file", "start").repartition(files)
    return listed.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` written to files of a new shared folder and read back from them."""
    folder = scratch_path(spark, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder)
