"""Removal of word passages that occur earlier, found by recompression.

Three steps over the same groups of documents, with a shuffle between them:

1. reveal: each group names the high-level interior symbols of its windows of k words
   (see ``recompression``); a symbol that occurs once in the corpus is in no repeat;
2. verify: windows that hold a shared symbol are compared as wholes, by two independent
   64-bit hashes of their words, and the first document of each is found;
3. remove: all windows but the first of each content, by the same hashes, lose their words.

Texts that are equal as wholes are found before: all but the first lose everything, and
only the first takes part in the three steps. So a large group of copies costs little.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from clickloom.llm.common import NULL_ID, groups_of
from clickloom.llm.recompression import window_symbols
from clickloom.llm.tokens import Words, hashed_words, starts_of, windows
from clickloom.session import materialize

WINDOW = 20
_COPY, _SHARED, _REPEATED = 0, 1, 2
#: Words of the texts whose windows are named at once.
_WORDS = 1 << 16


class _Group:
    """The documents of a group in order, and the windows of those that are no copies."""

    def __init__(self, docs: pa.Table, notes: pa.Table, k: int):
        ids = docs.column("_id").to_numpy()
        keys = docs.column("_text").to_numpy()
        # Rows of one id go by text hash; among equal rows the first is the original.
        order = np.lexsort((keys, ids))
        self.docs = docs.take(pa.array(order))
        ids, keys = ids[order], keys[order]
        kind, note_id = notes.column("kind").to_numpy(), notes.column("id").to_numpy()
        self.note, self.note_id = notes.column("value").to_numpy(), note_id
        self.kind = kind
        copies = set(zip(note_id[kind == _COPY].tolist(), self.note[kind == _COPY].tolist()))
        pairs = list(zip(ids.tolist(), keys.tolist()))
        self.copy = np.array(
            [pair in copies or (i > 0 and pairs[i - 1] == pair) for i, pair in enumerate(pairs)],
            dtype=bool,
        )
        self.ids, self.keys = ids, keys
        self.words: Words = hashed_words(self.docs.column("text"))
        self.k = k
        starts = starts_of(self.words, k)
        self.text = self.words.text_of()
        self.starts = starts[~self.copy[self.text[starts]]] if len(starts) else starts

    def values(self, kind: int) -> np.ndarray:
        return np.sort(self.note[self.kind == kind].view(np.uint64))

    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        hashes, first = self.words.hash, self.words.first
        opens = np.zeros(len(hashes), dtype=bool)
        opens[first[:-1][np.diff(first) > 0]] = True
        # Some whole texts at a time, whose numbers stay in a core's cache.
        names, places, low = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        while low < len(hashes):
            high = int(first[np.searchsorted(first[:-1], low + _WORDS)])
            starts = self.starts[slice(*np.searchsorted(self.starts, (low, high)))]
            name, place = window_symbols(hashes[low:high], opens[low:high], starts - low, self.k)
            names.append(name)
            places.append(place + low)
            low = high
        return np.concatenate(names), np.concatenate(places)

    def hashes(self) -> np.ndarray:
        """A hash of each window."""
        return windows(self.words, self.k)[self.starts]

    def second_hashes(self, chosen: np.ndarray) -> np.ndarray:
        """Another hash of the ``chosen`` windows, independent of the first."""
        starts = self.starts[chosen]
        change = np.zeros(len(self.words.hash) + 1, dtype=np.int64)
        change[starts] += 1
        change[starts + self.k] -= 1
        covered = np.cumsum(change[:-1]) > 0
        hashes = self.words.hashes(1, np.flatnonzero(covered))
        return windows(replace(self.words, hash=hashes), self.k)[(np.cumsum(covered) - 1)[starts]]

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of windows that occur in an earlier document of another group."""
        chosen = self.kind == _REPEATED
        return self.note[chosen].view(np.uint64), self.note_id[chosen].view(np.uint64)


def _first_of_each(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of hashes the place of the first equal pair."""
    found, some = np.arange(len(a)), np.flatnonzero(_repeats(a))
    found[some] = some[_first_of_repeats(a[some], b[some])]
    return found


def _repeats(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(values)
    same = np.diff(values[order]) == 0
    out = np.zeros(len(values), dtype=bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _first_of_repeats(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As ``_first_of_each``, where most hashes occur more than once."""
    _, first, inverse = np.unique(a, return_index=True, return_inverse=True)
    found = first[inverse]
    if (b[found] != b).any():  # different windows met in one of the hashes
        order = np.lexsort((b, a))
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        found = np.empty(len(a), dtype=np.int64)
        found[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return found


def _among(a: np.ndarray, b: np.ndarray, known_a: np.ndarray, known_b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) are among the known ones."""
    order = np.argsort(known_a)
    known_a, known_b = known_a[order], known_b[order]
    at, end = np.searchsorted(known_a, a, "left"), np.searchsorted(known_a, a, "right")
    hit = np.zeros(len(a), dtype=bool)
    while (some := at < end).any():  # once, but where known pairs share their first hash
        hit[some] |= known_b[at[some]] == b[some]
        at = at + 1
    return hit


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``known``."""
    found = np.zeros(len(values), dtype=bool)
    if not len(known):
        return found
    # Most values are not known: their first bits already tell most of these.
    bits = min(max(16 * len(known), 1 << 10).bit_length(), 22)
    shift = np.uint64(64 - bits)
    some = np.zeros(1 << bits, dtype=bool)
    some[(known >> shift).view(np.int64)] = True
    maybe = np.flatnonzero(some[(values >> shift).view(np.int64)])
    at = np.minimum(np.searchsorted(known, values[maybe]), len(known) - 1)
    found[maybe] = known[at] == values[maybe]
    return found


def _reveal(k: int):
    def run(key: tuple, docs: pa.Table, notes: pa.Table) -> pa.Table:
        group = _Group(docs, notes, k)
        names, places = group.symbols()
        new = np.ones(len(names), dtype=bool)
        new[1:] = (names[1:] != names[:-1]) | (places[1:] != places[:-1])
        found, count = np.unique(names[new], return_counts=True)
        # A symbol with several places in the group counts as two.
        out = np.concatenate([found, found[count > 1]]).view(np.int64)
        return pa.table(
            {"bucket": pa.array(np.full(len(out), key[0].as_py(), dtype=np.int32)), "name": pa.array(out)}
        )

    return run


def _verify(k: int):
    def run(key: tuple, docs: pa.Table, notes: pa.Table) -> pa.Table:
        group = _Group(docs, notes, k)
        names, _ = group.symbols()
        shared = np.flatnonzero(_within(names, group.values(_SHARED)))
        first, second = group.hashes()[shared], group.second_hashes(shared)
        found = np.unique(_first_of_each(first, second)) if len(shared) else shared
        owner = group.text[group.starts[shared[found]]] if len(shared) else shared
        return pa.table(
            {
                "a": pa.array(first[found].view(np.int64)),
                "b": pa.array(second[found].view(np.int64)),
                "id": pa.array(group.ids[owner]),
                "text": pa.array(group.keys[owner]),
            }
        )

    return run


def _remove(k: int, columns: list[str], schema: pa.Schema, texts: bool):
    def run(key: tuple, docs: pa.Table, notes: pa.Table) -> pa.Table:
        group = _Group(docs, notes, k)
        first = group.hashes()
        known_first, known_second = group.repeated()
        # The second hash decides between windows that agree in the first.
        some = np.flatnonzero(_repeats(first) | _within(first, np.sort(known_first)))
        first, second = first[some], group.second_hashes(some)
        again = _first_of_repeats(first, second) != np.arange(len(first))
        gone = some[again | _among(first, second, known_first, known_second)]
        words = group.words
        change = np.zeros(len(words.hash) + 1, dtype=np.int64)
        starts = group.starts[gone]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + k, -1)
        covered = np.cumsum(change[:-1]) > 0
        count = np.diff(words.first)
        covered |= (group.copy & (count >= k))[group.text]
        totals = np.concatenate([[0], np.cumsum(covered)])
        removed = totals[words.first[1:]] - totals[words.first[:-1]]
        digests, kept_texts = [], []
        data = words.data
        for i, n in enumerate(removed.tolist()):
            text = data[words.offsets[i] : words.offsets[i + 1]].tobytes()
            if n:
                base, a, b = words.offsets[i], words.first[i], words.first[i + 1]
                keep = np.concatenate([[False], ~covered[a:b], [False]]).astype(np.int8)
                edges = np.diff(keep)
                begins, ends = np.flatnonzero(edges == 1) + a, np.flatnonzero(edges == -1) + a - 1
                text = b" ".join(
                    text[x:y]
                    for x, y in zip(
                        (words.start[begins] - base).tolist(), (words.end[ends] - base).tolist()
                    )
                )
            if texts:
                kept_texts.append(text.decode("utf-8", "replace"))
            else:
                digests.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
        out = {
            "_n_words": pa.array(count.astype(np.int64)),
            "_n_removed": pa.array(removed.astype(np.int64)),
        }
        if texts:
            nulls = group.docs.column("text").is_null().to_numpy()
            out["_kept"] = pa.array(kept_texts, pa.string(), mask=nulls & (removed == 0))
        else:
            out["_kept"] = pa.array(digests, pa.string())
        kept = {name: group.docs.column(name) for name in columns}
        return pa.table(kept | out).cast(schema)

    return run


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    texts: bool = False,
    columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``columns``, _n_words, _n_removed and _kept.

    A word goes if a window of ``window`` words over it occurs earlier: in a document of
    smaller doc_id, or in the same one before. ``_kept`` is the SHA-256 of the kept words
    joined by one space or, with ``texts``, the text from which the passages are cut out. A null doc_id is before all others; rows of one doc_id are
    documents in the order of a text hash, and equal rows are copies of the first. Null
    and short texts have no window and stay as they are. Names of ``docs`` that begin with
    an underscore are not allowed.
    """
    groups = groups_of(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        *dict.fromkeys([*columns, "text"]),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(text).alias("_text"),
    )

    def bucket(id_: str, text: str):
        # By the text as well: one id, or none, may be that of very many rows.
        return F.pmod(F.xxhash64(id_, text), F.lit(groups)).cast("int")

    base = base.withColumn("_bucket", bucket("_id", "_text"))

    digests = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.unhex(F.md5(text)).alias("digest"),
        F.xxhash64(text).alias("value"),
    )
    firsts = digests.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    # Stored, so that the join on a very common text is one that can be split.
    firsts = materialize(firsts.filter("n > 1").select("digest", "first"), "equal-texts")
    copies = (
        digests.join(firsts, "digest")
        .filter(F.col("id") > F.col("first"))
        .select(bucket("id", "value").alias("bucket"), F.lit(_COPY).alias("kind"), "id", "value")
    )
    copies = materialize(copies, "copies")
    grouped = base.groupBy("_bucket")

    def notes(rows: DataFrame) -> DataFrame:
        return copies.unionByName(rows.select("bucket", "kind", "id", "value"))

    revealed = grouped.cogroup(copies.groupBy("bucket")).applyInArrow(
        _reveal(window), "bucket int, name long"
    )
    # A name has at most two rows for each group of documents, whatever it occurs.
    shared = revealed.withColumn("n", F.count("*").over(Window.partitionBy("name")))
    shared = shared.filter("n > 1").select("bucket", F.col("name").alias("value")).distinct()
    shared = shared.select("*", F.lit(_SHARED).alias("kind"), F.lit(0).cast("long").alias("id"))
    checked = grouped.cogroup(notes(shared).groupBy("bucket")).applyInArrow(
        _verify(window), "a long, b long, id long, text long"
    )
    own = F.struct("id", "text")
    first = F.min(own).over(Window.partitionBy("a", "b"))
    repeated = checked.withColumn("first", first).filter(own > F.col("first"))
    # A window goes by its two hashes.
    repeated = repeated.select(
        bucket("id", "text").alias("bucket"), F.lit(_REPEATED).alias("kind"),
        F.col("b").alias("id"), F.col("a").alias("value"),
    )
    result = T.StructType(
        [docs.schema[name] for name in columns]
        + [T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType())]
        + [T.StructField("_kept", T.StringType())]
    )
    return grouped.cogroup(notes(repeated).groupBy("bucket")).applyInArrow(
        _remove(window, list(columns), to_arrow_schema(result), texts), result
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``."""
    return without_repeats(docs).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_kept").alias("kept_sha256"),
    )


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut out, and without rows that lost all their words.

    ``n_chars``, where there is one, is counted anew. Rows that had no word stay.
    """
    kept = without_repeats(docs, window, texts=True, columns=tuple(docs.columns))
    kept = kept.filter("_n_removed = 0 OR _n_removed < _n_words").withColumn("text", F.col("_kept"))
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("_n_removed") > 0, count).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
spots AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d),
win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h FROM spots),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i,
          row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM
          (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM rep) GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
cut AS (SELECT doc_id, unnest(ps) AS p FROM gone),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t
         FROM word ANTI JOIN cut USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
