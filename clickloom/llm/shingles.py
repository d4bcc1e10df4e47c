"""Near duplicates by Jaccard similarity of word shingles: a chosen-path join.

Each distinct set of shingles is a class. In each of several independent runs a class
chooses some of its shingles by a hash that all classes share, so that similar sets choose
the same ones. A path begins with a chosen shingle; each further step is the shingle of the
least hash, by another hash for each run and step, so that every set has every step. Classes
on the same path form a bucket. Small buckets are compared as they are, larger ones are split
by a further step of the path. A pair with the least similarity shares a whole path in one
run with a fixed probability, and there are enough runs to reach the recall (``runs_for``).

Buckets compare sketches, so the sets themselves are not copied into buckets. Sketches
only tell which classes to look at together; all pairs of a group found so are then
compared by their whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import NULL_ID
from clickloom.llm.components import components, spanning_forest
from clickloom.llm.tokens import hashed_words, mix, range_hash, sliced, starts_of, windows
from clickloom.llm.urls import bloom_block, bloom_filter, possible
from clickloom.session import materialize

WORDS = 5
JACCARD = 0.8
#: The least probability that a pair of the least similarity shares a path of MAX_STEPS.
RECALL = 0.99999
#: A bucket with more classes is split, at most to paths of MAX_STEPS.
SMALL = 64
MAX_STEPS = 3
LARGE = 8_192
SKETCH = 128
#: Sketches are looked at together if they agree at most so many standard deviations less
#: than sets of the least similarity do on average. Small sets fill few cells, and so get a
#: lower bound.
DEVIATIONS = 5.0
#: Classes that one task compares with each other or with as many others.
BLOCK = 1_024


def runs_for(jaccard: float) -> int:
    """How many runs reach RECALL at the similarity ``jaccard`` where all buckets are split.

    Two sets at that similarity share on average at least one chosen shingle in a run, so
    they share a first step with a probability of at least 1 - exp(-1), and each further
    step with the probability ``jaccard``.
    """
    shared = (1 - math.exp(-1)) * jaccard ** (MAX_STEPS - 1)
    return math.ceil(math.log(1 - RECALL) / math.log(1 - shared))


def _paths(hashes: np.ndarray, owner: np.ndarray, n: np.ndarray, jaccard: float):
    """(numbers of paths by text, the paths of 1 .. MAX_STEPS steps as rows) of sets."""
    filled = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[filled]
    # Each shingle is chosen with a probability of 1 / (jaccard * n), all if that is over 1.
    share = np.minimum(1 / (jaccard * np.maximum(n, 1)), 1 - 2.0**-53)
    limit = (share * 2.0**64).astype(np.uint64)[owner]
    least = np.zeros(len(n), dtype=np.uint64)
    owners, paths = [np.zeros(0, np.int64)], [np.zeros((0, MAX_STEPS), np.uint64)]
    for run in range(runs_for(jaccard) if len(hashes) else 0):
        value = mix(hashes ^ mix(np.uint64([run * MAX_STEPS + 1])))
        chosen = np.flatnonzero(value <= limit)
        own = owner[chosen]
        path = [value[chosen]]
        for step in range(1, MAX_STEPS):
            fresh = mix(hashes ^ mix(np.uint64([run * MAX_STEPS + step + 1])))
            least[filled] = np.minimum.reduceat(fresh, starts)
            path.append(mix(path[-1] + np.uint64(step)) ^ least[own])
        owners.append(own)
        paths.append(np.stack(path, axis=1))
    own = np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return np.bincount(own, minlength=len(n)), np.concatenate(paths)[order]


def _sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes by text, their texts, numbers of words); short texts have one."""
    words = hashed_words(column)
    n = np.diff(words.first)
    text = words.text_of()
    starts = starts_of(words, k)
    hashes, owner = windows(words, k)[starts], text[starts]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = range_hash(words.hash, words.first[short], words.first[short + 1])
        hashes, owner = np.concatenate([hashes, whole]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new], n


def _set_keys(hashes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each set: sums of two mixes of its members, from one end to the next."""
    keys = []
    for salt in (1, 2):
        sums = np.append(np.uint64(0), np.cumsum(mix(hashes ^ mix(np.uint64([salt]))), dtype=np.uint64))
        keys.append(sums[ends[1:]] - sums[ends[:-1]])
    return keys


def _parse(k: int, jaccard: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            hashes, owner, _ = _sets(batch.column("text"), k)
            n = np.bincount(owner, minlength=batch.num_rows)
            key_a, key_b = _set_keys(hashes, np.append(0, np.cumsum(n)))
            path_count, paths = _paths(hashes, owner, n, jaccard)
            offsets = pa.array(np.concatenate([[0], np.cumsum(path_count)]).astype(np.int32))
            steps = [pa.array(np.ascontiguousarray(column).view(np.int64)) for column in paths.T]
            # One permutation: the least hash of each of SKETCH ranges, as a byte; 0 if none.
            sketch = np.zeros((batch.num_rows, SKETCH), dtype=np.uint8)
            if len(hashes):
                value = mix(hashes + np.uint64(13))
                cell = (value % np.uint64(SKETCH)).astype(np.int64) + owner * SKETCH
                order = np.lexsort((value, cell))
                cell, value = cell[order], value[order]
                least = np.append(True, cell[1:] != cell[:-1])
                byte = (mix(value[least]) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
                sketch.reshape(-1)[cell[least]] = byte
            yield pa.record_batch(
                {
                    "id": batch.column("id"),
                    "n": pa.array(n.astype(np.int32)),
                    "key_a": pa.array(key_a.view(np.int64)),
                    "key_b": pa.array(key_b.view(np.int64)),
                    "paths": pa.ListArray.from_arrays(
                        offsets, pa.StructArray.from_arrays(steps, _path_names())
                    ),
                    "sketch": pa.array([row.tobytes() for row in sketch], pa.binary()),
                }
            )

    return run


def _path_names() -> list[str]:
    """The fields of a path: what it is after one step, after two, and so on."""
    return [f"path{step}" for step in range(1, MAX_STEPS + 1)]


def _parsed() -> str:
    path = ", ".join(f"{name}: bigint" for name in _path_names())
    return f"id long, n int, key_a long, key_b long, paths array<struct<{path}>>, sketch binary"


def _alike(a: np.ndarray, b: np.ndarray, jaccard: float) -> np.ndarray:
    """Whether sketch rows agree enough, of the cells that any of both has filled."""
    filled = np.maximum(((a != 0) | (b != 0)).sum(axis=1), 1)
    agreement = ((a == b) & (a != 0)).sum(axis=1) / filled
    return agreement >= jaccard - DEVIATIONS * np.sqrt(jaccard * (1 - jaccard) / filled)


def _bucket_links(rows: pa.Table, jaccard: float) -> tuple[list[int], list[int]]:
    """Links of ids that connect what agrees within each bucket; one part of buckets."""
    rows = rows.sort_by([("path", "ascending"), ("id", "ascending")])
    path, ids = rows.column("path").to_numpy(), rows.column("id").to_numpy()
    sketch = np.frombuffer(
        b"".join(rows.column("sketch").to_pylist()), dtype=np.uint8
    ).reshape(len(ids), SKETCH)
    starts = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
    sizes = np.diff(np.append(starts, len(path)))
    pairs = starts[sizes == 2]
    agree = np.concatenate(
        [
            _alike(sketch[p], sketch[p + 1], jaccard)
            for p in np.array_split(pairs, len(pairs) // 10_000 + 1)
        ]
    )
    pairs = pairs[agree]
    a, b = ids[pairs].tolist(), ids[pairs + 1].tolist()
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own = sketch[start : start + size]
        label = np.arange(size)
        for i in range(size - 1):
            # Only with those that nothing connects with i yet.
            open_ = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
            if not len(open_):
                continue
            near = open_[_alike(own[i][None, :], own[open_], jaccard)]
            for j in near.tolist():
                if label[j] != label[i]:
                    a.append(int(ids[start + i]))
                    b.append(int(ids[start + j]))
                    label[label == label[j]] = label[i]
    return a, b


def _links_of(jaccard: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        a, b = _bucket_links(rows, jaccard) if rows.num_rows else ([], [])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _parts(rows: DataFrame, size, bytes_per_part: int = 4 << 20) -> int:
    """How many parts of about ``bytes_per_part`` the rows make, by the bytes ``size`` of each."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    return max(1, -(-int(total) // bytes_per_part))


def candidate_links(classes: DataFrame, jaccard: float) -> DataFrame:
    """Links (a, b) that connect all classes (id, paths, sketch) worth comparing."""
    names = _path_names()
    paths = classes.select("id", F.explode("paths").alias("p")).select("id", "p.*")
    small, compared = [], []
    for i, name in enumerate(names):
        paths = paths.withColumnRenamed(name, "path")
        sizes = paths.groupBy("path").count().filter("count > 1")
        # Stored, so that a path that very many classes share is a join that can be split.
        sizes = materialize(sizes, "bucket-sizes")
        fits = sizes if name == names[-1] else sizes.filter(F.col("count") <= SMALL)
        compared.append(fits)
        small.append(paths.join(fits, "path").select("path", "id", "count"))
        if name != names[-1]:
            # Every class of a large bucket has a next step, so none drops out here.
            large = paths.join(sizes.filter(F.col("count") > SMALL), "path")
            paths = materialize(large.select("id", *names[i + 1 :]), "paths")
    buckets = small[0]
    for more in small[1:]:
        buckets = buckets.unionByName(more)
    # What is left together after the last step is dealt into blocks, and every pair of
    # blocks is a bucket; below LARGE there is one block.
    blocks = F.ceil(F.col("count") / LARGE).cast("int")
    dealt = buckets.withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("id", "path"), "blocks").cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    dealt = dealt.select("path", "id", "block", others).select(
        F.xxhash64("path", F.least("block", "o"), F.greatest("block", "o")).alias("path"), "id"
    )
    members = dealt.join(classes.select("id", "sketch"), "id")
    parts = _parts(reduce(DataFrame.unionByName, compared), F.col("count") * blocks * 2 * SKETCH)
    members = members.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(parts)).cast("int"))
    found = members.groupBy("part").applyInArrow(_links_of(jaccard), "a long, b long")
    return found.distinct()


def _compare(ids, size, owner, hashes, left: int, jaccard: float, square: bool):
    """Exact links of rows [0, left) with the others, or with each other if ``square``."""
    values, inverse, df = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = df[inverse] > 1
    owner, token = owner[shared], inverse[shared]
    _, token = np.unique(token, return_inverse=True)
    n = len(ids)
    width = 4096
    common = np.zeros((left, n if square else n - left), dtype=np.float32)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    cuts = np.searchsorted(token, np.arange(0, (token[-1] + 1 if len(token) else 0) + width, width))
    for low, high in zip(cuts[:-1], cuts[1:]):
        if low == high:
            continue
        dense = np.zeros((n, width), dtype=np.float32)
        dense[owner[low:high], token[low:high] % width] = 1.0
        common += dense[:left] @ (dense if square else dense[left:]).T
    other = size if square else size[left:]
    union = size[:left, None] + other[None, :] - common
    # Whole numbers below 2**24, so the comparison is exact for jaccard as a fraction.
    close = common.astype(np.float64) >= jaccard * union - 1e-9
    close &= common > 0
    if square:
        np.fill_diagonal(close, False)
    return close


def _exact(jaccard: float):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """All tasks (pairs of blocks of a group) of one part."""
        rows = rows.sort_by([("group", "ascending"), ("x", "ascending"), ("y", "ascending"),
                             ("block", "ascending"), ("id", "ascending")])
        task = np.stack([rows.column(c).to_numpy() for c in ("group", "x", "y")], axis=1)
        block, ids = rows.column("block").to_numpy(), rows.column("id").to_numpy()
        weight = rows.column("copies").to_numpy()
        lists = rows.column("hashes").combine_chunks()
        offsets = np.asarray(lists.offsets)
        flat = np.asarray(lists.values).view(np.uint64)
        starts = np.flatnonzero(np.append(True, (task[1:] != task[:-1]).any(axis=1)))
        out = {"id": [], "n": [], "to": []}

        def tell(i, n, to):
            out["id"].append(i)
            out["n"].append(n)
            out["to"].append(to)

        for low, high in zip(starts, np.append(starts[1:], len(ids))):
            square = task[low, 1] == task[low, 2]
            left = high - low if square else int((block[low:high] == task[low, 1]).sum())
            size = (offsets[low + 1 : high + 1] - offsets[low:high]).astype(np.int64)
            owner = np.repeat(np.arange(high - low), size)
            hashes = flat[offsets[low] : offsets[high]]
            own, w = ids[low:high], weight[low:high]
            close = _compare(own, size, owner, hashes, left, jaccard, square)
            other = slice(0, None) if square else slice(left, None)
            tell(own[:left], close @ w[other], own[:left])
            if not square:
                tell(own[left:], w[:left] @ close, own[left:])
            links = spanning_forest(close, bool(square))
            if links:
                a, b = np.array(links).T
                tell(own[a], np.zeros(len(a), np.int64), own[b])
        return pa.table(
            {
                k: pa.array(np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64))
                for k, v in out.items()
            }
        )

    return run


def _wanted_sets(k: int, table: np.ndarray):
    """The sets of the rows whose id may be in the Bloom filter ``table``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            blocks = batch.column("block").to_numpy()
            hit = possible(blocks, batch.column("key").to_numpy(), table)
            rows = batch.filter(pa.array(hit))
            if not rows.num_rows:
                continue
            hashes, owner, _ = _sets(rows.column("text"), k)
            ends = np.searchsorted(owner, np.arange(rows.num_rows + 1))
            key_a, key_b = _set_keys(hashes, ends)
            lists = pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64))
            )
            yield pa.record_batch(
                {
                    "doc": rows.column("id"),
                    "key_a": pa.array(key_a.view(np.int64)),
                    "key_b": pa.array(key_b.view(np.int64)),
                    "hashes": lists,
                }
            )

    return run


def near_copies(docs: DataFrame, k: int = WORDS, jaccard: float = JACCARD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, class_id, n_links, component_id, kept.

    Documents with equal sets of shingles are one class, named by its smallest doc_id.
    ``n_links`` counts the other documents, of the class or another, with a Jaccard
    similarity of at least ``jaccard``; ``component_id`` is the smallest doc_id reachable by
    such links, and the document of that id is ``kept``. A text of fewer than ``k`` words
    has all its words as its only shingle; one without words, or null, has no links and is
    a class of its own. A null doc_id is before all others, and is null in the results;
    of rows with one doc_id each is a document, and all of a kept doc_id are kept.
    """
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "text"
    )
    parsed = materialize(rows.select("id", "text").mapInArrow(_parse(k, jaccard), _parsed()), "shingles")
    firsts = (
        parsed.filter("n > 0")
        .groupBy("key_a", "key_b", "n")
        .agg(F.min("id").alias("class"), F.count("*").alias("copies"))
    )
    # Stored, so that a very large class is a join that can be split.
    # From here on a class goes by its number, fixed in the written table.
    firsts = materialize(firsts.withColumn("number", F.monotonically_increasing_id()), "classes")
    one = parsed.join(firsts, ["key_a", "key_b", "n"]).filter("id = class")
    classes = one.select(
        F.col("number").alias("id"), "class", "copies", "key_a", "key_b", "n", "paths", "sketch"
    )
    classes = materialize(classes.dropDuplicates(["id"]), "class-shingles")
    groups = components(candidate_links(classes, jaccard)).withColumnRenamed("component", "group")

    # Blocks of each group, and the tasks that compare each block with itself and others.
    # Counted apart and stored, so that a very large group is a join that can be split.
    groups = materialize(groups, "candidate-groups")
    counted = groups.groupBy("group").agg(F.count("*").alias("count"))
    sized = groups.join(materialize(counted, "group-sizes"), "group")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    dealt = sized.select(
        "id", "group", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block")
    )
    own = classes.select("id", "class", "copies", "key_a", "key_b", "n")
    dealt = materialize(dealt.join(own, "id"), "groups")
    # Most documents are in no group. A Bloom filter of bounded size keeps their texts out of
    # the join; what it lets through by mistake meets no row there.
    table = bloom_filter(dealt.select(F.xxhash64("class").alias("key")))
    key = F.xxhash64("id")
    texts = rows.select("id", "text", key.alias("key"), bloom_block(key, len(table)).alias("block"))
    found = texts.mapInArrow(_wanted_sets(k, table), "doc long, key_a long, key_b long, hashes array<long>")
    # The same join at every size: by its few ids the other side would seem small.
    sets = (
        found.hint("merge")
        .join(dealt.withColumnRenamed("class", "doc"), ["key_a", "key_b", "doc"])
        .dropDuplicates(["id"])
    )
    against = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    spread = sets.select("*", against).select(
        "id", "group", "block", "copies", "hashes",
        F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"),
    )
    parts = _parts(dealt, F.col("n") * 8 * F.col("blocks"))
    part = F.pmod(F.xxhash64("group", "x", "y"), F.lit(parts)).cast("int")
    linked = spread.withColumn("part", part).groupBy("part").applyInArrow(
        _exact(jaccard), "id long, n long, to long"
    )
    linked = materialize(linked, "set-links")
    counts = linked.groupBy(F.col("id").alias("number")).agg(F.sum("n").alias("links"))
    joined = components(linked.filter("id <> to").select(F.col("id").alias("a"), F.col("to").alias("b")))
    joined = joined.withColumnRenamed("id", "number")
    names = joined.join(firsts.select("number", "class"), "number").groupBy("component")
    # Stored, so that a very large component is a join that can be split.
    names = materialize(names.agg(F.min("class").alias("smallest")), "component-names")
    facts = (
        firsts.join(counts, "number", "left")
        .join(joined.join(names, "component").select("number", "smallest"), "number", "left")
        .select(
            "key_a", "key_b", "n", "class",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("smallest", "class").alias("component"),
        )
    )
    facts = materialize(facts, "set-facts")
    every = parsed.select("id", "key_a", "key_b", "n").join(facts, ["key_a", "key_b", "n"], "left")
    own = F.coalesce("component", "id")

    def shown(value):
        return F.when(value != NULL_ID, value)

    return every.select(
        shown(F.col("id")).alias("doc_id"),
        shown(F.coalesce("class", "id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        shown(own).alias("component_id"),
        (F.col("id") == own).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near copies: that of the smallest doc_id.

    Rows of one doc_id that is kept all stay.
    """
    gone = near_copies(docs.select("doc_id", "text")).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


ORACLE_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {WORDS - 1}], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 2}, 2))) AS i FROM d
            WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
          FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b, c = m.n AND c = o.n AS equal FROM pairs
          JOIN size m ON m.doc_id = a JOIN size o ON o.doc_id = b
          WHERE 5 * c >= 4 * (m.n + o.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d
          UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
class AS (SELECT doc_id, least(doc_id, (SELECT min(b) FROM links WHERE a = doc_id AND equal)) AS class_id
          FROM d)
SELECT doc_id, class_id, (SELECT count(*) FROM links WHERE links.a = doc_id) AS n_links,
  component_id, doc_id = component_id AS kept
FROM class JOIN least ON a = doc_id
"""
