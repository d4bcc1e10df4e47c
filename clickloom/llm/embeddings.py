"""Near duplicates among embeddings: an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clickloom.llm.common import NULL_ID, file_system
from clickloom.llm.components import components, forest, spanning_forest
from clickloom.session import materialize, scratch_path

COSINE = 0.9
#: Leading principal dimensions of the grid.
DIMENSIONS = 6
#: Leading principal dimensions that bound a cosine, at most.
BOUND_DIMENSIONS = 64
#: Vectors that the principal dimensions are fitted on, at most; all vectors are joined.
SAMPLE_ROWS = 4_096
#: Vectors of a block, and their bytes, at most.
BLOCK = 4_096
BLOCK_BYTES = 1 << 20
#: Blocks on each side of a task, at most, and tasks that are wanted before they get larger.
PARTNERS = 32
TASKS = 256
#: Vectors of a block that are compared in one step.
STRIP = 512
#: Links that a task keeps before it makes a forest of them.
_LINKS = 1 << 20
#: Children of a node of the interval tree.
_FAN = 8

_ROWS = pa.schema(
    [("dim", pa.int32()), *[(name, pa.int64()) for name in ("cell", "h", "g", "id", "size")], ("v", pa.binary())]
)
_PACKED = pa.schema(
    [
        ("start", pa.int64()),
        ("dim", pa.int32()),
        *[(name, pa.list_(pa.int64())) for name in ("h", "g", "id", "size")],
        *[(name, pa.list_(pa.float64())) for name in ("lo", "hi")],
        ("v", pa.binary()),
    ]
)


def principal_axes(sample: pa.Array, cosine: float = COSINE) -> dict[int, np.ndarray]:
    """For each length of vector as many leading principal axes of the unit vectors as pay.

    Further axes make the bound of a cosine closer and dearer; the pairs of the sample
    show how many are left to compare.
    """
    lengths = pc.list_value_length(sample).to_numpy(zero_copy_only=False)
    axes = {}
    for size in np.unique(lengths).tolist():
        x = _unit(_matrix(sample.filter(pa.array(lengths == size))))[0]
        _, basis = np.linalg.eigh(np.cov(x.T).reshape(size, size) if len(x) > 1 else np.eye(size))
        basis = basis[:, ::-1][:, :BOUND_DIMENSIONS]
        half = min(len(x) // 2, 1_024)
        costs = {}
        for k in (k for k in (8, 16, 24, 32, 48, 64) if k < min(size, BOUND_DIMENSIONS)):
            bounds = _bounding(x[: 2 * half] @ basis[:, :k])
            left = (bounds[:half] @ bounds[half:].T >= cosine).mean() if half else 1.0
            costs[k] = 0.5 + 0.033 * k + left * (50 + 2 * size)
        whole = min(size, BOUND_DIMENSIONS)
        costs[whole] = 0.5 + 0.033 * whole
        axes[size] = np.ascontiguousarray(basis[:, : min(costs, key=costs.get)])
    return axes


def _axes_of(axes: dict[int, np.ndarray], size: int) -> np.ndarray:
    """Axes of vectors of one length; a length that the sample lacks has its first coordinates."""
    found = axes.get(size)
    return np.eye(size, min(size, DIMENSIONS)) if found is None else found


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    n = len(column)
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(n, -1)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1 and the lengths; zeros where a length is not a positive number.

    Sums go column by column, so that equal vectors get equal results wherever they stand.
    """
    x = x.astype(np.float64)
    squares = np.zeros(len(x))
    with np.errstate(all="ignore"):
        for column in x.T:
            squares += column * column
        norm = np.sqrt(squares)
        good = (norm > 0) & np.isfinite(norm)
        return np.where(good[:, None], x / norm[:, None], 0.0), norm


def _grid_points(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Places on the leading axes, equal for equal vectors (see ``_unit``)."""
    unit, _ = _unit(x)
    points = np.zeros((len(x), DIMENSIONS))
    basis = basis[:, :DIMENSIONS]
    for column, weights in zip(unit.T, basis):
        points[:, : basis.shape[1]] += column[:, None] * weights[None, :]
    return points


def _bounding(points: np.ndarray) -> np.ndarray:
    """Rows whose products are no less than the cosines, but for rounding.

    ``points`` are places of unit vectors on the leading axes. The last column is the length of
    what the axes leave out: the product of two remainders is at most that of their lengths.
    """
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", points, points)))
    return np.column_stack([points, rest]).astype(np.float32)


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _placed(axes: dict[int, np.ndarray], reach: float) -> Callable:
    """One row of each class of a batch, with its cell of the grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h, g, ids = (batch.column(name).to_numpy() for name in ("h", "g", "id"))
            order = np.lexsort((ids, g, h))
            first = _edges(h[order], g[order])
            sizes = np.diff(np.append(first, len(order)))
            rows = order[first]
            vectors = batch.column("v").take(pa.array(rows))
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                x = np.ascontiguousarray(_matrix(vectors.take(pa.array(at))))
                cells = np.floor(_grid_points(x, _axes_of(axes, size)) / reach)
                # The order alone goes by the cells: far ones may share a number.
                cells = np.clip(cells, -512, 511).astype(np.int64) + 512
                cell = np.zeros(len(at), dtype=np.int64)
                for c in cells.T:
                    cell = cell << 10 | c
                width = x.itemsize * size
                data = x.tobytes()
                own = rows[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), size, dtype=np.int32)), pa.array(cell), pa.array(h[own]),
                        pa.array(g[own]), pa.array(ids[own]), pa.array(sizes[at].astype(np.int64)),
                        pa.array([data[i * width : (i + 1) * width] for i in range(len(at))], pa.binary()),
                    ],
                    schema=_ROWS,
                )

    return run


def _packed(axes: dict[int, np.ndarray], kind: str, most: int, most_bytes: int) -> Callable:
    """Blocks of classes that follow each other in the order, with their boxes.

    A block ends where a partition or a length of vector ends. A class goes by its number:
    ``start`` of its block and its place in it.
    """
    item = np.dtype(kind).itemsize

    def merged(rows: pa.Table) -> pa.Table:
        first = _edges(*(rows.column(name).to_numpy() for name in ("dim", "h", "g")))
        if len(first) == rows.num_rows:
            return rows
        ids = np.minimum.reduceat(rows.column("id").to_numpy(), first)
        sizes = np.add.reduceat(rows.column("size").to_numpy(), first)
        kept = rows.take(pa.array(first))
        for name, values in (("id", ids), ("size", sizes)):
            kept = kept.set_column(kept.schema.get_field_index(name), name, pa.array(values))
        return kept

    def block(rows: pa.Table, start: int) -> pa.RecordBatch:
        size = rows.column("dim")[0].as_py()
        data = b"".join(rows.column("v").to_pylist())
        points = _grid_points(np.frombuffer(data, kind).reshape(-1, size), _axes_of(axes, size))
        values = [start, size, *(rows.column(name).to_numpy() for name in ("h", "g", "id", "size"))]
        values += [points.min(axis=0), points.max(axis=0), data]
        arrays = [pa.array([value], field.type) for value, field in zip(values, _PACKED)]
        return pa.RecordBatch.from_arrays(arrays, schema=_PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = TaskContext.get().partitionId() << 33
        rest = _ROWS.empty_table()
        for batch in chain(batches, [None]):
            if batch is not None:
                rest = pa.concat_tables([rest, pa.Table.from_batches([batch]).cast(_ROWS)])
            if not rest.num_rows:
                continue
            rest = merged(rest).combine_chunks()
            n = rest.num_rows
            dims = rest.column("dim").to_numpy()
            at = 0
            for end in np.append(_edges(dims)[1:], n).tolist():
                step = max(1, min(most, most_bytes // max(1, int(dims[at]) * item)))
                # The last class of a batch may go on in the next one.
                while at < end and (at + step < n or batch is None or end < n):
                    part = rest.slice(at, min(step, end - at))
                    yield block(part, start)
                    start += part.num_rows
                    at += part.num_rows
            rest = rest.slice(at)

    return run


@lru_cache(maxsize=4)
def _places(folder: str) -> dict[int, tuple[str, int, int, int]]:
    """File, row, start and length of vectors of each block, from the table of blocks."""
    system, path = file_system(folder)
    places = {}
    for info in system.get_file_info(fs.FileSelector(path)):
        if info.is_file and info.base_name.startswith("part-"):
            with system.open_input_file(info.path) as source:
                table = pq.ParquetFile(source).read(["block", "file", "row", "start", "dim"])
            columns = (table.column(i).to_pylist() for i in range(5))
            places.update((b, place) for b, *place in zip(*columns))
    return places


class _Block:
    """The vectors of a block, what bounds their cosines, and the boxes of its strips."""

    def __init__(self, x: np.ndarray, size: np.ndarray, start: int, basis: np.ndarray):
        self.x, self.size, self.start = x, size, start
        wide = x.astype(np.float64)
        with np.errstate(all="ignore"):
            self.norm = np.sqrt(np.einsum("ij,ij->i", wide, wide))
            p = (wide @ basis) / self.norm[:, None]
        # A length beyond double precision has no cosine.
        self.bounding = _bounding(np.where(np.isfinite(p), p, 0.0))
        strips = np.arange(0, len(x), STRIP)
        points = self.bounding[:, :-1][:, :DIMENSIONS]
        self.low, self.high = (f.reduceat(points, strips, axis=0) for f in (np.minimum, np.maximum))
        self.counts = np.zeros(len(x))


class _Blocks:
    """Reads blocks of the written grid order."""

    def __init__(self, folder: str, index: str, axes: dict[int, np.ndarray], kind: str):
        self.system, self.path = file_system(folder)
        self.places, self.axes, self.kind = _places(index), axes, kind
        self.files: dict[str, tuple[pq.ParquetFile, np.ndarray]] = {}

    def dim(self, block: int) -> int:
        return self.places[block][3]

    def read(self, block: int) -> _Block:
        name, row, start, dim = self.places[block]
        if name not in self.files:
            file = pq.ParquetFile(self.system.open_input_file(f"{self.path}/{name}"))
            groups = [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)]
            self.files[name] = file, np.cumsum([0, *groups])
        file, starts = self.files[name]
        group = int(np.searchsorted(starts, row, side="right")) - 1
        table = file.read_row_group(group, columns=["size", "v"]).slice(row - int(starts[group]), 1)
        x = np.frombuffer(table.column("v")[0].as_buffer(), self.kind).reshape(-1, dim)
        size = table.column("size").chunk(0).flatten().to_numpy()
        return _Block(x, size, start, _axes_of(self.axes, dim))

    def close(self) -> None:
        for file, _ in self.files.values():
            file.close(force=True)


def _close_pairs(a: _Block, i: slice, b: _Block, j: slice, hits: np.ndarray, cosine: float):
    """Those of the pairs ``hits`` (row, column) whose cosine in double precision is large enough."""
    rows, columns = hits
    xa, xb, na, nb = a.x[i], b.x[j], a.norm[i], b.norm[j]
    if len(rows) * 8 > len(xa) * len(xb):
        wanted = np.zeros((len(xa), len(xb)), dtype=bool)
        wanted[rows, columns] = True
        cosines = (xa.astype(np.float64) @ xb.astype(np.float64).T) / (na[:, None] * nb[None, :])
        return np.nonzero(wanted & (cosines >= cosine))
    step = max(1, (1 << 21) // xa.shape[1])
    good = [np.zeros(0, dtype=bool)]
    for at in range(0, len(rows), step):
        r, c = rows[at : at + step], columns[at : at + step]
        dots = np.einsum("ij,ij->i", xa[r].astype(np.float64), xb[c].astype(np.float64))
        good.append(dots / (na[r] * nb[c]) >= cosine)
    good = np.concatenate(good)
    return rows[good], columns[good]


def _hits(mask: np.ndarray) -> np.ndarray:
    """Where a flat mask is true; few places are found by eights."""
    flat = mask.reshape(-1)
    if len(flat) % 8:
        return np.flatnonzero(flat)
    some = np.flatnonzero(flat.view(np.uint64) != 0)
    eight, place = np.nonzero(flat.reshape(-1, 8)[some])
    return some[eight] * 8 + place


def _join_pair(a: _Block, b: _Block, cosine: float, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts the links of two blocks, and gives links that connect what these do, as numbers."""
    k = a.bounding.shape[1]
    # More than single precision can take from a bound.
    slack = (k + 8) * 2.4e-7
    gaps = np.maximum(a.low[:, None] - b.high[None], b.low[None] - a.high[:, None]).clip(0)
    near = (gaps.astype(np.float64) ** 2).sum(axis=2) <= (reach + slack) ** 2
    if a is b:
        near = np.triu(near)
    for s, t in zip(*np.nonzero(near)):
        i, j = (slice(int(n) * STRIP, (int(n) + 1) * STRIP) for n in (s, t))
        mask = a.bounding[i] @ b.bounding[j].T >= cosine - slack
        if not mask.any():
            continue
        height, width = mask.shape
        rows, columns = np.divmod(_hits(mask), width)
        own = a is b and s == t
        if own:
            once = rows < columns
            rows, columns = rows[once], columns[once]
        with np.errstate(all="ignore"):
            rows, columns = _close_pairs(a, i, b, j, (rows, columns), cosine)
        if not len(rows):
            continue
        a.counts[i] += np.bincount(rows, weights=b.size[j][columns], minlength=height)
        b.counts[j] += np.bincount(columns, weights=a.size[i][rows], minlength=width)
        if len(rows) > height + width:
            mask = np.zeros((height, width), dtype=bool)
            mask[rows, columns] = True
            names = np.concatenate([np.arange(height) + a.start + i.start, np.arange(width) + b.start + j.start])
            x, y = np.array(spanning_forest(mask, own)).T
            yield names[x], names[y]
        else:
            yield rows + (a.start + i.start), columns + (b.start + j.start)


def _join_blocks(
    cosine: float, reach: float, axes: dict[int, np.ndarray], kind: str, folder: str, index: str
) -> Callable:
    """Joins the pairs of blocks of each task; blocks are read from the written order."""

    def joined(blocks: _Blocks, pairs: list[dict[str, int]]) -> pa.RecordBatch:
        partners: dict[int, list[int]] = {}
        for pair in pairs:
            if blocks.dim(pair["a"]) == blocks.dim(pair["b"]):
                partners.setdefault(pair["b"], []).append(pair["a"])
        left: dict[int, _Block] = {}
        ids, counts, ends = [], [], [(np.zeros(0, dtype=np.int64),) * 2]
        kept = 0

        def count(block: _Block) -> None:
            hit = np.flatnonzero(block.counts)
            ids.append(hit + block.start)
            counts.append(block.counts[hit].astype(np.int64))
            block.counts[:] = 0

        for number in sorted(partners):
            b = left[number] if number in left else blocks.read(number)
            for partner in partners[number]:
                if partner == number:
                    left.setdefault(number, b)
                elif partner not in left:
                    left[partner] = blocks.read(partner)
                for link in _join_pair(left[partner], b, cosine, reach):
                    ends.append(link)
                    kept += len(link[0])
                if kept > _LINKS:
                    ends = [forest(*map(np.concatenate, zip(*ends)))]
                    kept = 0
            if number not in left:
                count(b)
        for block in left.values():
            count(block)
        x, y = forest(*map(np.concatenate, zip(*ends)))
        ids, counts = np.concatenate([*ids, x]), np.concatenate([*counts, np.zeros(len(x), dtype=np.int64)])
        to = np.concatenate([ids[: len(ids) - len(x)], y])
        arrays = [pa.array(values.astype(np.int64)) for values in (ids, counts, to)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "n", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        try:
            for batch in batches:
                for pairs in batch.column("pairs"):
                    blocks = blocks or _Blocks(folder, index, axes, kind)
                    out = joined(blocks, pairs.as_py())
                    for at in range(0, out.num_rows, 1 << 16):
                        yield out.slice(at, 1 << 16)
        finally:
            if blocks:
                blocks.close()

    return run


def _box_columns() -> list[str]:
    return [f"{side}{i}" for i in range(DIMENSIONS) for side in ("lo", "hi")]


def _distance(left: str, right: str):
    """Square of the least distance of two boxes."""
    total = F.lit(0.0)
    for i in range(DIMENSIONS):
        gap = F.greatest(
            F.col(f"{left}.lo{i}") - F.col(f"{right}.hi{i}"),
            F.col(f"{right}.lo{i}") - F.col(f"{left}.hi{i}"),
            F.lit(0.0),
        )
        total = total + gap * gap
    return total


def block_pairs(boxes: DataFrame, blocks: int, reach: float) -> DataFrame:
    """(a, b), a <= b, of the blocks whose boxes come within ``reach``.

    The blocks 0 to blocks - 1 are leaves of a tree of intervals of the grid order. From
    the whole sequence down, a pair of intervals gives the pairs of their parts, without
    those whose boxes are farther apart: the vectors in them cannot be close.
    """
    spark = boxes.sparkSession
    depth = 0
    while _FAN**depth < blocks:
        depth += 1
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for level in range(depth - 1, -1, -1):
        width = _FAN**level
        bounds = [
            (F.min if name.startswith("lo") else F.max)(name).alias(name) for name in _box_columns()
        ]
        nodes = boxes.groupBy(F.expr(f"block div {width}").alias("node")).agg(*bounds)
        parts = F.sequence(F.lit(0).cast("long"), F.lit(_FAN - 1).cast("long"))
        split = pairs.select(
            "b", F.explode(F.transform(parts, lambda p: F.col("a") * _FAN + p)).alias("a")
        ).select("a", F.explode(F.transform(parts, lambda p: F.col("b") * _FAN + p)).alias("b"))
        near = (
            split.filter("a <= b")
            .join(nodes.alias("l"), F.col("a") == F.col("l.node"))
            .join(nodes.alias("r"), F.col("b") == F.col("r.node"))
            .filter(_distance("l", "r") <= reach * reach)
            .select("a", "b")
        )
        pairs = materialize(near, "block-pairs")
    return pairs


def embedding_links(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    Unit vectors with a cosine of at least c are at most sqrt(2 - 2 c) apart, also in a
    projection. Equal vectors are one class, counted by its rows. The classes are sorted by
    grid cells of that size on the leading principal dimensions and written as blocks of
    consecutive ones; ``block_pairs`` finds the pairs of blocks to compare. Tasks get the
    numbers of such pairs and read the blocks, so that no vector is shuffled once for each
    block it is compared with. A product in single precision on the leading dimensions that is
    no less than the cosine tells which pairs to compare by cosines in double precision.
    Links are counted where they are found and only a spanning forest of a task is passed
    on. Vectors that are null, empty or zero, or hold nulls
    or non-finite numbers, have no links; neither have vectors of different lengths. A null
    vec_id stands before all others. Rows of one vec_id, or of none, are vectors of their own
    each. Other columns are ignored.
    """
    spark = vectors.sparkSession
    reach = float(np.sqrt(2.0 - 2.0 * cosine)) + 1e-9
    v = F.transform("embedding", lambda x: x.cast("double"))
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "float32" if single else "float64"
    sound = F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                          F.col("vec_id"), F.col("embedding"), v.alias("v"))
    rows = rows.withColumn("sound", sound)
    keyed = rows.withColumn(
        "class", F.when(F.col("sound"), F.struct(F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g")))
    )
    # Numbers of single precision are kept in it.
    stored = F.col("embedding" if single else "v").alias("v")
    whole = keyed.filter("sound").select("class", "id", stored)
    drawn = whole.select("class").distinct().orderBy("class").limit(SAMPLE_ROWS)
    sample = whole.join(F.broadcast(drawn), "class", "left_semi").groupBy("class").agg(F.first("v").alias("v"))
    axes = principal_axes(sample.orderBy("class").select("v").toArrow().column("v").combine_chunks(), cosine)
    placed = whole.select("class.h", "class.g", "id", "v").mapInArrow(
        _placed(axes, reach), "dim int, cell long, h long, g long, id long, size long, v binary"
    )
    # All rows of a class come to one range, where they are neighbours.
    order = ["dim", "cell", "h", "g"]
    packed = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _packed(axes, kind, BLOCK, BLOCK_BYTES),
        "start long, dim int, h array<long>, g array<long>, id array<long>, size array<long>, "
        "lo array<double>, hi array<double>, v binary",
    )
    folder = scratch_path(spark, "grid-order")
    # A row group for each block, so that a block is read alone.
    packed.write.options(**{"compression": "zstd", "parquet.block.row.count.limit": "1"}).parquet(folder)
    ordered = spark.read.schema(packed.schema).parquet(folder)
    # A class goes by its number, fixed in the written table: several may have one vec_id.
    members = ordered.select("start", F.posexplode(F.arrays_zip("h", "g", "id", "size")).alias("at", "c"))
    classes = members.select(
        F.struct("c.h", "c.g").alias("class"),
        (F.col("start") + F.col("at")).alias("number"),
        "c.id",
        "c.size",
    )
    boxes = ordered.select(
        "start",
        "dim",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        *[F.get(side, F.lit(i)).alias(f"{side}{i}") for i in range(DIMENSIONS) for side in ("lo", "hi")],
    )
    index = scratch_path(spark, "blocks")
    boxes = boxes.withColumn("block", (F.row_number().over(Window.orderBy("start")) - 1).cast("long"))
    boxes.write.option("compression", "zstd").parquet(index)
    numbered = spark.read.schema(boxes.schema).parquet(index)
    blocks = numbered.count()
    found = block_pairs(numbered.select("block", *_box_columns()), blocks, reach) if blocks else None
    if found is None:
        found = spark.createDataFrame([], "a long, b long")
    # Large tasks read less and pass on less; few blocks make small tasks, for all cores.
    side = max(1, min(PARTNERS, int((found.count() / TASKS) ** 0.5)))
    tasks = found.groupBy(F.expr(f"a div {side}").alias("left"), F.expr(f"b div {side}").alias("right")).agg(
        F.collect_list(F.struct("a", "b")).alias("pairs")
    )
    tasks = materialize(tasks.select("pairs"), "block-tasks")
    count = tasks.count()
    linked = tasks.repartition(max(1, min(count, 64), count // 4)).mapInArrow(
        _join_blocks(cosine, reach, axes, kind, folder, index), "id long, n long, to long"
    )
    linked = materialize(linked, "vector-links")
    counts = linked.groupBy(F.col("id").alias("number")).agg(F.sum("n").alias("n"))
    groups = components(linked.filter("id <> to").select(F.col("id").alias("a"), F.col("to").alias("b")))
    groups = groups.withColumnRenamed("id", "number")
    smallest = (
        groups.join(classes.select("number", "id"), "number")
        .groupBy("component")
        .agg(F.min("id").alias("smallest"))
    )
    # Stored, so that a very large component is a join that can be split.
    smallest = materialize(smallest, "component-ids")
    facts = (
        classes.select("class", "number", "id", "size")
        .join(counts, "number", "left")
        .join(groups.join(smallest, "component"), "number", "left")
        .select(
            "class",
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("smallest", "id").alias("component_id"),
        )
    )
    facts = materialize(facts, "vector-facts")
    every = keyed.select("id", "vec_id", "class").join(facts, "class", "left")
    component = F.coalesce("component_id", "id")
    return every.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(component != NULL_ID, component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
           FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
      WHERE len(e) > 0 AND list_dot_product(e, e) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.vec_id <> y.vec_id
          AND list_dot_product(x.e, y.e) / (x.n * y.n) >= {COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v
          UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, component_id,
  vec_id = component_id AS kept
FROM v JOIN least ON a = vec_id
"""
