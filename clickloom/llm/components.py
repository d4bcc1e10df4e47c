"""Connected components of a graph of links, by rounds of contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialize


def spanning_forest(mask: np.ndarray, square: bool) -> list[tuple[int, int]]:
    """Links (row node, other node) that connect what ``mask`` connects; columns follow rows."""
    rows, columns = mask.shape
    shift = 0 if square else rows
    label = np.arange(rows + columns)
    big = rows + columns
    row_some, column_some = mask.any(axis=1), mask.any(axis=0)
    r, c = np.flatnonzero(row_some), np.flatnonzero(column_some)
    if not len(r):
        return []
    small = mask[np.ix_(r, c)]
    while True:
        before = label.copy()
        label[r] = np.minimum(label[r], np.where(small, label[c + shift][None, :], big).min(axis=1))
        at = np.minimum(
            label[c + shift], np.where(small, label[r][:, None], big).min(axis=0)
        )
        label[c + shift] = at
        if (label == before).all():
            break
    ends = np.flatnonzero(label != np.arange(rows + columns))
    return list(zip(ends.tolist(), label[ends].tolist()))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (end, smallest node of its component) that connect what the links (a, b) connect."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = np.arange(len(nodes))
    x, y = places[: len(a)], places[len(a) :]
    while len(x):
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        open_ = low != high
        x, y = x[open_], y[open_]
        np.minimum.at(label, high[open_], low[open_])
        while (label != label[label]).any():
            label = label[label]
    ends = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[ends], nodes[label[ends]]


def components(links: DataFrame) -> DataFrame:
    """(id, component) for the ends of ``links`` (a, b): the smallest id that is reachable.

    In each round every node moves to the neighbour, or itself, with the smallest hash, and
    the links are rewritten to the nodes moved to. Hashes make the number of nodes fall by a
    constant factor whatever the shape, also for a path of rising ids; as they are the same
    in all rounds, a star is one node after two.
    Every round is written to the shared folder. A node with very many links is an
    aggregate with partial sums and one side of joins that can be split.
    """
    edges = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    edges = materialize(edges.filter("a <> b").distinct(), "links")
    names = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    names = names.withColumn("at", F.col("id"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        order = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("to"))
        best = both.groupBy("a").agg(F.min(order).alias("m"))
        moves = best.select("a", F.least(F.col("m"), own)["to"].alias("to"))
        moves = materialize(moves, "moves")
        first = moves.select(F.col("a"), F.col("to").alias("x"))
        second = moves.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = edges.join(first, "a").join(second, "b").filter("x <> y")
        edges = edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = materialize(edges.distinct(), "links")
        moved = names.join(moves.withColumnRenamed("a", "at"), "at", "left")
        names = materialize(moved.select("id", F.coalesce("to", "at").alias("at")), "names")
    smallest = names.groupBy("at").agg(F.min("id").alias("component"))
    # Stored, so that a very large component is a join that can be split.
    return names.join(materialize(smallest, "components"), "at").select("id", "component")
