"""Packing into optimal length buckets and token-budget batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import parted, with_running_amount, word_count

#: Longer documents are cut into pieces of this many words; it bounds the histogram.
MAX_WORDS = 8192
BUCKETS = 16
#: Words of a batch, padding included.
BATCH_WORDS = 65_536


def optimal_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding in total.

    A row of length l in a bucket with bound b is padded by b - l. ``lengths`` are distinct
    and rising. The best split of the first j lengths into k buckets ends with a bucket
    that starts after some i < j, and the first i lengths are split best into k - 1.
    """
    if not lengths:
        return []
    bound = np.asarray(lengths, dtype=np.float64)
    rows = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    filled = np.concatenate([[0.0], np.cumsum(bound * np.asarray(counts, dtype=np.float64))])
    n, buckets = len(lengths), min(buckets, len(lengths))
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    starts = np.zeros((buckets + 1, n + 1), dtype=np.int64)
    for k in range(1, buckets + 1):
        after = np.full(n + 1, np.inf)
        for j in range(k, n + 1):
            cost = best[:j] + bound[j - 1] * (rows[j] - rows[:j]) - (filled[j] - filled[:j])
            i = int(np.argmin(cost))
            after[j], starts[k, j] = cost[i], i
        best = after
    ends, j = [], n
    for k in range(buckets, 0, -1):
        ends.append(int(lengths[j - 1]))
        j = int(starts[k, j])
    return ends[::-1]


def packed(
    docs: DataFrame,
    buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
    batch_words: int = BATCH_WORDS,
) -> DataFrame:
    """Where each piece of each document goes: bucket, batch and place in the batch.

    ``docs`` needs doc_id and text; other columns are ignored. A document of more than
    ``max_words`` words is cut into pieces of that many, none is shortened. The histogram
    of piece lengths covers every document and has at most ``max_words`` rows. In a bucket
    of bound b, a batch holds batch_words // b pieces. A document without words, or with
    a null text, has one row with null bucket, batch and place, as there is nothing to
    pack. Repeated rows are packed each: (row, piece) names a piece, where ``row`` is a
    number of the input row. Pieces are numbered per input partition, so that
    a bucket that holds most pieces is not one task.
    """
    if batch_words < max_words:
        raise ValueError("a batch must hold a piece of max_words words")
    number = F.monotonically_increasing_id().alias("row")
    sized = docs.select("doc_id", number, word_count(F.col("text")).alias("size"))
    cut = sized.withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.expr(f"int((greatest(size, 1) - 1) div {max_words})")))
    )
    length = F.least(F.col("size") - F.col("piece") * max_words, F.lit(max_words))
    pieces = parted(cut.select("doc_id", "row", "piece", length.cast("int").alias("n_words")), "pieces")
    histogram = sorted(
        tuple(row) for row in pieces.filter("n_words > 0").groupBy("n_words").count().collect()
    )
    bounds = optimal_boundaries([n for n, _ in histogram], [c for _, c in histogram], buckets)
    if not bounds:
        bounds = [max_words]
    table = F.array(*[F.lit(b) for b in bounds])
    bucket = F.when(F.col("n_words") > 0, F.size(F.filter(table, lambda b: b < F.col("n_words"))))
    rows = pieces.withColumn("bucket", bucket).withColumn("one", F.lit(1))
    numbered = with_running_amount(rows, ["bucket"], "one", ["_row"], "slot")
    bound = F.get(table, F.col("bucket"))
    capacity = F.expr(f"{batch_words} div bound")
    return (
        numbered.withColumn("bound", bound)
        .withColumn("capacity", capacity)
        .select(
            "doc_id",
            "row",
            "piece",
            "n_words",
            "bucket",
            F.col("bound").alias("bucket_words"),
            F.when(F.col("bucket").isNotNull(), F.expr("slot div capacity")).alias("batch"),
            F.when(F.col("bucket").isNotNull(), F.expr("int(slot % capacity)")).alias("place"),
            (F.col("bound") - F.col("n_words")).alias("padding"),
        )
    )
