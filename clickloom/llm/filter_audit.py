"""What each of several document filters removes, whatever the order they run in.

A document becomes one 32-bit word: bit S is set if the document survives the subset S of
the filters. The positional popcounts of these words, per part and label, are the survivors
of all 32 subsets; every order of the filters is read off them without another pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from functools import reduce
from itertools import permutations
from math import factorial
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import NULL_ID, word_count, words
from clickloom.session import materialize

MAX_FILTERS = 5
#: The filter that fails a text found under a smaller doc_id.
REPEATED = "E"
_KINDS = ("all", "good", "toxic")


def text_filters(text: Column) -> dict[str, Column]:
    """Filters A to D of a text that is not null: the conditions under which it fails.

    A: under 200 words; B: fewer than half of the words are distinct; C: more than 2 % of
    the characters are capitals A to Z; D: a sign of markup or money.
    """
    n_words = word_count(text)
    distinct = F.size(F.array_distinct(words(text)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n_words < 200,
        "B": 100 * distinct < 50 * n_words,
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def positional_popcount(values: np.ndarray) -> np.ndarray:
    """For each of the 32 bits, how many of the values (uint32) have it.

    Carry-save adders: three words of one weight become a sum word of that weight and a
    carry word of twice the weight, in all 32 positions at once, until at most two words
    of each weight are left.
    """
    counts = np.zeros(32, dtype=np.int64)
    places = np.arange(32, dtype=np.uint32)
    weight, same = 0, values
    while len(same):
        carries = []
        while len(same) > 2:
            third = len(same) // 3
            a, b, c = same[:third], same[third : 2 * third], same[2 * third : 3 * third]
            either = a ^ b
            carries.append((a & b) | (either & c))
            same = np.concatenate([either ^ c, same[3 * third :]])
        for word in same:
            counts += ((word >> places) & np.uint32(1)).astype(np.int64) << weight
        same = np.concatenate(carries) if carries else same[:0]
        weight += 1
    return counts


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, kind, survivors) of every part and label kind of a batch."""
    for batch in batches:
        part = batch.column("part").dictionary_encode()
        code = part.indices.to_numpy()
        word = batch.column("word").to_numpy().view(np.uint32)
        flags = [
            np.ones(len(word), dtype=bool),
            batch.column("good").to_numpy(zero_copy_only=False),
            batch.column("toxic").to_numpy(zero_copy_only=False),
        ]
        order = np.argsort(code, kind="stable")
        ends = np.cumsum(np.bincount(code, minlength=len(part.dictionary)))
        names, kinds, counts = [], [], []
        for name, low, high in zip(part.dictionary.to_pylist(), np.append(0, ends), ends):
            rows = order[low:high]
            for kind, flag in zip(_KINDS, flags):
                chosen = rows[flag[rows]]
                if len(chosen):
                    names.append(name)
                    kinds.append(kind)
                    counts.append(positional_popcount(word[chosen]).tolist())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array(kinds, pa.string()),
                pa.array(counts, pa.list_(pa.int64())),
            ],
            names=["part", "kind", "survivors"],
        )


def _member(i: int) -> int:
    """The bits of the subsets that hold filter ``i``, as a signed 32-bit number."""
    bits = sum(1 << s for s in range(32) if s >> i & 1)
    return bits - (1 << 32) if bits >> 31 else bits


def survival_words(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    part: str = "source",
) -> DataFrame:
    """(part, good, toxic, word) of each row of ``docs`` (doc_id, text, ``part``).

    ``filters`` gives the failing condition of each filter over the columns of ``docs``, in
    which a null is no failure; by default ``text_filters`` of the text. REPEATED is added
    to them: it fails a row whose text another row has under a smaller doc_id, all rows
    counted, also removed ones. Texts are compared by SHA-256. A null text is empty, a null
    part the empty string, and a null doc_id is before all others, so that such a row never
    repeats. Equal rows of one doc_id do not repeat each other. ``labels`` (doc_id, quality,
    toxic) may lack documents and repeat them: good or toxic is who has one such row, and
    rows without doc_id count nowhere. Other columns are ignored.

    A row is found to be the first of its text by (text, doc_id), not by the text alone, so
    a text that a third of all rows hold is spread over tasks.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    failing = dict(filters) if filters is not None else text_filters(text)
    if REPEATED in failing or len(failing) >= MAX_FILTERS:
        raise ValueError(f"at most {MAX_FILTERS - 1} filters beside {REPEATED}")
    survives = F.lit(-1)
    for i, condition in enumerate(failing.values()):
        clear = F.when(condition, F.lit(~_member(i))).otherwise(F.lit(-1))
        survives = survives.bitwiseAND(clear)
    facts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        survives.cast("int").alias("word"),
    )
    facts = materialize(facts, "filter-facts")
    firsts = facts.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    rated = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    )
    repeated = F.when(F.col("first").isNull(), F.lit(~_member(len(failing)))).otherwise(F.lit(-1))
    return (
        facts.join(firsts, ["digest", "id"], "left")
        .join(rated, "id", "left")
        .select(
            "part",
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
            F.col("word").bitwiseAND(repeated).alias("word"),
        )
    )


def subset_survivors(survival: DataFrame) -> DataFrame:
    """One row per part: arrays ``all``, ``good`` and ``toxic`` of the survivors of each subset.

    Popcounts are taken batch by batch in the map tasks; 32 sums per part and kind are
    shuffled, whatever the number of rows of a part.
    """
    counted = survival.mapInArrow(_counted, "part string, kind string, survivors array<bigint>")
    totals = counted.groupBy("part", "kind").agg(
        *[F.sum(F.col("survivors")[s]).alias(f"n{s}") for s in range(32)]
    )
    folded = totals.select("part", "kind", F.array(*[f"n{s}" for s in range(32)]).alias("n"))
    none = F.array_repeat(F.lit(0).cast("long"), 32)
    return folded.groupBy("part").agg(
        *[
            F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), none).alias(kind)
            for kind in _KINDS
        ]
    )


def _in_all_orders(survivors: Column, i: int, k: int) -> Column:
    """What filter ``i`` of ``k`` removes, summed over all orders."""
    terms = [
        (survivors[s] - survivors[s | 1 << i])
        * F.lit(factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()))
        for s in range(1 << k)
        if not s >> i & 1
    ]
    return reduce(add, terms)


def order_effects(survivors: DataFrame, letters: str) -> DataFrame:
    """For each part, order of the filters and step, what the step's filter does.

    ``letters`` names the filters by bit. kept: left after the step; removed: by the step;
    redundant: failing the filter, removed before; unique_fails: failing it alone; good_lost
    and toxic_lost: removed rows so labelled; shapley: removed, summed over all orders.
    """
    k = len(letters)
    everything = (1 << k) - 1
    orders = ["".join(p) for p in permutations(letters)]
    shapley = F.array(*[_in_all_orders(F.col("all"), i, k) for i in range(k)])
    rows = (
        survivors.withColumn("shapleys", shapley)
        .withColumn("filter_order", F.explode(F.lit(orders)))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    )
    bit = F.instr(F.lit(letters), F.col("filter_order").substr(F.col("step"), F.lit(1))) - 1
    bits = F.transform(
        F.sequence(F.lit(1), F.lit(k)),
        lambda at: F.pow(
            F.lit(2), F.instr(F.lit(letters), F.col("filter_order").substr(at, F.lit(1))) - 1
        ).cast("int"),
    )

    def subset(n: Column) -> Column:
        return F.aggregate(F.slice(bits, F.lit(1), n), F.lit(0), lambda total, x: total + x)

    rows = rows.select(
        "*",
        bit.alias("bit"),
        subset(F.col("step") - 1).alias("before"),
        subset(F.col("step")).alias("after"),
    )
    own = F.pow(F.lit(2), F.col("bit")).cast("int")

    def lost(kind: str) -> Column:
        return F.get(kind, F.col("before")) - F.get(kind, F.col("after"))

    fails = F.get("all", F.lit(0)) - F.get("all", own)
    return rows.select(
        "part",
        "filter_order",
        "step",
        F.get("all", F.col("after")).alias("kept"),
        lost("all").alias("removed"),
        (fails - lost("all")).alias("redundant"),
        (F.get("all", F.lit(everything) - own) - F.get("all", F.lit(everything))).alias(
            "unique_fails"
        ),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shapleys", F.col("bit")).alias("shapley"),
    )


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    part: str = "source",
) -> DataFrame:
    """``order_effects`` of the given filters and REPEATED over ``docs``; see ``survival_words``.

    An empty table has no part and gives no row.
    """
    letters = "".join(filters if filters is not None else "ABCD") + REPEATED
    survivors = subset_survivors(survival_words(docs, labels, filters, part))
    return order_effects(survivors, letters)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                         lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
      FROM labels GROUP BY doc_id),
fails AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)
           THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l USING (doc_id)),
counts AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g,
             count(*) FILTER (toxic) AS t FROM fails GROUP BY part, mask),
f AS (SELECT unnest(range(0, 5)) AS i),
perm AS (SELECT [a.i, b.i, c.i, x.i, e.i] AS p FROM f a, f b, f c, f x, f e
         WHERE len(list_distinct([a.i, b.i, c.i, x.i, e.i])) = 5),
steps AS (SELECT p, k, p[k] AS i,
            CAST(list_sum(list_transform(p[1:k], lambda z: 1 << z)) AS INTEGER) AS after FROM
          (SELECT p, unnest(range(1, 6)) AS k FROM perm)),
run AS (SELECT part, list_aggregate(list_transform(p, lambda z: chr(65 + CAST(z AS INTEGER))),
            'string_agg', '') AS filter_order, k AS step, i,
    sum(CASE WHEN mask & after = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & (after - (1 << i)) = 0 AND mask & (1 << i) > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & (after - (1 << i)) > 0 AND mask & (1 << i) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = (1 << i) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & (after - (1 << i)) = 0 AND mask & (1 << i) > 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & (after - (1 << i)) = 0 AND mask & (1 << i) > 0 THEN t ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, p, k, i)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, i) AS BIGINT) AS shapley
FROM run
"""
