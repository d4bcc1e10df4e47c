"""Mixing sources to target weights in fixed-length blocks of words.

Each source's documents form one stream of words, cut into blocks of ``block`` words.
Every slot of the mix takes one block: a keyed permutation of all slots deals the slots
to the sources, so each output shard's source counts are multinomial draws under the
condition that the sources' totals are met exactly. The slots of a source go through a
second permutation, of its block indexes, and blocks are joined by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import parted, with_running_amount, word_count, words
from clickloom.session import materialize

WEIGHTS = (3, 1, 2)
#: Words of all sources together that the mix holds, as a share of all words.
SHARE = 1.5
#: No source is taken more often than this.
REPEATS = 2
BLOCK = 64
#: Rows that are ordered together, on average.
ROWS_PER_PART = 20_000
SHARD_BLOCKS = 4096
#: Steps of cycle walking; one step fails with probability below 1 / sqrt(n).
_WALK = 16
_ROUNDS = 4


def permuted(index: Column, n: Column, key: Column) -> Column:
    """A keyed permutation of [0, n): ``index`` to its image.

    A Feistel network over pairs (i mod a, i div a) with a * b >= n, followed by cycle
    walking for images at n or above. Fewer than sqrt(n) of the pairs lie there.
    """

    def network(state: Column) -> Column:
        low = state["x"] % state["a"]
        high = ((state["x"] - low) / state["a"]).cast("long")
        for turn in range(_ROUNDS):
            if turn % 2 == 0:
                low = (low + F.pmod(F.xxhash64(high, key, F.lit(turn)), state["a"])) % state["a"]
            else:
                high = (high + F.pmod(F.xxhash64(low, key, F.lit(turn)), state["b"])) % state["b"]
        return F.struct(
            (high * state["a"] + low).alias("x"), state["a"].alias("a"), state["b"].alias("b")
        )

    side = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("long"), F.lit(1))
    first = F.struct(
        index.cast("long").alias("x"), side.alias("a"), F.ceil(n / side).cast("long").alias("b")
    )
    def walked(image: Column) -> Column:
        further = F.aggregate(
            F.sequence(F.lit(1), F.lit(_WALK)),
            image,
            lambda state, _: F.when(state["x"] < n, state).otherwise(network(state)),
        )
        outside = F.raise_error(F.lit("a walk of the permutation did not come back"))
        came_back = F.when(further["x"] < n, further["x"]).otherwise(outside)
        return F.when(image["x"] < n, image["x"]).otherwise(came_back)

    return F.transform(F.array(network(first)), walked)[0]


def source_targets(sizes: DataFrame, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The sources in code-point order, null last, weigh 3, 1, 2 and again. The words asked
    for are shared by weight; a target stops at ``repeats`` times its source's size, and
    what is over goes to the others by weight until none is above. With the ratio of limit
    to weight as order, the ones that stop are always the first ones: source k stops if
    its limit is at most weight k * (words left after the earlier ones / weight left).
    The work is one window over the sources, of which there are few beside documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = sizes.withColumn("w", F.element_at(weights, (place + 1).cast("int")).cast("double"))
    limit = (F.col("source_size") * repeats).cast("double")
    ranked = weighed.withColumn("limit", limit)
    by_ratio = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), "source")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) * share
        - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    ) / F.sum("w").over(onwards)
    leveled = ranked.withColumn("level", level).withColumn(
        "open", F.col("level") * F.col("w") < F.col("limit")
    )
    # The first source that does not stop sets the level of all later ones.
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(everything)
    return leveled.withColumn("final", final).select(
        "source",
        "source_size",
        F.when(F.col("final").isNull(), F.col("limit"))
        .otherwise(F.least(F.col("limit"), F.col("final") * F.col("w")))
        .alias("target"),
    )


def _measures() -> list[Column]:
    return [
        word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_key"),
    ]


def mix(rows: DataFrame, block: int = BLOCK, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix of ``rows`` (_row, doc_id, source, size, text_key): documents, sources, pieces.

    ``documents`` has ``_row`` (one number per input row), doc_id, source, size and first
    word in the source's stream; ``sources`` has targets and slots; ``pieces`` has for
    each (document, block, epoch) that is taken the words [first, first + n) of the
    document, where they lie in the source's stream (``at``), and the slot and its shard. A null text is empty and takes no
    slot; repeated rows are documents of their own; null sources form one source.
    The order of a source's stream is that of a hash of the rows, so reruns agree however
    the input is split into files and partitions; only rows that are equal in all of
    doc_id, source, size and text hash may change places.
    """
    parts = max(1, -(-rows.count() // ROWS_PER_PART))
    rows = rows.withColumn("_key", F.xxhash64("doc_id", "source", "size", "text_key"))
    rows = rows.withColumn("_part", F.pmod("_key", F.lit(parts)))
    placed = with_running_amount(rows, ["source"], "size", ["_key", "doc_id", "_row"], "start")
    placed = placed.select("_row", "doc_id", "source", "size", "start")
    placed = materialize(placed, "mix-placed")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(sizes)
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    # A source of b blocks at target t gets the nearest number of slots to b * t / size.
    slots = F.when(
        F.col("source_size") > 0,
        F.round(blocks * F.col("target") / F.col("source_size")).cast("long"),
    ).otherwise(F.lit(0))
    upto = Window.orderBy(F.col("source").isNull(), "source")
    sources = (
        sources.withColumn("blocks", blocks)
        .withColumn("slots", slots)
        .withColumn(
            "first_slot",
            F.coalesce(
                F.sum("slots").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn(
            "source_key", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
        )
    )
    sources = materialize(sources, "mix-sources")
    total = sources.agg(F.sum("slots")).first()[0] or 0

    # Slots of every source, cut into runs so that a hot source is many rows.
    run = 1 << 16
    runs = sources.filter("slots > 0").select(
        "source",
        "blocks",
        "slots",
        "first_slot",
        "source_key",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(run))).alias("at"),
    )
    runs = runs.repartition(max(1, min(10_000, -(-total // run))), "source", "at")
    taken = runs.select(
        "source",
        "blocks",
        "first_slot",
        "source_key",
        F.explode(
            F.sequence(F.col("at"), F.least(F.col("at") + run, F.col("slots")) - 1)
        ).alias("i"),
    )
    taken = taken.select(
        "source",
        permuted(F.col("i") % F.col("blocks"), F.col("blocks"), F.col("source_key") + seed).alias(
            "block"
        ),
        F.floor(F.col("i") / F.col("blocks")).cast("int").alias("epoch"),
        permuted(F.col("first_slot") + F.col("i"), F.lit(total), F.lit(seed)).alias("slot"),
    )
    per_doc = placed.filter("size > 0").select(
        "_row",
        "doc_id",
        F.col("source").alias("d_source"),
        "start",
        "size",
        F.explode(
            F.sequence(
                F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")
            )
        ).alias("d_block"),
    )
    on = F.col("d_source").eqNullSafe(F.col("source")) & (F.col("d_block") == F.col("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    # Spark takes what a few rows explode to for small; it must not be broadcast.
    pieces = per_doc.join(taken.hint("merge"), on).select(
        "_row",
        "doc_id",
        "epoch",
        (begin - F.col("start")).alias("first"),
        (end - begin).alias("n"),
        begin.alias("at"),
        F.expr(f"slot div {SHARD_BLOCKS}").alias("shard"),
        F.col("slot"),
    )
    return placed, sources, pieces


def mixed_amounts(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document (all rows of ``docs``, empty ones too).

    ``n_blocks`` counts the blocks that hold words of it, repeats too, and ``first_shard`` is
    the first output shard that has one; null if none.
    """
    sized = docs.select("doc_id", "source", *_measures())
    placed, sources, pieces = mix(parted(sized, "mix-rows"))
    taken = pieces.groupBy("_row").agg(
        F.sum("n").alias("taken"), F.count("*").alias("n_blocks"), F.min("shard").alias("first_shard")
    )
    known = sources.select(F.col("source").alias("s"), "source_size", "target")
    return (
        placed.join(taken, "_row", "left")
        .join(known, F.col("source").eqNullSafe(F.col("s")))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_blocks"),
            "first_shard",
        )
    )


def _cut(text: Column, spans: Column) -> Column:
    """For each span (first, n) of ``spans`` an array of those words of ``text``."""

    def pieces_of(own: Column) -> Column:
        return F.transform(
            spans,
            lambda s: F.slice(own, (s["first"] + 1).cast("int"), s["n"].cast("int")),
        )

    # The words as a lambda variable: as a column they would be split anew for every span.
    return F.transform(F.array(words(text)), pieces_of)[0]


def mixed_blocks(docs: DataFrame) -> DataFrame:
    """The mix as it is written: (shard, place, text, doc_ids) of every slot.

    Blocks are joined by index: the slots of a shard are SHARD_BLOCKS consecutive ones, and
    ``place`` is the slot's in its shard, gapless from 0. ``text`` is the block's words joined
    by one space, ``doc_ids`` the documents they are from, in the source's order. The last
    block of a source may be short.
    """
    numbered = parted(docs.select("doc_id", "source", "text"), "mix-texts")
    _, _, pieces = mix(numbered.select("_row", "doc_id", "source", *_measures()))
    spans = pieces.groupBy("_row").agg(
        F.collect_list(F.struct("slot", "at", "first", "n")).alias("spans")
    )
    cut = numbered.join(spans, "_row").select(
        "doc_id", F.explode(F.arrays_zip("spans", _cut(F.col("text"), F.col("spans")).alias("words"))).alias("p")
    )
    each = cut.select(
        F.col("p.spans.slot").alias("slot"),
        F.struct(F.col("p.spans.at").alias("at"), "doc_id", F.col("p.words").alias("words")).alias("piece"),
    )
    # A block has at most BLOCK pieces.
    blocks = each.groupBy("slot").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    return blocks.select(
        F.expr(f"slot div {SHARD_BLOCKS}").alias("shard"),
        (F.col("slot") % SHARD_BLOCKS).alias("place"),
        F.array_join(F.flatten("pieces.words"), " ").alias("text"),
        F.col("pieces.doc_id").alias("doc_ids"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents with the columns of ``docs`` (doc_id, text, source and others).

    Each document gives a row per time its words are taken: the words of that time in
    their order, joined by one space. ``n_chars``, where there is one, is counted anew.
    Documents without words take no slot, so they are not in the mix.
    """
    numbered = parted(docs, "mix-texts")
    _, _, pieces = mix(numbered.select("_row", "doc_id", "source", *_measures()))
    spans = pieces.groupBy("_row", F.col("epoch").alias("_epoch")).agg(
        F.array_sort(F.collect_list(F.struct("first", "n"))).alias("_spans")
    )
    chosen = numbered.drop("_part").join(spans, "_row")

    taken = _cut(F.col("text"), F.col("_spans"))
    text = F.array_join(F.flatten(taken), " ")
    mixed = chosen.withColumn("text", text)
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        mixed = mixed.withColumn("n_chars", count)
    return mixed.select(*docs.columns)
