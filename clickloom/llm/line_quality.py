"""Quality rules on whole texts and on lines that many documents of a host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import word_count, words
from clickloom.session import materialize

#: A line in more documents of one host than this is removed.
MAX_DOCS = 100
#: A document that loses more than this share of its words is rejected.
MAX_LOST_PERCENT = 50
_WORD_CLASS = r"[^\x20\x09-\x0D]"


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def _in_pairs(sorted_array: Column, key) -> Column:
    """The elements of a sorted array whose ``key`` is that of a neighbour."""

    def same(j: Column, x: Column) -> Column:
        return F.coalesce(key(F.get(sorted_array, j)) == key(x), F.lit(False))

    return F.filter(sorted_array, lambda x, j: same(j - 1, x) | same(j + 1, x))


def repeated_words(word_array: Column) -> Column:
    """Words in windows of three words that occur at least twice in the array.

    A window is one long at first: the high bits are its hash, the low ones its position.
    Sorted, equal windows are neighbours, so all that occur twice are found. What is found is
    then sorted and compared by the words themselves: the number is exact for any text.
    """

    def of(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(
            _bound(F.pow(F.lit(2.0), F.ceil(F.log2(F.size(w) + 1))).cast("long"), lambda m: counted(w, m))
        )

    def counted(w: Column, m: Column) -> Column:
        packed = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
                .bitwiseAND(-m)
                .bitwiseOR(i.cast("long")),
            )
        )
        return _bound(packed, lambda s: compared(w, s, m))

    def compared(w: Column, s: Column, m: Column) -> Column:
        def window(x: Column) -> Column:
            i = x.bitwiseAND(m - 1).cast("int")
            words_of = F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"))
            return F.struct(words_of.alias("words"), i.alias("at"))

        found = F.transform(_in_pairs(s, lambda x: x.bitwiseAND(-m)), window)
        return _bound(F.sort_array(found), covered)

    def covered(windows: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            F.sort_array(_in_pairs(windows, lambda x: x["words"])["at"]),
            start,
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")
            ),
            lambda a: a["n"],
        )

    return _bound(word_array, of)


def _line_key(host: Column, line: Column) -> Column:
    """Hash of a host and a line in lower case with blanks joined and digits made equal."""
    plain = F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(host, F.trim(F.regexp_replace(plain, r"[0-9]", "0")))


def _without(text: Column, places: Column) -> Column:
    """``text`` without the lines at ``places``, counted from 0."""

    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return _bound(F.split(text, "\n"), rest)


def _facts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Each row's number, columns to ``keep``, statistics and lines, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = F.transform(
        F.split(text, "\n"), lambda line, i: F.struct(line.alias("line"), i.alias("place"))
    )
    lines = F.filter(placed, lambda x: x["line"].rlike(_WORD_CLASS))
    word_facts = _bound(
        words(F.col("text")),
        lambda a: F.struct(
            F.size(a).cast("long").alias("n_words"),
            F.aggregate(a, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
            repeated_words(a).cast("long").alias("n_repeat_words"),
        ),
    )
    line_facts = _bound(
        lines,
        lambda a: F.struct(
            (F.size(a) - F.size(F.array_distinct(a["line"]))).cast("long").alias("n_dup_lines"),
            F.transform(
                a,
                lambda x: F.struct(
                    _line_key(F.col("source"), x["line"]).alias("line"),
                    x["place"].alias("place"),
                    word_count(x["line"]).alias("n"),
                ),
            ).alias("lines"),
        ),
    )
    facts = docs.select(
        *keep,
        F.monotonically_increasing_id().alias("_row"),
        word_facts.alias("_w"),
        line_facts.alias("_l"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("_n_symbols"),
    )
    return materialize(facts, "line-facts")


def _frequent_in(facts: DataFrame, max_docs: int) -> DataFrame:
    """(_row, line, place, n) of the lines that over ``max_docs`` documents of a host have.

    A document counts once for each of its lines, and the counts are combined before the
    shuffle; a line that a third of all documents have is one row of each map task.
    """
    counts = facts.select(F.explode(F.array_distinct("_l.lines.line")).alias("line"))
    frequent = counts.groupBy("line").count().filter(F.col("count") > max_docs).select("line")
    # Stored, so that a line that a third of all documents share is a plain skewed join,
    # which adaptive execution splits.
    frequent = materialize(frequent, "frequent-lines")
    return facts.select("_row", F.inline("_l.lines")).join(frequent, "line")


def _verdict(lost: Column, max_lost_percent: int) -> Column:
    n_words = F.col("_w.n_words")
    base_failed = (n_words < 50) | (100 * F.col("_w.n_repeat_words") > 50 * n_words)
    return F.struct(
        "_w.n_words",
        "_w.word_chars",
        F.col("_n_symbols").alias("n_symbols"),
        F.col("_l.n_dup_lines").alias("n_dup_lines"),
        "_w.n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (100 * lost <= max_lost_percent * n_words)).alias("kept"),
        lost.alias("n_lost_words"),
    )


def _lost() -> Column:
    return F.coalesce(F.col("_lost"), F.lit(0)).cast("long")


def without_frequent_lines(
    docs: DataFrame, max_docs: int = MAX_DOCS, max_lost_percent: int = MAX_LOST_PERCENT
) -> DataFrame:
    """``docs`` (doc_id, text, source as host) without frequent lines, and ``_verdict``.

    Lines with a word are compared normalised (``_line_key``). Every row is a document, also
    a copy of another. The lines that more than ``max_docs`` documents of a host have are
    cut out of ``text``, and a document is depleted if they held more than
    ``max_lost_percent`` of its words. Null texts have no words and fail; a null host is a
    host. ``_verdict`` has the statistics of the text as it was, n_lost_words and kept.
    Other columns stay as they are. Names of ``docs`` that begin with an underscore are not
    allowed.
    """
    facts = _facts(docs, docs.columns)
    lost = _frequent_in(facts, max_docs).groupBy("_row")
    lost = lost.agg(F.collect_list("place").alias("_places"), F.sum("n").alias("_lost"))
    cut = F.when(F.col("_places").isNull(), F.col("text")).otherwise(
        _without(F.col("text"), F.col("_places"))
    )
    joined = facts.join(lost, "_row", "left").withColumn("text", cut)
    return joined.select(*docs.columns, _verdict(_lost(), max_lost_percent).alias("_verdict"))


def cleaned(
    docs: DataFrame, max_docs: int = MAX_DOCS, max_lost_percent: int = MAX_LOST_PERCENT
) -> DataFrame:
    """The kept rows of ``docs`` with frequent lines cut out; ``n_chars`` is counted anew."""
    kept = without_frequent_lines(docs, max_docs, max_lost_percent).filter("_verdict.kept")
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = F.col("_verdict.n_lost_words") > 0
        kept = kept.withColumn("n_chars", F.when(cut, count).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def quality_verdicts(
    docs: DataFrame, max_docs: int = MAX_DOCS, max_lost_percent: int = MAX_LOST_PERCENT
) -> DataFrame:
    """doc_id, statistics and verdict of each row of ``docs``, as in ``without_frequent_lines``.

    The words that frequent lines hold are counted line by line, so no text is written or
    shuffled. Columns beside doc_id, text and source are ignored.
    """
    facts = _facts(docs.select("doc_id", "text", "source"), ["doc_id"])
    lost = _frequent_in(facts, max_docs).groupBy("_row").agg(F.sum("n").alias("_lost"))
    judged = facts.join(lost, "_row", "left").select(
        "doc_id", _verdict(_lost(), max_lost_percent).alias("_verdict")
    )
    return judged.select("doc_id", "_verdict.*")


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                         lambda x: x <> '') AS w
           FROM documents),
lines AS (SELECT doc_id, host, text, unnest(list_filter(string_split(text, chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS line FROM d),
normal AS (SELECT doc_id, host, text, line,
             trim(regexp_replace(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'),
                  '[0-9]', '0', 'g'), ' ') AS key,
             len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
           FROM lines),
frequent AS (SELECT host, key FROM normal GROUP BY host, key
             HAVING count(DISTINCT doc_id) > {MAX_DOCS}),
lost AS (SELECT doc_id, sum(n) AS lost FROM normal JOIN frequent USING (host, key) GROUP BY doc_id),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri)
          WHERE c > 1),
rep AS (SELECT doc_id, count(*) AS n FROM
          (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY doc_id),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        CAST(coalesce(lost, 0) AS BIGINT) AS n_lost_words
      FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND 100 * n_lost_words <= {MAX_LOST_PERCENT} * n_words AS kept FROM g
"""
