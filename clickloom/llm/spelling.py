"""Spelling variants: words at one edit of each other, and the common form of each.

Every word is marked with a terminator and all rotations of it are sorted. Leaving out the
character at which two words may differ turns an edit into a common prefix: ``ho$mous`` and
``ho$mout`` share the prefix that skips the replaced character, and that prefix itself is a
rotation of the word which lacks it. A scan of each prefix's run of rotations finds the
neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.session import materialize

_LETTERS = r"A-Za-zÀ-ÿ"
_END = "$"
MIN_LETTERS = 6
MIN_COUNT = 5
#: A word's neighbour is its form if it occurs at least this many times as often.
FORM_RATIO = 5
#: One distinct run in this many is misspelt.
SLIP = 199
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lowered(run: Column) -> Column:
    """With only A to Z in lower case; ``lower`` alone would change other capitals as well."""
    ascii_only = F.octet_length(run) == F.length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(
        F.translate(run, _CAPITALS, _CAPITALS.lower())
    )


def misspelt(doc_id: Column, run: Column) -> Column:
    """``run`` with a letter left out where the CRC-32 of ``doc_id:run`` is divisible by SLIP."""
    code = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run))
    at = (code % F.length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(code % SLIP == 0, rest).otherwise(run)


def vocabulary(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n): how often each word occurs in ``docs`` (doc_id, text), slips made.

    A word is a longest run of letters, A to Z in lower case, with ``min_letters`` or more
    left after ``misspelt``, found ``min_count`` times or more. Null and empty texts have
    none; a null doc_id is written as nothing. Counts are combined in the map tasks.
    """
    runs = F.regexp_extract_all("text", F.lit(f"[{_LETTERS}]{{{min_letters},}}"), F.lit(0))
    lowered = docs.select("doc_id", F.explode(runs).alias("run")).select(
        "doc_id", _lowered(F.col("run")).alias("run")
    )
    each = lowered.select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))
    return (
        each.filter(F.length("word") >= min_letters)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )


def rotations(vocabulary: DataFrame) -> DataFrame:
    """(prefix, word, n, skips, opens) of all rotations of the marked words.

    Each rotation stands under itself and, where it ends with a letter, under the prefix
    that skips this letter. ``opens``: the letter is the first of its run of equal
    letters. Leaving out any letter of a run gives the same word; one of them is enough.
    """
    word, at = F.col("word"), F.col("at")
    last = F.substring(word, at, F.lit(1))
    entries = F.filter(
        F.array(F.lit(False), F.lit(True)), lambda skips: ~skips | (at > 0)
    )
    turned = vocabulary.select(
        "word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at")
    ).select("word", "n", "at", F.explode(entries).alias("skips"))
    head = F.substring(word, F.lit(1), F.when(F.col("skips"), at - 1).otherwise(at))
    return turned.select(
        F.concat(F.substring(word, at + 1, F.length(word)), F.lit(_END), head).alias("prefix"),
        "word",
        "n",
        "skips",
        (F.col("skips") & ((at == 1) | (last != F.substring(word, at - 1, F.lit(1))))).alias("opens"),
    )


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of words at one edit and the most frequent of them.

    ``vocabulary`` has distinct words. Two words at a replacement skip the letter under one
    prefix, once. A word at a deletion is that prefix itself, once for each run of equal
    letters. So a run of rotations under one prefix holds a word for each letter of the
    alphabet and one more, at most, and no pair is met twice. Each word takes from the run
    how many others there are and which is the most frequent; pairs are never rows.
    """
    by_count = Window.partitionBy("prefix").orderBy(F.desc("skips"), F.desc("n"), "word")
    run = by_count.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entry = F.struct((-F.col("n")).alias("minus_n"), F.col("word").alias("word"))
    skipping = F.when(F.col("skips"), entry)
    scanned = rotations(vocabulary).select(
        "word",
        "skips",
        "opens",
        F.count_if("skips").over(run).alias("n_skips"),
        F.count_if("opens").over(run).alias("n_opens"),
        F.nth_value(skipping, 1).over(run).alias("first"),
        F.nth_value(skipping, 2).over(run).alias("second"),
        F.min(F.when(F.col("opens"), entry)).over(run).alias("first_opens"),
        F.min(F.when(~F.col("skips"), entry)).over(run).alias("whole"),
    )
    shorter = F.when(F.col("opens"), F.col("whole"))
    other = F.when(F.col("first.word") == F.col("word"), F.col("second")).otherwise(F.col("first"))
    near = F.when(
        F.col("skips"), F.col("n_skips") - 1 + shorter.isNotNull().cast("int")
    ).otherwise(F.col("n_opens"))
    best = F.when(F.col("skips"), F.least(other, shorter)).otherwise(F.col("first_opens"))
    found = scanned.select("word", near.alias("near"), best.alias("best")).filter("near > 0")
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min("best").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each row (word, form): the end of the chain of forms.

    Every round doubles how far a word has come. A form occurs FORM_RATIO times as often as
    its word, so chains are short: of 30 words for a word that occurs 10**20 times.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(ahead, "root", "left")
        moved = moved.select("word", F.coalesce("next", "root").alias("root"), "next")
        moved = materialize(moved, "forms")
        if moved.filter("next IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    form_ratio: int = FORM_RATIO,
) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word of ``vocabulary``.

    Near words differ by one inserted, deleted or replaced code point. ``form`` is the near
    word that occurs most often (of several, the first in code-point order), if that is at
    least ``form_ratio`` times as often as the word; ``root`` is where the forms lead, or
    the word. An empty table has no words. Columns beside doc_id and text are ignored.
    """
    if form_ratio < 2:
        raise ValueError("a form must occur more often than its word")
    known = materialize(vocabulary(docs, min_letters, min_count), "vocabulary")
    form_n = -F.col("best.minus_n")
    enough = form_n >= form_ratio * F.col("n")
    judged = known.join(neighbours(known), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, form_n).alias("form_n"),
    )
    judged = materialize(judged, "spelling")
    ends = roots(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


#: CRC-32 has no function in DuckDB: a table of 256 remainders and a fold over the bytes. A
#: letter of the word class is one byte, or two from U+00C0 on.
ORACLE_SQL = rf"""
WITH RECURSIVE
crc AS (SELECT list(list_reduce([b] || range(0, 8), lambda c, k:
          CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
        FROM range(0, 256) r(b)),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''),
           '[A-Za-zÀ-ÿ]{{{MIN_LETTERS},}}')), '{_CAPITALS}', '{_CAPITALS.lower()}') AS run
         FROM documents),
each AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY doc_id, run),
coded AS (SELECT run, times, xor(list_reduce([4294967295] || flatten(list_transform(
            string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x:
              CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
                   ELSE [195, CAST(unicode(x) - 64 AS BIGINT)] END)),
            lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) AS h
          FROM each, crc),
slipped AS (SELECT times, CASE WHEN h % {SLIP} = 0
              THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
            FROM coded),
v AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slipped
      WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
less AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b
    ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS form_n FROM near GROUP BY word),
named AS (SELECT best.word, n_near, form_n, min(other) AS form FROM best
          JOIN near ON best.word = near.word AND near.n = form_n GROUP BY ALL),
j AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN form_n >= {FORM_RATIO} * v.n THEN form END AS form,
        CASE WHEN form_n >= {FORM_RATIO} * v.n THEN form_n END AS form_n
      FROM v LEFT JOIN named ON v.word = named.word),
walk AS (SELECT word, word AS root, form AS next FROM j
         UNION ALL SELECT walk.word, j.word, j.form FROM walk JOIN j ON walk.next = j.word)
SELECT j.word, j.n, j.n_near, j.form, j.form_n, root
FROM j JOIN walk ON j.word = walk.word AND walk.next IS NULL
"""
