"""URL filters: host and path rules, and a list of canonical URLs behind a Bloom filter."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import materialize

#: (verdict, host, path); of the rules that fit a URL the longest decides.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: A block is 8 words of 64 bits; each key sets one bit in each word.
_WORDS = 8
BITS_PER_KEY = 16
#: The filter is at most this large (16 MB), however long the list: beyond it more URLs
#: pass to the exact join, none is lost.
MAX_BLOCKS = 1 << 18
_PARAMS = "utm_[a-z]+|ref|fbclid|gclid"


def host_of(url: Column) -> Column:
    """What is between the first :// and the next /, ? or #, A-Z in lower case, or empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #, or empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without www. or m., path without a last / or .html, query without tracking.

    Scheme and fragment do not count. A URL without host has no canonical form (null).
    """
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(?:\.html?|/+)$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^(?:{_PARAMS})(?:=|$)"))
    joined = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""))
    return F.when(host != "", whole)


def _rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    # Of the rules that fit one host the longer hosts and paths are the longer rules.
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _blocks(keys: int) -> int:
    """A power of two, at most MAX_BLOCKS."""
    wanted = max(1, keys * BITS_PER_KEY // (64 * _WORDS))
    return min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())


def bloom_block(key: Column, blocks: int) -> Column:
    """The block of a 64-bit hash; its bits in the block come from the low 48 bits."""
    if blocks <= 1 << 16:
        return F.shiftrightunsigned(key, 48).bitwiseAND(blocks - 1)
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_filter(keys: DataFrame) -> np.ndarray:
    """The blocked Bloom filter (blocks x 8 words) of a column ``key`` of 64-bit hashes.

    Built as an aggregate: a row for each block with the OR of its keys' bits. The number
    of rows that reach the driver is bounded by MAX_BLOCKS.
    """
    blocks = _blocks(keys.count())
    bits = [
        F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(key, {6 * i}) & 63))")).alias(f"w{i}")
        for i in range(_WORDS)
    ]
    rows = keys.groupBy(bloom_block(F.col("key"), blocks).alias("b"))
    table = np.zeros((blocks, _WORDS), dtype=np.int64)
    for row in rows.agg(*bits).collect():
        table[row["b"]] = row[1:]
    return table


def possible(column_blocks: np.ndarray, keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether all eight bits of each key are set in its block."""
    hit = np.ones(len(keys), dtype=bool)
    unsigned = keys.view(np.uint64)
    words = table.view(np.uint64)
    for i in range(_WORDS):
        bit = (unsigned >> np.uint64(6 * i)) & np.uint64(63)
        hit &= ((words[column_blocks, i] >> bit) & np.uint64(1)).astype(bool)
    return hit


def judged(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every row of ``pages`` (page_id, url).

    A rule decides first; else a URL is blocked if its canonical form is among those of
    ``listed`` (a column ``url``), and allowed if not. URLs go through the Bloom filter
    of the list, and what passes is joined with the list itself, so that a false hit
    changes nothing. A null URL or one without :// has an empty host and path, fits no
    rule and is never listed. Repeated rows are judged each; an empty list blocks nothing.
    """
    spark = pages.sparkSession
    wanted = listed.select(canonical(F.col("url")).alias("url")).filter("url IS NOT NULL").distinct()
    table = bloom_filter(wanted.select(F.xxhash64("url").alias("key")))
    blocks = len(table)
    shared = spark.sparkContext.broadcast(table)
    parsed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canon"),
    )
    key = F.xxhash64("canon")
    block = bloom_block(key, blocks)
    parsed = parsed.withColumn("key", key).withColumn("block", block)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = shared.value
        for batch in batches:
            at, keys = batch.column("block").to_numpy(), batch.column("key").to_numpy()
            hit = pa.array(possible(at, keys, bloom))
            yield batch.drop_columns(["block", "key"]).append_column("maybe", hit)

    schema = "page_id {}, host string, path string, canon string, maybe boolean".format(
        pages.schema["page_id"].dataType.simpleString()
    )
    probed = materialize(parsed.mapInArrow(passed, schema), "probed-urls")
    # Only possible hits are joined with the list; what the filter rejects is judged already.
    found = wanted.select(F.col("url").alias("canon"), F.lit(True).alias("found"))
    hits = probed.filter("maybe").join(found, "canon", "left")
    rejected = probed.filter("NOT maybe").withColumn("found", F.lit(False))
    hits = hits.unionByName(rejected)
    rule = _rule(F.col("host"), F.col("path"), rules)
    is_listed = F.coalesce("found", F.lit(False))
    return hits.withColumn("r", rule).select(
        "page_id",
        "host",
        "path",
        F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(is_listed, "block").otherwise("allow")).alias("verdict"),
        is_listed.alias("listed"),
    )


def oracle_sql(chosen: str) -> str:
    """``judged`` for RULES and the pages for which ``chosen`` holds as the list, as DuckDB SQL."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return rf"""
WITH r(rule_verdict, rule_host, rule_path) AS (VALUES {rules}),
p AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (SELECT page_id,
        translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
        list_sort(list_filter(string_split(
          regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
          lambda x: x <> '' AND NOT regexp_matches(x, '^(?:{_PARAMS})(?:=|$)'))) AS query
      FROM p),
c AS (SELECT *, regexp_replace(host, '^(?:www|m)\.', '')
        || regexp_replace(path, '(?:\.html?|/+)$', '')
        || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canon
      FROM h),
l AS (SELECT DISTINCT canon FROM c WHERE {chosen}),
f AS (SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
      FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host))
        AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule,
  coalesce(rule_verdict, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
  l.canon IS NOT NULL AS listed
FROM c LEFT JOIN f USING (page_id) LEFT JOIN l ON c.canon = l.canon AND host <> ''
"""
