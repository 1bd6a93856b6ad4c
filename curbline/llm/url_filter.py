"""URL filters: ordered host/path rules, and a blocked Bloom filter before an exact hash join. DataFrame functions only.

Results for odd input: a null url, or one without ``://``, has empty host and path and fits no rule; an empty table
gives an empty table; repeated rows each get their verdict; further columns of the input are not carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Bits of a block, words of 32 bits in it (each holds one bit of a key), and bits per listed key.
BLOCK_WORDS, BITS_PER_KEY = 8, 16
#: Odd multipliers of the words, from the published split-block design: fixed values.
SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Canonical url: host without a leading ``www.`` or ``m.``, and path without closing slashes."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"/+$", ""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict): of the rules whose host is the url's or a parent of it and whose path begins the url's, the longest."""
    rule = verdict = F.lit(None).cast("string")
    for said, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _bits(key: Column) -> list[Column]:
    """One bit for each word of a key's block."""
    low = key.bitwiseAND(F.lit(0x7FFFFFFF))
    turn = [F.shiftright(low * F.lit(s), 27).bitwiseAND(F.lit(31)) for s in SALTS]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), t.cast("int")) for t in turn]


def blocked_bloom(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """Filter of the keys in ``listed``: one row per block that isn't empty, (block, w0..w7).

    Keys are dealt to blocks by hash and or-ed map-side first, so a block gets a row per task at most."""
    hashed = listed.select(F.xxhash64(key).alias("_key"))
    bits = [b.alias(f"w{k}") for k, b in enumerate(_bits(F.col("_key")))]
    return hashed.select(_block(n_blocks), *bits).groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(BLOCK_WORDS)])


def _block(n_blocks: int) -> Column:
    return F.pmod(F.shiftright(F.col("_key"), 32), F.lit(n_blocks)).alias("block")


def listed_flag(urls: DataFrame, key: str, listed: DataFrame, listed_key: str, row_id: str, flag: str = "_listed") -> DataFrame:
    """``urls`` with a boolean ``flag``: true where ``urls[key]`` is in ``listed[listed_key]``, else null.

    Each row with a key meets its one block of the Bloom filter; only rows that may hit keep their url as key of the exact
    hash join, which removes false positives. The others get a key of their own in either join, so that they spread and match
    nothing. Which side of either join is broadcast is left to Spark, by measured size; a hot url is split as a skewed
    partition. Null keys are in no list; columns of any name but ``flag`` can be carried."""
    keys = listed.select(F.col(listed_key).alias("_on")).where("_on is not null").distinct()
    n_blocks = max(1, -(-keys.count() * BITS_PER_KEY // (32 * BLOCK_WORDS)))
    bloom = blocked_bloom(keys, "_on", n_blocks)
    names = [f"c{k}" for k in range(len(urls.columns))]
    # what is carried stands apart from the columns of the filter
    row = F.coalesce(F.col(f"`{row_id}`").cast("string"), F.lit(""))
    probe = urls.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(urls.columns, names)]).alias("_row"), F.col(f"`{key}`").alias("_url"), row.alias("_id"))
    probe = probe.withColumn("_key", F.xxhash64("_url"))
    probe = probe.withColumn("block", F.when(F.col("_url").isNull(), -1 - F.pmod(F.xxhash64("_id"), F.lit(1 << 20))).otherwise(_block(n_blocks)))
    may = F.col("_url").isNotNull() & F.col("w0").isNotNull()
    for k, bit in enumerate(_bits(F.col("_key"))):
        may = may & (F.col(f"w{k}").bitwiseAND(bit) != 0)
    own = F.concat(F.lit("\0"), F.col("_id"))
    possible = probe.join(bloom, "block", "left").select("_row", F.when(may, F.col("_url")).otherwise(own).alias("_on"))
    found = possible.join(keys.withColumn("_hit", F.lit(True)), "_on", "left")
    return found.select(*[F.col(f"_row.{n}").alias(c) for c, n in zip(urls.columns, names)], F.col("_hit").alias(flag))


def judge_urls(pages: DataFrame, listed: DataFrame, listed_key: str, rules=RULES, url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Verdict on every url: its rule's; without a rule, block if its canonical form is listed, else allow."""
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", rule.alias("rule"), said.alias("_said"))
    parts = parts.withColumn("_canonical", F.when(F.col("rule").isNull(), canonical(F.col("host"), F.col("path"))))
    found = listed_flag(parts, "_canonical", listed, listed_key, "page_id")
    return found.select("page_id", "host", "path", "rule", F.coalesce("_said", F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"))


def feed_urls(pages: DataFrame) -> DataFrame:
    """The list that the registered query uses: canonical urls that some page of the table gives with a feed's tracking tag."""
    host, path = url_parts(F.col("url"))
    return pages.where(F.col("url").contains("utm_source=feed")).select(canonical(host, path).alias("canonical")).distinct()


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, feed_urls(pages), "canonical")


ORACLE = r"""
WITH p AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
q AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
c AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') AS canonical FROM q),
r(said, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
listed AS (SELECT DISTINCT canonical FROM c WHERE contains(url, 'utm_source=feed'))
SELECT page_id, host, path,
       (SELECT arg_max(h || r.p, length(h || r.p)) FROM r WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, r.p)) AS rule,
       coalesce((SELECT arg_max(said, length(h || r.p)) FROM r WHERE (c.host = h OR ends_with(c.host, '.' || h)) AND starts_with(c.path, r.p)),
                CASE WHEN c.canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM c
"""
