"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A listed entry is `host/path`; it fits its host, that host's subdomains, and the paths that start with its
path. A page's keys are the pairs of its host's suffixes (of up to as many labels as any listed host has) with its path's
prefixes (of lengths that occur in the list). Keys pass a filter of 256-bit blocks; those that may be listed meet the list in a hash join, which
removes the filter's errors. The filter is broadcast: its size is set from the list's count and never exceeds
MAX_BLOCKS rows; beyond that its error rate rises, not its size, and the join still decides.

Defined results: a null url, or one without `://`, has empty host and path and no keys; very long hosts and paths are kept
whole, and give no more keys than the list can match; equal rows stay as many as they were; an empty list lets all pass; an
empty table gives an empty one; a result column whose name is taken gets "_" put behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import free, table

BITS_PER_KEY = 12
MAX_BLOCKS = 1 << 18
#: A list of at most so many entries is broadcast for the exact join; a longer one is shuffled.
BROADCAST_ENTRIES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The contract's rules: they decide before the list does.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: The list that the query passes, by rule: every pair of a lure and a ware as an advertising host, under three ends.
LURES, WARES = ("casino", "cheap", "free", "instant", "lucky", "magic", "secret", "spam"), ("bets", "cash", "farm", "loans", "pills", "prizes", "watches", "win")
LISTED = tuple(f"{lure}-{ware}.example.{end}/" for lure in LURES for ware in WARES for end in ("com", "net", "org"))

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def listing(spark: SparkSession, rules=RULES, listed=LISTED) -> DataFrame:
    """entry, verdict, tier: rules are tier 1 and outrank the list's tier 0."""
    rows = [(e, v, 1) for e, v in rules] + [(e, "block", 0) for e in listed]
    each = [F.struct(F.lit(e).alias("entry"), F.lit(v).alias("verdict"), F.lit(t).alias("tier")) for e, v, t in rows]
    return spark.range(1).select(F.inline(F.array(*each)))


def _masks(key: Column) -> list[Column]:
    """Two bits in each of a block's four 64-bit words."""
    h = F.xxhash64(key, F.lit("bits"))
    bit = lambda at: F.expr("1L") * F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at).bitwiseAND(F.lit(63)).cast("int"))
    return [bit(12 * i).bitwiseOR(bit(12 * i + 6)) for i in range(4)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """block, w0..w3: the filter, a row for each block that is not empty."""
    own = listed.select(_block(F.col("entry"), blocks).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("entry")))))
    return own.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)))


def judge(pages: DataFrame, listed: DataFrame, keep: list[str], url: str = "url") -> DataFrame:
    """keep columns, host, path, rule (a fitting tier-1 entry) and verdict (the rule's, else the list's, else allow)."""
    listed = listed.where("entry IS NOT NULL").dropDuplicates(["entry", "tier"])
    path_len = F.length("entry") - F.instr(F.col("entry"), "/") + 1
    deep = F.size(F.split(F.substring_index("entry", "/", 1), r"\."))
    n, lengths, depth = listed.agg(F.count("*"), F.collect_set(path_len), F.coalesce(F.max(deep), F.lit(0))).first()  # numbers, and lengths of paths
    blocks = max(1, min(MAX_BLOCKS, -(-n * BITS_PER_KEY // 256)))
    labels = F.split("host", r"\.")
    none = F.array().cast("array<string>")
    suffixes = F.when((F.col("host") == "") | F.lit(depth == 0), none).otherwise(F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, depth)))), lambda k: F.array_join(F.slice(labels, -k, k), ".")))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, sorted(lengths))).cast("array<int>"), lambda k: k <= F.length("path")), lambda k: F.substring("path", F.lit(1), k))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda q: F.concat(s, q))))
    own = pages.select(F.struct(*keep).alias("kept"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # the null key stands for the row itself
    asked = own.withColumn("key", F.explode(F.concat(F.array(F.lit(None).cast("string")), keys)))
    asked = asked.withColumns({"block": _block(F.col("key"), blocks)} | {f"m{i}": m for i, m in enumerate(_masks(F.col("key")))})
    passed = asked.join(F.broadcast(bloom_blocks(listed, blocks)), "block", "left")
    may = F.lit(True)
    for i in range(4):
        may = may & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    passed = passed.where(F.col("key").isNull() | may).select("kept", "host", "path", "key")
    exact = listed.withColumnRenamed("entry", "key")
    exact = F.broadcast(exact) if n <= BROADCAST_ENTRIES else exact.hint("shuffle_hash")
    met = passed.join(exact, "key", "left")
    best = F.max(F.when(F.col("tier").isNotNull(), F.struct(F.col("tier"), F.length("key").alias("n"), F.col("key").alias("entry"), F.col("verdict"))))
    out = met.groupBy("kept", "host", "path").agg(best.alias("best"), F.count_if(F.col("key").isNull()).alias("times"))
    out = out.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    rule = F.when(F.col("best.tier") == 1, F.col("best.entry"))
    name = lambda x: free(pages.select(*keep), x)
    return out.select("kept.*", F.col("host").alias(name("host")), F.col("path").alias(name("path")), rule.alias(name("rule")), F.coalesce("best.verdict", F.lit("allow")).alias(name("verdict")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "pages"), listing(spark), ["page_id", "url"])
    return out.select("page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    rows = ", ".join(f"('{e}', '{v}', {t})" for e, v, t in [(e, v, 1) for e, v in RULES] + [(e, "block", 0) for e in LISTED])
    return rf"""
WITH l(entry, verdict, tier) AS (VALUES {rows}),
p AS (SELECT row_number() OVER () AS r, page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
f AS (SELECT r, entry, verdict, tier, row_number() OVER (PARTITION BY r ORDER BY tier DESC, length(entry) DESC) AS k FROM p JOIN l
  ON ends_with('.' || p.host, '.' || split_part(l.entry, '/', 1)) AND starts_with(p.path, substr(l.entry, strpos(l.entry, '/'))) AND p.host <> '')
SELECT page_id, host, path, CASE WHEN tier = 1 THEN entry END AS rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT * FROM f WHERE k = 1) USING (r)"""
