"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments (22, 21, 21 bits). Two fingerprints that differ in at most two
bits agree wholly in some segment, and differ in at most two bits in the next. Each segment, as a 23-bit word, is
decoded to the indices of the Golay codewords within distance 4 of it: one if its nearest codeword is within 2,
else six; any two words within distance 2 share one. So the keys are (i, segment i, an index of segment i + 1):
16 on average, 33 bits wide, and every link has a shared key.

Keys, of any size, are joined over distinct fingerprints: each fingerprint is verified against the least one under
each of its keys. That settles keys of two, and groups around their least fingerprint, in rows as many as keys. Where
more fingerprints of a key are still in different components, these alone are joined through their neighbourhoods: the 65
words at distance 0 or 1. Two fingerprints are within 2 of each other just if they share such a word, and at most 65
can; so the work is linear, whatever a key's or a group's size, and no pairs of a group are spelt out.

Components come from alternating large-star and small-star rounds, until nothing changes; each round is written to the
shared folder.

Defined results: texts without words have fingerprint zero, and link like any other; null ids never name a
component (a component of null ids alone has null); repeated rows get equal results; an empty table gives an empty one;
very long texts are hashed whole; other columns are kept, and a new column whose name is taken gets "_" put behind it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import discarding, free, materialise, table

SHINGLE = 3
SEED = 42
RADIUS = 2
#: The generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
POLYNOMIAL = 0b101011100011


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    w = raw.lower().split()
    if not w:
        return 0
    if len(w) < size:
        shingles = iter([b" ".join(w)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(w[k:] for k in range(size)), strict=False))
        n = len(w) - size + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        ones += np.unpackbits(h[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(x or b"") for x in batch.column(0).to_pylist()), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), *batch.columns[1:]], names=["simhash_fp", *batch.schema.names[1:]])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """simhash_fp (long) and the kept columns."""
    own = docs.select(F.col(text).cast("binary").alias("simhash_raw"), *keep)
    schema = ", ".join(["simhash_fp long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[1:])])
    return own.mapInArrow(_fingerprints, schema)


# --- Golay decoding ---------------------------------------------------------------------------------------


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    x = words.astype(np.int64).copy()
    for k in range(22, 10, -1):
        x ^= np.where(x >> k & 1, POLYNOMIAL << (k - 11), 0)
    return x


def _decoder() -> np.ndarray:
    """For each syndrome, six masks: word ^ mask is a codeword within distance 4. Where there is one such, it comes six times."""
    by: dict[int, list[int]] = {s: [] for s in range(2048)}
    bits = [1 << k for k in range(23)]
    at = [int(s) for s in _syndrome(np.asarray(bits))]
    errors = [(0, 0)]
    for weight in range(5):
        for e, s in errors:
            by[s].append(e)
        errors = [(e | bits[k], s ^ at[k]) for e, s in errors for k in range(e.bit_length(), 23)] if weight < 4 else []
    out = np.zeros((2048, 6), dtype=np.int64)
    for s, masks in by.items():
        assert len(masks) in (1, 6)
        out[s] = (masks * 6)[:6]
    return out


_MASKS: list[np.ndarray] = []


def golay_indices(words: np.ndarray) -> np.ndarray:
    """n x 6: 12-bit indices of the codewords within distance 4 of each 23-bit word (one six times, or six)."""
    if not _MASKS:
        _MASKS.append(_decoder())
    return (words[:, None].astype(np.int64) ^ _MASKS[0][_syndrome(words)]) >> 11


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints; a fingerprint's keys are distinct."""
    x = prints.astype(np.uint64)
    segments = [(x >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in ((0, 22), (22, 21), (43, 21))]
    rows, out = [], []
    for i in range(3):
        index = golay_indices(segments[(i + 1) % 3])
        first = np.ones_like(index, dtype=bool)
        first[:, 1:] = index[:, 1:] != index[:, :1]
        key = (np.int64(i) << 34) | (segments[i][:, None] << 12) | index
        rows.append(np.repeat(np.arange(len(x)), 6)[first.ravel()])
        out.append(key.ravel()[first.ravel()])
    return np.concatenate(rows), np.concatenate(out)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        rows, key = keys(fp.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[rows])], names=["key", "fp"])


def links(distinct: DataFrame) -> DataFrame:
    """a < b: verified links between distinct fingerprints that connect just what links within RADIUS connect."""
    keyed = distinct.select("fp").mapInArrow(_keyed, "key long, fp long")
    stars = materialise(keyed.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1"), "simhash-keys")
    met = materialise(keyed.join(stars, "key"), "simhash-met")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= RADIUS
    first = materialise(met.where("a <> fp").where(near).select("a", F.col("fp").alias("b")).distinct(), "simhash-stars")
    roots = components(first)
    many = met.where("n > 2").select("key", "fp").join(roots, F.col("fp") == F.col("node"), "left").select("key", "fp", F.coalesce("root", "fp").alias("root"))
    apart = many.groupBy("key").agg(F.min("root").alias("l"), F.max("root").alias("m")).where("l <> m").select("key")
    rest = many.join(apart, "key", "left_semi").select("fp").distinct()
    steps = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    spread = rest.select("fp", F.explode(steps).alias("step")).select("fp", F.col("fp").bitwiseXOR(F.col("step")).alias("word"))
    # at most 65 fingerprints meet in a word
    met = spread.groupBy("word").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    met = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b")
    return first.unionByName(met).distinct()


#: Rounds double what a component has gathered, so this many never come; to stop short of the end would give wrong groups.
ROUNDS = 200


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for the nodes of edges a, b."""
    spark = edges.sparkSession
    with discarding(spark):
        edges = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "cc", keep=True)
    seen = None
    for _ in range(ROUNDS):
        with discarding(spark):
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            # large star: larger neighbours go to the least of the neighbourhood
            least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            large = materialise(large, "cc-large")
            # small star: smaller neighbours, and the node, go to the least
            least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
            small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
            edges = materialise(small.where("u <> v").distinct(), "cc", keep=True)
        mark = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("u")).first())
        if mark == seen and mark[0] == mark[2]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
    raise RuntimeError(f"components have not settled in {ROUNDS} rounds")


def near_duplicates(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """kept columns (doc_id among them), fp and component_id."""
    names = {"simhash_fp": free(docs.select(*keep), "fp"), "simhash_component": free(docs.select(*keep), "component_id")}
    with discarding(docs.sparkSession):
        prints = materialise(fingerprints(docs, keep, text), "simhash", keep=True)
        distinct = materialise(prints.groupBy(F.col("simhash_fp").alias("fp")).agg(F.min(doc_id).alias("least")), "simhash-distinct")
        roots = components(links(distinct))
        grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        named = grouped.groupBy("root").agg(F.min("least").alias("simhash_component"))
        named = materialise(grouped.select(F.col("fp").alias("simhash_fp"), "root").join(named, "root").select("simhash_fp", "simhash_component"), "simhash-named", keep=True)
    return prints.join(named, "simhash_fp").select(*keep, *(F.col(own).alias(name) for own, name in names.items()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
