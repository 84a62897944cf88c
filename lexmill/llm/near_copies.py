"""Near copies: documents linked by similarity of their five-word shingles, of which one of each group stays.

A document's set is its distinct shingles of SHINGLE words in lower case (a shorter text is one shingle). Two documents
are linked if their sets' Jaccard similarity is at least THRESHOLD; a group is a component of links. Documents of equal
sets are one node before the join.

Links are found in two steps. The first is SimHash with Golay keys (simhash.keys) on a fingerprint of the set: under each
key, and under the two least and the two greatest hashes of the set, nodes are compared with the earliest one there,
which costs a group what its documents do. Fingerprints of 64 bits reach a similarity of 0.8 in few cases (about ten bits
differ), so a second step compares what is still in different components: pairs that share a shingle of their prefix,
the first n - ceil(t n) + 1 by rarity (by how many documents the shingle's bucket has, then by hash). Linked documents
share one, so no link is missed, and groups come out as from all pairs. Pairs have to pass the length and positional filters
and a comparison of parities, which bound their difference from below; then the whole sets decide. A set's parity has two to
four bits for each shingle, whatever its size, so few pairs that aren't links get as far as the sets. The prefix join takes its
keys in PASSES parts and the sets are compared CHUNK pairs at a time: texts are never shuffled, and what is on disk at once stays small.

Defined results: shingles are told apart by 56 bits of hash; texts without words have one set, and link with each other;
exactly one row of a group stays, also under null ids and repeated rows; an empty table stays empty; other columns pass
through.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import discarding, materialise, single
from lexmill.llm.simhash import components, keys

SHINGLE = 5
_NUM, _DEN = 4, 5  # the threshold, Jaccard 0.8, as a fraction: filters in whole numbers
BUCKETS = 1 << 18
#: 64-bit words of a set's parity, at least: a power of two.
WORDS = 4
#: The prefix join takes its keys in so many parts, one after the other.
PASSES = 4
#: Whole sets of so many pairs are compared at once; their documents, at most twice as many, are broadcast to pick the texts.
CHUNK = 250_000
#: Up to so many nodes are broadcast to a join; more are joined by shuffle.
BROADCAST_DOCS = 500_000
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(raw: bytes, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending."""
    w = raw.lower().split()
    size = min(size, len(w))
    n = max(1, len(w) - size + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = out * _STEP + h[k : k + n]
        out ^= out >> np.uint64(31)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return np.unique(out)


def places(hashes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Rank and hash in one positive number, ascending from the rarest."""
    rank = ranks[(hashes & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.int64)
    return np.unique(rank << 56 | (hashes >> np.uint64(8)).astype(np.int64))


def parity(toks: np.ndarray) -> np.ndarray:
    """The parity of the tokens that fall on each bit, in 64-bit words: the least power of two that gives two bits a token."""
    bits = 64 * max(WORDS, 1 << ((len(toks) - 1) // 32).bit_length())
    return np.packbits(np.bincount(toks & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").view("<i8")


def _lists(rows: list[np.ndarray]) -> pa.Array:
    at = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for x in batch.column(0).to_pylist():
            np.add.at(seen, (shingles(x or b"") & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
    at = np.flatnonzero(seen)
    for k in range(0, len(at), 1 << 16):
        own = at[k : k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(seen[own])], names=["b", "n"])


def rarity(docs: DataFrame) -> np.ndarray:
    """A byte for each bucket of shingles, four to each doubling of the documents in it. Its size is fixed."""
    counts = docs.select(F.col("text").cast("binary")).mapInArrow(_count, "b int, n long").groupBy("b").agg(F.sum("n").alias("n"))
    got = counts.select("b", F.least(F.lit(127), 1 + F.floor(4 * F.log2(1 + F.col("n")))).cast("byte").alias("r")).toArrow()
    out = np.ones(BUCKETS, dtype=np.uint8)
    out[got.column("b").to_numpy()] = got.column("r").to_numpy()
    return out


def star_keys(hashes: np.ndarray) -> np.ndarray:
    """Golay keys of the set's SimHash fingerprint, and the two least and two greatest hashes; those are told from keys by their sign."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    print_ = np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")
    ends = np.concatenate((hashes[:2], hashes[-2:])).view(np.int64) | np.int64(-1 << 63)
    return np.unique(np.concatenate((keys(print_)[1], ends)))


def sketches(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """doc_id, copy_text, sig (names the set), n, wide (parities), stars (keys) and prefix of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 512):
                batch = big.slice(at, 512)
                sig, size, wide, stars, prefix = [], [], [], [], []
                for x in batch.column(2).to_pylist():
                    hashes = shingles(x or b"")
                    toks = places(hashes, ranks)
                    n = len(toks)
                    sig.append(xxhash.xxh64_intdigest(toks.tobytes()))
                    size.append(n)
                    wide.append(parity(toks))
                    stars.append(star_keys(hashes))
                    prefix.append(toks[: n + (-n * _NUM // _DEN) + 1])
                cols = [pa.array(np.asarray(sig, dtype=np.uint64).view(np.int64)), pa.array(size, pa.int32()), _lists(wide), _lists(stars), _lists(prefix)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["doc_id", "copy_text", "sig", "n", "wide", "stars", "prefix"])

    own = docs.select("doc_id", "copy_text", F.col("text").cast("binary").alias("raw"))
    return own.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, copy_text long, sig long, n int, wide array<long>, stars array<long>, prefix array<long>")


def sets(docs: DataFrame, distinct: DataFrame, pairs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """sig, toks: the whole sets of the nodes of pairs, from their documents' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                yield pa.RecordBatch.from_arrays([some.column(0), _lists([places(shingles(x or b""), ranks) for x in some.column(1).to_pylist()])], names=["sig", "toks"])

    named = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct().join(distinct, "sig")
    named = materialise(named.select("sig", F.col("least.doc_id").alias("own_id"), F.col("least.copy_text").alias("own_text")), "copies-named")
    texts = docs.select("doc_id", "copy_text", "text").join(F.broadcast(named), F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("copy_text") == F.col("own_text")))
    made = texts.select("sig", F.col("text").cast("binary").alias("raw")).mapInArrow(run, "sig long, toks array<long>")
    return materialise(made.dropDuplicates(["sig"]), "copies-sets")


def _need(na: Column, nb: Column) -> Column:
    return F.ceil((na + nb) * _NUM / F.lit(_NUM + _DEN))


def _sizes() -> Column:
    return (F.col("n_a") * _DEN >= F.col("n_b") * _NUM) & (F.col("n_b") * _DEN >= F.col("n_a") * _NUM)


def _near() -> Column:
    na, nb, ia, ib = (F.col(c) for c in ("n_a", "n_b", "at_a", "at_b"))
    follow = F.least(ia, ib) + F.least(na - ia, nb - ib)
    return _sizes() & (follow >= _need(na, nb))


def _apart() -> Column:
    """A lower bound of the distance of two sets, by their parities: sizes of sets that match are less than one doubling apart."""
    both = F.least(F.size("wide_a"), F.size("wide_b"))
    differ = lambda x, y: x.bitwiseXOR(y)
    fold = lambda w: F.when(F.size(w) > both, F.zip_with(F.slice(w, F.lit(1), both), F.slice(w, both + 1, both), differ)).otherwise(F.col(w))
    return F.aggregate(F.zip_with(fold("wide_a"), fold("wide_b"), differ), F.lit(0), lambda s, w: s + F.bit_count(w))


def close(distinct: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of pairs a, b of sizes that can match, those whose parities don't tell them apart."""
    side = lambda x: distinct.select(F.col("sig").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}"))
    na, nb = F.col("n_a"), F.col("n_b")
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(_apart() <= na + nb - 2 * _need(na, nb))
    return materialise(near.select("a", "b"), "copies-close", keep=True)


def verify(docs: DataFrame, distinct: DataFrame, pairs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Of the pairs a, b that are close, those whose sets have at least the threshold's similarity."""
    na, nb, parts, chunks = F.col("n_a"), F.col("n_b"), [], -(-pairs.count() // CHUNK)
    for k in range(max(1, chunks)):
        with discarding(docs.sparkSession):
            some = pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(chunks)) == k) if chunks > 1 else pairs
            whole = sets(docs, distinct, some, ranks)
            both = some.join(whole.select(F.col("sig").alias("a"), F.col("toks").alias("toks_a")), "a").join(whole.select(F.col("sig").alias("b"), F.col("toks").alias("toks_b")), "b")
            both = both.select("a", "b", F.size("toks_a").alias("n_a"), F.size("toks_b").alias("n_b"), F.size(F.array_intersect("toks_a", "toks_b")).alias("shared"))
            parts.append(materialise(both.where(F.col("shared") * _DEN >= (na + nb - F.col("shared")) * _NUM).select("a", "b"), "copies-links", keep=True))
    return functools.reduce(DataFrame.unionByName, parts)


def groups(docs: DataFrame, distinct: DataFrame, ranks: np.ndarray) -> DataFrame:
    """node, root for the nodes that have a link."""
    place = F.struct("least.last", "least.doc_id", "least.copy_text")
    keyed = distinct.select("sig", "n", place.alias("place"), F.explode("stars").alias("key"))
    ends = [F.least("sig_a", "sig_b").alias("a"), F.greatest("sig_a", "sig_b").alias("b")]
    # the first step: each key's nodes with the earliest of them
    one = keyed.groupBy("key").agg(F.min(F.struct("place", "sig", "n")).alias("s"), F.count("*").alias("met")).where("met > 1")
    one = one.select("key", F.col("s.sig").alias("sig_a"), F.col("s.n").alias("n_a"))
    met = keyed.select("key", F.col("sig").alias("sig_b"), F.col("n").alias("n_b")).join(one, "key").where("sig_a <> sig_b").where(_sizes())
    tried = materialise(met.select(*ends).distinct(), "copies-first")
    first = verify(docs, distinct, close(distinct, tried), ranks)
    roots = materialise(components(first), "copies-roots")
    # the second: what is still apart
    few = roots.count() <= BROADCAST_DOCS
    rooted = distinct.join(F.broadcast(roots) if few else roots, distinct["sig"] == roots["node"], "left")
    bits = F.aggregate("wide", F.lit(0).cast("long"), lambda s, w: s.bitwiseXOR(w))
    rooted = materialise(rooted.select("sig", "n", F.coalesce("root", "sig").alias("root"), bits.alias("bits"), "prefix"), "copies-open")
    open_ = rooted.select("*", F.posexplode("prefix").alias("at", "key"))
    open_ = open_.select("key", "sig", "n", "root", "bits", "at", F.when(F.col("at") > 0, F.get("prefix", F.col("at") - 1)).alias("before"))
    parts = []
    for k in range(PASSES):
        own = open_.where(F.pmod("key", F.lit(PASSES)) == k)
        sides = [own.select("key", *(F.col(c).alias(f"{c}_{x}") for c in own.columns if c != "key")) for x in "ab"]
        pairs = sides[0].join(sides[1], "key").where("sig_a < sig_b and root_a <> root_b").where(_near())
        pairs = pairs.where(F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= F.col("n_a") + F.col("n_b") - 2 * _need(F.col("n_a"), F.col("n_b")))
        # where the shingles before are shared too, the pair has come by them
        with discarding(docs.sparkSession):
            met = materialise(pairs.where(~F.coalesce(F.col("before_a") == F.col("before_b"), F.lit(False))).select(*ends).distinct(), "copies-second")
            parts.append(close(distinct, met))
    pairs = functools.reduce(DataFrame.unionByName, parts).distinct().join(tried, ["a", "b"], "left_anti")
    second = verify(docs, distinct, materialise(pairs, "copies-open-pairs"), ranks)
    return roots if second.isEmpty() else components(first.unionByName(second))


def goers(docs: DataFrame) -> DataFrame:
    """goes_id, goes_text: id and text hash of the rows (doc_id, text, copy_text) that don't stay."""
    with discarding(docs.sparkSession):
        ranks = rarity(docs)
        with discarding(docs.sparkSession):
            found = materialise(sketches(docs, ranks), "copies")
            # of the same sets, nodes; a document without an id stands for one only where none has an id
            place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "copy_text")
            one = found.groupBy("sig").agg(F.min(place).alias("least"), *(F.first(c).alias(c) for c in ("n", "wide", "stars", "prefix")))
            distinct = materialise(one, "copies-distinct", keep=True)
            found = materialise(found.select("doc_id", "copy_text", "sig"), "copies-found", keep=True)
        with discarding(docs.sparkSession):
            roots = materialise(groups(docs, distinct, ranks), "copies-groups", keep=True)
        grouped = distinct.select("sig", "least").join(roots, F.col("sig") == F.col("node"), "left").select("sig", "least", F.coalesce("root", "sig").alias("root"))
        named = grouped.groupBy("root").agg(F.min("least").alias("stays"))
        named = materialise(grouped.select("sig", "root").join(named, "root").select("sig", "stays"), "copies-stay")
        stays = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("copy_text") == F.col("stays.copy_text"))
        goes = found.join(named, "sig").where(~stays)
        return materialise(goes.select(F.col("doc_id").alias("goes_id"), F.col("copy_text").alias("goes_text")).distinct(), "copies-goes", keep=True)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group stays: that of the least id (null ids last), then of the least text hash; of rows
    that share both, one."""
    marked = docs.withColumn("copy_text", F.xxhash64("text"))
    goes = goers(marked.select("doc_id", "text", "copy_text"))
    left = marked.join(goes, F.col("doc_id").eqNullSafe(F.col("goes_id")) & (F.col("copy_text") == F.col("goes_text")), "left_anti")
    return single(left, ["doc_id", "copy_text"]).select(*docs.columns)
