"""Similarity search and semantic dedup. Blocks of vectors meet in matrix products, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import vector as V
from lexmill.sources.store import written

#: Queries that are broadcast at once; a longer set is taken in blocks of this many.
QUERY_BLOCK = 4096
#: Rows of a block in semantic_dedup; a task holds two blocks.
BLOCK_ROWS = 20_000


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(x, dtype=np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True) if m.size else np.ones((len(m), 1))
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def knn(memory: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vec: str = "embedding", metric: str = "l2", least: float | None = None) -> DataFrame:
    """The k nearest rows of memory for each query: query_id, key, value, rank (from 1; ties by key).

    Each partition of memory keeps its own k best, so k rows a query and partition are shuffled.
    """
    spark, total, out = memory.sparkSession, queries.count(), None
    numbered = queries.select(F.col(key).alias("query_id"), F.col(vec).alias("q"))
    rounds = max(1, -(-total // QUERY_BLOCK))
    for r in range(rounds):
        part = numbered.where(F.pmod(F.xxhash64("query_id"), F.lit(rounds)) == r).toPandas()
        held = spark.sparkContext.broadcast((part["query_id"].tolist(), _matrix(part["q"])))

        def best(batches, held=held):
            ids, q = held.value
            kept: dict = {}
            for pdf in batches:
                if not len(pdf) or not len(ids):
                    continue
                m = _matrix(pdf[vec])
                keys = pdf[key].to_numpy()
                value = ((q**2).sum(1)[:, None] - 2 * q @ m.T + (m**2).sum(1)[None, :]) if metric == "l2" else -(_unit(q) @ _unit(m).T)
                kth = np.partition(value, k - 1, axis=1)[:, k - 1] if value.shape[1] > k else np.full(len(ids), np.inf)
                for i, qid in enumerate(ids):
                    some = np.flatnonzero(value[i] <= kth[i])  # the k least, and what ties with the last
                    order = some[np.lexsort((keys[some], value[i][some]))[:k]]
                    kept[qid] = sorted([*kept.get(qid, []), *zip(value[i][order].tolist(), keys[order].tolist(), strict=True)])[:k]
            rows = [(qid, key_, v if metric == "l2" else -v) for qid, best_ in kept.items() for v, key_ in best_]
            yield pd.DataFrame(rows, columns=["query_id", key, "value"]).astype({"query_id": "int64", key: "int64", "value": "float64"})

        found = memory.select(key, vec).mapInPandas(best, f"query_id long, {key} long, value double")
        if rounds > 1:  # one block of queries is held at a time
            found = written(found, "knn")
            held.unpersist()
        out = found if out is None else out.unionByName(found)
    if least is not None:
        out = out.where(F.col("value") >= least)
    order = F.col("value") if metric == "l2" else F.col("value").desc()
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, key)))
    return out.where(F.col("rank") <= k)


def semantic_dedup(df: DataFrame, threshold: float, key: str = "vec_id", vec: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Keys of rows with no earlier row (by key) of cosine similarity at threshold or over.

    Rows are dealt into blocks of about block_rows; a pair of blocks meets in one task, as a matrix product. Only keys
    come out. The number of blocks follows from the count, so a task's memory doesn't grow with the table.
    """
    blocks = max(1, -(-df.count() // block_rows))
    own = df.select(key, vec, F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("b"))
    others = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(F.least(F.col("b"), o).alias("lo"), F.greatest(F.col("b"), o).alias("hi")))
    dealt = own.withColumn("cell", F.explode(others))

    def late(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, m = pdf[key].to_numpy(), _unit(_matrix(pdf[vec]))
        gone = np.zeros(len(pdf), dtype=bool)
        for at in range(0, len(pdf), 1000):
            hit = (m[at : at + 1000] @ m.T >= threshold) & (keys[None, :] < keys[at : at + 1000, None])
            gone[at : at + 1000] = hit.any(axis=1)
        return pd.DataFrame({key: keys[gone]})

    dropped = dealt.groupBy("cell").applyInPandas(late, f"{key} long").distinct()
    return df.select(key).join(dropped, key, "left_anti")


def semantic_dedup_in_blocks(df: DataFrame, threshold: float, key: str = "vec_id", vec: str = "embedding", size: int = 1000) -> DataFrame:
    """Keys kept by the sequential form: blocks of size rows in key order; the first is deduplicated within itself, each
    later one against what earlier blocks kept (not within itself). A block is broadcast, so its size bounds that."""
    from lexmill.operators.curation import ranked

    spark = df.sparkSession
    rows = written(ranked(df.select(key, vec), [F.col(key)], "place").withColumn("block", F.floor((F.col("place") - 1) / size)), "blocks")
    n = rows.agg(F.coalesce(F.max("block") + 1, F.lit(0))).first()[0]
    first = rows.where("block = 0")
    kept = written(first.join(semantic_dedup(first.select(key, vec), threshold, key, vec, size), key, "left_semi").select(key, vec), "kept")
    for b in range(1, n):
        block = rows.where(F.col("block") == b).select(key, vec)
        part = block.toPandas()
        held = spark.sparkContext.broadcast((part[key].to_numpy(), _unit(_matrix(part[vec]))))

        def near(batches, held=held):
            keys, m = held.value
            for pdf in batches:
                if len(pdf):
                    yield pd.DataFrame({key: keys[(m @ _unit(_matrix(pdf[vec])).T >= threshold).any(axis=1)]})

        gone = kept.mapInPandas(near, f"{key} long").distinct()
        kept = kept.unionByName(written(block.join(gone, key, "left_anti"), "kept"))
        held.unpersist()
    return kept.select(key)


def with_distance(found: DataFrame, value: str = "value") -> DataFrame:
    """Neighbours of unit vectors, found by squared distance, with that distance and the cosine it stands for."""
    return found.withColumns({"distance": F.col(value), "cosine": 1 - F.col(value) / 2})


def similarity(a: DataFrame, b: DataFrame, on: str, vec: str = "embedding") -> DataFrame:
    """Cosine of the vectors that two tables have under a key."""
    return a.select(on, F.col(vec).alias("va")).join(b.select(on, F.col(vec).alias("vb")), on).select(on, V.cosine(F.col("va"), F.col("vb")).alias("similarity"))
