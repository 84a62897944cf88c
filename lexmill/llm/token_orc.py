"""Token ids in ORC files: run-length-encoded integers in stripes, row indexes, Bloom filters on document ids.

Documents are range-partitioned and sorted by id, so the files stand in ascending id order and a stripe or row
group covers a narrow range of ids. A reader takes stripes in parallel, and skips those whose statistics or
Bloom filters exclude an id. Each row keeps its part (file), its token offset in the part and its count, so the
corpus offset of a document follows from sums over parts, of which there are as many as files.

Defined results: a null or empty text is the end id alone; null ids come first; equal ids stand next to each
other, in the order of their texts' hashes; an empty table gives files without rows; only id and text are read, so other columns can't
clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm.common import scratch_path, table
from lexmill.llm.tokens import Encoder

END_ID = 1
STRIPE_BYTES = 16 << 20
ROWS_IN_GROUP = 1000
SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"

_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """One for each Python worker."""
    return _encoders.get((path, kind)) or _encoders.setdefault((path, kind), Encoder(path, kind))


def tokenise(path: str, kind: str, end_id: int):
    """For mapInArrow over doc_id, raw: ids with the end id, and each document's offset in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = encoder(path, kind), TaskContext.get().partitionId(), 0
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for big in batches:
            for at in range(0, big.num_rows, 256):  # rows at once: bounds the ids in memory
                batch = big.slice(at, 256)
                rows = [enc.encode(x or b"") + end for x in batch.column(1).to_pylist()]
                counts = np.fromiter((len(x) // 4 for x in rows), dtype=np.int64, count=len(rows))
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(len(rows), part, dtype=np.int32)), pa.array(start + offsets[:-1].astype(np.int64)), pa.array(counts), ids],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"],
                )
                start += int(offsets[-1])

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, kind: str = "word", end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw"))
    ordered = own.repartitionByRange("doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("raw"))
    rows = ordered.mapInArrow(tokenise(tokenizer, kind, end_id), SCHEMA)
    options = {"compression": "zstd", "orc.stripe.size": STRIPE_BYTES, "orc.row.index.stride": ROWS_IN_GROUP, "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": 0.01}
    rows.write.options(**options).orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        flat, offsets = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(offsets[1:].astype(np.int64) - offsets[:-1]), pa.array(sums, pa.int64())], names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])


def digest(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each stored document."""
    sums = stored.select("doc_id", "part", "part_start", "ids").mapInArrow(_checksums, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    # a row for each file: their number is bounded by the partitions written, so one window and a broadcast hold them
    parts = stored.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    out = sums.join(F.broadcast(parts), "part")
    return out.select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return digest(read_ids(spark, path))
