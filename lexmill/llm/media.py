"""Media columns: texts stored as MPEG audio streams, and features read back from the stored bytes.

`store` writes a table with the streams, `features` scans streams row by row; both work in Arrow batches of at most
BATCH_BYTES of streams and BATCH_ROWS rows, so memory is bounded by that and the longest single text.

Defined results: a null or empty text has 0 bytes and a payload of 64 zero bytes; equal texts give equal streams;
very long texts take more frames, one after the other; repeated rows stay as many as they are; an empty table gives an
empty one; other columns pass through untouched, and a new column whose name is taken gets "_" put behind it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lexmill.llm import mpeg
from lexmill.llm.common import free, materialise, table

BLOCK = 64
BATCH_BYTES = 4 << 20
BATCH_ROWS = 512
FEATURES = (
    "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "n_frames long, n_samples long, sample_rate int, duration_s double, crc_ok long, crc_bad long, skipped_bytes long, "
    "mean_kbps double, seek_offsets array<long>, feature string"
)


def pad(data: bytes) -> bytes:
    return data + bytes(-len(data) % BLOCK if data else BLOCK)


def encode(raw: bytes | None) -> bytes:
    return mpeg.carry(pad(raw or b""), len(raw or b""))


def read(media: bytes) -> dict:
    """Features of a stored stream; the payload is what its frames carry."""
    x = mpeg.scan(media)
    payload = b"".join(x.bodies)[: int(x.tags.get("payload_bytes", 0))]
    bits = sum(k * n for k, n in x.bitrates.items())
    seek = b"".join(o.to_bytes(8, "little") for o in x.offsets)
    mean = bits / max(1, x.frames)
    return {
        "n_bytes": int(x.tags.get("n_bytes", 0)),
        "payload_bytes": len(payload),
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-BLOCK:]),
        "media_bytes": len(media),
        "media_sha256": hashlib.sha256(media).hexdigest(),
        "n_frames": x.frames,
        "n_samples": x.samples,
        "sample_rate": x.hz,
        "duration_s": x.samples / x.hz if x.hz else 0.0,
        "crc_ok": x.crc_ok,
        "crc_bad": x.crc_bad,
        "skipped_bytes": x.skipped,
        "mean_kbps": mean,
        "seek_offsets": x.offsets,
        "feature": f"mpeg1l3 {x.hz}Hz frames={x.frames}/{x.vbr.get('frames', 0)} samples={x.samples} crc={x.crc_ok}+{x.crc_bad} skipped={x.skipped} kbps={mean:.3f} seek={zlib.crc32(seek):08x}",
    }


def _appended(df: DataFrame, source: str, to: str, kind: str, each: Callable, drop: bool = False) -> DataFrame:
    """df with a column `to` of each(source's bytes), in batches bounded by bytes; drop: without the source."""
    own = [c for c in df.columns if not (drop and c == source)]
    given = df.select(*own, F.col(source).cast("binary").alias(free(df, "media_source")))
    schema = StructType([*given.schema.fields[:-1], *StructType.fromDDL(f"`{to}` {kind}").fields])
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws, at, made, size = batch.columns[-1], 0, [], 0
            for k in range(batch.num_rows):
                raw = raws[k].as_py()
                made.append(each(raw))
                size += len(raw or b"")
                if size >= BATCH_BYTES or len(made) == BATCH_ROWS or k == batch.num_rows - 1:
                    kept = [c.cast(t) for c, t in zip(batch.slice(at, len(made)).columns[:-1], types.types, strict=False)]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(made, types.types[-1])], schema=types)
                    at, made, size = k + 1, [], 0

    return given.mapInArrow(run, schema)


def store(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """df with the stream of each text (binary) in place of the text."""
    return _appended(df, text, media, "binary", encode, drop=True)


def features(df: DataFrame, media: str = "media", to: str = "media_features") -> DataFrame:
    """df with what a scan of its streams finds (struct)."""
    return _appended(df, media, to, f"struct<{FEATURES.replace(' ', ':').replace(',:', ',')}>", read)


def media_columns(df: DataFrame, text: str = "text", media: str = "media", to: str = "media_features") -> DataFrame:
    """df with the stored stream (binary) and the features read back from it (struct)."""
    media, to = free(df, media), free(df, to)
    return features(_appended(df, text, media, "binary", encode), media, to)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialise(store(table(spark, sf_dir, "documents").select("doc_id", "text")), "media")
    names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "n_samples", "sample_rate", "duration_s", "seek_offsets")
    return features(stored).select("doc_id", *(F.col(f"media_features.{x}").alias(x) for x in names))
