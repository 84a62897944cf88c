"""Document files in a folder: pages of PDF files, with a plainer extractor behind, and audio in WAV files."""

from __future__ import annotations

import io
import re
import wave
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES = "array<struct<page:int,text:string>>"
#: Up to so many bytes of a file are read whole by one task.
LONGEST = 256 << 20

_STREAM = re.compile(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
_SHOWN = re.compile(rb"\((?:\\.|[^\\()])*\)|(?:T\*|Td|TD|')(?![A-Za-z])")
_ESCAPED = re.compile(rb"\\([nrtbf()\\]|[0-7]{1,3}|\r?\n)")
_PLAIN = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _literal(raw: bytes) -> str:
    def put(m: re.Match) -> bytes:
        x = m[1]
        return bytes((int(x, 8) & 255,)) if x[:1].isdigit() else b"" if x[-1:] == b"\n" else _PLAIN.get(x, x)

    return _ESCAPED.sub(put, raw).decode("latin-1")


def pdf_pages(raw: bytes) -> list[tuple[int, str]] | None:
    """(page from 1, text) of a PDF file's text streams, blank pages left out; None where none can be read."""
    if not raw.startswith(b"%PDF"):
        return None
    out, page = [], 0
    for m in _STREAM.finditer(raw):
        body = m[2]
        try:
            body = zlib.decompress(body) if b"FlateDecode" in m[1] else body
        except zlib.error:
            continue
        if b"BT" not in body:
            continue
        page += 1
        text = "".join(_literal(x[1:-1]) if x[:1] == b"(" else "\n" for x in _SHOWN.findall(body)).strip()
        if text:
            out.append((page, text))
    return out if page else None


def whole_text(raw: bytes) -> list[tuple[int, str]] | None:
    """The file's text as page 1, if it is text; None otherwise."""
    try:
        text = raw.decode("utf-8").strip()
    except UnicodeDecodeError:
        return None
    return [(1, text)] if text and not raw.startswith(b"%PDF") else None


def _udf(f, kind: str):
    @F.pandas_udf(kind)
    def run(files: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in files:
            yield pd.Series([f(bytes(x)) if x is not None else None for x in s], dtype=object)

    return run


def page_extractor(content: Column) -> Column:
    """array<struct<page, text>>: by the first extractor that can read the file, empty where none can."""
    pages = lambda f: lambda raw: None if (got := f(raw)) is None else [{"page": p, "text": t} for p, t in got]
    return F.coalesce(_udf(pages(pdf_pages), PAGES)(content), _udf(pages(whole_text), PAGES)(content), F.array().cast(PAGES))


def scan(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """filename, content of a folder's files, not of its subfolders; a folder without such files gives no rows."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false")
    out = read.load(folder).where(F.col("length") <= LONGEST)
    return out.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "content")


def pages(files: DataFrame) -> DataFrame:
    """filename, page, text: a row for each page."""
    return files.select("filename", F.inline(page_extractor(F.col("content"))))


def wav_chunks(files: DataFrame, frames: int = 4000) -> DataFrame:
    """filename, chunk, rate, n_frames, samples (binary) of WAV files in chunks of so many frames, as a recogniser takes them."""

    def cut(raw: bytes) -> list[dict] | None:
        out = []
        try:
            with wave.open(io.BytesIO(raw)) as w:
                while part := w.readframes(frames):
                    out.append({"rate": w.getframerate(), "n_frames": len(part) // (w.getsampwidth() * w.getnchannels()), "samples": part})
        except (wave.Error, EOFError):
            return None
        return out

    made = _udf(cut, "array<struct<rate:int,n_frames:int,samples:binary>>")(F.col("content"))
    return files.select("filename", F.posexplode(made).alias("chunk", "x")).select("filename", "chunk", "x.rate", "x.n_frames", "x.samples")


def wav_bytes(samples: Column, rate: int = 16_000) -> Column:
    """binary: 16-bit mono samples (binary) as a WAV file."""

    def put(raw: bytes) -> bytes:
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(rate)
            w.writeframes(raw)
        return out.getvalue()

    return _udf(put, "binary")(samples)
