"""Packing documents' token ids into sequences: bounded-space online best fit.

Each partition keeps OPEN windows. A document's full sequences leave at once; its rest goes to the open window
that it fits most tightly. When none fits, the fullest window is filled up by a cut of the rest and emitted.
What stays open at the end is merged in groups of GROUP partitions: best fit from the longest, then the
emptiest windows' pieces fill the others, and a group's last window is cut into powers of two, which need
no padding. A window never holds more than LENGTH ids, so a group's size is bounded.

Defined results: a null or empty text is the end id alone; repeated rows are packed as documents of their own;
an empty table gives no pieces; only id and text are read, so other columns can't clash. Sequence ids are unique; they depend on how the input is split, pieces' ids don't.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import materialise, table
from lexmill.llm.token_orc import encoder

LENGTH = 1024
OPEN = 16
GROUP = 16
END_ID = 0
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
#: Sequence ids of the merge start here; those of partitions are partition * 2^32 + count.
MERGED = 1 << 30


class Piece:
    """A run of a document's ids; ids is a view, so a cut copies nothing."""

    __slots__ = ("doc_id", "start", "ids", "total")

    def __init__(self, doc_id, start: int, ids: bytes | memoryview, total: int):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, memoryview(ids), total

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc_id, self.start, self.ids[: 4 * n], self.total), Piece(self.doc_id, self.start + n, self.ids[4 * n :], self.total)


class Packer:
    """Open windows ordered by free space; emits (sequence number, pieces) when a window is full."""

    def __init__(self, length: int = LENGTH, limit: int = OPEN):
        self.length, self.limit = length, limit
        self.free: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.windows: dict[int, list[Piece]] = {}
        self.made = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece) >= self.length:
            head, piece = piece.cut(self.length)
            yield [head]
        piece.ids = memoryview(bytes(piece.ids))  # a rest that waits in a window doesn't hold its whole document
        while len(piece):
            at = bisect_left(self.free, (len(piece), -1))
            if at < len(self.free):
                room, k = self.free.pop(at)
            elif len(self.free) < self.limit:
                room, k = self.length, self.made
                self.made += 1
                self.windows[k] = []
            else:
                room, k = self.free.pop(0)  # the fullest
            head, piece = piece.cut(min(room, len(piece)))
            self.windows[k].append(head)
            if room == len(head):
                yield self.windows.pop(k)
            else:
                insort(self.free, (room - len(head), k))


def _rows(pieces: list[Piece], sequence: int, keep: bool = False) -> list[tuple]:
    out, at = [], 0
    for p in pieces:
        out.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.total, sequence, at, bytes(p.ids) if keep else None))
        at += len(p)
    return out


def pack_partition(path: str, kind: str, end_id: int, keep_ids: bool):
    """For mapInArrow over doc_id, raw. Pieces of windows left open have no sequence id, and their ids."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * 7 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, count, packer, rows = encoder(path, kind), TaskContext.get().partitionId(), 0, Packer(), []
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for big in batches:
            for at in range(0, big.num_rows, 256):  # rows at once: bounds the texts in memory
                some = big.slice(at, 256)
                for doc_id, raw in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = enc.encode(raw or b"") + end
                    for pieces in packer.add(Piece(doc_id, 0, ids, len(ids) // 4)):
                        rows += _rows(pieces, part << 32 | count, keep_ids)
                        count += 1
                if len(rows) >= 2000:
                    yield batch(rows)
                    rows = []
        for pieces in packer.windows.values():
            rows += [(*r[:5], None, part, r[7]) for r in _rows(pieces, 0, True)]  # offset: the partition, for the merge
        if rows:
            yield batch(rows)

    return run


def merge(pieces: list[Piece], length: int = LENGTH) -> Iterator[list[Piece]]:
    """All pieces into sequences without padding: best fit from the longest, gaps filled from the emptiest, a rest in powers of two."""
    pieces = sorted(pieces, key=lambda p: (-len(p), p.doc_id is None, p.doc_id, p.start))
    packer, full = Packer(length, len(pieces) + 1), []
    for p in pieces:
        full += packer.add(p)
    yield from full
    left = sorted(packer.windows.values(), key=lambda w: -sum(map(len, w)))
    while left:
        window = left.pop(0)
        room = length - sum(map(len, window))
        while room and left:
            head, rest = left[-1].pop().cut(room) if len(left[-1][-1]) > room else (left[-1].pop(), None)
            window.append(head)
            room -= len(head)
            if rest is not None:
                left[-1].append(rest)
            if not left[-1]:
                left.pop()
        if not room:
            yield window
            continue
        rest, size = length - room, length
        while rest:
            size >>= 1
            if rest & size:
                own, need = [], size
                while need:
                    p = window.pop(0)
                    head, tail = p.cut(min(need, len(p)))
                    own.append(head)
                    need -= len(head)
                    if len(tail):
                        window.insert(0, tail)
                yield own
                rest -= size


def _merge_group(keep_ids: bool):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pieces = [Piece(None if pd.isna(d) else int(d), int(s), bytes(i), int(t)) for d, s, i, t in zip(pdf["doc_id"], pdf["start"], pdf["ids"], pdf["doc_tokens"], strict=True)]
        rows = []
        for k, window in enumerate(merge(pieces)):
            rows += _rows(window, (MERGED + int(key[0])) << 32 | k, keep_ids)
        out = pd.DataFrame(rows, columns=COLUMNS)
        return out.astype({"doc_id": "Int64"})

    return run


def pack(docs: DataFrame, tokenizer: str, kind: str = "byte", end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """A row for each piece; keep_ids adds its ids (little-endian 32-bit)."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw"))
    rows = materialise(own.mapInArrow(pack_partition(tokenizer, kind, end_id, keep_ids), PIECE), "pieces")
    done = rows.where("sequence_id IS NOT NULL")
    left = rows.where("sequence_id IS NULL").groupBy(F.floor(F.col("offset") / GROUP).alias("merge_group")).applyInPandas(_merge_group(keep_ids), PIECE)
    return done.unionByName(left) if keep_ids else done.unionByName(left).drop("ids")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
