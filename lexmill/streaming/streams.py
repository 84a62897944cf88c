"""The operators as streams: validated entries without repeats, ingest into a store, turn pairs, sessions and windows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupStateTimeout

from lexmill.functions import text as T


def fresh(entries: DataFrame, text: str = "text") -> DataFrame:
    """Valid entries whose text hasn't come before. The state is the hashes; with a watermark set, use fresh_within."""
    return entries.where(T.ingest_valid(F.col(text))).withColumn("md5", F.md5(text)).dropDuplicates(["md5"])


def fresh_within(entries: DataFrame, ts: str, delay: str, text: str = "text") -> DataFrame:
    """As fresh, with hashes forgotten once the watermark has passed them."""
    return entries.where(T.ingest_valid(F.col(text))).withColumn("md5", F.md5(text)).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["md5"])


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def store_batch(batch: DataFrame, number: int, store: str, text: str = "text") -> None:
    """One micro-batch into the store: valid entries whose text no other batch has stored. A batch that is run again
    replaces what it wrote, so replays change nothing."""
    spark = batch.sparkSession
    own = batch.where(T.ingest_valid(F.col(text))).withColumn("md5", F.md5(text)).dropDuplicates(["md5"])
    if _exists(spark, store):
        known = spark.read.parquet(store).where(F.col("batch") != number).select("md5")
        own = own.join(known, "md5", "left_anti")
    own.write.mode("overwrite").parquet(f"{store}/batch={number}")


def ingest(entries: DataFrame, store: str, checkpoint: str, every: str | None = None, text: str = "text"):
    """A running query that takes a stream of entries into the store, in micro-batches (the source sets their size). It
    resumes from its checkpoint; without every it stops when the input is used up, else it flushes at that interval."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = entries.writeStream.foreachBatch(lambda batch, number: store_batch(batch, number, store, text))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


class Progress(StreamingQueryListener):
    """Keeps what running queries report: hooks at the start, at each batch and at the end."""

    def __init__(self):
        super().__init__()
        self.seen: list[tuple[str, int]] = []

    def onQueryStarted(self, event) -> None:
        self.seen.append(("started", 0))

    def onQueryProgress(self, event) -> None:
        self.seen.append(("progress", event.progress.numInputRows))

    def onQueryIdle(self, event) -> None:
        self.seen.append(("idle", 0))

    def onQueryTerminated(self, event) -> None:
        self.seen.append(("ended", 0))


def _ordered(batches, columns: list[str]) -> list[tuple]:
    """A trigger's rows of one group in turn order: they come in several Arrow chunks, which are not ordered among each other."""
    parts = [pdf[columns] for pdf in batches]
    return list(pd.concat(parts).sort_values(columns[0], kind="stable").itertuples(index=False)) if parts else []


def pairs(turns: DataFrame) -> DataFrame:
    """User and assistant turns of conversations, paired as they come; the state is the last user's turn."""

    def step(key: tuple, batches, state):
        held = state.get[0] if state.exists else None
        out = []
        for turn, role, text in _ordered(batches, ["turn", "role", "text"]):
            if not (text or "").strip():
                continue
            if role in ("assistant", "ai") and held is not None:
                out.append((key[0], turn, held, text))
            held = text if role in ("user", "human") else None
        state.update((held,))
        yield pd.DataFrame(out, columns=["conv_id", "turn", "user", "assistant"])

    return turns.groupBy("conv_id").applyInPandasWithState(step, "conv_id long, turn long, user string, assistant string", "held string", "append", GroupStateTimeout.NoTimeout)


def recent(turns: DataFrame, n: int = 10) -> DataFrame:
    """conv_id, turn, history: each turn with the n turns of its conversation before it; the state is those n."""

    def step(key: tuple, batches, state):
        held = list(state.get[0]) if state.exists else []
        out = []
        for turn, role, text in _ordered(batches, ["turn", "role", "text"]):
            out.append((key[0], turn, list(held)))
            held = [*held, f"{role}: {text}"][-n:]
        state.update((held,))
        yield pd.DataFrame(out, columns=["conv_id", "turn", "history"])

    return turns.groupBy("conv_id").applyInPandasWithState(step, "conv_id long, turn long, history array<string>", "held array<string>", "append", GroupStateTimeout.NoTimeout)


def windows(events: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    out = events.withWatermark("ts", delay).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Events of a user with no longer gap between them, as one session."""
    out = events.withWatermark("ts", delay).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def answered(asked: DataFrame, replies: DataFrame, within: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Requests (id, ts) with the replies (request_id, reply_ts) that come within a time: a join of two streams, whose state
    is bounded by both watermarks."""
    a, b = asked.withWatermark("ts", delay), replies.withWatermark("reply_ts", delay)
    return a.join(b, F.expr(f"id = request_id AND reply_ts >= ts AND reply_ts <= ts + INTERVAL {within}"))
