"""Session, cache, latency and training-metric aggregates over event tables."""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType


def session_stats(events: DataFrame, by: str = "user_id", method: str = "event_type", fallback: str = "error") -> DataFrame:
    n, bad = F.count("*"), F.count_if(F.col(method) == fallback)
    return events.groupBy(by).agg(n.alias("total"), bad.alias("fallbacks"), (100.0 * (n - bad) / n).alias("success_pct"))


def method_counts(events: DataFrame, method: str = "event_type") -> DataFrame:
    return events.groupBy(F.col(method).alias("method")).agg(F.count("*").alias("n"))


def metric_series(events: DataFrame, metrics: list[str], step: str, metric: str, value: str, seq: str) -> DataFrame:
    """A row for each step, a column for each metric: the last value written at that step, else null."""
    return events.groupBy(F.col(step).alias("step")).pivot(metric, metrics).agg(F.max_by(value, seq))


def loss_summary(series: DataFrame, name: str) -> DataFrame:
    x = F.col(name)
    return series.agg(F.min(x).alias("least"), F.max_by(x, F.when(x.isNotNull(), F.col("step"))).alias("final"))


def recent_mean(events: DataFrame, by: str, value: str, order: list[str], n: int = 20) -> DataFrame:
    """Each row's mean over the last n of its group; the group's latest row has the current mean."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(1 - n, 0)
    return events.withColumn("recent_mean", F.avg(value).over(w))


def latest(events: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """The last n rows of each group."""
    w = Window.partitionBy(by).orderBy(*(F.col(c).desc() for c in order))
    return events.withColumn("age", F.row_number().over(w)).where(F.col("age") <= n)


def lru_hits(accesses: DataFrame, session: str, key: str, order: str, capacity: int) -> DataFrame:
    """accesses with hit: the key is among the capacity keys that the session used last. One ordered pass; the state is
    those keys, so a session of any length takes bounded memory."""
    rows = accesses.repartition(session).sortWithinPartitions(session, order)
    schema = StructType([*rows.schema.fields, StructField("hit", BooleanType())])

    def run(batches):
        at, held = None, OrderedDict()
        for pdf in batches:
            hits = []
            for s, k in zip(pdf[session].tolist(), pdf[key].tolist(), strict=True):
                if s != at:
                    at, held = s, OrderedDict()
                hits.append(k in held)
                held[k] = None
                held.move_to_end(k)
                if len(held) > capacity:
                    held.popitem(last=False)
            yield pdf.assign(hit=hits)

    return rows.mapInPandas(run, schema)


def throughput(events: DataFrame, by: str, ts: str) -> DataFrame:
    """Items a second of each group, from its first to its last; null where that is no time."""
    spent = F.max(ts).cast("timestamp").cast("double") - F.min(ts).cast("timestamp").cast("double")
    return events.groupBy(by).agg(F.count("*").alias("items"), spent.alias("seconds")).withColumn("per_second", F.when(F.col("seconds") > 0, F.col("items") / F.col("seconds")))


def parameter_counts(tensors: DataFrame, shape: str = "shape", trainable: str = "trainable") -> DataFrame:
    """One row: trainable and all parameters of a model's tensors (shape: array<long>), and the share in percent."""
    size = F.aggregate(shape, F.lit(1).cast("long"), lambda a, x: a * x)
    out = tensors.agg(F.coalesce(F.sum(F.when(F.col(trainable), size)), F.lit(0)).alias("trainable"), F.coalesce(F.sum(size), F.lit(0)).alias("total"))
    return out.withColumn("percent", F.when(F.col("total") > 0, 100.0 * F.col("trainable") / F.col("total")))


def collate(tokens: DataFrame, key: str, ids: str, batch: int, longest: int = 512, pad: int = 0) -> DataFrame:
    """Rows in batches by key; ids cut, and padded to the batch's longest: input_ids, attention_mask, labels."""
    cut = tokens.select(key, F.slice(ids, F.lit(1), F.lit(longest)).alias("own"), F.floor(F.col(key) / batch).alias("batch_id"))
    w = Window.partitionBy("batch_id")
    cut = cut.withColumn("width", F.max(F.size("own")).over(w))
    gap = F.col("width") - F.size("own")
    padded = F.concat("own", F.array_repeat(F.lit(pad), gap))
    mask = F.concat(F.transform("own", lambda _: F.lit(1)), F.array_repeat(F.lit(0), gap))
    return cut.select(key, "batch_id", padded.alias("input_ids"), mask.alias("attention_mask"), padded.alias("labels"))
