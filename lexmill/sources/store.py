"""Tables written between steps, in the cluster's shared folder, and the package's sinks and simple sources."""

from __future__ import annotations

import atexit
import contextlib
import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes df under spark.checkpoint.dir and reads it back; the table goes when the driver ends. Only a local master,
    where one process is all, may do without that setting."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    path = f"{base.rstrip('/')}/lexmill-{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_training(df: DataFrame, path: str) -> None:
    """JSON lines with a text field, a folder for each split."""
    from lexmill.operators.curation import training_text

    df.select("split", training_text(F.col("user"), F.col("assistant")).alias("text")).write.partitionBy("split").json(path)


def write_detailed(df: DataFrame, path: str) -> None:
    df.write.partitionBy("split").json(path)


def write_documents(docs: DataFrame, path: str) -> None:
    """Detailed documents, and a simple copy of name and text."""
    docs.write.json(f"{path}/detailed")
    docs.select("filename", F.col("total_text").alias("text")).write.json(f"{path}/simple")


def write_corpus(texts: DataFrame, vectors: DataFrame, path: str, key: str = "id", config: dict | None = None) -> None:
    """A corpus as three tables (texts, metadata: every other column, vectors) that share a key, and its configuration."""
    spark = texts.sparkSession
    texts.select(key, "text").write.parquet(f"{path}/texts")
    texts.drop("text").write.parquet(f"{path}/metadata")
    vectors.write.parquet(f"{path}/vectors")
    spark.createDataFrame([(json.dumps(config or {}, sort_keys=True),)], "value string").coalesce(1).write.text(f"{path}/config")


def read_corpus(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """The corpus's texts, metadata and vectors, joined by their key: a row that one of them lacks is left out."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    return read("texts").join(read("metadata"), key).join(read("vectors"), key)


def read_corpus_config(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/config").first()["value"])


def new_memory(df: DataFrame, text: str = "text", kind: str = "type") -> DataFrame:
    """Rows as the memory keeps them: text, type, length, timestamp (now, ISO)."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.select(F.col(text).alias("text"), F.col(kind).alias("type"), F.length(text).alias("length"), now.alias("timestamp"))


def unknown(df: DataFrame, memory: DataFrame, text: str = "text") -> DataFrame:
    """df without blank texts and texts that the memory holds, one row of each text (the least by the other columns)."""
    fresh = df.where(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+", "") != "").withColumn("memory_md5", F.md5(text))
    fresh = fresh.join(memory.select(F.md5(text).alias("memory_md5")).distinct(), "memory_md5", "left_anti")
    one = fresh.groupBy("memory_md5").agg(F.min(F.struct(*(c for c in df.columns if c != text), F.col(text).alias("memory_text"))).alias("m"))
    return one.select(*(F.col("m.memory_text").alias(c) if c == text else F.col(f"m.{c}").alias(c) for c in df.columns))


def append_memory(df: DataFrame, path: str) -> int:
    """Adds rows whose text the memory doesn't hold yet; returns how many. What it adds is seen by the next reader."""
    spark = df.sparkSession
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    known = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)
    fresh = written(unknown(df, spark.read.parquet(path)) if known else unknown(df, df.limit(0)), "memory")
    fresh.write.mode("append").parquet(path)
    return fresh.count()


def read_memory(spark: SparkSession, path: str) -> DataFrame:
    """Memory rows, with defaults where metadata is missing."""
    return spark.read.parquet(path).withColumns({"timestamp": F.coalesce("timestamp", F.lit("unknown")), "type": F.coalesce("type", F.lit("legacy"))})


def read_training(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("text string, split string").json(path)


def latest_checkpoint(paths: DataFrame, path: str = "path", base: str | None = None, model_files: tuple = ("config.json", "model.safetensors", "pytorch_model.bin")) -> DataFrame:
    """The path whose checkpoint number is greatest, as a number; where there is none, base if it holds a model file."""
    n = F.regexp_extract(path, r"checkpoint-(\d+)/?$", 1)
    out = F.max_by(path, F.when(n != "", n.cast("long")))
    if base is not None:
        held = F.col(path).isin([f"{base.rstrip('/')}/{f}" for f in model_files])
        out = F.coalesce(out, F.when(F.max(held), F.lit(base)))
    return paths.agg(out.alias("latest"))


def dataset_summary(pairs: DataFrame) -> DataFrame:
    """One row: total_pairs, splits, quality_stats, source_distribution and domain_distribution (maps), and all as JSON."""
    from lexmill.operators.curation import frequencies, split_stats

    stats = split_stats(pairs).withColumn("quality", F.struct(F.col("mean_quality").alias("mean"), F.col("std_quality").alias("std"), F.col("min_quality").alias("min"), F.col("max_quality").alias("max")))
    pairs_of = lambda k, v: F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v))))
    own = stats.agg(F.coalesce(F.max(F.when(F.col("split") == "all", F.col("n"))), F.lit(0)).alias("total_pairs"), F.map_filter(pairs_of("split", "n"), lambda k, _: k != "all").alias("splits"), F.map_filter(pairs_of("split", "quality"), lambda k, _: k != "all").alias("quality_stats"))
    # one entry for each source and domain, which a summary lists
    named = frequencies(pairs)
    named = named.agg(*(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("name", "n"))))).alias(f"{k}_distribution") for k in ("source", "domain")))
    out = own.join(named)
    return out.withColumn("json", F.to_json(F.struct(*out.columns)))
