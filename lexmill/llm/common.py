"""Shared helpers: table access, scratch tables in the shared folder, and the word rule."""

from __future__ import annotations

import atexit
import contextlib
import gc
import itertools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than these six ASCII white-space characters.
ASCII_SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Only a local master, where one process is all, may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = f"{tempfile.gettempdir()}/checkpoints"
    return named.rstrip("/")


#: The paths that open scopes will remove, innermost last.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed with the scope it is made in, or when the driver ends."""
    path = f"{shared_dir(spark)}/lexmill-{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    atexit.register(_remove, spark, path)
    return path


@contextlib.contextmanager
def discarding(spark: SparkSession):
    """Tables written inside are removed at the end, but for those that materialise(..., keep=True) wrote."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: With this setting a write's shuffle files go when it ends, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The driver keeps the text of each write's plan; long literals (line_dedup.rarity) make it megabytes.
_PLAN_TEXT = "spark.sql.maxPlanStringLength"
#: After so many writes the driver's garbage is collected: plans and broadcasts of many short queries would else fill its heap.
TIDY = 10
_writes = itertools.count(1)


@contextlib.contextmanager
def _settings(spark: SparkSession, **values: str):
    """Settings for the statements inside; they are as before at the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: computed once, lineage cut, survives lost executors. With keep, the
    table outlives the scope that it is made in."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if keep and _scopes:
        _scopes[-1].remove(path)
        if len(_scopes) > 1:
            _scopes[-2].append(path)
    with _settings(spark, **{_CLEANUP: "true", _PLAN_TEXT: "20000"}):
        df.write.option("compression", "zstd").parquet(path)
    if next(_writes) % TIDY == 0:
        gc.collect()  # what Python has dropped holds plans in the JVM
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def free(df: DataFrame, name: str) -> str:
    """The name, with as many "_" behind it as make it new to df (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """array<string> of the words of a text; null and blank texts have none."""
    even = F.coalesce(text, F.lit(""))
    for c in ASCII_SPACE[1:]:
        even = F.replace(even, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(even, " "), "")  # a pattern of one plain character is split without a regex


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def single(docs: DataFrame, keys: list[str], among: Column | None = None) -> DataFrame:
    """docs with one row of those (among some, if named) that agree in keys (nulls equal each other): the least by a
    hash of all its columns. Only rows that have a double are shuffled."""
    own = [f"single_{k}" for k in keys]
    repeated = (docs if among is None else docs.where(among)).groupBy(*keys).agg(F.count("*").alias("single_n")).where("single_n > 1")
    repeated = materialise(repeated.select(*(F.col(k).alias(o) for k, o in zip(keys, own, strict=True))), "single")
    if repeated.isEmpty():
        return docs
    met = F.lit(True)
    for k, o in zip(keys, own, strict=True):
        met = met & F.col(k).eqNullSafe(F.col(o))
    doubled = docs.join(repeated, met, "left_semi")
    one = doubled.groupBy(*keys).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("single_row"))
    return docs.join(repeated, met, "left_anti").unionByName(one.select("single_row.*"))
