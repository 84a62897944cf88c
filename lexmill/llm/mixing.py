"""Mixing sources to target weights: a time-varying curriculum.

Each source has a weight schedule, linear between knots over training time 0..1. Its integral is the source's
weight; targets share all words by weight, but stop at MAX_EPOCHS times the source's words, the excess going
to the others. Inside a source, documents stand in a keyed hash order; a copy of a document starts at its
cumulative token demand, and the inverse of the integrated schedule gives that demand its training position.
Documents are range-sorted by position.

Cumulative sums are taken in two steps: sums of (source, bucket), 4096 buckets of the hash order, then a
running sum inside a bucket. So one source may hold most rows, and no task sees a whole source.

Defined results: a null text has size 0 and takes nothing; the null source is a source, the last; rows that
tie in hash order, id and size are interchangeable; an empty table gives an empty mix; new columns stand under a prefix, in
which a clashing name of the input would be replaced. The last copy that a
source's target reaches is taken in part: at most one document a source.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm.common import materialise, n_words, table

#: Weights at the knots 0, 1/2 and 1 of training time; sources take these schedules in turn. Integrals: 5, 2, 1.
SCHEDULES = ((7.5, 5.0, 2.5), (2.0, 2.0, 2.0), (0.5, 1.0, 1.5))
MAX_EPOCHS = 3
SEED = "mix-1"
SCALE = 1_000_000_000


def integrate(knots) -> list[float]:
    """Cumulative integral at each knot."""
    h, out = 1.0 / (len(knots) - 1), [0.0]
    for a, b in zip(knots, knots[1:], strict=False):
        out.append(out[-1] + h * (a + b) / 2.0)
    return out


def weight(knots) -> float:
    return integrate(knots)[-1]


def invert_sql(knots, u: str) -> str:
    """SQL for the time at which the share u (0 to 1) of the schedule's integral is reached."""
    h, sums = 1.0 / (len(knots) - 1), integrate(knots)
    arms = []
    for j, (a, b) in enumerate(zip(knots, knots[1:], strict=False)):
        rest = f"({u} * {sums[-1]!r}D - {sums[j]!r}D)"
        arms.append((sums[j + 1] / sums[-1], f"({j * h!r}D + 2D * {rest} / ({a!r}D + sqrt({a * a!r}D + {2 * (b - a) / h!r}D * {rest})))"))
    return "CASE " + " ".join(f"WHEN {u} <= {top!r}D THEN {x}" for top, x in arms[:-1]) + f" ELSE {arms[-1][1]} END" if len(arms) > 1 else arms[0][1]


def _cycle(rank: str, values) -> str:
    return f"CASE ({rank} - 1) % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def targets(totals: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """totals: skey, source, source_size. Adds rank and target; the table has a row for each source.

    min(level * weight, cap) with one level for all is where sharing the excess again and again ends. The
    level follows from running sums over sources ordered by cap / weight.
    """
    out = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    out = out.withColumn("w", F.expr(_cycle("rank", [f"{weight(k)!r}D" for k in schedules])))
    out = out.withColumn("cap", (MAX_EPOCHS * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    out = out.withColumns({"all_words": F.sum("source_size").over(whole).cast("double"), "caps": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "spent": F.coalesce(F.sum("w").over(before), F.lit(0.0)), "weights": F.sum("w").over(whole)})
    # with all before it at their caps, what a unit of weight gets; the first source that stays under its cap sets the level
    out = out.withColumn("level", (F.col("all_words") - F.col("caps")) / (F.col("weights") - F.col("spent")))
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col("rank"), F.col("level").alias("level")))).over(whole)["level"]
    out = out.withColumn("share", level)
    return out.select("skey", "source_size", "rank", F.coalesce(F.least(F.col("share") * F.col("w"), F.col("cap")), F.col("cap")).alias("target"))


def plan(df: DataFrame, size: str = "size", doc_id: str = "doc_id", source: str = "source", schedules=SCHEDULES, prefix: str = "mix_") -> DataFrame:
    """df with source_size, target, taken (long), copies (int: copies of which at least half is taken) and
    positions (array<long>, in SCALEths of training time, one for each copy), under prefix."""
    p = lambda name: f"{prefix}{name}"
    own = df.withColumns({p("skey"): F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")), p("h"): F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))})
    own = own.withColumn(p("bucket"), F.conv(F.substring(p("h"), 1, 3), 16, 10).cast("int"))
    sums = own.groupBy(F.col(p("skey")).alias("skey"), F.col(source).alias("source"), F.col(p("bucket")).alias("bucket")).agg(F.sum(size).alias("n"))
    sums = materialise(sums, "mix-sums")
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shares = targets(sums.groupBy("skey", "source").agg(F.sum("n").alias("source_size")), schedules)
    starts = sums.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).select("skey", "bucket", "start").join(shares, "skey")
    starts = starts.select(F.col("skey").alias(p("skey")), F.col("bucket").alias(p("bucket")), F.col("start").alias(p("start")), F.col("source_size").alias(p("source_size")), F.col("target").alias(p("target")), F.col("rank").alias(p("rank")))
    inside = Window.partitionBy(p("skey"), p("bucket")).orderBy(p("h"), doc_id, size).rowsBetween(Window.unboundedPreceding, -1)
    out = own.join(starts, [p("skey"), p("bucket")])
    out = out.withColumn(p("from"), F.col(p("start")) + F.coalesce(F.sum(size).over(inside), F.lit(0)))
    out = out.withColumn(p("goal"), F.round(p("target")).cast("long"))
    part = lambda k: F.greatest(F.lit(0).cast("long"), F.least(F.col(size), F.col(p("goal")) - k * F.col(p("source_size")) - F.col(p("from"))))
    out = out.withColumn(p("parts"), F.array(*(part(k) for k in range(MAX_EPOCHS))))
    out = out.withColumn(p("taken"), F.aggregate(p("parts"), F.lit(0).cast("long"), lambda a, x: a + x))
    out = out.withColumn(p("copies"), F.size(F.filter(p("parts"), lambda x: (x > 0) & (2 * x >= F.col(size)))))
    share = lambda k: f"(({k} * {p('source_size')} + {p('from')} + least({size}, greatest(0, {p('goal')} - {k} * {p('source_size')} - {p('from')})) / 2D) / {p('goal')})"
    spot = lambda k: F.when(F.get(p("parts"), F.lit(k)) > 0, F.expr(f"CAST(floor({SCALE} * ({_cycle(p('rank'), [invert_sql(s, share(k)) for s in schedules])})) AS BIGINT)"))
    out = out.withColumn(p("positions"), F.array_compact(F.array(*(spot(k) for k in range(MAX_EPOCHS)))))
    return out.drop(*(p(x) for x in ("skey", "h", "bucket", "start", "rank", "from", "goal", "parts")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, each as many times as the mix takes it: a copy taken in part counts from half of
    it on, and documents without words, of which the mix takes nothing, don't come."""
    sized = docs.withColumn("mix_size", n_words(F.col("text")))
    out = plan(sized, size="mix_size").where("mix_copies > 0")
    out = out.select(*docs.columns, F.explode(F.slice("mix_positions", F.lit(1), F.col("mix_copies"))).alias("mix_position"))
    return out.repartitionByRange("mix_position").sortWithinPartitions("mix_position").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = materialise(table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    out = plan(sized)
    return out.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"), F.get("mix_positions", F.lit(0)).alias("position")).orderBy("position", "doc_id")


def oracle() -> str:
    """Shares the excess again and again, as the contract words it; a round for each of the first sources suffices."""
    ws = _cycle("rank", [f"{weight(k)!r}" for k in SCHEDULES])
    sql = rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s AS (SELECT *, ({ws})::DOUBLE AS w, (3 * source_size)::DOUBLE AS cap FROM (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM s0)),
r AS (SELECT rank, w, cap, false AS full_, 0 AS round, (SELECT sum(source_size)::DOUBLE FROM s) * w / (SELECT sum(w) FROM s) AS t FROM s
  UNION ALL
  SELECT rank, w, cap, t >= cap, round + 1,
    CASE WHEN t >= cap THEN cap ELSE (sum(cap + 0) FILTER (t >= cap) OVER () * -1 + (SELECT sum(source_size)::DOUBLE FROM s)) * w / sum(w) FILTER (t < cap) OVER () END
  FROM r WHERE round < 60),
f AS (SELECT s.source, s.source_size, s.rank, coalesce(r.t, r2.t) AS target FROM s JOIN r r2 ON r2.rank = s.rank AND r2.round = 0
  LEFT JOIN r ON r.rank = s.rank AND r.round = 60),
c AS (SELECT d.doc_id, d.size, f.source_size, f.target, f.rank, round(f.target)::BIGINT AS goal,
  (coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null')), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS begins
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
k AS (SELECT *, greatest(0, least(size, goal - begins)) AS p0, greatest(0, least(size, goal - source_size - begins)) AS p1, greatest(0, least(size, goal - 2 * source_size - begins)) AS p2 FROM c)
SELECT doc_id, size, source_size, target, (p0 + p1 + p2)::BIGINT AS taken,
  CASE WHEN p0 > 0 THEN floor({SCALE} * (SPOT))::BIGINT END AS position FROM k"""
    return _plain(sql)


def _plain(sql: str) -> str:
    """The SQL with the schedules put in, in DuckDB's spelling of doubles."""
    spot = _cycle("rank", [invert_sql(k, "((begins + p0 / 2D) / goal)") for k in SCHEDULES])
    sql = sql.replace("SPOT", spot).replace("sum(cap + 0) FILTER (t >= cap) OVER ()", "coalesce(sum(cap) FILTER (t >= cap) OVER (), 0)")
    return re.sub(r"(?<![\w.])(\d+(?:\.\d+)?)D\b", r"\1::DOUBLE", sql)
