"""Quality rules: a threshold table compiled into one projection of built-in functions.

Defined results: a null or blank text has no words and fails; equal rows get equal verdicts; an empty table gives an empty
one; very long texts are measured whole; columns of the input are kept, and the metric columns are added under a prefix, in
which a clashing name of the input would be replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import ASCII_SPACE, SPACE_RUN, table, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at are from "
    "le la les de des et un une que qui en dans pour par pas sur au du plus avec est "
    "der die das und zu den mit von ist sich auf für nicht ein eine als auch "
    "el los las del con para una su al lo y como más"
).split()

#: metric, least, most: a document that leaves a range is rejected. None: no bound on that side.
RULES = (
    ("mean_word_chars", 2.0, 12.0),
    ("symbols_per_word", None, 0.1),
    ("bangs_per_word", None, 0.2),
    ("stop_word_ratio", 0.03, None),
    ("dup_line_ratio", None, 0.5),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.3),
)


def _count_chars(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _covered(starts: Column) -> Column:
    """Words covered by windows that start at the given ascending positions."""
    step = F.transform(starts, lambda s, i: F.least(F.lit(WINDOW), s - F.coalesce(F.get(starts, i - 1), F.lit(-WINDOW))))
    return F.aggregate(step, F.lit(0), lambda a, x: a + x)


def measure(df: DataFrame, text: str = "text", prefix: str = "q_") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the rule metrics, under prefix.

    Each step is a projection of its own, and a column that a lambda reads is read twice by its step:
    so Catalyst keeps the steps apart, and nothing is computed again for each array element.
    """
    p = lambda name: f"{prefix}{name}"
    out = df.withColumn(p("text"), F.coalesce(F.col(text), F.lit("")))
    t = F.col(p("text"))
    out = out.withColumns({p("words"): words(t), p("lines"): F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(ASCII_SPACE)) != "")})
    w, lines = F.col(p("words")), F.col(p("lines"))
    out = out.withColumns({
        p("n_words"): F.size(w).cast("long"),
        p("word_chars"): F.length(F.regexp_replace(t, SPACE_RUN, "")).cast("long"),
        p("n_symbols"): _count_chars(t, SYMBOLS),
        p("n_lines"): F.size(lines).cast("long"),
        p("n_dup_lines"): (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        p("n_bangs"): _count_chars(t, "!"),
        p("n_stops"): F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long"),
        p("n_bullets"): F.size(F.filter(lines, lambda x: x.rlike(r"^\s*([-*•–]|\d+[.)])\s"))).cast("long"),
        p("n_ellipses"): F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("long"),
        p("hashes"): F.transform(w, lambda x: F.xxhash64(x)),
    })
    h = F.col(p("hashes"))
    out = out.withColumn(p("windows"), F.when(F.size(h) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))))
    win = F.col(p("windows"))
    # most texts repeat no window, and CASE evaluates the sort only for those that do
    out = out.withColumn(p("sorted"), F.when(F.size(F.array_distinct(win)) < F.size(win), F.array_sort(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col(p("sorted"))
    twin = lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"])
    out = out.withColumn(p("starts"), F.array_sort(F.transform(F.filter(s, lambda x, j: F.coalesce(twin(x, j), F.lit(False))), lambda x: x["i"])))
    out = out.withColumn(p("n_repeat_words"), F.coalesce(_covered(F.col(p("starts"))), F.lit(0)).cast("long"))
    n, n_lines = F.greatest(F.col(p("n_words")), F.lit(1)), F.greatest(F.col(p("n_lines")), F.lit(1))
    out = out.withColumns({
        p("mean_word_chars"): F.col(p("word_chars")) / n,
        p("symbols_per_word"): F.col(p("n_symbols")) / n,
        p("bangs_per_word"): F.col(p("n_bangs")) / n,
        p("stop_word_ratio"): F.col(p("n_stops")) / n,
        p("dup_line_ratio"): F.col(p("n_dup_lines")) / n_lines,
        p("bullet_line_ratio"): F.col(p("n_bullets")) / n_lines,
        p("ellipsis_line_ratio"): F.col(p("n_ellipses")) / n_lines,
    })
    return out.drop(*(p(x) for x in ("text", "words", "lines", "hashes", "windows", "sorted", "starts")))


def compile_rules(rules=RULES, prefix: str = "q_") -> Column:
    """array<string> of the rules that a measured row breaks."""
    broken = []
    for name, least, most in rules:
        x, bad = F.col(f"{prefix}{name}"), F.lit(False)
        if least is not None:
            bad = bad | (x < least)
        if most is not None:
            bad = bad | (x > most)
        broken.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*broken))


def judge(df: DataFrame, rules=RULES, text: str = "text", prefix: str = "q_") -> DataFrame:
    """measure(df) with base_failed, broken (array<string>) and kept, under prefix."""
    out = measure(df, text, prefix)
    n, rep = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    base = (n < MIN_WORDS) | (100 * rep > MAX_REPEAT_PERCENT * n)
    broken = compile_rules(rules, prefix)
    return out.withColumns({f"{prefix}base_failed": base, f"{prefix}broken": broken, f"{prefix}kept": ~base & (F.size(broken) == 0)})


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass, with the columns they came with.

    A generator that gives a row or none does what a filter would; but Catalyst would push a filter below the
    projections that judge() keeps apart, and compute their expressions again inside each other.
    """
    one = F.when(F.col("q_kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return judge(docs).select(*docs.columns, F.explode(one).alias("q_one")).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return out.select("doc_id", *(F.col(f"q_{x}").alias(x) for x in names))


def oracle() -> str:
    stops = ", ".join(f"'{x}'" for x in STOP_WORDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT r, i, list_aggregate(ws[i:i + 7], 'string_agg', ' ') AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT r, unnest(range(i, i + 8)) AS spot FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT spot) AS n_repeat_words FROM dup GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  len(ls) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_bangs,
  len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS n_stops,
  len(list_filter(ls, lambda x: regexp_matches(x, '^\s*([-*•–]|\d+[.)])\s'))) AS n_bullets,
  len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipses
  FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 12.0 AND n_symbols / n_words <= 0.1 AND n_bangs / n_words <= 0.2
  AND n_stops / n_words >= 0.03 AND n_dup_lines / n_lines <= 0.5 AND n_bullets / n_lines <= 0.9 AND n_ellipses / n_lines <= 0.3 AS kept
FROM b"""
