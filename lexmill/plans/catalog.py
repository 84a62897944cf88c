"""The registered queries over the driver's tables, each with its SQL for DuckDB where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions import vector as V
from lexmill.operators import curation as C
from lexmill.operators import responses as R
from lexmill.operators import telemetry as M
from lexmill.operators import vectors as S
from lexmill.operators.domain_table import GENERAL, KEYWORDS, TEMPLATES
from lexmill.sources import chat, files, store

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# pieces of SQL that several oracles share
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_WS = r"list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> '')"


def _strip(x: str) -> str:
    return _STRIP.format(x)


def _words(x: str) -> str:
    return _WS.format(x)


def _cosine(a: str, b: str) -> str:
    """SQL for the cosine of two texts' word sets."""
    x, y = (f"list_distinct({_words(f'lower({z})')})" for z in (a, b))
    return f"CASE WHEN len({x}) * len({y}) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({x}, {y})) / sqrt((len({x}) * len({y}))::DOUBLE) END"


def _quoted(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_CUT = f"substr({_strip('text')}, 1, 2000)"


@query("f1_ingest_valid", rf"""SELECT doc_id, length({_strip('text')}) >= 30 AND len({_words(_CUT)}) >= 10
  AND length(regexp_replace({_CUT}, '[^\p{{L}}]', '', 'g')) / length({_CUT}) >= 0.6 AS valid FROM documents""")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", T.ingest_valid(F.col("text")).alias("valid"))


@query("f2_curate_reason", rf"""WITH s AS (SELECT conv_id, turn, {_strip('text')} AS x FROM conversations)
SELECT conv_id, turn, CASE WHEN x = '' THEN 'blank' WHEN length(x) < 10 THEN 'short' WHEN length(x) > 2000 THEN 'long'
  WHEN len({_words('x')}) < 3 THEN 'few_words' WHEN (length(x) - length(regexp_replace(x, '[^\p{{L}}]', '', 'g'))) / length(x) > 0.7 THEN 'punctuation'
  WHEN regexp_matches(x, '^[\s\-_=]{{10,}}$') OR regexp_matches(x, '^\d+\s*$') OR regexp_matches(x, '^[^\w\s]{{5,}}$') THEN 'shape' ELSE 'valid' END AS reason FROM s""")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", T.curate_reason(F.col("text")).alias("reason"))


@query("p4_chunks", rf"""WITH w AS (SELECT doc_id, text, {_words('text')} AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(CASE WHEN len(ws) <= 400 THEN [0] ELSE range(0, len(ws), 350) END) AS a, text FROM w),
c AS (SELECT doc_id, a, CASE WHEN len(ws) <= 400 THEN text ELSE array_to_string(ws[a + 1:a + 400], ' ') END AS chunk FROM s),
k AS (SELECT * FROM c WHERE length({_strip('chunk')}) >= 30)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY a) - 1)::INT AS chunk_id, (count(*) OVER (PARTITION BY doc_id))::INT AS total_chunks, chunk FROM k""")
def _(spark, d):
    return C.chunks(t(spark, d, "documents"))


@query("u4_md5_first", "SELECT min(doc_id) AS doc_id, md5(text) AS md5, count(*) AS copies FROM documents GROUP BY md5(text)")
def _(spark, d):
    return C.first_by_hash(t(spark, d, "documents"), "text", "doc_id")


@query("j5_seen_anti_join", "SELECT doc_id, md5(text) AS md5 FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM benchmark) AND text IS NOT NULL")
def _(spark, d):
    own = t(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.md5("text").alias("md5"))
    return own.join(t(spark, d, "benchmark").select(F.md5("text").alias("md5")).distinct(), "md5", "left_anti").select("doc_id", "md5")


_CLEAN = "text"
for _p, _by in T.CLEANING:
    # RE2 has no look-around and spells code points and groups its own way
    _q = _p.replace(r"\x{200B}-\x{200D}\x{FEFF}", "​-‍﻿").replace("'", "''")
    _b = _by.replace("$1", r"\1")
    if "(?<=" in _p:
        _q, _b = r'([\p{L}\p{N}_])"([\p{L}\p{N}_]+)"([\p{L}\p{N}_])', r"\1\2\3"
    elif "(?=" in _p:
        _q, _b = r'"([A-Z][^"]*?)"(\s|$)', r"\1\2"
    _CLEAN = f"regexp_replace({_CLEAN}, '{_q}', '{_b}', 'g')"


@query("p6_clean_text", f"SELECT doc_id, {_strip(_CLEAN)} AS cleaned FROM documents")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", T.clean(F.col("text")).alias("cleaned"))


_NAME = "CASE WHEN lower(role) IN ('human', 'user') THEN 'user' WHEN lower(role) IN ('assistant', 'ai', 'claude') THEN 'assistant' ELSE lower(role) END"


def _exports(spark, d) -> DataFrame:
    """The conversations as export files, in five root shapes in turn, with four forms of content."""
    turn, role, text = (F.col(c) for c in ("turn", "role", "text"))
    form = F.pmod(turn, F.lit(4))
    said = F.when(form == 0, F.to_json(F.struct(F.struct(F.array(text).alias("parts")).alias("content"), role.alias("role")))).when(form == 1, F.to_json(F.struct(text.alias("text"), F.struct(role.alias("role")).alias("author")))).when(form == 2, F.to_json(F.struct(F.array(F.struct(text.alias("text"))).alias("message"), role.alias("sender")))).otherwise(F.to_json(F.struct(text.alias("content"), role.alias("role"))))
    own = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(turn, said.alias("m")))).alias("all"))
    listed = F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["m"]), ","), F.lit("]"))
    mapped = F.concat(F.lit("{"), F.array_join(F.transform("all", lambda x, i: F.format_string('"%s":{"message":%s}', F.lpad(i.cast("string"), 4, "0"), x["m"])), ","), F.lit("}"))
    shape = F.pmod("conv_id", F.lit(5))
    value = F.when(shape == 0, F.format_string('[{"messages":%s}]', listed)).when(shape == 1, F.format_string('{"conversations":[{"messages":%s}]}', listed)).when(shape == 2, F.format_string('{"mapping":%s}', mapped)).when(shape == 3, F.format_string('{"messages":%s}', listed)).otherwise(F.format_string('{"first":{"messages":%s}}', listed))
    return own.select("conv_id", value.alias("value"))


@query("s5_chat_scan", rf"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations)
SELECT conv_id, CASE WHEN conv_id % 5 = 2 THEN lpad(k::VARCHAR, 4, '0') ELSE k::VARCHAR END AS message_id, {_NAME} AS author, trim(text) AS text FROM n WHERE trim(text) <> ''""")
def _(spark, d):
    return chat.messages(chat.conversations(_exports(spark, d))).select("conv_id", "message_id", "author", "text")


@query("s16_estimates", "SELECT conv_id, (CASE WHEN conv_id % 5 IN (2, 3) THEN count(*) ELSE 1 END)::INT AS items FROM conversations GROUP BY conv_id")
def _(spark, d):
    return chat.estimate(_exports(spark, d)).select("conv_id", "items")


@query("s8_document_scan", "SELECT doc_id, 'document_0.pdf' AS filename, trim(text) AS text FROM documents WHERE trim(text) <> ''")
def _(spark, d):
    files = t(spark, d, "documents").select("doc_id", F.to_json(F.array(F.struct(F.col("text").alias("content")))).alias("value"))
    return chat.documents(files).select("doc_id", "filename", "text")


@query("s4_document_assembly", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents)
SELECT doc_id, coalesce(string_agg(trim(x), chr(10) || chr(10) ORDER BY page) FILTER (trim(x) <> ''), '') AS total_text, CASE WHEN count(*) FILTER (trim(x) <> '') = 0 THEN 'failed' ELSE 'ok' END AS status FROM l GROUP BY doc_id""")
def _(spark, d):
    pages = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "text")).withColumn("page", F.col("at") + 1)
    return chat.assemble(pages, "doc_id", "page", "text").select("doc_id", "total_text", "status")


@query("s15_source_profile", """SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'list' ELSE 'dict' END AS root, 1 AS length,
  CASE conv_id % 5 WHEN 0 THEN 'messages' WHEN 1 THEN 'conversations' WHEN 2 THEN 'mapping' WHEN 3 THEN 'messages' ELSE 'first' END AS shape FROM conversations GROUP BY conv_id""")
def _(spark, d):
    return chat.profile(_exports(spark, d)).select("conv_id", "root", "length", "shape")


def _domain_sql(name: str = "''") -> str:
    """Counts of a keyword are what its removal takes from the text, over its length; those of the file name count twice."""
    part = lambda x, k: f"((length({x}) - length(replace({x}, '{k}', ''))) // {len(k)})"
    scores = ", ".join("(" + " + ".join(f"{part('x', k)} + 2 * {part('f', k)}" for k in keys) + f") AS d{i}" for i, keys in enumerate(KEYWORDS.values()))
    best = "greatest(" + ", ".join(f"d{i}" for i in range(len(KEYWORDS))) + ")"
    arms = " ".join(f"WHEN d{i} = {best} THEN '{n}'" for i, n in enumerate(KEYWORDS))
    return f"WITH s AS (SELECT doc_id, {scores} FROM (SELECT doc_id, lower(coalesce(text, '')) AS x, lower({name}) AS f FROM documents)) SELECT doc_id, CASE WHEN {best} = 0 THEN 'general' {arms} END AS domain, ({best})::INT AS domain_score FROM s"


#: File names for the documents, by number: every third speaks of a domain, every fourth is unknown.
_FILE = "CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 'court_case_' || (doc_id % 10) || '.pdf' ELSE 'notes_' || (doc_id % 10) || '.pdf' END"


def _filed(spark, d) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", "text", F.expr(_FILE).alias("filename"))


@query("a5_domain", _domain_sql(f"coalesce({_FILE}, '')"))
def _(spark, d):
    return C.domain_scores(_filed(spark, d), filename=F.col("filename")).select("doc_id", "domain", "domain_score")


@query("a3_domain_frequency", f"SELECT domain, count(*) AS n FROM ({_domain_sql()}) GROUP BY domain")
def _(spark, d):
    return C.domain_scores(t(spark, d, "documents").select("doc_id", "text")).groupBy("domain").agg(F.count("*").alias("n"))


@query("a7_by_file", f"SELECT coalesce({_FILE}, 'unknown_pdf_source') AS source_file, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY 1")
def _(spark, d):
    return C.by_file(_filed(spark, d)).groupBy("source_file").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("a3_source_domain", f"WITH x AS (SELECT coalesce({_FILE}, 'conversation') AS s, domain FROM documents JOIN ({_domain_sql()}) USING (doc_id)) SELECT 'source' AS kind, s AS name, count(*) AS n FROM x GROUP BY s UNION ALL SELECT 'domain', domain, count(*) FROM x GROUP BY domain")
def _(spark, d):
    return C.frequencies(C.domain_scores(_filed(spark, d)).withColumn("source_file", F.col("filename")))


_PAIRS = f"""s AS (SELECT conv_id, turn, role, text, lag(text) OVER w AS u, lag(role) OVER w AS r FROM conversations WHERE {_strip('text')} <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (SELECT conv_id, turn, u AS user, text AS assistant FROM s WHERE role IN ('assistant', 'ai') AND r IN ('user', 'human'))"""


@query("w1_turn_pairs", f'WITH {_PAIRS.replace("u AS user", "u AS usr")} SELECT conv_id, turn, usr AS "user", assistant FROM pairs')
def _(spark, d):
    return C.pair_turns(t(spark, d, "conversations"))


_P2 = _PAIRS.replace("u AS user", "u AS usr")


@query("w2_rolling_context", f"""WITH {_P2} SELECT conv_id, turn, concat_ws(' ', 'Assistant: ' || lag(assistant, 2) OVER w, 'User: ' || lag(usr) OVER w, 'Assistant: ' || lag(assistant) OVER w) AS context FROM pairs WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def _(spark, d):
    return C.with_context(C.pair_turns(t(spark, d, "conversations"))).select("conv_id", "turn", "context")


_Q = rf"""{_P2},
m AS (SELECT *, CASE WHEN length(usr) > 0 THEN length(assistant) / length(usr) ELSE 0.0 END AS length_ratio, {_words('assistant')} AS ws, {_words('lower(assistant)')} AS lw, len(regexp_split_to_array(assistant, '[.!?]+')) AS segs, {_cosine('usr', 'assistant')} AS semantic_similarity FROM pairs),
q AS (SELECT conv_id, turn, usr, assistant, length_ratio, semantic_similarity, least(1.0::DOUBLE, 20.0::DOUBLE / greatest(len(ws) / greatest(segs, 1), 1.0::DOUBLE)) AS readability_score, len(list_distinct(lw)) / greatest(len(lw), 1) AS information_density FROM m),
z AS (SELECT *, (CASE WHEN length_ratio BETWEEN 0.1 AND 10.0 THEN 1.0::DOUBLE ELSE 0.5 END) * (CASE WHEN semantic_similarity BETWEEN 0.1 AND 0.95 THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END) * (0.7::DOUBLE + 0.3::DOUBLE * readability_score) * (0.8::DOUBLE + 0.2::DOUBLE * information_density) AS quality_score FROM q)"""


@query("p13_pair_quality", f"WITH {_Q} SELECT conv_id, turn, length_ratio, semantic_similarity, readability_score, information_density, quality_score FROM z")
def _(spark, d):
    return C.pair_quality(C.pair_turns(t(spark, d, "conversations"))).select("conv_id", "turn", "length_ratio", "semantic_similarity", "readability_score", "information_density", "quality_score")


def _good(spark, d):
    return C.pair_quality(C.pair_turns(t(spark, d, "conversations"))).where("quality_score >= 0.46")


_SPLITS = f"""{_Q}, g AS (SELECT *, row_number() OVER (ORDER BY quality_score DESC, conv_id, turn) AS rn, count(*) OVER () AS n FROM z WHERE quality_score >= 0.46),
h AS (SELECT *, CASE WHEN n >= 4 THEN least((rn - 1) // greatest(n // 4, 1), 3) ELSE 3 END AS quartile FROM g),
p AS (SELECT *, row_number() OVER (ORDER BY quartile, md5('42|' || conv_id || '|' || turn)) AS pos FROM h),
sp AS (SELECT conv_id, turn, quality_score, quartile::INT AS quartile, CASE WHEN pos <= floor(n * 0.8) THEN 'train' WHEN pos <= floor(n * 0.8) + floor(n * 0.1) THEN 'validation' ELSE 'test' END AS split FROM p)"""


@query("o9_splits", f"WITH {_SPLITS} SELECT conv_id, turn, quartile, split FROM sp")
def _(spark, d):
    return C.splits(_good(spark, d), ["conv_id", "turn"]).select("conv_id", "turn", "quartile", "split")


@query("a2_split_stats", f"WITH {_SPLITS} SELECT coalesce(split, 'all') AS split, count(*) AS n, round(avg(quality_score), 9) AS mean_quality, round(stddev_pop(quality_score), 7) AS std_quality, min(quality_score) AS min_quality, max(quality_score) AS max_quality FROM sp GROUP BY ROLLUP (split)")
def _(spark, d):
    out = C.split_stats(C.splits(_good(spark, d), ["conv_id", "turn"]))
    return out.withColumns({"mean_quality": F.round("mean_quality", 9), "std_quality": F.round("std_quality", 7)})


@query("k3_training_text", f"WITH {_P2} SELECT conv_id, turn, '<|user|>' || usr || '<|assistant|>' || assistant || '<|endoftext|>' AS text FROM pairs")
def _(spark, d):
    return C.pair_turns(t(spark, d, "conversations")).select("conv_id", "turn", C.training_text(F.col("user"), F.col("assistant")).alias("text"))


#: Labels of page and chapter, known for some documents only.
_PAGE, _CHAPTER = "CASE WHEN doc_id % 2 = 0 THEN doc_id % 7 + 1 END", "CASE WHEN doc_id % 5 = 0 THEN 'Part ' || (doc_id % 3) END"
_POOL = "CASE domain " + " ".join(f"WHEN '{k}' THEN {_quoted([*dict.fromkeys([*v, *GENERAL])])}" for k, v in TEMPLATES.items()) + f" ELSE {_quoted(GENERAL)} END"
_LABEL = f"coalesce('From ' || chr(39) || replace(replace({_FILE}, '.pdf', ''), '_', ' ') || chr(39) || ': ', '') || CASE WHEN ({_PAGE}) IS NOT NULL THEN '(Page ' || ({_PAGE}) || ') ' ELSE '' END || coalesce('[Chapter: ' || ({_CHAPTER}) || '] ', '')"
_ASKED = f"""p AS (SELECT doc_id, domain, {_POOL} AS pool, {_LABEL} AS label FROM ({_domain_sql()})),
e AS (SELECT doc_id, domain, label, len(pool) AS n, unnest(pool) AS template FROM p),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY md5('42|' || doc_id || '|' || template), template) AS r FROM e),
asked AS (SELECT doc_id, domain, replace(template, '{{label}}', label) AS question FROM k WHERE r <= least(5, greatest(3, n // 3)))"""


def _labelled(spark, d) -> tuple[DataFrame, Column]:
    docs = C.by_file(C.domain_scores(_filed(spark, d)).withColumns({"page": F.expr(_PAGE), "chapter": F.expr(_CHAPTER)}))
    return docs, C.source_label(F.col("filename"), F.col("page"), F.col("chapter"))


@query("j7_document_questions", f"WITH {_ASKED} SELECT doc_id, domain, question FROM asked")
def _(spark, d):
    docs, label = _labelled(spark, d)
    return C.questions(docs, ["doc_id"], label).select("doc_id", "domain", "question")


@query("u2_training_pairs", f"""WITH {_Q}, {_ASKED},
b AS (SELECT a.doc_id, a.question AS usr, d.text AS assistant FROM asked a JOIN documents d ON a.doc_id = d.doc_id WHERE coalesce(d.text, '') <> ''),
bm AS (SELECT *, CASE WHEN length(usr) > 0 THEN length(assistant) / length(usr) ELSE 0.0 END AS length_ratio, {_words('assistant')} AS ws, {_words('lower(assistant)')} AS lw, len(regexp_split_to_array(assistant, '[.!?]+')) AS segs, {_cosine('usr', 'assistant')} AS sim FROM b),
bz AS (SELECT doc_id, usr, (CASE WHEN length_ratio BETWEEN 0.1 AND 10.0 THEN 1.0::DOUBLE ELSE 0.5 END) * (CASE WHEN sim BETWEEN 0.1 AND 0.95 THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END)
  * (0.7::DOUBLE + 0.3::DOUBLE * least(1.0::DOUBLE, 20.0::DOUBLE / greatest(len(ws) / greatest(segs, 1), 1.0::DOUBLE))) * (0.8::DOUBLE + 0.2::DOUBLE * len(list_distinct(lw)) / greatest(len(lw), 1)) AS quality_score FROM bm)
SELECT 'conversation' AS source, conv_id || ':' || turn AS id, usr AS "user", round(quality_score, 9) AS quality_score FROM z WHERE quality_score >= 0.46
UNION ALL SELECT 'pdf', doc_id::VARCHAR, usr, round(quality_score, 9) FROM bz WHERE quality_score >= 0.46""")
def _(spark, d):
    docs, label = _labelled(spark, d)
    a = _good(spark, d).select(F.lit("conversation").alias("source"), F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "user", F.round("quality_score", 9).alias("quality_score"))
    b = C.question_pairs(docs, ["doc_id"], label).select(F.lit("pdf").alias("source"), F.col("doc_id").cast("string").alias("id"), "user", F.round("quality_score", 9).alias("quality_score"))
    return a.unionByName(b)


@query("k5_dataset_summary", f"""WITH {_SPLITS} SELECT (SELECT count(*) FROM sp) AS total_pairs, split, count(*) AS n, round(avg(quality_score), 9) AS mean, min(quality_score) AS min, max(quality_score) AS max FROM sp GROUP BY split""")
def _(spark, d):
    own = C.splits(_good(spark, d), ["conv_id", "turn"]).withColumns({"source_file": F.lit(None).cast("string"), "domain": F.lit(None).cast("string")})
    out = store.dataset_summary(own).select("total_pairs", "splits", F.explode("quality_stats").alias("split", "q"))
    return out.select("total_pairs", "split", F.element_at("splits", F.col("split")).alias("n"), F.round("q.mean", 9).alias("mean"), "q.min", "q.max")


@query("f10_reject_reason", rf"""WITH s AS (SELECT conv_id, turn, text AS x, lower(text) AS l, {_words('lower(text)')} AS ws FROM conversations)
SELECT conv_id, turn, CASE WHEN length({_strip('x')}) < 15 THEN 'too_short' {" ".join("WHEN " + " OR ".join(f"regexp_matches({c}, '" + p.replace("'", "''") + "')" for p in ps) + f" THEN '{n}'" for n, c, ps in (("deflection", "l", R.DEFLECTION), ("circular", "l", R.CIRCULAR), ("incomplete", "x", R.INCOMPLETE)))}
  WHEN len(list_filter(range(1, len(ws) - 1), lambda i: ws[i] = ws[i + 2])) > 0 THEN 'repetitive' ELSE 'valid' END AS reason FROM s""")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", R.reject_reason(F.col("text")).alias("reason"))


_ART = "text"
for _p, _by in R.ARTEFACTS:
    _ART = f"regexp_replace({_ART}, '{_p.replace('(?m)', '').replace('[' + chr(92) + 'p{C}&&[^' + chr(92) + 's]]', '[^' + chr(92) + 'P{C}' + chr(92) + 's]')}', '{_by.replace('$1', chr(92) + '1')}', '{'gm' if '(?m)' in _p else 'g'}')"


@query("p19_clean_response", rf"""WITH s AS (SELECT conv_id, turn, list_transform(regexp_split_to_array({_strip(_ART)}, '[.!?]+'), lambda x: {_strip('x')}) AS ss FROM conversations),
g AS (SELECT conv_id, turn, list_filter(ss, lambda x: length(x) >= 8 AND NOT regexp_matches(lower(x), '{"|".join(f"(?:{p})" for p in R.SKIPPED).replace("'", "''")}')) AS good FROM s),
o AS (SELECT conv_id, turn, CASE WHEN len(good) = 0 THEN '' WHEN length(good[1]) > 50 OR len(good) = 1 THEN good[1] ELSE good[1] || '. ' || good[2] END AS r FROM g)
SELECT conv_id, turn, CASE WHEN r = '' OR regexp_matches(r, '[.!?]$') THEN r ELSE r || '.' END AS cleaned FROM o""")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", R.clean_response(F.col("text")).alias("cleaned"))


@query("p22_fast_trims", """WITH s AS (SELECT conv_id, turn, split_part(text, '. ', 1) AS h, text, regexp_replace(substr(text, 1, 80), '^\\s+|\\s+$', '', 'g') AS c FROM conversations), k AS (SELECT conv_id, turn, CASE WHEN length(h) > 10 THEN h ELSE text END AS a, c FROM s)
SELECT conv_id, turn, CASE WHEN a = '' OR regexp_matches(a, '[.!?]$') THEN a ELSE a || '.' END AS sentence, CASE WHEN c = '' OR regexp_matches(c, '[.!?]$') THEN c ELSE c || '.' END AS chars FROM k""")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", R.first_sentence(F.col("text")).alias("sentence"), R.first_chars(F.col("text")).alias("chars"))


@query("p23_speech_text", "SELECT conv_id, turn, " + _strip(r"regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s.,!?;:\-]', '', 'g'), '\s+', ' ', 'g')") + " AS speech FROM conversations")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", T.speakable(F.col("text")).alias("speech"))


# RE2's word borders are ASCII, and it consumes what stands beside a match: so in two rounds
_FILL = "regexp_replace({}, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(?:um|uh|er|ah)([^\\p{{L}}\\p{{N}}_]|$)', '\\1\\2', 'g')"


@query("p24_without_fillers", "SELECT conv_id, turn, " + _strip(f"regexp_replace({_FILL.format(_FILL.format('text'))}, '\\s+', ' ', 'g')") + " AS spoken FROM conversations")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", T.without_fillers(F.col("text")).alias("spoken"))


@query("c1_request_classes", rf"""SELECT conv_id, turn, CASE WHEN regexp_matches(lower(text), 'why|how|what|explain|\?') THEN 'creative' WHEN len({_words('text')}) < 5 THEN 'focused' ELSE 'balanced' END AS style,
  CASE WHEN regexp_matches(lower(text), 'hello|hi|hey|greetings') THEN 'greeting' WHEN ends_with({_strip('text')}, '?') THEN 'question' ELSE 'statement' END AS kind, {_strip('lower(text)')} AS key0 FROM conversations""")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", R.generation_style(F.col("text")).alias("style"), R.fallback_kind(F.col("text")).alias("kind"), T.strip(F.lower("text")).alias("key0"))


@query("p18_prompts", "SELECT conv_id, turn, unnest(['<|user|>' || chr(10) || text || chr(10) || '<|assistant|>' || chr(10), 'User: ' || text || chr(10) || 'Assistant:', text || '<|endoftext|>']) AS prompt FROM conversations")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", F.explode(R.prompts(F.col("text"))).alias("prompt"))


_PICK = " ".join(f"WHEN '{k}' THEN {_quoted(v)}[('0x' || substr(md5(text), 1, 7))::INT % {len(v)} + 1]" for k, v in R.FALLBACKS.items())


@query("p25_cache_key_fallback", rf"""WITH k AS (SELECT *, CASE WHEN regexp_matches(lower(text), 'hello|hi|hey|greetings') THEN 'greeting' WHEN ends_with({_strip('text')}, '?') THEN 'question' ELSE 'statement' END AS kind FROM conversations)
SELECT conv_id, turn, regexp_replace({_strip('lower(text)')}, '\s+', ' ', 'g') AS key, CASE kind {_PICK} END AS fallback, {_strip("list_extract(string_split(text, 'Assistant:'), -1)")} AS reply FROM k""")
def _(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", T.cache_key(F.col("text")).alias("key"), R.fallback(F.col("text")).alias("fallback"), R.after_last(F.col("text")).alias("reply"))


@query("j2_knn", "WITH d AS (SELECT q.vec_id AS query_id, m.vec_id, list_sum(list_transform(list_zip(q.embedding, m.embedding), lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2]))) AS v FROM embeddings q JOIN embeddings m ON q.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY v, vec_id) AS rank FROM d) SELECT query_id, vec_id, rank::INT AS rank FROM r WHERE rank <= 10 AND query_id <> vec_id")
def _(spark, d):
    e = t(spark, d, "embeddings")
    return S.knn(e, e.where("vec_id % 100 = 0"), 10).where("query_id <> vec_id").select("query_id", "vec_id", "rank")


@query("j3_memory_search", "WITH d AS (SELECT q.vec_id AS query_id, m.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], m.embedding::DOUBLE[]) AS v FROM embeddings q JOIN embeddings m ON q.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY v DESC, vec_id) AS rank FROM d WHERE v >= 0.25) SELECT query_id, vec_id, round(v, 6) AS score FROM r WHERE rank <= 5 AND query_id <> vec_id")
def _(spark, d):
    e = t(spark, d, "embeddings")
    return S.knn(e, e.where("vec_id % 100 = 0"), 15, metric="cosine", least=0.25).where("rank <= 5 AND query_id <> vec_id").select("query_id", "vec_id", F.round("value", 6).alias("score"))


@query("j4_semantic_dedup", "SELECT vec_id FROM embeddings a WHERE NOT EXISTS (SELECT 1 FROM embeddings b WHERE b.vec_id < a.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4)")
def _(spark, d):
    return S.semantic_dedup(t(spark, d, "embeddings"), 0.4)


@query("p15_unit_vectors", "WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x))) AS norm FROM embeddings), u AS (SELECT vec_id, norm, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS k FROM n) SELECT vec_id, k::INT AS at, round(CASE WHEN norm = 0 THEN x ELSE x / norm END, 9) AS value FROM u")
def _(spark, d):
    e = t(spark, d, "embeddings").where(V.non_zero(F.col("embedding")))
    return e.select("vec_id", F.posexplode(V.unit(F.col("embedding"))).alias("at", "x")).select("vec_id", "at", F.round("x", 9).alias("value"))


@query("p16_hash_embedding", rf"""WITH w AS (SELECT conv_id, turn, unnest({_words('lower(text)')}) AS w FROM conversations), c AS (SELECT conv_id, turn, ('0x' || substr(md5(w), 1, 7))::INT % 64 AS slot, count(*)::DOUBLE AS n FROM w GROUP BY ALL)
SELECT conv_id, turn, slot, round(n / sqrt(sum(n * n) OVER (PARTITION BY conv_id, turn)), 9) AS value FROM c""")
def _(spark, d):
    out = V.embed(t(spark, d, "conversations")).select("conv_id", "turn", F.posexplode_outer("embedding").alias("slot", "x"))  # the outer form infers no filter that would be made of the whole embedding
    return out.where("x <> 0").select("conv_id", "turn", "slot", F.round("x", 9).alias("value"))


@query("a12_session_stats", "SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'error') AS fallbacks, 100.0::DOUBLE * (count(*) - count(*) FILTER (event_type = 'error')) / count(*) AS success_pct FROM events GROUP BY user_id")
def _(spark, d):
    return M.session_stats(t(spark, d, "events"))


@query("a12_method_counts", "SELECT event_type AS method, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    return M.method_counts(t(spark, d, "events"))


_METRICS = ["click", "view", "purchase"]


@query("a13_metric_series", "SELECT user_id AS step, " + ", ".join(f"arg_max(value, event_id) FILTER (event_type = '{m}') AS {m}" for m in _METRICS) + " FROM events GROUP BY user_id")
def _(spark, d):
    return M.metric_series(t(spark, d, "events"), _METRICS, "user_id", "event_type", "value", "event_id")


@query("a14_loss_summary", "WITH s AS (SELECT user_id AS step, arg_max(value, event_id) FILTER (event_type = 'click') AS x FROM events GROUP BY user_id) SELECT min(x) AS least, arg_max(x, step) FILTER (x IS NOT NULL) AS final FROM s")
def _(spark, d):
    return M.loss_summary(M.metric_series(t(spark, d, "events"), _METRICS, "user_id", "event_type", "value", "event_id"), "click")


@query("a16_recent_mean", "SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS recent_mean FROM events")
def _(spark, d):
    return M.recent_mean(t(spark, d, "events"), "user_id", "value", ["ts", "event_id"]).select("event_id", "user_id", F.round("recent_mean", 6).alias("recent_mean"))


@query("w8_latest_turns", "SELECT conv_id, turn, age::INT AS age FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS age FROM conversations) WHERE age <= 10")
def _(spark, d):
    return M.latest(t(spark, d, "conversations"), "conv_id", ["turn"], 10).select("conv_id", "turn", "age")


@query("a15_lru_hits", """WITH s AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events),
l AS (SELECT *, lag(p) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS q FROM s)
SELECT a.event_id, a.q IS NOT NULL AND (SELECT count(DISTINCT b.event_type) FROM s b WHERE b.user_id = a.user_id AND b.p > a.q AND b.p < a.p) < 2 AS hit FROM l a""")
def _(spark, d):
    return M.lru_hits(t(spark, d, "events"), "user_id", "event_type", "event_id", 2).select("event_id", "hit")


@query("a11_length_stats", f"SELECT min(n) AS shortest, max(n) AS longest, round(avg(n), 6) AS mean FROM (SELECT len({_words('text')}) AS n FROM documents)")
def _(spark, d):
    own = t(spark, d, "documents").select(T.n_words(F.col("text")).alias("n"))
    return own.agg(F.min("n").alias("shortest"), F.max("n").alias("longest"), F.round(F.avg("n"), 6).alias("mean"))


@query("a19_funnel", f"SELECT count(*) AS entries, count(*) FILTER ({_strip('text')} <> '') AS non_blank, count(DISTINCT md5(text)) AS distinct_texts FROM conversations")
def _(spark, d):
    c = t(spark, d, "conversations")
    return c.agg(F.count("*").alias("entries"), F.count_if(T.strip(F.col("text")) != "").alias("non_blank"), F.count_distinct(F.md5("text")).alias("distinct_texts"))


@query("p28_collate", rf"""WITH k AS (SELECT doc_id, list_transform({_words('text')}, lambda w: length(w)::INT)[1:512] AS own, doc_id // 4 AS batch_id FROM documents), m AS (SELECT *, max(len(own)) OVER (PARTITION BY batch_id) AS width FROM k)
SELECT doc_id, batch_id, array_to_string(list_resize(own, width, 0), ',') AS input_ids, repeat('1', len(own)) || repeat('0', (width - len(own))::INT) AS attention_mask, array_to_string(list_resize(own, width, 0), ',') AS labels FROM m""")
def _(spark, d):
    toks = t(spark, d, "documents").select("doc_id", F.transform(T.words(F.col("text")), F.length).alias("ids"))
    joined = lambda c, by: F.array_join(F.col(c).cast("array<string>"), by)
    return M.collate(toks, "doc_id", "ids", 4).select("doc_id", "batch_id", joined("input_ids", ",").alias("input_ids"), joined("attention_mask", "").alias("attention_mask"), joined("labels", ",").alias("labels"))


@query("u1_union_sources", "SELECT 'conversation' AS source, conv_id AS id, text FROM conversations UNION ALL SELECT 'pdf', doc_id, text FROM documents")
def _(spark, d):
    a = t(spark, d, "conversations").select(F.lit("conversation").alias("source"), F.col("conv_id").alias("id"), "text")
    return a.unionByName(t(spark, d, "documents").select(F.lit("pdf").alias("source"), F.col("doc_id").alias("id"), "text"))


@query("o6_keyed_sample", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) AS r FROM documents) WHERE r <= 5")
def _(spark, d):
    w = Window.partitionBy("source").orderBy(F.md5(F.concat(F.lit("42|"), F.col("doc_id").cast("string"))), "doc_id")
    return t(spark, d, "documents").select("source", "doc_id", F.row_number().over(w).alias("r")).where("r <= 5").select("source", "doc_id")


@query("r8_event_windows", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(spark, d):
    e = t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


_SAID = "(CASE turn % 4 WHEN 0 THEN text || ' User: more' WHEN 1 THEN '**' || text || '** <b>x</b> assistant: y' WHEN 2 THEN '# ' || text ELSE text || chr(10) || '--- User: z' END)"


def _marked(spark, d) -> DataFrame:
    said = F.expr("CASE turn % 4 WHEN 0 THEN text || ' User: more' WHEN 1 THEN '**' || text || '** <b>x</b> assistant: y' WHEN 2 THEN '# ' || text ELSE text || char(10) || '--- User: z' END")
    return t(spark, d, "conversations").select("conv_id", "turn", said.alias("said"))


_MARK_ARMS = " ".join(f"WHEN contains(lower(said), '{m.lower()}') THEN {_strip(f'substr(said, 1, strpos(lower(said), {chr(39)}{m.lower()}{chr(39)}) - 1)')}" for m in R.TURN_MARKS)


@query("p20_post_process", rf"""WITH s AS (SELECT conv_id, turn, {_SAID} AS said FROM conversations), c AS (SELECT conv_id, turn, CASE {_MARK_ARMS} ELSE said END AS c FROM s),
k AS (SELECT conv_id, turn, {_strip(r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(c, '<[^>]+>', '', 'g'), '\*+', '', 'g'), '#+\s*', '', 'g'), '\s+', ' ', 'g')")} AS r FROM c)
SELECT conv_id, turn, CASE WHEN r = '' OR regexp_matches(r, '[.!?]$') THEN r ELSE r || '.' END AS reply FROM k""")
def _(spark, d):
    return _marked(spark, d).select("conv_id", "turn", R.post_process(F.col("said")).alias("reply"))


_TRIMMED = _strip("list_extract(string_split(said, 'Assistant:'), -1)")
for _x in R.CHAT_PHRASES:
    _y = _x.replace("'", "''")
    _TRIMMED = _strip(f"replace({_TRIMMED}, '{_y}', '')")


@query("p21_chat_reply", rf"""WITH s AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'User: a' || chr(10) || 'Assistant: User: ' || text WHEN 1 THEN '--- - **I have memory.** ' || text ELSE 'Ok.' END AS said FROM conversations),
a AS (SELECT conv_id, turn, {_TRIMMED} AS r FROM s),
b AS (SELECT conv_id, turn, CASE WHEN starts_with(r, 'User:') THEN {_strip('substr(r, 6)')} ELSE r END AS r FROM a),
f AS (SELECT conv_id, turn, list_filter(list_transform(string_split(r, '.'), lambda x: {_strip('x')}), lambda x: x <> '') AS ss FROM b),
o AS (SELECT conv_id, turn, CASE WHEN len(ss) > 0 THEN ss[1] || '.' ELSE '' END AS r FROM f)
SELECT conv_id, turn, CASE WHEN r = '' THEN 'I' || chr(39) || 'm thinking about that...' WHEN len({_words('r')}) < 3 THEN 'I' || chr(39) || 'm processing that thought.' ELSE r END AS reply FROM o""")
def _(spark, d):
    said = F.expr("CASE turn % 3 WHEN 0 THEN 'User: a' || char(10) || 'Assistant: User: ' || text WHEN 1 THEN '--- - **I have memory.** ' || text ELSE 'Ok.' END")
    return t(spark, d, "conversations").select("conv_id", "turn", R.chat_reply(said).alias("reply"))


@query("p26_memory_context", """WITH m AS (SELECT conv_id, list('[2024-01-01T00:00:00] (' || role || ') ' || text ORDER BY turn)[1:3] AS ms, arg_max(text, turn) AS asked FROM conversations GROUP BY conv_id)
SELECT conv_id, 'Context:' || chr(10) || 'Relevant memories:' || chr(10) || array_to_string(list_transform(ms, lambda x, i: i || '. ' || substr(substr(x, strpos(x, ') ') + 2), 1, 150) || '...'), chr(10)) || chr(10) || chr(10) || 'User: ' || asked || chr(10) || 'Assistant:' AS prompt FROM m""")
def _(spark, d):
    line = R.memory_line(F.lit("2024-01-01T00:00:00.123456"), F.col("role"), F.col("text"))
    own = t(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]).alias("memories"), F.max_by("text", "turn").alias("asked"))
    none = F.array().cast("array<struct<user:string,bot:string>>")
    return own.select("conv_id", R.prompt_with_context(F.col("asked"), F.col("memories"), none).alias("prompt"))


@query("p8_context_prefix", f"""WITH {_P2}, c AS (SELECT conv_id, turn, usr, concat_ws(' ', 'Assistant: ' || lag(assistant, 2) OVER w, 'User: ' || lag(usr) OVER w, 'Assistant: ' || lag(assistant) OVER w) AS context FROM pairs WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, CASE WHEN context <> '' THEN 'Context: ' || context || chr(10) || chr(10) || 'User: ' || usr ELSE usr END AS "user" FROM c""")
def _(spark, d):
    out = C.with_context(C.pair_turns(t(spark, d, "conversations")))
    return out.select("conv_id", "turn", C.with_context_prefix(F.col("user"), F.col("context")).alias("user"))


@query("f3_drop_emptied", "WITH s AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 0 THEN chr(8203) || chr(10) || ' ' ELSE text END AS text FROM conversations) SELECT conv_id, turn, cleaned FROM (SELECT conv_id, turn, " + _strip(_CLEAN) + " AS cleaned FROM s) WHERE cleaned <> ''")
def _(spark, d):
    c = t(spark, d, "conversations").withColumn("text", F.when(F.col("turn") % 5 == 0, "\u200b\n ").otherwise(F.col("text")))
    return C.drop_emptied(c).select("conv_id", "turn", "cleaned")


@query("f6_source_filter", "SELECT 'pdf' AS source, doc_id AS id FROM documents")
def _(spark, d):
    return QUERIES["u1_union_sources"](spark, d).where("source = 'pdf'").select("source", "id")


@query("f9_known_conversation", "SELECT CASE WHEN conv_id % 3 <> 0 THEN conv_id END AS conv_id, turn FROM conversations WHERE conv_id % 3 <> 0")
def _(spark, d):
    c = t(spark, d, "conversations").withColumn("conv_id", F.when(F.col("conv_id") % 3 != 0, F.col("conv_id")))
    return c.where(F.col("conv_id").isNotNull()).select("conv_id", "turn")


@query("f13_unknown_texts", r"SELECT min(conv_id) AS conv_id, text FROM conversations WHERE regexp_replace(coalesce(text, ''), '\s+', '', 'g') <> '' AND text NOT IN (SELECT text FROM conversations WHERE conv_id % 4 = 0 AND text IS NOT NULL) GROUP BY text")
def _(spark, d):
    c = t(spark, d, "conversations").select("conv_id", "text")
    return store.unknown(c, c.where("conv_id % 4 = 0"))


@query("p27_token_ids", r"WITH w AS (SELECT doc_id, list_transform(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')[1:512], lambda w: ('0x' || substr(md5(w), 1, 7))::INT % 50000) AS ids FROM documents) SELECT doc_id, array_to_string(ids, ',') AS ids FROM w")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", F.array_join(T.token_ids(F.col("text")).cast("array<string>"), ",").alias("ids"))


@query("p29_entities", r"WITH e AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '\p{Lu}[\p{L}]*(?: \p{Lu}[\p{L}]*)*|\p{N}+')) AS entity FROM documents) SELECT doc_id, entity, CASE WHEN regexp_matches(entity, '^\p{N}') THEN 'NUMBER' ELSE 'NAME' END AS label, count(*) AS n FROM e WHERE length(entity) > 2 GROUP BY ALL")
def _(spark, d):
    return t(spark, d, "documents").select("doc_id", F.inline(T.entities(F.col("text")))).groupBy("doc_id", F.col("text").alias("entity"), "label").agg(F.count("*").alias("n"))


@query("p30_new_memory", "SELECT text, role AS type, length(text)::INT AS length, true AS stamped FROM conversations")
def _(spark, d):
    out = store.new_memory(t(spark, d, "conversations"), kind="role")
    return out.select("text", "type", "length", F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$").alias("stamped"))


@query("p7_unescape", r"SELECT conv_id, turn, replace(text, chr(92) || 'n', chr(10)) AS text FROM (SELECT conv_id, turn, regexp_replace(text, '[^a-zA-Z ]', '', 'g') || ' tail' AS text FROM conversations)")
def _(spark, d):
    c = t(spark, d, "conversations").select("conv_id", "turn", F.concat(F.regexp_replace("text", "[^a-zA-Z ]", ""), F.lit(r" \u0074ail")).alias("text"))
    return c.select("conv_id", "turn", T.unescape(F.col("text")).alias("text"))


@query("p23_speech_caps", "WITH s AS (SELECT conv_id, turn, length(text) AS n, " + _strip(r"regexp_replace(regexp_replace(text, '[^\p{L}\p{N}_\s.,!?;:\-]', '', 'g'), '\s+', ' ', 'g')") + " AS x FROM conversations) SELECT conv_id, turn, CASE WHEN n <= 150 THEN substr(x, 1, 100) END AS fast, CASE WHEN n <= 80 THEN substr(x, 1, 60) END AS quick, CASE WHEN n <= 200 THEN x END AS whole FROM s")
def _(spark, d):
    clip = lambda *a: T.speech_clip(F.col("text"), *a)
    return t(spark, d, "conversations").select("conv_id", "turn", clip(150, 100).alias("fast"), clip(80, 60).alias("quick"), clip(200).alias("whole"))


@query("j8_requests", "WITH p AS (SELECT conv_id, turn, unnest(['<|user|>' || chr(10) || text || chr(10) || '<|assistant|>' || chr(10), 'User: ' || text || chr(10) || 'Assistant:', text || '<|endoftext|>']) AS prompt FROM conversations) SELECT conv_id, turn, prompt, config::INT AS config, substr(prompt, 1, 6) || '-' || config AS method FROM p, range(1, 4) r(config)")
def _(spark, d):
    return R.requests(t(spark, d, "conversations")).select("conv_id", "turn", "prompt", "config", "method")


_CANDIDATES = "(SELECT q.conv_id, q.turn, q.text AS asked, a.turn AS place, a.text AS reply, 'turn-' || a.turn AS method FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id WHERE q.role = 'user' AND a.role = 'assistant')"


@query("o4_best_candidate", f"""WITH c AS {_CANDIDATES}, f AS ({ORACLES['f10_reject_reason']}),
s AS (SELECT c.*, {_cosine('asked', 'reply')} AS coherence, f.reason FROM c JOIN f ON f.conv_id = c.conv_id AND f.turn = c.place),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY coherence DESC, place) AS k FROM s WHERE reason = 'valid'),
q AS (SELECT DISTINCT conv_id, turn FROM c)
SELECT q.conv_id, q.turn, CASE WHEN coherence >= 0.4 THEN method ELSE 'fallback' END AS method, CASE WHEN coherence >= 0.4 THEN round(coherence, 9) END AS coherence FROM q LEFT JOIN r ON r.conv_id = q.conv_id AND r.turn = q.turn AND k = 1""")
def _(spark, d):
    c = t(spark, d, "conversations")
    asked = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    replies = c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("place"), F.col("text").alias("reply"), F.concat(F.lit("turn-"), F.col("turn").cast("string")).alias("method"))
    out = R.best_candidate(asked.join(replies, "conv_id"), ["conv_id", "turn"])
    return out.select("conv_id", "turn", "method", F.round("coherence", 9).alias("coherence"))


@query("j1_corpus_join", "SELECT doc_id, length(text) AS n, source, quality FROM documents JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)")
def _(spark, d):
    docs = t(spark, d, "documents")
    labels = t(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return docs.select("doc_id", F.length("text").cast("long").alias("n")).join(docs.select("doc_id", "source"), "doc_id").join(labels, "doc_id")


@query("j4_in_blocks", """WITH o AS (SELECT vec_id, embedding::DOUBLE[] AS e, (row_number() OVER (ORDER BY vec_id) - 1) // 250 AS b FROM embeddings),
k0 AS (SELECT vec_id, e FROM o x WHERE b = 0 AND NOT EXISTS (SELECT 1 FROM o y WHERE y.b = 0 AND y.vec_id < x.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.4)),
k1 AS (SELECT * FROM k0 UNION ALL SELECT vec_id, e FROM o x WHERE b = 1 AND NOT EXISTS (SELECT 1 FROM k0 y WHERE list_cosine_similarity(x.e, y.e) >= 0.4))
SELECT vec_id FROM k1""")
def _(spark, d):
    e = t(spark, d, "embeddings").orderBy("vec_id").limit(500)  # the feature works in input order; two blocks show its rule
    return S.semantic_dedup_in_blocks(e, 0.4, size=250)


@query("j2_distance_and_cosine", "WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), d AS (SELECT q.vec_id AS query_id, m.vec_id, list_cosine_similarity(q.e, m.e) AS c FROM u q JOIN u m ON q.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(c, 9) DESC, vec_id) AS rank FROM d) SELECT query_id, vec_id, round(2 - 2 * c, 6) AS distance, round(c, 6) AS cosine FROM r WHERE rank <= 5")
def _(spark, d):
    e = t(spark, d, "embeddings").withColumn("embedding", V.unit(F.col("embedding")))
    out = S.with_distance(S.knn(e, e.where("vec_id % 100 = 0"), 5))
    return out.select("query_id", "vec_id", F.round("distance", 6).alias("distance"), F.round("cosine", 6).alias("cosine"))


@query("a17_throughput", "SELECT event_type, count(*) AS items, round(count(*) / (epoch(max(ts)) - epoch(min(ts))), 9) AS per_second FROM events GROUP BY event_type")
def _(spark, d):
    return M.throughput(t(spark, d, "events"), "event_type", "ts").select("event_type", "items", F.round("per_second", 9).alias("per_second"))


@query("a18_parameters", "SELECT sum(CASE WHEN label = 1 THEN len(embedding) * 3 ELSE 0 END)::BIGINT AS trainable, sum(len(embedding) * 3)::BIGINT AS total FROM embeddings")
def _(spark, d):
    own = t(spark, d, "embeddings").select(F.array(F.size("embedding").cast("long"), F.lit(3).cast("long")).alias("shape"), (F.col("label") == 1).alias("trainable"))
    return M.parameter_counts(own).select("trainable", "total")


_MODELS = {"sprinter": "small", "sprinter-long": "large", "walker": "medium"}


@query("j10_model_setting", "WITH m AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Sprinter' WHEN 1 THEN 'my-sprinter-long-2' WHEN 2 THEN 'walker' WHEN 3 THEN 'a sprinter' ELSE NULL END AS model FROM events) SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'small' WHEN 1 THEN 'large' WHEN 2 THEN 'medium' WHEN 3 THEN 'small' ELSE 'auto' END AS setting FROM m")
def _(spark, d):
    model = F.expr("CASE event_id % 5 WHEN 0 THEN 'Sprinter' WHEN 1 THEN 'my-sprinter-long-2' WHEN 2 THEN 'walker' WHEN 3 THEN 'a sprinter' END")
    return t(spark, d, "events").select("event_id", R.model_setting(model, _MODELS, "auto").alias("setting"))


@query("s2_pages", r"WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents) SELECT doc_id || '.txt' AS filename, 1 AS page, count(*) AS lines FROM l WHERE x IS NOT NULL GROUP BY doc_id HAVING length(regexp_replace(string_agg(x, ''), '\s+', '', 'g')) > 0")
def _(spark, d):
    docs = t(spark, d, "documents").where("text IS NOT NULL").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"), F.col("text").cast("binary").alias("content"), F.size(F.split("text", "\n")).cast("long").alias("lines"))
    return files.pages(docs.select("filename", "content")).join(docs.select("filename", "lines"), "filename").select("filename", "page", "lines")


@query("r8_session_windows", "WITH s AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, k")
def _(spark, d):
    e = t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")
