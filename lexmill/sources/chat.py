"""Chat exports and document files in JSON, of several root shapes, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import ingest_text, ingest_valid
from lexmill.operators.curation import chunks


def _text(v: str, *paths: str) -> list[Column]:
    return [F.nullif(F.expr(f"try_variant_get({v}, '{p}', 'string')"), F.lit("")) for p in paths]


def _kind(v: str) -> Column:
    return F.expr(f"schema_of_variant({v})")


def _listed(v: str, field: str) -> Column:
    """The first text or content string of a list's objects, whichever item holds it."""
    held = lambda k: f"CASE WHEN schema_of_variant(try_variant_get(x, '$.{k}', 'variant')) = 'STRING' THEN nullif(try_variant_get(x, '$.{k}', 'string'), '') END"
    items = f"try_variant_get({v}, '$.{field}', 'array<variant>')"
    return F.expr(f"get(filter(transform({items}, x -> coalesce({held('text')}, {held('content')})), y -> y IS NOT NULL), 0)")


def content(v: str) -> Column:
    """The first of content, text, message that holds something: a string, parts, a text field, or a list of such."""
    out = []
    for f in ("content", "text", "message"):
        whole = F.expr(f"try_variant_get({v}, '$.{f}', 'variant')")
        kind = F.expr(f"schema_of_variant(try_variant_get({v}, '$.{f}', 'variant'))")
        first = F.expr(f"schema_of_variant(try_variant_get({v}, '$.{f}[0]', 'variant'))")
        plain = F.when(kind == "STRING", _text(v, f"$.{f}")[0])
        out.append(F.coalesce(plain, F.when(whole.isNotNull(), F.coalesce(*_text(v, f"$.{f}.parts[0]", f"$.{f}.text", f"$.{f}[0].text", f"$.{f}[0].content"), F.when(first == "STRING", _text(v, f"$.{f}[0]")[0]), _listed(v, f), *_text(v, f"$.{f}[0]")))))
    return F.trim(F.coalesce(*out, F.lit("")))


def author(v: str) -> Column:
    plain = []
    for f in ("author", "role", "sender"):
        kind = F.expr(f"schema_of_variant(try_variant_get({v}, '$.{f}', 'variant'))")
        plain.append(F.coalesce(F.when(kind == "STRING", _text(v, f"$.{f}")[0]), *_text(v, f"$.{f}.role", f"$.{f}.name")))
    name = F.lower(F.coalesce(*plain, F.lit("unknown")))
    return F.when(name.isin("human", "user"), "user").when(name.isin("assistant", "ai", "claude"), "assistant").otherwise(name)


def _timestamp(v: str, *fields: str) -> Column:
    return F.coalesce(*_text(v, *(f"$.{f}" for f in fields)))


def conversations(files: DataFrame, raw: str = "value", strict: bool = False) -> DataFrame:
    """files: one row for each file, its text in raw. Rows: file columns, conversation_id, v (variant)."""
    parse = "parse_json" if strict else "try_parse_json"
    rest = [c for c in files.columns if c != raw]
    root = files.select(*rest, F.expr(f"{parse}({raw})").alias("root")).where("root IS NOT NULL")
    root = root.withColumn("shape", F.expr("schema_of_variant(root)"))
    listed = F.when(F.col("shape").startswith("ARRAY"), F.expr("try_variant_get(root, '$', 'array<variant>')"))
    inner = F.expr("try_variant_get(root, '$.conversations', 'array<variant>')")
    one = F.array("root")
    known = F.expr("variant_get(root, '$.mapping', 'variant') IS NOT NULL OR variant_get(root, '$.messages', 'variant') IS NOT NULL OR variant_get(root, '$.content', 'variant') IS NOT NULL OR variant_get(root, '$.text', 'variant') IS NOT NULL OR variant_get(root, '$.message', 'variant') IS NOT NULL")
    values = F.map_values(F.expr("try_variant_get(root, '$', 'map<string,variant>')"))
    found = F.coalesce(listed, inner, F.when(known, one), values, one)
    return root.select(*rest, F.posexplode(found).alias("conversation_id", "v"))


def messages(convs: DataFrame) -> DataFrame:
    """The messages of conversations: text, author, message_id, timestamp; blank ones are left out."""
    rest = [c for c in convs.columns if c != "v"]
    items = F.transform(F.coalesce(F.expr("try_variant_get(v, '$.messages', 'array<variant>')"), F.expr("try_variant_get(v, '$', 'array<variant>')")), lambda m, i: F.struct(i.cast("string").alias("id"), m.alias("m")))
    mapped = F.transform(F.map_entries(F.expr("try_variant_get(v, '$.mapping', 'map<string,variant>')")), lambda e: F.struct(e["key"].alias("id"), F.call_function("try_variant_get", e["value"], F.lit("$.message"), F.lit("variant")).alias("m")))
    single = F.array(F.struct(F.lit("0").alias("id"), F.col("v").alias("m")))
    own = convs.select(*rest, F.explode(F.coalesce(mapped, items, single)).alias("e")).select(*rest, F.col("e.id").alias("message_id"), F.col("e.m").alias("m")).where("m IS NOT NULL")
    out = own.select(*rest, "message_id", content("m").alias("text"), author("m").alias("author"), _timestamp("m", "timestamp", "created_at", "create_time", "time").alias("timestamp"))
    return out.where("text <> ''")


def profile(files: DataFrame, raw: str = "value") -> DataFrame:
    """What each file holds: its root's type, length and first keys, the shape of its first entry and that one's text field."""
    rest = [c for c in files.columns if c != raw]
    kind = F.when(F.ltrim(raw).startswith("["), "list").when(F.ltrim(raw).startswith("{"), "dict").otherwise("other")
    first = F.when(kind == "list", F.get_json_object(raw, "$[0]")).when(kind == "dict", F.col(raw))
    keys = F.json_object_keys(first)
    named = F.get(F.filter(F.array(*map(F.lit, ("text", "content", "total_text", "body", "message"))), lambda k: F.array_contains(keys, k)), F.lit(0))
    shape = F.when(keys.isNull(), F.when(first.isNotNull(), "scalar")).otherwise(F.array_join(F.array_sort(keys), ","))
    return files.select(*rest, kind.alias("root"), F.coalesce(F.json_array_length(raw), F.size(F.json_object_keys(raw))).alias("length"), F.json_object_keys(raw).alias("keys"), shape.alias("shape"), named.alias("text_field"))


def estimate(files: DataFrame, raw: str = "value") -> DataFrame:
    """files with items: how many entries each holds, by its root's shape, without a scan of the entries."""

    def held(path: str) -> Column:
        part = F.get_json_object(raw, path)
        return F.coalesce(F.json_array_length(part), F.size(F.json_object_keys(part)))

    values = F.map_values(F.expr(f"try_variant_get(try_parse_json({raw}), '$', 'map<string,variant>')"))
    size = lambda v: F.coalesce(F.json_array_length(F.to_json(v)), F.size(F.json_object_keys(F.to_json(v))), F.lit(1))
    other = F.aggregate(F.transform(values, size), F.lit(0), lambda a, x: a + x)
    known = [F.when(F.get_json_object(raw, f"$.{k}").isNotNull(), held(f"$.{k}")) for k in ("conversations", "mapping", "messages")]
    rest = [c for c in files.columns if c != raw]
    return files.select(*rest, F.coalesce(F.json_array_length(raw), *known, other, F.lit(0)).alias("items"))


def entries(spark, rows: list[dict]) -> DataFrame:
    """A source held in memory: text, source, message_id, author, timestamp, filename; what a row lacks is null."""
    names = ("text", "source", "message_id", "author", "timestamp", "filename")
    return spark.createDataFrame([tuple(None if r.get(n) is None else str(r[n]) for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def documents(files: DataFrame, raw: str = "value", strict: bool = False) -> DataFrame:
    """Document files: a list of documents; the text is the first string among text, content, total_text, body. A file
    that is no JSON is skipped, or with strict an error."""
    rest = [c for c in files.columns if c != raw]
    parse = "parse_json" if strict else "try_parse_json"
    own = files.select(*rest, F.posexplode(F.expr(f"try_variant_get({parse}({raw}), '$', 'array<variant>')")).alias("document_id", "v"))
    body = F.coalesce(*(F.when(F.expr(f"schema_of_variant(try_variant_get(v, '$.{f}', 'variant'))") == "STRING", F.expr(f"try_variant_get(v, '$.{f}', 'string')")) for f in ("text", "content", "total_text", "body")))
    name = F.coalesce(*_text("v", "$.filename"), F.concat(F.lit("document_"), F.col("document_id"), F.lit(".pdf")))
    return own.select(*rest, "document_id", name.alias("filename"), F.trim(body).alias("text")).where("text <> ''")


def document_chunks(files: DataFrame, raw: str = "value", strict: bool = False, cut_first: bool = False) -> DataFrame:
    """The valid chunks of document files: file columns, document_id, filename, chunk_id, total_chunks, chunk. cut_first cuts
    texts to the longest that is embedded before they are chunked, as one old form did."""
    docs = documents(files, raw, strict)
    rest = [c for c in docs.columns if c not in ("text", "document_id", "filename")]
    own = docs.withColumn("chunk_key", F.struct(*rest, "document_id", "filename"))
    own = own.withColumn("text", ingest_text(F.col("text"))) if cut_first else own
    out = chunks(own, "text", "chunk_key").where(ingest_valid(F.col("chunk")))
    return out.select("chunk_key.*", "chunk_id", "total_chunks", "chunk")


def assemble(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """Documents of pages: the texts in page order, a blank line between; a document without text has failed."""
    kept = F.collect_list(F.when(F.trim(text) != "", F.struct(F.col(page).alias("page"), F.trim(text).alias("text"))))
    out = pages.groupBy(key).agg(F.array_sort(kept).alias("pages"))
    total = F.array_join(F.transform("pages", lambda p: p["text"]), "\n\n")
    return out.select(key, "pages", total.alias("total_text"), F.when(F.size("pages") == 0, "failed").otherwise("ok").alias("status"))
