"""Files, stores, configuration and streams of entries."""

import io
import wave
import zlib

import pytest
from pyspark.sql import functions as F

from lexmill import config
from lexmill.functions import text as T
from lexmill.operators import curation as C
from lexmill.operators import responses as R
from lexmill.operators import telemetry as M
from lexmill.operators import vectors as S
from lexmill.sources import chat, files, store
from lexmill.streaming import streams

LONG = "these are plain words that stand in one valid entry number"


def pdf(*pages: str) -> bytes:
    out = b"%PDF-1.4\n"
    for k, text in enumerate(pages):
        body = f"BT /F1 12 Tf ({text}) Tj T* (next line) Tj ET".encode("latin-1") if text else b"BT ET"
        body, kind = (zlib.compress(body), b"/Filter /FlateDecode ") if k % 2 else (body, b"")
        out += b"%d 0 obj\n<< " % k + kind + b"/Length %d >>\nstream\n" % len(body) + body + b"\nendstream\nendobj\n"
    return out + b"%%EOF"


def test_pages_of_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(pdf(r"One \(first\)", "", "Three"))
    (tmp_path / "b.pdf").write_bytes(b"plain text in place of a file of pages")
    (tmp_path / "c.pdf").write_bytes(b"\xff\xfe\x00")
    (tmp_path / "d.txt").write_text("not taken")
    found = files.scan(spark, str(tmp_path))
    assert sorted(r["filename"] for r in found.collect()) == ["a.pdf", "b.pdf", "c.pdf"]
    got = sorted((r["filename"], r["page"], r["text"]) for r in files.pages(found).collect())
    assert got == [("a.pdf", 1, "One (first)\nnext line"), ("a.pdf", 3, "Three\nnext line"), ("b.pdf", 1, "plain text in place of a file of pages")]
    (tmp_path / "none").mkdir()
    assert files.scan(spark, str(tmp_path / "none")).count() == 0


def test_wav_round_trip(spark):
    raw = bytes(range(250)) * 40
    made = spark.createDataFrame([("x.wav", bytearray(raw)), ("bad.wav", bytearray(b"no audio"))], "filename string, s binary")
    stored = made.select("filename", F.when(F.col("filename") == "bad.wav", F.col("s")).otherwise(files.wav_bytes(F.col("s"))).alias("content"))
    with wave.open(io.BytesIO(bytes(stored.where("filename = 'x.wav'").first()["content"]))) as w:
        assert (w.getframerate(), w.getnframes()) == (16_000, 5000)
    got = files.wav_chunks(stored).orderBy("chunk").collect()
    assert [(r["chunk"], r["rate"], r["n_frames"]) for r in got] == [(0, 16_000, 4000), (1, 16_000, 1000)]
    assert b"".join(bytes(r["samples"]) for r in got) == raw


def test_corpus_round_trip(spark, tmp_path):
    texts = spark.createDataFrame([(2, "b", "s"), (1, "a", "t"), (3, "no vector", "t")], "id long, text string, source string")
    vectors = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id long, embedding array<double>")
    store.write_corpus(texts, vectors, str(tmp_path / "c"), config={"dims": 1})
    assert sorted(map(tuple, store.read_corpus(spark, str(tmp_path / "c")).collect())) == [(1, "a", "t", [1.0]), (2, "b", "s", [2.0])]
    assert store.read_corpus_config(spark, str(tmp_path / "c")) == {"dims": 1}


def test_memory_takes_a_text_once(spark, tmp_path):
    path = str(tmp_path / "m")
    own = lambda *xs: store.new_memory(spark.createDataFrame([(x, "user") for x in xs], "text string, type string"))
    assert store.append_memory(own("a", "b", "a", "  ", None), path) == 2
    assert store.append_memory(own("b", "c"), path) == 1
    assert sorted(r["text"] for r in store.read_memory(spark, path).collect()) == ["a", "b", "c"]


def test_checkpoint_of_a_base_folder(spark):
    paths = lambda *xs: spark.createDataFrame([(x,) for x in xs], "path string")
    assert store.latest_checkpoint(paths("m/config.json"), base="m").first()[0] == "m"
    assert store.latest_checkpoint(paths("m/config.json", "m/checkpoint-2", "m/checkpoint-10"), base="m").first()[0] == "m/checkpoint-10"
    assert store.latest_checkpoint(paths("m/other"), base="m").first()[0] is None


def test_config_from_text():
    got = config.load("# settings\nmin_quality: 0.6  # higher\nshares: [0.7, 0.2]\nseed: '7'\n")
    assert (got.min_quality, got.shares, got.seed, got.min_chars) == (0.6, (0.7, 0.2), "7", 10)
    with pytest.raises(ValueError, match="unknown settings: speed"):
        config.load("speed: 3")


def test_strict_files_raise(spark):
    bad = spark.createDataFrame([("{no json",), ("[]",)], "value string")
    assert chat.conversations(bad).count() == 0 and chat.documents(bad).count() == 0
    for f in (chat.conversations, chat.documents):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            f(bad, strict=True).collect()


def test_document_chunks_cut_or_whole(spark):
    text = " ".join("abcdefghij"[i % 10] * 5 for i in range(900))
    docs = spark.createDataFrame([("f", f'[{{"filename": "a.pdf", "total_text": "{text}"}}]')], "file string, value string")
    assert [r["total_chunks"] for r in chat.document_chunks(docs).collect()] == [3, 3, 3]
    assert [r["total_chunks"] for r in chat.document_chunks(docs, cut_first=True).collect()] == [1]


def test_estimates_and_entries(spark):
    roots = ['[1, 2, 3]', '{"conversations": [1, 2]}', '{"mapping": {"a": 1, "b": 2, "c": 3}}', '{"messages": [1]}', '{"x": [1, 2], "y": {"k": 1}, "z": 5}', "{bad"]
    got = chat.estimate(spark.createDataFrame(list(enumerate(roots)), "k int, value string")).collect()
    assert [r["items"] for r in sorted(got)] == [3, 2, 3, 1, 4, 0]
    rows = chat.entries(spark, [{"text": "a", "author": "user"}, {"text": "b", "timestamp": 5}]).collect()
    assert [(r["text"], r["author"], r["timestamp"]) for r in rows] == [("a", "user", None), ("b", None, "5")]


def test_ingest_resumes_and_replays(spark, tmp_path):
    src, out, mark = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "mark")
    put = lambda *xs: spark.createDataFrame([(f"{LONG} {x}",) for x in xs] + [("short",)], "text string").coalesce(1).write.mode("append").parquet(src)
    seen = streams.Progress()
    spark.streams.addListener(seen)
    put("a", "b", "a")
    run = lambda: streams.ingest(spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).parquet(src), out, mark).awaitTermination(120)
    run()
    put("b", "c")
    put("d")
    run()
    texts = lambda: sorted(r["text"][-1] for r in spark.read.parquet(out).collect())
    assert texts() == ["a", "b", "c", "d"]
    # a batch that runs again changes nothing
    streams.store_batch(spark.createDataFrame([(f"{LONG} b",), (f"{LONG} c",)], "text string"), 1, out)
    assert texts() == ["a", "b", "c", "d"]
    spark.streams.removeListener(seen)
    assert ("started", 0) in seen.seen


def _streamed(spark, tmp_path, df, f, name):
    df.coalesce(1).write.parquet(str(tmp_path / name))
    stream = f(spark.readStream.schema(df.schema).parquet(str(tmp_path / name)))
    q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"c-{name}")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_recent_turns_are_bounded(spark, tmp_path):
    turns = spark.createDataFrame([(1, k, "user", f"t{k}") for k in range(5)], "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r["history"] for r in _streamed(spark, tmp_path, turns, lambda s: streams.recent(s, 2), "recent")}
    assert got == {0: [], 1: ["user: t0"], 2: ["user: t0", "user: t1"], 3: ["user: t1", "user: t2"], 4: ["user: t2", "user: t3"]}


def test_sessions_and_answers(spark, tmp_path):
    at = lambda m: f"timestamp'2024-01-01 {m // 60:02d}:{m % 60:02d}:00'"
    events = spark.sql(" UNION ALL ".join(f"SELECT {at(m)} AS ts, 1L AS user_id, 1.0D AS value" for m in (0, 10, 100, 600)))
    got = sorted((r["start"].hour * 60 + r["start"].minute, r["n"]) for r in _streamed(spark, tmp_path, events, streams.sessions, "sessions"))
    assert got == [(0, 2), (100, 1)]
    asked = spark.sql(f"SELECT 1L AS id, {at(0)} AS ts UNION ALL SELECT 2L, {at(5)}")
    replies = spark.sql(f"SELECT 1L AS request_id, {at(30)} AS reply_ts UNION ALL SELECT 2L, {at(90)}")
    replies.coalesce(1).write.parquet(str(tmp_path / "r"))
    late = lambda s: streams.answered(s, spark.readStream.schema(replies.schema).parquet(str(tmp_path / "r"))).select("id")
    assert [r["id"] for r in _streamed(spark, tmp_path, asked, late, "answers")] == [1]


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_reply_rules(spark):
    # the first mark in list order cuts, not the first in the text
    assert one(spark, "a <|user|> b User: c", R.post_process) == "a b."
    assert one(spark, "x ASSISTANT: y", R.post_process) == "x."
    assert one(spark, None, R.post_process) == ""
    assert one(spark, "q Assistant: Bot: It stands here. More.", R.chat_reply) == "It stands here."
    assert one(spark, "...", R.chat_reply) == "I'm processing that thought." and one(spark, "", R.chat_reply) == "I'm thinking about that..."
    assert one(spark, "MEMORY: the old house", R.memory_query) == "the old house" and one(spark, "plain", R.memory_query) == "plain"
    assert one(spark, "[2024] (user) some text", lambda c: R.memory_text(c, 4)) == "some"
    assert one(spark, "Big-Model-7b", lambda c: R.model_setting(c, {"model": "m", "big-model": "b"}, "d")) == "b"
    assert one(spark, r"caf \u12 x", T.unescape) == "caf x" and one(spark, r"\u0041b", T.unescape) == "Ab" and one(spark, "end\\", T.unescape) == "end\\"
    assert one(spark, None, T.unescape) is None


def test_best_candidate_needs_coherence(spark):
    rows = [(1, "where is the old house", 0, "m1", "the old house is where the river bends"), (1, "where is the old house", 1, "m2", "quite another matter altogether, in short"), (2, "what now", 0, "m1", "short")]
    got = {r["id"]: (r["method"], r["reply"]) for r in R.best_candidate(spark.createDataFrame(rows, "id int, asked string, place int, method string, reply string"), ["id"]).collect()}
    assert got[1] == ("m1", rows[0][4]) and got[2][0] == "fallback"


def test_lru_against_a_dictionary(spark):
    keys = [(s, k, (k * k + s) % 5) for s in range(3) for k in range(60)]
    df = spark.createDataFrame(keys, "s long, k long, x long")
    for size in (1, 2, 4):
        held, want = {}, {}
        for s, k, x in keys:
            own = held.setdefault(s, [])
            want[s, k] = x in own
            own[:] = [y for y in own if y != x][-size + 1 :] if size > 1 else []
            own.append(x)
        assert {(r["s"], r["k"]): r["hit"] for r in M.lru_hits(df, "s", "x", "k", size).collect()} == want


def test_stratified_splits(spark):
    df = spark.createDataFrame([(i, i / 50) for i in range(45)], "pair_id long, quality_score double")
    got = C.splits(df, ["pair_id"], stratified=True).groupBy("quartile", "split").agg(F.count("*").alias("n")).collect()
    n = {(r["quartile"], r["split"]): r["n"] for r in got}
    assert [n[q, "train"] for q in range(4)] == [8, 8, 8, 9] and sum(n.values()) == 45


def test_dedup_in_many_blocks_agrees(spark):
    df = spark.createDataFrame([(k, [float(k % 7), 1.0 + k % 3, float(k % 5)]) for k in range(1, 200)], "vec_id long, embedding array<double>")
    whole = sorted(r[0] for r in S.semantic_dedup(df, 0.999).collect())
    assert whole == sorted(r[0] for r in S.semantic_dedup(df, 0.999, block_rows=30).collect())
    queries = df.where("vec_id % 10 = 0")
    a = S.knn(df, queries, 4)
    assert a.count() == 4 * queries.count() and {r["rank"] for r in a.collect()} == {1, 2, 3, 4}
