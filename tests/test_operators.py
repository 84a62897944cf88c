from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions import vector as V
from lexmill.operators import curation as C
from lexmill.operators import responses as R
from lexmill.sources import chat, store
from lexmill.streaming import streams


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


def test_clean_text_rules(spark):
    assert one(spark, 'a\u200bb  c\n\n\nd', T.clean) == "ab c d"
    assert one(spark, "exam- ple", T.clean) == "example"
    assert one(spark, 'He said "stop." now', T.clean) == "He said stop. now"
    assert one(spark, 'what?!" x', T.clean) == 'what!" x'
    assert one(spark, None, T.clean) is None


def test_reasons(spark):
    for text, reason in ((None, "blank"), ("  ", "blank"), ("a b c", "short"), ("one longword", "few_words"), ("---------- - -", "punctuation"), ("x " * 1001, "long"), ("plain words stand here", "valid")):
        assert one(spark, text, T.curate_reason) == reason
    for text, reason in (("short", "too_short"), ("Well, what do you think of it?", "deflection"), ("I mean that it means that nothing", "circular"), ("one two one four five six", "repetitive"), ("This answer stands on its own.", "valid")):
        assert one(spark, text, R.reject_reason) == reason


def test_chunk_borders(spark):
    words = [" ".join(f"word{i}" for i in range(n)) for n in (0, 1, 400, 401, 750, 751)]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    counts = {r["doc_id"]: r["n"] for r in C.chunks(df).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {2: 1, 3: 2, 4: 3, 5: 3}


def test_pairing_state_machine(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d"), (2, 0, "user", "a"), (2, 1, "system", "s"), (2, 2, "assistant", "x"), (3, 0, "user", "q"), (3, 1, "user", " "), (3, 2, "assistant", "r")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["user"], r["assistant"]) for r in C.pair_turns(df).collect()}
    assert got == {(1, "b", "c"), (3, "q", "r")}


def test_split_sizes(spark):
    for n in (0, 1, 3, 4, 10, 11):
        df = spark.createDataFrame([(i, i / 20) for i in range(n)], "pair_id long, quality_score double")
        got = {r["split"]: r["n"] for r in C.splits(df, ["pair_id"]).groupBy("split").agg(F.count("*").alias("n")).collect()}
        assert sum(got.values()) == n and got.get("train", 0) == int(n * 0.8) and got.get("validation", 0) == int(n * 0.1)


def test_chat_shapes(spark):
    message = '{"role": "Human", "content": {"parts": ["hi there"]}}'
    shapes = {"list": f'[{{"messages": [{message}]}}]', "wrapped": f'{{"conversations": [{{"messages": [{message}]}}]}}', "mapping": f'{{"mapping": {{"k": {{"message": {message}}}}}}}', "messages": f'{{"messages": [{message}]}}', "values": f'{{"a": {{"messages": [{message}]}}}}', "lists": f'{{"a": [{message}]}}', "single": message, "flat": f"[{message}]", "bad": "{"}
    files = spark.createDataFrame(list(shapes.items()), "file string, value string")
    got = {r["file"]: (r["author"], r["text"]) for r in chat.messages(chat.conversations(files)).collect()}
    assert got == {k: ("user", "hi there") for k in shapes if k != "bad"}


def test_checkpoints_and_sinks(spark, tmp_path):
    paths = spark.createDataFrame([("out/checkpoint-9",), ("out/checkpoint-100",), ("out/last",)], "path string")
    assert store.latest_checkpoint(paths).first()["latest"] == "out/checkpoint-100"
    df = spark.createDataFrame([("train", "ü", "a")], "split string, user string, assistant string")
    store.write_training(df, str(tmp_path / "t"))
    assert store.read_training(spark, str(tmp_path / "t")).first()["text"] == "<|user|>ü<|assistant|>a<|endoftext|>"


def test_zero_vectors(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    assert df.select(V.cosine(F.col("a"), F.col("b")).alias("c"), V.unit(F.col("b")).alias("u")).first() == (0.0, [1.0, 0.0])


def test_streams_agree_with_batch(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    src.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    for name, streamed, batch in (("pairs", streams.pairs(stream), C.pair_turns(src)), ("fresh", streams.fresh(stream).select("md5"), streams.fresh(src).select("md5"))):
        q = streamed.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"c-{name}")).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, batch.collect()))


def test_default_domains_are_the_whole_table(spark):
    from lexmill.operators import curation
    from lexmill.operators.domain_table import GENERAL, KEYWORDS, TEMPLATES
    from lexmill.plans import catalog

    sizes = {"neuroscience": 28, "physics": 28, "mathematics": 26, "computer_science": 24, "philosophy": 28, "biography": 28, "law": 28, "economics": 26, "literature": 25, "psychology": 20, "history": 23, "science_general": 22, "astronomy": 21, "biology": 22, "chemistry": 20}
    assert {d: len(v) for d, v in KEYWORDS.items()} == sizes and list(TEMPLATES) == list(sizes)
    assert len(GENERAL) == 10 and all(len(set(v)) == 8 for v in TEMPLATES.values())
    texts = ["The synapse and the axon", "photon, photon and galaxy", "a tort; a tort", "nothing", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: (r["domain"], r["domain_score"]) for r in curation.domain_scores(docs).collect()}
    assert got == {0: ("neuroscience", 2), 1: ("physics", 2), 2: ("law", 2), 3: ("general", 0), 4: ("general", 0)}
    SF = "/root/testdata/sf0.001"
    scores = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        found = {d: sum((r["text"] or "").lower().count(k) for k in v) for d, v in KEYWORDS.items()}
        best = max(found, key=found.get)
        scores[r["doc_id"]] = best if found[best] else "general"
    asked = catalog.QUERIES["j7_document_questions"](spark, SF).collect()
    assert {r["doc_id"]: r["domain"] for r in asked} == scores
    for d, domain in scores.items():
        own = [r["question"] for r in asked if r["doc_id"] == d]
        assert len(set(own)) == len(own) == (3 if domain == "general" else 5)


def test_domains_count_as_texts_do(spark):
    domains = {"x": ("aa", "b c", "aa"), "y": ("aba", "é"), "z": ("b c", "")}
    rows = [(0, "AAAAA", None), (1, "ababa É", ""), (2, "b c b c", "é é"), (3, None, None), (4, "", "b c"), (5, "long aba " * 20_000, "x"), (5, "long aba " * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, file string").withColumn("domain_low", F.lit("stays"))
    got = C.domain_scores(docs, filename=F.col("file"), domains=domains)
    assert got.columns == [*docs.columns, "domain", "domain_score"]

    def plain(text, name):
        scores = {d: sum((text or "").lower().count(k) + 2 * (name or "").lower().count(k) for k in keys if k) for d, keys in domains.items()}
        best = max(scores, key=scores.get)
        return (best, scores[best]) if scores[best] else ("general", 0)

    assert sorted((r["doc_id"], r["domain"], r["domain_score"]) for r in got.collect()) == sorted((d, *plain(x, n)) for d, x, n in rows)
    assert C.domain_scores(docs.limit(0), domains=domains).count() == 0


def test_chat_reply_takes_speakers_in_order(spark):
    said = {"User: Human: a long enough reply. More": "a long enough reply.", "Human: User: a long reply": "User: a long reply.", "Bot:  Assistant: so it is then": "so it is then.", "": "I'm thinking about that...", None: "I'm thinking about that...", "User:": "I'm thinking about that...", "Ok.": "I'm processing that thought.", "see\nUser: at the end.": "see\nUser: at the end."}
    df = spark.createDataFrame([(k, v) for k, v in said.items()], "said string, want string")
    got = df.select("said", "want", R.chat_reply(F.col("said")).alias("got")).collect()
    assert [(r["said"], r["got"]) for r in got if r["got"] != r["want"]] == []


def test_list_content_takes_the_first_item_with_text(spark):
    lists = ['[{"type": "image"}, {"type": "text", "text": "see this"}]', '["plain", {"text": "later"}]']
    rows = [(k, f'[{{"messages": [{{"role": "user", "content": {x}}}]}}]') for k, x in enumerate(lists)]
    got = chat.messages(chat.conversations(spark.createDataFrame(rows, "file int, value string"))).collect()
    assert sorted((r["file"], r["text"]) for r in got) == [(0, "see this"), (1, "plain")]
