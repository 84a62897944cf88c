"""Chunking, deduplication, domains, turn pairing, pair quality, splits and their statistics."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.config import CURATE, INGEST
from lexmill.functions import text as T
from lexmill.operators.domain_table import GENERAL, KEYWORDS, TEMPLATES

#: The small table that the SQL of a5 and a3 names; domain_table.KEYWORDS is the default.
DOMAINS = {
    "medicine": ("patient", "doctor", "disease", "therapy", "clinic"),
    "law": ("license", "licensed", "court", "contract", "statute"),
    "software": ("code", "server", "database", "software", "version"),
    "science": ("theory", "energy", "experiment", "species", "cell"),
    "history": ("king", "war", "empire", "century", "ancient"),
}


def chunks(df: DataFrame, text: str = "text", key: str = "doc_id", c=INGEST) -> DataFrame:
    """Sliding windows of words: key, chunk_id, total_chunks, chunk. A short text is one chunk, as it stands."""
    stride = max(1, c.chunk_size - c.overlap)
    own = df.select(key, F.col(text).alias("whole"), T.words(F.coalesce(F.col(text), F.lit(""))).alias("w"))
    own = own.withColumn("n", F.size("w"))
    starts = F.when(F.col("n") <= c.chunk_size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("n") - 1, F.lit(stride)))
    cut = F.when(F.col("n") <= c.chunk_size, F.array(F.coalesce("whole", F.lit("")))).otherwise(F.transform(starts, lambda s: F.array_join(F.slice(F.col("w"), s + 1, c.chunk_size), " ")))
    kept = own.select(key, F.filter(cut, lambda x: F.length(T.strip(x)) >= c.min_chars).alias("kept"))
    # the outer form infers no filter, which would be pushed below and chunk each text again
    out = kept.select(key, F.size("kept").alias("total_chunks"), F.posexplode_outer("kept").alias("chunk_id", "chunk"))
    return out.where("chunk_id IS NOT NULL").select(key, "chunk_id", "total_chunks", "chunk")


def first_by_hash(df: DataFrame, text: str, order: str) -> DataFrame:
    """Exact dedup: of equal texts the first in order stays. min_by aggregates before the shuffle, and carries no text."""
    first = df.groupBy(F.md5(text).alias("md5")).agg(F.min(order).alias(order), F.count("*").alias("copies"))
    return first.select(order, "md5", "copies")


def _domain_judge(domains: dict[str, tuple[str, ...]]):
    """An Arrow-batched function of lower-cased text and file name: label and score of the best domain. One pass over a text
    finds the keywords of all domains; built-in functions would need a pass for each of them."""
    labels, owners = list(domains), {}
    for d, keys in enumerate(domains.values()):
        for k in filter(None, keys):
            owners.setdefault(k, []).append(d)

    @F.pandas_udf("label string, score int")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        find = ahocorasick.Automaton()
        for k, own in owners.items():
            find.add_word(k, (k, len(k), own))
        find.make_automaton()

        def best(text: str, name: str) -> tuple[str, int]:
            scores = [0] * len(labels)
            for said, weight in ((text, 1), (name, 2)):
                last: dict[str, int] = {}
                for end, (k, n, own) in find.iter(said) if owners else ():
                    if end - n >= last.get(k, -1):  # occurrences of one keyword don't overlap
                        last[k] = end
                        for d in own:
                            scores[d] += weight
            top = max(scores, default=0)
            return (labels[scores.index(top)], top) if top else ("general", 0)

        for texts, names in batches:
            yield pd.DataFrame([best(x, y) for x, y in zip(texts, names, strict=True)], columns=["label", "score"])

    return judge


def domain_scores(df: DataFrame, text: str = "text", filename: Column | None = None, domains=None) -> DataFrame:
    """df with domain and domain_score: keyword occurrences, those in the file name twice; the first domain wins ties."""
    low = lambda x: F.lower(F.coalesce(x, F.lit("")))
    judge = _domain_judge(domains or KEYWORDS)
    best = df.withColumn("domain_best", judge(low(F.col(text)), F.lit("") if filename is None else low(filename)))
    return best.withColumns({"domain": F.col("domain_best.label"), "domain_score": F.col("domain_best.score")}).drop("domain_best")


def pair_turns(df: DataFrame, conv: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """An assistant's turn with the user's turn that stands directly before it; blank turns don't count."""
    w = Window.partitionBy(conv).orderBy(order)
    said = df.where(T.strip(F.coalesce(F.col(text), F.lit(""))) != "")
    said = said.withColumns({"user": F.lag(text).over(w), "before": F.lag(role).over(w)})
    pairs = said.where(F.col(role).isin("assistant", "ai") & F.col("before").isin("user", "human"))
    return pairs.select(F.col(conv).alias("conv_id"), F.col(order).alias("turn"), "user", F.col(text).alias("assistant"))


def with_context(pairs: DataFrame, entries: int = CURATE.context_entries) -> DataFrame:
    """pairs with context: the last entries of what the conversation's earlier pairs said, oldest first."""
    depth = (entries + 1) // 2
    w = Window.partitionBy("conv_id").orderBy("turn")
    said = []
    for k in range(depth, 0, -1):
        said += [F.concat(F.lit("User: "), F.lag("user", k).over(w)), F.concat(F.lit("Assistant: "), F.lag("assistant", k).over(w))]
    return pairs.withColumn("context", F.concat_ws(" ", *said[len(said) - entries :]))


def pair_quality(pairs: DataFrame, similarity: Column | None = None, c=CURATE) -> DataFrame:
    """pairs with their metrics and quality_score; similarity is the cosine of word sets unless another is given."""
    sim = T.word_cosine(F.col("user"), F.col("assistant")) if similarity is None else similarity
    out = pairs.withColumns({"user_len": F.length("user"), "assistant_len": F.length("assistant"), "user_words": T.n_words(F.col("user")), "assistant_words": T.n_words(F.col("assistant")), "semantic_similarity": sim})
    ratio = F.when(F.col("user_len") > 0, F.col("assistant_len") / F.col("user_len")).otherwise(0.0)
    out = out.withColumns({"length_ratio": ratio, "readability_score": T.readability(F.col("assistant")), "information_density": T.density(F.col("assistant"))})
    score = F.when(F.col("length_ratio").between(*c.length_ratio), 1.0).otherwise(0.5) * F.when(F.col("semantic_similarity").between(*c.similarity), 1.0).otherwise(0.7)
    return out.withColumn("quality_score", score * (0.7 + 0.3 * F.col("readability_score")) * (0.8 + 0.2 * F.col("information_density")))


def ranked(df: DataFrame, order: list[Column], to: str) -> DataFrame:
    """Global row numbers without a single task: a range sort, then per-partition counts and offsets.

    The counts are a row for each partition, so their window is small whatever the table's size.
    """
    from lexmill.sources.store import written

    part = df.repartitionByRange(*order).withColumn(f"{to}_part", F.spark_partition_id())
    own = Window.partitionBy(f"{to}_part").orderBy(*order)
    part = written(part.withColumn(f"{to}_own", F.row_number().over(own)), "ranked")
    counts = part.groupBy(f"{to}_part").agg(F.count("*").alias("n"))
    before = Window.orderBy(f"{to}_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(f"{to}_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(f"{to}_before"))
    return part.join(F.broadcast(counts), f"{to}_part").withColumn(to, F.col(f"{to}_own") + F.col(f"{to}_before")).drop(f"{to}_part", f"{to}_own", f"{to}_before")


def splits(pairs: DataFrame, key: list[str], score: str = "quality_score", c=CURATE, stratified: bool = False) -> DataFrame:
    """pairs with quartile and split: by quality downwards into quartiles (the rest to the last), in a keyed hash
    order within each, then cut into training, validation and test. The cut runs over all quartiles, so training gets the
    best; stratified cuts each quartile by itself."""
    from lexmill.sources.store import written

    pairs = written(pairs, "pairs")  # read four times from here on
    total = pairs.count()
    out = ranked(pairs, [F.col(score).desc(), *map(F.col, key)], "quality_rank")
    quarter = max(total // 4, 1)
    quartile = F.least(F.floor((F.col("quality_rank") - 1) / quarter), F.lit(3)).cast("int") if total >= 4 else F.lit(3)
    out = out.withColumn("quartile", quartile)
    mixed = F.md5(F.concat_ws("|", F.lit(c.seed), *(F.col(k).cast("string") for k in key)))
    out = ranked(out.withColumn("shuffle_key", mixed), [F.col("quartile"), F.col("shuffle_key")], "position").drop("shuffle_key", "quality_rank")
    if stratified:
        # a quartile's size and start follow from the total
        start, size = (F.col("quartile") * quarter, F.when(F.col("quartile") < 3, quarter).otherwise(total - 3 * quarter)) if total >= 4 else (F.lit(0), F.lit(total))
        own, a, b = F.col("position") - start, F.floor(size * c.shares[0]), F.floor(size * c.shares[1])
        return out.withColumn("split", F.when(own <= a, "train").when(own <= a + b, "validation").otherwise("test"))
    a, b = int(total * c.shares[0]), int(total * c.shares[1])
    return out.withColumn("split", F.when(F.col("position") <= a, "train").when(F.col("position") <= a + b, "validation").otherwise("test"))


def split_stats(df: DataFrame, score: str = "quality_score") -> DataFrame:
    """Count, mean, population deviation, least and greatest of each split and of all."""
    return df.rollup("split").agg(F.count("*").alias("n"), F.avg(score).alias("mean_quality"), F.stddev_pop(score).alias("std_quality"), F.min(score).alias("min_quality"), F.max(score).alias("max_quality")).withColumn("split", F.coalesce("split", F.lit("all")))


def questions(chunks_df: DataFrame, key: list[str], label: Column, seed: str = CURATE.seed) -> DataFrame:
    """Question and answer pairs of tagged chunks: templates of the domain and general ones, the first in a keyed hash order."""
    arms = F.array(*map(F.lit, GENERAL))
    for d, own in TEMPLATES.items():
        arms = F.when(F.col("domain") == d, F.array_union(F.array(*map(F.lit, own)), F.array(*map(F.lit, GENERAL)))).otherwise(arms)
    pool = chunks_df.withColumns({"pool": arms, "label": label})
    take = F.least(F.lit(5), F.greatest(F.lit(3), F.floor(F.size("pool") / 3))).cast("int")
    order = F.array_sort(F.transform("pool", lambda t: F.struct(F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in key), t)).alias("h"), t.alias("t"))))
    asked = pool.withColumn("template", F.explode(F.transform(F.slice(order, F.lit(1), take), lambda x: x["t"])))
    return asked.withColumn("question", F.replace("template", F.lit("{label}"), F.col("label"))).drop("pool", "template")


def source_label(filename: Column, page: Column | None = None, chapter: Column | None = None) -> Column:
    """Where a question's text is from: the file, then page and chapter where they are known."""
    out = F.coalesce(F.concat(F.lit("From '"), F.replace(F.replace(filename, F.lit(".pdf"), F.lit("")), F.lit("_"), F.lit(" ")), F.lit("': ")), F.lit(""))
    for x, form in ((page, "(Page %s) "), (chapter, "[Chapter: %s] ")):
        if x is not None:
            out = F.concat(out, F.when(x.isNotNull(), F.format_string(form, x.cast("string"))).otherwise(""))
    return out


def with_context_prefix(user: Column, context: Column) -> Column:
    return F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit("Context: "), context, F.lit("\n\nUser: "), user)).otherwise(user)


def drop_emptied(df: DataFrame, text: str = "text", to: str = "cleaned") -> DataFrame:
    """df with the cleaned text, without the rows that cleaning leaves nothing of."""
    return df.withColumn(to, T.clean(F.col(text))).where(F.col(to) != "")


def by_file(chunks_df: DataFrame, filename: str = "filename", unknown: str = "unknown_pdf_source", most: int | None = None, key: str = "doc_id", seed: str = CURATE.seed) -> DataFrame:
    """Chunks with source_file; with most, so many of each file in a keyed hash order (a sample, as the feature has it)."""
    own = chunks_df.withColumn("source_file", F.coalesce(F.col(filename), F.lit(unknown)))
    if most is None:
        return own
    w = Window.partitionBy("source_file").orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"))), key)
    return own.withColumn("file_rank", F.row_number().over(w)).where(F.col("file_rank") <= most).drop("file_rank")


def question_pairs(chunks_df: DataFrame, key: list[str], label: Column, text: str = "text") -> DataFrame:
    """Question and text of each chunk as pairs of enough quality: key, source_file, domain, user, assistant, quality_score."""
    asked = questions(chunks_df.where(F.coalesce(F.col(text), F.lit("")) != ""), key, label)
    asked = asked.select(*key, "source_file", "domain", F.col("question").alias("user"), F.col(text).alias("assistant"))
    return pair_quality(asked).where(F.col("quality_score") >= CURATE.min_quality).select(*key, "source_file", "domain", "user", "assistant", "quality_score")


def frequencies(pairs: DataFrame, source: str = "source_file", domain: str = "domain") -> DataFrame:
    """kind ('source' or 'domain'), name, n: in one pass, with the defaults for pairs of conversations."""
    own = pairs.select(F.explode(F.array(F.struct(F.lit("source").alias("kind"), F.coalesce(F.col(source), F.lit("conversation")).alias("name")), F.struct(F.lit("domain").alias("kind"), F.coalesce(F.col(domain), F.lit("general")).alias("name")))).alias("x"))
    return own.groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))


def training_text(user: Column, assistant: Column) -> Column:
    return F.concat(F.lit("<|user|>"), user, F.lit("<|assistant|>"), assistant, F.lit("<|endoftext|>"))
