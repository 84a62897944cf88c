"""Rules for model responses: reasons to reject, cleaning, trimming, prompts, and request classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T

# The reject patterns by reason, in order; the third group is matched on the original case.
DEFLECTION = (
    r"what do you (do|think|feel)",
    r"how (do|does) you",
    r"that's (what|how|why) you",
    r"you (should|need to|have to)",
    r"what about you",
    r"how about you",
    r"what's your (thought|opinion|view)",
)
CIRCULAR = (
    r"that's (the|what|why|how) (beauty|part|thing|point)",
    r"it'?s (not|just) (like|that|what)",
    r"that'?s (not|just) (something|what|how)",
    r"you'?re (right|thinking|asking)[\w\s]{0,20}but",
    r"it (just )?means that",
    r"that'?s (why|what|how) (it'?s|you|we)",
)
INCOMPLETE = (r":\s*it'?s not", r"—.*?(it'?s|that'?s|you)", r"\.\s*that'?s")
#: Sentences that hold one of these are passed over.
SKIPPED = (r"that'?s (the|what|why)", r"it (just )?means", r"you'?re (right|thinking)", r"what (do|does) you")
#: What cleaning takes from a response, in order.
ARTEFACTS = ((r"<\|[^|]*\|>", ""), (r"</?[^>]+>", ""), (r"\*+", ""), (r"#+\s*", ""), (r"(?m)^\s*[-*+•]\s+", ""), (r"[\p{C}&&[^\s]]", ""), (r"\s+([.,!?;:])", "$1"), (r"\s{2,}", " "))
MIN_RESPONSE, MIN_SENTENCE, LONG_SENTENCE = 15, 8, 50
FALLBACKS = {"greeting": ("Hello. What would you like to know?", "Hi there."), "question": ("I am not sure about that.", "I don't have an answer to that."), "statement": ("I see.", "Tell me more.")}


def _any(text: Column, patterns) -> Column:
    return text.rlike("|".join(f"(?:{p})" for p in patterns))


def repetitive(text: Column) -> Column:
    """Some word equals the one after the next."""
    w = T.words(F.lower(text))
    # beside the words from the third on: a lambda that read w itself would split the text for each word
    return F.exists(F.zip_with(w, F.slice(w, F.lit(3), F.size(w)), lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x)


def reject_reason(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    low = F.lower(t)
    return (
        F.when(F.length(T.strip(t)) < MIN_RESPONSE, "too_short")
        .when(_any(low, DEFLECTION), "deflection")
        .when(_any(low, CIRCULAR), "circular")
        .when(_any(t, INCOMPLETE), "incomplete")
        .when(repetitive(t), "repetitive")
        .otherwise("valid")
    )


def _ended(text: Column) -> Column:
    return F.when(text == "", text).when(text.rlike(r"[.!?]$"), text).otherwise(F.concat(text, F.lit(".")))


def clean_response(text: Column) -> Column:
    """Artefacts out; then the first good sentence if long, else the first two."""
    t = F.coalesce(text, F.lit(""))
    for pattern, by in ARTEFACTS:
        t = F.regexp_replace(t, pattern, by)
    sentences = F.transform(F.split(T.strip(t), r"[.!?]+"), T.strip)
    good = F.filter(sentences, lambda s: (F.length(s) >= MIN_SENTENCE) & ~_any(F.lower(s), SKIPPED))
    first, second = F.get(good, F.lit(0)), F.get(good, F.lit(1))
    out = F.when(F.length(first) > LONG_SENTENCE, first).when(second.isNotNull(), F.concat(first, F.lit(". "), second)).otherwise(first)
    return _ended(F.coalesce(out, F.lit("")))


def first_sentence(text: Column, least: int = 10) -> Column:
    """The first sentence if it is longer than least, else the text."""
    head = F.split_part(text, F.lit(". "), F.lit(1))
    return _ended(F.when(F.length(head) > least, head).otherwise(text))


def first_chars(text: Column, n: int = 80) -> Column:
    return _ended(T.strip(F.substring(text, 1, n)))


def after_last(text: Column, mark: str = "Assistant:") -> Column:
    return T.strip(F.element_at(F.split(text, mark), -1))


def generation_style(text: Column) -> Column:
    return F.when(F.lower(text).rlike(r"why|how|what|explain|\?"), "creative").when(T.n_words(text) < 5, "focused").otherwise("balanced")


def fallback_kind(text: Column) -> Column:
    return F.when(F.lower(text).rlike("hello|hi|hey|greetings"), "greeting").when(T.strip(text).endswith("?"), "question").otherwise("statement")


def fallback(text: Column) -> Column:
    """A reply of the text's kind, chosen by the text's hash."""
    out = None
    for kind, replies in FALLBACKS.items():
        pick = F.get(F.array(*map(F.lit, replies)), F.pmod(F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("int"), F.lit(len(replies))))
        out = F.when(fallback_kind(text) == kind, pick) if out is None else out.when(fallback_kind(text) == kind, pick)
    return out


def prompts(text: Column, end: str = "<|endoftext|>") -> Column:
    """The three forms in which a request is put to a model: with tags, as a dialogue, and as it is with the end mark."""
    return F.array(F.concat(F.lit("<|user|>\n"), text, F.lit("\n<|assistant|>\n")), F.concat(F.lit("User: "), text, F.lit("\nAssistant:")), F.concat(text, F.lit(end)))


def requests(df: DataFrame, text: str = "text", configs: int = 3) -> DataFrame:
    """df with a row for each prompt form and generation setting: prompt, config (from 1), method."""
    each = df.withColumn("prompt", F.explode(prompts(F.col(text)))).withColumn("config", F.explode(F.sequence(F.lit(1), F.lit(configs))))
    return each.withColumn("method", F.concat(F.substring("prompt", 1, 6), F.lit("-"), F.col("config").cast("string")))


def best_candidate(candidates: DataFrame, by: list[str], asked: str = "asked", reply: str = "reply", method: str = "method", order: str = "place", least: float = 0.4) -> DataFrame:
    """by, reply, method, coherence: of each request's candidates that pass reject_reason the most coherent (the first of
    equals), if it is coherent enough; else a fallback reply, method 'fallback'."""
    # one struct, so that the coherence is made once a candidate; null, for those that fail, is the least
    coherence = F.when(reject_reason(F.col(reply)) == "valid", T.word_cosine(F.col(asked), F.col(reply)))
    top = F.max(F.struct(coherence.alias("coherence"), (-F.col(order)).alias("o"), F.col(reply).alias("reply"), F.col(method).alias("method")))
    best = candidates.groupBy(*by).agg(top.alias("top"), F.first(asked).alias("asked"))
    good = F.coalesce(F.col("top.coherence") >= least, F.lit(False))
    return best.select(*by, F.when(good, F.col("top.reply")).otherwise(fallback(F.col("asked"))).alias("reply"), F.when(good, F.col("top.method")).otherwise("fallback").alias("method"), F.when(good, F.col("top.coherence")).alias("coherence"))


# Marks of a turn, in the order in which they are tried; the first that occurs cuts the response.
TURN_MARKS = ("User:", "<|user|>", "Assistant:", "<|assistant|>", "--- User:", "--- Assistant:")
# Phrases that a memory chat's reply loses, in order.
CHAT_PHRASES = (
    "📠 *The answer is this:**",
    "- **I have memory.**",
    "*I can still remember conversations, but not conversations.**",
    "- I don't have memory of the conversation, but I do have memories of the conversation.**",
    "- ***I don't have memory of the conversation.***",
    "- ***I have memory of a conversation.***",
    "- And I don't have memory of the conversation.***",
    "- I can't remember either.***",
    "---",
    "Questions . User : Questions .",
    "User : Questions .",
    "User: Questions.",
    "User: Questions. User: Questions.",
)
# Speakers whose names are taken from a reply's start, in order, and the replies that stand in for none.
SPEAKERS = ("User:", "Human:", "Bot:", "Assistant:")
NO_REPLY, SHORT_REPLY = "I'm thinking about that...", "I'm processing that thought."


def post_process(text: Column) -> Column:
    """A response up to the first mark in list order that it holds, without tags and marks of emphasis, ended by a stop."""
    t = F.coalesce(text, F.lit(""))
    spots = [(F.regexp_instr(t, F.lit("(?i)" + m.replace("|", "[|]"))), m) for m in TURN_MARKS]
    cut = None
    for at, _ in spots:
        head = T.strip(F.substring(t, F.lit(1), at - 1))
        cut = F.when(at > 0, head) if cut is None else cut.when(at > 0, head)
    out = cut.otherwise(t)
    for pattern, by in ((r"<[^>]+>", ""), (r"\*+", ""), (r"#+\s*", ""), (r"\s+", " ")):
        out = F.regexp_replace(out, pattern, by)
    return _ended(T.strip(out))


def chat_reply(text: Column) -> Column:
    """A memory chat's reply: what follows the last speaker's mark, without stock phrases and speakers, its first sentence."""
    out = after_last(F.coalesce(text, F.lit("")))
    for phrase in CHAT_PHRASES:
        out = T.strip(F.replace(out, F.lit(phrase), F.lit("")))
    for speaker in SPEAKERS:
        # the text is stripped already; a condition on it would double the expression with each speaker
        out = T.strip(F.regexp_replace(out, f"^{speaker}", ""))
    first = lambda x, mark: F.get(F.filter(F.transform(F.split(x, mark), T.strip), lambda y: y != ""), F.lit(0))
    head = T.once(out, lambda x: F.coalesce(F.concat(first(x, r"\."), F.lit(".")), first(x, "\n"), F.lit("")))
    return T.once(head, lambda x: F.when(x == "", NO_REPLY).when(T.n_words(x) < 3, SHORT_REPLY).otherwise(x))


def memory_line(ts: Column, kind: Column, text: Column) -> Column:
    return F.concat(F.lit("["), F.substring(ts, 1, 19), F.lit("] ("), kind, F.lit(") "), text)


def memory_text(line: Column, n: int = 150) -> Column:
    """What a memory line says, without its prefix, cut to n characters."""
    at = F.instr(line, ") ")
    said = F.when((F.instr(line, "] (") > 0) & (at > 0), F.substring(line, at + 2, F.length(line))).otherwise(line)
    return F.substring(said, 1, n)


def prompt_with_context(asked: Column, memories: Column, turns: Column, top: int = 3) -> Column:
    """A prompt with the first memories (array<string> of lines) and the latest turns (array<struct<user, bot>>) before the question."""
    lines = F.transform(F.slice(memories, F.lit(1), F.lit(top)), lambda m, i: F.concat((i + 1).cast("string"), F.lit(". "), memory_text(m), F.lit("...")))
    late = F.slice(turns, F.greatest(F.size(turns) - top, F.lit(0)) + 1, F.lit(top))
    said = F.flatten(F.transform(late, lambda x: F.array(F.concat(F.lit("User: "), x["user"]), F.concat(F.lit("Assistant: "), x["bot"]))))
    none = F.array().cast("array<string>")
    parts = F.concat(F.when(F.size(lines) > 0, F.concat(F.array(F.lit("Relevant memories:")), lines)).otherwise(none), F.when(F.size(said) > 0, F.concat(F.array(F.lit("\nRecent conversation:")), said)).otherwise(none))
    plain = F.concat(F.lit("User: "), asked, F.lit("\nAssistant:"))
    return F.when(F.size(parts) == 0, plain).otherwise(F.concat(F.lit("Context:\n"), F.array_join(parts, "\n"), F.lit("\n\n"), plain))


def memory_query(text: Column) -> Column:
    """What a request asks of the memory: the text after 'memory:', in any case, else the text."""
    return T.strip(F.regexp_replace(text, r"(?is)^.*?memory:", ""))


def model_setting(model: Column, table: dict[str, str], default: str) -> Column:
    """The setting of a model type: by its whole name, else by the longest listed name that it holds, else the default."""
    name = F.lower(F.coalesce(model, F.lit("")))
    out = F.when(F.lit(False), F.lit(default))
    for k, v in table.items():
        out = out.when(name == k.lower(), v)
    for k in sorted(table, key=lambda k: (-len(k), k)):
        out = out.when(F.contains(name, F.lit(k.lower())), table[k])
    return out.otherwise(default)
