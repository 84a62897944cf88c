"""Text expressions. Each is a Column of built-in functions, so it stays inside code generation."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.config import CURATE, INGEST

#: The ordered cleaning rules, pattern and replacement.
CLEANING = (
    (r"[ \t]+", " "),
    (r"\n{3,}", "\n\n"),
    (r"[\x{200B}-\x{200D}\x{FEFF}]", ""),
    (r"([\p{L}\p{N}_])-\s+([\p{L}\p{N}_])", "$1$2"),
    (r"\s*\n\s*", " "),
    (r'(?<=[\p{L}\p{N}_])"([\p{L}\p{N}_]+)"(?=[\p{L}\p{N}_])', "$1"),
    (r'"([^"]+[.,!?])"', "$1"),
    (r'"([A-Z][^"]*?)"(?=\s|$)', "$1"),
    (r"\\+([\"'])", "$1"),
    (r'\*+"', '"'),
    (r'"\*+', '"'),
    (r'\*\s*"', ' *"'),
    (r'"\s*\*', '"* '),
    (r"""([!?.,]){2,}["']""", '$1"'),
    (r" {2,}", " "),
)
#: Patterns of texts that hold nothing, for the curation check.
EMPTY_SHAPES = (r"^[\s\-_=]{10,}$", r"^\d+\s*$", r"^[^\w\s]{5,}$")


def once(value: Column, f) -> Column:
    """f(value), with value made once however often f reads it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip(text: Column) -> Column:
    """Without white space at either end, as \\s has it."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def words(text: Column) -> Column:
    """Runs of characters that aren't white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text))


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def clean(text: Column) -> Column:
    for pattern, by in CLEANING:
        text = F.regexp_replace(text, pattern, by)
    return strip(text)


def ingest_text(text: Column, c=INGEST) -> Column:
    """The stripped text, cut to the longest that is embedded."""
    return F.substring(strip(F.coalesce(text, F.lit(""))), 1, c.max_chars)


def ingest_valid(text: Column, c=INGEST) -> Column:
    """Enough characters and words, mostly letters; judged on what ingest_text gives."""
    t = ingest_text(text, c)
    return (F.length(strip(F.coalesce(text, F.lit("")))) >= c.min_chars) & (n_words(t) >= c.min_words) & (letters(t) / F.length(t) >= 1 - c.max_non_alpha)


def curate_reason(text: Column, c=CURATE) -> Column:
    """The first check that a raw text fails, else valid."""
    t = strip(F.coalesce(text, F.lit("")))
    shape = F.lit(False)
    for pattern in EMPTY_SHAPES:
        shape = shape | t.rlike(pattern)
    return (
        F.when(t == "", "blank")
        .when(F.length(t) < c.min_chars, "short")
        .when(F.length(t) > c.max_chars, "long")
        .when(n_words(t) < c.min_words, "few_words")
        .when((F.length(t) - letters(t)) / F.length(t) > c.max_punctuation, "punctuation")
        .when(shape, "shape")
        .otherwise("valid")
    )


def readability(text: Column) -> Column:
    per = n_words(text) / F.greatest(F.size(F.split(text, r"[.!?]+")), F.lit(1))
    return F.least(F.lit(1.0), 20.0 / F.greatest(per, F.lit(1.0)))


def density(text: Column) -> Column:
    w = words(F.lower(text))
    return F.size(F.array_distinct(w)) / F.greatest(F.size(w), F.lit(1))


def cache_key(text: Column) -> Column:
    return F.regexp_replace(strip(F.lower(text)), r"\s+", " ")


def speakable(text: Column) -> Column:
    """For a speech engine: letters, digits and plain punctuation, single spaces."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}_\s.,!?;:\-]", ""), r"\s+", " "))


def without_fillers(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text, r"(?iU)\b(um|uh|er|ah)\b", ""), r"\s+", " "))


def word_cosine(a: Column, b: Column) -> Column:
    """Cosine of the two texts' sets of lower-case words: a stand-in for a sentence encoder's similarity. 0 without words."""
    wa, wb = (F.array_distinct(words(F.lower(F.coalesce(x, F.lit(""))))) for x in (a, b))
    n = F.size(wa) * F.size(wb)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(wa, wb)) / F.sqrt(n.cast("double")))


def speech_clip(text: Column, skip: int, cut: int | None = None) -> Column:
    """speakable text, null if longer than skip; cut to so many characters first where a cut is named."""
    spoken = speakable(text)
    spoken = spoken if cut is None else F.substring(spoken, 1, cut)
    return F.when(F.length(text) <= skip, spoken)


def token_ids(text: Column, longest: int = 512, vocabulary: int = 50_000) -> Column:
    """array<int>: a stand-in tokenizer, of words and single marks by hash, cut to the longest."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"), F.lit(1))
    number = lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int"), F.lit(vocabulary))
    return F.transform(F.slice(found, F.lit(1), F.lit(longest)), number)


def entities(text: Column, least: int = 3) -> Column:
    """array<struct<text, label>>: a stand-in recogniser, of capitalised runs (NAME) and numbers (NUMBER) of so many characters."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\p{Lu}[\p{L}]*(?: \p{Lu}[\p{L}]*)*|\p{N}+)"), F.lit(1))
    kind = lambda x: F.when(x.rlike(r"^\p{N}"), "NUMBER").otherwise("NAME")
    return F.transform(F.filter(found, lambda x: F.length(x) >= least), lambda x: F.struct(x.alias("text"), kind(x).alias("label")))


_CUT_ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{0,3}(?![0-9A-Fa-f]).", re.DOTALL)


def _unescaped(text: str | None) -> str | None:
    for tried in (text, _CUT_ESCAPE.sub("", text or "")):
        try:
            return None if text is None else tried.encode().decode("unicode_escape")
        except UnicodeDecodeError:
            continue
    return text


def unescape(text: Column) -> Column:
    """Backslash escapes decoded; escapes that are cut short are taken out first where that helps, else the text stays."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_unescaped)

    return run(text)
