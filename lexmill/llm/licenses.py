"""License scans: Aho-Corasick over normalised words, and a shunting-yard parser for identifier expressions.

The score is the most that any finding restricts: a phrase or notice by its label, an identifier expression by its value
(or: the least of its sides, and: the most, with: relaxed).

Defined results: a null or empty text has no words, labels or places, and score 0; a phrase counts at every
place, overlaps too; very long texts are scanned whole, in time linear in their length; repeated rows get equal results; an
empty table gives an empty one; other columns pass through untouched, and a new column whose name is taken gets "_" put
behind it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import free, table

#: The contract's phrases.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Notice phrases of the method's own, as words.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
_TAG_LINE = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)")
#: How far a label restricts use: 0 none, 1 most. A label of no listed family counts as 0.5.
WEIGHTS = {"public-domain": 0.0, "cc0": 0.0, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "apache": 0.1, "cc-by": 0.2, "mpl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.6, "gpl": 0.8, "agpl": 0.9, "cc-by-nc": 0.9, "reserved": 1.0}
EXCEPTION = 0.75  # an exception relaxes its license by a quarter

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normalise(raw: bytes) -> list[bytes]:
    """Words [0-9a-z and beyond ASCII] of the text with A-Z lower-cased."""
    return raw.translate(_FOLD).split()


def automaton(phrases: dict) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for phrase, label in phrases.items():
        out.add_word(f" {phrase} ", (phrase, label))
    out.make_automaton()
    return out


_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def parse(expression: str) -> list[str]:
    """Reverse Polish of the longest leading run that is a whole license expression; [] if there is none."""
    out, ops, best, want = [], [], [], True
    for token in re.findall(r"[a-z0-9][a-z0-9.+:\-]*|[()]", expression):
        if want:
            if token == "(":
                ops.append(token)
                continue
            if token in _PRECEDENCE or token == ")":
                break
            out.append(token)
            want = False
        elif token in _PRECEDENCE:
            while ops and ops[-1] != "(" and _PRECEDENCE[ops[-1]] >= _PRECEDENCE[token]:
                out.append(ops.pop())
            ops.append(token)
            want = True
        elif token == ")" and "(" in ops:
            while ops[-1] != "(":
                out.append(ops.pop())
            ops.pop()
        else:
            break
        if not want and "(" not in ops:
            best = out + ops[::-1]
    return best


def family(identifier: str) -> str:
    """apache-2.0 -> apache-2, cc-by-nc-4.0 -> cc-by-nc, gpl-3.0-or-later -> gpl, bsd-3-clause -> bsd."""
    if identifier.startswith("apache-2"):
        return "apache-2"
    if identifier.startswith("cc0"):
        return "cc0"
    return re.sub(r"-(v?\d[\w.+]*|only|or-later|clause)(?=-|$)", "", identifier).rstrip("+") or identifier


def weight(label: str) -> float:
    return WEIGHTS.get(label, WEIGHTS.get(label.split("-")[0], 0.5))


def evaluate(rpn: list[str]) -> tuple[float, set[str]]:
    """How far the expression restricts (or: the least, and: the most, with: relaxed), and its labels."""
    stack, labels = [], set()
    for token in rpn:
        if token in _PRECEDENCE:
            b, a = stack.pop(), stack.pop()
            stack.append({"or": min(a[0], b[0]), "and": max(a[0], b[0]), "with": a[0] * EXCEPTION}[token])
            if token == "with":
                labels.discard(b[1])
            stack[-1] = (stack[-1], a[1])
        else:
            stack.append((weight(family(token)), family(token)))
            labels.add(family(token))
    return stack[0][0], labels


RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, n_notices long, expressions array<string>, score double"


class Scanner:
    def __init__(self):
        self.words = automaton({**{p: ("base", x) for p, x in BASE.items()}, **{p: ("notice", x) for p, x in NOTICES.items()}, TAG: ("tag", "")})

    def scan(self, raw: bytes) -> tuple:
        words = normalise(raw)
        text = " " + b" ".join(words).decode("latin-1") + " "
        spots, base, labels, notices, tagged, score = [], set(), set(), 0, False, 0.0
        for end, (phrase, (kind, label)) in self.words.iter(text):
            if kind == "base":
                spots.append(end - len(phrase) - 1)
                base.add(label)
            elif kind == "notice":
                notices += 1
                labels.add(label)
            else:
                tagged = True
        starts = []
        if spots:
            # a phrase's word number is the spaces before it, but for the one it starts with
            spaces = np.cumsum(np.frombuffer(text.encode("latin-1"), dtype=np.uint8) == 32)
            starts = (spaces[spots] - 1).tolist()
        noticed, expressions = set(labels), []
        if tagged:
            for m in _TAG_LINE.finditer(raw.lower()):
                if rpn := parse(m[1].decode("utf-8", "replace")):
                    restricts, named = evaluate(rpn)
                    expressions.append(" ".join(rpn))
                    labels |= named
                    score = max(score, restricts)
        labels |= base
        score = max([score, *(weight(x) for x in base | noticed)])
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), notices, expressions, score


def scan_udf():
    names = [x.split()[0] for x in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        for s in texts:
            out = pd.DataFrame([scanner.scan(b or b"") for b in s], columns=names)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return run


def license_columns(df: DataFrame, text: str = "text", to: str = "license") -> DataFrame:
    """df with a struct of what the scan found."""
    return df.withColumn(free(df, to), scan_udf()(F.col(text).cast("binary")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_columns(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *(F.col(f"license.{x}").alias(x) for x in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_notices")))
