"""Thresholds of the curation operators: they are the operators' semantics, so they stand in one place."""

from __future__ import annotations

import ast
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Ingest:
    chunk_size: int = 400
    overlap: int = 50
    min_chars: int = 30
    max_chars: int = 2000
    min_words: int = 10
    max_non_alpha: float = 0.4


@dataclass(frozen=True)
class Curate:
    min_chars: int = 10
    max_chars: int = 2000
    min_words: int = 3
    max_punctuation: float = 0.7
    duplicate_similarity: float = 0.95
    similarity: tuple[float, float] = (0.1, 0.95)
    length_ratio: tuple[float, float] = (0.1, 10.0)
    min_quality: float = 0.46
    context_entries: int = 3
    shares: tuple[float, float] = (0.8, 0.1)
    seed: str = "42"


INGEST, CURATE = Ingest(), Curate()


def _value(text: str):
    """A plain YAML scalar or bracketed list."""
    plain = {"true": True, "yes": True, "false": False, "no": False, "null": None, "~": None, "": None}
    if text.lower() in plain:
        return plain[text.lower()]
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def load(text: str, base=CURATE):
    """base with the values that a flat YAML text (key: value lines, comments) names; keys it doesn't know are an error."""
    given = {}
    for line in text.splitlines():
        bare = line.split(" #")[0].strip()
        if not bare or bare.startswith(("#", "---")):
            continue
        key, mark, value = bare.partition(":")
        if not mark:
            raise ValueError(f"no 'key: value' line: {line!r}")
        given[key.strip()] = _value(value.strip())
    known = {f.name: f for f in fields(base)}
    if strange := sorted(set(given) - set(known)):
        raise ValueError(f"unknown settings: {', '.join(strange)}")
    return replace(base, **{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})
