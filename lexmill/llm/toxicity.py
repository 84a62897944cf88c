"""Toxicity: a support vector machine on a subsequence string kernel, with Nyström landmarks, trained on labelled sentences.

A sentence is a bag of units: its words, without marks inside them, and runs of letters set apart by spaces. The kernel of
two units counts common subsequences of three characters, each occurrence weighted by DECAY to the length it
spans, up to SPAN characters, and is normalised. So an insult with characters put in or left out stays close to it.
Kernel values against landmark units, times the inverse root of the landmarks' own kernel matrix, are the
features of a linear machine (squared hinge loss, solved in the primal by Newton steps).

Training rows are the units of labelled sentences, each with its sentence's label, which is its document's. Most sentences of
a toxic document are clean, so the first machine weighs clean rows CLEAN times as heavy as toxic ones; each later one
takes, of every toxic document, only the sentence that the machine before found most toxic, by its highest unit (multiple-
instance learning), with copies of that unit that have a character put in or left out, against the highest unit of each
clean sentence (in any round so far) and all units of clean sentences. Its landmarks are such units of both kinds. The machine's weights collapse into one table over
three-character codes, which scores a unit without visiting the landmarks. A sentence scores as its highest unit, a
document as its highest sentence; a logistic curve makes it 0 to 1.

Training takes at most SAMPLE labelled documents of each class, the first in a hash order, and LANDMARKS landmarks of
each kind: documented bounds. All units of those documents are rows. Scoring reads every whole text, and units of any length.
Defined results: a null or empty text has the floor score, as have texts whose units all stay under FLOOR; equal texts score
alike; repeated rows stay as many as they are; an empty table gives an empty one; with no labels of one class, every
score is the share of toxic labels (0 without labels); a score column whose name is taken gets "_" put behind it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import free, table

SAMPLE = 1500  # labelled documents of each class
LANDMARKS = 96  # of each kind: of toxic sentences, of clean ones
ROUNDS = 4  # in which each toxic document's most toxic sentence is chosen anew
CLEAN = 20.0  # times as heavy as toxic rows, while every sentence of a toxic document counts as toxic
VARIED = 0.5  # share of a toxic row's weight that its varied copies have
SPREAD = 0.2  # share of the clean weight that all units of clean sentences have, whatever they score
FIRST_PENALTY, PENALTY = 1e-6, 1e-3  # of the first machine, of the later ones
DECAY = 0.6
SPAN = 7
WIDTH = 32  # characters; longer units are scored one by one
FLOOR = -0.9  # the least decision value that is told apart
TABLE = 400_000  # entries of the table of scored units
HOLD = 5  # of which remainder 0 is held out

_DELETE = bytes(c for c in range(128) if not (chr(c).isalnum() or c in b" \t\n\r\x0b\x0c"))
_SPACED = re.compile(rb"(?<!\S)(?:\S[ \t]){2,}\S(?!\S)")
_SENTENCE = re.compile(rb"[.!?]+(?=\s)|\n")
_STEPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]


def fold(text: str | None) -> bytes:
    """One byte a character, A-Z lower-cased; what Latin-1 lacks becomes a mark."""
    return (text or "").encode("latin-1", "replace").lower()


def units(folded: bytes) -> set[bytes]:
    bare = folded.translate(None, _DELETE)
    out = set(bare.split())
    if _SPACED.search(bare):
        out.update(m[0].translate(None, b" \t") for m in _SPACED.finditer(bare))
    return out


def phi(unit: bytes) -> dict[bytes, float]:
    """Weights of the unit's three-character subsequences."""
    out: dict[bytes, float] = defaultdict(float)
    n = len(unit)
    for a, b in _STEPS:
        w = DECAY ** (a + b + 1)
        for i in range(n - a - b):
            out[bytes((unit[i], unit[i + a], unit[i + a + b]))] += w
    return out


def norm(f: dict[bytes, float]) -> float:
    return sum(x * x for x in f.values()) ** 0.5


class Landmarks:
    """Normalised kernel values of units against landmarks; units of fewer than three characters are orthogonal to all."""

    def __init__(self, marks: list[bytes]):
        letters = sorted({b for u in marks for b in u})
        self.size = len(letters) + 1
        self.classes = np.zeros(256, dtype=np.int64)
        self.classes[letters] = np.arange(1, self.size)
        #: A row for each code that some landmark has; all others share the first, of zeros.
        self.at = np.zeros(self.size**3, dtype=np.int64)
        rows = [np.zeros(len(marks), dtype=np.float32)]
        for k, u in enumerate(marks):
            f = phi(u)
            n = norm(f)
            for c, x in f.items():
                x1, x2, x3 = self.classes[list(c)]
                code = (x1 * self.size + x2) * self.size + x3
                if not self.at[code]:
                    self.at[code] = len(rows)
                    rows.append(np.zeros(len(marks), dtype=np.float32))
                rows[self.at[code]][k] = x / n
        self.rows = np.vstack(rows)

    def values(self, some: list[bytes], root: np.ndarray | None = None) -> np.ndarray:
        """A row for each unit, times root where one is given."""
        out = np.zeros((len(some), self.rows.shape[1]), dtype=np.float32)
        by: dict[int, list[int]] = defaultdict(list)
        for k, u in enumerate(some):
            if len(u) >= 3:
                by[len(u)].append(k)
        for n, all_ in by.items():
            spots = [(i, i + a, i + a + b, DECAY ** (a + b + 1)) for a, b in _STEPS for i in range(n - a - b)]
            first, mid, last, w = (np.asarray(x) for x in zip(*spots, strict=True))
            for at in range(0, len(all_), max(1, 200_000 // len(spots))):
                own = all_[at : at + max(1, 200_000 // len(spots))]
                raw = np.frombuffer(b"".join(some[k] for k in own), dtype=np.uint8).reshape(-1, n).astype(np.int64)
                own_code = (raw[:, first] << 16) | (raw[:, mid] << 8) | raw[:, last]
                order = np.argsort(own_code, axis=1, kind="stable")
                ordered, weights = np.take_along_axis(own_code, order, 1), w[order]
                ends = np.hstack((ordered[:, 1:] != ordered[:, :-1], np.ones((len(own), 1), dtype=bool)))
                sums = np.diff(np.concatenate(([0.0], np.cumsum(weights.ravel())[np.flatnonzero(ends.ravel())])))
                square = np.bincount(np.nonzero(ends)[0], sums**2, minlength=len(own))
                c = self.classes[raw]
                rows = self.at[(c[:, first] * self.size + c[:, mid]) * self.size + c[:, last]]
                dots = np.zeros((len(own), self.rows.shape[1]), dtype=np.float32)
                for j, x in enumerate(w):
                    dots += np.float32(x) * self.rows[rows[:, j]]
                dots /= np.sqrt(square).astype(np.float32)[:, None]
                out[own] = dots if root is None else dots @ root
        return out


def _svm(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, penalty: float) -> np.ndarray:
    """Weights (the offset last) that minimise penalty |w|^2 + the squared hinge losses of the rows, each taken as toxic and
    as clean at these costs: Newton steps over the rows inside their margin, halved until the loss falls."""
    ridge = np.full(x.shape[1] + 1, penalty)
    ridge[-1] = 1e-9
    w = np.zeros(x.shape[1] + 1)

    def loss(v: np.ndarray) -> tuple[float, np.ndarray]:
        f = x @ v[:-1].astype(np.float32) + v[-1]
        f = f.astype(np.float64)
        return float(ridge @ v**2 + (toxic * np.maximum(0, 1 - f) ** 2 + clean * np.maximum(0, 1 + f) ** 2).sum()), f

    now, f = loss(w)
    for _ in range(40):
        a, b = toxic * (f < 1), clean * (f > -1)
        g, h = 2 * ridge * w, 2 * np.diag(ridge)
        inside = np.flatnonzero(a + b)
        for at in range(0, len(inside), 8192):
            k = inside[at : at + 8192]
            z = np.hstack((x[k].astype(np.float64), np.ones((len(k), 1))))
            g += 2 * z.T @ (a[k] * (f[k] - 1) + b[k] * (f[k] + 1))
            h += 2 * (z * (a + b)[k, None]).T @ z
        step, size = np.linalg.solve(h + 1e-10 * np.eye(len(w)), g), 1.0
        while size > 1e-4:
            then, f2 = loss(w - size * step)
            if then < now:
                break
            size /= 2
        if size <= 1e-4 or now - then < 1e-7 * now:
            break
        w, now, f = w - size * step, then, f2
    return w


def _logistic(m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, each halved until the loss falls, with a little shrinkage."""

    def loss(v: np.ndarray) -> float:
        z = v[0] * m + v[1]
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 5e-3 * v[0] ** 2)

    v = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(v[0] * m + v[1], -30, 30)))
        g = np.array([(weight * (p - y) * m).sum() + 1e-2 * v[0], (weight * (p - y)).sum()])
        h = weight * p * (1 - p)
        step = np.linalg.solve(np.array([[(h * m * m).sum() + 1e-2, (h * m).sum()], [(h * m).sum(), h.sum() + 1e-6]]), g)
        while loss(v - step) > loss(v) and np.abs(step).max() > 1e-9:
            step /= 2
        v = v - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(v[0], 0.0)), float(v[1])


class Model:
    """Weights over three-character codes, an offset, and the logistic curve."""

    def __init__(self, weights: dict[bytes, float], offset: float, slope: float = 1.0, shift: float = 0.0, constant: float | None = None):
        self.offset, self.slope, self.shift, self.constant = offset, slope, shift, constant
        letters = sorted({b for c in weights for b in c})
        self.size = len(letters) + 1
        self.classes = np.zeros(256, dtype=np.int32)
        self.classes[letters] = np.arange(1, self.size)
        self.weights = weights
        self.table = np.zeros(self.size**3)
        for c, x in weights.items():
            a, b, d = self.classes[list(c)]
            self.table[(a * self.size + b) * self.size + d] = x
        #: The least norm that units of each length can have: no subsequence occurs twice.
        self.least = np.array([max(1e-9, sum(max(0, n - a - b) * DECAY ** (2 * (a + b + 1)) for a, b in _STEPS)) ** 0.5 for n in range(WIDTH + 1)])
        self.known: dict[bytes, float] = {}

    def __getstate__(self):
        return self.weights, self.offset, self.slope, self.shift, self.constant

    def __setstate__(self, state):
        self.__init__(*state)

    def _exact(self, unit: bytes) -> float:
        f = phi(unit)
        return sum(x * self.weights.get(c, 0.0) for c, x in f.items()) / norm(f) + self.offset

    def decide(self, some: list[bytes]) -> list[float]:
        """Decision values, FLOOR at least. A bound from the least norm spares most units the exact value."""
        out = [FLOOR] * len(some)
        short = []
        for k, u in enumerate(some):
            if len(u) <= WIDTH:
                short.append(k)
            else:
                out[k] = max(FLOOR, self._exact(u))
        for at in range(0, len(short), 20_000):
            block = [some[k] for k in short[at : at + 20_000]]
            c = self.classes[np.frombuffer(b"".join(p.ljust(WIDTH, b"\0") for p in block), dtype=np.uint8).reshape(-1, WIDTH)]
            dot = np.zeros(len(block))
            for a, b in _STEPS:
                code = (c[:, : WIDTH - a - b] * self.size + c[:, a : WIDTH - b]) * self.size + c[:, a + b :]
                dot += DECAY ** (a + b + 1) * self.table[code].sum(axis=1)
            bound = dot / self.least[[len(p) for p in block]] + self.offset
            for k in np.flatnonzero((bound > FLOOR) & (dot > 0)):
                out[short[at + k]] = max(FLOOR, self._exact(block[k]))
        return out

    def decisions(self, texts: list[bytes]) -> np.ndarray:
        found = [units(t) for t in texts]
        missing = list(set().union(*found).difference(self.known)) if found else []
        if len(self.known) + len(missing) > TABLE:
            self.known.clear()
            missing = list(set().union(*found))
        self.known.update(zip(missing, self.decide(missing), strict=True))
        return np.array([max(map(self.known.__getitem__, f), default=FLOOR) for f in found])

    def scores(self, decisions: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(decisions), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * decisions + self.shift, -30, 30)))


def _variants(unit: bytes) -> list[bytes]:
    """The unit with a character put in, and with one left out: what the machine should still take for it."""
    return [unit, *(unit[:k] + b"x" + unit[k:] for k in range(1, len(unit))), *(unit[:k] + unit[k + 1 :] for k in range(1, len(unit) - 1) if len(unit) > 4)]


def machine(marks: list[bytes], units_: list[bytes], toxic: np.ndarray, clean: np.ndarray, penalty: float | None = None) -> tuple[Model, np.ndarray]:
    """The machine over these landmarks, of rows with these costs as toxic and as clean; and the rows' decision values."""
    held = Landmarks(marks)
    value, vector = np.linalg.eigh(held.values(marks).astype(np.float64))
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-4))) @ vector.T
    rows = held.values(units_, root.astype(np.float32))
    w = _svm(rows, toxic, clean, PENALTY if penalty is None else penalty)
    weights: dict[bytes, float] = defaultdict(float)
    for a, u in zip(root @ w[:-1], marks, strict=True):
        f = phi(u)
        n = norm(f)
        for c, x in f.items():
            weights[c] += a * x / n
    return Model(dict(weights), float(w[-1])), rows @ w[:-1].astype(np.float32) + w[-1]


def _sentences(texts: list[bytes]) -> list[list[set[bytes]]]:
    """The units of each text's sentences; units of fewer than three characters have no kernel."""
    split = [[s for s in _SENTENCE.split(t) if s.strip()] for t in texts]
    return [[got for s in own if (got := {u for u in units(s) if len(u) >= 3})] for own in split]


def train(toxic: list[str], clean: list[str], share: float = 0.5) -> Model:
    """share: of toxic documents among all labelled ones, for the logistic curve."""
    if not toxic or not clean:
        return Model({}, FLOOR, constant=float(share) if toxic or clean else 0.0)
    tox, cln = [fold(t) for t in toxic], [fold(t) for t in clean]
    bags, plain = _sentences(tox), _sentences(cln)
    bad, good = (Counter(u for own in some for s in own for u in s) for some in (bags, plain))
    if not bad or not good:
        return Model({}, FLOOR, constant=float(share))
    listed = sorted(set(bad) | set(good))
    place = {u: k for k, u in enumerate(listed)}
    as_clean = np.array([good[u] for u in listed], dtype=np.float64) / sum(good.values())
    as_toxic = np.array([bad[u] for u in listed], dtype=np.float64) / sum(bad.values())
    rank = lambda cost: [listed[k] for k in np.argsort(-cost, kind="stable")[:LANDMARKS]]
    marks = list(dict.fromkeys([*rank(as_toxic - CLEAN * as_clean), *rank(as_clean)]))
    model, found = machine(marks, listed, as_toxic, CLEAN * as_clean, FIRST_PENALTY)
    nearest = Counter()  # units that some clean sentence scored by, in any round
    for _ in range(ROUNDS):
        value = dict(zip(listed, found.tolist(), strict=False))
        by = lambda u: (value[u], u)
        # of each toxic document the sentence that is most toxic, by its highest unit; of each clean sentence its highest unit
        chosen = Counter(max(max(own, key=lambda s: max(value[u] for u in s)), key=by) for own in bags if own)
        nearest.update(max(s, key=by) for own in plain for s in own)
        varied = Counter()
        for u, n in chosen.items():
            copies = _variants(u)[1:]
            for v in copies:
                varied[v] += VARIED * n / len(copies)
        extra = [v for v in varied if v not in place]
        rows = listed + extra
        cost = np.array([chosen[u] * (1 - VARIED) + varied[u] for u in rows]) / sum(chosen.values())
        near = np.array([nearest[u] for u in listed]) / sum(nearest.values())
        hard = [u for u, _ in sorted(nearest.items(), key=lambda x: (-x[1] * max(1e-9, 1 + value[x[0]]) ** 2, x[0]))[:LANDMARKS]]
        marks = list(dict.fromkeys([*(u for u, _ in sorted(chosen.items(), key=lambda x: (-x[1], x[0]))[:LANDMARKS]), *hard]))
        model, found = machine(marks, rows, cost, np.concatenate(((1 - SPREAD) * near + SPREAD * as_clean, np.zeros(len(extra)))))
    m = model.decisions(tox + cln)
    y = np.array([1.0] * len(tox) + [0.0] * len(cln))
    model.slope, model.shift = _logistic(m, y, np.where(y > 0, share / len(tox), (1 - share) / len(cln)) * len(y))
    model.known.clear()
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Learns from labels whose id's CRC-32 leaves a remainder other than 0; an id labelled twice counts as toxic if it ever is."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    usable = labels.where(F.col(label).isNotNull() & (F.pmod(crc, F.lit(HOLD)) != 0)).groupBy(doc_id).agg(F.max(label).alias("toxicity_label"))
    counts = {r["y"]: r["n"] for r in usable.groupBy((F.col("toxicity_label") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64(doc_id, F.lit("toxicity")), F.col(doc_id)]
    chosen = [usable.where(F.col("toxicity_label") > 0).orderBy(*order).limit(SAMPLE), usable.where(F.col("toxicity_label") <= 0).orderBy(*order).limit(SAMPLE)]
    # at most 2 * SAMPLE ids are broadcast, and as many documents come to the driver
    rows = docs.select(doc_id, text).join(F.broadcast(chosen[0].unionByName(chosen[1])), doc_id).orderBy(doc_id, text).select(F.col(text).alias("t"), F.col("toxicity_label").alias("y")).collect()
    total = sum(counts.values())
    return train([r["t"] for r in rows if r["y"] > 0], [r["t"] for r in rows if r["y"] <= 0], counts.get(True, 0) / total if total else 0.0)


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = held.value
        for s in texts:
            folded = [fold(t) for t in s]
            yield pd.Series(np.concatenate([own.scores(own.decisions(folded[at : at + 256])) for at in range(0, len(folded), 256)]) if folded else [], dtype="float64")

    return df.withColumn(free(df, to), run(F.col(text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    out = score(docs.select("doc_id", "text"), model)
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(HOLD)) == 0
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
