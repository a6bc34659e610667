"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding lowers case, maps look-alike letters of other scripts to Latin ones and digits or signs inside a word to the
letters they stand for, and turns punctuation into spaces. The lexicon (whole words, and stems that stand for all words
that start with them), its weights and the exception phrases, inside which a hit does not count, come from labelled
documents. Weights are log-odds; a document's weight, alone and by length, goes through a fitted logistic curve.

Defined results: a null text counts as empty and has the score of a text without hits; a very long text is matched whole;
without labels of both classes every score is 0; of several labels of one document the smallest counts; of hits that start
at one word the heaviest counts; repeated rows are each scored; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm._common import held_out, table
from wellspring.session import ship

#: Bounds of the fit: so many labelled documents of each class, chosen by a hash of their ids, and so many entries of the
#: lexicon and exceptions, those in most documents first: the model goes to every task.
SAMPLE, MOST_ENTRIES = 3000, 20_000
STEMS = range(4, 9)
LEAST_DOCS, LEAST_ODDS = 4, math.log(15)

# Letters of other scripts that look like Latin ones, and what digits and signs stand for in a word.
LOOKALIKES = dict(zip("аеорсухіјѕԁԛԝһѵɡмнтквαεορτυικνχıɑ", "aeopcyxijsdqwhvgmhtkbaeoptuiknxia"))
#: Where letters, their compatible forms (full width, circled, mathematical ...) and punctuation are folded.
FOLDED = (range(0x20, 0x2E80), range(0x3000, 0x3040), range(0xFB00, 0xFB07), range(0xFE10, 0xFE70), range(0xFF01, 0xFFEF), range(0x1D400, 0x1D800), range(0x1F100, 0x1F200))
SUBSTITUTES = dict(zip("0134578@$€", "oieastbase"))


def _table() -> dict[int, str]:
    out = {}
    for c in map(chr, (x for part in FOLDED for x in part)):
        low = "".join(LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFKC", c).lower())
        if not low.isalnum() and c not in SUBSTITUTES and low not in SUBSTITUTES:
            low = " " if unicodedata.category(c)[0] in "PSZC" else low
        if low != c:
            out[ord(c)] = low
    for c in "\t\n\v\f\r":
        out[ord(c)] = " "
    for c in (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD):  # zero width: dropped
        out[c] = ""
    return out


_FOLD = _table()
_MIXED = re.compile(r"[^ ]*[^\W\d_][^ ]*[0134578@$€][^ ]*|[^ ]*[0134578@$€][^ ]*[^\W\d_][^ ]*")
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_SIGNS = str.maketrans({c: " " for c in SUBSTITUTES if not c.isdigit()})


def fold(text: str | None) -> str:
    """Words with single spaces around each. Digits and signs are only replaced in words that also have letters."""
    t = (text or "").translate(_FOLD)
    if any(c in t for c in SUBSTITUTES):
        t = _MIXED.sub(lambda m: m[0].translate(_SUBSTITUTE), t).translate(_SIGNS)
    return f" {' '.join(t.split())} "


@dataclass
class Lexicon:
    """weights: ' word ' for a whole word, ' stem' for all words that start so; exceptions: ' two words '."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] | None = None  # of log weight, log weight per 100 words, and the constant

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for p, w in self.weights.items():
            a.add_word(p, (len(p), w, p in self.exceptions))
        for p in self.exceptions - set(self.weights):
            a.add_word(p, (len(p), 0.0, True))
        if len(a):
            a.make_automaton()
        return a

    def hits(self, folded: str, automaton) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the hits that count: none inside an exception, of those that start at one word the heaviest."""
        if not len(automaton):
            return []
        best: dict[int, tuple[int, float]] = {}
        free: list[tuple[int, int]] = []
        for last, (n, w, exempt) in automaton.iter(folded):
            start = last + 1 - n
            if exempt:
                free.append((start, last + 1))
            elif start not in best or best[start][1] < w:
                best[start] = (last + 1, w)
        return [(s, e, w) for s, (e, w) in sorted(best.items()) if not any(a <= s and e <= b + 1 for a, b in free)]

    def measures(self, text: str | None, automaton) -> tuple[float, float]:
        """Log of the summed weight, and of that per 100 words."""
        folded = fold(text)
        total = sum(w for _, _, w in self.hits(folded, automaton))
        return math.log1p(total), math.log1p(100 * total / max(1, folded.count(" ") - 1))

    def score(self, m: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(m))
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a * m[:, 0] + b * m[:, 1] + c, -500, 500)))


def _labelled(docs: DataFrame, labels: DataFrame, label_col: str, sample: int) -> DataFrame:
    """text and y of at most `sample` documents of each class: ids are chosen first, and texts fetched for them alone."""
    one = labels.where(F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.min(label_col).cast("int").alias("y"))
    picked = [one.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    # At most 2 * sample rows of two numbers: their size is bounded by the parameter.
    return docs.select("doc_id", "text").join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("doc_id", "text", "y")


def _counts(rows: DataFrame, make) -> DataFrame:
    """p, d1, d0: in how many documents of each class each of make()(text) occurs; summed in each batch before the shuffle."""

    def run(batches):
        patterns = make()
        for b in batches:
            seen: dict[str, list[int]] = {}
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                for p in patterns(text):
                    seen.setdefault(p, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64())], ["p", "d1", "d0"])

    return rows.select("text", "y").mapInArrow(run, "p string, d1 bigint, d0 bigint").groupBy("p").agg(F.sum("d1").alias("d1"), F.sum("d0").alias("d0"))


def _words_and_stems(text: str | None) -> set[str]:
    words = set(fold(text).split())
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:n]}" for w in words for n in STEMS if len(w) > n}


def _choose(rows: list[tuple[str, int, int]], n1: int, n0: int) -> dict[str, float]:
    """From (pattern, documents of class 1, of class 0): no entry that a chosen stem already covers.

    A stem is dropped where one word makes nine tenths of its documents: then it's that word.
    """
    weight = {p: math.log((d1 + 0.1) / n1) - math.log((d0 + 0.5) / n0) for p, d1, d0 in rows}
    support = {p: d1 for p, d1, _ in rows}
    words = {p for p in weight if p.endswith(" ")}
    owned: dict[str, int] = {}
    for p in words:
        for n in STEMS:
            if len(p) - 2 >= n:
                owned[p[: n + 1]] = max(owned.get(p[: n + 1], 0), support[p])
    chosen: dict[str, float] = {}
    for p in sorted(weight, key=lambda p: (p.endswith(" "), len(p), p)):
        if not p.endswith(" ") and owned.get(p, 0) >= 0.9 * support[p]:
            continue
        above = [chosen[p[: n + 1]] for n in STEMS if p[: n + 1] in chosen and p[: n + 1] != p]
        if not above or max(above) < weight[p] - 1:
            chosen[p] = weight[p]
    return chosen


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = SAMPLE) -> Lexicon:
    """Lexicon, exceptions and curve from at most `sample` labelled documents of each class."""
    ship(docs.sparkSession)
    from wellspring.session import materialize

    rows = materialize(_labelled(docs, labels, label_col, sample), "labelled")
    size = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Lexicon()
    odds = F.log((F.col("d1") + 0.1) / n1) - F.log((F.col("d0") + 0.5) / n0)
    found = _counts(rows, lambda: _words_and_stems).where((F.col("d1") >= LEAST_DOCS) & (odds >= LEAST_ODDS)).orderBy(F.desc("d1"), "p").limit(MOST_ENTRIES).collect()
    lexicon = Lexicon(_choose([(r.p, r.d1, r.d0) for r in found], n1, n0))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def phrases():
        """Of a text: each hit with the word before it, and with the word after it."""
        lex, automaton = shared.value, shared.value.automaton()

        def of(text):
            folded = fold(text)
            out = set()
            for s, e, _ in lex.hits(folded, automaton):
                a, b = folded.rfind(" ", 0, s), folded.find(" ", e if folded[e - 1] != " " else e - 1)
                c = folded.find(" ", b + 1)
                out |= {folded[a : b + 1]} if a >= 0 else set()
                out |= {folded[s : c + 1]} if c >= 0 else set()
            return out

        return of

    clean = _counts(rows, phrases).where((F.col("d0") >= LEAST_DOCS) & ((F.col("d0") + 0.1) / n0 > 4 * (F.col("d1") + 0.1) / n1))
    lexicon.exceptions = {r.p for r in clean.orderBy(F.desc("d0"), "p").limit(MOST_ENTRIES).collect()}
    final = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        automaton = final.value.automaton()
        for b in batches:
            m = np.array([final.value.measures(t, automaton) for t in b.column("text").to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(m[:, 0]), pa.array(m[:, 1]), b.column("y")], ["a", "b", "y"])

    measured = rows.select("text", "y").mapInArrow(run, "a double, b double, y int").groupBy("a", "b", "y").agg(F.count("*").alias("n")).orderBy("a", "b", "y").collect()
    lexicon.curve = _logistic(np.array([(r.a, r.b) for r in measured]), np.array([r.y for r in measured]), np.array([r.n for r in measured], float))
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Newton's method with a ridge, which also holds the curve finite where the classes separate; slopes are not negative."""
    d = np.column_stack([x, np.ones(len(x))])
    free = [0, 1]
    while True:
        cols = [*free, 2]
        w = np.zeros(len(cols))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(d[:, cols] @ w, -500, 500)))
            keep = np.diag([ridge] * len(free) + [1e-6])
            step = np.linalg.solve((d[:, cols] * (n * p * (1 - p))[:, None]).T @ d[:, cols] + keep, d[:, cols].T @ (n * (y - p)) - keep @ w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        bad = [k for k, v in zip(free, w) if v < 0]
        if not bad:
            full = dict(zip(cols, w))
            return float(full.get(0, 0.0)), float(full.get(1, 0.0)), float(full[2])
        free = [k for k in free if k not in bad]


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and weight of every row; one narrow pass over whole texts."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        lex = shared.value
        automaton = lex.automaton()
        for b in batches:
            m = np.array([lex.measures(t, automaton) for t in b.column("text").to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lex.score(m)), pa.array(np.expm1(m[:, 0]))], ["doc_id", "score", "weight"])

    return picked.mapInArrow(run, f"doc_id {dict(picked.dtypes)['doc_id']}, score double, weight double")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, lexicon).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
