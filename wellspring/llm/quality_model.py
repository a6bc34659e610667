"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each text is reduced to transformed statistics (lengths, character shares, repetition). Class means and
covariances are summed over every labelled training document; each covariance is shrunk towards the pooled
variances; a score is the difference of the two classes' Mahalanobis log-densities, from Cholesky factors
computed once and sent with the code.

Defined results: a null text counts as empty; empty, wordless and very long texts are scored like any other; where only
one class has labels its share decides every score, and without labels every score is 0.5; a score of exactly the
threshold accepts; of several labels of one document the smallest counts; repeated rows are each scored; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm._common import Words, held_out, mix, table, word_batches
from wellspring.session import materialize, release, ship

FEATURES = (
    "log_words", "word_length", "log_length_spread", "upper", "symbol", "bang", "other_punctuation", "digit", "wordless", "line_breaks",
    "beside_itself", "distinct", "top_word", "repeated_windows",
)
SHRINKAGE = 0.1
_NONE, _UPPER, _LOWER, _DIGIT, _SYMBOL, _BANG, _PUNCTUATION, _BREAK = range(8)


def _classes() -> np.ndarray:
    c = np.full(256, _LOWER, np.int64)
    c[:128] = _PUNCTUATION
    c[:33] = _NONE
    c[10] = _BREAK
    c[ord("A") : ord("Z") + 1], c[ord("a") : ord("z") + 1], c[ord("0") : ord("9") + 1] = _UPPER, _LOWER, _DIGIT
    c[[ord(x) for x in "#*$%&|<>"]], c[ord("!")] = _SYMBOL, _BANG
    return c


_CLASS = _classes()


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _runs(w: Words, hashes: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: how many different hashes, the count of the commonest, and how many occur more than once."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    keys = np.sort(mix(hashes + docs.astype(np.uint64)) >> np.uint64(20) | (docs.astype(np.uint64) << np.uint64(44)))
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(new, len(keys)))
    owner = (keys[new] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, owner, size)
    return np.bincount(owner, minlength=n).astype(float), most, np.bincount(owner, np.where(size > 1, size, 0), n)


def statistics(w: Words) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(w.docs) - 1
    kinds = _CLASS[w.data]
    owner = np.repeat(np.arange(n), np.diff(w.docs))
    count = np.bincount(owner * 8 + kinds, minlength=n * 8).reshape(n, 8).astype(float)
    words, length = np.diff(w.bounds).astype(float), w.ends - w.starts
    of = np.repeat(np.arange(n), np.diff(w.bounds))
    some = np.maximum(words, 1)
    chars = np.maximum(_sums(length, w.bounds), 1)
    mean = chars / some
    spread = np.sqrt(np.maximum(_sums(length.astype(float) ** 2, w.bounds) / some - mean**2, 0))
    letters = np.concatenate([[0], np.cumsum((kinds == _LOWER) | (kinds == _UPPER))])
    bare = letters[w.ends] == letters[w.starts]
    beside = np.zeros(len(length), bool)
    beside[1:] = (w.hashes[1:] == w.hashes[:-1]) & (of[1:] == of[:-1])
    distinct, top, _ = _runs(w, w.hashes, of, n)
    triple, inside = w.hashes[:-2] * np.uint64(3) + w.hashes[1:-1] * np.uint64(5) + w.hashes[2:] * np.uint64(7) if len(length) > 2 else w.hashes[:0], of[2:] == of[:-2]
    _, _, repeated = _runs(w, triple[inside], of[:-2][inside], n)
    share = lambda k: np.sqrt(count[:, k] / chars)
    return np.stack(
        [
            np.log1p(words), mean, np.log1p(spread), share(_UPPER), share(_SYMBOL), share(_BANG), share(_PUNCTUATION), share(_DIGIT), np.sqrt(_sums(bare, w.bounds) / some),
            share(_BREAK), np.sqrt(_sums(beside, w.bounds) / some), np.log((distinct + 1) / (words + 1)), np.sqrt(top / some), np.sqrt(repeated / some),
        ],
        axis=1,
    )


def _features(texts: pa.Array) -> np.ndarray:
    out = [statistics(w) for _, w in word_batches(texts)]
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the array x of FEATURES for every row; one narrow pass."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            x = _features(b.column("text"))
            flat = pa.array(x.reshape(-1))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), flat)], ["doc_id", "x"])
        release()

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {dict(picked.dtypes)['doc_id']}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Centres, inverse Cholesky factors and constants of both classes; `fixed` where there is nothing to compare."""

    centre: np.ndarray
    scale: np.ndarray
    means: tuple = ()
    factors: tuple = ()
    constants: tuple = ()
    fixed: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(x), self.fixed)
        z = (x - self.centre) / self.scale
        density = [c - 0.5 * (((z - m) @ f) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants)]
        # The width of the statistics tempers the difference, so that scores keep their order away from 0.5.
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / len(self.centre), -500, 500)))


def fit(features: DataFrame, labels: DataFrame, label_col: str = "quality", shrinkage: float = SHRINKAGE) -> Discriminant:
    """Sums counts, means and products over all rows of features that have a label; d + d**2 numbers a class reach the driver."""
    d = len(FEATURES)
    one = labels.where(F.col(label_col).isin(0, 1)).groupBy("doc_id").agg(F.min(label_col).cast("int").alias("y"))

    def run(batches):
        total = {y: np.zeros(1 + d + d * d) for y in (0, 1)}
        for b in batches:
            x = np.asarray(b.column("x").flatten()).reshape(-1, d)
            y = np.asarray(b.column("y"))
            for k, t in total.items():
                v = x[y == k]
                t += np.concatenate([[len(v)], v.sum(0), (v.T @ v).reshape(-1)])
        n = 1 + d + d * d
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], n), pa.int32()), pa.array(np.tile(np.arange(n), 2), pa.int32()), pa.array(np.concatenate([total[0], total[1]]))], ["y", "k", "v"])

    rows = features.join(one, "doc_id").select("x", "y").mapInArrow(run, "y int, k int, v double").groupBy("y", "k").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((2, 1 + d + d * d))
    for r in rows:
        total[r.y, r.k] = r.v
    n = total[:, 0]
    if min(n) < 2:
        return Discriminant(np.zeros(d), np.ones(d), fixed=float(n[1] / n.sum()) if n.sum() else 0.5)
    mean = total[:, 1 : d + 1] / n[:, None]
    covariance = total[:, d + 1 :].reshape(2, d, d) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = (n[:, None, None] * covariance).sum(0) / n.sum()
    centre, scale = mean.mean(0), np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    covariance = covariance / scale[:, None] / scale[None, :]
    target = np.eye(d)  # the pooled variances, after scaling
    means, factors, constants = [], [], []
    for k in (0, 1):
        lower = np.linalg.cholesky((1 - shrinkage) * covariance[k] + shrinkage * target + 1e-9 * np.eye(d))
        means.append((mean[k] - centre) / scale)
        factors.append(np.linalg.inv(lower).T)
        constants.append(-np.log(np.diag(lower)).sum() + np.log(n[k] / n.sum()))
    return Discriminant(centre, scale, tuple(means), tuple(factors), tuple(constants))


def score_statistics(features: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score from document_statistics."""

    def run(batches):
        for b in batches:
            x = np.asarray(b.column("x").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return features.mapInArrow(run, f"doc_id {dict(features.dtypes)['doc_id']}, score double")


def keep_good(docs: DataFrame, model: Discriminant, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that the model accepts, with their columns; a narrow pass that moves no text between tasks."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            good = model.score(_features(b.column(place).cast(pa.string()))) >= threshold
            yield b.filter(pa.array(good))
        release()

    return docs.mapInArrow(run, docs.schema)


def train(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Discriminant]:
    """Statistics of every document, and the model of those outside the held-out third."""
    features = materialize(document_statistics(docs), "statistics")
    return features, fit(features, labels.where(~held_out(F.col("doc_id"))))


def query(spark, sf_dir: str) -> DataFrame:
    features, model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score_statistics(features, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, model = train(docs, table(spark, sf_dir, "labels"))
    return keep_good(docs, model)
