"""Language identification by a bidirectional gated recurrent network over bytes.

A text is cut into windows of WINDOW bytes; in each the network reads the bytes from both ends and labels every
position with a distribution over the languages; a document's probabilities are the mean over all its positions.
Weights are trained in numpy by backpropagation through time, on windows of a bounded sample.

Defined results: a null text, or one without any letter, is `und` with score 0, as is every text where no
document is labelled; a very long text is read whole, window by window; of equal probabilities the first language by
name holds; repeated rows are each labelled, and count once in training; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm._common import held_out, table
from wellspring.session import ship

WINDOW = 64
HIDDEN = 8
#: Bounds of the fit: about so many documents in all, the same number of each language, and windows of each document.
SAMPLE_DOCS = 1600
WINDOWS_PER_DOC = 4
STEPS, BATCH, RATE = 220, 256, 0.02
#: Windows that go through the network at once.
LANES = 4096


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place, to spare memory traffic."""
    np.negative(x, out=x)
    np.exp(np.minimum(x, 60, out=x), out=x)
    x += 1
    return np.divide(1, x, out=x)


@dataclass
class Network:
    """Two gated recurrent layers of opposite direction. Index 0 of each array is forwards, 1 backwards.

    table: [2 * 256, 3 * HIDDEN], what a byte adds to the update and reset gates and to the candidate;
    gates: [2, HIDDEN, 2 * HIDDEN]; candidate: [2, HIDDEN, HIDDEN]; out: [2, HIDDEN, languages]; bias: [languages].
    """

    languages: list[str]
    table: np.ndarray
    gates: np.ndarray
    candidate: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.gates, self.candidate, self.out, self.bias]

    def logits(self, x: np.ndarray) -> np.ndarray:
        """x: bytes, [time, lanes]. Logits of every position, [time, languages, lanes].

        Lanes are the innermost axis, so that gates are contiguous blocks; buffers are reused at each step.
        """
        steps, lanes = x.shape
        forwards, backwards = np.ascontiguousarray(self.table[:256].T), np.ascontiguousarray(self.table[256:].T)
        recurrent = np.ascontiguousarray(np.concatenate([self.gates, self.candidate], axis=2).transpose(0, 2, 1))
        out = np.ascontiguousarray(self.out.transpose(0, 2, 1))
        h = np.zeros((2, HIDDEN, lanes), np.float32)
        g, u = np.empty((2, 3 * HIDDEN, lanes), np.float32), np.empty((2, 3 * HIDDEN, lanes), np.float32)
        y = np.empty((2, len(self.languages), lanes), np.float32)
        gates, n, c = g[:, : 2 * HIDDEN], g[:, 2 * HIDDEN :], u[:, 2 * HIDDEN :]
        total = np.empty((steps, len(self.languages), lanes), np.float32)
        total[:] = self.bias[:, None]
        at = x.astype(np.intp)
        for t in range(steps):
            np.take(forwards, at[t], axis=1, out=g[0], mode="clip")
            np.take(backwards, at[steps - 1 - t], axis=1, out=g[1], mode="clip")
            np.matmul(recurrent, h, out=u)
            gates += u[:, : 2 * HIDDEN]
            _sigmoid(gates)
            c *= g[:, HIDDEN : 2 * HIDDEN]
            n += c
            np.tanh(n, out=n)
            n -= h
            n *= g[:, :HIDDEN]
            h += n
            np.matmul(out, h, out=y)
            total[t] += y[0]
            total[steps - 1 - t] += y[1]
        return total


def _softmax(x: np.ndarray, axis: int = -1) -> np.ndarray:
    x -= x.max(axis, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis, keepdims=True)
    return x


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time of the mean cross-entropy over all positions. x, weight: [time, lanes]; y: [lanes]."""
    steps, lanes = x.shape
    both = np.stack([x.astype(np.int64), x[::-1].astype(np.int64) + 256], axis=1)
    hs = np.zeros((steps + 1, 2, lanes, HIDDEN), np.float32)
    kept = []
    total = np.zeros((steps, lanes, len(net.languages)), np.float32) + net.bias
    for t in range(steps):
        h, g = hs[t], net.table[both[t]]
        zr = _sigmoid(g[..., : 2 * HIDDEN] + h @ net.gates)
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        c = h @ net.candidate
        n = np.tanh(g[..., 2 * HIDDEN :] + r * c)
        hs[t + 1] = h + z * (n - h)
        kept.append((z, r, c, n))
        v = hs[t + 1] @ net.out
        total[t] += v[0]
        total[steps - 1 - t] += v[1]
    d = _softmax(total)
    d[:, np.arange(lanes), y] -= 1
    d *= weight[..., None] / weight.sum()
    grads = [np.zeros_like(p) for p in net.parameters()]
    g_table, g_gates, g_candidate, g_out, g_bias = grads
    g_bias += d.sum((0, 1))
    dh = np.zeros((2, lanes, HIDDEN), np.float32)
    for t in reversed(range(steps)):
        dy = np.stack([d[t], d[steps - 1 - t]])
        g_out += hs[t + 1].transpose(0, 2, 1) @ dy
        dh = dh + dy @ net.out.transpose(0, 2, 1)
        z, r, c, n = kept[t]
        h = hs[t]
        dn = dh * z * (1 - n * n)
        dz = dh * (n - h) * z * (1 - z)
        dr = dn * c * r * (1 - r)
        dc = dn * r
        dzr = np.concatenate([dz, dr], axis=-1)
        g_gates += h.transpose(0, 2, 1) @ dzr
        g_candidate += h.transpose(0, 2, 1) @ dc
        np.add.at(g_table, both[t], np.concatenate([dzr, dn], axis=-1))
        dh = dh * (1 - z) + dzr @ net.gates.transpose(0, 2, 1) + dc @ net.candidate.transpose(0, 2, 1)
    return grads


def train(windows: np.ndarray, weight: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Adam over shuffled batches. windows: bytes, [n, WINDOW]; weight: 1 where there is a byte; labels: [n]."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    net = Network(languages, draw(512, 3 * HIDDEN), draw(2, HIDDEN, 2 * HIDDEN), draw(2, HIDDEN, HIDDEN), draw(2, HIDDEN, len(languages)), np.zeros(len(languages), np.float32))
    first, second = ([np.zeros_like(p) for p in net.parameters()] for _ in range(2))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), BATCH)
        rate = RATE * min(1, step / 10) * (1 - 0.9 * step / steps)
        for p, g, m, v in zip(net.parameters(), _gradients(net, windows[pick].T, labels[pick], weight[pick].T), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _windows(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of some texts end on end: (bytes [n, WINDOW], zero after a text's end; bytes in each; text of each)."""
    size = np.diff(docs)
    count = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), count)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = docs[:-1][owner] + rank * WINDOW
    length = np.minimum(docs[1:][owner] - start, WINDOW)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    x = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start].copy()
    x[np.arange(WINDOW) >= length[:, None]] = 0
    return x, length, owner


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def probabilities(net: Network, texts: list[str]) -> np.ndarray:
    """Mean over all positions of each text; rows of empty texts are zero."""
    coded = [t.encode("utf-8") for t in texts]
    out = np.zeros((len(texts), len(net.languages)))
    first = 0
    while first < len(coded):
        last, total = first + 1, len(coded[first])
        while last < len(coded) and total + len(coded[last]) <= LANES * WINDOW * 2:
            total += len(coded[last])
            last += 1
        docs = np.concatenate([[0], np.cumsum([len(c) for c in coded[first:last]])])
        x, length, owner = _windows(np.frombuffer(b"".join(coded[first:last]), np.uint8), docs)
        for k in range(0, len(x), LANES):
            lanes = slice(k, k + LANES)
            p = _softmax(net.logits(np.ascontiguousarray(x[lanes].T)), 1)
            p *= (np.arange(WINDOW)[:, None] < length[lanes])[:, None]
            np.add.at(out, first + owner[lanes], p.sum(0).T)
        out[first:last] /= np.maximum(np.diff(docs), 1)[:, None]
        first = last
    return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS) -> Network | None:
    """Train on about `sample` of the labelled rows of docs, as many of each language, chosen by a hash of id and text.

    A language's rows are counted first; then each row knows by itself whether it's in the sample, so that none meet in a task.
    """
    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages, parts = sorted(counts), 1 << 30
    most = F.map_from_arrays(F.array(*map(F.lit, languages)), F.array(*[F.lit(math.ceil(parts * min(1.0, max(1, sample // len(languages)) / counts[x]))) for x in languages]))
    known = known.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(3)), F.lit(parts)) < F.element_at(most, F.col("lang")))
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int") + 1
    cut = known.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", *[F.substr("text", place(k), F.lit(WINDOW)).alias(f"w{k}") for k in range(WINDOWS_PER_DOC)]).distinct()
    rows = [(w, r.lang) for r in sorted(cut.collect(), key=lambda r: (r.lang, r[0], r[2:])) for w in r[2:] if w]
    if not rows:
        return None
    coded = [w.encode("utf-8")[:WINDOW] for w, _ in rows]
    x = np.frombuffer(b"".join(c.ljust(WINDOW, b"\0") for c in coded), np.uint8).reshape(-1, WINDOW)
    weight = (np.arange(WINDOW) < np.array([len(c) for c in coded])[:, None]).astype(np.float32)
    return train(x, weight, np.array([languages.index(lang) for _, lang in rows]), languages)


def predict(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row; one narrow pass over whole texts."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        net = shared.value
        for b in batches:
            texts = [t if has_letter(t) else "" for t in b.column("text").to_pylist()] if net else [""] * b.num_rows
            p = probabilities(net, texts) if net else np.zeros((len(texts), 1))
            best = p.argmax(1)
            names = [net.languages[k] if t else "und" for k, t in zip(best, texts)]
            score = np.where([bool(t) for t in texts], np.minimum(p.max(1), 1), 0) if len(texts) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(score.astype(float))], ["doc_id", "lang_pred", "score"])

    return picked.mapInArrow(run, f"doc_id {dict(picked.dtypes)['doc_id']}, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
