"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.session import materialize

#: Bytes that separate words: space and \x09 to \x0D. A word is [^\x20\x09-\x0D]+.
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True

_PRIME = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_PRIME, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 3; 1 marks the held-out documents."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 18)
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, p, np.uint64)])) for p in (_PRIME, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that close inputs have unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts: bytes, word starts and ends in them, the text of each word, 64-bit word hashes."""

    def __init__(self, data: np.ndarray, docs: np.ndarray):
        """data: the texts' UTF-8 bytes on end; docs: where each starts, and the end."""
        n = len(data)
        word = ~_SEPARATOR[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        inner = docs[:-1]
        at = inner[inner < n]
        first[at] = word[at]
        before = at[at > 0] - 1
        last[before] = word[before]
        self.data, self.docs = data, docs
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        #: Word w of text k: bounds[k] <= w < bounds[k + 1].
        self.bounds = np.searchsorted(self.starts, docs)
        power, inverse = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        self.hashes = mix((total[self.ends] - total[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_batches(texts: pa.Array, most: int = 1 << 18):
    """Yields (first text, Words) over runs of texts of about `most` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type)
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    k = 0
    while k < n:
        stop = max(k + 1, int(np.searchsorted(offsets, offsets[k] + most, "right")) - 1)
        yield k, Words(data[offsets[k] : offsets[stop]], offsets[k : stop + 1] - offsets[k])
        k = stop


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node that can be reached.

    Alternating large-star and small-star: each round hangs a node's larger neighbours, then its smaller
    ones, on the smallest. Every step is a grouped minimum and an equi-join, so nothing is gathered on
    the driver, and a hub's edges can be split between tasks. The rounds grow with the logarithm of
    the largest component. Each round's edges are written to the shared folder.
    """
    spark = edges.sparkSession
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    seen = mark(e)
    for _ in range(rounds):
        if not seen[0]:
            break
        near = e.union(e.select("b", "a"))
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Written first: then both sides are exchanged for this join alone, and a hub's edges can be split between tasks.
        low = materialize(low, "low")
        e = near.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        e = materialize(e, "edges")
        if (now := mark(e)) == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)
