"""Exact top-k search by inner product with a KD-tree in each shard.

Vectors are dealt to cells by median splits of a bounded sample, and within a cell to shards by a hash; each shard builds a
KD-tree by median splits and keeps, for every node, the tight bounding box of its points. A query descends best-first: a
box's upper bound is the sum over dimensions of the larger product with either side, and nodes below the k-th score so far
are never opened. Each query is first searched in its own shard; the k-th score found there goes with it, and it's sent on
only to cells whose box can hold as good a score.

Defined results: vectors that are null or hold a null or non-finite component take no part; a query meets only vectors
of its own length, however long; rows with the same id are one vector, the smallest; ties go to the smaller id; fewer than
k candidates are all returned; scores are held within 64 bits, beyond which their order is that of the exact ones; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm._common import table
from wellspring.session import materialize, ship

SHARD_ROWS = 16_384
QUERY_BLOCK = 32_768
#: Bounds of the splits: cells, and the rows and bytes of the sample that they're fitted on. Boxes of all cells, of at most
#: BOX_BYTES, go to the tasks that send queries on.
CELLS, SAMPLE_ROWS, SAMPLE_BYTES, BOX_BYTES = 4096, 16_384, 32 << 20, 32 << 20
LEAF = 128
SCALE = 1024


class Tree:
    """points: [n, d] whole numbers as float64; ids: [n]."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.points, self.ids = points, ids
        self.low, self.high, self.children, self.span = [], [], [], []
        order = np.arange(len(points))
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            me = len(self.low)
            part = points[order[a:b]]
            low, high = part.min(0), part.max(0)
            self.low.append(low), self.high.append(high), self.children.append([]), self.span.append((a, b))
            if parent >= 0:
                self.children[parent].append(me)
            if b - a > leaf and (high > low).any():
                axis, half = int((high - low).argmax()), (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, axis], half)]
                todo += [(a, a + half, me), (a + half, b, me)]
        self.points, self.ids = points[order], ids[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, nodes: list[int], q: np.ndarray) -> np.ndarray:
        return np.maximum(self.low[nodes] * q, self.high[nodes] * q).sum(1)

    def search(self, q: np.ndarray, own: int, k: int, least: float = -math.inf) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best, but for `own`; those below `least` may be left out."""
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        heap = [(-b, n) for b, n in zip(self.bounds([0], q), [0])]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:  # equal ones go on: a smaller id may win the tie
                break
            if self.children[node]:
                below = self.children[node]
                for b, n in zip(self.bounds(below, q).tolist(), below):
                    if b >= least:
                        heapq.heappush(heap, (-b, n))
                continue
            a, b = self.span[node]
            s, ids = self.points[a:b] @ q, self.ids[a:b]
            good = (s >= least) & (ids != own)
            if good.any():
                best, best_ids = np.concatenate([best, s[good]]), np.concatenate([best_ids, ids[good]])
                if len(best) > k:
                    top = np.lexsort((best_ids, -best))[:k]
                    best, best_ids = best[top], best_ids[top]
                if len(best) == k:
                    least = max(least, best.min())
        return best_ids, best


def _exact(points: np.ndarray, ids: np.ndarray, q: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """By Python's integers, where a product sum could exceed what float64 holds exactly; scores are held within 64 bits."""
    whole = [int(x) for x in q]
    scores = sorted((-sum(int(a) * b for a, b in zip(p, whole)), int(i)) for p, i in zip(points, ids) if i != own)
    return [(i, max(-(2**63), min(2**63 - 1, -s))) for s, i in scores[:k]]


def _search(k: int):
    """Of one shard; all its vectors are of one length, whole numbers."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(vectors) and len(queries):
            points, ids, qs = np.stack(vectors["v"].to_numpy()), vectors["vec_id"].to_numpy(), np.stack(queries["q"].to_numpy())
            safe = points.shape[1] * max(1.0, np.abs(points).max(initial=0)) * max(1.0, np.abs(qs).max(initial=0)) < 2**52
            tree = Tree(points, ids) if safe else None
            for own, q, least in zip(queries["q_id"].to_numpy(), qs, queries["least"].to_numpy()):
                if tree:
                    found, scores = tree.search(q, own, k, least if least == least else -math.inf)
                    out += [(own, i, int(s)) for i, s in zip(found, scores)]
                else:
                    out += [(own, i, s) for i, s in _exact(points, ids, q, own, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


class Splits:
    """Cells of vectors of one length: median splits of a sample, the fullest cell first, along its widest dimension."""

    def __init__(self, sample: np.ndarray, cells: int):
        #: A node is (axis, cut, low child, high child), or a cell's number.
        self.nodes: list = [0]
        self.cells = 1
        heap = [(-len(sample), 0, np.arange(len(sample)))]
        while heap and self.cells < cells:
            _, node, rows = heapq.heappop(heap)
            part = sample[rows]
            spread = np.ptp(part, axis=0) if len(part) > 1 and part.shape[1] else np.zeros(1)
            axis = int(spread.argmax())
            if not spread[axis]:
                continue
            cut = np.median(part[:, axis])
            low = part[:, axis] < cut if (part[:, axis] < cut).any() else part[:, axis] <= cut
            cut = part[low, axis].max()  # to the low side: up to this value
            below, above = len(self.nodes), len(self.nodes) + 1
            self.nodes += [self.nodes[node], self.cells]
            self.nodes[node] = (axis, cut, below, above)
            self.cells += 1
            for child, mine in ((below, rows[low]), (above, rows[~low])):
                heapq.heappush(heap, (-len(mine), child, mine))

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            at = self.nodes[node]
            if isinstance(at, tuple):
                low = points[rows, at[0]] <= at[1]
                todo += [(at[2], rows[low]), (at[3], rows[~low])]
            else:
                out[rows] = at
        return out


def _by_length(rows: pd.Series) -> list[tuple[int, np.ndarray]]:
    size = rows.map(len).to_numpy()
    return [(int(d), np.flatnonzero(size == d)) for d in np.unique(size)]


def _splits(vectors: DataFrame, shards: int, longest: int) -> dict[int, Splits]:
    """By length, from a bounded sample: the first rows by a hash of their ids."""
    cells = max(1, min(shards, CELLS, BOX_BYTES // (16 * max(1, longest))))
    if cells == 1:
        return {}
    rows = vectors.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, longest))))).select("v").toPandas()["v"]
    return {d: Splits(np.stack(rows.iloc[at].to_numpy()), max(1, cells * len(at) // len(rows))) for d, at in _by_length(rows)}


def _boxes(placed: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: cells, and the least and largest components of each. Every task gives one row for each cell it has."""

    def run(batches):
        found: dict = {}
        for b in batches:
            for (d, cell), at in b.groupby(["d", "cell"]).indices.items():
                x = np.stack(b["v"].iloc[at].to_numpy())
                low, high = found.get((d, cell), (np.inf, -np.inf))
                found[d, cell] = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        for (d, cell), (low, high) in found.items():
            yield pd.DataFrame({"d": [d], "cell": [cell], "low": [low], "high": [high]})

    each = placed.mapInPandas(run, "d int, cell int, low array<double>, high array<double>")
    long = each.select("d", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("i", "x")).groupBy("d", "cell", "i").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    rows = long.groupBy("d", "cell").agg(F.sort_array(F.collect_list(F.struct("i", "low", "high"))).alias("x")).collect()  # bounded by BOX_BYTES
    out = {}
    for d in {r.d for r in rows}:
        mine = [r for r in rows if r.d == d]
        out[d] = np.array([r.cell for r in mine]), np.array([[x.low for x in r.x] for r in mine]), np.array([[x.high for x in r.x] for r in mine])
    return out


def _send(boxes: dict, subs: dict[tuple[int, int], int]):
    """Each query once for every shard, but its own, of the cells whose box can hold a score of `least` or more."""

    def run(batches):
        for b in batches:
            rows = []
            for q_id, q, d, cell, sub, least in b[["q_id", "q", "d", "cell", "sub", "least"]].itertuples(index=False):
                if d not in boxes or least != least:
                    near = [c for e, c in subs if e == d]
                else:
                    cells, low, high = boxes[d]
                    up, down = np.maximum(q, 0), np.minimum(q, 0)
                    slack = 1e-9 * (np.abs(high) @ up - np.abs(low) @ down) + 1e-9  # a bound is a sum of rounded products
                    near = cells[high @ up + low @ down + slack >= least]
                rows += [(q_id, q, d, int(c), s, least) for c in near for s in range(subs[d, int(c)]) if (c, s) != (cell, sub)]
                if len(rows) > 4096:
                    yield pd.DataFrame(rows, columns=["q_id", "q", "d", "cell", "sub", "least"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["q_id", "q", "d", "cell", "sub", "least"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score for every row where is_query (an expression over vec_id) holds."""
    spark = vectors.sparkSession
    ship(spark)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & F.forall("v", finite))
    v = materialize(v.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    n, asked, longest = v.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(asked / QUERY_BLOCK))
    splits = spark.sparkContext.broadcast(_splits(v, shards, longest or 0))

    def place(batches):
        for b in batches:
            values, cells = b["v"].to_list(), np.zeros(len(b), np.int32)
            for d, at in _by_length(b["v"]):
                x = np.stack([values[i] for i in at]).astype(np.float64)
                if d in splits.value:
                    cells[at] = splits.value[d].of(x)
                for i, row in zip(at, np.floor(scale * x)):
                    values[i] = row
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": values, "d": b["v"].map(len).astype("int32"), "cell": cells})

    placed = materialize(v.mapInPandas(place, "vec_id bigint, v array<double>, d int, cell int"), "placed")
    subs = {(r.d, r.cell): math.ceil(r.n / SHARD_ROWS) for r in placed.groupBy("d", "cell").agg(F.count("*").alias("n")).collect()}  # at most CELLS, and one for each length
    if not subs:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    parts = F.map_from_arrays(F.array(*[F.lit(d * 2**32 + c) for d, c in subs]), F.array(*[F.lit(x) for x in subs.values()])) if max(subs.values()) > 1 else None
    number = F.element_at(parts, F.col("d").cast("bigint") * 2**32 + F.col("cell")) if parts is not None else F.lit(1)
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("vec_id"), number).cast("int"))
    queries = placed.where(is_query).select(F.col("vec_id").alias("q_id"), F.col("v").alias("q"), "d", "cell", "sub")
    schema, shard = "query_id bigint, vec_id bigint, score bigint", ["d", "cell", "sub"]
    at_home = queries.withColumn("least", F.lit(None).cast("double"))
    found = materialize(placed.groupBy(*shard).cogroup(at_home.groupBy(*shard)).applyInPandas(_search(k), schema), "home")
    if sum(subs.values()) > 1:
        least = found.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).cast("double").alias("least"))
        asking = queries.join(least, F.col("q_id") == F.col("query_id"), "left").select("q_id", "q", *shard, "least")
        sent = asking.mapInPandas(_send(_boxes(placed), subs), "q_id bigint, q array<double>, d int, cell int, sub int, least double")
        # A shard that many queries go to is searched in blocks of them; its tree is built for each, a small part of the work.
        sent = sent.withColumn("block", F.pmod(F.xxhash64("q_id", F.lit(1)), F.lit(blocks)).cast("int"))
        every = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        found = found.union(every.groupBy(*shard, "block").cogroup(sent.groupBy(*shard, "block")).applyInPandas(_search(k), schema))
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
