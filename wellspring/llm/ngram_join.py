"""N-gram Jaccard self-join: MinHash bands find candidates, full n-gram sets verify them.

1. Every text becomes its set of five-word shingles (64-bit hashes) and BANDS band hashes of ROWS minima each; texts
   with the same set are one class from here on, found by a partial aggregate on the set's 128-bit digest.
2. Band hashes are shuffled; classes that share one are candidates. Buckets are kept as stars, never as pairs, and
   their connected components tell which sets may meet.
3. Full sets are verified in units: a bucket is one, where its pairs count in the first band that they share; or, where the
   buckets of a component overlap so much that comparing all its classes once is less work (groups of near copies), the
   component is. The classes of a unit are dealt to blocks, bounded in classes and bytes, and every pair of blocks is
   compared by matrix products that return, for each class, how many documents it links to and one edge of a spanning
   forest: rows in proportion to the classes, not to the pairs. A large unit becomes many equal tasks.
4. The forest's components are the groups.

A pair is missed only if no band has the same hash: at the threshold of 0.8, 20 bands of 5 miss one pair in 2800, fewer
above it.

Defined results: every row is a document of its own, whatever its id, so repeated rows link to one another and rows with a
null id take part; a text of one to four words has one shingle, all its words; a text without words, or null, links to
nothing; a very long text is one set like any other; pairs exactly at the threshold link; class_id is the group's smallest
id that is not null, else null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.llm._common import Words, connected_components, mix, table, word_batches
from wellspring.session import materialize, release, ship

N = 5
THRESHOLD = 0.8
#: A unit of n classes is dealt to blocks of max(BLOCK, 2 * sqrt(n)) classes, at most LARGEST_BLOCK, and of BLOCK_BYTES of sets.
BLOCK, LARGEST_BLOCK, BLOCK_BYTES = 64, 2048, 8 << 20
#: Shingles that a matrix product takes at once.
COLUMNS = 2048
KEY = "struct<i:bigint,h:bigint,g:int>"
UNIT = "struct<unit:bigint,band:int,blocks:int>"
LINKS = "node bigint, root bigint, links bigint"


def bands_and_rows(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """The most rows a band (fewest chance candidates) with which a pair at the threshold still shares a band with this probability."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no bands reach this recall")


def shingles(w: Words, k: int, n: int = N) -> np.ndarray:
    """The distinct shingle hashes of text k, in order."""
    h = w.hashes[w.bounds[k] : w.bounds[k + 1]]
    if not len(h):
        return h
    width = min(n, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        total = mix(total + h[i : len(h) - width + 1 + i] + np.uint64(i + 1))
    return np.unique(total)


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _signature(s: np.ndarray, bands: int, rows: int, multipliers: np.ndarray) -> np.ndarray:
    """Band hashes of a shingle set: minima under random odd multipliers, `rows` of them mixed into each band."""
    low = np.empty(len(multipliers), np.uint64)
    for k, m in enumerate(multipliers):
        low[k] = (s * m).min()
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        out = mix(out + low.reshape(bands, rows)[:, r])
    return out


def _digest(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return s.sum(dtype=np.uint64) ^ np.uint64(len(s)), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and key: id and two hashes of the text. Rows with one key are copies of one document."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.withColumn("key", _key("doc_id", "text"))


def _key(id_col: str, text_col: str) -> Column:
    """As one struct: nulls inside it are equal."""
    text = F.col(text_col).cast("string")
    return F.struct(F.col(id_col).cast("long").alias("i"), F.xxhash64(text).alias("h"), F.hash(text).alias("g"))


def signatures(docs: DataFrame, bands: int, rows: int, n: int = N) -> DataFrame:
    """key, d1, d2 (digest of the shingle set), n_shingles and the array bands of every row of _documents(); one narrow pass."""
    ship(docs.sparkSession)
    multipliers = _multipliers(bands * rows)

    def run(batches):
        for b in batches:
            d1, d2, size, hashes = [], [], [], []
            for _, w in word_batches(b.column("text")):
                for k in range(len(w.docs) - 1):
                    s = shingles(w, k, n)
                    x, y = _digest(s)
                    d1.append(x), d2.append(y), size.append(len(s))
                    hashes.append(_signature(s, bands, rows, multipliers) if len(s) else np.zeros(0, np.uint64))
            places = np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int32)
            flat = np.concatenate(hashes).view(np.int64) if hashes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array(np.array(d1, np.uint64).view(np.int64)), pa.array(np.array(d2, np.uint64).view(np.int64)), pa.array(np.array(size, np.int32)), pa.ListArray.from_arrays(pa.array(places), pa.array(flat))],
                ["key", "d1", "d2", "n_shingles", "bands"],
            )
        release()

    return docs.select("key", "text").mapInArrow(run, f"key {KEY}, d1 bigint, d2 bigint, n_shingles int, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """wanted (key, node, d1, d2, ...) with the column `s`, the node's shingle set as bytes; a node of repeated rows once a task."""
    kept = ("node", "copies", "units", "bands")

    def run(batches):
        seen = set()
        for b in batches:
            keep, out = [], []
            d1, d2, node = (b.column(c).to_numpy() for c in ("d1", "d2", "node"))
            for first, w in word_batches(b.column("text")):
                for k in range(len(w.docs) - 1):
                    if node[first + k] in seen:
                        continue
                    s = shingles(w, k, n)
                    x, y = _digest(s)
                    if x.astype(np.int64) == d1[first + k] and y.astype(np.int64) == d2[first + k]:
                        seen.add(node[first + k])
                        keep.append(first + k)
                        out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(keep, pa.int64())) for c in kept), pa.array(out, pa.binary())], [*kept, "s"])
        release()

    return docs.join(wanted, "key").select(*kept, "d1", "d2", "text").mapInArrow(run, f"node bigint, copies bigint, units array<{UNIT}>, bands array<bigint>, s binary")


def _compare(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which sets of `left` and `right` (indices) have at least this Jaccard similarity."""
    size = np.array([len(s) for s in sets], np.float64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size.astype(int))
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1  # the others only add to the sizes
    place = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], place[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(left), len(right)), np.float64)
    width = int(shared.sum())
    for first in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, width - first)), np.float32)
        m[owner[a:b], column[a:b] - first] = 1
        both += m[left] @ m[right].T
    return both >= threshold * (size[left][:, None] + size[right][None, :] - both) - 1e-9


def _verify(threshold: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, band, low, high = key
        rows = rows.sort_values("node").drop_duplicates("node")
        node, copies, block = rows["node"].to_numpy(), rows["copies"].to_numpy(), rows["block"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in rows["s"]]
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        if not len(left) or not len(right):
            return pd.DataFrame({"node": node[:0], "root": node[:0], "links": copies[:0]})
        alike = _compare(sets, left, right, threshold)
        if low == high:
            np.fill_diagonal(alike, False)
        if band > 0:  # a pair that shares an earlier band counts there
            bands = np.stack(rows["bands"].to_list())
            for k in range(band):
                alike &= bands[left, k][:, None] != bands[right, k][None, :]
        links = np.zeros(len(node), np.int64)
        links[left] += alike @ copies[right]
        if low != high:
            links[right] += alike.T @ copies[left]
        root = np.arange(len(node))
        i, j = (x[k] for x, k in zip((left, right), np.nonzero(alike)))
        while True:  # smallest label over links until nothing changes
            before = root.copy()
            np.minimum.at(root, i, before[j])
            np.minimum.at(root, j, before[i])
            root = root[root]
            if (root == before).all():
                break
        some = links > 0
        return pd.DataFrame({"node": node[some], "root": node[root[some]], "links": links[some]})

    return run


def _units(same: DataFrame) -> DataFrame | None:
    """node and units: where each class that shares a band with another is compared. None if none does."""
    members = same.select("node", "n_shingles", F.posexplode("bands").alias("band", "hash"))
    members = materialize(members.select("node", "n_shingles", "band", F.xxhash64("band", "hash").alias("bucket")), "bands")
    buckets = members.groupBy("bucket").agg(F.min("node").alias("b"), F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).where("n > 1")
    buckets = materialize(buckets, "buckets")
    if buckets.isEmpty():
        return None
    members = materialize(members.join(buckets, "bucket").select("node", "bucket", "band", "b", "n", "shingles"), "members")
    parts = materialize(connected_components(members.where("node <> b").select(F.col("node").alias("a"), "b")), "candidates")
    # How many pairs a component has, and how many its buckets have, those in several buckets as often.
    sizes = parts.join(same.select("node", "n_shingles"), "node").groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    overlap = buckets.join(parts, F.col("b") == F.col("node")).groupBy("root").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    sizes = materialize(sizes.join(overlap, "root").withColumn("by_bucket", (F.col("n") > BLOCK) & (F.col("pairs") < F.col("n").cast("double") * F.col("n"))), "sizes")
    per_block = F.least(F.greatest(F.lit(float(BLOCK)), 2 * F.sqrt("n")), F.lit(float(LARGEST_BLOCK)))
    blocks = F.greatest(F.ceil(F.col("n") / per_block), F.ceil(8 * F.col("shingles") / BLOCK_BYTES)).cast("int").alias("blocks")
    whole = parts.join(sizes.where("not by_bucket"), "root").select("node", F.struct(F.col("root").alias("unit"), F.lit(-1).alias("band"), blocks).alias("u"))
    dealt = members.join(parts, "node").join(sizes.where("by_bucket").select("root"), "root", "left_semi")
    units = whole.union(dealt.select("node", F.struct(F.col("bucket").alias("unit"), "band", blocks).alias("u")))
    return units.groupBy("node").agg(F.sort_array(F.collect_list("u")).alias("units"))


def _known(docs: DataFrame, threshold: float, recall: float, n: int) -> tuple[DataFrame, DataFrame]:
    """From _documents(): key, d1, d2 and n_shingles of every row; and of every class its digest, node, root (of its group),
    links, copies, and the key of its first row. Nodes are numbered by their smallest id, so a group's root has its smallest."""
    bands, rows = bands_and_rows(threshold, recall)
    every = materialize(signatures(docs, bands, rows, n), "signatures")
    first = F.struct(F.col("key.i").isNull().alias("none"), "key", "n_shingles", "bands")
    same = every.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min(first).alias("x"), F.count("*").alias("copies"))
    same = same.select("d1", "d2", "copies", "x.key", "x.n_shingles", "x.bands").orderBy(F.asc_nulls_last("key.i"), "d1", "d2")
    same = materialize(same.withColumn("node", F.monotonically_increasing_id()), "classes")
    units = _units(same)
    if units is None:
        found = docs.sparkSession.createDataFrame([], LINKS)
    else:
        wanted = units.join(same, "node").select("key", "node", "copies", "d1", "d2", "units", F.when(F.exists("units", lambda u: u["band"] > 0), F.col("bands")).alias("bands"))
        met = _sets(docs, wanted, n).withColumn("u", F.explode("units")).select("node", "copies", "bands", "s", "u.*")
        met = met.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.select("unit", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "copies", F.when(F.col("band") > 0, F.col("bands")).alias("bands"), "s")
        found = materialize(met.groupBy("unit", "band", "low", "high").applyInPandas(_verify(threshold), LINKS), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = same.join(links, "node", "left").join(groups, "node", "left")
    known = known.select("d1", "d2", "node", "copies", "key", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    return every, materialize(known, "known")


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = 0.9996, n: int = N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_links, copy_of and n_shingles: one row for each row of docs.

    class_id is the smallest doc_id that links reach; n_links counts the rows, copies among them, whose
    similarity to this one is at least the threshold; copy_of is the smallest doc_id with the same shingle set.
    """
    every, known = _known(_documents(docs, id_col, text_col), threshold, recall, n)
    # The root's id, met by a join of two written tables, so that the members of a large group can be split.
    named = known.join(known.select(F.col("node").alias("root"), F.col("key.i").alias("class_id")), "root")
    named = materialize(named.select("d1", "d2", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("key.i").alias("copy_of")), "named")
    out = every.select(F.col("key.i").alias("doc_id"), "d1", "d2", "n_shingles").join(named, ["d1", "d2"], "left")
    some = F.col("n_shingles") > 0
    return out.select(
        "doc_id",
        F.when(some, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(some, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        F.when(some, F.col("copy_of")).otherwise(F.col("doc_id")).alias("copy_of"),
        F.col("n_shingles").cast("long").alias("n_shingles"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


def without_copies(docs: DataFrame, threshold: float = THRESHOLD, recall: float = 0.9996, n: int = N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' columns: of each group one row, a row of its root class; every row that links to nothing, wordless ones too."""
    columns = docs.columns
    every, known = _known(_documents(docs, id_col, text_col), threshold, recall, n)
    rows = every.groupBy("key").agg(F.count("*").alias("rows"), F.max("n_shingles").alias("n_shingles"))
    roots = known.where("node = root").select("key", F.lit(True).alias("root"))
    kept = rows.join(roots, "key", "left").where("root OR n_shingles = 0")
    kept = materialize(kept.select("key", ((F.col("rows") == 1) | (F.col("n_shingles") == 0)).alias("all")), "kept")
    # docs' own columns are held in a struct, so that their names can't clash.
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), _key(id_col, text_col).alias("key"))
    plain = held.join(kept.where("all").select("key"), "key", "left_semi").select("row")
    repeated = held.join(kept.where("not all").select("key"), "key", "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row")
    return plain.union(repeated).select(*[F.col("row")[c].alias(c) for c in columns])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs without near-duplicates."""
    return without_copies(docs)
