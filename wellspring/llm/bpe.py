"""Byte-level BPE: encoding by overlapping chunks, and decoding.

Long texts are cut into overlapping chunks, which are dealt to all tasks and pre-tokenised as rows of their own. A
chunk's first boundaries may be wrong, as it may start inside a pre-token; but the pattern looks only forward,
so from the first boundary that it shares with the chunk before, both agree. There the chunks are stitched, and
the pieces between stitches are dealt to all tasks again and encoded as rows of their own; their ids are put on end.
Decoding puts the tokens' raw bytes on end.

Defined results: a null text counts as empty, an empty text has no tokens; a text of any length is encoded whole, and has
to fit in one row, as do its ids; of equal ranks in a piece the leftmost is merged first; ids are unsigned 32-bit integers
in little-endian bytes; repeated rows are each encoded; an empty table gives an empty result; other columns are ignored, or
kept by decode(), where a column named `decoded` is replaced.
"""

from __future__ import annotations

import base64
import bisect
import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from wellspring.llm._common import table
from wellspring.session import materialize, release, ship

CHUNK = 32_768
OVERLAP = 512
#: A boundary nearer than this to a chunk's end may change once more text is seen (contractions look so far ahead).
MARGIN = 16
CACHE = 1 << 16
_MADE: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one piece, lowest rank first and then leftmost; a heap keeps long pieces near-linear."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(i: int) -> None:
        if after[i] < n and (r := ranks.get(piece[i : end[after[i]]])) is not None:
            heapq.heappush(heap, (r, i, end[after[i]]))

    for i in range(n):
        offer(i)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Encoder:
    """Pre-tokens to ids with a bounded cache; the merges run in tiktoken's compiled core where it is installed (with a pattern
    that takes a piece whole), else in merge()."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.pattern, self.ranks, self.cache = regex.compile(pattern), ranks, {}
        try:
            import tiktoken

            self.one = tiktoken.Encoding("ranks", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        except ImportError:
            self.one = lambda piece: merge(piece.encode("utf-8"), ranks)

    def encode(self, pieces: list[str]) -> list[int]:
        cache, out = self.cache, []
        for p in pieces:
            ids = cache.get(p)
            if ids is None:
                if len(cache) >= CACHE:
                    cache.clear()
                ids = cache[p] = self.one(p)
            out += ids
        return out

    def starts(self, text: str) -> np.ndarray:
        """Where each pre-token of text starts."""
        return np.fromiter((m.start() for m in self.pattern.finditer(text)), np.int64)


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each token, by its id."""
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def join_bytes(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encoder(shared) -> Encoder:
    """This Python worker's encoder for the broadcast (name, ranks, pattern)."""
    name, ranks, pattern = shared.value
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = Encoder(ranks, pattern)
    return _MADE[name]


def stitch(chunks: list[tuple[int, str, np.ndarray]], encoder: Encoder) -> list[list[str]]:
    """The pre-tokens of a text from its chunks in order: (start, text, starts of pre-tokens in that text).

    A list for each stretch between two stitches. Where two chunks share no boundary in their overlap (a
    run longer than it), the text is pre-tokenised on from the last sure boundary until it meets one
    of a later chunk.
    """
    ends = [start + len(text) for start, text, _ in chunks]
    full = "".join(text[: (chunks[k + 1][0] - start) if k + 1 < len(chunks) else None] for k, (start, text, _) in enumerate(chunks))
    bounds = [start + starts for start, _, starts in chunks]
    out, k, at = [], 0, 0

    def cut(b: np.ndarray) -> list[str]:
        return [full[i:j] for i, j in zip(b[:-1].tolist(), b[1:].tolist())]

    while True:
        mine = bounds[k][np.searchsorted(bounds[k], at) :]
        if k == len(chunks) - 1:
            out.append(cut(np.append(mine, len(full))))
            return out
        sure = mine[mine <= ends[k] - MARGIN]
        shared = np.intersect1d(sure, bounds[k + 1], assume_unique=True)
        if len(shared):
            out.append(cut(mine[: np.searchsorted(mine, shared[0]) + 1]))
            k, at = k + 1, int(shared[0])
            continue
        if len(sure):
            out.append(cut(sure))
            at = int(sure[-1])
        pieces, later = [], k + 1
        for m in encoder.pattern.finditer(full, at):
            b = m.start()
            while later < len(chunks) - 1 and b > ends[later] - MARGIN:
                later += 1
            i = bisect.bisect_left(bounds[later], b)
            if b > at and i < len(bounds[later]) and bounds[later][i] == b and (b <= ends[later] - MARGIN or later == len(chunks) - 1):
                at = b
                break
            pieces.append(m.group())
        else:
            out.append(pieces)
            return out
        out.append(pieces)
        k = later


def _share(spark, path: str, pattern: str):
    """Ranks (under 2 MB for 50,000 tokens) and pattern as a broadcast variable; executors need no file."""
    ship(spark)
    return spark.sparkContext.broadcast((f"{path} {pattern}", read_ranks(path), pattern))


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id and ids (binary) of every row. Texts within one chunk never move; chunks of longer ones go to any task, meet there
    to be stitched, and their pieces go to any task again."""
    shared = _share(docs.sparkSession, path, pattern)
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = dict(t.dtypes)["doc_id"]

    def whole(batches):
        e = encoder(shared)
        for b in batches:
            ids = [_packed(e.encode(e.pattern.findall(x.as_py()))) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])
        release()

    def cut(batches):
        for b in batches:
            for row, text in zip(b.column("row"), b.column("text")):
                text = text.as_py()
                starts = list(range(0, len(text) - overlap, chunk - overlap))
                for k in range(0, len(starts), 16):
                    some = starts[k : k + 16]
                    yield pa.RecordBatch.from_arrays([pa.array([row.as_py()] * len(some), pa.int64()), pa.array(some, pa.int32()), pa.array([text[a : a + chunk] for a in some], pa.string())], ["row", "start", "text"])
        release()

    def bounds(batches):
        e = encoder(shared)
        for b in batches:
            starts = [e.starts(x.as_py()).astype("<i4").tobytes() for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(starts, pa.binary())], [*b.schema.names, "starts"])
        release()

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        e = encoder(shared)
        rows = rows.sort_values("start")
        chunks = [(int(s), x, np.frombuffer(b, "<i4").astype(np.int64)) for s, x, b in zip(rows["start"], rows["text"], rows["starts"])]
        parts = stitch(chunks, e)
        ends = [np.cumsum([len(p) for p in pieces], dtype="<i4").tobytes() for pieces in parts]
        return pd.DataFrame({"row": rows["row"].iloc[0], "part": range(len(parts)), "text": ["".join(pieces) for pieces in parts], "ends": ends})

    def pieces(batches):
        e = encoder(shared)
        for b in batches:
            ids = []
            for text, ends in zip(b.column("text"), b.column("ends")):
                text, ends = text.as_py(), np.frombuffer(ends.as_py(), "<i4").tolist()
                ids.append(_packed(e.encode([text[i:j] for i, j in zip([0, *ends], ends)])))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("part"), pa.array(ids, pa.binary())], ["row", "part", "ids"])
        release()

    def on_end(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        return pa.table({"doc_id": rows.column("doc_id").slice(0, 1), "ids": pa.array([b"".join(x.as_py() for x in rows.column("ids") if x.is_valid)], pa.binary())})

    long = F.length("text") > chunk
    short = t.where(~long).mapInArrow(whole, f"doc_id {kind}, ids binary")
    # Numbered once and written, so that a number never comes to name another row.
    rows = materialize(t.where(long).withColumn("row", F.monotonically_increasing_id()), "long")
    chunks = rows.select("row", "text").mapInArrow(cut, "row bigint, start int, text string").repartition("row", "start")
    met = chunks.mapInArrow(bounds, "row bigint, start int, text string, starts binary").groupBy("row").applyInPandas(meet, "row bigint, part int, text string, ends binary")
    coded = met.repartition("row", "part").mapInArrow(pieces, "row bigint, part int, ids binary")
    # Every text's number and id as part -1, so that the ids' pieces meet its doc_id without another join.
    named = rows.select("row", "doc_id", F.lit(-1).alias("part"), F.lit(None).cast("binary").alias("ids"))
    return short.union(named.unionByName(coded.withColumn("doc_id", F.lit(None).cast(kind))).groupBy("row").applyInArrow(on_end, f"doc_id {kind}, ids binary"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded with a column `decoded`, the bytes of its ids."""
    shared = _share(encoded.sparkSession, path, pattern)
    encoded = encoded.drop("decoded")
    place = encoded.columns.index("ids")

    def run(batches):
        tokens = token_bytes(shared.value[1])
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([join_bytes(x.as_py(), tokens) for x in b.column(place)], pa.binary())], [*b.schema.names, "decoded"])
        release()

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    import public_tokenizers

    path, pattern = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    both = decode(encode(docs, path, pattern), path, pattern)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents")).drop("ids")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests and the ids of every row of docs."""
    return digests(docs)
