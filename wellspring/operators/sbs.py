"""From spot intensities to called cells.

Per-tile statistics (channel medians, mixing matrices) are small aggregates joined back; base calls are array
expressions; the best barcodes of a cell come from one window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from wellspring.functions.barcodes import base_call, quality, substring_1based
from wellspring.functions.stats import with_group_stats
from wellspring.operators.joins import error_correct

TILE = ["plate", "well", "tile"]


def format_bases(spots: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    """Wide spot rows (a column for each channel) as one row for each channel."""
    return spots.unpivot([*keys], channels, "channel", "intensity")


def normalize_bases(bases: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Intensity over its channel's median in the tile."""
    out = with_group_stats(bases, [*(by if by is not None else TILE), "channel"], {"median_": F.percentile("intensity", 0.5)})
    return out.withColumn("intensity", F.try_divide(F.col("intensity"), F.col("median_"))).drop("median_")


def to_cycles(bases: DataFrame, channels: list[str], keys: list[str] | None = None) -> DataFrame:
    """One row for each read and cycle: x, the intensities in the order of channels (alphabetical is the convention)."""
    keys = keys or [*TILE, "read"]
    # Grouped on all keys with a fixed number of sums: a pivot without collecting lists.
    wide = bases.groupBy(*keys, "cycle").agg(F.min("cell").alias("cell"), F.min("i").alias("i"), F.min("j").alias("j"), *[F.max(F.when(F.col("channel") == c, F.col("intensity"))).alias(f"c_{c}") for c in channels])
    return wide.withColumn("x", F.array(*[F.coalesce(f"c_{c}", F.lit(0.0)).cast("double") for c in channels])).drop(*[f"c_{c}" for c in channels])


def _inverse_of(rows: list, n: int) -> np.ndarray:
    """Inverse of the column-normalised matrix of median vectors; the identity where it has none."""
    if any(r is None or len(r) != n for r in rows):
        return np.eye(n)
    m = np.array(rows, float)
    if m.shape != (n, n) or not np.isfinite(m).all():
        return np.eye(n)
    m = m.T
    total = m.sum(0)
    m = m / np.where(total == 0, 1, total)
    try:
        return np.linalg.inv(m)
    except np.linalg.LinAlgError:
        return np.eye(n)


@F.pandas_udf(ArrayType(ArrayType(DoubleType())))
def _invert(medians: pd.Series) -> pd.Series:
    """medians: for each channel, in order, the median intensities of its spots."""
    return pd.Series([_inverse_of(list(m), len(m)).tolist() for m in medians])


def mixing(cycles: DataFrame, n: int, by: list[str], method: str = "median", where: Column | None = None, quartile: float | None = None) -> DataFrame:
    """by and w, the correction matrix of each group.

    median: spots by their brightest channel, above the channel's quantile `quartile` where it's given. percentile: spots
    whose share of a channel is in that channel's top twentieth.
    """
    src = cycles if where is None else cycles.where(where)
    if method == "median":
        picked = src.withColumn("ch", (F.array_position("x", F.array_max("x")) - 1).cast("int"))
        if quartile:
            picked = with_group_stats(picked.withColumn("top_", F.array_max("x")), [*by, "ch"], {"cut_": F.percentile("top_", quartile)}).where("top_ >= cut_").drop("top_", "cut_")
    else:
        total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
        shares = src.withColumn("total_", total).select(*by, "x", F.posexplode(F.transform("x", lambda v: F.try_divide(v, F.col("total_")))).alias("ch", "share"))
        picked = with_group_stats(shares, [*by, "ch"], {"cut_": F.percentile("share", 0.95)}).where("share >= cut_").drop("cut_", "share")
    med = picked.groupBy(*by, "ch").agg(F.array(*[F.percentile(F.col("x")[k], 0.5) for k in range(n)]).alias("m"))
    rows = med.groupBy(*by).agg(*[F.max(F.when(F.col("ch") == k, F.col("m"))).alias(f"m{k}") for k in range(n)])
    return rows.select(*by, _invert(F.array(*[F.col(f"m{k}") for k in range(n)])).alias("w"))


def correct(cycles: DataFrame, matrices: DataFrame, n: int, by: list[str]) -> DataFrame:
    """W x for each spot, cut to whole numbers toward zero."""
    out = cycles.join(matrices, by, "left")
    dot = [sum((F.col("w")[r][c] * F.col("x")[c] for c in range(1, n)), F.col("w")[r][0] * F.col("x")[0]) for r in range(n)]
    whole = F.array(*[d.cast("long").cast("double") for d in dot])
    return out.withColumn("x", F.when(F.col("w").isNull(), F.col("x")).otherwise(whole)).drop("w")


def call_reads(bases: DataFrame, channels: list[str], method: str = "median", normalize: bool = False, only_in_cells: bool = True, by_cycle: bool = False, quartile: float | None = None, peaks: DataFrame | None = None) -> DataFrame:
    """One row for each read: barcode, the quality of each cycle (array q), q_min and, from peaks (i, j, peak), peak."""
    if normalize:
        bases = normalize_bases(bases)
    n = len(channels)
    cycles = to_cycles(bases, channels)
    by = [*TILE, "cycle"] if by_cycle else TILE
    if method != "none":
        matrices = mixing(cycles, n, by, method, (F.col("cell") > 0) if only_in_cells else None, quartile)
        cycles = correct(cycles, matrices, n, by)
    called = cycles.select(*TILE, "read", "cycle", "cell", "i", "j", base_call(F.col("x"), channels).alias("base"), quality(F.col("x")).alias("q"))
    # A read has as many cycles as the run: the list is bounded.
    listed = called.groupBy(*TILE, "read").agg(F.min("cell").alias("cell"), F.min("i").alias("i"), F.min("j").alias("j"), F.sort_array(F.collect_list(F.struct("cycle", "base", "q"))).alias("s"))
    reads = listed.select(*TILE, "read", "cell", "i", "j", F.array_join(F.transform("s", lambda s: s["base"]), "").alias("barcode"), F.transform("s", lambda s: s["q"]).alias("q"))
    reads = reads.withColumn("q_min", F.array_min("q"))
    return reads.join(peaks.select(*TILE, "i", "j", "peak"), [*TILE, "i", "j"], "left") if peaks is not None else reads


def prep_multi(reads: DataFrame, map_start: int, map_end: int, recomb_start: int | None = None, recomb_end: int | None = None) -> DataFrame:
    """prefix_map and prefix_recomb, cut from the barcode by cycles (from 1, both ends in), and the recombination part's worst quality."""
    out = reads.withColumn("prefix_map", substring_1based(F.col("barcode"), map_start, map_end))
    if recomb_start is None:
        return out
    out = out.withColumn("prefix_recomb", substring_1based(F.col("barcode"), recomb_start, recomb_end))
    return out.withColumn("q_recomb", F.array_min(F.slice("q", recomb_start, recomb_end - recomb_start + 1)))


def top_barcodes(reads: DataFrame, cell_keys: list[str], barcode: str = "barcode", n: int = 2, sort: str = "count", mapped: str | None = None, peak: str = "peak", tie: str = "read") -> DataFrame:
    """The n best barcodes of each cell as columns barcode_k and count_k or peak_k (k from 0), and n_reads.

    count: most reads first; peak: brightest read of each barcode first. Mapped ones go before the others. Ties go to
    the smaller barcode. Spark limits the windows before the shuffle.
    """
    keys = [*cell_keys, barcode]
    m = F.max(F.col(mapped).cast("int")) if mapped else F.lit(1)
    each = reads.groupBy(*keys).agg(F.count("*").alias("count"), F.max(peak).alias("peak") if peak in reads.columns else F.lit(None).cast("double").alias("peak"), m.alias("mapped_"))
    w = Window.partitionBy(*cell_keys).orderBy(F.desc("mapped_"), F.desc(sort), barcode)
    ranked = each.withColumns({"k_": F.row_number().over(w) - 1, "total_": F.sum("count").over(Window.partitionBy(*cell_keys))}).where(F.col("k_") < n)
    at = lambda c, k: F.max(F.when(F.col("k_") == k, F.col(c)))
    return ranked.groupBy(*cell_keys).agg(F.max("total_").alias("n_reads"), *[at(c, k).alias(f"{name}_{k}") for k in range(n) for c, name in ((barcode, "barcode"), (sort, sort))])


def call_cells(reads: DataFrame, library: DataFrame, q_min: float = 0.0, barcode: str = "barcode", prefix: str = "prefix", sort: str = "count", n: int = 2, correct_errors: bool = False, max_distance: int = 1, metric: str = "hamming", info: list[str] | None = None, cell_keys: list[str] | None = None) -> DataFrame:
    """One row for each cell (0 is background): its best n barcodes with what the library knows of them.

    Library keys must be unique, else cells would multiply.
    """
    cell_keys = cell_keys or [*TILE, "cell"]
    info = info if info is not None else [c for c in library.columns if c != prefix]
    if not library.groupBy(prefix).count().where("count > 1").isEmpty():
        raise ValueError(f"{prefix} is not unique in the library")
    good = reads.where((F.col("q_min") >= q_min) & (F.col("cell") > 0))
    if correct_errors:
        good = error_correct(good, library, barcode, prefix, max_distance, metric)
    known = library.select(F.col(prefix).alias(barcode), F.lit(1).alias("mapped_in"))
    good = good.join(known, barcode, "left").withColumn("mapped_in", F.coalesce("mapped_in", F.lit(0)))
    cells = top_barcodes(good, cell_keys, barcode, n, sort, "mapped_in")
    for k in range(n):
        named = library.select(F.col(prefix).alias(f"barcode_{k}"), *[F.col(c).alias(f"{c}_{k}") for c in info])
        cells = cells.join(named, f"barcode_{k}", "left")
    return cells


def no_recombination(reads: DataFrame, library: DataFrame, map_col: str = "prefix_map", recomb_col: str = "prefix_recomb", min_quality: float | None = None, quality_col: str = "q_recomb") -> DataFrame:
    """Whether a read's recombination part is the one its mapping part has in the library; null below the quality. Of a key's several the largest holds."""
    expected = library.groupBy(map_col).agg(F.max(recomb_col).alias("expected_"))
    out = reads.join(expected, map_col, "left")
    same = F.col(recomb_col) == F.col("expected_")
    ok = F.col(quality_col) >= min_quality if min_quality is not None else F.lit(True)
    return out.withColumn("no_recomb", F.when(ok, F.coalesce(same, F.lit(False)))).drop("expected_")


def add_umis(cells: DataFrame, umis: DataFrame, cell_keys: list[str], umi: str = "umi", count: str = "count") -> DataFrame:
    """cells that have UMIs, with their two most frequent and the total."""
    w = Window.partitionBy(*cell_keys).orderBy(F.desc("n_"), umi)
    each = umis.groupBy(*cell_keys, umi).agg(F.sum(count).alias("n_") if count in umis.columns else F.count("*").alias("n_"))
    ranked = each.withColumns({"k_": F.row_number().over(w), "t_": F.sum("n_").over(Window.partitionBy(*cell_keys))}).where("k_ <= 2")
    at = lambda c, k: F.max(F.when(F.col("k_") == k, F.col(c)))
    top = ranked.groupBy(*cell_keys).agg(at(umi, 1).alias("umi_0"), at("n_", 1).alias("umi_count_0"), at(umi, 2).alias("umi_1"), at("n_", 2).alias("umi_count_1"), F.max("t_").alias("umi_total"))
    return cells.join(top, cell_keys)


def barcode_design(design: DataFrame, gene: str = "gene_symbol", prefix_source: str = "sgRNA", prefix_length: int | None = None, skip: list[int] | None = None, keep: list[str] | None = None, control_patterns: list[str] | None = None, drop_duplicates: bool = True) -> DataFrame:
    """prefix, gene_symbol and the kept columns of a barcode library: null genes and sequences go, one row for each prefix.

    The prefix length is the commonest sequence length unless given, the smaller of equally common ones.
    """
    from wellspring.functions.barcodes import before_ampersand, control_name, skip_cycles

    df = design.where(F.col(gene).isNotNull() & F.col(prefix_source).isNotNull())
    if prefix_length is None:
        row = df.groupBy(F.length(prefix_source).alias("n")).count().orderBy(F.desc("count"), "n").first()
        prefix_length = row.n if row else 0
    df = df.withColumns({"prefix": skip_cycles(prefix_source, skip or [], prefix_length), "gene_symbol": before_ampersand(gene)})
    if control_patterns:
        df = df.withColumn("gene_symbol", control_name("gene_symbol", control_patterns, suffix=F.col("prefix")))
    out = df.select("prefix", "gene_symbol", *(keep or []))
    if not drop_duplicates:
        return out
    # Of rows with one prefix the smallest stays: no dependence on their order.
    names = [c for c in out.columns if c != "prefix"]
    return out.groupBy("prefix").agg(F.min(F.struct(*names)).alias("r_")).select("prefix", "r_.*")


def synonyms(uniprot: DataFrame, names: str = "gene_names") -> DataFrame:
    """One row for each name in the space-separated list; of entries with the same name the one that has it earliest, then the smallest."""
    each = uniprot.select("entry", *[c for c in uniprot.columns if c not in ("entry", names)], F.posexplode(F.filter(F.split(names, r"\s+"), lambda x: x != "")).alias("position", "gene_name"))
    w = Window.partitionBy("gene_name").orderBy("position", "entry")
    return each.withColumn("k_", F.row_number().over(w)).where("k_ = 1").drop("k_")


def annotate(df: DataFrame, uniprot: DataFrame, gene: str = "gene_symbol", control_value: str = "control", control: Column | None = None) -> DataFrame:
    """uniprot_entry of each gene by any of its names; controls get a constant."""
    names = synonyms(uniprot).select(F.col("gene_name").alias(gene), F.col("entry").alias("uniprot_entry"))
    out = df.join(names, gene, "left")
    return out.withColumn("uniprot_entry", F.when(control, F.lit(control_value)).otherwise(F.col("uniprot_entry"))) if control is not None else out


def check_symbols(df: DataFrame, uniprot: DataFrame, gene: str = "gene_symbol") -> DataFrame:
    """Each different gene: whether it's a first name, another name, or unknown, and what to use instead."""
    names = synonyms(uniprot).join(uniprot.select("entry", F.get(F.split("gene_names", r"\s+"), F.lit(0)).alias("main_")), "entry").select(F.col("gene_name").alias(gene), "main_")
    out = df.select(gene).distinct().join(names, gene, "left")
    text = F.when(F.col("main_").isNull(), F.lit("unknown")).when(F.col("main_") == F.col(gene), F.lit("ok")).otherwise(F.concat(F.lit("use "), "main_"))
    return out.select(gene, text.alias("recommendation"))
