"""A whole screen as one lazy plan: spots to reads to cells, matched with phenotypes, filtered, normalised, aggregated.

screen() only composes operators; nothing runs before an output is asked for, and columns that no output needs are never
read. The steps that need a second pass over their own results (bootstrap, clusters) start from its frames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.operators import bootstrap, filters, graph, joins, merge, normalise, sbs
from wellspring.plans.roles import rounded, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


@dataclass(frozen=True)
class ScreenConfig:
    """What a screen is run with. Fields are named after what they set."""

    channels: tuple[str, ...] = ("A", "C", "G", "T")
    correction: str = "median"
    least_quality: float = 0.0
    barcode_length: int | None = None
    correct_errors: bool = False
    dims: tuple[float, float] = (2960.0, 2960.0)
    match_threshold: float = 2.0
    warp: str | None = None
    filters: tuple[str, ...] = ()
    drop_columns: float | None = None
    drop_rows: float | None = None
    features: tuple[str, ...] = ()
    control: str = "nontargeting"
    batch: tuple[str, ...] = ("plate", "well")
    scaling: str = "mad"
    simulations: int = 1000
    resolution: float = 1.0
    extra: dict = field(default_factory=dict)


def called_cells(bases: DataFrame, library: DataFrame, c: ScreenConfig) -> DataFrame:
    """Reads of the bases, and the best barcodes of each cell with their genes. library: prefix, gene_symbol."""
    reads = sbs.call_reads(bases, list(c.channels), c.correction)
    if c.barcode_length:
        reads = reads.withColumn("barcode", F.substring("barcode", 1, c.barcode_length))
    return sbs.call_cells(reads, library, c.least_quality, correct_errors=c.correct_errors)


def merged_cells(cells: DataFrame, phenotype: DataFrame, positions: DataFrame, alignment: DataFrame, c: ScreenConfig) -> DataFrame:
    """One row for each matched cell: of a phenotype cell's matches the nearest, then of an SBS cell's.

    phenotype: plate, well, tile, label, i, j and features; positions: plate, well, tile, cell, i, j of the SBS cells.
    """
    matches = joins.merge_by_alignment(phenotype.withColumnRenamed("label", "cell"), positions.withColumnRenamed("tile", "site"), alignment, c.match_threshold, warp=c.warp)
    out = merge.format_merge(matches, cells, phenotype, c.dims)
    out = out.where("mapped_single_gene")
    near, keys = ["distance", "fov_distance_0", "site", "cell_1"], ["plate", "well"]
    out = merge.deduplicate(out, [*keys, "tile", "cell_0"], near, [*keys, "site", "cell_1"], [*near[:2], "tile", "cell_0"])
    return out.join(phenotype.select(*keys, "tile", F.col("label").alias("cell_0"), *c.features), [*keys, "tile", "cell_0"])


def is_control(c: ScreenConfig) -> Column:
    return F.coalesce(F.col("gene_symbol_0").startswith(c.control), F.lit(False))


def profiles(merged: DataFrame, c: ScreenConfig) -> tuple[DataFrame, DataFrame]:
    """Construct and gene profiles of filtered cells, scaled by the controls of their batch."""
    kept = filters.perturbation_filter(filters.query_filter(merged, list(c.filters)), "gene_symbol_0")
    features = list(c.features)
    if c.drop_columns is not None or c.drop_rows is not None:
        kept, features = filters.missing_values_filter(kept, features, c.drop_columns, c.drop_rows)
    scaled = normalise.scale_on_controls(kept, features, is_control(c), list(c.batch), c.scaling)
    constructs = normalise.construct_table(scaled, features, "barcode_0", "gene_symbol_0")
    return constructs, normalise.gene_table(constructs, features, "gene_symbol_0")


def screen(bases: DataFrame, library: DataFrame, phenotype: DataFrame, positions: DataFrame, alignment: DataFrame, c: ScreenConfig) -> dict[str, DataFrame]:
    """cells, merged, constructs and genes, all lazy."""
    cells = called_cells(bases, library, c)
    merged = merged_cells(cells, phenotype, positions, alignment, c)
    constructs, genes = profiles(merged, c)
    return {"cells": cells, "merged": merged, "constructs": constructs, "genes": genes}


def tested_genes(frames: dict[str, DataFrame], c: ScreenConfig) -> DataFrame:
    """genes with bootstrap p-values, FDR and clusters; it runs the plan up to the constructs."""
    features = [f for f in c.features if f in frames["genes"].columns]
    controls = normalise.scale_on_controls(frames["merged"], features, is_control(c), list(c.batch), c.scaling).where(is_control(c))
    nulls = bootstrap.construct_bootstrap(frames["constructs"], controls, features, "barcode_0", sims=c.simulations)
    p = bootstrap.p_values(bootstrap.gene_null(nulls, frames["constructs"], "barcode_0", "gene_symbol_0"), frames["genes"], features, "gene_symbol_0")
    out = frames["genes"].join(bootstrap.correct_pooled(p, features, "gene_symbol_0"), "gene_symbol_0")
    return out.join(graph.phate_leiden(frames["genes"], "gene_symbol_0", features, c.resolution).select("gene_symbol_0", "cluster"), "gene_symbol_0")


def example(spark, d: str) -> dict[str, DataFrame]:
    """Parts as cells: two cycles spell the part's number, prices and sizes are the phenotype, tiles lie two to one."""
    part = table(spark, d, "part").withColumns({"plate": F.lit("p"), "well": F.expr("concat('w', p_partkey % 3)"), "t": F.expr("cast(p_partkey div 3 % 4 AS int)"), "a": F.expr("p_partkey % 4"), "b": F.expr("p_partkey div 4 % 4")})
    bright = lambda cycle, k: F.when(F.col("a" if cycle == 1 else "b") == k, 1000.0 + F.col("p_size")).otherwise(1.0 * (F.col("p_size") % 10))
    rows = [F.struct(F.lit(cycle).alias("cycle"), F.lit(x).alias("channel"), bright(cycle, k).alias("intensity")) for cycle in (1, 2) for k, x in enumerate("ACGT")]
    key = ["plate", "well", F.col("t").alias("tile"), (F.col("p_partkey") + 1).alias("cell")]
    at = [F.expr("p_partkey div 12 % 200 * 10.0D"), F.expr("p_partkey div 2400 * 10.0D")]
    bases = part.select(*key, F.col("p_partkey").alias("read"), at[0].alias("i"), at[1].alias("j"), F.explode(F.array(*rows)).alias("r")).select("plate", "well", "tile", "cell", "read", "i", "j", "r.*")
    library = spark.createDataFrame([(x + y, "nontargeting" if x == "A" else f"gene_{x}{'CG'.find(y) >= 0:d}") for x in "ACG" for y in "ACGT"], "prefix string, gene_symbol string")
    positions = part.select(*key, at[0].alias("i"), at[1].alias("j"))
    phenotype = part.select("plate", "well", F.col("t").alias("tile"), (F.col("p_partkey") + 5).alias("label"), ((at[0] - 7) / 2).alias("i"), ((at[1] + 3) / 2).alias("j"), F.col("p_retailprice").alias("price"), F.col("p_size").cast("double").alias("size"))
    alignment = spark.createDataFrame([("p", f"w{w}", t, t, [[2.0, 0.0], [0.0, 2.0]], [7.0, -3.0]) for w in range(3) for t in range(4)], "plate string, well string, tile int, site int, rotation array<array<double>>, translation array<double>")
    c = ScreenConfig(correction="none", features=("price", "size"), filters=("size > 3",))
    return screen(bases, library, phenotype, positions, alignment, c)


_Z = """c AS (SELECT 'w' || (p_partkey % 3) AS well, ['A', 'C', 'G', 'T'][p_partkey % 4 + 1] AS x, ['A', 'C', 'G', 'T'][p_partkey // 4 % 4 + 1] AS y, p_retailprice AS price, CAST(p_size AS DOUBLE) AS size FROM part WHERE p_size > 3),
g AS (SELECT *, x || y AS barcode, CASE WHEN x = 'A' THEN 'nontargeting' ELSE 'gene_' || x || (CASE WHEN y IN ('C', 'G') THEN 1 ELSE 0 END) END AS gene FROM c WHERE x <> 'T'),
m AS (SELECT well, median(price) AS mp, median(size) AS ms FROM g WHERE gene = 'nontargeting' GROUP BY well), s AS (SELECT well, median(abs(price - mp)) AS sp, median(abs(size - ms)) AS ss FROM g JOIN m USING (well) WHERE gene = 'nontargeting' GROUP BY well),
z AS (SELECT barcode, gene, 0.6745 * (price - mp) / CASE WHEN sp = 0 THEN 1 ELSE sp END AS price, 0.6745 * (size - ms) / CASE WHEN ss = 0 THEN 1 ELSE ss END AS size FROM g JOIN m USING (well) JOIN s USING (well)),
k AS (SELECT barcode, gene, count(*) AS n, median(price) AS price, median(size) AS size FROM z GROUP BY barcode, gene)"""

SQL["screen_genes"] = f"WITH {_Z} SELECT gene AS gene_symbol_0, CAST(sum(n) AS BIGINT) AS cell_count, round(median(price), 4) AS price, round(median(size), 4) AS size FROM k GROUP BY gene"
SQL["screen_constructs"] = f"WITH {_Z} SELECT barcode AS barcode_0, gene AS gene_symbol_0, n AS cell_count, round(price, 4) AS price, round(size, 4) AS size FROM k"


def screen_genes(spark, d: str) -> DataFrame:
    return rounded(example(spark, d)["genes"])


def screen_constructs(spark, d: str) -> DataFrame:
    return rounded(example(spark, d)["constructs"])


QUERIES |= {"screen_genes": screen_genes, "screen_constructs": screen_constructs}
