"""Formatting, de-duplicating and checking matched cells; stitching helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.barcodes import single_gene


def fov_distance(i: Column, j: Column, height: float, width: float) -> Column:
    """Distance from the middle of the field of view."""
    return F.sqrt(F.pow(i - height / 2, 2) + F.pow(j - width / 2, 2))


def channel_min(columns: list[Column]) -> Column:
    """Smallest of the columns; null and NaN don't count."""
    present = [F.when(~F.isnan(c.cast("double")), c.cast("double")) for c in columns]
    return F.least(*present) if len(present) > 1 else present[0]


def format_merge(matches: DataFrame, cells: DataFrame, phenotype: DataFrame, dims: tuple[float, float], keys: tuple[str, str] = ("plate", "well")) -> DataFrame:
    """Matches with both distances from the middle, the called genes (mapped_single_gene) and the phenotype's channel_min."""
    out = matches.withColumns({"fov_distance_0": fov_distance(F.col("i_0"), F.col("j_0"), *dims), "fov_distance_1": fov_distance(F.col("i_1"), F.col("j_1"), *dims)})
    genes = [c for c in cells.columns if c.startswith("gene_symbol_")]
    called = cells.withColumnRenamed("tile", "site").withColumnRenamed("cell", "cell_1")
    out = out.join(called, [*keys, "site", "cell_1"], "left").withColumn("mapped_single_gene", single_gene([F.col(g) for g in genes]) if genes else F.lit(False))
    mins = [c for c in phenotype.columns if "_min" in c]
    if mins:
        low = phenotype.select(*keys, "tile", F.col("label").alias("cell_0"), channel_min([F.col(c) for c in mins]).alias("channel_min"))
        out = out.join(low, [*keys, "tile", "cell_0"], "left")
    return out


def deduplicate(df: DataFrame, first_keys: list[str], first_order: list, second_keys: list[str], second_order: list) -> DataFrame:
    """One row for each first key by its order, then of these one for each second key by its own. Orders must end in a unique key."""
    a = df.withColumn("k_", F.row_number().over(Window.partitionBy(*first_keys).orderBy(*first_order))).where("k_ = 1")
    return a.withColumn("k_", F.row_number().over(Window.partitionBy(*second_keys).orderBy(*second_order))).where("k_ = 1").drop("k_")


def deduplicate_stats(df: DataFrame, first_keys: list[str], first_order: list, second_keys: list[str], second_order: list) -> DataFrame:
    """How many rows there are at the start and after each step, in one pass of windows."""
    a = df.withColumn("a_", F.row_number().over(Window.partitionBy(*first_keys).orderBy(*first_order)) == 1)
    b = a.withColumn("b_", F.col("a_") & (F.row_number().over(Window.partitionBy(*second_keys, "a_").orderBy(*second_order)) == 1))
    n = b.agg(F.count("*").alias("initial"), F.count_if("a_").alias("first"), F.count_if("b_").alias("second"))
    return n.unpivot([], ["initial", "first", "second"], "stage", "n")


def matching_rates(original: DataFrame, merged: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """by, total, matched and rate (percent): how many of the original keys the merged table has."""
    found = merged.select(*keys).distinct().withColumn("found_", F.lit(1))
    out = original.join(found, keys, "left").groupBy(*by).agg(F.count("*").alias("total"), F.count("found_").alias("matched"))
    return out.withColumn("rate", 100 * F.col("matched") / F.col("total"))


def distance_distribution(df: DataFrame, distance: str = "distance", thresholds: tuple[float, ...] = (1, 2, 5, 10)) -> DataFrame:
    """One row: mean, median, sample deviation, extremes, 95th percentile and how many lie under each threshold."""
    d = F.col(distance)
    return df.agg(
        F.count(d).alias("n"), F.avg(d).alias("mean"), F.percentile(d, 0.5).alias("median"), F.stddev_samp(d).alias("std"), F.min(d).alias("min"), F.max(d).alias("max"), F.percentile(d, 0.95).alias("p95"),
        *[F.count_if(d < t).alias(f"under_{t:g}".replace(".", "_")) for t in thresholds],
    )


def validate_matches(df: DataFrame, first: list[str], second: list[str], distance: str = "distance") -> DataFrame:
    """One row: matches, different cells on either side, repeats, and the distances' mean and largest."""
    a, b = F.struct(*first), F.struct(*second)
    return df.agg(F.count("*").alias("n"), F.count_distinct(a).alias("cells_0"), F.count_distinct(b).alias("cells_1"), F.avg(distance).alias("mean_distance"), F.max(distance).alias("max_distance")).withColumns({"repeats_0": F.col("n") - F.col("cells_0"), "repeats_1": F.col("n") - F.col("cells_1")})


def scale_factor(a: DataFrame, b: DataFrame) -> float:
    """Mean ratio of b's extent to a's along i and j: what a's coordinates are multiplied by."""
    span = lambda df: df.agg(*[(F.max(c) - F.min(c)).alias(c) for c in ("i", "j")]).first()
    x, y = span(a), span(b)
    ratios = [float(y[c]) / float(x[c]) for c in ("i", "j") if x[c]]
    return sum(ratios) / len(ratios) if ratios else 1.0


def scale_coordinates(df: DataFrame, factor: float) -> DataFrame:
    return df.withColumns({"i": F.col("i") * factor, "j": F.col("j") * factor})


def bounding_overlap(a: DataFrame, b: DataFrame) -> float:
    """Area shared by the two bounding boxes over the second's area."""
    box = lambda df: df.agg(F.min("i"), F.max("i"), F.min("j"), F.max("j")).first()
    x, y = box(a), box(b)
    if None in (*x, *y):
        return 0.0
    h, w = min(x[1], y[1]) - max(x[0], y[0]), min(x[3], y[3]) - max(x[2], y[2])
    area = (y[1] - y[0]) * (y[3] - y[2])
    return float(max(h, 0) * max(w, 0) / area) if area else 0.0


def in_region(df: DataFrame, i: tuple[float, float], j: tuple[float, float]) -> DataFrame:
    return df.where(F.col("i").between(*i) & F.col("j").between(*j))


def align_metadata(df: DataFrame, reference: DataFrame | None = None, x: str = "x_pos", y: str = "y_pos", flip_x: bool = False, flip_y: bool = False, rotate_90: bool = False, align_centers: bool = False) -> DataFrame:
    """Stage positions flipped and turned about their own middle, then moved to the reference's middle where asked for."""
    cx, cy = df.agg(F.avg(x), F.avg(y)).first()
    a, b = F.col(x) - (cx or 0.0), F.col(y) - (cy or 0.0)
    a, b = (-a if flip_x else a), (-b if flip_y else b)
    if rotate_90:
        a, b = -b, a
    if align_centers and reference is not None:
        cx, cy = reference.agg(F.avg(x), F.avg(y)).first()
    return df.withColumns({x: a + (cx or 0.0), y: b + (cy or 0.0)})


def closest_tiles(sbs: DataFrame, phenotype: DataFrame, sbs_tile: int, n: int | None = None, x: str = "x_pos", y: str = "y_pos") -> DataFrame:
    """Phenotype tiles by their distance from one SBS tile."""
    at = sbs.where(F.col("tile") == sbs_tile).select(x, y).first()
    out = phenotype.withColumn("distance", F.sqrt(F.pow(F.col(x) - at[0], 2) + F.pow(F.col(y) - at[1], 2))).orderBy("distance", "tile")
    return out.limit(n) if n else out


def stitched_ids(matches: DataFrame, phenotype: DataFrame, sbs: DataFrame, by: list[str]) -> DataFrame:
    """Matches between stitched ids, with each side's tile, original cell and area."""
    side = lambda df, k, tile: df.select(*by, F.col("stitched_cell_id").alias(f"stitched_cell_id_{k}"), F.col("tile").alias(tile), F.col("original_cell_id").alias(f"cell_{k}"), F.col("area").alias(f"area_{k}"))
    return matches.join(side(phenotype, 0, "tile"), [*by, "stitched_cell_id_0"]).join(side(sbs, 1, "site"), [*by, "stitched_cell_id_1"])


def merge_summary(matches: DataFrame, phenotype: DataFrame, sbs: DataFrame, by: list[str]) -> DataFrame:
    """For each well: cells on both sides, matches, their rates and distances."""
    a = phenotype.groupBy(*by).agg(F.count("*").alias("cells_0"))
    b = sbs.groupBy(*by).agg(F.count("*").alias("cells_1"))
    m = matches.groupBy(*by).agg(F.count("*").alias("matches"), F.avg("distance").alias("mean_distance"), F.percentile("distance", 0.5).alias("median_distance"))
    out = a.join(b, by, "full").join(m, by, "left").na.fill(0, ["cells_0", "cells_1", "matches"])
    return out.withColumns({"rate_0": F.coalesce(F.try_divide(100 * F.col("matches"), F.col("cells_0")), F.lit(0.0)), "rate_1": F.coalesce(F.try_divide(100 * F.col("matches"), F.col("cells_1")), F.lit(0.0))})


def site_report(matches: DataFrame, phenotype: DataFrame, sbs: DataFrame, site: int, threshold: float) -> dict[str, DataFrame]:
    """One site: matches within the threshold, the cells that lack one on either side (phenotype cells inside the site's box), a summary row."""
    here = matches.where((F.col("site") == site) & (F.col("distance") <= threshold))
    cells = sbs.where(F.col("site") == site)
    a, b, c, d = cells.agg(F.min("i"), F.max("i"), F.min("j"), F.max("j")).first()
    near = phenotype.where(F.col("i").between(a, b) & F.col("j").between(c, d))
    lone_0 = near.join(here.select("tile", F.col("cell_0").alias("cell")), ["tile", "cell"], "left_anti")
    lone_1 = cells.join(here.select(F.col("cell_1").alias("cell")), "cell", "left_anti")
    summary = here.agg(F.count("*").alias("matches"), F.avg("distance").alias("mean_distance"), F.percentile("distance", 0.5).alias("median_distance"))
    return {"matched": here, "unmatched_0": lone_0, "unmatched_1": lone_1, "summary": summary}


def grid_positions(metadata: DataFrame, by: list[str], x: str = "x_pos", y: str = "y_pos") -> DataFrame:
    """Stage positions as whole grid steps; a step is the tenth percentile of the gaps between different positions."""
    out = metadata
    for c in (x, y):
        steps = metadata.select(*by, F.round(c, 1).alias("v")).distinct()
        gap = F.col("v") - F.lag("v").over(Window.partitionBy(*by).orderBy("v"))
        spacing = steps.withColumn("g", gap).where("g > 0").groupBy(*by).agg(F.percentile("g", 0.1).alias(f"step_{c}"))
        low = metadata.groupBy(*by).agg(F.min(c).alias(f"low_{c}"))
        out = out.join(low.join(spacing, by, "left"), by).withColumn(f"grid_{c}", F.coalesce(F.round((F.col(c) - F.col(f"low_{c}")) / F.col(f"step_{c}")), F.lit(0)).cast("int")).drop(f"low_{c}", f"step_{c}")
    return out


def stage_shifts(metadata: DataFrame, by: list[str], pixel_size: str = "pixel_size_x", fallback: float = 1.0, x: str = "x_pos", y: str = "y_pos") -> DataFrame:
    """Pixel shift of each tile from its stage position, cut to whole pixels."""
    low = metadata.groupBy(*by).agg(F.min(x).alias("lx_"), F.min(y).alias("ly_"), F.coalesce(F.min(pixel_size), F.lit(fallback)).alias("px_"))
    out = metadata.join(low, by)
    return out.withColumns({"shift_i": ((F.col(y) - F.col("ly_")) / F.col("px_")).cast("int"), "shift_j": ((F.col(x) - F.col("lx_")) / F.col("px_")).cast("int")}).drop("lx_", "ly_", "px_")


def tile_edges(positions: DataFrame, by: list[str], threshold: float, neighbours: int = 3, tile: str = "tile", x: str = "x_pos", y: str = "y_pos") -> DataFrame:
    """Each tile's nearest tiles under the threshold, as edges a < b; candidates from a grid of that spacing."""
    from wellspring.operators.joins import _near

    p = lambda k: positions.select(*by, F.col(tile).alias(f"id_{k}"), F.col(x).cast("double").alias(f"i_{k}"), F.col(y).cast("double").alias(f"j_{k}"))
    near = _near(p(0), p(1), by, threshold, strict=True).where("id_0 <> id_1")
    best = near.withColumn("k_", F.row_number().over(Window.partitionBy(*by, "id_0").orderBy("distance", "id_1"))).where(F.col("k_") <= neighbours)
    return best.select(*by, F.least("id_0", "id_1").alias("a"), F.greatest("id_0", "id_1").alias("b"), "distance").distinct()
