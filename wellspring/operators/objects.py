"""Objects of segmentation masks as tables: pixels are rows, features are grouped aggregates.

A mask becomes a row for each labelled pixel where it is read (pixels()); from there a well of any size is a table, so
stitching needs no canvas and features are partial aggregates before their shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions.stats import cumulative
from wellspring.operators.images import decode
from wellspring.session import materialize, ship


def pixels(masks: DataFrame, channels: list[str] | None = None, decoder: Callable[[bytes], np.ndarray] = decode) -> DataFrame:
    """path, label, i, j and a column for each channel of every labelled pixel.

    masks: path, content and, with channels, image, whose array is (channel, i, j).
    """
    ship(masks.sparkSession)
    channels = channels or []

    def run(batches):
        for b in batches:
            for row in b.itertuples(index=False):
                labels = decoder(row.content)
                i, j = np.nonzero(labels)
                out = {"path": row.path, "label": labels[i, j].astype(np.int64), "i": i, "j": j}
                image = decoder(row.image) if channels else None
                for k, c in enumerate(channels):
                    out[c] = image[k][i, j].astype(float)
                yield pd.DataFrame(out)

    fields = ", ".join(["path string, label bigint, i int, j int", *[f"`{c}` double" for c in channels]])
    return masks.select("path", "content", *(["image"] if channels else [])).mapInPandas(run, fields)


def correlation(a: str, b: str) -> Column:
    """Pearson's correlation of two channels over an object's pixels where both are positive; null where none is or one is flat."""
    both = (F.col(a) > 0) & (F.col(b) > 0)
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def channel_features(channels: list[str]) -> dict[str, Column]:
    """Mean, sum, deviation, least, largest and median of each channel, and the correlations of all pairs."""
    out: dict[str, Column] = {}
    for c in channels:
        out |= {f"{c}_mean": F.avg(c), f"{c}_integrated": F.sum(c), f"{c}_std": F.stddev_pop(c), f"{c}_min": F.min(c), f"{c}_max": F.max(c), f"{c}_median": F.percentile(c, 0.5)}
    return out | {f"{a}_{b}_correlation": correlation(a, b) for k, a in enumerate(channels) for b in channels[k + 1 :]}


def feature_table(pixel_rows: DataFrame, by: list[str], features: dict[str, Column] | None = None, of_image: dict[str, Column] | None = None) -> DataFrame:
    """by, label, area, centroid (i, j), bounds (first and past the last pixel) and any aggregates of every object.

    of_image: aggregates over all objects of an image, repeated on each of its rows. An object has as many pixels as a
    cell covers, so a group is bounded.
    """
    bounds = F.array(F.min("i"), F.min("j"), F.max("i") + 1, F.max("j") + 1)
    each = {"area": F.count("*"), "i": F.avg("i"), "j": F.avg("j"), "bounds": bounds} | (features or {})
    out = pixel_rows.where("label > 0").groupBy(*by, "label").agg(*[a.alias(n) for n, a in each.items()])
    if of_image:
        whole = pixel_rows.where("label > 0").groupBy(*by).agg(*[a.alias(n) for n, a in of_image.items()])
        out = out.join(whole, by)
    return out


def correct_illumination(pixel_rows: DataFrame, field: DataFrame, channels: list[str]) -> DataFrame:
    """Intensities over the field's (i, j and a column for each channel), cut to whole numbers of 16 bits."""
    f = field.select("i", "j", *[F.col(c).alias(f"{c}_field") for c in channels])
    out = pixel_rows.join(f, ["i", "j"])
    return out.withColumns({c: (F.col(c) / F.col(f"{c}_field")).cast("bigint").bitwiseAND(0xFFFF).cast("double") for c in channels}).drop(*[f"{c}_field" for c in channels])


def number_cells(pixel_rows: DataFrame, by: list[str], tile: str = "tile") -> DataFrame:
    """by, tile, label and stitched_cell_id: cells numbered from 1 in the order of tile and label, covered ones too."""
    cells = pixel_rows.where("label > 0").select(*by, tile, "label").distinct()
    numbered = cumulative(cells.withColumns({"o_": F.struct(*by, tile, "label"), "one_": F.lit(1)}), "o_", "one_", "n_")
    if not by:
        return numbered.select(tile, "label", F.col("n_").alias("stitched_cell_id"))
    numbered = materialize(numbered.drop("o_", "one_"), "numbers")
    first = numbered.groupBy(*by).agg((F.min("n_") - 1).alias("before_"))
    return numbered.join(first, by).select(*by, tile, "label", (F.col("n_") - F.col("before_")).alias("stitched_cell_id"))


def stitched_cells(pixel_rows: DataFrame, shifts: DataFrame, by: list[str], metadata: DataFrame | None = None, tile: str = "tile") -> DataFrame:
    """Cells of tiles laid at their shifts (by, tile, shift_i, shift_j): where tiles overlap the later tile's pixels hold.

    by, stitched_cell_id, tile, cell (its label in the tile), i, j and area on the well, tile_i and tile_j in the tile,
    and from metadata (by, tile, x_pos, y_pos) stage_x and stage_y. Cells that are covered whole have no row; tiles
    without a shift aren't laid.
    """
    laid = pixel_rows.where("label > 0").join(shifts.select(*by, tile, "shift_i", "shift_j"), [*by, tile])
    placed = laid.withColumns({"y_": F.col("i") + F.col("shift_i"), "x_": F.col("j") + F.col("shift_j")})
    top = placed.groupBy(*by, "y_", "x_").agg(F.max(F.struct(tile, "label", "shift_i", "shift_j")).alias("t_"))
    seen = top.select(*by, "y_", "x_", "t_.*").groupBy(*by, tile, "label", "shift_i", "shift_j").agg(F.avg("y_").alias("i"), F.avg("x_").alias("j"), F.count("*").alias("area"))
    out = seen.join(number_cells(pixel_rows.join(shifts.select(*by, tile), [*by, tile], "left_semi"), by, tile), [*by, tile, "label"])
    out = out.select(*by, "stitched_cell_id", tile, F.col("label").alias("cell"), "i", "j", "area", (F.col("i") - F.col("shift_i")).alias("tile_i"), (F.col("j") - F.col("shift_j")).alias("tile_j"))
    if metadata is None:
        return out
    return out.join(metadata.select(*by, tile, F.col("x_pos").alias("stage_x"), F.col("y_pos").alias("stage_y")), [*by, tile], "left")


def neighbours(cells: DataFrame, by: list[str], radius: float) -> DataFrame:
    """For each cell how many others lie within the radius, and the distance of the nearest of them."""
    from wellspring.operators.joins import _near

    p = lambda k: cells.select(*by, F.col("cell").alias(f"id_{k}"), F.col("i").cast("double").alias(f"i_{k}"), F.col("j").cast("double").alias(f"j_{k}"))
    near = _near(p(0), p(1), by, radius, strict=False).where("id_0 <> id_1")
    found = near.groupBy(*by, F.col("id_0").alias("cell")).agg(F.count("*").alias("neighbours"), F.min("distance").alias("nearest"))
    return cells.select(*by, "cell").join(found, [*by, "cell"], "left").na.fill(0, ["neighbours"])

