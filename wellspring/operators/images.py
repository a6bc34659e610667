"""Pixel kernels as a mapInPandas extension point over binaryFile rows, with numpy versions of the simple ones.

An image row is (path, content); `decode` turns content into an array. Networks for segmentation are not part of this
package: any function from arrays to labels can be plugged in.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.session import ship


def read_images(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    df = spark.read.format("binaryFile")
    return (df.option("pathGlobFilter", pattern) if pattern else df).load(path).select("path", "content")


def decode(content: bytes) -> np.ndarray:
    """Arrays in numpy's own format; other formats need their own decoder."""
    return np.load(io.BytesIO(content), allow_pickle=False)


def encode(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def map_images(df: DataFrame, func: Callable[[np.ndarray], np.ndarray], decoder: Callable[[bytes], np.ndarray] = decode) -> DataFrame:
    """(path, content) with content = func(image)."""
    ship(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "content": [encode(func(decoder(c))) for c in b["content"]]})

    return df.select("path", "content").mapInPandas(run, "path string, content binary")


def map_tables(df: DataFrame, func: Callable[[np.ndarray], pd.DataFrame], schema: str, decoder: Callable[[bytes], np.ndarray] = decode) -> DataFrame:
    """path and the rows that func makes of each image, peaks or objects, say. schema: of these rows."""
    ship(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                out = func(decoder(content))
                out.insert(0, "path", path)
                yield out

    return df.select("path", "content").mapInPandas(run, f"path string, {schema}")


def _gauss(sigma: float) -> np.ndarray:
    r = int(4 * sigma + 0.5)
    g = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return g / g.sum()


def _along(x: np.ndarray, kernel: np.ndarray, axis: int) -> np.ndarray:
    r = len(kernel) // 2
    pad = [(0, 0)] * x.ndim
    pad[axis] = (r, r)
    p = np.pad(x, pad, mode="symmetric")
    return sum(k * np.take(p, range(i, i + x.shape[axis]), axis=axis) for i, k in enumerate(kernel))


def laplacian_of_gaussian(x: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Negative Laplacian of a Gaussian-smoothed image over the last two axes, clipped at 0: bright spots are positive."""
    x = x.astype(float)
    g = _gauss(sigma)
    r = len(g) // 2
    d2 = g * ((np.arange(-r, r + 1) ** 2) / sigma**4 - 1 / sigma**2)
    a, b = x.ndim - 2, x.ndim - 1
    return np.maximum(-(_along(_along(x, d2, a), g, b) + _along(_along(x, g, a), d2, b)), 0)


def cycle_deviation(x: np.ndarray, remove: list[int] | None = None) -> np.ndarray:
    """(cycle, channel, i, j): deviation over cycles, mean over channels."""
    if remove:
        x = np.delete(x, remove, axis=1)
    return x.std(axis=0).mean(axis=0)


def window_max(x: np.ndarray, width: int = 3) -> np.ndarray:
    r = width // 2
    p = np.pad(x, [(0, 0)] * (x.ndim - 2) + [(r, r), (r, r)], mode="symmetric")
    h, w = x.shape[-2:]
    return np.max([p[..., i : i + h, j : j + w] for i in range(width) for j in range(width)], axis=0)


def find_peaks(x: np.ndarray, width: int = 5) -> np.ndarray:
    """Local maxima keep their height over the window's lowest pixel, all else is 0."""
    high, low = window_max(x, width), -window_max(-x, width)
    return np.where((x == high) & (high > low), high - low, 0)


def illumination(images: list[np.ndarray], smooth: int = 5) -> np.ndarray:
    """Mean image, median-smoothed, over its robust lowest value; at least 1."""
    mean = np.mean(images, axis=0)
    r = smooth // 2
    p = np.pad(mean, [(0, 0)] * (mean.ndim - 2) + [(r, r), (r, r)], mode="symmetric")
    h, w = mean.shape[-2:]
    flat = np.median([p[..., i : i + h, j : j + w] for i in range(smooth) for j in range(smooth)], axis=0)
    low = np.quantile(flat.reshape(*flat.shape[:-2], -1), 0.02, axis=-1)[..., None, None]
    return np.maximum(flat / np.maximum(low, 1e-12), 1)


def correct_illumination(x: np.ndarray, field: np.ndarray | None = None, project: bool = False, background: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Intensities over the illumination field as 16-bit whole numbers; projected to the brightest plane of the first axis
    before, where asked for, and without a background that a function gives, after."""
    if project:
        x = x.max(axis=0)
    if field is not None:
        x = (x / field).astype(np.uint16)
    return x if background is None else np.maximum(x - background(x), 0).astype(np.uint16)


def phase_offset(a: np.ndarray, b: np.ndarray, factor: int = 1) -> tuple[float, float]:
    """Shift (i, j) that brings b onto a, from the peak of the phase correlation; factor > 1 refines by a parabola to 1 / factor."""
    c = np.fft.fft2(a) * np.conj(np.fft.fft2(b))
    r = np.fft.ifft2(c / np.maximum(np.abs(c), 1e-12)).real
    at = np.unravel_index(np.argmax(r), r.shape)
    out = []
    for axis, k in enumerate(at):
        n = r.shape[axis]
        shift = k - n if k > n // 2 else k
        if factor > 1:
            line = [r[tuple((k + s) % n if ax == axis else at[ax] for ax in range(2))] for s in (-1, 0, 1)]
            d = line[0] - 2 * line[1] + line[2]
            shift += round(0.5 * (line[0] - line[2]) / d * factor) / factor if d else 0
        out.append(float(shift))
    return out[0], out[1]


def components(mask: np.ndarray) -> np.ndarray:
    """4-connected components of a mask, labelled from 1."""
    label = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    while True:
        p = np.pad(label, 1)
        near = np.maximum.reduce([p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:], label])
        new = np.where(mask, near, 0)
        if (new == label).all():
            break
        label = new
    return np.unique(label, return_inverse=True)[1].reshape(mask.shape) if (label == 0).any() else np.unique(label, return_inverse=True)[1].reshape(mask.shape) + 1


def objects(labels: np.ndarray, image: np.ndarray | None = None) -> pd.DataFrame:
    """label, area, centroid (i, j), bounds and, with an image (channel, i, j), each channel's mean and least."""
    i, j = np.indices(labels.shape)
    flat = labels.reshape(-1)
    names, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    mean = lambda v: np.bincount(at, v.reshape(-1)) / count
    low = lambda v: np.array([v.reshape(-1)[at == k].min() for k in range(len(names))])
    high = lambda v: -low(-v)
    out = pd.DataFrame({"label": names, "area": count, "i": mean(i), "j": mean(j), "bounds": list(map(list, zip(low(i), low(j), high(i) + 1, high(j) + 1)))})
    for k in range(len(image) if image is not None else 0):
        out[f"channel_{k}_mean"], out[f"channel_{k}_min"] = mean(image[k]), low(image[k])
    return out[out["label"] > 0].reset_index(drop=True)


def reconcile(nuclei: DataFrame, by: list[str]) -> DataFrame:
    """Pairs (nucleus, cell) that are each other's only partner, from rows of overlapping label pairs."""
    pairs = nuclei.where("nucleus > 0 AND cell > 0").select(*by, "nucleus", "cell").distinct()
    one_n = pairs.groupBy(*by, "nucleus").agg(F.count("*").alias("n")).where("n = 1").select(*by, "nucleus")
    one_c = pairs.groupBy(*by, "cell").agg(F.count("*").alias("n")).where("n = 1").select(*by, "cell")
    return pairs.join(one_n, [*by, "nucleus"], "left_semi").join(one_c, [*by, "cell"], "left_semi")


def cytoplasm(nuclei: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Cells without their nuclei."""
    return np.where(nuclei > 0, 0, cells)


def montage_cells(cells: DataFrame, n: int, order: list, keys: list[str], width: int = 40) -> DataFrame:
    """The n first cells in an order (a report), with the square bounds (i - w, j - w, i + w, j + w) to crop."""
    i, j = F.col("i").cast("int"), F.col("j").cast("int")
    return cells.orderBy(*order, *keys).limit(n).withColumn("bounds", F.array(i - width, j - width, i + width, j + width))
