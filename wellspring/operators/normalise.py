"""Batch and control normalisation, embeddings and aggregation of cell features.

Control statistics are grouped aggregates joined back: partial before the shuffle, and one row for each batch after.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions.stats import STD_TO_MAD, clean, mean_strict, median_skipna, median_strict, with_group_stats
from wellspring.session import materialize, ship


def batch_column(df: DataFrame, batch_cols: list[str], out: str = "batch_values") -> DataFrame:
    return df.withColumn(out, F.concat_ws("_", *[F.col(c).cast("string") for c in batch_cols]))


def suffix_controls(df: DataFrame, perturbation: str, control_key: str, construct: str) -> DataFrame:
    """Perturbations equal to the control key become {key}_{construct}: each control construct is a gene of its own."""
    return df.withColumn(perturbation, F.when(F.col(perturbation) == control_key, F.concat_ws("_", perturbation, construct)).otherwise(F.col(perturbation)))


def is_control(column: str, key: str, mode: str = "prefix") -> Column:
    """Controls equal the key, start with it, contain it or match it, as each operator has it."""
    c = F.col(column)
    test = {"equal": lambda: c == key, "prefix": lambda: c.startswith(key), "contains": lambda: c.contains(key), "regex": lambda: c.rlike(f"^(?:{key})")}[mode]()
    return F.coalesce(test, F.lit(False))


def center_scale(df: DataFrame, features: list[str], by: list[str]) -> DataFrame:
    """(x - mean) / population standard deviation in each batch; a deviation of 0 divides by 1."""
    aggs = {f"m_{f}": F.avg(clean(f)) for f in features} | {f"s_{f}": F.stddev_pop(clean(f)) for f in features}
    out = with_group_stats(df, by, aggs)
    return out.withColumns({f: (clean(f) - F.col(f"m_{f}")) / F.when(F.col(f"s_{f}") == 0, 1.0).otherwise(F.col(f"s_{f}")) for f in features}).drop(*aggs)


def scale_on_controls(df: DataFrame, features: list[str], control: Column, by: list[str], method: str = "standard") -> DataFrame:
    """Each batch scaled by its controls; a batch without controls stays as it is.

    standard: population deviation, 0 as 1. mad: 0.6745 * (x - median) / MAD, a MAD of 0 as 1.
    """
    if method == "standard":
        aggs = {f"m_{f}": F.avg(clean(f)) for f in features} | {f"s_{f}": F.stddev_pop(clean(f)) for f in features}
        out = with_group_stats(df, by, aggs, control)
        factor = 1.0
    elif method == "mad":
        medians = {f"m_{f}": F.percentile(clean(f), 0.5) for f in features}
        out = with_group_stats(df, by, medians, control)
        spreads = {f"s_{f}": F.percentile(F.abs(clean(f) - F.col(f"m_{f}")), 0.5) for f in features}
        out = with_group_stats(out, by, spreads, control)
        factor = STD_TO_MAD
    else:
        raise ValueError(f"unknown method {method!r}")
    scaled = {f: F.when(F.col(f"m_{f}").isNull(), clean(f)).otherwise(factor * (clean(f) - F.col(f"m_{f}")) / F.when(F.col(f"s_{f}") == 0, 1.0).otherwise(F.col(f"s_{f}"))) for f in features}
    return out.withColumns(scaled).drop(*[f"{x}_{f}" for x in "ms" for f in features])


def construct_table(df: DataFrame, features: list[str], construct: str, perturbation: str) -> DataFrame:
    """Median of each feature and cell_count of each construct."""
    return df.groupBy(construct, perturbation).agg(F.count("*").alias("cell_count"), *[median_skipna(f).alias(f) for f in features])


def gene_table(constructs: DataFrame, features: list[str], perturbation: str) -> DataFrame:
    """Medians of the constructs' medians, and the cells of all constructs."""
    return constructs.groupBy(perturbation).agg(F.sum("cell_count").alias("cell_count"), *[median_skipna(f).alias(f) for f in features])


def aggregate(df: DataFrame, features: list[str], perturbation: str, method: str = "mean", auc: str | None = None, score: str | None = None) -> DataFrame:
    """Mean or median of each feature, cell_count, first AUC and the aggregated score of each perturbation; null perturbations go."""
    center = {"mean": mean_strict, "median": median_strict}[method]
    extra = ([F.first(auc, ignorenulls=True).alias(auc)] if auc else []) + ([(F.avg if method == "mean" else median_skipna)(score).alias(f"aggregated_{score}")] if score else [])
    return df.where(F.col(perturbation).isNotNull()).groupBy(perturbation).agg(F.count("*").alias("cell_count"), *extra, *[center(f).alias(f) for f in features])


def pack(df: DataFrame, features: list[str], out: str = "x") -> DataFrame:
    """Features as one array: beyond some fifty columns this keeps plans and generated code small."""
    return df.withColumn(out, F.array(*[clean(f).cast("double") for f in features])).drop(*features)


def packed_medians(df: DataFrame, by: list[str], vector: str = "x") -> DataFrame:
    """Per group the median of each element of an array column, packed again."""
    long = df.select(*by, F.posexplode(vector).alias("pos", "v"))
    each = long.groupBy(*by, "pos").agg(F.percentile("v", 0.5).alias("v"))
    return each.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias(vector))


def moments(df: DataFrame, vector: str, by: list[str] | None = None) -> dict[tuple, tuple[int, np.ndarray, np.ndarray]]:
    """Group -> (rows, mean, cross products about the mean) of an array column.

    Every partition sums its own rows; only d + d**2 numbers for each group travel, so the rows never meet.
    """
    by = by or []
    ship(df.sparkSession)

    def run(batches):
        total: dict[tuple, list] = {}
        for pdf in batches:
            x = np.stack(pdf[vector].to_numpy()).astype(float) if len(pdf) else np.zeros((0, 0))
            keys = list(zip(*[pdf[c] for c in by])) if by else [()] * len(pdf)
            for key in dict.fromkeys(keys):
                part = x[[k == key for k in keys]] if by else x
                n, s, q = total.get(key, (0, 0.0, 0.0))
                total[key] = [n + len(part), s + part.sum(0), q + part.T @ part]
        for key, (n, s, q) in total.items():
            yield pd.DataFrame({**{c: [v] for c, v in zip(by, key)}, "n_": [n], "s_": [s], "q_": [q.reshape(-1)]})

    types = dict(df.dtypes)
    fields = ", ".join([*[f"`{c}` {types[c]}" for c in by], "n_ bigint, s_ array<double>, q_ array<double>"])
    parts = df.select(*by, vector).mapInPandas(run, fields)
    flat = parts.select(*by, "n_", F.posexplode(F.concat("s_", "q_")).alias("i", "v")).groupBy(*by, "i").agg(F.sum("v").alias("v"), F.sum("n_").alias("n"))
    out: dict[tuple, tuple[int, np.ndarray, np.ndarray]] = {}
    rows: dict[tuple, dict[int, float]] = {}
    size: dict[tuple, int] = {}
    for r in flat.collect():
        key = tuple(r[c] for c in by)
        rows.setdefault(key, {})[r.i] = r.v
        size[key] = r.n
    for key, v in rows.items():
        a = np.array([v[i] for i in range(len(v))])
        d = int((np.sqrt(1 + 4 * len(a)) - 1) / 2)
        n, s, q = size[key], a[:d], a[d:].reshape(d, d)
        out[key] = (n, s / n, q - np.outer(s, s) / n)
    return out


def _apply_linear(df: DataFrame, vector: str, by: list[str], maps: dict[tuple, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(x - shift) @ matrix by group; groups without an entry stay. The maps' size is d**2 for each batch."""
    shared = df.sparkSession.sparkContext.broadcast(maps)

    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[vector].to_numpy()).astype(float)
                keys = list(zip(*[pdf[c] for c in by])) if by else [()] * len(pdf)
                out = [None] * len(x)
                for key in dict.fromkeys(keys):
                    at = [i for i, k in enumerate(keys) if k == key]
                    m = shared.value.get(key)
                    y = (x[at] - m[0]) @ m[1] if m else x[at]
                    for i, row in zip(at, y):
                        out[i] = row
                pdf[vector] = out
            yield pdf

    return df.mapInPandas(run, df.schema)


def pca(df: DataFrame, vector: str, variance_or_components: float | int, scale: bool = True) -> tuple[DataFrame, np.ndarray]:
    """The vector replaced by its principal components, fitted on all rows; and the share of variance of each.

    A number under 1 asks for that share of variance, else it's how many components. The covariance comes from
    partial sums, its eigenvectors from the driver (d x d). Signs: each component's largest loading is positive.
    """
    df = df.withColumn(vector, F.col(vector).cast("array<double>"))
    n, mean, q = moments(df, vector)[()]
    std = np.sqrt(np.diag(q) / n) if scale else np.ones(len(mean))
    std = np.where(std == 0, 1, std)
    cov = q / max(n - 1, 1) / std[:, None] / std[None, :]
    values, vectors = np.linalg.eigh(cov)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    share = values / values.sum() if values.sum() else values
    k = int(np.searchsorted(np.cumsum(share), variance_or_components - 1e-12) + 1) if variance_or_components < 1 else int(variance_or_components)
    k = min(k, len(share))
    return _apply_linear(df, vector, [], {(): (mean, vectors[:, :k] / std[:, None])}), share


def _power(m: np.ndarray, p: float) -> np.ndarray:
    values, vectors = np.linalg.eigh(m)
    return (vectors * np.maximum(values, 1e-12) ** p) @ vectors.T


def tvn(df: DataFrame, vector: str, control: Column, batch: str, ridge: float = 0.5) -> DataFrame:
    """Typical variation normalisation: control scaling, PCA on controls, control scaling in each batch, and each batch's
    control covariance (sample, + ridge * I) brought to that of all controls. Batches with fewer controls than
    dimensions, or values that aren't finite, skip the last step.
    """
    df = materialize(df.withColumns({vector: F.col(vector).cast("array<double>"), "control_": control}), "tvn")
    n, mean, q = moments(df.where("control_"), vector)[()]
    std = np.sqrt(np.diag(q) / n)
    std = np.where(std == 0, 1, std)
    values, vectors = np.linalg.eigh(q / max(n - 1, 1) / std[:, None] / std[None, :])
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(order))])
    df = materialize(_apply_linear(df, vector, [], {(): (mean, vectors / std[:, None])}), "tvn")
    groups = moments(df.where("control_"), vector, [batch])
    scale = {k: (m, np.diag(1 / np.where(np.diag(q) <= 0, 1, np.sqrt(np.maximum(np.diag(q) / c, 1e-300))))) for k, (c, m, q) in groups.items()}
    df = materialize(_apply_linear(df, vector, [batch], scale), "tvn")
    groups, whole = moments(df.where("control_"), vector, [batch]), moments(df.where("control_"), vector)[()]
    d = len(whole[1])
    eye = ridge * np.eye(d)
    target = _power(whole[2] / max(whole[0] - 1, 1) + eye, 0.5)
    maps = {}
    for k, (c, _, q) in groups.items():
        if c >= d and np.isfinite(q).all():
            maps[k] = (np.zeros(d), _power(q / max(c - 1, 1) + eye, -0.5) @ target)
    return _apply_linear(df, vector, [batch], maps).drop("control_")
