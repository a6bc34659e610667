"""Statistics as column expressions and DataFrame steps: exact percentiles, robust scales, BH, Fisher, rank tests."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: 1 / the 0.75 quantile of the normal, and its inverse: the usual MAD constants.
MAD_TO_STD, STD_TO_MAD = 1.4826, 0.6745


def clean(c: str | Column) -> Column:
    """NaN as null: the one spelling of "missing" that every operator here expects."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c), c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every float column with NaN as null; done once, at a scan."""
    return df.withColumns({c: clean(c) for c, t in df.dtypes if t in ("double", "float")})


def median_skipna(c: str | Column) -> Column:
    """Median of what is there."""
    return F.percentile(clean(c), 0.5)


def median_strict(c: str | Column) -> Column:
    """Median that is null as soon as one value is missing."""
    return F.when(F.count("*") == F.count(clean(c)), F.percentile(clean(c), 0.5))


def mean_strict(c: str | Column) -> Column:
    return F.when(F.count("*") == F.count(clean(c)), F.avg(clean(c)))


def with_group_stats(df: DataFrame, keys: list[str], aggs: dict[str, Column], where: Column | None = None, how: str = "left") -> DataFrame:
    """df with aggregates of its groups joined back on; null keys meet null keys.

    The aggregate is partial before its shuffle. Its side of the join has a row for each group, which Spark
    broadcasts only where its measured size allows; else both sides are shuffled and skewed keys split.
    """
    src = df if where is None else df.where(where)
    if not keys:
        return df.crossJoin(F.broadcast(src.agg(*[a.alias(n) for n, a in aggs.items()])))  # one row
    g = src.groupBy(*[F.col(k).alias(f"g_{k}") for k in keys]).agg(*[a.alias(n) for n, a in aggs.items()])
    on = [df[k].eqNullSafe(g[f"g_{k}"]) for k in keys]
    return df.join(g, on, how).drop(*[f"g_{k}" for k in keys])


def benjamini_hochberg(df: DataFrame, p: str, out: str, by: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """df with FDR values: p * n / rank, made monotone from the top and capped at 1. Null p-values get none.

    Within groups `by` this is a window over each group. Pooled over all rows, no single task may sort them
    all: ranks come from a range-partitioned sort and the running minimum from the partitions' own minima.
    """
    if by:
        w = Window.partitionBy(*by, F.col(p).isNull())
        up = w.orderBy(F.asc(p), *(order or []))
        down = w.orderBy(F.desc(p), *[F.desc(o) for o in order or []]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = df.withColumn("bh_q", F.col(p) * F.count("*").over(w) / F.row_number().over(up))
        return df.withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min("bh_q").over(down)))).drop("bh_q")
    return _pooled_bh(df, p, out)


def _pooled_bh(df: DataFrame, p: str, out: str) -> DataFrame:
    """Counts of each different p-value are cumulated; equal p-values share the rank of their last, as BH lets them."""
    from wellspring.session import materialize

    counts = materialize(df.where(F.col(p).isNotNull()).groupBy(F.col(p).alias("bh_p")).agg(F.count("*").alias("bh_c")), "counts")
    ranked = cumulative(counts, "bh_p", "bh_c", "bh_rank")
    total = counts.agg(F.sum("bh_c")).first()[0] or 0
    ranked = ranked.withColumn("bh_q", F.least(F.lit(1.0), F.col("bh_p") * total / F.col("bh_rank")))
    low = running_min_from_top(ranked, "bh_p", "bh_q", out).select("bh_p", out)
    return df.join(low, df[p] == low["bh_p"], "left").drop("bh_p")


def _split(df: DataFrame, order: str) -> DataFrame:
    """df in range partitions by `order`, with the number of each row's partition."""
    return df.repartitionByRange(F.col(order)).withColumn("part_", F.spark_partition_id())


def cumulative(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Running sum of value in the order of a unique column, without one task that holds all rows.

    Range partitions are summed; the sums before each partition (one number a partition) are added to a window
    inside it.
    """
    from wellspring.session import materialize

    parts = materialize(_split(df, order), "ranges")
    sums = sorted((r.part_, r.s) for r in parts.groupBy("part_").agg(F.sum(value).alias("s")).collect())
    before, rows = 0, []
    for k, s in sums:
        rows.append((k, before))
        before += s
    base = df.sparkSession.createDataFrame(rows or [(0, 0)], f"part_ int, base_ {'double' if any(isinstance(b, float) for _, b in rows) else 'bigint'}")
    inside = F.sum(value).over(Window.partitionBy("part_").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return parts.withColumn("in_", inside).join(F.broadcast(base), "part_").withColumn(out, F.col("in_") + F.col("base_")).drop("part_", "in_", "base_")


def running_min_from_top(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Smallest value among the rows that are not before this one, by range partitions as in cumulative()."""
    from wellspring.session import materialize

    parts = materialize(_split(df, order), "ranges")
    lows = sorted(((r.part_, r.m) for r in parts.groupBy("part_").agg(F.min(value).alias("m")).collect()), reverse=True)
    after, rows = math.inf, []
    for k, m in lows:
        rows.append((k, after))
        after = min(after, m)
    base = df.sparkSession.createDataFrame(rows or [(0, math.inf)], "part_ int, base_ double")
    inside = F.min(value).over(Window.partitionBy("part_").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return parts.withColumn("in_", inside).join(F.broadcast(base), "part_").withColumn(out, F.least("in_", "base_")).drop("part_", "in_", "base_")


#: Values that an exact quantile may hold at once, and how finely a pass narrows down where it lies.
QUANTILE_ROWS, QUANTILE_STEPS = 50_000, 2_000


def exact_quantiles(df: DataFrame, value: str | Column, shares: list[float]) -> list[float | None]:
    """Linear quantiles over all rows, as percentile() gives them; None where nothing is there.

    percentile() holds every different value in one task. Here sketches of bounded size say between which values a
    quantile lies, passes over what is between them narrow that down, and only when some thousands are left are they
    counted by value. Sketches only choose where to look: ranks are exact counts.
    """
    v = clean(value).cast("double")
    rows = df.select(v.alias("v")).where("v IS NOT NULL")
    n = rows.count()
    if not n:
        return [None for _ in shares]
    ranks = sorted({k for p in shares for k in (math.floor((n - 1) * p), math.ceil((n - 1) * p))})
    at: dict[int, float] = {}
    todo = [(-math.inf, math.inf, 0, n, ranks)]  # values in [low, high], rows under low, rows in it, ranks sought in it
    while todo:
        low, high, before, inside, sought = todo.pop()
        part = rows if inside == n else rows.where(F.col("v").between(low, high))
        if low == high:
            at |= {k: low for k in sought}
        elif inside <= QUANTILE_ROWS:
            values = sorted((r.v, r.c) for r in part.groupBy("v").agg(F.count("*").alias("c")).collect())
            i, seen = 0, before
            for k in sought:
                while seen + values[i][1] <= k:
                    seen, i = seen + values[i][1], i + 1
                at[k] = values[i][0]
        else:
            near = sorted({min(1.0, max(0.0, (k - before) / inside + x / QUANTILE_STEPS)) for k in sought for x in (-2, 2)})
            cuts = part.agg(F.percentile_approx("v", [0.0, *near, 1.0], 4 * QUANTILE_STEPS)).first()[0]
            cuts = sorted(set(cuts))
            counts = part.agg(*[x for c in cuts for x in (F.count_if(F.col("v") < c), F.count_if(F.col("v") == c))]).first()
            # Pieces: each cut by itself, and what lies open between two cuts.
            pieces = []
            for j, c in enumerate(cuts):
                under, same = counts[2 * j], counts[2 * j + 1]
                pieces.append((c, c, before + under, same))
                if j + 1 < len(cuts):
                    pieces.append((math.nextafter(c, math.inf), math.nextafter(cuts[j + 1], -math.inf), before + under + same, counts[2 * j + 2] - under - same))
            for a, b, first, size in pieces:
                if mine := [k for k in sought if first <= k < first + size]:
                    todo.append((a, b, first, size, mine))
    out = []
    for p in shares:
        h = (n - 1) * p
        a, b = at[math.floor(h)], at[math.ceil(h)]
        out.append(a + (b - a) * (h - math.floor(h)))
    return out


def fold_p(share: Column) -> Column:
    """Two-sided p-value from a one-sided share: folded at one half and doubled."""
    return 2 * F.least(share, 1 - share)


#: Log-factorials are tabulated for a batch up to this total; larger tables take them one by one.
FISHER_TABLE = 4_000_000


def _fisher(a: np.ndarray, row: int, col: int, n: int, log_factorial) -> np.ndarray:
    """Two-sided p-values of tables with the same margins and these first cells, from one vector of their probabilities."""
    k = np.arange(max(0, row + col - n), min(row, col) + 1)
    f = log_factorial
    logs = f(row) - f(k) - f(row - k) + f(n - row) - f(col - k) - f(n - row - col + k) - f(n) + f(col) + f(n - col)
    order = np.sort(logs)
    below = np.concatenate([[0.0], np.cumsum(np.exp(order))])
    return np.minimum(1.0, below[np.searchsorted(order, logs[a - k[0]] + 1e-7, "right")])


@F.pandas_udf(DoubleType())
def fisher_exact(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided p-value of the 2 x 2 table [[a, b], [c, d]]; negative cells count as zero. Tables with equal margins are
    worked out together."""
    t = np.maximum(np.stack([x.to_numpy(float) for x in (a, b, c, d)]), 0).astype(np.int64)
    margins = np.stack([t[0] + t[1], t[0] + t[2], t.sum(0)], axis=1)
    out = np.empty(len(a))
    if len(out) and margins[:, 2].max() <= FISHER_TABLE:
        table = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, margins[:, 2].max() + 1)))])
        log_factorial = lambda k: table[k]
    else:
        log_factorial = np.vectorize(lambda k: math.lgamma(k + 1), otypes=[float])
    for m in np.unique(margins, axis=0):
        at = np.flatnonzero((margins == m).all(1))
        out[at] = _fisher(t[0, at], *map(int, m), log_factorial)
    return pd.Series(out)


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """Two-sided tail of the standard normal."""
    return z.map(lambda x: None if x is None or x != x else math.erfc(abs(x) / math.sqrt(2)))


def _beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_tail(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) - math.log(a) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)))
    f = c = 1.0
    d = 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            n = 1.0
        elif i % 2 == 0:
            n = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            n = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 + n * d
        d = 1 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1 + n / (c if abs(c) > 1e-300 else 1e-300)
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


@F.pandas_udf(DoubleType())
def f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Upper tail of the F distribution."""
    ok = lambda x: x is not None and x == x
    return pd.Series([_beta_tail(v / 2, u / 2, v / (v + u * x)) if ok(x) and ok(u) and ok(v) and u > 0 and v > 0 else None for x, u, v in zip(f, d1, d2)], dtype=float)


@F.pandas_udf(DoubleType())
def t_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided tail of Student's t."""
    ok = lambda x: x is not None and x == x
    return pd.Series([_beta_tail(v / 2, 0.5, v / (v + x * x)) if ok(x) and ok(v) and v > 0 else None for x, v in zip(t, df)], dtype=float)


def mann_whitney(df: DataFrame, value: str, is_test: Column, by: list[str]) -> DataFrame:
    """by, n1, n2, u, z, p: rank-sum test of test rows against the others in each group (asymptotic, ties corrected, continuity 0.5).

    Equal values are first counted; ranks then follow from cumulative counts of the different values.
    """
    c = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count_if(is_test).alias("a"), F.count_if(~is_test).alias("b"))
    t = F.col("a") + F.col("b")
    before = F.sum(t).over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - t
    r = c.withColumn("rank", before + (t + 1) / 2).withColumn("t", t.cast("double"))
    g = r.groupBy(*by).agg(F.sum("a").alias("n1"), F.sum("b").alias("n2"), F.sum(F.col("a") * F.col("rank")).alias("r1"), F.sum(F.col("t") * F.col("t") * F.col("t") - F.col("t")).alias("ties"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    g = g.withColumn("u", F.col("r1") - n1 * (n1 + 1) / 2)
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(F.abs(F.col("u") - n1 * n2 / 2) - 0.5, spread) * F.signum(F.col("u") - n1 * n2 / 2)
    return g.withColumn("z", z).withColumn("p", F.least(F.lit(1.0), normal_two_sided(F.greatest(F.abs(z), F.lit(0.0))))).select(*by, "n1", "n2", "u", "z", "p")


def anova_f(df: DataFrame, value: str, group: str, by: list[str]) -> DataFrame:
    """by, f, d1, d2, p: one-way analysis of variance from the groups' sums."""
    v = clean(value)
    g = df.where(v.isNotNull()).groupBy(*by, group).agg(F.count("*").alias("n"), F.sum(v).alias("s"), F.sum(v * v).alias("q"))
    a = g.groupBy(*by).agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
    between, within = F.col("b") - F.col("s") * F.col("s") / F.col("n"), F.col("q") - F.col("b")
    a = a.withColumn("d1", (F.col("k") - 1).cast("double")).withColumn("d2", (F.col("n") - F.col("k")).cast("double"))
    a = a.withColumn("f", F.try_divide(F.try_divide(between, F.col("d1")), F.try_divide(within, F.col("d2"))))
    return a.withColumn("p", f_tail("f", "d1", "d2")).select(*by, "f", "d1", "d2", "p")
