"""Row filters: query strings, missing values, outliers, gates, class thresholds, pools."""

from __future__ import annotations

import ast
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.stats import MAD_TO_STD, clean, cumulative, exact_quantiles
from wellspring.session import materialize, ship

_COMPARE = {ast.Eq: lambda a, b: a == b, ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}
_ARITHMETIC = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: lambda a, b: F.try_divide(a, b), ast.Mod: lambda a, b: F.try_mod(a, b)}


def predicate(query: str, variables: dict | None = None) -> Column:
    """A query string (comparisons, chains, and/or/not, & | ~, in, arithmetic, @variables, `quoted names`) as a column.

    Missing values compare as false, but are different from everything: != is true for them.
    """
    quoted: dict[str, str] = {}
    while query.count("`") >= 2:
        before, name, after = query.split("`", 2)
        quoted[f"quoted_{len(quoted)}_"] = name
        query = f"{before}quoted_{len(quoted) - 1}_{after}"
    # In these strings & | ~ bind as and, or, not do.
    words = {"&": " and ", "|": " or ", "~": " not ", "@": "at_variable_"}
    query = re.sub(r"""('[^']*'|"[^"]*")|([&|~@])""", lambda m: m[1] or words[m[2]], query)
    tree = ast.parse(query.strip(), mode="eval").body

    def values(n: ast.expr) -> list:
        if isinstance(n, (ast.List, ast.Tuple, ast.Set)):
            return [ast.literal_eval(x) for x in n.elts]
        if isinstance(n, ast.Name) and n.id.startswith("at_variable_"):
            return list((variables or {})[n.id.removeprefix("at_variable_")])
        raise ValueError(f"not a list: {ast.unparse(n)}")

    def one(n: ast.expr) -> Column:
        if isinstance(n, ast.BoolOp):
            parts = [one(x) for x in n.values]
            out = parts[0]
            for x in parts[1:]:
                out = out & x if isinstance(n.op, ast.And) else out | x
            return out
        if isinstance(n, ast.BinOp):
            return _ARITHMETIC[type(n.op)](one(n.left), one(n.right))
        if isinstance(n, ast.UnaryOp):
            return -one(n.operand) if isinstance(n.op, ast.USub) else ~one(n.operand)
        if isinstance(n, ast.Compare):
            left, out = n.left, None
            for op, right in zip(n.ops, n.comparators):
                if isinstance(op, (ast.In, ast.NotIn)):
                    c = F.coalesce(one(left).isin(values(right)), F.lit(False))
                    c = c if isinstance(op, ast.In) else ~c
                elif isinstance(right, (ast.List, ast.Tuple)):
                    c = F.coalesce(one(left).isin(values(right)), F.lit(False))
                    c = ~c if isinstance(op, ast.NotEq) else c
                elif isinstance(op, ast.NotEq):
                    c = ~F.coalesce(one(left) == one(right), F.lit(False))
                else:
                    c = F.coalesce(_COMPARE[type(op)](one(left), one(right)), F.lit(False))
                out, left = c if out is None else out & c, right
            return out
        if isinstance(n, ast.Constant):
            return F.lit(n.value)
        if isinstance(n, ast.Name):
            if n.id.startswith("at_variable_"):
                return F.lit((variables or {})[n.id.removeprefix("at_variable_")])
            return F.col(f"`{quoted.get(n.id, n.id)}`")
        raise ValueError(f"not understood: {ast.unparse(n)}")

    return one(tree)


def query_filter(df: DataFrame, queries: list[str] | None, variables: dict | None = None) -> DataFrame:
    """Rows that pass every query; None passes all. All become one predicate, which reaches the scan."""
    for q in queries or []:
        df = df.where(predicate(q, variables))
    return df


def perturbation_filter(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def missing_values_filter(df: DataFrame, features: list[str], drop_columns: float | None = None, drop_rows: float | None = None) -> tuple[DataFrame, list[str]]:
    """Drops features whose missing share is at least drop_columns, then rows whose share over the rest is at least drop_rows."""
    if drop_columns is not None and features:
        # 1-row answer: the shares of all features in one pass.
        share = df.agg(*[F.avg(clean(c).isNull().cast("double")).alias(c) for c in features]).first()
        gone = [c for c in features if share[c] is not None and share[c] >= drop_columns]
        df, features = df.drop(*gone), [c for c in features if c not in gone]
    if drop_rows is not None and features:
        missing = sum((clean(c).isNull().cast("int") for c in features), F.lit(0))
        df = df.where(missing / len(features) < drop_rows)
    return df, features


#: Rows of a block, when all rows are searched for the nearest: a task holds one block of those that lack values, and one of all.
KNN_BLOCK = 8192


def impute_knn(df: DataFrame, features: list[str], keys: list[str], k: int = 5, reference_rows: int | None = None, seed: int = 42) -> DataFrame:
    """Missing features as the mean of the k nearest rows that have them; the column's mean where no row is comparable.

    The distance is over the features both have, scaled up for those missing; ties go by the keys. All rows are searched,
    by blocks of KNN_BLOCK, so the work is rows with missing values times rows. reference_rows: search only so many, the
    first by a hash of their keys, which are sent with the code.
    """
    ship(df.sparkSession)
    if reference_rows is None:
        return _impute_from_all(df, features, keys, k)
    order = F.xxhash64(*keys, F.lit(seed))
    ref = df.select(*[clean(c).cast("double").alias(c) for c in features], order.alias("h_"), *[F.col(c).alias(f"k_{c}") for c in keys]).orderBy("h_", *[f"k_{c}" for c in keys]).limit(reference_rows)
    shared = df.sparkSession.sparkContext.broadcast(ref.select(*features).toPandas().to_numpy(float))

    def run(batches):
        reference = shared.value
        for pdf in batches:
            pdf[features] = fill_from_neighbours(pdf[features].to_numpy(float), reference, k)
            yield pdf

    fields = ", ".join(f"`{c}` {'double' if c in features else t}" for c, t in df.dtypes)
    return df.withColumns({c: clean(c).cast("double") for c in features}).mapInPandas(run, fields)


def _impute_from_all(df: DataFrame, features: list[str], keys: list[str], k: int) -> DataFrame:
    spark = df.sparkSession
    rows = df.withColumns({c: clean(c).cast("double") for c in features} | {"o_": F.struct(*keys), "one_": F.lit(1)})
    rows = materialize(cumulative(rows, "o_", "one_", "at_").drop("o_", "one_"), "rows")
    n, *means = rows.agg(F.count("*"), *[F.avg(c) for c in features]).first()
    blocks = max(1, -(-n // KNN_BLOCK))
    slim = rows.select("at_", F.floor((F.col("at_") - 1) / KNN_BLOCK).cast("int").alias("own_"), *features)
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    tasks = min(blocks * blocks, 4 * spark.sparkContext.defaultParallelism)
    # As many tasks as given: few bytes are much work here.
    dealt = lambda d: d.drop("own_").repartition(tasks, "b0_", "b1_").groupBy("b0_", "b1_")
    asking = dealt(slim.where(" OR ".join(f"`{c}` IS NULL" for c in features)).withColumn("b0_", F.col("own_")).withColumn("b1_", every))
    known = dealt(slim.withColumn("b1_", F.col("own_")).withColumn("b0_", every))

    def search(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("at_")
        found = [nearest_known(a[features].to_numpy(float), b[features].to_numpy(float), k)] if len(a) and len(b) else []
        parts = [pd.DataFrame({"at_": a["at_"].to_numpy()[i], "c_": c, "d_": d, "by_": b["at_"].to_numpy()[j], "v_": b[features].to_numpy(float)[j, c]}) for i, c, j, d in found]
        return parts[0] if parts else pd.DataFrame({"at_": [], "c_": [], "d_": [], "by_": [], "v_": []})

    near = asking.cogroup(known).applyInPandas(search, "at_ bigint, c_ int, d_ double, by_ bigint, v_ double")
    best = near.groupBy("at_", "c_").agg(F.slice(F.array_sort(F.collect_list(F.struct("d_", "by_", "v_"))), 1, k).alias("x_"))
    mean = F.aggregate("x_", F.lit(0.0), lambda s, x: s + x["v_"]) / F.size("x_")
    best = best.groupBy("at_").agg(*[F.max(F.when(F.col("c_") == c, mean)).alias(f"m_{c}") for c in range(len(features))])
    out = rows.join(best, "at_", "left").withColumns({f: F.coalesce(f, f"m_{c}", F.lit(means[c]).cast("double")) for c, f in enumerate(features)})
    return out.select(*df.columns)


def nearest_known(x: np.ndarray, reference: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each NaN of x the k nearest reference rows that have this column: row and column in x, row of the reference,
    distance. Ties go to the earlier row."""
    known = ~np.isnan(reference)
    filled = np.where(known, reference, 0)
    empty = np.zeros(0, int)
    rows, columns, others, distances = [empty], [empty], [empty], [np.zeros(0)]
    lacks = np.isnan(x)
    for pattern in np.unique(lacks[lacks.any(1)], axis=0):
        mine = np.flatnonzero(~pattern)
        both = known[:, mine].sum(1)
        asked = np.flatnonzero((lacks == pattern).all(1))
        for c in np.flatnonzero(pattern):
            can = np.flatnonzero(known[:, c] & (both > 0))
            if not len(can):
                continue
            for first in range(0, len(asked), 256):
                at = asked[first : first + 256]
                d = np.zeros((len(at), len(can)))
                for f in mine:
                    d += (filled[can, f] - x[at, f][:, None]) ** 2 * known[can, f]
                d = d * x.shape[1] / both[can]
                d[~np.isfinite(d)] = np.inf
                limit = np.partition(d, min(k, len(can)) - 1, axis=1)[:, min(k, len(can)) - 1]
                i, j = np.nonzero((d <= limit[:, None]) & (d < np.inf))
                order = np.lexsort((j, d[i, j], i))
                i, j = i[order], j[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j = i[keep], j[keep]
                rows.append(at[i])
                columns.append(np.full(len(i), c))
                others.append(can[j])
                distances.append(d[i, j])
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(others), np.concatenate(distances)


def fill_from_neighbours(x: np.ndarray, reference: np.ndarray, k: int) -> np.ndarray:
    """x with NaN filled; a column without any reference value stays NaN."""
    x = x.copy()
    known = ~np.isnan(reference)
    filled = np.where(known, reference, 0)
    for i in np.flatnonzero(np.isnan(x).any(1)):
        mine = ~np.isnan(x[i])
        both = known & mine
        n = both.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.where(n > 0, (((filled - np.where(mine, x[i], 0)) ** 2) * both).sum(1) * x.shape[1] / n, np.inf)
        for c in np.flatnonzero(~mine):
            can = np.flatnonzero(known[:, c] & np.isfinite(d))
            if len(can):
                near = can[np.argsort(d[can], kind="stable")[:k]]
                x[i, c] = reference[near, c].mean()
            elif known[:, c].any():
                x[i, c] = reference[known[:, c], c].mean()
    return x


def local_outlier_factor(x: np.ndarray, k: int = 20) -> np.ndarray:
    """LOF scores of the rows of x by the textbook formula, distances in blocks."""
    n = len(x)
    k = min(k, n - 1)
    if k < 1:
        return np.ones(n)
    near, dist = np.empty((n, k), int), np.empty((n, k))
    square = (x**2).sum(1)
    for a in range(0, n, 1024):
        d = np.sqrt(np.maximum(square[a : a + 1024, None] + square[None] - 2 * x[a : a + 1024] @ x.T, 0))
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        near[a : a + 1024] = np.argsort(d, axis=1, kind="stable")[:, :k]
        dist[a : a + 1024] = np.take_along_axis(d, near[a : a + 1024], 1)
    reach = np.maximum(dist, dist[near, -1])
    density = 1 / (reach.mean(1) + 1e-10)
    return density[near].mean(1) / density


def intensity_filter(df: DataFrame, features: list[str], channels: list[str], contamination: float = 0.01, by: list[str] | None = None, k: int = 20, block_rows: int = 20_000, keys: list[str] | None = None) -> DataFrame:
    """Drops the share `contamination` of each group's rows (of each plate and well, say) with the highest local outlier factor.

    Factors are over the columns that end in _{channel}_mean, of the whole group, whose quantile cuts; rows with a
    missing one stay. A group is dealt to blocks of about block_rows rows, and every block is compared with every
    other, so that no task holds an unbounded group. Ties of distance go by row. 0 filters nothing.
    """
    used = [c for c in features if any(c.endswith(f"_{ch}_mean") for ch in channels)]
    if not 0 <= contamination < 0.5:
        raise ValueError("contamination must be in [0, 0.5)")
    if contamination == 0 or not used:
        return df
    ship(df.sparkSession)
    by = by or []
    rows = materialize(df.withColumn("id_", F.monotonically_increasing_id()), "rows")
    groups = rows.groupBy(*by).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks_")).withColumn("g_", F.monotonically_increasing_id())
    groups = materialize(groups.withColumnsRenamed({c: f"by_{i}_" for i, c in enumerate(by)}), "groups")
    each = rows.dropna(subset=used)
    if by:
        match = F.col(by[0]).eqNullSafe(F.col("by_0_"))
        for i, c in enumerate(by[1:], 1):
            match = match & F.col(c).eqNullSafe(F.col(f"by_{i}_"))
        each = each.join(groups, match)
    else:
        each = each.crossJoin(F.broadcast(groups))
    dealt = F.pmod(F.xxhash64(*(keys or df.columns), "id_"), F.col("blocks_")).cast("int")
    points = materialize(each.select("g_", "blocks_", "id_", dealt.alias("block_"), F.array(*[F.col(c).cast("double") for c in used]).alias("x_")), "points")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1))
    asking = points.withColumn("shard_", others).select("g_", "block_", "shard_", "id_", "x_")
    asked = points.withColumn("shard_", F.col("block_")).withColumn("block_", others).select("g_", "block_", "shard_", "id_", "x_")

    def nearest(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"g_": [], "id_": [], "d_": [], "j_": []})
        b = b.sort_values("id_")
        i, j = a["id_"].to_numpy(), b["id_"].to_numpy()
        x, y = np.stack(a["x_"].to_numpy()), np.stack(b["x_"].to_numpy())
        square, take = (y**2).sum(1), min(k, len(j))
        d_all, j_all = np.empty((len(i), take)), np.empty((len(i), take), np.int64)
        for first in range(0, len(i), 1024):
            part = slice(first, first + 1024)
            d = np.sqrt(np.maximum((x[part] ** 2).sum(1)[:, None] + square[None] - 2 * x[part] @ y.T, 0))
            d[i[part][:, None] == j[None]] = np.inf
            order = np.argsort(d, axis=1, kind="stable")[:, :take]
            d_all[part], j_all[part] = np.take_along_axis(d, order, 1), j[order]
        return pd.DataFrame({"g_": key[0], "id_": i, "d_": list(d_all), "j_": list(j_all)})

    by_pair = ["g_", "block_", "shard_"]
    found = asking.groupBy(*by_pair).cogroup(asked.groupBy(*by_pair)).applyInPandas(nearest, "g_ long, id_ long, d_ array<double>, j_ array<long>")
    near = F.transform(F.arrays_zip("d_", "j_"), lambda v: F.struct(v["d_"].alias("d"), v["j_"].alias("j")))
    near = F.filter(near, lambda v: v["d"] < float("inf"))
    near = found.groupBy("g_", "id_").agg(F.slice(F.array_sort(F.flatten(F.collect_list(near))), 1, k).alias("near_"))
    near = materialize(near.where(F.size("near_") > 0).withColumn("last_", F.element_at("near_", -1)["d"]), "near")
    long = near.select("g_", "id_", F.explode("near_").alias("n_")).select("g_", "id_", F.col("n_")["d"].alias("d_"), F.col("n_")["j"].alias("j_"))
    reach = long.join(near.select(F.col("id_").alias("j_"), "last_"), "j_").groupBy("id_").agg((1 / (F.avg(F.greatest("d_", "last_")) + 1e-10)).alias("density_"))
    reach = materialize(reach, "densities")
    around = long.join(reach.select(F.col("id_").alias("j_"), F.col("density_").alias("other_")), "j_").groupBy("g_", "id_").agg(F.avg("other_").alias("other_"))
    # Rounded: sums come in any order, and equal factors must stay equal at the cut.
    factor = materialize(around.join(reach, "id_").select("g_", "id_", F.round(F.col("other_") / F.col("density_"), 10).alias("s_")), "factors")
    cut = factor.groupBy("g_").agg(F.percentile("s_", 1 - contamination).alias("cut_"))
    drop = factor.join(cut, "g_").where(F.col("s_") > F.col("cut_")).select("id_")
    return rows.join(drop, "id_", "left_anti").select(*df.columns)


def class_thresholds(df: DataFrame, class_col: str, confidence_col: str, thresholds: dict[int, float | dict], probability_cols: dict[int, str] | None = None) -> DataFrame:
    """Rows whose class passes its confidence threshold.

    A threshold is a number or {"threshold", "mode"}. Mode "exclude" drops what is below; "reassign" gives it to
    the first other class, in ascending id, whose probability passes that class's own threshold, and drops it if
    there is none. Classes without a threshold always pass. A threshold of 0 counts.
    """
    spec = {int(k): (v if isinstance(v, dict) else {"threshold": v}) for k, v in thresholds.items()}
    probability_cols = {int(k): v for k, v in (probability_cols or {}).items()}
    low = F.lit(False)
    new = F.col(class_col)
    new_confidence = F.col(confidence_col)
    for k in sorted(spec):
        t = float(spec[k]["threshold"])
        below = (F.col(class_col) == k) & (F.col(confidence_col) < t)
        low = low | below
        if spec[k].get("mode", "exclude") == "reassign":
            pick = F.lit(None).cast("int")
            value = F.lit(None).cast("double")
            for j in sorted(probability_cols, reverse=True):
                if j != k:
                    ok = F.col(probability_cols[j]) >= float(spec.get(j, {"threshold": 0.0})["threshold"])
                    pick = F.when(ok, F.lit(j)).otherwise(pick)
                    value = F.when(ok, F.col(probability_cols[j])).otherwise(value)
            new = F.when(below, pick).otherwise(new)
            new_confidence = F.when(below, value).otherwise(new_confidence)
        else:
            new = F.when(below, F.lit(None)).otherwise(new)
    t = dict(df.dtypes)[class_col]
    marked = df.withColumns({"class_": new.cast(t), "confidence_": new_confidence}).where(F.col(class_col).isNull() | F.col("class_").isNotNull())
    return marked.withColumns({class_col: F.col("class_"), confidence_col: F.col("confidence_")}).drop("class_", "confidence_")


def threshold_summary(before: DataFrame, after: DataFrame, class_col: str) -> DataFrame:
    """class, before, after and share kept, with a TOTAL row."""
    a = before.groupBy(F.col(class_col).cast("string").alias("class")).agg(F.count("*").alias("before"))
    b = after.groupBy(F.col(class_col).cast("string").alias("class")).agg(F.count("*").alias("after"))
    both = a.join(b, "class", "full").na.fill(0)
    both = both.unionByName(both.agg(F.lit("TOTAL").alias("class"), F.sum("before").alias("before"), F.sum("after").alias("after")))
    return both.withColumn("kept", F.coalesce(F.try_divide(F.col("after"), F.col("before")), F.lit(0.0)))


def bounds(df: DataFrame, column: str, low: float | None = None, high: float | None = None, low_pct: float | None = None, high_pct: float | None = None) -> tuple[float, float]:
    """The open interval of a gate: the smaller of the lower limits, the larger of the upper; past the data where none is given."""
    p = [x for x in (low_pct, high_pct) if x is not None]
    row = df.agg(F.min(clean(column)), F.max(clean(column))).first()
    at = dict(zip(p, exact_quantiles(df, column, [x / 100 for x in p]))) if p else {}
    lows = [x for x in (low, at.get(low_pct) if low_pct is not None else None) if x is not None]
    highs = [x for x in (high, at.get(high_pct) if high_pct is not None else None) if x is not None]
    first = -math.inf if row[0] is None else math.nextafter(float(row[0]), -math.inf)
    last = math.inf if row[1] is None else math.nextafter(float(row[1]), math.inf)
    return (min(lows) if lows else first), (max(highs) if highs else last)


def gate_pools(df: DataFrame, gates: list[dict], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows inside every gate, and the others. Percentile limits are of those that the gates before left."""
    inside = df
    for g in gates:
        limits = {k: v for k, v in g.items() if k != "column"}
        a, b = bounds(inside, g["column"], **limits)
        inside = inside.where((clean(g["column"]) > a) & (clean(g["column"]) < b))
    return inside, df.join(inside.select(*keys), keys, "left_anti")


def without_seen(pools: list[DataFrame], seen: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Each pool without the rows whose keys were seen."""
    return [p.join(seen.select(*keys).distinct(), keys, "left_anti") for p in pools]


def diverse_tiles(df: DataFrame, tile: str, original: str) -> DataFrame:
    """Rows of tiles that hold more than one different original id."""
    # Two rows are enough to tell: least and largest differ.
    good = df.groupBy(tile).agg(F.min(original).alias("a"), F.max(original).alias("b")).where("a <> b").select(tile)
    return df.join(good, tile, "left_semi")


def drop_low_seeds(df: DataFrame, score: str, keys: list[str], k: float = 3.0, min_keep: int = 5) -> DataFrame:
    """Without scores under median - k * 1.4826 * MAD, but never fewer than the min_keep best; as it is with so few, or with MAD 0."""
    (median,) = exact_quantiles(df, score, [0.5])
    if median is None or df.limit(min_keep + 1).count() <= min_keep:
        return df
    (mad,) = exact_quantiles(df, F.abs(F.col(score) - median), [0.5])
    if not mad:
        return df
    kept = df.where(F.col(score) >= median - k * MAD_TO_STD * mad)
    return kept if kept.limit(min_keep).count() == min_keep else df.orderBy(F.desc(score), *keys).limit(min_keep)


def genes_by_bootstrap(df: DataFrame, gene: str, features: list[str], controls: list[str], z: float | None = None, direction: str = "both", fdr: float | None = None, mode: str = "combined") -> DataFrame:
    """Rows where some feature passes |z| >= t (column feature), FDR < t (feature_fdr), or both; control genes always stay."""
    tests = []
    for f in features:
        value = {"both": F.abs(F.col(f)), "positive": F.col(f), "negative": -F.col(f)}[direction]
        by_z = F.coalesce(value >= z, F.lit(False)) if z is not None else None
        by_f = F.coalesce(F.col(f"{f}_fdr") < fdr, F.lit(False)) if fdr is not None else None
        pick = {"zscore": [by_z], "fdr": [by_f], "combined": [by_z, by_f]}[mode]
        pick = [x for x in pick if x is not None]
        tests.append(pick[0] if len(pick) == 1 else pick[0] & pick[1])
    control = F.lit(False)
    for p in controls:
        control = control | F.coalesce(F.col(gene).rlike(f"^(?:{p})"), F.lit(False))
    passes = F.exists(F.array(*tests), lambda x: x) if tests else F.lit(False)
    return df.where(control | passes)


def auc_gate(df: DataFrame, perturbation: str, control_key: str, auc: str, threshold: float) -> DataFrame:
    """Controls, and perturbations whose AUC is over the threshold."""
    return df.where(F.col(perturbation).startswith(control_key) | (F.col(auc) > threshold))


def score_gate(df: DataFrame, score: str, probability: float | None = None, percentile: float | None = None) -> DataFrame:
    """Rows with at least this score, or at least this percentile of the scores there are; missing scores stay."""
    s = clean(score)
    if probability is not None:
        df = df.where(s.isNull() | (s >= probability))
    if percentile is not None:
        (low,) = exact_quantiles(df, s, [percentile / 100])
        if low is not None:
            df = df.where(s.isNull() | (s >= low))
    return df


def next_batch(inside: DataFrame, outside: DataFrame, keys: list[str], size: int, prioritized: DataFrame | None = None, inside_share: float = 0.5, seed: int = 42) -> DataFrame:
    """`size` rows from two pools: prioritised keys first, the rest by a hash; what one pool lacks the other gives."""
    def ranked(df: DataFrame, pool: str) -> DataFrame:
        first = F.lit(1)
        if prioritized is not None:
            df = df.join(F.broadcast(prioritized.select(*keys).distinct().limit(size).withColumn("first_", F.lit(0))), keys, "left")
            first = F.coalesce("first_", F.lit(1))
        return df.withColumns({"pool": F.lit(pool), "p_": first, "h_": F.xxhash64(*keys, F.lit(seed))}).orderBy("p_", "h_", *keys).limit(size)

    want = math.ceil(size * inside_share)
    a, b = materialize(ranked(inside, "in"), "pool"), materialize(ranked(outside, "out"), "pool")
    n_a, n_b = a.count(), b.count()
    take_a = min(n_a, max(want, size - n_b))
    take_b = min(n_b, size - take_a)
    order = ["p_", "h_", *keys]
    return a.orderBy(*order).limit(take_a).unionByName(b.orderBy(*order).limit(take_b), allowMissingColumns=True).drop("p_", "h_", "first_")


def rank_in(df: DataFrame, by: list[str], order: list[Column | str], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
