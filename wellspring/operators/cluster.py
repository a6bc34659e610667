"""Benchmarks of clusters, choice of a resolution, and comparison of clusters with controls.

Genes number in the thousands, clusters in the hundreds: still nothing here is collected, except where an operator's
whole input is one number for each resolution.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.stats import STD_TO_MAD, benjamini_hochberg, clean, fisher_exact, mann_whitney, t_two_sided, with_group_stats
from wellspring.session import materialize, ship


def group_enrichment(clusters: DataFrame, groups: DataFrame, gene: str = "gene", cluster: str = "cluster", group: str = "group", fdr: float = 0.05) -> DataFrame:
    """cluster, group, the 2 x 2 counts, p and fdr (BH within the cluster): which gene groups are over- or under-represented.

    The background is every gene of the clustering. Group genes outside it still count for the group's size, so the
    fourth count can fall under zero: it's clamped to zero.
    """
    c = clusters.select(F.col(gene).alias("gene"), F.col(cluster).alias("cluster")).distinct()
    g = groups.select(F.col(gene).alias("gene"), F.col(group).alias("group")).distinct()
    n = c.agg(F.count_distinct("gene").alias("n_all"))
    sizes_c, sizes_g = c.groupBy("cluster").agg(F.count("*").alias("n_c")), g.groupBy("group").agg(F.count("*").alias("n_g"))
    both = c.join(g, "gene").groupBy("cluster", "group").agg(F.count("*").alias("a"))
    # Every cluster is tested against every group: clusters x groups rows, of two small dimension tables.
    grid = sizes_c.crossJoin(sizes_g).crossJoin(F.broadcast(n))
    t = grid.join(both, ["cluster", "group"], "left").withColumn("a", F.coalesce("a", F.lit(0)))
    t = t.withColumns({"b": F.col("n_c") - F.col("a"), "c": F.col("n_g") - F.col("a")})
    t = t.withColumn("d", F.greatest(F.col("n_all") - F.col("a") - F.col("b") - F.col("c"), F.lit(0)))
    t = t.withColumn("p", fisher_exact("a", "b", "c", "d"))
    t = benjamini_hochberg(t, "p", "fdr", by=["cluster"], order=["group"])
    return t.select("cluster", "group", "a", "b", "c", "d", "p", "fdr", (F.col("fdr") < fdr).alias("enriched"))


def enriched_lists(enrichment: DataFrame) -> DataFrame:
    """cluster and its enriched groups, sorted, joined by '; '."""
    listed = F.array_join(F.sort_array(F.collect_set(F.when(F.col("enriched"), F.col("group").cast("string")))), "; ")
    return enrichment.groupBy("cluster").agg(listed.alias("groups"), F.count_if("enriched").alias("n_enriched"))


def pair_enrichment(clusters: DataFrame, pairs: DataFrame, gene: str = "gene", cluster: str = "cluster", by_cluster: bool = False, adjust: Column | None = None) -> DataFrame:
    """true and false positives, false negatives, precision, recall and F1 of "same cluster" against known pairs (a, b).

    Pairs inside clusters are counted, not made: a cluster of n genes has n (n - 1) / 2 of them.
    """
    c = clusters.select(F.col(gene).alias("gene"), F.col(cluster).alias("cluster")).distinct()
    known = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    known = known.join(c.select(F.col("gene").alias("a"), F.col("cluster").alias("ca")), "a").join(c.select(F.col("gene").alias("b"), F.col("cluster").alias("cb")), "b")
    sizes = c.groupBy("cluster").agg(F.count("*").alias("n")).select("cluster", (F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"))
    keys = ["cluster"] if by_cluster else []
    hits = known.where("ca = cb").groupBy(*([F.col("ca").alias("cluster")] if by_cluster else [])).agg(F.count("*").alias("tp"))
    split = known.where("ca <> cb")
    if by_cluster:
        misses = split.select(F.explode(F.array("ca", "cb")).alias("cluster")).groupBy("cluster").agg(F.count("*").alias("fn"))
        out = sizes.join(hits, keys, "left").join(misses, keys, "left")
    else:
        out = sizes.agg(F.sum("pairs").alias("pairs")).crossJoin(hits).crossJoin(split.agg(F.count("*").alias("fn")))  # three single rows
    out = out.na.fill(0, ["tp", "fn"]).withColumn("fp", F.col("pairs") - F.col("tp"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), b), F.lit(0.0))
    out = out.withColumns({"precision": ratio("tp", F.col("tp") + F.col("fp")), "recall": ratio("tp", F.col("tp") + F.col("fn"))})
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))).drop("pairs")


def filter_complexes(groups: DataFrame, library: DataFrame, gene: str = "gene", group: str = "group", min_genes: int = 3, min_share: float = 2 / 3, overlap: float = 0.1) -> DataFrame:
    """Groups with enough genes in the library; of two that share over a tenth of the smaller one's pairs the larger goes.

    Pairs shared by two groups are those of their common genes: s (s - 1) / 2 of them, so only genes are joined.
    """
    g = groups.select(F.col(gene).alias("gene"), F.col(group).alias("group")).distinct()
    lib = library.select(F.col(gene).alias("gene")).distinct().withColumn("in_", F.lit(1))
    size = g.join(lib, "gene", "left").groupBy("group").agg(F.count("*").alias("n"), F.count("in_").alias("k"))
    good = size.where((F.col("k") >= min_genes) & (F.col("k") >= min_share * F.col("n"))).select("group", "k")
    kept = g.join(lib.select("gene"), "gene").join(good, "group")
    x, y = kept.select("gene", F.col("group").alias("x"), F.col("k").alias("kx")), kept.select("gene", F.col("group").alias("y"), F.col("k").alias("ky"))
    shared = x.join(y, "gene").where("kx > ky OR (kx = ky AND x > y)").groupBy("x", "kx", "y", "ky").agg(F.count("*").alias("s"))
    pairs = lambda c: F.col(c) * (F.col(c) - 1) / 2
    gone = shared.where(pairs("s") > overlap * pairs("ky")).select(F.col("x").alias("group")).distinct()
    return kept.join(gone, "group", "left_anti").select("gene", "group")


def combined_table(tables: dict[str, DataFrame]) -> DataFrame:
    """One row for each cluster, the columns of each benchmark with its name in front."""
    out = None
    for name, t in tables.items():
        t = t.select("cluster", *[F.col(c).alias(f"{name}_{c}") for c in t.columns if c != "cluster"])
        out = t if out is None else out.join(t, "cluster", "full")
    return out


def enriched_in(tables: dict[str, DataFrame]) -> DataFrame:
    """How many clusters are enriched in which set of benchmarks."""
    all_ = None
    for name, t in tables.items():
        t = t.where(F.col("n_enriched") > 0).select("cluster", F.lit(name).alias("name"))
        all_ = t if all_ is None else all_.union(t)
    sets = all_.groupBy("cluster").agg(F.array_join(F.sort_array(F.collect_set("name")), "; ").alias("enriched_in"))
    return sets.groupBy("enriched_in").agg(F.count("*").alias("clusters"))


def size_utility(size: Column, low: float, high: float) -> Column:
    """1 inside the ideal range, falling to 0 at no size and at twice the upper end."""
    return F.when(size < low, size / low).when(size <= high, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - (size - high) / high))


def score_resolutions(metrics: DataFrame, columns: list[str], size: str | None = None, ideal: tuple[float, float] = (5, 20), by: list[str] | None = None) -> DataFrame:
    """metrics with each column over its largest (n_...), combined (their mean) and balanced (half of it the size utility)."""
    by = by or []
    # A row for each resolution: tens of rows in a window.
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    out = metrics.withColumns({f"n_{c}": F.coalesce(F.try_divide(F.col(c).cast("double"), F.max(c).over(w)), F.lit(0.0)) for c in columns})
    out = out.withColumn("combined", sum((F.col(f"n_{c}") for c in columns), F.lit(0.0)) / len(columns))
    return out.withColumn("balanced", (F.col("combined") + size_utility(F.col(size), *ideal)) / 2) if size else out.withColumn("balanced", F.col("combined"))


def best_resolution(scored: DataFrame, resolution: str = "resolution", metric: str = "balanced", by: list[str] | None = None) -> DataFrame:
    """Of each group the row with the best metric, the smaller resolution of equal ones."""
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc(metric), resolution)
    return scored.withColumn("k_", F.row_number().over(w)).where("k_ = 1").drop("k_")


def resolution_table(scored: DataFrame, rates: list[str], top: int = 10, resolution: str = "resolution") -> DataFrame:
    """Rates as percentages of one decimal, best balanced score first; a report of the top rows."""
    return scored.withColumns({c: F.round(100 * F.col(c), 1) for c in rates}).orderBy(F.desc("balanced"), resolution).limit(top)


def control_distance(embedded: DataFrame, gene: str, vector: str, control: Column, metric: str = "euclidean", block: int = 8192) -> DataFrame:
    """gene, mean_distance to the control genes (a control's distance 0 to itself counts), and that scaled to 0..1.

    Rows and controls are dealt to blocks of about `block`, and each block of rows meets each of controls in a co-group, as
    two matrices: no pairs are made one by one. A null vector, or one with a null, has no distance.
    """
    spark = embedded.sparkSession
    ship(spark)
    kind = dict(embedded.dtypes)[gene]
    v = F.transform(vector, lambda x: x.cast("double"))
    rows = embedded.select(F.col(gene).alias("gene"), v.alias("v"))
    controls = embedded.where(control).select(v.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    n_rows, n_controls = max(1, -(-rows.count() // block)), max(1, -(-controls.count() // block))
    own = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # As many tasks as given: few bytes are much work here.
    tasks = min(n_rows * n_controls, 4 * spark.sparkContext.defaultParallelism)
    dealt = lambda d: d.repartition(tasks, "a", "b").groupBy("a", "b")

    def meet(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"gene": [], "n": [], "d": []})
        y = np.stack(y["v"].to_numpy()).astype(float)
        size = y.shape[1]
        x0 = np.stack([u.astype(float) if u is not None and len(u) == size else np.full(size, np.nan) for u in x["v"]])
        return pd.DataFrame({"gene": x["gene"].to_numpy(), "n": len(y), "d": distance_sums(x0, y, metric)})

    sums = dealt(rows.withColumn("a", own(n_rows, "gene")).withColumn("b", every(n_controls))).cogroup(dealt(controls.withColumn("b", own(n_controls, F.monotonically_increasing_id())).withColumn("a", every(n_rows))))
    sums = sums.applyInPandas(meet, f"gene {kind}, n bigint, d double").withColumn("d", clean("d"))
    mean = materialize(sums.groupBy("gene").agg((F.sum("d") / F.sum("n")).alias("mean_distance")), "distances")
    out = with_group_stats(mean, [], {"lo_": F.min("mean_distance"), "hi_": F.max("mean_distance")})
    return out.withColumn("normalized_distance", F.coalesce(F.try_divide(F.col("mean_distance") - F.col("lo_"), F.col("hi_") - F.col("lo_")), F.lit(0.0))).drop("lo_", "hi_")


def distance_sums(x: np.ndarray, y: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    """For each row of x the sum of its distances to all rows of y."""
    out = np.empty(len(x))
    if metric == "cosine":
        length = lambda m: np.sqrt((m**2).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            return len(y) - x @ (y / length(y)[:, None]).sum(0) / length(x)
    middle = y.mean(0)
    x, y = x - middle, y - middle
    square = (y**2).sum(1)
    for k in range(0, len(x), 512):
        part = x[k : k + 512]
        d = part @ y.T
        d *= -2
        both = (part**2).sum(1)[:, None] + square
        d += both
        # Close pairs have lost their digits in the difference of squares.
        i, j = np.nonzero(d < 1e-4 * both)
        starts = np.searchsorted(i, hit := np.unique(i))
        for r, others in zip(hit, np.split(j, starts[1:])):
            d[r, others] = ((y[others] - part[r]) ** 2).sum(1)
        out[k : k + 512] = np.sqrt(np.maximum(d, 0, out=d), out=d).sum(1)
    return out


def _long(df: DataFrame, features: list[str], test: Column, control: Column) -> DataFrame:
    """feature, value, is_test of the rows that are in either set."""
    keep = df.where(test | control).withColumn("is_test", test)
    return keep.unpivot(["is_test"], [F.col(f) for f in features], "feature", "value").withColumn("value", clean(F.col("value").cast("double"))).where("value IS NOT NULL")


def median_analysis(df: DataFrame, features: list[str], test: Column, control: Column, min_diff: float = 0.5, min_ratio: float = 1.5, least: int = 3) -> DataFrame:
    """feature, medians and quartile ranges of both sets, their difference and ratio, and whether both exceed the limits."""
    x = _long(df, features, test, control)
    side = lambda k: F.when(F.col("is_test") == k, F.col("value"))
    aggs = []
    for name, k in (("test", True), ("control", False)):
        aggs += [F.count(side(k)).alias(f"n_{name}"), F.percentile(side(k), 0.5).alias(f"{name}_median"), (F.percentile(side(k), 0.75) - F.percentile(side(k), 0.25)).alias(f"{name}_iqr")]
    out = x.groupBy("feature").agg(*aggs).where((F.col("n_test") >= least) & (F.col("n_control") >= least))
    diff, ratio = F.col("test_median") - F.col("control_median"), F.try_divide(F.col("test_median"), F.col("control_median"))
    out = out.withColumns({"diff": diff, "ratio": ratio})
    up = F.coalesce((F.abs("ratio") >= min_ratio) | (F.abs("ratio") <= 1 / min_ratio), F.lit(False))
    return out.withColumn("significant", (F.abs("diff") >= min_diff) & up)


def top_features(analysis: DataFrame, n: int = 10, score: str = "diff") -> DataFrame:
    """The n most raised and the n most lowered features, a report."""
    up = analysis.where(F.col(score) > 0).orderBy(F.desc(score), "feature").limit(n).withColumn("direction", F.lit("up"))
    down = analysis.where(F.col(score) < 0).orderBy(score, "feature").limit(n).withColumn("direction", F.lit("down"))
    return up.unionByName(down)


def differential_analysis(df: DataFrame, features: list[str], test: Column, control: Column, nonparametric: bool = True, p_threshold: float = 0.05, effect_threshold: float = 1.0) -> DataFrame:
    """feature, robust z (difference of medians by pooled MAD) or Cohen's d, test statistic, p, BH fdr and significance."""
    x = _long(df, features, test, control)
    if nonparametric:
        m = with_group_stats(x, ["feature", "is_test"], {"med_": F.percentile("value", 0.5)})
        side = lambda c, k: F.when(F.col("is_test") == k, F.col(c))
        spread = m.withColumn("dev_", F.abs(F.col("value") - F.col("med_"))).groupBy("feature").agg(F.max(side("med_", True)).alias("test_center"), F.max(side("med_", False)).alias("control_center"), F.percentile("dev_", 0.5).alias("mad"))
        out = spread.withColumn("effect", F.coalesce(F.try_divide(STD_TO_MAD * (F.col("test_center") - F.col("control_center")), F.col("mad")), F.lit(0.0))).drop("mad")
        out = out.join(mann_whitney(x, "value", F.col("is_test"), ["feature"]).select("feature", F.col("u").alias("statistic"), "p"), "feature")
    else:
        side = lambda k: F.when(F.col("is_test") == k, F.col("value"))
        g = x.groupBy("feature").agg(*[f(side(k)).alias(f"{n}{i}") for i, k in ((1, True), (2, False)) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))])
        a, b = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
        pooled = F.sqrt(F.try_divide((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2"), F.col("n1") + F.col("n2") - 2))
        g = g.withColumns({"effect": F.coalesce(F.try_divide(F.col("m1") - F.col("m2"), pooled), F.lit(0.0)), "statistic": F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(a + b)), "df_": F.try_divide((a + b) * (a + b), a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1))})
        out = g.select("feature", F.col("m1").alias("test_center"), F.col("m2").alias("control_center"), "effect", "statistic", t_two_sided("statistic", "df_").alias("p"))
    # One row for each feature: thousands at most.
    out = benjamini_hochberg(out.withColumn("one_", F.lit(0)), "p", "fdr", by=["one_"], order=["feature"]).drop("one_")
    return out.withColumn("significant", (F.col("fdr") < p_threshold) & (F.abs("effect") >= effect_threshold))


def heatmap_values(df: DataFrame, features: list[str], where: Column, gene: str, z: str = "global") -> DataFrame:
    """Genes of chosen clusters x features, z-scored over all genes, over the chosen ones, or along each gene's features.

    Sample standard deviation; over all genes a deviation of 0 gives 0.
    """
    if z == "rows":
        v = F.array(*[clean(f).cast("double") for f in features])
        x = df.where(where).withColumn("v_", v)
        ok = F.filter("v_", lambda a: a.isNotNull())
        n = F.size(ok)
        mean = F.aggregate(ok, F.lit(0.0), lambda s, a: s + a) / n
        x = x.withColumn("m_", mean).withColumn("s_", F.sqrt(F.try_divide(F.aggregate(ok, F.lit(0.0), lambda s, a: s + (a - F.col("m_")) * (a - F.col("m_"))), n - 1)))
        return x.select(gene, *[F.try_divide(clean(f) - F.col("m_"), F.col("s_")).alias(f) for f in features])
    src = df if z == "global" else df.where(where)
    aggs = {f"m_{f}": F.avg(clean(f)) for f in features} | {f"s_{f}": F.stddev_samp(clean(f)) for f in features}
    x = with_group_stats(src, [], aggs).where(where)
    return x.select(gene, *[F.coalesce(F.try_divide(clean(f) - F.col(f"m_{f}"), F.col(f"s_{f}")), F.when(clean(f).isNotNull(), 0.0)).alias(f) for f in features])
