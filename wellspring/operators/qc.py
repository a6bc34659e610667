"""Summaries behind the quality plots: mapping rates, densities, histograms, missing values, pipeline statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.stats import anova_f, clean


def na_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column and percent_na of the columns that have missing values, from one aggregate."""
    types = dict(df.dtypes)
    columns = columns or df.columns
    missing = lambda c: (clean(c) if types[c] in ("double", "float") else F.col(c)).isNull()
    one = df.agg(*[F.avg(missing(c).cast("double")).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "percent_na").where("percent_na > 0")


def cell_summary(df: DataFrame, class_col: str, distinct: list[str]) -> DataFrame:
    """stage and count: all rows, and for each class its rows and the different values of some columns; percent of all rows (2 decimals)."""
    per = df.groupBy(F.col(class_col).cast("string").alias("class")).agg(F.count("*").alias("cells"), *[F.count_distinct(c).alias(c) for c in distinct])
    long = per.unpivot(["class"], ["cells", *distinct], "stage", "count")
    total = df.agg(F.count("*").alias("count")).select(F.lit("all").alias("class"), F.lit("cells").alias("stage"), "count")
    n = df.agg(F.count("*").alias("n_"))
    out = total.unionByName(long).crossJoin(F.broadcast(n))  # one row
    return out.withColumn("percent", F.round(F.try_divide(100 * F.col("count"), F.col("n_")), 2)).drop("n_")


def mapped(df: DataFrame, library: DataFrame, barcode: str = "barcode", library_col: str = "barcode", out: str = "mapped") -> DataFrame:
    """df with whether its barcode is in the library: a join on a distinct key, which can't add rows."""
    known = library.select(F.col(library_col).alias(barcode)).distinct().withColumn("in_", F.lit(True))
    return df.join(known, barcode, "left").withColumn(out, F.coalesce("in_", F.lit(False))).drop("in_")


def read_mapping_rate(reads: DataFrame, library: DataFrame, by: list[str], barcode: str = "barcode") -> DataFrame:
    """Share of mapped reads in each tile; tiles without any vanish."""
    return mapped(reads, library, barcode).groupBy(*by).agg(F.avg(F.col("mapped").cast("double")).alias("rate")).where("rate > 0")


def cell_mapping_rate(cells: DataFrame, info: DataFrame, by: list[str], keys: list[str], condition: Column) -> DataFrame:
    """Share of all segmented cells that meet a condition on their called barcodes; cells without a call count as not."""
    out = info.select(*keys).join(cells, keys, "left")
    return out.groupBy(*by).agg(F.avg(F.coalesce(condition, F.lit(False)).cast("double")).alias("rate")).where("rate > 0")


def mapping_overview(info: DataFrame, cells: DataFrame, by: list[str], gene: str = "gene_symbol", one_barcode: Column | None = None) -> DataFrame:
    """For each well: cells, those with a barcode, with one gene, with exactly one read barcode, and percents of the well's cells."""
    total = info.groupBy(*by).agg(F.count("*").alias("cells"))
    g0, g1 = F.col(f"{gene}_0"), F.col(f"{gene}_1")
    one_gene = g0.isNotNull() & (g1.isNull() | (g0 == g1))
    parts = {"any_barcode": g0.isNotNull(), "one_gene": one_gene} | ({"one_barcode": one_barcode} if one_barcode is not None else {})
    counts = cells.groupBy(*by).agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in parts.items()])
    out = total.join(counts, by, "left").na.fill(0, list(parts))
    return out.withColumns({f"percent_{n}": 100 * F.col(n) / F.col("cells") for n in parts})


def mapping_vs_threshold(reads: DataFrame, library: DataFrame, variable: str, thresholds: list[float], cell_keys: list[str], barcode: str = "barcode") -> DataFrame:
    """For each threshold: reads at or over it, mapped ones, their rate and the different cells that mapped ones are in.

    Each row only needs the highest threshold it reaches; each cell the highest among its mapped reads. One aggregate
    of both, then sums from the top: rows are never multiplied by thresholds.
    """
    at = F.lit(None).cast("int")
    for k, t in enumerate(sorted(thresholds)):
        at = F.when(F.col(variable) >= t, F.lit(k)).otherwise(at)
    r = mapped(reads, library, barcode).withColumn("k", at).where("k IS NOT NULL")
    counts = r.groupBy("k").agg(F.count("*").alias("reads"), F.count_if("mapped").alias("mapped"))
    cells = r.where("mapped").groupBy(*cell_keys).agg(F.max("k").alias("k")).groupBy("k").agg(F.count("*").alias("cells"))
    grid = reads.sparkSession.createDataFrame([(k, float(t)) for k, t in enumerate(sorted(thresholds))], "k int, threshold double")
    # A row for each threshold.
    top = Window.partitionBy(F.lit(0)).orderBy(F.desc("k"))
    out = grid.join(counts, "k", "left").join(cells, "k", "left").na.fill(0, ["reads", "mapped", "cells"])
    out = out.select("threshold", *[F.sum(c).over(top).alias(c) for c in ("reads", "mapped", "cells")])
    return out.withColumn("rate", F.coalesce(F.try_divide(F.col("mapped").cast("double"), F.col("reads")), F.lit(0.0)))


def prefix_match_rate(reads: DataFrame, library: DataFrame, length: int, barcode: str = "barcode", library_col: str = "barcode") -> DataFrame:
    """length, rate (reads whose prefix of that length starts some library barcode), and expected (different prefixes / 4 ** length)."""
    lengths = F.sequence(F.lit(1), F.lit(length))
    cut = lambda df, c: df.where(F.col(c).isNotNull()).select(F.explode(F.transform(lengths, lambda n: F.struct(n.alias("length"), F.substr(F.col(c), F.lit(1), n).alias("prefix")))).alias("p")).select("p.*")
    known = cut(library, library_col).distinct().withColumn("in_", F.lit(1))
    # Equal prefixes are counted before they meet the library.
    got = cut(reads, barcode).groupBy("length", "prefix").agg(F.count("*").alias("n")).join(known, ["length", "prefix"], "left")
    rate = got.groupBy("length").agg((F.sum(F.when(F.col("in_") == 1, F.col("n")).otherwise(0)) / F.sum("n")).alias("rate"))
    random = known.groupBy("length").agg(F.count("*").alias("prefixes"))
    return rate.join(random, "length", "left").withColumn("expected", F.coalesce("prefixes", F.lit(0)) / F.pow(F.lit(4.0), "length"))


def density_grid(cells: DataFrame, by: list[str], tile: str = "tile") -> DataFrame:
    """Cells in every tile of each well from 0 to the highest, empty ones as 0."""
    count = cells.groupBy(*by, tile).agg(F.count("*").alias("cells"))
    grid = cells.groupBy(*by).agg(F.max(tile).alias("m")).select(*by, F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long"))).alias(tile))
    return grid.join(count.withColumn(tile, F.col(tile).cast("long")), [*by, tile], "left").na.fill(0, ["cells"])


def histogram(df: DataFrame, value: str, width: float, cutoff: float | None = None) -> DataFrame:
    """bin (its lower end) and count; values over the cutoff are put in the bin of the cutoff."""
    v = F.least(F.col(value), F.lit(cutoff)) if cutoff is not None else F.col(value)
    return df.where(clean(F.col(value).cast("double")).isNotNull()).groupBy((F.floor(v / width) * width).alias("bin")).agg(F.count("*").alias("count"))


def gene_histogram(cells: DataFrame, gene: str) -> DataFrame:
    """Cells of each gene, and whether it has more than Q3 + 1.5 IQR of them."""
    n = cells.where(F.col(gene).isNotNull()).groupBy(gene).agg(F.count("*").alias("cells"))
    q = n.agg(F.percentile("cells", 0.25).alias("q1"), F.percentile("cells", 0.75).alias("q3"))
    return n.crossJoin(F.broadcast(q)).withColumn("outlier", F.col("cells") > F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).drop("q1", "q3")  # one row


def tile_heatmap(df: DataFrame, feature: str, by: list[str], how: str = "median") -> DataFrame:
    f = clean(F.col(feature).cast("double"))
    agg = {"median": lambda: F.percentile(f, 0.5), "mean": lambda: F.avg(f), "sum": lambda: F.sum(f), "count": lambda: F.count(f)}[how]()
    return df.groupBy(*by).agg(agg.alias(feature))


def segmentation_overview(stats: DataFrame, by: list[str]) -> DataFrame:
    """Sum of every numeric statistic of the tiles in each well."""
    numbers = [c for c, t in stats.dtypes if c not in by and c != "tile" and t in ("int", "bigint", "double", "float")]
    return stats.groupBy(*by).agg(*[F.sum(c).alias(c) for c in numbers])


def match_heatmap(info: DataFrame, merged: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Share of cells that were matched, of each tile; tiles without any vanish."""
    found = merged.select(*keys).distinct().withColumn("in_", F.lit(1))
    return info.join(found, keys, "left").groupBy(*by).agg(F.avg(F.col("in_").isNotNull().cast("double")).alias("rate")).where("rate > 0")


def parameter_search(results: DataFrame, parameters: list[str], metrics: list[str]) -> DataFrame:
    """Means of the metrics (2 decimals) of each parameter set, their product as score, best first."""
    out = results.groupBy(*parameters).agg(*[F.round(F.avg(m), 2).alias(m) for m in metrics])
    product = F.lit(1.0)
    for m in metrics:
        product = product * F.col(m)
    return out.withColumn("score", product).orderBy(F.desc("score"), *parameters)


def best_parameters(results: DataFrame, metric: str, maximize: bool = True, success: str | None = None, tolerance: float = 1e-9) -> DataFrame:
    """Every successful row whose metric ties with the best."""
    ok = results.where(F.col(success)) if success else results
    top = ok.agg((F.max if maximize else F.min)(metric).alias("best_"))
    return ok.crossJoin(F.broadcast(top)).where(F.abs(F.col(metric) - F.col("best_")) <= tolerance).drop("best_")  # one row


def barcode_fractions(cells: DataFrame, total: int | None = None, gene: str = "gene_symbol") -> DataFrame:
    """One row: shares of cells with one, with any barcode, and specificity (one / any, 0 where none has any)."""
    g0, g1 = F.col(f"{gene}_0"), F.col(f"{gene}_1")
    c = cells.agg(F.count_if(g0.isNotNull() & g1.isNull()).alias("one"), F.count_if(g0.isNotNull()).alias("any"), (F.lit(total) if total else F.count("*")).alias("n"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return c.select(share("one", "n").alias("one_barcode"), share("any", "n").alias("any_barcode"), share("one", "any").alias("specificity"))


def trimmed_long(df: DataFrame, features: list[str], keys: list[str], group: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Features as rows, without what is outside the 1 to 99 % range of its group and feature."""
    long = df.select(group, *keys, *[F.col(f).cast("double").alias(f) for f in features]).unpivot([group, *keys], features, "feature", "value").where("value IS NOT NULL")
    q = long.groupBy(group, "feature").agg(F.percentile("value", low).alias("lo_"), F.percentile("value", high).alias("hi_"))
    return long.join(q, [group, "feature"]).where("value BETWEEN lo_ AND hi_").drop("lo_", "hi_")


def batch_effects(df: DataFrame, features: list[str], batch: str, control: Column) -> DataFrame:
    """One row: the median over features of the analysis-of-variance p-value of controls by batch."""
    long = df.where(control).select(batch, *[F.col(f).cast("double").alias(f) for f in features]).unpivot([batch], features, "feature", "value")
    return anova_f(long, "value", batch, ["feature"]).agg(F.percentile("p", 0.5).alias("median_p"), F.count("p").alias("features"))


def pipeline_stats(tables: dict[str, DataFrame], percents: list[str] | None = None) -> DataFrame:
    """module, metric, value: rows of each table, sums of its counts and unweighted means of its percents."""
    out = None
    for name, t in tables.items():
        numbers = [c for c, k in t.dtypes if k in ("int", "bigint", "double", "float")]
        mean = lambda c: c in (percents or []) or "percent" in c or "rate" in c
        one = t.agg(F.count("*").cast("double").alias("rows"), *[(F.avg(c) if mean(c) else F.sum(c)).cast("double").alias(c) for c in numbers])
        one = one.unpivot([], ["rows", *numbers], "metric", "value").withColumn("module", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select("module", "metric", "value")


def unseen_counts(inside: DataFrame, outside: DataFrame, by: list[str]) -> DataFrame:
    """Rows inside and outside of a gate in each tile, missing ones as 0."""
    a, b = inside.groupBy(*by).agg(F.count("*").alias("inside")), outside.groupBy(*by).agg(F.count("*").alias("outside"))
    return a.join(b, by, "full").na.fill(0, ["inside", "outside"])
