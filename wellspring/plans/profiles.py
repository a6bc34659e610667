"""Queries of filtering, normalisation, aggregation and testing of cell features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.functions import stats
from wellspring.operators import bootstrap, classify, filters, merge, normalise, qc
from wellspring.plans.roles import BATCH, CELLS_SQL, FEATURES, KEYS, cells, control, rounded, table
from wellspring.session import materialize
from wellspring.sources import tables as sources

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _each(template: str, features: list[str] = FEATURES) -> str:
    return ", ".join(template.format(f=f) for f in features)


_MAD_CTES = f"""{CELLS_SQL},
med AS (SELECT plate, well, {_each("median({f}) AS m_{f}")} FROM cells WHERE gene LIKE 'Brand#1%' GROUP BY plate, well),
mad AS (SELECT plate, well, {_each("median(abs({f} - m_{f})) AS s_{f}")} FROM cells JOIN med USING (plate, well)
        WHERE gene LIKE 'Brand#1%' GROUP BY plate, well),
z AS (SELECT construct, gene, {_each("0.6745 * ({f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END AS {f}")}
      FROM cells JOIN med USING (plate, well) JOIN mad USING (plate, well)),
c AS (SELECT construct, gene, count(*) AS n, {_each("median({f}) AS {f}")} FROM z GROUP BY construct, gene)"""


def _constructs(spark, d) -> DataFrame:
    z = normalise.scale_on_controls(cells(spark, d), FEATURES, control(), BATCH, "mad")
    return normalise.construct_table(z, FEATURES, "construct", "gene")


@query(f"WITH {_MAD_CTES} SELECT gene, CAST(sum(n) AS BIGINT) AS cell_count, {_each('round(median({f}), 4) AS {f}')} FROM c GROUP BY gene")
def gene_profile_mad(spark, d):
    return rounded(normalise.gene_table(_constructs(spark, d), FEATURES, "gene"))


@query(f"WITH {_MAD_CTES} SELECT construct, gene, n AS cell_count, {_each('round({f}, 4) AS {f}')} FROM c")
def construct_profile_mad(spark, d):
    return rounded(_constructs(spark, d))


@query(f"""WITH {CELLS_SQL} SELECT {", ".join(KEYS)}, {_each("round(({f} - avg({f}) OVER w) / CASE WHEN stddev_pop({f}) OVER w = 0 THEN 1 ELSE stddev_pop({f}) OVER w END, 4) AS {f}", ["q", "price"])}
FROM cells WINDOW w AS (PARTITION BY plate, well)""")
def batch_zscore(spark, d):
    return rounded(normalise.center_scale(cells(spark, d), ["q", "price"], BATCH).select(*KEYS, "q", "price"))


@query(f"""WITH {CELLS_SQL}, s AS (SELECT plate, well, avg(q) AS m, stddev_pop(q) AS sd, avg(tax) AS mt, stddev_pop(tax) AS st FROM cells WHERE gene LIKE 'Brand#1%' GROUP BY plate, well)
SELECT {", ".join(KEYS)}, round((q - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 4) AS q, round((tax - mt) / CASE WHEN st = 0 THEN 1 ELSE st END, 4) AS tax FROM cells JOIN s USING (plate, well)""")
def control_zscore(spark, d):
    return rounded(normalise.scale_on_controls(cells(spark, d), ["q", "tax"], control(), BATCH).select(*KEYS, "q", "tax"))


@query(f"WITH {CELLS_SQL} SELECT gene, count(*) AS cell_count, {_each('round(avg({f}), 4) AS {f}')} FROM cells GROUP BY gene")
def aggregate_mean(spark, d):
    return rounded(normalise.aggregate(cells(spark, d), FEATURES, "gene"))


@query(f"WITH {CELLS_SQL} SELECT gene, count(*) AS cell_count, {_each('round(median({f}), 4) AS {f}')} FROM cells GROUP BY gene")
def aggregate_median(spark, d):
    return rounded(normalise.aggregate(cells(spark, d), FEATURES, "gene", "median"))


@query(f"""WITH {CELLS_SQL}, s AS (SELECT *, nullif(disc, 0.05) AS score FROM cells), t AS (SELECT quantile_cont(score, 0.3) AS low FROM s)
SELECT gene, count(*) AS cell_count, round(avg(q), 4) AS q FROM s, t WHERE score IS NULL OR score >= low GROUP BY gene""")
def aggregate_score_gate(spark, d):
    df = cells(spark, d).withColumn("score", F.expr("nullif(disc, 0.05D)"))
    return rounded(normalise.aggregate(filters.score_gate(df, "score", percentile=30), ["q"], "gene"))


@query(f"""WITH {CELLS_SQL}, k AS (SELECT concat_ws('_', plate, well) AS batch, CASE WHEN gene = 'Brand#11' THEN concat_ws('_', gene, CAST(construct AS VARCHAR)) ELSE gene END AS gene FROM cells)
SELECT batch, gene, count(*) AS n FROM k GROUP BY batch, gene""")
def suffixed_controls(spark, d):
    df = normalise.suffix_controls(normalise.batch_column(cells(spark, d), BATCH, "batch"), "gene", "Brand#11", "construct")
    return df.groupBy("batch", "gene").agg(F.count("*").alias("n"))


@query(f"""WITH {CELLS_SQL}, s AS (SELECT construct, gene, {_each("median({f}) AS {f}")} FROM cells GROUP BY construct, gene) SELECT construct, gene, {_each("round({f}, 4) AS {f}")} FROM s""")
def packed_medians(spark, d):
    p = normalise.packed_medians(normalise.pack(cells(spark, d), FEATURES), ["construct", "gene"])
    return p.select("construct", "gene", *[F.round(F.col("x")[i], 4).alias(f) for i, f in enumerate(FEATURES)])


@query("""WITH n AS (SELECT 'value' AS "column", avg(CASE WHEN value < 20 THEN 1.0 ELSE 0.0 END) AS p FROM events
UNION ALL SELECT 'event_type', avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) FROM events)
SELECT "column", round(p, 9) AS percent_na FROM n WHERE p > 0""")
def na_summary(spark, d):
    df = table(spark, d, "events").select("event_id", F.expr("CASE WHEN value >= 20 THEN value END").alias("value"), F.expr("nullif(event_type, 'click')").alias("event_type"))
    return rounded(qc.na_summary(df), 9)



@query(f"""WITH {CELLS_SQL}, t AS (SELECT count(*) AS n FROM cells), p AS (SELECT plate AS class, count(*) AS c, count(DISTINCT gene) AS g, count(DISTINCT construct) AS k FROM cells GROUP BY plate),
l AS (SELECT 'all' AS class, 'cells' AS stage, n AS count FROM t UNION ALL SELECT class, 'cells', c FROM p UNION ALL SELECT class, 'gene', g FROM p UNION ALL SELECT class, 'construct', k FROM p)
SELECT class, stage, count, round(100 * count / n, 2) AS percent FROM l, t""")
def cell_summary(spark, d):
    return qc.cell_summary(cells(spark, d), "plate", ["gene", "construct"])


@query(f"""WITH {CELLS_SQL} SELECT {", ".join(KEYS)} FROM cells WHERE q > 10 AND disc <= 0.05 AND (plate <> 'A' OR plate IS NULL) AND gene IN ('Brand#11', 'Brand#22', 'Brand#33') AND 2 < tax * 100 AND tax * 100 <= 6""")
def query_filter_chain(spark, d):
    q = ["q > 10 and disc <= 0.05", "plate != 'A'", "gene in ['Brand#11', 'Brand#22', 'Brand#33'] & (@low < tax * 100 <= 6)"]
    return filters.query_filter(cells(spark, d), q, {"low": 2}).select(*KEYS)


@query(f"""WITH {CELLS_SQL}, n AS (SELECT *, CASE WHEN q > 25 THEN q END AS a, CASE WHEN disc > 0.02 THEN disc END AS b, CASE WHEN tax > 0.01 THEN tax END AS c FROM cells)
SELECT {", ".join(KEYS)}, b, c FROM n WHERE (CASE WHEN b IS NULL THEN 1 ELSE 0 END + CASE WHEN c IS NULL THEN 1 ELSE 0 END) / 2.0 < 0.5""")
def missing_values(spark, d):
    df = cells(spark, d).select(*KEYS, F.expr("CASE WHEN q > 25 THEN q END").alias("a"), F.expr("CASE WHEN disc > 0.02D THEN disc END").alias("b"), F.expr("CASE WHEN tax > 0.01D THEN tax END").alias("c"))
    return filters.missing_values_filter(df, ["a", "b", "c"], 0.45, 0.5)[0]


@query(f"""WITH {CELLS_SQL} SELECT {", ".join(KEYS)}, least(q, price / 1000, 100 * tax) AS channel_min, round(sqrt(pow(q - 25, 2) + pow(100 * disc - 5, 2)), 6) AS fov FROM cells""")
def merge_columns(spark, d):
    df = cells(spark, d)
    return df.select(*KEYS, merge.channel_min([F.col("q"), F.col("price") / 1000, 100 * F.col("tax")]).alias("channel_min"), F.round(merge.fov_distance(F.col("q"), 100 * F.col("disc"), 50, 10), 6).alias("fov"))


@query(f"""WITH {CELLS_SQL}, q AS (SELECT quantile_cont(q, 0.25) AS a, median(q) AS m, quantile_cont(q, 0.75) AS b FROM cells), k AS (SELECT plate, CASE WHEN (q - m) / (b - a) > 0.8 THEN 'mitotic' ELSE 'interphase' END AS class FROM cells, q)
SELECT plate, class, count(*) AS n FROM k GROUP BY plate, class""")
def threshold_classes(spark, d):
    k = classify.ThresholdClassifier("q", 0.8).classify_cells(cells(spark, d))
    return k.groupBy("plate", "class").agg(F.count("*").alias("n"))


@query(f"""WITH {CELLS_SQL}, q AS (SELECT quantile_cont(q, 0.25) AS a, median(q) AS m, quantile_cont(q, 0.75) AS b FROM cells), k AS (SELECT *, CASE WHEN (q - m) / (b - a) > 0.8 THEN 'mitotic' ELSE 'interphase' END AS class FROM cells, q)
SELECT {", ".join(KEYS)}, class, round(row_number() OVER (PARTITION BY class ORDER BY q, {", ".join(KEYS)}) / count(*) OVER (PARTITION BY class), 9) AS confidence FROM k""")
def rank_confidence(spark, d):
    return rounded(classify.ThresholdClassifier("q", 0.8, keys=KEYS).classify_cells(cells(spark, d)).select(*KEYS, "class", "confidence"), 9)


_P = f"""{CELLS_SQL}, p AS (SELECT gene, construct, avg(CASE WHEN q > 25 THEN 1.0 ELSE 0.0 END) AS p FROM cells GROUP BY gene, construct)"""


def _p_table(spark, d):
    return cells(spark, d).groupBy("gene", "construct").agg(F.avg(F.when(F.col("q") > 25, 1.0).otherwise(0.0)).alias("p"))


@query(f"""WITH {_P}, r AS (SELECT *, p * count(*) OVER (PARTITION BY gene) / row_number() OVER (PARTITION BY gene ORDER BY p, construct) AS v FROM p)
SELECT gene, construct, round(p, 9) AS p, round(least(1.0, min(v) OVER (PARTITION BY gene ORDER BY p DESC, construct DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 9) AS fdr FROM r""")
def bh_fdr(spark, d):
    return rounded(stats.benjamini_hochberg(_p_table(spark, d), "p", "fdr", by=["gene"], order=["construct"]), 9)


@query(f"""WITH {_P}, r AS (SELECT *, p * count(*) OVER () / rank() OVER (ORDER BY p DESC) AS x, count(*) OVER () - rank() OVER (ORDER BY p DESC) + 1 AS k FROM p),
v AS (SELECT *, p * count(*) OVER () / k AS v FROM r)
SELECT gene, construct, round(p, 9) AS p, round(least(1.0, (SELECT min(w.v) FROM v AS w WHERE w.p >= v.p)), 9) AS fdr FROM v""")
def bh_fdr_pooled(spark, d):
    return rounded(stats.benjamini_hochberg(_p_table(spark, d), "p", "fdr"), 9)


@query(f"""WITH {CELLS_SQL}, o AS (SELECT gene, median(price) AS o FROM cells GROUP BY gene), n AS (SELECT construct AS sim, avg(price) AS v FROM cells GROUP BY construct),
s AS (SELECT gene, avg(CASE WHEN v > o THEN 1.0 ELSE 0.0 END) AS share FROM o, n GROUP BY gene) SELECT gene, round(2 * least(share, 1 - share), 9) AS price_pval FROM s""")
def fold_pvalue(spark, d):
    df = cells(spark, d)
    # Equal prices are counted first: an exact median holds every row of a gene that it is given.
    prices = df.groupBy("gene", "price").agg(F.count("*").alias("n"))
    observed = prices.groupBy("gene").agg(F.percentile("price", 0.5, F.col("n")).alias("price"))
    nulls = df.groupBy(F.col("construct").alias("sim")).agg(F.array(F.avg("price")).alias("x"))
    return rounded(bootstrap.p_values(nulls, observed, ["price"], "gene").drop("num_sims"), 9)


@query()
def bootstrap_genes(spark, d):
    df = cells(spark, d)
    c = materialize(normalise.construct_table(df, ["q", "price"], "construct", "gene"), "constructs")
    nulls = bootstrap.construct_bootstrap(c, df.where(control()), ["q", "price"], "construct", sims=50, keep="gene", write=False)
    genes = bootstrap.gene_null(nulls, None, "construct", "gene")
    observed = normalise.gene_table(c, ["q", "price"], "gene")
    return bootstrap.correct_pooled(bootstrap.p_values(genes, observed, ["q", "price"], "gene"), ["q", "price"], "gene")


@query(f"""WITH {CELLS_SQL}, g AS (SELECT *, row_number() OVER (ORDER BY 1) AS z FROM cells WHERE gene LIKE 'Brand#1%' OR gene = 'Brand#25'), l AS (
SELECT gene = 'Brand#25' AS t, 'q' AS feature, q AS v FROM g UNION ALL SELECT gene = 'Brand#25', 'tax', tax FROM g),
r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS rk FROM l)
SELECT feature, count(*) FILTER (t) AS n1, count(*) FILTER (NOT t) AS n2, round(sum(rk) FILTER (t) - count(*) FILTER (t) * (count(*) FILTER (t) + 1) / 2.0, 3) AS u FROM r GROUP BY feature""")
def mann_whitney_u(spark, d):
    df = cells(spark, d).where(control() | (F.col("gene") == "Brand#25")).withColumn("t", F.col("gene") == "Brand#25")
    long = df.unpivot(["t"], ["q", "tax"], "feature", "v")
    return rounded(stats.mann_whitney(long, "v", F.col("t"), ["feature"]).select("feature", "n1", "n2", "u"), 3)


@query(f"""WITH {CELLS_SQL}, g AS (SELECT plate || well AS b, count(*) AS n, sum(price) AS s, sum(price * price) AS q FROM cells WHERE gene LIKE 'Brand#1%' GROUP BY 1),
a AS (SELECT count(*) AS k, sum(n) AS n, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM g) SELECT 'price' AS feature, round((b - s * s / n) / (k - 1) / ((q - b) / (n - k)), 4) AS f FROM a""")
def batch_anova(spark, d):
    long = cells(spark, d).where(control()).select(F.concat("plate", "well").alias("b"), F.lit("price").alias("feature"), F.col("price").alias("v"))
    return rounded(stats.anova_f(long, "v", "b", ["feature"]).select("feature", "f"))


@query(f"""WITH {CELLS_SQL}, g AS (SELECT *, price AS v FROM cells WHERE q > 10), t AS (SELECT quantile_cont(v, 0.1) AS a, quantile_cont(v, 0.9) AS b FROM g), i AS (SELECT g.* FROM g, t WHERE v > a AND v < b)
SELECT plate, 'in' AS pool, count(*) AS n FROM i GROUP BY plate UNION ALL
SELECT plate, 'out', count(*) FROM cells WHERE (l_orderkey, construct, l_suppkey, l_linenumber) NOT IN (SELECT (l_orderkey, construct, l_suppkey, l_linenumber) FROM i) GROUP BY plate""")
def gate_pools(spark, d):
    inside, outside = filters.gate_pools(cells(spark, d), [{"column": "q", "low": 10}, {"column": "price", "low_pct": 10, "high_pct": 90}], KEYS)
    n = lambda df, name: df.groupBy("plate").agg(F.count("*").alias("n")).select("plate", F.lit(name).alias("pool"), "n")
    return n(inside, "in").unionByName(n(outside, "out"))


@query("""WITH x AS (SELECT doc_id, quality AS class, CASE WHEN n_chars > 4000 THEN 0.9 ELSE n_chars / 5000.0 END AS p1, lang FROM documents JOIN labels USING (doc_id)),
y AS (SELECT *, 1 - p1 AS p0, CASE WHEN class = 1 THEN p1 ELSE 1 - p1 END AS conf FROM x)
SELECT doc_id, class, round(conf, 9) AS confidence FROM y WHERE NOT (class = 1 AND conf < 0.4) AND NOT (class = 0 AND conf < 0.6)""")
def class_threshold_exclude(spark, d):
    return rounded(filters.class_thresholds(_classes(spark, d), "class", "confidence", {0: 0.6, 1: 0.4}).select("doc_id", "class", "confidence"), 9)


def _classes(spark, d):
    x = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    x = x.select("doc_id", F.col("quality").alias("class"), F.expr("CASE WHEN n_chars > 4000 THEN 0.9D ELSE n_chars / 5000.0D END").alias("p1"))
    return x.withColumn("p0", 1 - F.col("p1")).withColumn("confidence", F.when(F.col("class") == 1, F.col("p1")).otherwise(F.col("p0")))


@query("""WITH x AS (SELECT doc_id, quality AS class, CASE WHEN n_chars > 4000 THEN 0.9 ELSE n_chars / 5000.0 END AS p1 FROM documents JOIN labels USING (doc_id)),
y AS (SELECT *, 1 - p1 AS p0, CASE WHEN class = 1 THEN p1 ELSE 1 - p1 END AS conf FROM x),
z AS (SELECT doc_id, CASE WHEN class = 1 AND conf < 0.4 THEN CASE WHEN p0 >= 0.7 THEN 0 END WHEN class = 0 AND conf < 0.7 THEN NULL ELSE class END AS class,
  CASE WHEN class = 1 AND conf < 0.4 THEN p0 ELSE conf END AS conf FROM y)
SELECT doc_id, CAST(class AS INTEGER) AS class, round(conf, 9) AS confidence FROM z WHERE class IS NOT NULL""")
def class_threshold_reassign(spark, d):
    spec = {0: {"threshold": 0.7, "mode": "exclude"}, 1: {"threshold": 0.4, "mode": "reassign"}}
    return rounded(filters.class_thresholds(_classes(spark, d), "class", "confidence", spec, {0: "p0", 1: "p1"}).select("doc_id", "class", "confidence"), 9)


@query(f"""WITH {CELLS_SQL} SELECT construct AS tile, count(*) AS n FROM cells WHERE construct IN (SELECT construct FROM cells GROUP BY construct HAVING count(DISTINCT l_suppkey) > 1) GROUP BY construct""")
def tile_diversity(spark, d):
    return filters.diverse_tiles(cells(spark, d), "construct", "l_suppkey").groupBy(F.col("construct").alias("tile")).agg(F.count("*").alias("n"))


@query("""WITH m AS (SELECT median(s_acctbal) AS m FROM supplier), a AS (SELECT median(abs(s_acctbal - m)) AS mad FROM supplier, m)
SELECT s_suppkey FROM supplier, m, a WHERE s_acctbal >= m - 0.5 * 1.4826 * mad""")
def seed_mad_filter(spark, d):
    return filters.drop_low_seeds(table(spark, d, "supplier"), "s_acctbal", ["s_suppkey"], k=0.5).select("s_suppkey")


@query("""SELECT 'a' AS name, 'bigint' AS type UNION ALL SELECT 'b', CASE WHEN bool_and(p_size % 1 = 0) THEN 'bigint' ELSE 'double' END FROM part UNION ALL SELECT 'c', CASE WHEN bool_and(p_retailprice % 1 = 0) THEN 'bigint' ELSE 'double' END FROM part
UNION ALL SELECT 'e', 'boolean' UNION ALL SELECT 'p_name', CASE WHEN bool_and(try_cast(p_name AS DOUBLE) IS NOT NULL) THEN 'double' ELSE 'string' END FROM part""")
def infer_types(spark, d):
    df = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("a"), F.col("p_size").cast("double").alias("b"), F.col("p_retailprice").cast("string").alias("c"), F.when(F.col("p_size") > 10, "True").otherwise("false").alias("e"), "p_name")
    return spark.createDataFrame(sources.infer_dtypes(df).dtypes, "name string, type string")


@query("""SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL ORDER BY p_retailprice DESC, p_partkey LIMIT 20""")
def top_cells(spark, d):
    from wellspring.operators.images import montage_cells

    df = table(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("i"), F.col("p_size").alias("j"))
    return montage_cells(df, 20, [F.desc("i")], ["p_partkey"]).select("p_partkey")


@query(f"""WITH {CELLS_SQL}, l AS (SELECT plate, 'q' AS feature, q AS value FROM cells UNION ALL SELECT plate, 'price', price FROM cells), t AS (SELECT plate, feature, quantile_cont(value, 0.01) AS a, quantile_cont(value, 0.99) AS b FROM l GROUP BY plate, feature)
SELECT plate, feature, count(*) AS n, round(avg(value), 4) AS mean FROM l JOIN t USING (plate, feature) WHERE value BETWEEN a AND b GROUP BY plate, feature""")
def trimmed_distributions(spark, d):
    t = qc.trimmed_long(cells(spark, d), ["q", "price"], KEYS, "plate")
    return rounded(t.groupBy("plate", "feature").agg(F.count("*").alias("n"), F.avg("value").alias("mean")))


def _vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.concat(F.lit("gene_"), "label").alias("gene"), F.expr("CASE WHEN vec_id % 2 = 0 THEN 'a' ELSE 'b' END").alias("batch"), F.col("embedding").cast("array<double>").alias("x"))


@query()
def pca_embed(spark, d):
    out, _ = normalise.pca(_vectors(spark, d), "x", 0.8)
    return out.select("vec_id", F.transform("x", lambda v: F.round(v, 3)).alias("x"))


@query("""WITH l AS (SELECT vec_id, generate_subscripts(embedding, 1) AS k, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), s AS (SELECT k, avg(v) AS m, stddev_pop(v) AS sd FROM l GROUP BY 1)
SELECT vec_id, round(sqrt(sum(pow((v - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 2))), 4) AS length FROM l JOIN s USING (k) GROUP BY 1""")
def pca_lengths(spark, d):
    """With all components kept a rotation: lengths stay those of the scaled vectors."""
    out, share = normalise.pca(_vectors(spark, d), "x", len(_vectors(spark, d).first().x))
    return out.select("vec_id", F.round(F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)), 4).alias("length"))


@query()
def tvn(spark, d):
    return normalise.tvn(_vectors(spark, d), "x", F.col("gene").isin("gene_0", "gene_1", "gene_2", "gene_3", "gene_4"), "batch").select("vec_id", "batch", F.transform("x", lambda v: F.round(v, 3)).alias("x"))


@query("""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 'a' ELSE 'b' END AS batch, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
d AS (SELECT a.batch, a.vec_id AS i, b.vec_id AS j, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) AS d FROM v a JOIN v b ON a.batch = b.batch AND a.vec_id <> b.vec_id),
n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, j) <= 20), k AS (SELECT i AS j, max(d) AS k FROM n GROUP BY 1), r AS (SELECT batch, i, 1 / (avg(greatest(d, k)) + 1e-10) AS lrd FROM n JOIN k USING (j) GROUP BY 1, 2),
f AS (SELECT n.batch, n.i, avg(o.lrd) / max(r.lrd) AS f FROM n JOIN r o ON o.i = n.j JOIN r ON r.i = n.i GROUP BY 1, 2), c AS (SELECT batch, quantile_cont(f, 0.95) AS cut FROM f GROUP BY 1)
SELECT vec_id, v.batch, x AS cell_c0_mean, y AS cell_c1_mean, z AS cell_c2_mean FROM v JOIN f ON f.i = vec_id JOIN c ON c.batch = v.batch WHERE f <= cut""")
def lof_filter(spark, d):
    v = _vectors(spark, d).select("vec_id", "batch", *[F.col("x")[i].alias(f"cell_c{i}_mean") for i in range(3)])
    return filters.intensity_filter(v, [f"cell_c{i}_mean" for i in range(3)], ["c0", "c1", "c2"], 0.05, ["batch"], keys=["vec_id"])


_KNN = ", ".join(f"CASE WHEN vec_id % {7 + i} <> 0 THEN CAST(embedding[{i + 1}] AS DOUBLE) END AS f{i}" for i in range(4))


@query(f"""WITH v AS (SELECT vec_id, {_KNN} FROM embeddings), d AS (SELECT a.vec_id AS i, b.vec_id AS j, {" + ".join(f"CASE WHEN a.f{i} IS NOT NULL AND b.f{i} IS NOT NULL THEN pow(a.f{i} - b.f{i}, 2) ELSE 0 END" for i in range(4))} AS s, {" + ".join(f"CASE WHEN a.f{i} IS NOT NULL AND b.f{i} IS NOT NULL THEN 1 ELSE 0 END" for i in range(4))} AS n FROM v a, v b WHERE a.f0 IS NULL OR a.f1 IS NULL OR a.f2 IS NULL OR a.f3 IS NULL),
l AS (SELECT i, j, s * 4 / n AS d FROM d WHERE n > 0), {", ".join(f"k{c} AS (SELECT i, avg(f{c}) AS m FROM (SELECT i, f{c} FROM l JOIN v ON vec_id = j AND f{c} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, j) <= 5) GROUP BY 1)" for c in range(4))}
SELECT v.vec_id, {", ".join(f"round(coalesce(v.f{c}, k{c}.m, (SELECT avg(f{c}) FROM v)), 6) AS f{c}" for c in range(4))} FROM v {" ".join(f"LEFT JOIN k{c} ON k{c}.i = v.vec_id" for c in range(4))}""")
def knn_impute(spark, d):
    v = _vectors(spark, d).select("vec_id", *[F.when(F.pmod("vec_id", F.lit(7 + i)) != 0, F.col("x")[i]).alias(f"f{i}") for i in range(4)])
    return rounded(filters.impute_knn(v, [f"f{i}" for i in range(4)], ["vec_id"]), 6)


@query()
def perturbation_score(spark, d):
    v = _vectors(spark, d).select("vec_id", "gene", *[F.col("x")[i].alias(f"f{i}") for i in range(16)])
    return bootstrap.perturbation_scores(v, [f"f{i}" for i in range(16)], "gene", F.col("gene") == "gene_0", ["vec_id"], least=20)


@query()
def trained_classes(spark, d):
    v = _vectors(spark, d).select("vec_id", F.when(F.col("gene") == "gene_0", "pos").otherwise("neg").alias("label"), *[F.col("x")[i].alias(f"f{i}") for i in range(8)])
    model, _ = classify.TrainedClassifier.train(v, [f"f{i}" for i in range(8)], "label")
    return model.classify_cells(v).select("vec_id", "class", F.round("confidence", 3).alias("confidence"))
