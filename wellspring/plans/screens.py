"""Queries of base and cell calling, matching, de-duplication, quality summaries and cluster benchmarks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellspring.functions import barcodes
from wellspring.operators import cluster, graph, images, joins, merge, qc, registration, sbs
from wellspring.plans.roles import CELLS_SQL, KEYS, cells, rounded, table
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


def _reads(spark, d):
    """Events as reads: the user is the cell, the event's kind the barcode, its value the peak."""
    return table(spark, d, "events").select(F.col("event_id").alias("read"), F.col("user_id").alias("cell"), F.col("event_type").alias("barcode"), F.col("value").alias("peak"))


def _library(spark, d):
    return _reads(spark, d).select("barcode").distinct().where(F.col("barcode").isin("click", "view", "purchase"))


_TOP2 = """WITH r AS (SELECT user_id AS cell, event_type AS barcode, count(*) AS c, max(value) AS p FROM events GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY {by} DESC, barcode) AS k, sum(c) OVER (PARTITION BY cell) AS t FROM r)
SELECT cell, CAST(max(t) AS BIGINT) AS n_reads, max(barcode) FILTER (k = 1) AS barcode_0, max({by}) FILTER (k = 1) AS {name}_0,
       max(barcode) FILTER (k = 2) AS barcode_1, max({by}) FILTER (k = 2) AS {name}_1 FROM k WHERE k <= 2 GROUP BY cell"""


@query(_TOP2.format(by="c", name="count"))
def top2_barcodes_count(spark, d):
    return sbs.top_barcodes(_reads(spark, d), ["cell"], sort="count")


@query(_TOP2.format(by="p", name="peak"))
def top2_barcodes_peak(spark, d):
    return sbs.top_barcodes(_reads(spark, d), ["cell"], sort="peak")


@query("""WITH r AS (SELECT user_id AS cell, event_type AS barcode, count(*) AS c, max(CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 1 ELSE 0 END) AS m FROM events WHERE value >= 5 AND user_id > 0 GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY m DESC, c DESC, barcode) AS k, sum(c) OVER (PARTITION BY cell) AS t FROM r),
w AS (SELECT cell, CAST(max(t) AS BIGINT) AS n_reads, max(barcode) FILTER (k = 1) AS barcode_0, max(c) FILTER (k = 1) AS count_0, max(barcode) FILTER (k = 2) AS barcode_1, max(c) FILTER (k = 2) AS count_1 FROM k WHERE k <= 2 GROUP BY cell)
SELECT w.*, CASE WHEN barcode_0 IN ('click', 'view', 'purchase') THEN upper(barcode_0) END AS gene_symbol_0, CASE WHEN barcode_1 IN ('click', 'view', 'purchase') THEN upper(barcode_1) END AS gene_symbol_1 FROM w""")
def call_cells(spark, d):
    lib = _library(spark, d).select(F.col("barcode").alias("prefix"), F.upper("barcode").alias("gene_symbol"))
    return sbs.call_cells(_reads(spark, d).withColumn("q_min", F.col("peak")), lib, q_min=5, cell_keys=["cell"])


@query("""WITH u AS (SELECT c_custkey AS cell, o_orderpriority AS umi, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY n DESC, umi) AS k, sum(n) OVER (PARTITION BY cell) AS t FROM u)
SELECT cell, max(umi) FILTER (k = 1) AS umi_0, max(n) FILTER (k = 1) AS umi_count_0, max(umi) FILTER (k = 2) AS umi_1, max(n) FILTER (k = 2) AS umi_count_1, CAST(max(t) AS BIGINT) AS umi_total FROM k WHERE k <= 2 GROUP BY cell""")
def umi_top2(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("cell"))
    return sbs.add_umis(c, table(spark, d, "orders").select(F.col("o_custkey").alias("cell"), F.col("o_orderpriority").alias("umi")), ["cell"])


def _spots(spark, d):
    """Embeddings as spots: eight components are two cycles of four channels, the label is the tile."""
    v = table(spark, d, "embeddings")
    x = lambda c, k: F.abs(F.col("embedding")[4 * c + k].cast("double")) * 1000
    rows = [F.struct(F.lit(c + 1).alias("cycle"), F.lit(b).alias("channel"), x(c, k).alias("intensity")) for c in range(2) for k, b in enumerate("ACGT")]
    v = v.select(F.lit(1).alias("plate"), F.lit("A1").alias("well"), F.pmod("label", F.lit(3)).cast("int").alias("tile"), F.col("vec_id").alias("read"), F.pmod("vec_id", F.lit(9)).alias("cell"), F.col("vec_id").alias("i"), F.col("label").alias("j"), F.explode(F.array(*rows)).alias("r"))
    return v.select("plate", "well", "tile", "read", "cell", "i", "j", "r.*")


_SPOTS_SQL = """s AS (SELECT vec_id AS read, label % 3 AS tile, c AS cycle, [abs(CAST(embedding[4 * c - 3] AS DOUBLE)) * 1000, abs(CAST(embedding[4 * c - 2] AS DOUBLE)) * 1000,
abs(CAST(embedding[4 * c - 1] AS DOUBLE)) * 1000, abs(CAST(embedding[4 * c] AS DOUBLE)) * 1000] AS x FROM embeddings, range(1, 3) t(c))"""


@query(f"""WITH {_SPOTS_SQL}, o AS (SELECT read, cycle, ['A', 'C', 'G', 'T'][list_position(x, list_max(x))] AS base, list_reverse_sort(x) AS y FROM s),
q AS (SELECT *, greatest(0, least(1, 2 * (1 - ln(2 + y[2]) / ln(2 + y[1])))) AS q FROM o)
SELECT read, string_agg(base, '' ORDER BY cycle) AS barcode, round(min(q), 6) AS q_min FROM q GROUP BY read""")
def base_call_quality(spark, d):
    return rounded(sbs.call_reads(_spots(spark, d), list("ACGT"), method="none").select("read", "barcode", "q_min"), 6)


@query(f"""WITH {_SPOTS_SQL}, l AS (SELECT read, tile, cycle, unnest(['A', 'C', 'G', 'T']) AS channel, unnest(x) AS v FROM s), m AS (SELECT tile, channel, median(v) AS m FROM l GROUP BY tile, channel)
SELECT read, cycle, channel, round(v / m, 6) AS intensity FROM l JOIN m USING (tile, channel)""")
def normalized_bases(spark, d):
    return rounded(sbs.normalize_bases(_spots(spark, d)).select("read", "cycle", "channel", "intensity"), 6)


def _minor(m: list[list[str]]) -> str:
    """Determinant of a matrix of SQL expressions, by its first row."""
    if len(m) == 1:
        return m[0][0]
    return "(" + " + ".join(f"{'-' if k % 2 else ''}{m[0][k]} * {_minor([row[:k] + row[k + 1 :] for row in m[1:]])}" for k in range(len(m))) + ")"


def _corrected_sql(picked: str) -> str:
    """Reads after the correction by the inverse of the normalised median vectors. picked: tile, ch (from 1) and the x of the spots they're of."""
    n = range(4)
    m = [[f"m{r}{c}" for c in n] for r in n]
    median = ", ".join(f"median(x[{r + 1}]) FILTER (ch = {c + 1}) AS v{r}{c}" for r in n for c in n)
    normal = ", ".join(f"v{r}{c} / CASE WHEN {' + '.join(f'v{i}{c}' for i in n)} = 0 THEN 1 ELSE {' + '.join(f'v{i}{c}' for i in n)} END AS m{r}{c}" for r in n for c in n)
    cofactor = lambda r, c: f"{'-' if (r + c) % 2 else ''}{_minor([row[:c] + row[c + 1 :] for k, row in enumerate(m) if k != r])}"
    inverse = ", ".join(f"{cofactor(c, r)} / {_minor(m)} AS w{r}{c}" for r in n for c in n)
    dot = ", ".join(f"trunc({' + '.join(f'w{r}{c} * x[{c + 1}]' for c in n)})" for r in n)
    return f"""WITH {_SPOTS_SQL}, p AS ({picked}), med AS (SELECT tile, {median} FROM p GROUP BY tile), nor AS (SELECT tile, {normal} FROM med), w AS (SELECT tile, {inverse} FROM nor),
k AS (SELECT read, cycle, [{dot}] AS x FROM s JOIN w USING (tile)), o AS (SELECT read, cycle, ['A', 'C', 'G', 'T'][list_position(x, list_max(x))] AS base, list_reverse_sort(x) AS y FROM k),
q AS (SELECT *, greatest(0, least(1, 2 * (1 - ln(2 + least(abs(y[1]), abs(y[2]))) / ln(2 + greatest(abs(y[1]), abs(y[2])))))) AS q FROM o)
SELECT read, string_agg(base, '' ORDER BY cycle) AS barcode, round(min(q), 5) AS q_min FROM q GROUP BY read"""


@query(_corrected_sql("SELECT tile, x, list_position(x, list_max(x)) AS ch FROM s WHERE read % 9 > 0"))
def corrected_reads_median(spark, d):
    return rounded(sbs.call_reads(_spots(spark, d), list("ACGT"), "median").select("read", "barcode", "q_min"), 5)


@query(_corrected_sql("SELECT tile, x, ch FROM (SELECT *, quantile_cont(share, 0.95) OVER (PARTITION BY tile, ch) AS cut FROM (SELECT tile, x, unnest([1, 2, 3, 4]) AS ch, unnest(list_transform(x, lambda v: v / list_sum(x))) AS share FROM s)) WHERE share >= cut"))
def corrected_reads_percentile(spark, d):
    return rounded(sbs.call_reads(_spots(spark, d), list("ACGT"), "percentile", only_in_cells=False).select("read", "barcode", "q_min"), 5)


@query("""SELECT p_partkey, array_to_string(list_filter(string_split(p_name, ''), lambda x, i: i NOT IN (2, 5)), '')[1:6] AS prefix, p_name[1:p_size % 7 + 1] AS dynamic FROM part""")
def skip_cycle_prefix(spark, d):
    p = table(spark, d, "part").withColumn("n", F.col("p_size") % 7 + 1)
    return p.select("p_partkey", barcodes.skip_cycles("p_name", [2, 5], 6).alias("prefix"), barcodes.dynamic_prefix("p_name", "n").alias("dynamic"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '(?i)brand#1') THEN 'nontargeting_' || p_type ELSE p_brand END AS gene FROM part""")
def nontargeting_standardise(spark, d):
    return table(spark, d, "part").select("p_partkey", barcodes.control_name("p_brand", ["brand#1"], suffix=F.col("p_type")).alias("gene"))


@query("""WITH m AS (SELECT length(p_brand) AS n, count(*) AS c FROM part GROUP BY 1 ORDER BY c DESC, n LIMIT 1), d AS (SELECT p_brand[1:n] AS prefix, trim(split_part(p_type, '&', 1)) AS gene_symbol, p_partkey FROM part, m)
SELECT prefix, min((gene_symbol, p_partkey)) [1] AS gene_symbol, min((gene_symbol, p_partkey)) [2] AS p_partkey FROM d GROUP BY prefix""")
def barcode_design(spark, d):
    return sbs.barcode_design(table(spark, d, "part"), "p_type", "p_brand", keep=["p_partkey"])


@query("""WITH lib AS (SELECT DISTINCT substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS k FROM part WHERE p_size <= 25), r AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'z' || substr(md5(CAST(p_partkey AS VARCHAR)), 2, 7) ELSE substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) END AS b FROM part),
d AS (SELECT p_partkey, b, k, hamming(b, k) AS h, min(hamming(b, k)) OVER (PARTITION BY p_partkey) AS m FROM r, lib), n AS (SELECT p_partkey, b, max(m) AS m, count(*) AS c, max(k) AS k FROM d WHERE h = m GROUP BY p_partkey, b)
SELECT p_partkey, CASE WHEN m <= 1 AND c = 1 THEN k ELSE b END AS barcode FROM n""")
def barcode_error_correct(spark, d):
    p = table(spark, d, "part").withColumn("h", F.md5(F.col("p_partkey").cast("string").cast("binary")))
    lib = p.where("p_size <= 25").select(F.substring("h", 1, 8).alias("barcode"))
    reads = p.select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("z"), F.substring("h", 2, 7))).otherwise(F.substring("h", 1, 8)).alias("barcode"))
    return joins.error_correct(reads, lib)


@query("""WITH lib AS (SELECT DISTINCT substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS k FROM part WHERE p_size <= 25), r AS (SELECT p_partkey, substr(md5(CAST(p_partkey AS VARCHAR)), 1, 3) || substr(md5(CAST(p_partkey AS VARCHAR)), 5, 4) AS b FROM part),
d AS (SELECT p_partkey, b, k, levenshtein(b, k) AS h, min(levenshtein(b, k)) OVER (PARTITION BY p_partkey) AS m FROM r, lib), n AS (SELECT p_partkey, b, max(m) AS m, count(*) AS c, max(k) AS k FROM d WHERE h = m GROUP BY p_partkey, b)
SELECT p_partkey, CASE WHEN m <= 1 AND c = 1 THEN k ELSE b END AS barcode FROM n""")
def barcode_error_correct_edits(spark, d):
    p = table(spark, d, "part").withColumn("h", F.md5(F.col("p_partkey").cast("string").cast("binary")))
    lib = p.where("p_size <= 25").select(F.substring("h", 1, 8).alias("barcode"))
    reads = p.select("p_partkey", F.concat(F.substring("h", 1, 3), F.substring("h", 5, 4)).alias("barcode"))
    return joins.error_correct(reads, lib, metric="levenshtein")


@query("""SELECT tile, round(rate, 9) AS rate FROM (SELECT o_custkey % 50 AS tile, avg(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0.0 END) AS rate FROM orders GROUP BY 1) WHERE rate > 0""")
def read_mapping_rate(spark, d):
    o = table(spark, d, "orders").select(F.pmod("o_custkey", F.lit(50)).alias("tile"), F.col("o_orderpriority").alias("barcode"))
    lib = spark.createDataFrame([("1-URGENT",), ("2-HIGH",)], "barcode string")
    return rounded(qc.read_mapping_rate(o, lib, ["tile"]), 9)



@query("""WITH o AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1), r AS (SELECT c_nationkey AS tile, avg(CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END) AS rate FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY 1)
SELECT tile, round(rate, 9) AS rate FROM r WHERE rate > 0""")
def cell_mapping_rate(spark, d):
    info = table(spark, d, "customer").select(F.col("c_custkey").alias("cell"), F.col("c_nationkey").alias("tile"))
    called = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cell")).agg(F.count_distinct("o_orderpriority").alias("n"))
    cells_ = called.join(info, "cell").select("cell", "tile", "n")
    return rounded(qc.cell_mapping_rate(cells_, info, ["tile"], ["cell", "tile"], F.col("n") == 1), 9)


_GENES = """g AS (SELECT o_custkey AS cell, min(o_orderpriority) AS g0, CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN max(o_orderpriority) END AS g1 FROM orders GROUP BY 1)"""


@query(f"""WITH {_GENES}, i AS (SELECT c_nationkey AS well, count(*) AS cells FROM customer GROUP BY 1), c AS (SELECT c_nationkey AS well, count(g0) AS any_barcode, count(*) FILTER (g0 IS NOT NULL AND (g1 IS NULL OR g0 = g1)) AS one_gene FROM g JOIN customer ON cell = c_custkey GROUP BY 1)
SELECT well, cells, coalesce(any_barcode, 0) AS any_barcode, coalesce(one_gene, 0) AS one_gene, round(100.0 * coalesce(any_barcode, 0) / cells, 6) AS percent_any_barcode, round(100.0 * coalesce(one_gene, 0) / cells, 6) AS percent_one_gene FROM i LEFT JOIN c USING (well)""")
def mapping_overview(spark, d):
    info = table(spark, d, "customer").select(F.col("c_custkey").alias("cell"), F.col("c_nationkey").alias("well"))
    return rounded(qc.mapping_overview(info, _gene_calls(spark, d).join(info, "cell"), ["well"]), 6)


def _gene_calls(spark, d):
    p = F.col("o_orderpriority")
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("cell")).agg(F.min(p).alias("gene_symbol_0"), F.when(F.count_distinct(p) > 1, F.max(p)).alias("gene_symbol_1"))


@query(f"""WITH {_GENES} SELECT round(avg(CASE WHEN g0 IS NOT NULL AND g1 IS NULL THEN 1.0 ELSE 0.0 END), 9) AS one_barcode, round(avg(CASE WHEN g0 IS NOT NULL THEN 1.0 ELSE 0.0 END), 9) AS any_barcode,
round(count(*) FILTER (g0 IS NOT NULL AND g1 IS NULL) / count(g0), 9) AS specificity FROM g""")
def barcode_fractions(spark, d):
    return rounded(qc.barcode_fractions(_gene_calls(spark, d)), 9)


@query("""WITH t(threshold) AS (VALUES (0.0), (20.0), (50.0), (80.0)), e AS (SELECT *, event_type IN ('click', 'view', 'purchase') AS m FROM events)
SELECT CAST(threshold AS DOUBLE) AS threshold, count(*) AS reads, count(*) FILTER (m) AS mapped, count(DISTINCT user_id) FILTER (m) AS cells, round(count(*) FILTER (m) / count(*), 9) AS rate FROM t JOIN e ON value >= threshold GROUP BY threshold""")
def mapping_vs_threshold(spark, d):
    out = qc.mapping_vs_threshold(_reads(spark, d), _library(spark, d), "peak", [0.0, 20.0, 50.0, 80.0], ["cell"])
    return rounded(out.where("reads > 0"), 9)


@query("""WITH n AS (SELECT unnest(range(1, 7)) AS length), k AS (SELECT DISTINCT length, p_brand[1:length] AS p FROM part, n WHERE p_size <= 20), r AS (SELECT length, p_type[1:length] AS p FROM part, n UNION ALL SELECT length, p_brand[1:length] FROM part, n)
SELECT r.length, round(avg(CASE WHEN k.p IS NULL THEN 0.0 ELSE 1.0 END), 9) AS rate, max(c.c) AS prefixes, round(max(c.c) / pow(4, r.length), 9) AS expected FROM r LEFT JOIN k ON r.length = k.length AND r.p = k.p JOIN (SELECT length, count(*) AS c FROM k GROUP BY 1) c ON c.length = r.length GROUP BY r.length""")
def prefix_match_rate(spark, d):
    p = table(spark, d, "part")
    reads = p.select(F.explode(F.array("p_type", "p_brand")).alias("barcode"))
    out = qc.prefix_match_rate(reads, p.where("p_size <= 20").select(F.col("p_brand").alias("barcode")), 6)
    return rounded(out.withColumn("length", F.col("length").cast("long")), 9)


@query("""WITH c AS (SELECT s_nationkey AS well, s_suppkey % 30 AS tile, count(*) AS cells FROM supplier GROUP BY 1, 2), m AS (SELECT well, max(tile) AS m FROM c GROUP BY 1), g AS (SELECT well, unnest(range(0, m + 1)) AS tile FROM m)
SELECT well, tile, coalesce(cells, 0) AS cells FROM g LEFT JOIN c USING (well, tile)""")
def density_grid(spark, d):
    return qc.density_grid(table(spark, d, "supplier").select(F.col("s_nationkey").alias("well"), F.pmod("s_suppkey", F.lit(30)).alias("tile")), ["well"])


@query("""SELECT floor(least(value, 80) / 5) * 5 AS bin, count(*) AS count FROM events GROUP BY 1""")
def metric_histogram(spark, d):
    return qc.histogram(table(spark, d, "events"), "value", 5.0, 80.0).withColumn("bin", F.col("bin").cast("double"))


@query(f"""WITH {CELLS_SQL}, n AS (SELECT construct AS gene, count(*) AS cells FROM cells GROUP BY 1), q AS (SELECT quantile_cont(cells, 0.25) AS a, quantile_cont(cells, 0.75) AS b FROM n) SELECT gene, cells, cells > b + 1.5 * (b - a) AS outlier FROM n, q""")
def gene_histogram(spark, d):
    return qc.gene_histogram(cells(spark, d).select(F.col("construct").alias("gene")), "gene")


@query(f"""WITH {CELLS_SQL} SELECT plate, well, round(median(price), 4) AS price FROM cells GROUP BY plate, well""")
def tile_heatmap(spark, d):
    return rounded(qc.tile_heatmap(cells(spark, d), "price", ["plate", "well"]))


@query("""SELECT s_nationkey AS well, count(*) AS n, round(sum(s_acctbal), 2) AS s_acctbal, CAST(sum(s_suppkey) AS BIGINT) AS s_suppkey FROM supplier GROUP BY 1""")
def segmentation_overview(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("well"), "s_acctbal", "s_suppkey", F.lit(1).cast("long").alias("n"))
    return rounded(qc.segmentation_overview(s, ["well"]), 2)


@query(f"""WITH {CELLS_SQL}, a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY price DESC, construct, l_suppkey, l_linenumber) AS k FROM cells), b AS (SELECT *, row_number() OVER (PARTITION BY construct ORDER BY q, l_orderkey, l_suppkey, l_linenumber) AS k2 FROM a WHERE k = 1)
SELECT {", ".join(KEYS)} FROM b WHERE k2 = 1""")
def dedup_two_step(spark, d):
    return merge.deduplicate(cells(spark, d), *_priors()).select(*KEYS)


def _priors():
    return ["l_orderkey"], [F.desc("price"), "construct", "l_suppkey", "l_linenumber"], ["construct"], ["q", "l_orderkey", "l_suppkey", "l_linenumber"]


@query(f"""WITH {CELLS_SQL}, a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY price DESC, construct, l_suppkey, l_linenumber) AS k FROM cells), b AS (SELECT *, row_number() OVER (PARTITION BY construct ORDER BY q, l_orderkey, l_suppkey, l_linenumber) AS k2 FROM a WHERE k = 1)
SELECT 'initial' AS stage, count(*) AS n FROM cells UNION ALL SELECT 'first', count(*) FROM b UNION ALL SELECT 'second', count(*) FROM b WHERE k2 = 1""")
def dedup_stats(spark, d):
    return merge.deduplicate_stats(cells(spark, d), *_priors())


@query("""WITH f AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45) SELECT o_orderstatus AS well, count(*) AS total, count(l_orderkey) AS matched, round(100.0 * count(l_orderkey) / count(*), 6) AS rate FROM orders LEFT JOIN f ON o_orderkey = l_orderkey GROUP BY 1""")
def match_rates(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell"), F.col("o_orderstatus").alias("well"))
    m = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("cell"))
    return rounded(merge.matching_rates(o, m, ["cell"], ["well"]), 6)


@query("""SELECT count(*) AS n, round(avg(l_quantity), 6) AS mean, median(l_quantity) AS median, round(stddev_samp(l_quantity), 6) AS std, min(l_quantity) AS min, max(l_quantity) AS max, quantile_cont(l_quantity, 0.95) AS p95,
count(*) FILTER (l_quantity < 5) AS under_5, count(*) FILTER (l_quantity < 10) AS under_10 FROM lineitem""")
def distance_distribution(spark, d):
    return rounded(merge.distance_distribution(table(spark, d, "lineitem"), "l_quantity", (5, 10)), 6)


@query("""SELECT count(*) AS n, count(DISTINCT l_orderkey) AS cells_0, count(DISTINCT (l_partkey, l_suppkey)) AS cells_1, round(avg(l_quantity), 6) AS mean_distance, max(l_quantity) AS max_distance,
count(*) - count(DISTINCT l_orderkey) AS repeats_0, count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS repeats_1 FROM lineitem""")
def validate_matches(spark, d):
    return rounded(merge.validate_matches(table(spark, d, "lineitem"), ["l_orderkey"], ["l_partkey", "l_suppkey"], "l_quantity"), 6)


#: Points from keys and balances, the same in both engines.
_POINTS = """a AS (SELECT c_custkey AS id, c_nationkey % 5 AS well, c_custkey * 37 % 997 + 0.0 AS i, (c_acctbal * 7) % 883 AS j FROM customer), b AS (SELECT s_suppkey AS id, s_nationkey % 5 AS well, s_suppkey * 53 % 991 + 0.25 AS i, (s_acctbal * 3) % 877 AS j FROM supplier),
d AS (SELECT well, a.id AS id_0, b.id AS id_1, sqrt(pow(a.i - b.i, 2) + pow(a.j - b.j, 2)) AS distance FROM a JOIN b USING (well))"""


def _points(spark, d):
    a = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_nationkey % 5 AS well", "c_custkey * 37 % 997 + 0.0D AS i", "(c_acctbal * 7) % 883 AS j")
    b = table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_nationkey % 5 AS well", "s_suppkey * 53 % 991 + 0.25D AS i", "(s_acctbal * 3) % 877 AS j")
    return a, b


@query(f"""WITH {_POINTS}, k AS (SELECT *, row_number() OVER (PARTITION BY well, id_0 ORDER BY distance, id_1) AS k FROM d WHERE distance <= 40) SELECT well, id_0, id_1, round(distance, 6) AS distance FROM k WHERE k = 1""")
def nn_one_way(spark, d):
    return rounded(joins.nearest_one_way(*_points(spark, d), 40, ["well"]).select("well", "id_0", "id_1", "distance"), 6)


@query(f"""WITH {_POINTS}, k AS (SELECT *, row_number() OVER (PARTITION BY well, id_0 ORDER BY distance, id_1) AS k0, row_number() OVER (PARTITION BY well, id_1 ORDER BY distance, id_0) AS k1 FROM d WHERE distance < 40) SELECT well, id_0, id_1, round(distance, 6) AS distance FROM k WHERE k0 = 1 AND k1 = 1""")
def nn_mutual(spark, d):
    return rounded(joins.nearest_mutual(*_points(spark, d), 40, ["well"]).select("well", "id_0", "id_1", "distance"), 6)


@query("SELECT s_suppkey AS cell_0, s_suppkey AS cell_1, 0e0 AS distance FROM supplier")
def triangle_alignment(spark, d):
    """The second table is the first one turned and moved: every cell meets itself."""
    import math

    a = table(spark, d, "supplier").selectExpr("'P1' AS plate", "'A1' AS well", "1 AS tile", "s_suppkey AS cell", "s_suppkey * 53 % 991 + 0.25D AS i", "(s_acctbal * 3) % 877 AS j")
    c, s = math.cos(0.02), math.sin(0.02)
    b = joins.affine(a, [[c, -s], [s, c]], [30.0, -12.0])
    keys = ["plate", "well"]
    pairs = spark.createDataFrame([("P1", "A1", 1, 1)], "plate string, well string, tile int, site int")
    h0, h1 = registration.hash_cells(a, [*keys, "tile"], packed=True), registration.hash_cells(b, [*keys, "tile"], packed=True)
    al = registration.align_pairs(h0, h1, pairs, keys)
    m = joins.merge_by_alignment(a, b.withColumnRenamed("tile", "site"), al, 2.0, coincident=True)
    return m.select("cell_0", "cell_1", F.round("distance", 3).alias("distance"))


@query("""WITH c AS (SELECT c_custkey AS gene, c_mktsegment AS cluster FROM customer), g AS (SELECT c_custkey AS gene, c_nationkey AS grp FROM customer), n AS (SELECT count(DISTINCT gene) AS n FROM c),
sc AS (SELECT cluster, count(*) AS nc FROM c GROUP BY 1), sg AS (SELECT grp, count(*) AS ng FROM g GROUP BY 1), b AS (SELECT cluster, grp, count(*) AS a FROM c JOIN g USING (gene) GROUP BY 1, 2)
SELECT cluster, grp AS "group", coalesce(a, 0) AS a, nc - coalesce(a, 0) AS b, ng - coalesce(a, 0) AS c, greatest(n - nc - ng + coalesce(a, 0), 0) AS d FROM sc CROSS JOIN sg CROSS JOIN n LEFT JOIN b USING (cluster, grp)""")
def group_counts(spark, d):
    return _enrichment(spark, d).select("cluster", "group", "a", "b", "c", "d")


def _enrichment(spark, d):
    c = table(spark, d, "customer")
    return cluster.group_enrichment(c.select(F.col("c_custkey").alias("gene"), F.col("c_mktsegment").alias("cluster")), c.select(F.col("c_custkey").alias("gene"), F.col("c_nationkey").alias("group")))


@query("""WITH c AS (SELECT c_custkey AS gene, c_mktsegment AS cluster FROM customer), g AS (SELECT c_custkey AS gene, c_nationkey AS grp FROM customer), n AS (SELECT count(DISTINCT gene) AS n FROM c), sc AS (SELECT cluster, count(*) AS nc FROM c GROUP BY 1), sg AS (SELECT grp, count(*) AS ng FROM g GROUP BY 1),
b AS (SELECT cluster, grp, count(*) AS a FROM c JOIN g USING (gene) GROUP BY 1, 2), t AS (SELECT cluster, grp, coalesce(a, 0) AS a, nc, ng, n FROM sc CROSS JOIN sg CROSS JOIN n LEFT JOIN b USING (cluster, grp)),
k AS (SELECT *, unnest(range(greatest(0, nc + ng - n), least(nc, ng) + 1)) AS k FROM t), l AS (SELECT *, lgamma(nc + 1) - lgamma(k + 1) - lgamma(nc - k + 1) + lgamma(n - nc + 1) - lgamma(ng - k + 1) - lgamma(n - nc - ng + k + 1) - lgamma(n + 1) + lgamma(ng + 1) + lgamma(n - ng + 1) AS lp FROM k),
o AS (SELECT *, max(lp) FILTER (k = a) OVER (PARTITION BY cluster, grp) AS here FROM l), p AS (SELECT cluster, grp, least(1.0, sum(exp(lp)) FILTER (lp <= here + 1e-7)) AS p FROM o GROUP BY 1, 2), r AS (SELECT *, p * count(*) OVER (PARTITION BY cluster) / row_number() OVER (PARTITION BY cluster ORDER BY p, grp) AS v FROM p),
f AS (SELECT *, least(1.0, min(v) OVER (PARTITION BY cluster ORDER BY p DESC, grp DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS fdr FROM r) SELECT cluster, grp AS "group", round(p, 6) AS p, round(fdr, 6) AS fdr, fdr < 0.05 AS enriched FROM f""")
def group_fisher(spark, d):
    return rounded(_enrichment(spark, d).select("cluster", "group", "p", "fdr", "enriched"), 6)


_KNOWN = "SELECT o_custkey AS a, (o_custkey * 7 + o_orderkey) % 1000 + 1 AS b FROM orders"


@query(f"""WITH c AS (SELECT c_custkey AS gene, c_mktsegment AS cluster FROM customer), k AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ({_KNOWN}) WHERE a <> b),
j AS (SELECT x.cluster = y.cluster AS same FROM k JOIN c x ON x.gene = k.a JOIN c y ON y.gene = k.b), s AS (SELECT CAST(sum(n * (n - 1) // 2) AS BIGINT) AS pairs FROM (SELECT count(*) AS n FROM c GROUP BY cluster)),
t AS (SELECT count(*) FILTER (same) AS tp, count(*) FILTER (NOT same) AS fn, max(pairs) AS pairs FROM j, s), r AS (SELECT tp, fn, pairs - tp AS fp, tp / pairs AS p, tp / (tp + fn) AS r FROM t)
SELECT tp, fn, fp, round(p, 9) AS precision, round(r, 9) AS recall, round(2 * p * r / (p + r), 9) AS f1 FROM r""")
def pair_precision_recall(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("gene"), F.col("c_mktsegment").alias("cluster"))
    o = table(spark, d, "orders").selectExpr("o_custkey AS a", "(o_custkey * 7 + o_orderkey) % 1000 + 1 AS b")
    return rounded(cluster.pair_enrichment(c, o), 9)


@query(f"""WITH c AS (SELECT c_custkey AS gene, c_mktsegment AS cluster FROM customer), k AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM ({_KNOWN}) WHERE a <> b),
j AS (SELECT x.cluster AS ca, y.cluster AS cb FROM k JOIN c x ON x.gene = k.a JOIN c y ON y.gene = k.b), s AS (SELECT cluster, count(*) * (count(*) - 1) // 2 AS pairs FROM c GROUP BY 1),
h AS (SELECT ca AS cluster, count(*) AS tp FROM j WHERE ca = cb GROUP BY 1), m AS (SELECT cluster, count(*) AS fn FROM (SELECT ca AS cluster FROM j WHERE ca <> cb UNION ALL SELECT cb FROM j WHERE ca <> cb) GROUP BY 1)
SELECT cluster, coalesce(tp, 0) AS tp, coalesce(fn, 0) AS fn, pairs - coalesce(tp, 0) AS fp FROM s LEFT JOIN h USING (cluster) LEFT JOIN m USING (cluster)""")
def pair_counts_by_cluster(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("gene"), F.col("c_mktsegment").alias("cluster"))
    o = table(spark, d, "orders").selectExpr("o_custkey AS a", "(o_custkey * 7 + o_orderkey) % 1000 + 1 AS b")
    return cluster.pair_enrichment(c, o, by_cluster=True).select("cluster", "tp", "fn", "fp")


@query("""WITH g AS (SELECT DISTINCT l_partkey AS gene, l_suppkey AS grp FROM lineitem), l AS (SELECT p_partkey AS gene FROM part WHERE p_size > 5), s AS (SELECT grp, count(*) AS n, count(l.gene) AS k FROM g LEFT JOIN l USING (gene) GROUP BY 1),
ok AS (SELECT grp, k FROM s WHERE k >= 3 AND k >= n * 2 / 3), h AS (SELECT gene, grp, k FROM g JOIN l USING (gene) JOIN ok USING (grp)),
x AS (SELECT a.grp AS big, a.k AS ka, b.grp AS small, b.k AS kb, count(*) AS s FROM h a JOIN h b ON a.gene = b.gene AND (a.k > b.k OR (a.k = b.k AND a.grp > b.grp)) GROUP BY 1, 2, 3, 4)
SELECT gene, grp AS "group" FROM h WHERE grp NOT IN (SELECT big FROM x WHERE s * (s - 1) / 2 > 0.1 * kb * (kb - 1) / 2)""")
def complex_filter(spark, d):
    g = table(spark, d, "lineitem").select(F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("group"))
    return cluster.filter_complexes(g, table(spark, d, "part").where("p_size > 5").select(F.col("p_partkey").alias("gene")))


def _metrics(spark, d):
    c = table(spark, d, "customer")
    return c.groupBy((F.col("c_nationkey") + 1).alias("resolution")).agg(F.avg("c_acctbal").alias("f1"), F.count("*").cast("double").alias("enriched"), (F.count("*") / 4).alias("size"))


@query("""WITH m AS (SELECT c_nationkey + 1 AS resolution, avg(c_acctbal) AS f1, CAST(count(*) AS DOUBLE) AS enriched, count(*) / 4 AS size FROM customer GROUP BY 1), s AS (SELECT *, (f1 / max(f1) OVER () + enriched / max(enriched) OVER ()) / 2 AS combined,
CASE WHEN size < 10 THEN size / 10 WHEN size <= 14 THEN 1.0 ELSE greatest(0.0, 1 - (size - 14) / 14) END AS u FROM m) SELECT resolution, round(combined, 6) AS combined, round((combined + u) / 2, 6) AS balanced FROM s""")
def resolution_scores(spark, d):
    return rounded(cluster.score_resolutions(_metrics(spark, d), ["f1", "enriched"], "size", (10, 14)).select("resolution", "combined", "balanced"), 6)


@query("""WITH m AS (SELECT c_nationkey + 1 AS resolution, avg(c_acctbal) AS f1, CAST(count(*) AS DOUBLE) AS enriched, count(*) / 4 AS size FROM customer GROUP BY 1), s AS (SELECT *, (f1 / max(f1) OVER () + enriched / max(enriched) OVER ()) / 2 AS combined,
CASE WHEN size < 10 THEN size / 10 WHEN size <= 14 THEN 1.0 ELSE greatest(0.0, 1 - (size - 14) / 14) END AS u FROM m) SELECT resolution FROM s ORDER BY combined + u DESC, resolution LIMIT 1""")
def resolution_choice(spark, d):
    return cluster.best_resolution(cluster.score_resolutions(_metrics(spark, d), ["f1", "enriched"], "size", (10, 14))).select("resolution")


_TWO_SETS = f"""{CELLS_SQL}, s AS (SELECT gene = 'Brand#25' AS t, q, tax FROM cells WHERE gene LIKE 'Brand#1%' OR gene = 'Brand#25'), l AS (SELECT t, 'q' AS feature, q AS v FROM s UNION ALL SELECT t, 'tax', tax FROM s)"""


@query(f"""WITH {_TWO_SETS}, m AS (SELECT feature, count(*) FILTER (t) AS n_test, count(*) FILTER (NOT t) AS n_control, median(v) FILTER (t) AS a, median(v) FILTER (NOT t) AS b, quantile_cont(v, 0.75) FILTER (t) - quantile_cont(v, 0.25) FILTER (t) AS ia, quantile_cont(v, 0.75) FILTER (NOT t) - quantile_cont(v, 0.25) FILTER (NOT t) AS ib FROM l GROUP BY 1)
SELECT feature, n_test, n_control, round(a, 6) AS test_median, round(b, 6) AS control_median, round(ia, 6) AS test_iqr, round(ib, 6) AS control_iqr, round(a - b, 6) AS diff, round(a / b, 6) AS ratio, abs(a - b) >= 0.5 AND (abs(a / b) >= 1.5 OR abs(a / b) <= 1 / 1.5) AS significant FROM m""")
def median_analysis(spark, d):
    return rounded(cluster.median_analysis(cells(spark, d), ["q", "tax"], F.col("gene") == "Brand#25", F.col("gene").startswith("Brand#1")), 6)


@query(f"""WITH {_TWO_SETS}, m AS (SELECT *, median(v) OVER (PARTITION BY feature, t) AS md FROM l), r AS (SELECT feature, max(md) FILTER (t) AS a, max(md) FILTER (NOT t) AS b, median(abs(v - md)) AS mad FROM m GROUP BY 1)
SELECT feature, round(a, 6) AS test_center, round(b, 6) AS control_center, round(CASE WHEN mad = 0 THEN 0 ELSE 0.6745 * (a - b) / mad END, 6) AS effect FROM r""")
def diff_robust_z(spark, d):
    out = cluster.differential_analysis(cells(spark, d), ["q", "tax"], F.col("gene") == "Brand#25", F.col("gene").startswith("Brand#1"))
    return rounded(out.select("feature", "test_center", "control_center", "effect"), 6)


@query(f"""WITH {CELLS_SQL}, s AS (SELECT gene = 'Brand#25' AS t, q, price, tax FROM cells WHERE gene LIKE 'Brand#1%' OR gene = 'Brand#25'), l AS (SELECT t, 'q' AS feature, q AS v FROM s UNION ALL SELECT t, 'price', price FROM s UNION ALL SELECT t, 'tax', tax FROM s),
g AS (SELECT feature, count(*) FILTER (t) AS n1, avg(v) FILTER (t) AS m1, var_samp(v) FILTER (t) AS v1, count(*) FILTER (NOT t) AS n2, avg(v) FILTER (NOT t) AS m2, var_samp(v) FILTER (NOT t) AS v2 FROM l GROUP BY 1),
w AS (SELECT *, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS effect, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS statistic, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS df FROM g),
i AS (SELECT *, unnest(range(0, 4001)) AS k FROM w), e AS (SELECT feature, sum(CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END * exp(-(df + 1) / 2 * ln(1 + pow(abs(statistic) * k / 4000, 2) / df))) * max(abs(statistic)) / 12000 * exp(max(lgamma((df + 1) / 2) - lgamma(df / 2))) / sqrt(max(df) * pi()) AS half FROM i GROUP BY 1),
p AS (SELECT *, greatest(0.0, 1 - 2 * half) AS p FROM w JOIN e USING (feature)), r AS (SELECT *, p * 3 / row_number() OVER (ORDER BY p, feature) AS x FROM p), f AS (SELECT *, least(1.0, min(x) OVER (ORDER BY p DESC, feature DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS fdr FROM r)
SELECT feature, round(m1, 6) AS test_center, round(m2, 6) AS control_center, round(effect, 6) AS effect, round(statistic, 6) AS statistic, round(p, 6) AS p, round(fdr, 6) AS fdr, fdr < 0.05 AND abs(effect) >= 1 AS significant FROM f""")
def diff_tests(spark, d):
    """The t distribution's tail is integrated by Simpson's rule on the SQL side."""
    return rounded(cluster.differential_analysis(cells(spark, d), ["q", "price", "tax"], F.col("gene") == "Brand#25", F.col("gene").startswith("Brand#1"), nonparametric=False), 6)


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e, label FROM embeddings), d AS (SELECT a.vec_id, avg(list_distance(a.e, b.e)) AS m FROM v a, v b WHERE b.label = 0 GROUP BY 1)
SELECT vec_id, round(m, 6) AS mean_distance, round((m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ()), 6) AS normalized_distance FROM d""")
def cluster_control_distance(spark, d):
    return rounded(cluster.control_distance(table(spark, d, "embeddings"), "vec_id", "embedding", F.col("label") == 0).withColumnRenamed("gene", "vec_id"), 6)


@query("""WITH x AS (SELECT p_partkey AS entry, unnest(string_split(p_name, ' ')) AS gene_name, generate_subscripts(string_split(p_name, ' '), 1) - 1 AS position FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY gene_name ORDER BY position, entry) AS k FROM x WHERE gene_name <> '')
SELECT entry, CAST(position AS INTEGER) AS position, gene_name FROM k WHERE k = 1""")
def explode_synonyms(spark, d):
    return sbs.synonyms(table(spark, d, "part").select(F.col("p_partkey").alias("entry"), F.col("p_name").alias("gene_names")))


@query(f"""WITH {CELLS_SQL}, g AS (SELECT gene, avg(q) AS q, avg(price) AS price FROM cells GROUP BY 1), s AS (SELECT avg(q) AS mq, stddev_samp(q) AS sq, avg(price) AS mp, stddev_samp(price) AS sp FROM g)
SELECT gene, round((q - mq) / sq, 4) AS q, round((price - mp) / sp, 4) AS price FROM g, s WHERE gene LIKE 'Brand#2%'""")
def heatmap_zscores(spark, d):
    g = cells(spark, d).groupBy("gene").agg(F.avg("q").alias("q"), F.avg("price").alias("price"))
    return rounded(cluster.heatmap_values(g, ["q", "price"], F.col("gene").startswith("Brand#2"), "gene"))


@query("""WITH p AS (SELECT DISTINCT l_orderkey AS nucleus, l_partkey * 100000 + l_suppkey AS cell FROM lineitem)
SELECT nucleus, cell FROM p WHERE nucleus IN (SELECT nucleus FROM p GROUP BY 1 HAVING count(*) = 1) AND cell IN (SELECT cell FROM p GROUP BY 1 HAVING count(*) = 1)""")
def reconcile_labels(spark, d):
    return images.reconcile(table(spark, d, "lineitem").selectExpr("l_orderkey AS nucleus", "l_partkey * 100000 + l_suppkey AS cell"), [])


@query()
def phate_leiden(spark, d):
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("gene"), *[F.col("embedding")[i].alias(f"PC_{i}") for i in range(16)])
    return graph.phate_leiden(v, "gene", [f"PC_{i}" for i in range(16)]).select("gene", "cluster")


@query("""SELECT 'screens/P-' || p_partkey || '_W-A' || p_size || '_T-5__reads.tsv' AS path, CAST(p_partkey AS VARCHAR) AS plate, 'A' || p_size AS well, '5' AS tile, 'reads' AS info FROM part""")
def parse_file_names(spark, d):
    p = table(spark, d, "part").select(F.format_string("screens/P-%s_W-A%s_T-5__reads.tsv", F.col("p_partkey"), F.col("p_size")).alias("path"))
    n = sources.parse_names(F.col("path"))
    return p.select("path", *[n[k].alias(k) for k in ("plate", "well", "tile", "info")])


@query("""SELECT 'orders' AS module, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders UNION ALL SELECT 'orders', 'o_orderkey', CAST(sum(o_orderkey) AS DOUBLE) FROM orders UNION ALL SELECT 'nation', 'rows', CAST(count(*) AS DOUBLE) FROM nation UNION ALL SELECT 'nation', 'n_nationkey', CAST(sum(n_nationkey) AS DOUBLE) FROM nation""")
def pipeline_stats(spark, d):
    return qc.pipeline_stats({"orders": table(spark, d, "orders").select("o_orderkey"), "nation": table(spark, d, "nation").select("n_nationkey")})


@query("""WITH p AS (SELECT p_brand AS brand, round(avg(p_size), 2) AS size, round(avg(p_retailprice), 2) AS price FROM part GROUP BY 1) SELECT brand, size, price, round(size * price, 4) AS score FROM p""")
def parameter_search(spark, d):
    return rounded(qc.parameter_search(table(spark, d, "part").selectExpr("p_brand AS brand", "p_size AS size", "p_retailprice AS price"), ["brand"], ["size", "price"]))


@query("""SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def streamed_counts(spark, d):
    """The same counts from a stream over the file, read to its end."""
    import uuid

    from wellspring.session import shared_dir
    from wellspring.streaming import ingest

    schema = table(spark, d, "events").schema
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = ingest.new_rows(spark, f"{d}/events.parquet*", schema, ["event_id"])
    ingest.run_available(stream, ingest.append_batches(f"{root}/rows"), f"{root}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{root}/rows")
    return rows.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n"))


@query("""SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def streamed_cells(spark, d):
    """The last event of each user, upserted from a stream whose state is bounded by a watermark."""
    import uuid

    from wellspring.session import shared_dir
    from wellspring.streaming import ingest

    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = ingest.new_rows(spark, f"{d}/events.parquet*", table(spark, d, "events").schema, ["event_id"], time="ts", late="30 days")
    ingest.run_available(stream, ingest.upsert_batches(f"{root}/cells", ["user_id"], ["ts", "event_id"]), f"{root}/checkpoint").awaitTermination()
    last = max(ingest.versions(spark, f"{root}/cells"))
    return spark.read.parquet(f"{root}/cells/version={last}").select("event_id", "user_id", "event_type", "value")
