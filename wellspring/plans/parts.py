"""Queries of sources, keys, projections, joins and summaries, one or two operators each."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wellspring.functions import barcodes
from wellspring.operators import bootstrap, classify, cluster, filters, joins, merge, normalise, objects, qc, registration, sbs
from wellspring.plans.roles import CELLS_SQL, KEYS, cells, control, rounded, table
from wellspring.session import shared_dir
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


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Sources and sinks.

_TABLES = "(VALUES ('benchmark'), ('conversations'), ('customer'), ('documents'), ('embeddings'), ('events'), ('labels'), ('lineitem'), ('nation'), ('orders'), ('pages'), ('part'), ('region'), ('supplier')) t(name)"


def _manifest(spark, d):
    """The folder's tables; where one is a folder of parts, those have the table's name too."""
    return sources.manifest(spark, d, r"/([a-z]+)\.parquet", ["name"], integers=(), recursive=True)


@query(f"SELECT name FROM {_TABLES}")
def sample_combos(spark, d):
    return sources.partition_combos(_manifest(spark, d))


@query("SELECT 'orders' AS name, 'orders.parquet' AS file")
def selected_samples(spark, d):
    found = sources.select_samples(_manifest(spark, d), order={"name": ["orders", "part"]}, name="orders")
    return found.select("name", F.regexp_extract("sample_fp", r"([a-z]+\.parquet)", 1).alias("file")).distinct()


@query("SELECT p_partkey, p_size * 1000.0::DOUBLE AS x_pos, p_retailprice AS y_pos, CAST(NULL AS DOUBLE) AS z_pos FROM part")
def stage_metadata(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", "p_size AS X_mm", "p_retailprice AS pos_y")
    return sources.stage_metadata(p).select("p_partkey", "x_pos", "y_pos", "z_pos")


@query("SELECT least(count(*), 300) AS n, least(count(*), 300) AS different, 1.0::DOUBLE AS known FROM part")
def sampled_rows(spark, d):
    part = table(spark, d, "part")
    some = sources.sample_rows(part.select("p_partkey"), 300, ["p_partkey"])
    known = some.join(part.select("p_partkey", F.lit(1.0).alias("k")), "p_partkey", "left")
    return known.agg(F.count("*").alias("n"), F.count_distinct("p_partkey").alias("different"), F.avg(F.coalesce("k", F.lit(0.0))).alias("known"))


@query("SELECT l_returnflag, TRUE AS about_a_quarter FROM lineitem GROUP BY 1")
def sampled_share(spark, d):
    line = table(spark, d, "lineitem")
    some = sources.sample_each(line, 0.25, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    n = line.groupBy("l_returnflag").agg(F.count("*").alias("n")).join(some.groupBy("l_returnflag").agg(F.count("*").alias("k")), "l_returnflag", "left")
    return n.select("l_returnflag", (F.abs(F.coalesce("k", F.lit(0)) / F.col("n") - 0.25) < 0.04).alias("about_a_quarter"))


@query("SELECT n_nationkey, 'P-' || n_nationkey || '_W-A1_T-' || (n_nationkey % 5) || '__cells.tsv' AS name, n_nationkey % 5 AS tile FROM nation")
def file_names(spark, d):
    keys = [r.n_nationkey for r in table(spark, d, "nation").select("n_nationkey").collect()]  # a dimension of 25 rows
    names = spark.createDataFrame([(k, sources.file_name({"plate": k, "well": "A1", "tile": k % 5}, "cells", "tsv")) for k in keys], "n_nationkey int, name string")
    return names.withColumn("tile", sources.parse_names(F.col("name"))["tile"].cast("int"))


@query("SELECT CAST(p_partkey AS INTEGER) AS tile, 'x/P-1_W-A1_T-' || p_partkey || '__i.tiff' AS path FROM part")
def tile_files(spark, d):
    files = table(spark, d, "part").select(F.format_string("x/P-1_W-A1_T-%s__i.tiff", F.col("p_partkey")).alias("path"))
    return sources.tile_files(files).select(F.explode("files").alias("tile", "path"))


@query("SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS name FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier")
def combined_rows(spark, d):
    a = table(spark, d, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance", "c_mktsegment AS segment")
    b = table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_acctbal AS balance", "s_name AS name")
    return sources.combine([a, b])


@query("SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_retailprice END AS price FROM part")
def read_written_tables(spark, d):
    """NaN is written, null is read."""
    path = f"{_folder(spark, 'read')}/a.parquet"
    table(spark, d, "part").select("p_partkey", "p_name", F.expr("CASE WHEN p_size > 10 THEN p_retailprice ELSE double('NaN') END").alias("price")).write.parquet(path)
    return sources.read_tables(spark, [path])


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def partitioned_text(spark, d):
    path = _folder(spark, "text")
    sources.write_partitioned(table(spark, d, "nation"), f"{path}/n.tsv", ["n_regionkey"], "tsv")
    return sources.read_tables(spark, f"{path}/n.tsv", "n_nationkey int, n_name string, n_regionkey int")


@query("SELECT p_partkey, p_brand, p_size FROM part")
def appended_json(spark, d):
    path = _folder(spark, "json")
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    sources.write_json(part.where("p_partkey % 2 = 0"), path)
    sources.write_json(part.where("p_partkey % 2 = 1"), path, "append")
    return spark.read.schema("p_partkey bigint, p_brand string, p_size int").json(path)


@query("SELECT 'P' || p_partkey AS entry, p_name AS gene_names_primary, CAST(p_size AS VARCHAR) AS length FROM part")
def uniprot_columns(spark, d):
    path = _folder(spark, "uniprot")
    p = table(spark, d, "part").select(F.concat(F.lit("P"), "p_partkey").alias("Entry"), F.col("p_name").alias("Gene Names (primary)"), F.col("p_size").alias("Length"))
    p.write.option("header", True).option("sep", "\t").csv(path)
    return sources.uniprot_table(spark, path)


@query("""SELECT DISTINCT trim(unnest(string_split(replace(p_name, ' ', ';'), ';'))) AS gene_name, p_brand AS "group" FROM part""")
def complex_members(spark, d):
    p = table(spark, d, "part").select("p_brand", F.translate("p_name", " ", ";").alias("genes"))
    return sources.complex_groups(p, "p_brand", "genes")


@query("""WITH ids AS (SELECT 'S' || p_partkey AS p, p_brand || '_' || p_size AS g FROM part), l AS (SELECT 'S' || l_partkey AS p1, 'S' || l_suppkey AS p2 FROM lineitem WHERE l_quantity * 20 >= 950),
k AS (SELECT DISTINCT least(a.g, b.g) AS a, greatest(a.g, b.g) AS b FROM l JOIN ids a ON a.p = p1 JOIN ids b ON b.p = p2 WHERE a.g <> b.g)
SELECT gene_name, count(*) AS pairs FROM (SELECT a AS gene_name FROM k UNION ALL SELECT b FROM k) GROUP BY 1""")
def protein_pairs(spark, d):
    up = table(spark, d, "part").selectExpr("concat('S', p_partkey, ';x') AS string", "concat(p_brand, '_', p_size, ' other') AS gene_names")
    links = table(spark, d, "lineitem").selectExpr("concat('S', l_partkey) AS protein1", "concat('S', l_suppkey) AS protein2", "l_quantity * 20 AS combined_score")
    return sources.string_pairs(links, up).groupBy("gene_name").agg(F.count_distinct("pair").alias("pairs"))


@query("""SELECT n_name AS gene_name, r_name AS "group" FROM nation JOIN region ON n_regionkey = r_regionkey""")
def gene_sets(spark, d):
    path = _folder(spark, "sets")
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sets = both.groupBy("r_name").agg(F.struct(F.collect_list("n_name").alias("geneSymbols")).alias("v"))  # five regions, one file
    sets.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("r_name", "v")))).alias("value")).coalesce(1).write.text(path)
    return sources.json_gene_sets(spark, path)


_FEATURES = ["label", "plate", "well", "nucleus_DAPI_mean", "nucleus_GFP_mean", "cell_DAPI_area", "cell_GFP_std", "cell_DAPI_GFP_correlation", "cytoplasm_DAPI_mean", "cell_extra_x", "other"]


def _features(spark):
    """An empty table: only its columns are looked at."""
    return spark.createDataFrame([], ", ".join(f"`{c}` {'string' if c in ('plate', 'well') else 'double'}" for c in _FEATURES))


def _listed(spark, lists: dict[str, list[str]]):
    return spark.createDataFrame([(name, k, c) for name, found in lists.items() for k, c in enumerate(found)], "list string, position int, name string")


@query("""SELECT * FROM (VALUES ('metadata', 0, 'label'), ('metadata', 1, 'plate'), ('metadata', 2, 'well'), ('one_channel', 0, 'nucleus_DAPI_mean'), ('one_channel', 1, 'cell_DAPI_area'), ('one_channel', 2, 'cytoplasm_DAPI_mean'), ('one_channel', 3, 'cell_extra_x'), ('one_channel', 4, 'other'),
('gene_table', 0, 'nucleus_DAPI_mean'), ('gene_table', 1, 'nucleus_GFP_mean'), ('gene_table', 2, 'cell_GFP_std'), ('gene_table', 3, 'cell_DAPI_area'), ('gene_table', 4, 'cell_DAPI_GFP_correlation'), ('gene_table', 5, 'cell_extra_x'),
('ordered', 0, 'label'), ('ordered', 1, 'plate'), ('ordered', 2, 'well'), ('ordered', 3, 'other'), ('ordered', 4, 'nucleus_DAPI_mean'), ('ordered', 5, 'nucleus_GFP_mean'), ('ordered', 6, 'cell_DAPI_area'), ('ordered', 7, 'cell_GFP_std'), ('ordered', 8, 'cell_DAPI_GFP_correlation'), ('ordered', 9, 'cell_extra_x'), ('ordered', 10, 'cytoplasm_DAPI_mean')) t(list, position, name)""")
def feature_lists(spark, d):
    metadata, features = sources.split_columns(_features(spark), ["label", "plate", "well"])
    return _listed(spark, {"metadata": metadata, "one_channel": sources.channel_subset(features, ["DAPI"], ["DAPI", "GFP"]), "gene_table": sources.table_features(features, ["extra"]), "ordered": sources.ordered_columns(_FEATURES[3:] + _FEATURES[:3], metadata)})


# Filters and keys.


@query(f"WITH {CELLS_SQL} SELECT {', '.join(KEYS)} FROM cells WHERE nullif(gene, 'Brand#11') IS NOT NULL")
def perturbed_cells(spark, d):
    return filters.perturbation_filter(cells(spark, d).withColumn("gene", F.expr("nullif(gene, 'Brand#11')")), "gene").select(*KEYS)


@query("SELECT o_orderkey, CAST(o_custkey % 9 AS VARCHAR) AS plate, upper(trim(' ' || lower(o_orderstatus) || '1 ')) AS well, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS cell FROM orders WHERE o_custkey % 9 IN (1, 4)")
def canonical_keys(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "concat(o_custkey % 9, '.0') AS plate", "concat(' ', lower(o_orderstatus), '1 ') AS well", "CASE WHEN o_custkey % 3 <> 0 THEN concat(o_custkey, '.0') ELSE 'none' END AS cell")
    return classify.normalize_keys(o, ids=["cell"]).where(F.col("plate").isin("1", "4"))


@query("""WITH seen AS (SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 40) SELECT 'odd' AS pool, count(*) AS n FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey NOT IN (SELECT k FROM seen)
UNION ALL SELECT 'even', count(*) FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey NOT IN (SELECT k FROM seen)""")
def unseen_pools(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    pools = filters.without_seen([o.where("k % 2 = 1"), o.where("k % 2 = 0")], table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("k")), ["k"])
    return pools[0].agg(F.lit("odd").alias("pool"), F.count("*").alias("n")).unionByName(pools[1].agg(F.lit("even").alias("pool"), F.count("*").alias("n")))


@query("SELECT p_partkey FROM part WHERE regexp_matches(p_brand, '^Brand#1') OR (abs(p_size - 25) >= 15 AND p_retailprice / 10000 < 0.1) OR (abs(p_size % 7 - 3) >= 15 AND p_size / 50.0 < 0.1)")
def genes_by_bootstrap(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", "p_brand", "p_size - 25.0D AS a", "p_retailprice / 10000 AS a_fdr", "p_size % 7 - 3.0D AS b", "p_size / 50.0D AS b_fdr")
    return filters.genes_by_bootstrap(p, "p_brand", ["a", "b"], ["Brand#1"], z=15, fdr=0.1).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_brand LIKE 'Brand#1%' OR p_size / 50.0 > 0.6")
def auc_gate(spark, d):
    return filters.auc_gate(table(spark, d, "part").withColumn("auc", F.expr("p_size / 50.0D")), "p_brand", "Brand#1", "auc", 0.6).select("p_partkey")


@query("""WITH a AS (SELECT 'in' AS pool, count(*) AS n FROM part WHERE p_size > 40), b AS (SELECT count(*) AS n FROM part WHERE p_size <= 40) SELECT pool, CAST(least(a.n, greatest(150, 300 - b.n)) AS BIGINT) AS n, 20 AS prioritized FROM a, b
UNION ALL SELECT 'out', CAST(least(b.n, 300 - least(a.n, greatest(150, 300 - b.n))) AS BIGINT), 0 FROM a, b""")
def next_batch(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size")
    first = p.where("p_size > 40").orderBy("p_partkey").limit(20).select("p_partkey")
    out = filters.next_batch(p.where("p_size > 40"), p.where("p_size <= 40"), ["p_partkey"], 300, first)
    return out.join(first.withColumn("f", F.lit(1)), "p_partkey", "left").groupBy("pool").agg(F.count("*").alias("n"), F.count("f").cast("int").alias("prioritized"))


@query(f"WITH {CELLS_SQL}, k AS (SELECT plate, count(*) FILTER (q > 25 AND disc < 0.05) AS inside, count(*) FILTER (NOT (q > 25 AND disc < 0.05)) AS outside FROM cells GROUP BY plate) SELECT plate, inside, outside FROM k")
def unseen_counts(spark, d):
    c = cells(spark, d)
    return qc.unseen_counts(c.where("q > 25 AND disc < 0.05"), c.where("NOT (q > 25 AND disc < 0.05)"), ["plate"])


@query("""WITH b AS (SELECT o_orderstatus AS class, count(*) AS before, count(*) FILTER (o_totalprice > 200000) AS after FROM orders GROUP BY 1), t AS (SELECT * FROM b UNION ALL SELECT 'TOTAL', sum(before), sum(after) FROM b)
SELECT class, CAST(before AS BIGINT) AS before, CAST(after AS BIGINT) AS after, round(after / before, 9) AS kept FROM t""")
def threshold_summary(spark, d):
    o = table(spark, d, "orders")
    return rounded(filters.threshold_summary(o, o.where("o_totalprice > 200000"), "o_orderstatus"), 9)


# Projections and expressions.


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'large' ELSE 'rest' END AS category, p_size % 4 + 1 AS label, CASE p_size % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'c' WHEN 2 THEN 'd' END AS class FROM part")
def class_names(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", "p_size % 3 AS k", "p_size % 4 + 1 AS label")
    named = classify.map_categories(p, "k", {0: "small", 1: "large"}, default="rest")
    return classify.map_categories(named, "label", classify.class_mapping(["a", "b", "c", "d"], ["b"]), "class").drop("k")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END IS NOT NULL OR p_type IS NOT NULL AS any_gene, (CASE WHEN p_size % 4 = 0 THEN 1 WHEN p_brand = 'Brand#' || (p_size % 5) THEN 1 ELSE 2 END) = 1 AS single,
CASE WHEN list_contains(['ring', 'widget'], string_split(p_name, ' ')[1]) THEN string_split(p_name, ' ')[1] WHEN list_contains(['ring', 'widget'], string_split(p_name, ' ')[2]) THEN string_split(p_name, ' ')[2] ELSE string_split(p_name, ' ')[1] END AS gene FROM part""")
def gene_choices(spark, d):
    p = table(spark, d, "part").withColumns({"a": F.expr("CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END"), "b": F.expr("concat('Brand#', p_size % 5)")})
    return p.select("p_partkey", (F.col("a").isNotNull() | F.col("p_type").isNotNull()).alias("any_gene"), barcodes.single_gene([F.col("a"), F.col("b")]).alias("single"), barcodes.first_known(F.col("p_name"), F.array(F.lit("ring"), F.lit("widget"))).alias("gene"))


@query("""SELECT * FROM (VALUES ('map_recomb', 1, 13, 14, 22), ('recomb_map', 10, 22, 1, 9)) t("order", map_start, map_end, recomb_start, recomb_end)""")
def cycle_positions(spark, d):
    found = [(o, barcodes.cycle_positions(15, 10, o, [2, 5], [3])) for o in ("map_recomb", "recomb_map")]
    return spark.createDataFrame([(o, *[f[k] for k in ("map_start", "map_end", "recomb_start", "recomb_end")]) for o, f in found], "`order` string, map_start int, map_end int, recomb_start int, recomb_end int")


@query("""SELECT p_partkey, md5(CAST(p_partkey AS VARCHAR))[1:6] AS prefix_map, md5(CAST(p_partkey AS VARCHAR))[7:10] AS prefix_recomb, least(p_size / 50.0, p_retailprice / 3000.0) AS q_recomb FROM part""")
def multi_reads(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.md5(F.col("p_partkey").cast("string").cast("binary")).alias("barcode"), F.expr("concat(array_repeat(0.0D, 6), array(p_size / 50.0D, 1.0D, p_retailprice / 3000.0D, 1.0D), array(0.0D))").alias("q"))
    return sbs.prep_multi(p, 1, 6, 7, 10).select("p_partkey", "prefix_map", "prefix_recomb", F.least("q_recomb", F.lit(1.0)).alias("q_recomb"))


@query("""WITH l AS (SELECT md5(CAST(p_partkey AS VARCHAR))[1:1] AS m, max(md5(CAST(p_partkey AS VARCHAR))[2:2]) AS e FROM part WHERE p_size < 5 GROUP BY 1), r AS (SELECT p_partkey, md5(CAST(p_partkey AS VARCHAR))[1:1] AS m, md5(CAST(p_partkey AS VARCHAR))[2:2] AS x, p_size / 50.0 AS q FROM part)
SELECT p_partkey, CASE WHEN q >= 0.3 THEN coalesce(x = e, FALSE) END AS no_recomb FROM r LEFT JOIN l USING (m)""")
def recombination_flags(spark, d):
    p = table(spark, d, "part").withColumn("h", F.md5(F.col("p_partkey").cast("string").cast("binary"))).select("p_partkey", "p_size", F.substring("h", 1, 1).alias("prefix_map"), F.substring("h", 2, 1).alias("prefix_recomb"), F.expr("p_size / 50.0D").alias("q_recomb"))
    return sbs.no_recombination(p, p.where("p_size < 5").select("prefix_map", "prefix_recomb"), min_quality=0.3).select("p_partkey", "no_recomb")


@query("""WITH u AS (SELECT p_partkey AS vec_id, unnest(['a', 'c']) AS channel, unnest([p_size + 0.0, p_retailprice]) AS intensity FROM part) SELECT vec_id, channel, intensity FROM u""")
def long_bases(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey AS vec_id", "double(p_size) AS a", "p_retailprice AS c")
    return sbs.format_bases(p, ["vec_id"], ["a", "c"])


# Matching and merging.

_PLACES = """a AS (SELECT c_custkey AS cell, 'p' AS plate, 'w' || (c_nationkey % 2) AS well, c_nationkey % 4 AS tile, CAST(c_custkey * 37 % 997 AS DOUBLE) AS i, (c_acctbal * 7) % 883 AS j FROM customer),
b AS (SELECT c_custkey + 7 AS cell, 'p' AS plate, 'w' || (c_nationkey % 2) AS well, c_nationkey % 4 AS site, CAST((c_custkey * 37 % 997) * 2.0 + 11 + (c_custkey % 3) * 0.25 AS DOUBLE) AS i, ((c_acctbal * 7) % 883) * 2.0 - 5 AS j FROM customer WHERE c_custkey % 10 <> 0)"""


def _places(spark, d):
    c = table(spark, d, "customer")
    a = c.selectExpr("c_custkey AS cell", "'p' AS plate", "concat('w', c_nationkey % 2) AS well", "c_nationkey % 4 AS tile", "c_custkey * 37 % 997 + 0.0D AS i", "(c_acctbal * 7) % 883 AS j")
    b = c.where("c_custkey % 10 <> 0").selectExpr("c_custkey + 7 AS cell", "'p' AS plate", "concat('w', c_nationkey % 2) AS well", "c_nationkey % 4 AS site", "(c_custkey * 37 % 997) * 2.0D + 11 + (c_custkey % 3) * 0.25D AS i", "((c_acctbal * 7) % 883) * 2.0D - 5 AS j")
    return a, b


@query(f"""WITH {_PLACES}, m AS (SELECT *, i * 2 + 11 AS x, j * 2 - 5 AS y FROM a), d AS (SELECT a.well, a.tile, a.cell AS cell_0, a.i AS i_0, a.j AS j_0, b.site, b.cell AS cell_1, b.i AS i_1, b.j AS j_1, sqrt(pow(x - b.i, 2) + pow(y - b.j, 2)) AS distance FROM m a JOIN b ON a.well = b.well AND a.tile = b.site),
k AS (SELECT *, row_number() OVER (PARTITION BY well, tile, cell_0 ORDER BY distance, cell_1) AS k0, row_number() OVER (PARTITION BY well, tile, cell_1 ORDER BY distance, cell_0) AS k1 FROM d WHERE distance < 2)
SELECT 'p' AS plate, well, tile, cell_0, i_0, round(j_0, 6) AS j_0, site, cell_1, i_1, round(j_1, 6) AS j_1, round(distance, 6) AS distance FROM k WHERE k0 = 1 AND k1 = 1""")
def merged_by_alignment(spark, d):
    a, b = _places(spark, d)
    rows = [("p", f"w{t % 2}", t, t, [[2.0, 0.0], [0.0, 2.0]], [11.0, -5.0]) for t in range(4)]
    alignment = spark.createDataFrame(rows, "plate string, well string, tile int, site int, rotation array<array<double>>, translation array<double>")
    return rounded(joins.merge_by_alignment(a, b, alignment, 2.0), 6)


@query(f"""WITH {_PLACES} SELECT cell, round(0.6 * i - 0.8 * j + 3, 6) AS i, round(0.8 * i + 0.6 * j - 4, 6) AS j, round(i * 1.5, 6) AS scaled_i FROM a WHERE i BETWEEN 100 AND 700 AND j BETWEEN 50 AND 600""")
def moved_points(spark, d):
    a = merge.in_region(_places(spark, d)[0], (100, 700), (50, 600))
    scaled = merge.scale_coordinates(a, 1.5).select("cell", F.col("i").alias("scaled_i"))
    return rounded(joins.affine(a, [[0.6, -0.8], [0.8, 0.6]], [3.0, -4.0]).select("cell", "i", "j").join(scaled, "cell"), 6)


@query(f"""WITH {_PLACES}, x AS (SELECT min(i) AS i0, max(i) AS i1, min(j) AS j0, max(j) AS j1 FROM a), y AS (SELECT min(i) AS i0, max(i) AS i1, min(j) AS j0, max(j) AS j1 FROM b)
SELECT round(((y.i1 - y.i0) / (x.i1 - x.i0) + (y.j1 - y.j0) / (x.j1 - x.j0)) / 2, 6) AS scale, round(greatest(least(x.i1, y.i1) - greatest(x.i0, y.i0), 0) * greatest(least(x.j1, y.j1) - greatest(x.j0, y.j0), 0) / ((y.i1 - y.i0) * (y.j1 - y.j0)), 6) AS overlap FROM x, y""")
def scale_and_overlap(spark, d):
    a, b = _places(spark, d)
    return spark.createDataFrame([(round(merge.scale_factor(a, b), 6), round(merge.bounding_overlap(a, b), 6))], "scale double, overlap double")


@query("""WITH s AS (SELECT s_suppkey AS tile, s_suppkey * 53 % 991 + 0.0 AS x_pos, (s_acctbal * 3) % 877 AS y_pos FROM supplier), c AS (SELECT avg(x_pos) AS cx, avg(y_pos) AS cy FROM s), r AS (SELECT avg(c_custkey * 37 % 997) AS rx, avg((c_acctbal * 7) % 883) AS ry FROM customer)
SELECT tile, round(-(y_pos - cy) + rx, 4) AS x_pos, round(-(x_pos - cx) + ry, 4) AS y_pos FROM s, c, r""")
def aligned_metadata(spark, d):
    s = table(spark, d, "supplier").selectExpr("s_suppkey AS tile", "s_suppkey * 53 % 991 + 0.0D AS x_pos", "(s_acctbal * 3) % 877 AS y_pos")
    r = table(spark, d, "customer").selectExpr("c_custkey * 37 % 997 + 0.0D AS x_pos", "(c_acctbal * 7) % 883 AS y_pos")
    return rounded(merge.align_metadata(s, r, flip_x=True, rotate_90=True, align_centers=True), 4)


@query("""WITH s AS (SELECT s_suppkey AS tile, s_suppkey * 53 % 991 + 0.0 AS x_pos, (s_acctbal * 3) % 877 AS y_pos FROM supplier), o AS (SELECT x_pos AS ox, y_pos AS oy FROM s WHERE tile = 3), p AS (SELECT c_custkey AS tile, c_custkey * 37 % 997 + 0.0 AS x_pos, (c_acctbal * 7) % 883 AS y_pos FROM customer)
SELECT tile, round(sqrt(pow(x_pos - ox, 2) + pow(y_pos - oy, 2)), 6) AS distance FROM p, o ORDER BY sqrt(pow(x_pos - ox, 2) + pow(y_pos - oy, 2)), tile LIMIT 12""")
def closest_tiles(spark, d):
    s = table(spark, d, "supplier").selectExpr("s_suppkey AS tile", "s_suppkey * 53 % 991 + 0.0D AS x_pos", "(s_acctbal * 3) % 877 AS y_pos")
    p = table(spark, d, "customer").selectExpr("c_custkey AS tile", "c_custkey * 37 % 997 + 0.0D AS x_pos", "(c_acctbal * 7) % 883 AS y_pos")
    return rounded(merge.closest_tiles(s, p, 3, 12).select("tile", "distance"), 6)


_STITCHED = """p AS (SELECT 'w' || (c_nationkey % 3) AS well, c_custkey AS stitched_cell_id, c_nationkey AS tile, c_custkey % 100 AS original_cell_id, c_acctbal AS area FROM customer), s AS (SELECT 'w' || (s_nationkey % 3) AS well, s_suppkey AS stitched_cell_id, s_nationkey AS tile, s_suppkey % 10 AS original_cell_id, s_acctbal AS area FROM supplier),
m AS (SELECT 'w' || (o_orderkey % 3) AS well, o_custkey AS stitched_cell_id_0, o_orderkey % 50 AS stitched_cell_id_1, o_totalprice / 100000 AS distance FROM orders)"""


def _stitched(spark, d):
    p = table(spark, d, "customer").selectExpr("concat('w', c_nationkey % 3) AS well", "c_custkey AS stitched_cell_id", "c_nationkey AS tile", "c_custkey % 100 AS original_cell_id", "c_acctbal AS area")
    s = table(spark, d, "supplier").selectExpr("concat('w', s_nationkey % 3) AS well", "s_suppkey AS stitched_cell_id", "s_nationkey AS tile", "s_suppkey % 10 AS original_cell_id", "s_acctbal AS area")
    m = table(spark, d, "orders").selectExpr("concat('w', o_orderkey % 3) AS well", "o_custkey AS stitched_cell_id_0", "o_orderkey % 50 AS stitched_cell_id_1", "o_totalprice / 100000 AS distance")
    return m, p, s


@query(f"""WITH {_STITCHED} SELECT m.well, m.stitched_cell_id_0, m.stitched_cell_id_1, m.distance, p.tile, p.original_cell_id AS cell_0, p.area AS area_0, s.tile AS site, s.original_cell_id AS cell_1, s.area AS area_1
FROM m JOIN p ON p.well = m.well AND p.stitched_cell_id = m.stitched_cell_id_0 JOIN s ON s.well = m.well AND s.stitched_cell_id = m.stitched_cell_id_1""")
def stitched_matches(spark, d):
    return merge.stitched_ids(*_stitched(spark, d), ["well"])


@query(f"""WITH {_STITCHED}, a AS (SELECT well, count(*) AS cells_0 FROM p GROUP BY 1), b AS (SELECT well, count(*) AS cells_1 FROM s GROUP BY 1), c AS (SELECT well, count(*) AS matches, avg(distance) AS mean_distance, median(distance) AS median_distance FROM m GROUP BY 1)
SELECT well, cells_0, cells_1, matches, round(mean_distance, 6) AS mean_distance, round(median_distance, 6) AS median_distance, round(100.0 * matches / cells_0, 6) AS rate_0, round(100.0 * matches / cells_1, 6) AS rate_1 FROM a JOIN b USING (well) JOIN c USING (well)""")
def merge_summary(spark, d):
    return rounded(merge.merge_summary(*_stitched(spark, d), ["well"]), 6)


@query("""WITH m AS (SELECT c_custkey AS cell FROM customer WHERE c_acctbal > 5000) SELECT c_nationkey AS tile, round(avg(CASE WHEN m.cell IS NULL THEN 0.0 ELSE 1.0 END), 9) AS rate FROM customer LEFT JOIN m ON c_custkey = m.cell GROUP BY 1 HAVING count(m.cell) > 0""")
def match_heatmap(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey AS cell", "c_nationkey AS tile", "c_acctbal")
    return rounded(qc.match_heatmap(c.select("cell", "tile"), c.where("c_acctbal > 5000"), ["cell"], ["tile"]), 9)


_SITE = """ph AS (SELECT c_nationkey AS tile, c_custkey AS cell, c_custkey * 37 % 997 + 0.0 AS i, (c_acctbal * 7) % 883 AS j FROM customer), sb AS (SELECT s_nationkey % 5 AS site, s_suppkey AS cell, s_suppkey * 53 % 991 + 0.0 AS i, (s_acctbal * 3) % 877 AS j FROM supplier),
mt AS (SELECT c_nationkey AS tile, c_custkey AS cell_0, c_custkey % 5 AS site, c_custkey % 90 AS cell_1, c_acctbal / 1000 AS distance FROM customer), here AS (SELECT * FROM mt WHERE site = 2 AND distance <= 4), box AS (SELECT min(i) AS a, max(i) AS b, min(j) AS c, max(j) AS d FROM sb WHERE site = 2)"""


@query(f"""WITH {_SITE} SELECT 'matched' AS part, count(*) AS n, round(avg(distance), 6) AS mean_distance, round(median(distance), 6) AS median_distance FROM here
UNION ALL SELECT 'unmatched_0', count(*), NULL, NULL FROM ph, box WHERE i BETWEEN a AND b AND j BETWEEN c AND d AND (tile, cell) NOT IN (SELECT (tile, cell_0) FROM here) UNION ALL SELECT 'unmatched_1', count(*), NULL, NULL FROM sb WHERE site = 2 AND cell NOT IN (SELECT cell_1 FROM here)""")
def site_report(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    ph = c.selectExpr("c_nationkey AS tile", "c_custkey AS cell", "c_custkey * 37 % 997 + 0.0D AS i", "(c_acctbal * 7) % 883 AS j")
    sb = s.selectExpr("s_nationkey % 5 AS site", "s_suppkey AS cell", "s_suppkey * 53 % 991 + 0.0D AS i", "(s_acctbal * 3) % 877 AS j")
    r = merge.site_report(c.selectExpr("c_nationkey AS tile", "c_custkey AS cell_0", "c_custkey % 5 AS site", "c_custkey % 90 AS cell_1", "c_acctbal / 1000 AS distance"), ph, sb, 2, 4.0)
    n = lambda k: r[k].agg(F.lit(k).alias("part"), F.count("*").alias("n"), F.lit(None).cast("double").alias("mean_distance"), F.lit(None).cast("double").alias("median_distance"))
    return rounded(r["summary"].select(F.lit("matched").alias("part"), F.col("matches").alias("n"), "mean_distance", "median_distance").unionByName(n("unmatched_0")).unionByName(n("unmatched_1")), 6)


@query("""SELECT o_orderkey AS cell_0, round(sqrt(pow(o_orderkey % 1000 - 500, 2) + pow(o_custkey % 800 - 400, 2)), 6) AS fov_distance_0, round(sqrt(pow(o_custkey % 1000 - 500, 2) + pow(o_orderkey % 800 - 400, 2)), 6) AS fov_distance_1,
CASE WHEN o_custkey % 3 = 0 THEN c_mktsegment END AS gene_symbol_0, c_mktsegment AS gene_symbol_1, coalesce(c_custkey IS NOT NULL, FALSE) AS mapped_single_gene, least(o_totalprice, nullif(o_custkey, 5) * 100.0) AS channel_min FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def formatted_merge(spark, d):
    o = table(spark, d, "orders")
    matches = o.selectExpr("'p' AS plate", "'w' AS well", "1 AS tile", "o_orderkey AS cell_0", "double(o_orderkey % 1000) AS i_0", "double(o_custkey % 800) AS j_0", "2 AS site", "o_custkey AS cell_1", "double(o_custkey % 1000) AS i_1", "double(o_orderkey % 800) AS j_1")
    called = table(spark, d, "customer").selectExpr("'p' AS plate", "'w' AS well", "2 AS tile", "c_custkey AS cell", "CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS gene_symbol_0", "c_mktsegment AS gene_symbol_1")
    ph = o.selectExpr("'p' AS plate", "'w' AS well", "1 AS tile", "o_orderkey AS label", "o_totalprice AS cell_a_min", "nullif(o_custkey, 5) * 100.0D AS cell_b_min")
    return rounded(merge.format_merge(matches, called, ph, (1000, 800)).select("cell_0", "fov_distance_0", "fov_distance_1", "gene_symbol_0", "gene_symbol_1", "mapped_single_gene", "channel_min"), 6)


@query("SELECT c_custkey, c_mktsegment, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def checked_join(spark, d):
    c = table(spark, d, "customer").selectExpr("c_custkey", "c_mktsegment", "c_nationkey AS k")
    return joins.checked_join(c, table(spark, d, "nation").selectExpr("n_nationkey AS k", "n_name"), ["k"]).drop("k")


@query("""SELECT coalesce(c_custkey, s_suppkey) AS label, c_acctbal AS cell_acctbal, s_acctbal AS nucleus_acctbal FROM customer FULL JOIN (SELECT s_suppkey * 20 AS s_suppkey, s_acctbal FROM supplier) ON c_custkey = s_suppkey""")
def full_on_label(spark, d):
    return joins.full_on_label({"cell": table(spark, d, "customer").selectExpr("c_custkey AS label", "c_acctbal AS acctbal"), "nucleus": table(spark, d, "supplier").selectExpr("s_suppkey * 20 AS label", "s_acctbal AS acctbal")})


_SYNONYMS = """x AS (SELECT 'E' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS entry, unnest(string_split(p_name, ' ')) AS g, generate_subscripts(string_split(p_name, ' '), 1) AS pos, string_split(p_name, ' ')[1] AS main FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY pos, entry) AS k FROM x WHERE g <> ''),
n AS (SELECT g, entry, main FROM k WHERE k = 1), q AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'ring' WHEN 1 THEN 'small' WHEN 2 THEN 'unheard' ELSE 'widget' END AS gene_symbol FROM customer)"""


def _symbols(spark, d):
    up = table(spark, d, "part").selectExpr("concat('E', lpad(p_partkey, 9, '0')) AS entry", "p_name AS gene_names")
    return up, table(spark, d, "customer").selectExpr("c_custkey", "CASE c_custkey % 4 WHEN 0 THEN 'ring' WHEN 1 THEN 'small' WHEN 2 THEN 'unheard' ELSE 'widget' END AS gene_symbol")


@query(f"WITH {_SYNONYMS} SELECT c_custkey, gene_symbol, CASE WHEN gene_symbol = 'widget' THEN 'control' ELSE entry END AS uniprot_entry FROM q LEFT JOIN n ON gene_symbol = g")
def annotated_genes(spark, d):
    up, q = _symbols(spark, d)
    return sbs.annotate(q, up, control=F.col("gene_symbol") == "widget")


@query(f"WITH {_SYNONYMS} SELECT DISTINCT gene_symbol, CASE WHEN main IS NULL THEN 'unknown' WHEN main = gene_symbol THEN 'ok' ELSE 'use ' || main END AS recommendation FROM q LEFT JOIN n ON gene_symbol = g")
def symbol_check(spark, d):
    up, q = _symbols(spark, d)
    return sbs.check_symbols(q, up)


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def latest_labels(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return classify.latest_labels(o, ["o_custkey"], "o_orderkey", o.select("o_custkey").distinct())


# Aggregates, tests and choices.


@query("""WITH e AS (SELECT c_mktsegment AS cluster, count(*) AS n_enriched, min(c_name) AS groups FROM customer GROUP BY 1), f AS (SELECT o_orderpriority AS cluster, count(*) AS n_enriched, min(o_orderstatus) AS groups FROM orders GROUP BY 1)
SELECT coalesce(e.cluster, f.cluster) AS cluster, e.n_enriched AS x_n_enriched, e.groups AS x_groups, f.n_enriched AS y_n_enriched, f.groups AS y_groups FROM e FULL JOIN f ON e.cluster = f.cluster""")
def combined_benchmarks(spark, d):
    e = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("cluster")).agg(F.count("*").alias("n_enriched"), F.min("c_name").alias("groups"))
    f = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("cluster")).agg(F.count("*").alias("n_enriched"), F.min("o_orderstatus").alias("groups"))
    return cluster.combined_table({"x": e, "y": f})


@query("""WITH c AS (SELECT c_nationkey AS cluster, count(*) FILTER (c_acctbal > 9500) AS a, count(*) FILTER (c_acctbal < -800) AS b FROM customer GROUP BY 1), s AS (SELECT cluster, concat_ws('; ', CASE WHEN a > 0 THEN 'high' END, CASE WHEN b > 0 THEN 'low' END) AS enriched_in FROM c WHERE a > 0 OR b > 0)
SELECT enriched_in, count(*) AS clusters FROM s GROUP BY 1""")
def enriched_in(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("cluster"))
    return cluster.enriched_in({"high": c.agg(F.count_if(F.col("c_acctbal") > 9500).alias("n_enriched")), "low": c.agg(F.count_if(F.col("c_acctbal") < -800).alias("n_enriched"))})


@query("SELECT p_partkey, p_size FROM part WHERE p_size = (SELECT max(p_size) FROM part WHERE p_retailprice < 1500) AND p_retailprice < 1500")
def best_parameters(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size", (F.col("p_retailprice") < 1500).alias("ok"))
    return qc.best_parameters(p, "p_size", success="ok").select("p_partkey", "p_size")


@query("""WITH m AS (SELECT c_nationkey AS resolution, avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END) AS rate, sum(c_acctbal) AS balanced FROM customer GROUP BY 1) SELECT resolution, round(100 * rate, 1) AS rate FROM m ORDER BY balanced DESC, resolution LIMIT 10""")
def resolution_report(spark, d):
    m = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("resolution")).agg(F.avg(F.when(F.col("c_acctbal") > 0, 1.0).otherwise(0.0)).alias("rate"), F.sum("c_acctbal").alias("balanced"))
    return cluster.resolution_table(m, ["rate"]).select("resolution", "rate")


@query("""WITH a AS (SELECT p_brand AS feature, count(*) - 40 AS diff FROM part GROUP BY 1), u AS (SELECT feature, diff, 'up' AS direction FROM a WHERE diff > 0 ORDER BY diff DESC, feature LIMIT 5), w AS (SELECT feature, diff, 'down' AS direction FROM a WHERE diff < 0 ORDER BY diff, feature LIMIT 5) SELECT * FROM u UNION ALL SELECT * FROM w""")
def top_features(spark, d):
    return cluster.top_features(table(spark, d, "part").groupBy(F.col("p_brand").alias("feature")).agg((F.count("*") - 40).alias("diff")), 5)


@query(f"""WITH {CELLS_SQL}, g AS (SELECT plate || well AS b, count(*) AS n, sum(price) AS s, sum(price * price) AS q FROM cells WHERE gene LIKE 'Brand#1%' GROUP BY 1), a AS (SELECT count(*) AS k, sum(n) AS n, sum(s) AS s, sum(q) AS q, sum(s * s / n) AS b FROM g)
SELECT CAST(k - 1 AS DOUBLE) AS d1, CAST(n - k AS DOUBLE) AS d2, round((b - s * s / n) / (k - 1) / ((q - b) / (n - k)), 4) AS f, 1 AS features, TRUE AS is_share FROM a""")
def batch_effects(spark, d):
    """The statistic has its SQL; the p-value, a continued fraction, its test."""
    from wellspring.functions.stats import anova_f

    c = cells(spark, d).withColumn("b", F.concat("plate", "well"))
    p = qc.batch_effects(c, ["price"], "b", control())
    f = anova_f(c.where(control()).select("b", F.lit("price").alias("feature"), F.col("price").alias("v")), "v", "b", ["feature"])
    return rounded(f.crossJoin(p).select("d1", "d2", "f", F.col("features").cast("int").alias("features"), F.col("median_p").between(0, 1).alias("is_share")))


@query(f"""WITH {CELLS_SQL} SELECT construct, count(*) AS cell_count, {', '.join(f'round(median({f}), 4) AS {f}' for f in ('q', 'price'))}, gene FROM cells GROUP BY construct, gene""")
def construct_features(spark, d):
    return rounded(normalise.construct_table(cells(spark, d), ["q", "price"], "construct", "gene"))


@query("""WITH c AS (SELECT p_partkey AS construct FROM part WHERE p_brand LIKE 'Brand#1%'), n AS (SELECT count(*) AS n FROM c) SELECT 'pseudo_Brand#1_' || (k + 1) AS pseudogene, CAST(least(4, n - 4 * k) AS BIGINT) AS constructs FROM n, range(0, 100000) r(k) WHERE 4 * k < n""")
def pseudogene_sizes(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("construct"), F.col("p_brand").alias("gene"))
    return bootstrap.pseudogenes(p, {"Brand#1": 4}, "gene", "construct").groupBy("pseudogene").agg(F.count("*").alias("constructs"))


@query(f"""WITH {CELLS_SQL}, n AS (SELECT construct, gene, l_linenumber AS sim, avg(q) AS a, avg(price) AS b FROM cells GROUP BY 1, 2, 3) SELECT gene, sim, round(median(a), 6) AS a, round(median(b), 6) AS b FROM n GROUP BY gene, sim""")
def gene_nulls(spark, d):
    c = cells(spark, d)
    nulls = c.groupBy("construct", F.col("l_linenumber").alias("sim")).agg(F.array(F.avg("q"), F.avg("price")).alias("x"))
    out = bootstrap.gene_null(nulls, c.select("construct", "gene"), "construct", "gene")
    return out.select("gene", "sim", F.round(F.col("x")[0], 6).alias("a"), F.round(F.col("x")[1], 6).alias("b"))


@query("""SELECT feature FROM (VALUES ('p_size'), ('p_retailprice')) t(feature)""")
def enhanced_features(spark, d):
    """A constant, a copy and two of their own: the first two go."""
    p = table(spark, d, "part").withColumns({"constant": F.lit(1.0), "copy": F.col("p_size") * 2.0})
    return spark.createDataFrame([(f,) for f in classify.enhance_features(p, ["p_size", "constant", "copy", "p_retailprice"])], "feature string")


# Tiles.

#: 35 x 20 tiles a well, as many wells as there are parts for.
_TILES = """t AS (SELECT 'w' || (p_partkey // 700) AS well, p_partkey AS tile, CAST((p_partkey % 35) * 250 AS DOUBLE) AS x_pos, CAST(((p_partkey % 700) // 35) * 125 AS DOUBLE) AS y_pos, 0.5 AS px FROM part)"""


def _tiles(spark, d):
    return table(spark, d, "part").selectExpr("concat('w', p_partkey div 700) AS well", "p_partkey AS tile", "(p_partkey % 35) * 250.0D AS x_pos", "((p_partkey % 700) div 35) * 125.0D AS y_pos", "0.5D AS pixel_size_x")


@query(f"""WITH {_TILES} SELECT well, tile, CAST(round((x_pos - min(x_pos) OVER (PARTITION BY well)) / 250) AS INTEGER) AS grid_x_pos, CAST(round((y_pos - min(y_pos) OVER (PARTITION BY well)) / 125) AS INTEGER) AS grid_y_pos FROM t""")
def grid_positions(spark, d):
    return merge.grid_positions(_tiles(spark, d), ["well"]).select("well", "tile", "grid_x_pos", "grid_y_pos")


@query(f"""WITH {_TILES} SELECT well, tile, CAST((y_pos - min(y_pos) OVER (PARTITION BY well)) / px AS INTEGER) AS shift_i, CAST((x_pos - min(x_pos) OVER (PARTITION BY well)) / px AS INTEGER) AS shift_j FROM t""")
def stage_shifts(spark, d):
    return merge.stage_shifts(_tiles(spark, d), ["well"]).select("well", "tile", "shift_i", "shift_j")


@query(f"""WITH {_TILES}, e AS (SELECT a.well, a.tile AS x, b.tile AS y, sqrt(pow(a.x_pos - b.x_pos, 2) + pow(a.y_pos - b.y_pos, 2)) AS distance FROM t a JOIN t b ON a.well = b.well AND a.tile <> b.tile), k AS (SELECT *, row_number() OVER (PARTITION BY well, x ORDER BY distance, y) AS k FROM e WHERE distance < 300)
SELECT DISTINCT well, least(x, y) AS a, greatest(x, y) AS b, round(distance, 6) AS distance FROM k WHERE k <= 3""")
def tile_edges(spark, d):
    return rounded(merge.tile_edges(_tiles(spark, d), ["well"], 300.0), 6)


# Objects.

_PIXELS = """px AS (SELECT l_linestatus AS well, l_suppkey % 10 AS tile, l_partkey % 50 AS label, l_orderkey % 97 AS i, (l_linenumber * 13 + l_partkey % 11) % 60 AS j, l_quantity - 5 AS a, l_extendedprice AS b FROM lineitem)"""


def _pixels(spark, d):
    return table(spark, d, "lineitem").selectExpr("l_linestatus AS well", "l_suppkey % 10 AS tile", "l_partkey % 50 AS label", "l_orderkey % 97 AS i", "(l_linenumber * 13 + l_partkey % 11) % 60 AS j", "l_quantity - 5 AS a", "l_extendedprice AS b")


@query(f"""WITH {_PIXELS} SELECT well, tile, label, count(*) AS area, round(avg(i), 6) AS i, round(avg(j), 6) AS j, min(i) AS top, max(j) + 1 AS "right", round(avg(a), 6) AS a_mean, round(sum(b), 2) AS b_integrated, round(stddev_pop(a), 6) AS a_std, min(b) AS b_min, max(b) AS b_max, median(a) AS a_median FROM px WHERE label > 0 GROUP BY 1, 2, 3""")
def object_features(spark, d):
    p = _pixels(spark, d)
    f = objects.feature_table(p, ["well", "tile"], objects.channel_features(["a", "b"]))
    return f.select("well", "tile", "label", "area", *[F.round(c, 6).alias(c) for c in ("i", "j", "a_mean", "a_std")], F.col("bounds")[0].alias("top"), F.col("bounds")[3].alias("right"), F.round("b_integrated", 2).alias("b_integrated"), "b_min", "b_max", "a_median")


@query(f"""WITH {_PIXELS}, f AS (SELECT well, tile, label, round(corr(a, b), 6) AS a_b_correlation FROM px WHERE label > 0 AND a > 0 AND b > 0 GROUP BY 1, 2, 3 HAVING min(a) < max(a) AND min(b) < max(b)), n AS (SELECT well, tile, count(DISTINCT label) AS objects FROM px WHERE label > 0 GROUP BY 1, 2),
l AS (SELECT DISTINCT well, tile, label FROM px WHERE label > 0) SELECT well, tile, label, a_b_correlation, objects FROM l LEFT JOIN f USING (well, tile, label) JOIN n USING (well, tile)""")
def masked_correlation(spark, d):
    f = objects.feature_table(_pixels(spark, d), ["well", "tile"], {"a_b_correlation": objects.correlation("a", "b")}, {"objects": F.count_distinct("label")})
    return f.select("well", "tile", "label", F.round("a_b_correlation", 6).alias("a_b_correlation"), "objects")


@query(f"""WITH {_PIXELS}, t AS (SELECT *, i + tile * 60 AS y, j + (tile % 3) * 40 AS x FROM px WHERE label > 0), top AS (SELECT well, y, x, max((tile, label)) AS k FROM t GROUP BY 1, 2, 3), n AS (SELECT well, tile, label, row_number() OVER (PARTITION BY well ORDER BY tile, label) AS stitched_cell_id FROM (SELECT DISTINCT well, tile, label FROM t))
SELECT n.well AS well, stitched_cell_id, tile, label AS cell, round(avg(y), 6) AS i, round(avg(x), 6) AS j, count(*) AS area, round(avg(y) - tile * 60, 6) AS tile_i, round(avg(x) - (tile % 3) * 40, 6) AS tile_j, CAST(tile * 10 AS DOUBLE) AS stage_x, CAST(tile * 20 AS DOUBLE) AS stage_y FROM top JOIN n ON n.well = top.well AND n.tile = k[1] AND n.label = k[2] GROUP BY n.well, stitched_cell_id, tile, label""")
def stitched_cells(spark, d):
    p = _pixels(spark, d)
    shifts = p.select("well", "tile").distinct().withColumns({"shift_i": F.col("tile") * 60, "shift_j": F.col("tile") % 3 * 40, "x_pos": F.col("tile") * 10.0, "y_pos": F.col("tile") * 20.0})
    return rounded(objects.stitched_cells(p, shifts, ["well"], shifts), 6)


@query(f"""WITH {_PIXELS} SELECT well, tile, label, CAST(sum(CAST(trunc(b / (1 + (i % 5) / 10.0)) AS BIGINT) & 65535) AS BIGINT) AS b FROM px GROUP BY 1, 2, 3""")
def corrected_intensities(spark, d):
    p = _pixels(spark, d)
    field = p.select("i", "j").distinct().withColumn("b", 1 + (F.col("i") % 5) / 10.0)
    return objects.correct_illumination(p, field, ["b"]).groupBy("well", "tile", "label").agg(F.sum("b").cast("bigint").alias("b"))


@query(f"""WITH {_PLACES}, n AS (SELECT x.well, x.tile, x.cell, count(y.cell) AS neighbours, min(sqrt(pow(x.i - y.i, 2) + pow(x.j - y.j, 2))) AS nearest FROM a x LEFT JOIN a y ON x.well = y.well AND x.tile = y.tile AND x.cell <> y.cell AND sqrt(pow(x.i - y.i, 2) + pow(x.j - y.j, 2)) <= 60 GROUP BY 1, 2, 3)
SELECT well, tile, cell, neighbours, round(nearest, 6) AS nearest FROM n""")
def cell_neighbours(spark, d):
    return rounded(objects.neighbours(_places(spark, d)[0], ["well", "tile"], 60.0), 6)


# Alignment reports.


@query("""SELECT * FROM (VALUES ('w0', 2e0, 0e0, 2e0, 7e0, -3e0, 0.8e0, 4e0, 'affine', 'success', 40), ('w1', 1e0, 0e0, 1e0, 0e0, 0e0, 0e0, 1e0, 'failed_no_match', 'failed', 0)) t(well, r00, r01, r11, t0, t1, score, determinant, kind, status, triangles_0)""")
def alignment_reports(spark, d):
    rows = [("w0", [[2.0, 0.0], [0.0, 2.0]], [7.0, -3.0], 0.8), ("w1", None, None, -1.0)]
    p = registration.alignment_parameters(spark.createDataFrame(rows, "well string, rotation array<array<double>>, translation array<double>, score double"), ["well"])
    hashes = spark.range(40).select(F.lit("w0").alias("well"))
    s = registration.alignment_summary(p, hashes, hashes, ["well"])
    return p.join(s.select("well", "status", F.col("triangles_0").cast("int").alias("triangles_0")), "well").select("well", *[F.col("rotation_flat")[k].alias(n) for k, n in ((0, "r00"), (1, "r01"), (3, "r11"))], *[F.col("translation")[k].alias(f"t{k}") for k in (0, 1)], "score", "determinant", "kind", "status", "triangles_0")


# Alignment that spreads, positions by least squares, functions of groups.


@query("""SELECT c_custkey % 5 AS tile, c_custkey % 5 AS site, TRUE AS moved_back FROM customer GROUP BY 1""")
def stepwise_alignment(spark, d):
    """Five tiles of cells, and the same ones turned and moved: two known pairs lead to the others."""
    import math

    c, s = math.cos(0.03), math.sin(0.03)
    a = table(spark, d, "customer").selectExpr("'w' AS well", "c_custkey % 5 AS tile", "c_custkey * 37 % 997 + 0.0D AS i", "(c_acctbal * 7) % 883 AS j")
    b = joins.affine(a, [[c, -s], [s, c]], [25.0, -14.0])
    h0, h1 = registration.hash_cells(a, ["well", "tile"], packed=True), registration.hash_cells(b, ["well", "tile"], packed=True)
    where = spark.createDataFrame([("w", t, 100.0 * (t % 3), 90.0 * (t // 3)) for t in range(5)], "well string, tile bigint, x_pos double, y_pos double")
    seeds = spark.createDataFrame([("w", 0, 0), ("w", 1, 1), ("w", 4, 4)], "well string, tile bigint, site bigint")
    out = registration.multistep_alignment(h0, h1, where, where.withColumnRenamed("tile", "site"), seeds, ["well"])
    back = (F.abs(F.col("translation")[0] - 25) < 0.5) & (F.abs(F.col("translation")[1] + 14) < 0.5)
    return out.select("tile", "site", back.alias("moved_back"))


@query(f"""WITH {_TILES} SELECT well, tile, round(x_pos - min(x_pos) OVER (PARTITION BY well), 3) AS i, round(y_pos - min(y_pos) OVER (PARTITION BY well), 3) AS j FROM t""")
def solved_positions(spark, d):
    """Shifts between neighbouring tiles of a well, a bounded group, give their positions back."""
    t = _tiles(spark, d)
    at = lambda k: t.select("well", F.col("tile").alias(k), F.col("x_pos").alias(f"x_{k}"), F.col("y_pos").alias(f"y_{k}"))
    edges = merge.tile_edges(t, ["well"], 300.0, neighbours=8).join(at("a").hint("merge"), ["well", "a"]).join(at("b").hint("merge"), ["well", "b"])
    edges = edges.select("well", "a", "b", (F.col("x_b") - F.col("x_a")).alias("di"), (F.col("y_b") - F.col("y_a")).alias("dj"))

    def solve(g):
        out = registration.solve_positions(g, sorted(set(g["a"]) | set(g["b"])))
        out.insert(0, "well", g["well"].iloc[0])
        return out

    return rounded(joins.group_map(edges, ["well"], solve, "well string, tile bigint, i double, j double"), 3).withColumns({"i": F.col("i") + 0.0, "j": F.col("j") + 0.0})
