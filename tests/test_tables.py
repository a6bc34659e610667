import numpy as np
import pytest
from pyspark.sql import functions as F

from wellspring.functions import barcodes
from wellspring.operators import classify, cluster, images, joins, merge, qc, sbs
from wellspring.sources import tables


def test_names_round_trip(spark):
    name = tables.file_name({"plate": 1, "well": "A1", "channel_combo": "DAPI_COXIV", "leiden_resolution": 5}, "cells", "tsv")
    n = tables.parse_names(F.lit(f"x/y/{name}"))
    r = spark.range(1).select(*[n[k].alias(k) for k in ("plate", "well", "tile", "channel_combo", "leiden_resolution", "info", "extension")]).first()
    assert tuple(r) == ("1", "A1", None, "DAPI_COXIV", "5", "cells", "tsv")


def test_manifest(spark, tmp_path):
    for t in (1, 2):
        (tmp_path / f"P-1_T-{t}.npy").write_bytes(b"x")
    m = tables.manifest(spark, str(tmp_path), r"P-(\d+)_T-(\d+)\.npy", ["plate", "tile"])
    assert [(r.plate, r.tile) for r in m.collect()] == [(1, 1), (1, 2)]
    assert tables.select_samples(m, tile="2").count() == 1 and tables.partition_combos(m).count() == 2
    with pytest.raises(ValueError):
        tables.manifest(spark, str(tmp_path), "nothing(x)", ["plate"])


def test_infer_dtypes(spark):
    df = spark.createDataFrame([("1", "true", "1.5", "a", 2.0), (None, "False", "2", "b", None)], "a string, b string, c string, d string, e double")
    assert tables.infer_dtypes(df).dtypes == [("a", "bigint"), ("b", "boolean"), ("c", "double"), ("d", "string"), ("e", "bigint")]


def test_feature_names(spark):
    f = ["nucleus_DAPI_mean", "cell_DAPI2_mean", "cell_GFP_area", "cytoplasm_GFP_mean"]
    assert tables.channel_subset(f, ["GFP", "DAPI2"], ["DAPI", "DAPI2", "GFP"]) == ["cell_GFP_area", "cytoplasm_GFP_mean"]
    assert tables.channel_subset(f, ["GFP", "DAPI2"], ["DAPI", "DAPI2", "GFP"], tokens=True) == f[1:]
    assert tables.table_features(f) == ["nucleus_DAPI_mean", "cell_DAPI2_mean", "cell_GFP_area"]
    with pytest.raises(ValueError):
        tables.split_columns(spark.createDataFrame([("a", 1.0)], "m string, x double"), [])


def test_stage_metadata(spark):
    df = spark.createDataFrame([(1.5, 2.0)], "X_mm double, y double")
    assert tuple(tables.stage_metadata(df).select("x_pos", "y_pos", "z_pos").first()) == (1500.0, 2.0, None)


def test_writes_and_reads(spark, tmp_path):
    df = spark.createDataFrame([("g", "s", 1.0), ("h", "t", float("nan"))], "gene string, sgrna string, x double")
    tables.write_partitioned(df, f"{tmp_path}/a", ["gene", "sgrna"])
    assert {(r.gene, r.x) for r in tables.read_tables(spark, f"{tmp_path}/a").collect()} == {("g", 1.0), ("h", None)}
    tables.write_json(df, f"{tmp_path}/b")
    assert spark.read.json(f"{tmp_path}/b").count() == 2


def test_reference_tables(spark, tmp_path):
    (tmp_path / "sets.json").write_text('{"A": {"geneSymbols": ["x", "y"]}, "B": {"geneSymbols": ["z"]}}')
    assert {(r.gene_name, r.group) for r in tables.json_gene_sets(spark, f"{tmp_path}/sets.json").collect()} == {("x", "A"), ("y", "A"), ("z", "B")}
    up = spark.createDataFrame([("E1", "ABC DEF", "9606.1;"), ("E2", "DEF XYZ", "9606.2;9606.3")], "entry string, gene_names string, string string")
    links = spark.createDataFrame([("9606.1", "9606.2", 990), ("9606.1", "9606.9", 999), ("9606.2", "9606.1", 960), ("9606.1", "9606.2", 10)], "protein1 string, protein2 string, combined_score int")
    assert sorted(r.gene_name for r in tables.string_pairs(links, up).collect()) == ["ABC", "DEF"]
    assert {(r.gene_name, r.entry) for r in sbs.synonyms(up).collect()} == {("ABC", "E1"), ("DEF", "E2"), ("XYZ", "E2")}
    assert {tuple(r) for r in sbs.check_symbols(spark.createDataFrame([("XYZ",), ("ABC",), ("Q",)], "gene_symbol string"), up).collect()} == {("XYZ", "use DEF"), ("ABC", "ok"), ("Q", "unknown")}
    g = tables.complex_groups(spark.createDataFrame([("c", "x; y;")], "name string, genes string"), "name", "genes")
    assert sorted(r.gene_name for r in g.collect()) == ["x", "y"]


def test_barcodes(spark):
    df = spark.createDataFrame([("ACGTAC", 3)], "s string, n int")
    r = df.select(barcodes.skip_cycles("s", [2], 4), barcodes.dynamic_prefix("s", "n"), barcodes.substring_1based(F.col("s"), 2, 4), barcodes.hamming(F.col("s"), F.lit("ACCTA"))).first()
    assert tuple(r) == ("AGTA", "ACG", "CGT", 2)
    assert barcodes.cycle_positions(3, 2, "recomb_map", [2]) == {"recomb_start": 1, "recomb_end": 2, "map_start": 3, "map_end": 4}
    r = spark.range(1).select(barcodes.first_known(F.lit("a b c"), F.array(F.lit("b"))), barcodes.first_known(F.lit("a b"), F.array(F.lit("z"))), barcodes.before_ampersand(F.lit("x & y")), barcodes.canon_plate(F.lit("1.0")), barcodes.canon_well(F.lit(" a1 "))).first()
    assert tuple(r) == ("b", "a", "x", "1", "A1")


def test_calls_one_clear_read(spark):
    rows = [("p", "w", 1, 7, c, b, v, 3, 0, 0) for c, best in ((1, "A"), (2, "T")) for b, v in (("A", 1.0), ("C", 1.0), ("G", 1.0), ("T", 1.0)) for v in [100.0 if b == best else v]]
    df = spark.createDataFrame(rows, "plate string, well string, tile int, read int, cycle int, channel string, intensity double, cell int, i int, j int")
    r = sbs.call_reads(df, list("ACGT"), method="none").first()
    assert r.barcode == "AT" and r.q_min == pytest.approx(1.0)
    assert sbs.call_reads(df, list("ACGT"), method="median").first().barcode is not None


def test_call_cells_rejects_double_keys(spark):
    reads = spark.createDataFrame([("p", "w", 1, 1, 0, "AC", 1.0, 1.0), ("p", "w", 1, 2, 5, "AC", 1.0, 1.0)], "plate string, well string, tile int, read int, cell int, barcode string, q_min double, peak double")
    lib = spark.createDataFrame([("AC", "g")], "prefix string, gene_symbol string")
    out = sbs.call_cells(reads, lib).collect()
    assert [(r.cell, r.gene_symbol_0, r.barcode_1) for r in out] == [(5, "g", None)]
    with pytest.raises(ValueError):
        sbs.call_cells(reads, lib.union(lib))


def test_error_correction_needs_one_nearest(spark):
    lib = spark.createDataFrame([("AAAA",), ("AAAT",), ("CCCC",)], "barcode string")
    reads = spark.createDataFrame([("AAAG",), ("CCCG",), ("AAAA",), ("GGGG",), (None,)], "barcode string")
    assert sorted(map(str, (r.barcode for r in joins.error_correct(reads, lib).collect()))) == ["AAAA", "AAAG", "CCCC", "GGGG", "None"]


def test_recombination(spark):
    lib = spark.createDataFrame([("A", "X"), ("A", "Y")], "prefix_map string, prefix_recomb string")
    reads = spark.createDataFrame([("A", "Y", 1.0), ("A", "X", 1.0), ("A", "Y", 0.1), ("B", "Y", 1.0)], "prefix_map string, prefix_recomb string, q_recomb double")
    got = sorted((r.prefix_map, r.prefix_recomb, r.q_recomb, r.no_recomb) for r in sbs.no_recombination(reads, lib, min_quality=0.5).collect())
    assert got == [("A", "X", 1.0, False), ("A", "Y", 0.1, None), ("A", "Y", 1.0, True), ("B", "Y", 1.0, False)]


def test_mutual_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    a, b = rng.random((150, 2)) * 100, rng.random((150, 2)) * 100
    frame = lambda p: spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(p)], "id int, i double, j double")
    got = {(r.id_0, r.id_1) for r in joins.nearest_mutual(frame(a), frame(b), 5.0).collect()}
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    want = {(i, int(d[i].argmin())) for i in range(150) if d[:, d[i].argmin()].argmin() == i and d[i].min() < 5}
    assert got == want and len({x for x, _ in got}) == len(got)
    exact = joins.nearest_mutual(frame(np.array([[0.0, 0.0]])), frame(np.array([[0.0, 5.0]])), 5.0)
    assert exact.count() == 0 and joins.nearest_one_way(frame(np.array([[0.0, 0.0]])), frame(np.array([[0.0, 5.0]])), 5.0).count() == 1


def test_deduplicated_keys_are_unique(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 2, 1.0), (2, 2, 5.0), (3, 2, 0.5)], "a int, b int, d double")
    out = merge.deduplicate(df, ["a"], ["d", "b"], ["b"], ["d", "a"]).collect()
    assert [(r.a, r.b) for r in out] == [(3, 2)]
    n = {r.stage: r.n for r in merge.deduplicate_stats(df, ["a"], ["d", "b"], ["b"], ["d", "a"]).collect()}
    assert n == {"initial": 4, "first": 3, "second": 1}


def test_stitching_helpers(spark):
    m = spark.createDataFrame([("w", t, float(100 * (t % 3)), float(100 * (t // 3)), 0.5) for t in range(9)], "well string, tile int, x_pos double, y_pos double, pixel_size_x double")
    g = {r.tile: (r.grid_x_pos, r.grid_y_pos) for r in merge.grid_positions(m, ["well"]).collect()}
    assert g[5] == (2, 1)
    assert {r.tile: (r.shift_i, r.shift_j) for r in merge.stage_shifts(m, ["well"]).collect()}[4] == (200, 200)
    assert merge.tile_edges(m, ["well"], 101.0).count() >= 8
    p = spark.createDataFrame([(0.0, 0.0), (10.0, 20.0)], "i double, j double")
    assert merge.scale_factor(p, merge.scale_coordinates(p, 3.0)) == 3.0 and merge.bounding_overlap(p, p) == 1.0
    r = merge.align_metadata(m, flip_x=True, rotate_90=True).agg(F.min("x_pos"), F.max("y_pos")).first()
    assert tuple(r) == (0.0, 200.0)
    assert merge.closest_tiles(m, m, 4, 1).first().tile == 4


def test_format_merge(spark):
    matches = spark.createDataFrame([("p", "w", 1, 10, 3.0, 4.0, 2, 20, 0.0, 0.0, 1.0)], "plate string, well string, tile int, cell_0 int, i_0 double, j_0 double, site int, cell_1 int, i_1 double, j_1 double, distance double")
    cells = spark.createDataFrame([("p", "w", 2, 20, "g", "g")], "plate string, well string, tile int, cell int, gene_symbol_0 string, gene_symbol_1 string")
    ph = spark.createDataFrame([("p", "w", 1, 10, float("nan"), 7.0)], "plate string, well string, tile int, label int, cell_A_min double, cell_B_min double")
    r = merge.format_merge(matches, cells, ph, (0, 0)).first()
    assert r.mapped_single_gene and r.channel_min == 7.0 and r.fov_distance_0 == 5.0


def test_enrichment_and_complexes(spark):
    c = spark.createDataFrame([(g, 0 if g < 5 else 1) for g in range(20)], "gene int, cluster int")
    g = spark.createDataFrame([(i, "x") for i in range(5)] + [(i, "y") for i in (0, 7, 13)], "gene int, group string")
    e = {(r.cluster, r.group): (r.a, r.b, r.c, r.d, r.enriched) for r in cluster.group_enrichment(c, g).collect()}
    assert e[0, "x"] == (5, 0, 0, 15, True) and e[0, "y"][:4] == (1, 4, 2, 13)
    assert {r.cluster: r.groups for r in cluster.enriched_lists(cluster.group_enrichment(c, g)).collect()}[0] == "x"
    f = cluster.filter_complexes(g, c)
    assert {r.group for r in f.collect()} == {"x", "y"}
    t = {"x": cluster.enriched_lists(cluster.group_enrichment(c, g))}
    assert cluster.combined_table(t).count() == 2 and cluster.enriched_in(t).count() >= 1


def test_qc_tables(spark):
    df = spark.createDataFrame([("w", 0, 1), ("w", 2, 2)], "well string, tile int, cell int")
    assert {r.tile: r.cells for r in qc.density_grid(df, ["well"]).collect()} == {0: 1, 1: 0, 2: 1}
    r = spark.createDataFrame([("a", 1.0, True), ("b", 1.0, True), ("c", 9.0, False)], "k string, m double, ok boolean")
    assert sorted(x.k for x in qc.best_parameters(r, "m", success="ok").collect()) == ["a", "b"]
    assert qc.unseen_counts(df, df.where("tile = 2"), ["well"]).first().outside == 1
    assert qc.match_heatmap(df, df.where("cell = 1"), ["cell"], ["well", "tile"]).count() == 1


def test_classifiers(spark):
    rows = [(i, float(i % 10), float(i), "a" if i % 10 < 5 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "i int, x double, y double, label string")
    model, accuracy = classify.TrainedClassifier.train(df, ["x", "y"], "label")
    out = model.classify_cells(df.withColumn("x", F.when(F.col("i") != 0, F.col("x"))))
    assert accuracy > 0.9 and out.count() == 199 and set(out.columns) >= {"class", "confidence", "prob_a", "prob_b"}
    fixed = classify.calibrate(out.select("i", "class", "confidence"), df.select("i", "label"), ["i"])
    assert fixed.where("confidence BETWEEN 0 AND 1").count() == 199
    few = classify.calibrate(out.select("i", "class", "confidence"), df.limit(10).select("i", "label"), ["i"])
    assert few.where("confidence BETWEEN 0 AND 1").count() == 199
    assert classify.enhance_features(df.withColumn("z", F.col("y") * 2).withColumn("k", F.lit(1.0)), ["x", "y", "z", "k"], "label", k_best=1) == ["x"]
    assert classify.class_mapping(["u", "v", "w"], ["v"]) == {1: "u", 2: "w"}
    labels = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "i int, t int, l string")
    assert classify.latest_labels(labels, ["i"], "t", df.select("i")).first().l == "b"
    with pytest.raises(ValueError):
        classify.latest_labels(labels, ["i"], "t", df.select("i").union(df.select("i")))
    assert classify.map_categories(df, "label", {"a": "first"}, default="rest").where("category = 'rest'").count() == 100
    assert set(classify.split_by_class(df, "label", "y", {"a": 100.0})) == {"all", "a", "b"}


def test_images(spark, tmp_path):
    x = np.zeros((2, 1, 32, 32))
    x[:, 0, 10, 12] = [5, 50]
    (tmp_path / "a.npy").write_bytes(images.encode(x))
    df = images.read_images(spark, str(tmp_path))
    peaks = images.map_tables(images.map_images(df, lambda a: images.find_peaks(images.cycle_deviation(a))), lambda a: __import__("pandas").DataFrame(np.argwhere(a > 0), columns=["i", "j"]), "i bigint, j bigint")
    assert [(r.i, r.j) for r in peaks.collect()] == [(10, 12)]
    mask = np.zeros((8, 8), bool)
    mask[1:3, 1:3] = mask[5:7, 5:7] = True
    t = images.objects(images.components(mask), mask[None].astype(float))
    assert list(t["area"]) == [4, 4] and sorted(t["i"]) == [1.5, 5.5]
    a = np.random.default_rng(0).random((32, 32))
    assert images.phase_offset(a, np.roll(a, (3, -2), (0, 1))) == (-3.0, 2.0)
    assert images.laplacian_of_gaussian(x)[1, 0].argmax() == 10 * 32 + 12 and images.illumination([a + 1, a + 1]).min() >= 1


def test_near_points_are_never_broadcast(spark):
    """A table of tiles is small as a file and large as a hashed relation on the driver."""
    p = spark.range(200).select(F.lit("w").alias("well"), F.col("id").alias("tile"), (F.col("id") % 20 * 10.0).alias("x_pos"), (F.col("id") / 20).alias("y_pos"))
    plan = merge.tile_edges(p, ["well"], 15.0)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_control_distances_by_blocks(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(90, 5)) + 100
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(90, None)], "g int, v array<double>")
    d = np.sqrt(((x[:, None] - x[None, :30]) ** 2).sum(-1)).mean(1)
    got = {r.gene: r for r in cluster.control_distance(df, "g", "v", F.col("g") < 30, block=7).collect()}
    assert got[90].mean_distance is None and np.allclose([got[i].mean_distance for i in range(90)], d)
    y = x / np.sqrt((x**2).sum(1))[:, None]
    got = {r.gene: r.mean_distance for r in cluster.control_distance(df, "g", "v", F.col("g") < 30, "cosine", 7).collect()}
    assert np.allclose([got[i] for i in range(90)], (1 - y @ y[:30].T).mean(1))


def test_close_pairs_keep_their_digits():
    x = np.random.default_rng(6).normal(size=(40, 8))
    near = np.vstack([x, x + 1e-7])
    assert np.allclose(cluster.distance_sums(x, near[40:41]), np.sqrt(((x - near[40]) ** 2).sum(1)), rtol=1e-7, atol=0)
    assert abs(cluster.distance_sums(near[:1], near[[0, 40]])[0] - 1e-7 * np.sqrt(8)) < 1e-13
