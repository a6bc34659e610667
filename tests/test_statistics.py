import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wellspring.functions import stats
from wellspring.operators import bootstrap, filters, graph, normalise, registration


def bh(p):
    p = np.asarray(p, float)
    order = np.argsort(p)
    q = p[order] * len(p) / np.arange(1, len(p) + 1)
    out = np.empty(len(p))
    out[order] = np.minimum(1, np.minimum.accumulate(q[::-1])[::-1])
    return out


def test_bh_pooled_and_grouped(spark):
    rng = np.random.default_rng(0)
    p = np.round(rng.random(200) ** 2, 3)  # with ties
    df = spark.createDataFrame([(i, float(x), "g") for i, x in enumerate(p)], "i int, p double, g string")
    for by in (None, ["g"]):
        got = {r.i: r.q for r in stats.benjamini_hochberg(df, "p", "q", by=by, order=["i"]).collect()}
        assert np.allclose([got[i] for i in range(200)], bh(p))
    assert all(got[i] >= p[i] - 1e-12 for i in range(200))


def test_bh_keeps_null_p(spark):
    df = spark.createDataFrame([(1, 0.01), (2, None), (3, 0.5)], "i int, p double")
    got = {r.i: r.q for r in stats.benjamini_hochberg(df, "p", "q").collect()}
    assert got[2] is None and got[1] == pytest.approx(0.02) and got[3] == pytest.approx(0.5)


def test_tails(spark):
    df = spark.createDataFrame([(4.0, 3.0, 10.0, 2.228138852, 1.959963985)], "f double, a double, b double, t double, z double")
    r = df.select(stats.f_tail("f", "a", "b"), stats.t_two_sided("t", "b"), stats.normal_two_sided("z")).first()
    assert r[0] == pytest.approx(0.0414, abs=1e-3) and r[1] == pytest.approx(0.05, abs=1e-6) and r[2] == pytest.approx(0.05, abs=1e-6)


def test_fisher(spark):
    df = spark.createDataFrame([(3, 1, 1, 3), (0, 0, 0, 0), (8, 2, 1, 5), (2, 2, 2, -1)], "a int, b int, c int, d int")
    got = [r[0] for r in df.select(stats.fisher_exact("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(0.4857142857) and got[1] == 1.0 and got[2] == pytest.approx(0.0349650350) and 0 < got[3] <= 1


def test_medians_and_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", float("nan")), ("b", 5.0), ("c", 1.0)], "g string, x double")
    got = {r.g: (r.s, r.k) for r in df.groupBy("g").agg(stats.median_strict("x").alias("s"), stats.median_skipna("x").alias("k")).collect()}
    assert got == {"a": (None, 2.0), "b": (None, 5.0), "c": (1.0, 1.0)}


def test_predicate_semantics(spark):
    df = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y"), (3, 3.0, None)], "i int, a double, b string")
    ids = lambda q, **v: [r.i for r in df.where(filters.predicate(q, v)).orderBy("i").collect()]
    assert ids("a != 1") == [2, 3] and ids("a > 0") == [1, 3] and ids("not a > 0") == [2]
    assert ids("0 < a <= 1 or b == 'y'") == [1, 2] and ids("b in ['x', 'y'] & i >= 2") == [2] and ids("b not in @xs", xs=["x"]) == [2, 3]
    assert ids("`a` == 3") == [3] and filters.query_filter(df, None).count() == 3
    with pytest.raises(ValueError):
        filters.predicate("__import__('os')")


def test_scaling_on_controls(spark):
    rows = [("p", True, 1.0), ("p", True, 3.0), ("p", False, 9.0), ("q", False, 5.0), ("r", True, 2.0), ("r", True, 2.0), ("r", False, 4.0)]
    df = spark.createDataFrame(rows, "b string, c boolean, x double")
    got = sorted((r.b, r.c, r.x) for r in normalise.scale_on_controls(df, ["x"], F.col("c"), ["b"]).collect())
    assert got == [("p", False, 7.0), ("p", True, -1.0), ("p", True, 1.0), ("q", False, 5.0), ("r", False, 2.0), ("r", True, 0.0), ("r", True, 0.0)]
    mad = {(r.b, round(r.x, 9)) for r in normalise.scale_on_controls(df, ["x"], F.col("c"), ["b"], "mad").where("NOT c").collect()}
    assert mad == {("p", round(0.6745 * 7, 9)), ("q", 5.0), ("r", round(0.6745 * 2, 9))}


def test_tvn_matches_control_covariances(spark):
    rng = np.random.default_rng(3)
    rows = []
    for b, spread in (("u", 1.0), ("v", 3.0)):
        for i in range(200):
            x = rng.standard_normal(3) * spread + (b == "v")
            rows.append((f"{b}{i}", b, i % 2 == 0, x.tolist()))
    df = spark.createDataFrame(rows, "id string, b string, c boolean, x array<double>")
    out = normalise.tvn(df, "x", F.col("c"), "b", ridge=1e-6).toPandas()
    at = {r.id: r for r in out.itertuples()}
    control = [i for i, b, c, _ in rows if c]
    covs = [np.cov(np.stack([at[i].x for i in control if i.startswith(b)]).T) for b in "uv"]
    assert np.allclose(covs[0], covs[1], atol=0.05)


def test_pca(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 5))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, x array<double>")
    out, share = normalise.pca(df, "x", 3, scale=False)
    got = np.stack([r.x for r in out.orderBy("i").collect()])
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :3] * s[:3]), atol=1e-8) and np.allclose(share[:5], s**2 / (s**2).sum())


def test_lof_and_knn():
    rng = np.random.default_rng(2)
    x = np.vstack([rng.standard_normal((100, 2)), [[12.0, 12.0]]])
    assert filters.local_outlier_factor(x).argmax() == 100
    y = np.array([[0.0, np.nan], [10.0, 1.0]])
    ref = np.array([[0.0, 5.0], [0.1, 7.0], [10.0, 100.0]])
    assert filters.fill_from_neighbours(y, ref, 2)[0, 1] == 6.0


def test_delaunay_is_empty_circle():
    rng = np.random.default_rng(5)
    p = rng.random((60, 2)) * 100
    t, beside = registration.delaunay(p)
    for a, b, c in t:
        m = 2 * np.array([p[b] - p[a], p[c] - p[a]])
        centre = np.linalg.solve(m, [(p[b] ** 2 - p[a] ** 2).sum(), (p[c] ** 2 - p[a] ** 2).sum()])
        r = ((p[a] - centre) ** 2).sum()
        d = ((p - centre) ** 2).sum(1)
        d[[a, b, c]] = np.inf
        assert d.min() > r - 1e-6
    for k, near in enumerate(beside):
        assert all(n < 0 or len(set(t[k]) & set(t[n])) == 2 for n in near)


def test_alignment_recovers_rotation():
    rng = np.random.default_rng(6)
    p = rng.random((150, 2)) * 1000
    r = np.array([[math.cos(0.03), -math.sin(0.03)], [math.sin(0.03), math.cos(0.03)]])
    a, b = registration.triangle_hashes(p), registration.triangle_hashes(p @ r.T + [5, -9])
    rotation, translation, score = registration.evaluate_match(a, b)
    assert np.allclose(rotation, r, atol=1e-3) and np.allclose(translation, [5, -9], atol=0.5) and score > 0.9


def test_leiden_finds_blocks():
    w = np.zeros((30, 30))
    for k in range(3):
        w[k * 10 : k * 10 + 10, k * 10 : k * 10 + 10] = 1
    w[0, 10] = w[10, 0] = w[20, 10] = w[10, 20] = 1
    np.fill_diagonal(w, 0)
    labels = graph.leiden(w)
    assert len(set(labels)) == 3 and all(len(set(labels[k * 10 : k * 10 + 10])) == 1 for k in range(3))
    assert graph.modularity(w, labels) > 0.6


def test_auc_and_out_of_fold():
    rng = np.random.default_rng(7)
    y = np.repeat([1.0, 0.0], 60)
    x = rng.standard_normal((120, 4)) + y[:, None] * [2, 0, 0, 0]
    p, _ = bootstrap.out_of_fold(x, y, 2, 5, rng)
    pairs = np.mean([(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]])
    assert bootstrap.auc(p, y) == pytest.approx(pairs) and pairs > 0.85


def test_intensity_filter_judges_whole_groups(spark):
    rng = np.random.default_rng(5)
    rows = [(i, None if i % 3 == 0 else "w", *map(float, rng.normal(size=2) * rng.choice([1, 4]))) for i in range(400)] + [(900, "w", None, 1.0), (901, "alone", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "i int, well string, a_x_mean double, b_x_mean double")
    want = {900, 901}
    for odd in (False, True):
        mine = [r for r in rows[:400] if (r[0] % 3 == 0) == odd]
        s = filters.local_outlier_factor(np.array([r[2:] for r in mine]), 20)
        want |= {r[0] for r, v in zip(mine, s) if v <= np.quantile(s, 0.95)}
    for size in (50, 20_000):
        got = filters.intensity_filter(df, ["a_x_mean", "b_x_mean"], ["x"], 0.05, ["well"], block_rows=size, keys=["i"])
        assert got.columns == df.columns and {r.i for r in got.collect()} == want
    assert filters.intensity_filter(df, ["a_x_mean"], ["x"], 0.05, block_rows=100).count() < 402


def test_alignment_goes_on_while_batches_add_pairs(spark, monkeypatch):
    def pairs_as_given(hashes_0, hashes_1, pairs, keys, **options):
        same = (F.col("tile") == F.col("site")).cast("double")
        none = F.lit(None)
        return pairs.select(*keys, "tile", "site", none.cast("array<array<double>>").alias("rotation"), none.cast("array<double>").alias("translation"), same.alias("score"), F.lit(1.0).alias("determinant"))

    monkeypatch.setattr(registration, "align_pairs", pairs_as_given)
    tiles = [("w", t, 100.0 * (t % 7), 100.0 * (t // 7)) for t in range(49)]
    where_0 = spark.createDataFrame(tiles, "well string, tile long, x_pos double, y_pos double")
    seeds = spark.createDataFrame([("w", t, t) for t in (0, 6, 42)], "well string, tile long, site long")
    got = registration.multistep_alignment(where_0, where_0, where_0, where_0.withColumnRenamed("tile", "site"), seeds, ["well"], batch=2)
    assert sorted(r.tile for r in got.collect()) == list(range(49))


def test_perturbation_scores_reach_every_cell(spark):
    rng = np.random.default_rng(3)
    gene = ["c"] * 300 + ["big"] * 200 + ["even"] * 60 + ["small"] * 40
    x = rng.normal(size=(600, 3)) + np.where(np.array(gene) == "c", 0, 2)[:, None]
    df = spark.createDataFrame([(i, g, *map(float, v)) for i, (g, v) in enumerate(zip(gene, x))] + [(300, "big", *map(float, x[300]))], "i int, g string, a double, b double, d double")
    get = lambda most: bootstrap.perturbation_scores(df, ["a", "b", "d"], "g", F.col("g") == "c", ["i"], least=20, most=most).toPandas()
    whole, capped = get(1000), get(60)
    assert sorted(capped["i"]) == sorted(whole["i"]) == sorted([*range(300, 600), 300])
    assert capped["perturbation_score"].between(0, 1).all() and capped.groupby("g")["perturbation_auc"].nunique().eq(1).all()
    both = whole.groupby("i")["perturbation_score"].mean() - capped.groupby("i")["perturbation_score"].mean()
    assert both[both.index < 500].abs().mean() < 0.1
    a, b = whole.groupby("g")["perturbation_auc"].first(), capped.groupby("g")["perturbation_auc"].first()
    assert a["big"] > 0.9 and abs(a["big"] - b["big"]) < 0.03


def test_pooled_auc_equals_auc(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 500)
    p = np.round(np.clip(rng.random(500) * 0.7 + 0.3 * y, 0, 1), 2)
    df = spark.createDataFrame([("g", float(a), int(b)) for a, b in zip(p, y)], "g string, p double, y int")
    assert bootstrap.pooled_auc(df, "g", "p", "y", buckets=8).first()[1] == pytest.approx(bootstrap.auc(p, y))


def test_bootstrap_is_repeatable(spark):
    controls = spark.createDataFrame([("c1", float(i)) for i in range(20)] + [("c2", float(i + 50)) for i in range(5)], "k string, x double")
    constructs = spark.createDataFrame([("a", 5), ("b", 3), ("z", 0)], "k string, cell_count int")
    get = lambda: sorted((r.k, r.sim, tuple(r.x)) for r in bootstrap.construct_bootstrap(constructs, controls, ["x"], "k", sims=20).collect())
    one = get()
    assert one == get() and len(one) == 40
    seen = spark.createDataFrame([("a", 1000.0), ("b", -1.0)], "k string, x double")
    p = {r.k: r.x_pval for r in bootstrap.p_values(bootstrap.construct_bootstrap(constructs, controls, ["x"], "k", sims=20), seen, ["x"], "k").collect()}
    assert p == {"a": 0.0, "b": 0.0}
    c = {r.k: r.x_pval for r in bootstrap.correct_pooled(bootstrap.p_values(bootstrap.construct_bootstrap(constructs, controls, ["x"], "k", sims=20), seen, ["x"], "k"), ["x"], "k").collect()}
    assert c == {"a": 0.05, "b": 0.05}


def test_missing_values_and_imputation(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, float("nan")), (3, None, 4.0)], "i int, a double, b double")
    kept, features = filters.missing_values_filter(df, ["a", "b"], 0.5, 0.5)
    assert features == ["a"] and sorted(r.i for r in kept.collect()) == [1, 2]
    full = filters.impute_knn(df, ["a", "b"], ["i"]).toPandas()
    assert not full.isna().any().any()


def test_class_thresholds(spark):
    df = spark.createDataFrame([(1, 0, 0.2, 0.2, 0.8), (2, 0, 0.9, 0.9, 0.1), (3, 1, 0.1, 0.4, 0.1), (4, 2, 0.5, 0.1, 0.1)], "i int, k int, c double, p0 double, p1 double")
    got = {r.i: (r.k, r.c) for r in filters.class_thresholds(df, "k", "c", {0: {"threshold": 0.5, "mode": "reassign"}, 1: 0.3}, {0: "p0", 1: "p1"}).collect()}
    assert got == {1: (1, 0.8), 2: (0, 0.9), 4: (2, 0.5)}
    assert filters.class_thresholds(df, "k", "c", {0: 0.0}).count() == 4
    s = {r["class"]: (r.before, r.after) for r in filters.threshold_summary(df, df.where("i < 3"), "k").collect()}
    assert s["TOTAL"] == (4, 2) and s["1"] == (1, 0)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "i int, g string, x double")
    assert normalise.aggregate(empty, ["x"], "g").count() == 0
    assert stats.benjamini_hochberg(empty, "x", "q").count() == 0
    assert filters.drop_low_seeds(empty, "x", ["i"]).count() == 0
    assert filters.score_gate(empty, "x", percentile=50).count() == 0


def test_pandas_input_is_plain():
    assert isinstance(registration.triangle_hashes(np.zeros((4, 2))), pd.DataFrame)


@pytest.mark.parametrize("rows", [50_000, 40])
def test_exact_quantiles(spark, monkeypatch, rows):
    """The same whether values are counted at once or narrowed down to."""
    monkeypatch.setattr(stats, "QUANTILE_ROWS", rows)
    monkeypatch.setattr(stats, "QUANTILE_STEPS", 20)
    rng = np.random.default_rng(3)
    shares = [0.0, 0.013, 0.25, 0.5, 0.731, 0.95, 1.0]
    for x in (rng.standard_normal(997), np.round(rng.random(500), 1), np.repeat([1.0, 5.0], [400, 1]), np.array([2.5]), np.append(rng.random(300), np.nan)):
        df = spark.createDataFrame([(float(v),) for v in x], "x double")
        assert np.allclose(stats.exact_quantiles(df, "x", shares), np.quantile(x[~np.isnan(x)], shares), rtol=1e-12)
    assert stats.exact_quantiles(spark.createDataFrame([(None,)], "x double"), "x", [0.5]) == [None]


def test_bootstrap_values_joined_or_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(4)
    controls = spark.createDataFrame([(f"c{i % 7}", float(np.round(rng.random(), 1)), float(i)) for i in range(300)] + [("c1", None, 1.0)], "k string, x double, y double")
    constructs = spark.createDataFrame([("a", 5), ("b", 12), ("c", 0)], "k string, cell_count int")
    get = lambda: sorted((r.k, r.sim, tuple(r.x)) for r in bootstrap.construct_bootstrap(constructs, controls, ["x", "y"], "k", sims=30).collect())
    one = get()
    monkeypatch.setattr(bootstrap, "BROADCAST_BYTES", 0)
    assert one == get() and len(one) == 60
    assert bootstrap.construct_bootstrap(constructs, controls.where("x > 9"), ["x"], "k").count() == 0


def test_warps(spark):
    rng = np.random.default_rng(5)
    x = rng.random((300, 2)) * 500
    bend = lambda p: p + np.column_stack([3 * np.sin(p[:, 1] / 150), 2 * np.cos(p[:, 0] / 200)])
    y = bend(x)
    for model in ("polynomial", "thin_plate"):
        fine = registration.refine_warp(x, y, x, 5.0, model=model, degree=3)
        assert np.abs(fine - y).max() < 0.5 * np.abs(x - y).max()
    assert (registration.refine_warp(x[:20], y[:20], x[:20], 5.0) == x[:20]).all()
    keys = "plate string, well string, tile int, cell int, i double, j double"
    a = spark.createDataFrame([("p", "w", 1, k, float(p[0]), float(p[1])) for k, p in enumerate(x)], keys)
    b = spark.createDataFrame([("p", "w", 9, k, float(p[0]), float(p[1])) for k, p in enumerate(y)], keys.replace("tile", "site"))
    al = spark.createDataFrame([("p", "w", 1, 9, [[1.0, 0.0], [0.0, 1.0]], [0.0, 0.0])], "plate string, well string, tile int, site int, rotation array<array<double>>, translation array<double>")
    from wellspring.operators import joins

    plain, warped = (joins.merge_by_alignment(a, b, al, 4.0, warp=w).where("cell_0 = cell_1") for w in (None, "polynomial"))
    mean = lambda df: df.agg(F.avg("distance")).first()[0]
    assert warped.count() >= plain.count() and mean(warped) < 0.5 * mean(plain)


def test_regional_alignment(spark):
    rng = np.random.default_rng(6)
    x = rng.random((700, 2)) * 1000
    turn = np.array([[math.cos(0.05), -math.sin(0.05)], [math.sin(0.05), math.cos(0.05)]])
    y = (x - 500) @ turn.T + 500 + [20.0, -10.0]
    frame = lambda p: spark.createDataFrame([("w", k, float(v[0]), float(v[1])) for k, v in enumerate(p)], "well string, cell int, i double, j double")
    r = registration.align_regionally(frame(x), frame(y), ["well"], 250.0, least=60).collect()
    assert len(r) == 1 and r[0].score > 0.5 and r[0].attempts >= 1 and np.allclose(r[0].rotation, turn, atol=1e-3)
    far = registration.align_regionally(frame(x), frame(rng.random((50, 2))), ["well"], 250.0)
    assert far.count() == 0 and far.columns == ["well", "rotation", "translation", "score", "determinant", "region", "attempts"]


def test_tested_screen(spark):
    """The whole plan, with bootstrap and clusters, on the small tables."""
    import dataclasses

    from wellspring.plans import screen

    c = screen.ScreenConfig(features=("price", "size"), simulations=20)
    out = screen.tested_genes(screen.example(spark, "/root/testdata/sf0.001"), dataclasses.replace(c))
    rows = out.collect()
    assert {r.gene_symbol_0 for r in rows} == {"nontargeting", "gene_C0", "gene_C1", "gene_G0", "gene_G1"} and all(0 <= r.price_pval <= 1 for r in rows)


def test_objects_of_masks(spark):
    from wellspring.operators import images, objects

    a, b = np.zeros((6, 6), int), np.zeros((6, 6), int)
    a[1:3, 1:5], b[0:2, 0:2], b[4:6, 4:6] = 1, 1, 2
    image = np.arange(72.0).reshape(2, 6, 6)
    rows = [(f"P-1_T-{t}.npy", images.encode(m), images.encode(image)) for t, m in enumerate((a, b))]
    px = objects.pixels(spark.createDataFrame(rows, "path string, content binary, image binary"), ["c0", "c1"])
    f = {(r.path[6:7], r.label): r for r in objects.feature_table(px, ["path"], objects.channel_features(["c0", "c1"])).collect()}
    assert f["0", 1].area == 8 and f["0", 1].bounds == [1, 1, 3, 5] and f["0", 1].c0_mean == image[0][a == 1].mean() and f["0", 1].c0_c1_correlation == pytest.approx(1.0)
    tiles = px.withColumns({"tile": F.substring("path", 7, 1).cast("int"), "well": F.lit("w")})
    shifts = spark.createDataFrame([("w", 0, 0, 0), ("w", 1, 2, 3)], "well string, tile int, shift_i int, shift_j int")
    canvas = np.zeros((8, 9), int)
    canvas[0:6, 0:6][a > 0] = 1
    later = canvas[2:8, 3:9]
    later[b > 0] = b[b > 0] + 1
    got = {r.stitched_cell_id: (r.tile, r.cell, r.area, r.i, r.j) for r in objects.stitched_cells(tiles, shifts, ["well"]).collect()}
    want = {k: (int(k > 1), 1 if k < 3 else 2, int((canvas == k).sum()), *np.argwhere(canvas == k).mean(0)) for k in (1, 2, 3)}
    assert got == want
    assert objects.stitched_cells(tiles.where("label > 9"), shifts, ["well"]).count() == 0
    assert (images.correct_illumination(np.full((2, 3, 3), 10.0), np.full((3, 3), 4.0), project=True) == 2).all()


def test_positions_by_normal_equations():
    """As by least squares over all edges, also with shifts that disagree, edges that repeat, and tiles apart from the first."""
    rng = np.random.default_rng(3)
    for edges in ([(0, 1), (1, 2), (0, 2), (2, 3), (0, 1)], [(0, 1), (2, 3)]):
        e = pd.DataFrame([(a, b, *rng.normal(size=2)) for a, b in edges], columns=["a", "b", "di", "dj"])
        m = np.zeros((len(e) + 1, 4))
        for r, (a, b) in enumerate(edges):
            m[r, b], m[r, a] = 1, -1
        m[-1, 0] = 1
        want = np.linalg.lstsq(m, np.vstack([e[["di", "dj"]].to_numpy(), [[0, 0]]]), rcond=None)[0]
        assert np.allclose(registration.solve_positions(e, [0, 1, 2, 3])[["i", "j"]], want)


def test_a_large_well_is_solved_without_a_matrix_of_edges(monkeypatch):
    tiles = list(range(600))
    e = pd.DataFrame([(t, t + 1, 2.0, -1.0) for t in tiles[:-1]] * 5, columns=["a", "b", "di", "dj"])
    monkeypatch.setattr(np.linalg, "lstsq", None)
    assert np.allclose(registration.solve_positions(e, tiles)["i"], 2.0 * np.arange(600))


def test_a_shared_null_is_not_copied_for_every_key(spark):
    nulls = spark.createDataFrame([(k, [float(k)]) for k in range(10)], "sim int, x array<double>")
    seen = spark.createDataFrame([("a", 1.5), ("b", 7.0), ("c", 20.0)], "g string, x double")
    one = {r.g: (r.num_sims, round(r.x_pval, 9)) for r in bootstrap.p_values(nulls, seen, ["x"], "g").collect()}
    each = {r.g: (r.num_sims, round(r.x_pval, 9)) for r in bootstrap.p_values(seen.select("g").crossJoin(nulls), seen, ["x"], "g").collect()}
    assert one == each == {"a": (10, 0.4), "b": (10, 0.4), "c": (10, 0.0)}


def test_imputation_searches_all_rows(spark, monkeypatch):
    """More rows than a block, and the nearest of each among the last by any hash; equal distances go by the key."""
    monkeypatch.setattr(filters, "KNN_BLOCK", 700)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(11_000, 3)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    few = x.copy()
    few[300:] = np.where(np.isnan(few[300:]), 0.5, few[300:])
    df = spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(few)], "i int, a double, b double, c double")
    got = filters.impute_knn(df, ["a", "b", "c"], ["i"]).toPandas().sort_values("i")[["a", "b", "c"]].to_numpy()
    assert np.allclose(got, filters.fill_from_neighbours(few, few, 5), atol=1e-12)


def test_simulations_come_to_blocks_of_controls(spark, monkeypatch):
    """Many blocks, one construct larger than a block, and no row for a single draw; the gene goes along."""
    rng = np.random.default_rng(8)
    controls = spark.createDataFrame([(0 if i < 150 else i // 10, float(rng.random())) for i in range(400)], "k bigint, x double")
    constructs = spark.createDataFrame([(i, f"g{i % 2}", 4 + i) for i in range(9)], "k bigint, g string, cell_count bigint")
    draw = lambda **o: bootstrap.construct_bootstrap(constructs, controls, ["x"], "k", sims=40, **o)
    one = sorted(draw().collect())
    want = {tuple(r) for r in bootstrap.gene_null(draw(), constructs, "k", "g").select("g", "sim", F.col("x")[0]).collect()}
    monkeypatch.setattr(bootstrap, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(bootstrap, "BLOCK_ROWS", 20)
    far = draw(keep="g", write=False)
    assert sorted(far.select("k", "sim", "x").collect()) == one and len(one) == 360
    assert {tuple(r) for r in bootstrap.gene_null(far, None, "k", "g").select("g", "sim", F.col("x")[0]).collect()} == want and len(want) == 80


def test_sparse_affinities_and_landmarks(monkeypatch):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(size=(120, 4)) + c for c in (0, 8, 16)])
    k = graph.sparse_kernel(x, block=50)
    dense = np.zeros((360, 360))
    dense[graph._rows(k), k[1]] = k[2]
    assert np.allclose(dense, graph.kernel(x)) and len(k[2]) < 360 * 40
    off = dense - np.diag(np.diag(dense))
    assert (graph.leiden(off) == graph.leiden(graph._sparse(*np.nonzero(off), off[np.nonzero(off)], 360))).all()
    monkeypatch.setattr(graph, "LANDMARKS", 60)
    y = graph.landmark_embedding(x, k, block=100)
    middle = [y[a : a + 120].mean(0) for a in (0, 120, 240)]
    nearest = np.array([[((p - c) ** 2).sum() for c in middle] for p in y]).argmin(1)
    assert y.shape == (360, 2) and (nearest == np.repeat([0, 1, 2], 120)).mean() > 0.95


def test_nearest_hashes_and_distances_in_bounded_memory(monkeypatch):
    rng = np.random.default_rng(11)
    a, b = (registration.triangle_hashes(rng.random((n, 2)) * 100) for n in (150, 180))
    va, vb = (np.stack(h["v"].to_numpy()) / h["magnitude"].to_numpy()[:, None] for h in (a, b))
    vb = np.vstack([vb, va[:50] + 0.01])
    vb[:, :2] /= np.sqrt((vb[:, :2] ** 2).sum(1))[:, None]
    monkeypatch.setattr(registration, "DISTANCES", 1000)
    d = np.sqrt(((va[:, None] - vb[None]) ** 2).sum(-1))
    got, distance = registration.nearest_hashes(va, vb, 0.3)
    met = d.min(1) < 0.3
    assert met.sum() >= 50 and ((distance < 0.3) == met).all() and (got[met] == d.argmin(1)[met]).all()
    p, q = rng.random((300, 2)) * [900, 30], rng.random((200, 2)) * [1100, 90] - 40
    want = np.sqrt(((q[:, None] - p[None]) ** 2).sum(-1)).min(1)
    assert np.allclose(registration.nearest_distance(p, q, 20.0), np.where(want < 20, want, np.inf))


def test_coincident_cells_all_meet(spark):
    from wellspring.operators import joins

    a = spark.createDataFrame([("p", "w", 1, c, x, 5.0) for c, x in ((1, 0.0), (2, 0.0), (3, 9.0), (4, 0.0))], "plate string, well string, tile int, cell int, i double, j double")
    al = spark.createDataFrame([("p", "w", 1, 1, [[1.0, 0.0], [0.0, 1.0]], [0.0, 0.0])], "plate string, well string, tile int, site int, rotation array<array<double>>, translation array<double>")
    met = lambda **o: sorted((r.cell_0, r.cell_1) for r in joins.merge_by_alignment(a, a.withColumnRenamed("tile", "site"), al, 2.0, **o).collect())
    assert met() == [(1, 1), (3, 3)] and met(coincident=True) == [(c, c) for c in (1, 2, 3, 4)]


def test_clusters_of_more_genes_than_fit_one_matrix(spark, monkeypatch):
    """Beyond 20,000 rows too, which were an error; the executors' affinities are those of one process."""
    monkeypatch.setattr(graph, "LANDMARKS", 60)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(500, 3))
    x[7:20] = x[7]
    k = graph.sparse_kernel(x)
    off = graph._rows(k) != k[1]
    starts, columns, values = graph.spread_kernel(spark, x, block=64)
    assert (graph._rows((starts, columns, values)) == graph._rows(k)[off]).all() and (columns == k[1][off]).all() and np.allclose(values, k[2][off])
    part = graph._affinities(x, 0, 500, 10, 40.0, chunk=50)
    one = graph._affinities(x, 0, 500, 10, 40.0)
    assert sorted(zip(*(c.tolist() for c in part))) == sorted(zip(*(c.tolist() for c in one)))
    n = 20_100
    df = spark.range(n).select(F.col("id").alias("gene"), *[(F.rand(c) + 9 * (F.col("id") % 3)).alias(f"f{c}") for c in range(2)])
    got = graph.phate_leiden(df, "gene", ["f0", "f1"], resolution=0.01).toPandas()
    assert sorted(got["gene"]) == list(range(n)) and got.groupby("cluster")["gene"].agg(lambda g: (g % 3).nunique()).eq(1).all()
    assert got[["PHATE_0", "PHATE_1"]].notna().all().all()


def test_cells_at_one_place_but_for_rounding_all_meet(spark):
    from wellspring.operators import joins

    rows = [(1, 5.0, 7.0), (2, 5.0, 7.0 + 1e-13), (3, 9.0, 7.0), (4, 5.0 - 1e-12, 7.0), (5, 9.0, 7.0 + 1e-3)]
    frame = lambda shift: spark.createDataFrame([("p", "w", 1, c, x, y + shift * (-1) ** c) for c, x, y in rows], "plate string, well string, tile int, cell int, i double, j double")
    al = spark.createDataFrame([("p", "w", 1, 1, [[1.0, 0.0], [0.0, 1.0]], [0.0, 0.0])], "plate string, well string, tile int, site int, rotation array<array<double>>, translation array<double>")
    met = joins.merge_by_alignment(frame(0), frame(-3e-13).withColumnRenamed("tile", "site"), al, 2.0, coincident=True)
    assert sorted((r.cell_0, r.cell_1) for r in met.collect()) == [(c, c) for c in range(1, 6)]


def test_triangles_of_awkward_points():
    rng = np.random.default_rng(13)
    grid = np.array([(x, y) for x in range(12) for y in range(12)], float)
    for p in (grid, np.vstack([grid, grid[:5], grid[20:60] + 1e-13]), np.column_stack([np.arange(9.0), np.zeros(9)])):
        t, beside = registration.delaunay(p)
        area = lambda t, p: (p[t[:, 1], 0] - p[t[:, 0], 0]) * (p[t[:, 2], 1] - p[t[:, 0], 1]) - (p[t[:, 1], 1] - p[t[:, 0], 1]) * (p[t[:, 2], 0] - p[t[:, 0], 0])
        assert abs(area(t, p).sum() - 2 * np.ptp(p, axis=0).prod()) < 1e-6 and (area(t, p) >= -1e-9).all()
        assert all(n < 0 or k in beside[n] for k, row in enumerate(beside) for n in row)
    # Hashes don't depend on the order of the points.
    p = rng.random((300, 2)) * 100
    key = lambda h: np.round(np.column_stack([h[["c_0", "c_1"]].to_numpy(), np.stack(h["v"].to_numpy())]), 6)
    a, b = (key(registration.triangle_hashes(q)) for q in (p, p[rng.permutation(300)]))
    assert (a[np.lexsort((a[:, 1], a[:, 0]))] == b[np.lexsort((b[:, 1], b[:, 0]))]).all()


def test_models_without_hope_are_left_early_and_copies_are_met_once(monkeypatch):
    rng = np.random.default_rng(14)
    x = rng.random((500, 2)) * 100
    y = np.where(rng.random(500)[:, None] < 0.6, x + [3, -2], rng.random((500, 2)) * 100)
    whole = registration.ransac_affine(x, y)
    monkeypatch.setattr(registration, "RANSAC_ROWS", 20)
    early = registration.ransac_affine(x, y)
    assert all((a == b).all() for a, b in zip(whole, early)) and 250 < early[2].sum() < 350
    points = np.repeat(rng.random((3, 2)), 400, axis=0)
    assert np.allclose(registration.nearest_distance(points, points[::100] + [1e-3, 0], 0.5), 1e-3)


def test_packed_tiles_align_as_hashes_do(spark):
    rng = np.random.default_rng(15)
    x = rng.random((400, 2)) * 500
    turn = np.array([[math.cos(0.03), -math.sin(0.03)], [math.sin(0.03), math.cos(0.03)]])
    frame = lambda p: spark.createDataFrame([("w", t, float(i), float(j)) for t, q in ((0, p), (1, p[:3])) for i, j in q], "well string, tile int, i double, j double")
    pairs = spark.createDataFrame([("w", 0, 0)], "well string, tile int, site int")
    get = lambda packed: registration.align_pairs(*(registration.hash_cells(frame(p), ["well", "tile"], packed) for p in (x, x @ turn.T + [5.0, -9.0])), pairs, ["well"]).collect()
    (a,), (b,) = get(True), get(False)
    assert a == b and a.score > 0.9 and np.allclose(a.translation, [5, -9], atol=0.1)
    assert [r.tile for r in registration.hash_cells(frame(x), ["well", "tile"], True).collect()] == [0]
