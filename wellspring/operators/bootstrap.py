"""Bootstrap tests of constructs and genes against resampled controls.

A simulation draws one control cell, takes its control construct, and resamples that construct's cells with
replacement; the null is the per-feature median. Draws are seeded by (construct, simulation), so lost tasks repeat them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.functions.stats import benjamini_hochberg, cumulative, fold_p
from wellspring.session import materialize, ship

#: Control values up to so many bytes are sent to every executor; more are dealt in blocks, which simulations come to.
BROADCAST_BYTES = 64 << 20
#: Control rows and simulations that meet in a task, about; draws that are held at once; null rows that are packed together.
BLOCK_ROWS, BLOCK_PAIRS, DRAWS_AT_ONCE, PACKED_ROWS = 1 << 17, 500_000, 1 << 20, 1 << 18


def _seed(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("|".join(map(str, parts)).encode(), digest_size=8).digest(), "little")


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64: independent 64-bit numbers from different ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _share(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)) * 2.0**-53


def _seeds(constructs: np.ndarray, seed: int) -> np.ndarray:
    names = constructs.astype(np.int64) if constructs.dtype.kind in "iu" else np.array([str(c) for c in constructs], object)
    return _mix(pd.util.hash_array(names, categorize=False) + np.uint64(_seed(seed)))


def simulations(seeds: np.ndarray, sims: np.ndarray) -> np.ndarray:
    """A number for each simulation of a construct, from which all its draws follow."""
    return _mix(seeds + (sims.astype(np.uint64) + np.uint64(1)) * _STEP)


def drawn_groups(numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The control construct of each simulation: that of a control cell drawn from all."""
    return np.searchsorted(starts, (_share(numbers) * starts[-1]).astype(np.int64), "right") - 1


def simulate(values: np.ndarray, numbers: np.ndarray, low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """simulations x features medians of so many rows each, drawn with replacement from values[low:high]."""
    out = np.empty((len(numbers), values.shape[1]))
    columns = np.ascontiguousarray(values.T)
    for size in np.unique(sizes):
        same = np.flatnonzero(sizes == size)
        step = max(1, DRAWS_AT_ONCE // int(size))
        for first in range(0, len(same), step):
            at = same[first : first + step]
            share = _share(_mix(numbers[at, None] + np.arange(1, size + 1, dtype=np.uint64) * _STEP))
            place = low[at, None] + (share * (high - low)[at, None]).astype(np.int64)
            for f, column in enumerate(columns):
                out[at, f] = np.median(column[place], axis=1, overwrite_input=True)
    return out


def construct_bootstrap(constructs: DataFrame, controls: DataFrame, features: list[str], construct: str, size: str = "cell_count", sims: int = 1000, seed: int = 42, keep: str | None = None, write: bool = True) -> DataFrame:
    """construct, sim, x: the null medians of every construct (x in the order of features), one row for each simulation.

    Every control row without missing features takes part. Rows are numbered in the order of construct and features, so
    that the draws are the same whether the values are broadcast or dealt: a simulation needs the rows of one control
    construct only, so it goes, as a name and a number, to the block that has them. keep: a column of constructs (their gene)
    that goes along. write: the nulls are drawn once and written, as several steps may read them.
    """
    spark = constructs.sparkSession
    ship(spark)
    kind = dict(constructs.dtypes)[construct]
    carried = [construct, *([keep] if keep else [])]
    fields = ", ".join(f"`{c}` {dict(constructs.dtypes)[c]}" for c in carried)
    rows = controls.select(construct, *[F.col(f).cast("double").alias(f) for f in features]).na.drop()
    counts = rows.groupBy(construct).agg(F.count("*").alias("n")).toPandas().sort_values(construct, kind="stable")  # a number for each control construct
    starts = np.concatenate([[0], np.cumsum(counts["n"].to_numpy(np.int64))])
    # Constructs are few rows but much work: they are dealt to all cores, a number that isn't coalesced again.
    dealt = constructs.where(F.col(size) > 0).select(*carried, F.col(size).cast("bigint").alias(size)).repartition(spark.sparkContext.defaultParallelism * 2)
    out = f"{fields}, sim int, x array<double>"
    if not len(counts):
        return spark.createDataFrame([], out)

    def result(names: list, sim: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1)))
        return pa.RecordBatch.from_arrays([*names, pa.array(sim, pa.int32()), lists], names=[*carried, "sim", "x"])

    done = (lambda d: materialize(d, "nulls")) if write else (lambda d: d)
    if starts[-1] * len(features) * 8 <= BROADCAST_BYTES:
        pdf = rows.toPandas().sort_values([construct, *features], kind="stable")
        shared = spark.sparkContext.broadcast((pdf[features].to_numpy(float), starts))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values, groups = shared.value
            for b in batches:
                for first in range(0, len(b), max(1, BLOCK_PAIRS // sims)):
                    part = b.slice(first, max(1, BLOCK_PAIRS // sims))
                    who, sim = np.repeat(np.arange(len(part)), sims), np.tile(np.arange(sims), len(part))
                    numbers = simulations(_seeds(part.column(construct).to_numpy(zero_copy_only=False), seed)[who], sim)
                    g = drawn_groups(numbers, groups)
                    nulls = simulate(values, numbers, groups[g], groups[g + 1], part.column(size).to_numpy(zero_copy_only=False)[who])
                    yield result([part.column(c).take(pa.array(who)) for c in carried], sim, nulls)

        return done(dealt.mapInArrow(run, out))

    # Blocks of whole control constructs; the simulations of one that has more rows than a block go to several copies of it.
    total = max(1, constructs.count()) * sims
    step = int(max(1, min(BLOCK_ROWS, starts[-1] * BLOCK_PAIRS // total)))
    block_of = starts[:-1] // step
    copies = np.maximum(1, np.bincount(block_of, counts["n"].to_numpy(float)).astype(np.int64) // (2 * step))
    shared = spark.sparkContext.broadcast((starts, block_of, copies))
    blocks = int(len(np.unique(block_of)))
    tasks = max(spark.sparkContext.defaultParallelism * 2, min(blocks, 1024))
    place = pd.DataFrame({"k_": counts[construct].to_numpy(), "b_": block_of, "n_": copies[block_of]})
    place = materialize(spark.createDataFrame(pa.Table.from_pandas(place, preserve_index=False)).select(F.col("k_").cast(kind).alias("k_"), "b_", "n_"), "blocks")
    values = rows.join(place.hint("merge"), F.col(construct) == F.col("k_")).select(F.col("b_"), F.explode(F.sequence(F.lit(0), (F.col("n_") - 1).cast("int"))).alias("p_"), construct, *features)
    packed = ", ".join([*[f"`{c}` array<{dict(constructs.dtypes)[c]}>" for c in carried], "size array<bigint>, sim array<int>"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, block_of, copies = shared.value
        for b in batches:
            for first in range(0, len(b), max(1, BLOCK_PAIRS // sims)):
                part = b.slice(first, max(1, BLOCK_PAIRS // sims))
                who, sim = np.repeat(np.arange(len(part)), sims), np.tile(np.arange(sims), len(part))
                numbers = simulations(_seeds(part.column(construct).to_numpy(zero_copy_only=False), seed)[who], sim)
                block = block_of[drawn_groups(numbers, starts)]
                copy = (_mix(numbers + np.uint64(1)) % copies[block].astype(np.uint64)).astype(np.int64)
                order = np.lexsort((copy, block))
                block, copy, who, sim = block[order], copy[order], who[order], sim[order]
                cut = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (copy[1:] != copy[:-1])))
                ends = pa.array(np.append(cut, len(who)), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, part.column(c).take(pa.array(who))) for c in [*carried, size]] + [pa.ListArray.from_arrays(ends, pa.array(sim, pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.array(block[cut]), pa.array(copy[cut], pa.int32()), *lists], names=["b_", "p_", *carried, "size", "sim"])

    def meet(pairs: pa.Table, mine: pa.Table) -> pa.Table:
        starts, block_of, _ = shared.value
        flat = {c: pa.concat_arrays([x.flatten() for x in pairs.column(c).chunks]) for c in [*carried, "size", "sim"]} if len(pairs) else None
        if flat is None:
            return pa.table(result([pa.array([], mine.schema.field(construct).type)] * len(carried), np.zeros(0, int), np.zeros((0, 1)))).slice(0, 0)
        block = mine.select([construct, *features]).to_pandas().sort_values([construct, *features], kind="stable")[features].to_numpy(float)
        names = flat[construct].to_numpy(zero_copy_only=False)
        sim = flat["sim"].to_numpy(zero_copy_only=False)
        numbers = simulations(_seeds(names, seed), sim)
        g = drawn_groups(numbers, starts)
        base = starts[np.searchsorted(block_of, mine.column("b_")[0].as_py())]
        nulls = simulate(block, numbers, starts[g] - base, starts[g + 1] - base, flat["size"].to_numpy(zero_copy_only=False))
        return pa.Table.from_batches([result([flat[c] for c in carried], sim, nulls)])

    pairs = dealt.mapInArrow(deal, f"b_ bigint, p_ int, {packed}").repartition(tasks, "b_", "p_")
    return done(pairs.groupBy("b_", "p_").cogroup(values.repartition(tasks, "b_", "p_").groupBy("b_", "p_")).applyInArrow(meet, out))


def gene_null(nulls: DataFrame, members: DataFrame | None, construct: str, gene: str) -> DataFrame:
    """Gene nulls: the element-wise median over the gene's constructs, simulation by simulation. Nulls that have the gene's
    column need no members. Values are packed by gene and simulation before they are sent to where their median is taken."""
    ship(nulls.sparkSession)
    long = nulls if gene in nulls.columns else nulls.join(members.select(construct, gene).distinct(), construct)
    long = long.where(F.col("x").isNotNull()).select(gene, "sim", "x")
    types = dict(long.dtypes)
    fields = f"`{gene}` {types[gene]}, sim {types['sim']}"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= PACKED_ROWS:
                yield packed(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield packed(pa.Table.from_batches(held))

    def packed(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        codes = [pc.dictionary_encode(t.column(c), null_encoding="encode").combine_chunks() for c in (gene, "sim")]
        codes = [(c.chunk(0) if isinstance(c, pa.ChunkedArray) else c).indices.to_numpy() for c in codes]
        order = np.lexsort(codes[::-1])
        a, b = (c[order] for c in codes)
        cut = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        x = t.column("x").take(pa.array(order)).combine_chunks()
        x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
        offsets = np.append(0, np.cumsum(pc.list_value_length(x).to_numpy()))
        lists = pa.ListArray.from_arrays(pa.array(offsets[np.append(cut, len(order))], pa.int32()), x.flatten())
        first = t.select([gene, "sim"]).take(pa.array(order[cut])).combine_chunks()
        return pa.RecordBatch.from_arrays([*[c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in first.columns], lists, pa.array((offsets[cut + 1] - offsets[cut]), pa.int32())], names=[gene, "sim", "x", "width"])

    def median(t: pa.Table) -> pa.Table:
        x = pa.concat_arrays([c.flatten() for c in t.column("x").chunks]).to_numpy(zero_copy_only=False).astype(float).reshape(-1, t.column("width")[0].as_py())
        some = ~np.isnan(x).all(0)
        middle = np.full(x.shape[1], np.nan)
        middle[some] = np.nanmedian(x[:, some], axis=0) if np.isnan(x).any() else np.median(x, axis=0)
        return pa.table({gene: t.column(gene).slice(0, 1), "sim": t.column("sim").slice(0, 1), "x": pa.array([[None if np.isnan(v) else float(v) for v in middle]], pa.list_(pa.float64()))})

    each = long.mapInArrow(pack, f"{fields}, x array<double>, width int")
    return each.groupBy(gene, "sim").applyInArrow(median, f"{fields}, x array<double>")


def p_values(nulls: DataFrame, observed: DataFrame, features: list[str], key: str) -> DataFrame:
    """key, num_sims and {feature}_pval: the share of the null over the observed value, folded and doubled; degenerate nulls have none.

    Nulls without the key's column are shared by all keys: observed values, a row for each key, are sent to them.
    """
    seen = observed.select(F.col(key).alias("key_"), *[F.col(f).cast("double").alias(f"o_{f}") for f in features])
    x = nulls.join(seen, nulls[key] == seen["key_"]) if key in nulls.columns else nulls.crossJoin(F.broadcast(seen)).withColumn(key, F.col("key_"))
    each = [F.when(F.min(F.col("x")[i]) < F.max(F.col("x")[i]), fold_p(F.avg((F.col("x")[i] > F.col(f"o_{f}")).cast("double")))).alias(f"{f}_pval") for i, f in enumerate(features)]
    return x.groupBy(key).agg(F.count("*").alias("num_sims"), *each)


def correct_pooled(p: DataFrame, features: list[str], key: str, by: list[str] | None = None) -> DataFrame:
    """p with {feature}_log10 and {feature}_fdr: one BH over all rows and features; p of 0 becomes 1 / the most simulations.

    by: BH within groups instead.
    """
    cols = [f"{f}_pval" for f in features]
    p = materialize(p, "pvalues")
    floor = p.agg(F.max("num_sims")).first()[0] or 1
    low = p.withColumns({c: F.when(F.col(c) == 0, F.lit(1.0 / floor)).otherwise(F.col(c)) for c in cols})
    long = low.select(key, *(by or []), *cols).unpivot([key, *(by or [])], cols, "feature", "p")
    long = benjamini_hochberg(long, "p", "fdr", by=by, order=[key, "feature"])
    wide = long.groupBy(key).agg(*[F.max(F.when(F.col("feature") == f"{f}_pval", F.col("fdr"))).alias(f"{f}_fdr") for f in features])
    return low.withColumns({f"{f}_log10": -F.log10(f"{f}_pval") for f in features}).join(wide, key)


def pseudogenes(constructs: DataFrame, patterns: dict[str, int], perturbation: str, construct: str, seed: int = 42) -> DataFrame:
    """Constructs whose perturbation matches a pattern, dealt in a hashed order to pseudo-genes of so many constructs each."""
    out = None
    for pattern, size in patterns.items():
        mine = constructs.where(F.col(perturbation).rlike(f"^(?:{pattern})"))
        order = {"o_": F.struct(F.xxhash64(construct, F.lit(seed)).alias("h"), F.col(construct).alias("k")), "one_": F.lit(1)}
        mine = cumulative(mine.withColumns(order), "o_", "one_", "k_")
        mine = mine.withColumn("pseudogene", F.concat(F.lit(f"pseudo_{pattern}_"), F.ceil(F.col("k_") / size).cast("string"))).drop("o_", "one_", "k_")
        out = mine if out is None else out.unionByName(mine)
    return out


def perturbation_scores(df: DataFrame, features: list[str], perturbation: str, control: Column, keys: list[str], top: int = 200, least: int = 100, folds: int | None = None, most: int = 20_000, seed: int = 42) -> DataFrame:
    """keys, perturbation, perturbation_score (out-of-fold probability against as many controls) and perturbation_auc.

    Of each gene at most `most` cells, by hash, train its models, with as many controls. Every further cell is scored
    by the mean of the gene's models, none of which saw it, as are further controls, up to as many as the gene has
    cells; the AUC is over all of them. folds: else 5, and 10 from 2 * least rows on. Genes with too few rows have no score.
    """
    spark = df.sparkSession
    ship(spark)
    base = materialize(df.select(*keys, perturbation, control.alias("c_"), *[F.col(f).cast("double").alias(f) for f in features], F.xxhash64(*keys, F.lit(seed)).alias("h_"), F.monotonically_increasing_id().alias("id_")), "scores")
    order = ["h_", *keys, "id_"]
    genes = base.where(f"NOT c_ AND `{perturbation}` IS NOT NULL")
    ranked = genes.withColumn("k_", F.row_number().over(Window.partitionBy(perturbation).orderBy(*order))).where(F.col("k_") <= most)
    sizes = genes.groupBy(perturbation).agg(F.count("*").alias("n_"))
    limit = min(sizes.agg(F.max("n_")).first()[0] or 0, most)
    pool = base.where("c_").orderBy(*order).limit(int(limit)).select("id_", *features).toPandas()
    shared = spark.sparkContext.broadcast(pool[features].to_numpy(float))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng(_seed(seed, key[0]))
        pdf = pdf.sort_values(order, kind="stable")
        x1, pool = np.nan_to_num(pdf[features].to_numpy(float)), np.nan_to_num(shared.value)
        x0 = pool[rng.permutation(len(pool))[: len(x1)]] if len(pool) else pool
        out = pdf[[*keys, perturbation]].copy()
        out["perturbation_score"], out["perturbation_auc"], out["fits_"], out["controls_"] = np.nan, np.nan, None, None
        k = folds or (5 if len(x1) + len(x0) < 2 * least else 10)
        if len(x1) + len(x0) >= least and len(x0) >= k and len(x1) >= k:
            p, y = out_of_fold(np.vstack([x1, x0]), np.append(np.ones(len(x1)), np.zeros(len(x0))), top, k, rng, fits := [])
            out["perturbation_score"], out["perturbation_auc"] = p[: len(x1)], auc(p, y)
            if len(x1) == most:
                out["fits_"] = [np.concatenate(fits), *[None] * (len(x1) - 1)]
                out["controls_"] = [p[len(x1) :], *[None] * (len(x1) - 1)]
        return out

    types = dict(base.dtypes)
    names = [*keys, perturbation, "perturbation_score", "perturbation_auc"]
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in [*keys, perturbation]], "perturbation_score double, perturbation_auc double, fits_ array<double>, controls_ array<double>"])
    scored = ranked.groupBy(perturbation).applyInPandas(run, schema)
    large = {r[0]: r[1] for r in sizes.where(F.col("n_") > most).collect()}  # at most one for each `most` rows
    if not large:
        return scored.select(*names)
    scored = materialize(scored, "scored")
    models = spark.sparkContext.broadcast({r[0]: np.array(r[1]).reshape(-1, len(features) + 1) for r in scored.where("fits_ IS NOT NULL").select(perturbation, "fits_").collect() if r[0] in large})
    cells = scored.select(*keys, perturbation, "perturbation_score").withColumn("y_", F.lit(1))

    # What did not train: a gene's cells after its last that did, and controls outside the pool.
    place = F.struct(*order)
    last = materialize(ranked.where(F.col("k_") == most).select(F.col(perturbation).alias("g_"), place.alias("last_")), "last")
    rest = genes.join(F.broadcast(last), F.col(perturbation) == F.col("g_")).where(place > F.col("last_")).withColumn("y_", F.lit(1))
    n_controls = base.where("c_").count()
    if n_controls > len(pool):
        end = materialize(base.where("c_").join(F.broadcast(spark.createDataFrame([(int(i),) for i in pool["id_"]], "id_ long")), "id_").select(F.max(place).alias("last_")), "last")
        share = {g: (min(n, n_controls) - len(pool)) / (n_controls - len(pool)) for g, n in large.items()}
        wanted = spark.createDataFrame(list(share.items()), f"g_ {types[perturbation]}, share_ double")
        more = base.where("c_").crossJoin(F.broadcast(end)).where(place > F.col("last_")).crossJoin(F.broadcast(wanted))
        more = more.where(F.pmod(F.xxhash64("id_", "g_", F.lit(seed)), F.lit(1_000_000)) < F.col("share_") * 1_000_000).withColumn(perturbation, F.col("g_")).withColumn("y_", F.lit(0))
        rest = rest.select(*keys, perturbation, *features, "y_").unionByName(more.select(*keys, perturbation, *features, "y_"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = np.full(len(b), np.nan)
            x = np.nan_to_num(b[features].to_numpy(float))
            for gene, at in b.groupby(perturbation).indices.items():
                if (w := models.value.get(gene)) is not None:
                    p[at] = (1 / (1 + np.exp(-np.clip(x[at] @ w[:, :-1].T + w[:, -1], -50, 50)))).mean(1)
            out = b[[*keys, perturbation]].copy()
            out["perturbation_score"], out["y_"] = p, b["y_"]
            yield out

    asked = rest.select(*keys, perturbation, *features, "y_").mapInPandas(ask, ", ".join([*[f"`{c}` {types[c]}" for c in [*keys, perturbation]], "perturbation_score double, y_ int"]))
    asked = materialize(asked, "asked")
    cells = cells.unionByName(asked.where("y_ = 1"))
    seen = scored.where("controls_ IS NOT NULL").select(perturbation, F.explode("controls_").alias("perturbation_score")).withColumn("y_", F.lit(0))
    judged = cells.select(perturbation, "perturbation_score", "y_").unionByName(asked.where("y_ = 0").select(perturbation, "perturbation_score", "y_")).unionByName(seen)
    of_large = F.broadcast(last.select(F.col("g_").alias(perturbation)))
    exact = pooled_auc(judged.where("perturbation_score IS NOT NULL").join(of_large, perturbation, "left_semi"), perturbation, "perturbation_score", "y_")
    others = scored.join(of_large, perturbation, "left_anti")
    return others.select(*names).unionByName(cells.join(of_large, perturbation, "left_semi").join(F.broadcast(exact), perturbation, "left").select(*names))


def pooled_auc(df: DataFrame, by: str, score: str, y: str, buckets: int = 4096) -> DataFrame:
    """by and perturbation_auc: auc() of each group, whatever its size; scores in [0, 1] are ranked bucket by bucket."""
    each = df.groupBy(by, score).agg(F.sum(F.when(F.col(y) == 0, 1).otherwise(0)).alias("n0"), F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("n1"))
    each = materialize(each.withColumn("b", F.floor(F.col(score) * buckets)), "ranks")
    before = lambda *g: Window.partitionBy(*g[:-1]).orderBy(g[-1]).rowsBetween(Window.unboundedPreceding, -1)
    lower = each.groupBy(by, "b").agg(F.sum("n0").alias("m0")).withColumn("lower", F.coalesce(F.sum("m0").over(before(by, "b")), F.lit(0)))
    within = each.withColumn("under", F.coalesce(F.sum("n0").over(before(by, "b", score)), F.lit(0)))
    total = within.join(lower.drop("m0"), [by, "b"]).groupBy(by).agg(F.sum(F.col("n1") * (F.col("lower") + F.col("under") + F.col("n0") / 2)).alias("won"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return total.select(by, F.try_divide(F.col("won"), F.col("n0").cast("double") * F.col("n1")).alias("perturbation_auc"))


def auc(p: np.ndarray, y: np.ndarray) -> float:
    """Area under the ROC curve by average ranks."""
    order = np.argsort(p, kind="stable")
    _, first, count = np.unique(p[order], return_index=True, return_counts=True)
    rank = np.empty(len(p))
    rank[order] = np.repeat(first + (count + 1) / 2, count)
    n1 = y.sum()
    return float((rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights and intercept of balanced, ridge-penalised logistic regression by Newton's method."""
    d = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    penalty = ridge * np.eye(d.shape[1])
    penalty[-1, -1] = 1e-9
    w = np.zeros(d.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -50, 50)))
        step = np.linalg.solve((d * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ d + penalty, d.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def out_of_fold(x: np.ndarray, y: np.ndarray, top: int, folds: int, rng: np.random.Generator, fits: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities from models that did not see the row; the features with the largest ANOVA F are chosen in each fold.

    fits: gets each fold's weights of the features as they are, and its intercept.
    """
    fold = np.empty(len(y), int)
    for k in (0, 1):
        at = rng.permutation(np.flatnonzero(y == k))
        fold[at] = np.arange(len(at)) % folds
    p = np.empty(len(y))
    for f in range(folds):
        fit, ask = fold != f, fold == f
        m, s = x[fit].mean(0), x[fit].std(0)
        z = (x - m) / np.where(s == 0, 1, s)
        a, b = z[fit & (y == 1)], z[fit & (y == 0)]
        within = ((a - a.mean(0)) ** 2).sum(0) + ((b - b.mean(0)) ** 2).sum(0)
        between = len(a) * a.mean(0) ** 2 + len(b) * b.mean(0) ** 2
        use = np.argsort(-between / np.maximum(within, 1e-12), kind="stable")[:top]
        w = logistic(z[fit][:, use], y[fit])
        p[ask] = 1 / (1 + np.exp(-np.clip(z[ask][:, use] @ w[:-1] + w[-1], -50, 50)))
        if fits is not None:
            plain = np.zeros(x.shape[1] + 1)
            plain[use] = w[:-1] / np.where(s == 0, 1, s)[use]
            plain[-1] = w[-1] - plain[:-1] @ m
            fits.append(plain)
    return p, y
