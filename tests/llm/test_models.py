"""Trained operators: held-out accuracy, gradients, awkward inputs; and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose, vocabulary
from wellspring.llm import language, quality_model, toxicity

SF = "/root/testdata/sf0.01"


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = language.train(rng.integers(0, 256, (8, 5)).astype(np.uint8), np.ones((8, 5), np.float32), rng.integers(0, 3, 8), ["a", "b", "c"], steps=1)
    for p in net.parameters():
        p[...] = p.astype(np.float32)
    x, y = rng.integers(0, 256, (5, 4)).astype(np.uint8), rng.integers(0, 3, 4)
    weight = np.ones((5, 4), np.float32)
    weight[4, 1] = 0

    def loss():
        z = net.logits(x).transpose(0, 2, 1).astype(np.float64)
        z -= z.max(-1, keepdims=True)
        logp = z - np.log(np.exp(z).sum(-1, keepdims=True))
        return -(logp[:, np.arange(4), y] * weight).sum() / weight.sum()

    for p, g in zip(net.parameters(), language._gradients(net, x, y, weight)):
        for at in random.Random(1).sample(list(np.ndindex(p.shape)), min(6, p.size)):
            old = p[at]
            p[at] = old + 1e-2
            up = loss()
            p[at] = old - 1e-2
            down = loss()
            p[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-2, abs=2e-3)


def test_batches_do_not_change_probabilities():
    rng = np.random.default_rng(1)
    net = language.train(rng.integers(0, 256, (64, language.WINDOW)).astype(np.uint8), np.ones((64, language.WINDOW), np.float32), rng.integers(0, 2, 64), ["a", "b"], steps=2)
    texts = ["x", "longer text " * 40, "", "é" * 100]
    together = language.probabilities(net, texts)
    assert np.allclose(together, np.concatenate([language.probabilities(net, [t]) for t in texts]), atol=1e-5)
    assert np.allclose(together.sum(1), [1, 1, 0, 1], atol=1e-5)


def plain_probabilities(net, text):
    """The network byte by byte, in plain loops over each window from both ends."""
    data, hidden = text.encode(), language.HIDDEN
    total, n = np.zeros(len(net.languages)), 0
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    for first in range(0, len(data), language.WINDOW):
        piece = list(data[first : first + language.WINDOW])
        padded = piece + [0] * (language.WINDOW - len(piece))
        logits = np.tile(net.bias.astype(float), (language.WINDOW, 1))
        for way, order in enumerate((range(language.WINDOW), reversed(range(language.WINDOW)))):
            h = np.zeros(hidden)
            for t in order:
                g = net.table[256 * way + padded[t]].astype(float)
                gates = sigmoid(g[: 2 * hidden] + h @ net.gates[way])
                z, r = gates[:hidden], gates[hidden:]
                h = (1 - z) * h + z * np.tanh(g[2 * hidden :] + r * (h @ net.candidate[way]))
                logits[t] += h @ net.out[way]
        e = np.exp(logits - logits.max(1, keepdims=True))
        total += (e / e.sum(1, keepdims=True))[: len(piece)].sum(0)
        n += len(piece)
    return total / max(n, 1)


def test_probabilities_equal_the_plain_network():
    rng = np.random.default_rng(2)
    net = language.train(rng.integers(0, 256, (64, language.WINDOW)).astype(np.uint8), np.ones((64, language.WINDOW), np.float32), rng.integers(0, 3, 64), ["a", "b", "c"], steps=3)
    texts = ["", "a", "short text", "ünïcode " * 9, "x" * language.WINDOW, "longer " * 60 + "漢字"]
    assert np.allclose(language.probabilities(net, texts), [plain_probabilities(net, t) for t in texts], atol=1e-4)


def test_language_sample_is_bounded(spark):
    """A language with most rows gives no more than its share, and one id that all rows have gives one row for each text."""
    docs = documents(spark, [(1 if i % 2 else i, f"some text {i % 50}") for i in range(2000)], {i: "aa" for i in range(2000)})
    rows = []
    fit = language.train
    try:
        language.train = lambda x, *a, **k: rows.append(len(x)) or fit(x, *a, steps=1, **k)
        language.fit(docs, sample=100)
    finally:
        language.train = fit
    assert 0 < rows[0] <= 200 * language.WINDOWS_PER_DOC


def test_language_on_held_out(spark):
    from wellspring.llm import registry

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = registry.queries()["op2_language"](spark, SF).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.96 and all(0 <= r.score <= 1 for r in got)


def test_language_awkward_texts(spark):
    a, b = vocabulary(60, 1), [w.upper() for w in vocabulary(60, 2)]
    texts = {i: prose(30, i, a if i % 2 else b) for i in range(40)} | {50: None, 51: "", 52: "12 !? 34", 53: prose(4000, 9, a), 54: "漢字"}
    docs = documents(spark, [*texts.items(), (1, texts[1])], {i: "aa" if i % 2 else "bb" for i in range(40)})
    net = language.fit(docs)
    rows = language.predict(docs, net).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(texts) + 1 and got[50] == got[51] == got[52] == ("und", 0.0) and got[53][0] == "aa" and got[54][0] in ("aa", "bb")
    assert all(got[i][0] == ("aa" if i % 2 else "bb") for i in range(40))
    assert {r.lang_pred for r in language.predict(docs, language.fit(docs.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}
    assert language.predict(docs.where("doc_id < 0"), net).count() == 0


def test_quality_on_held_out(spark):
    from wellspring.llm import registry

    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = registry.queries()["op8_quality_model"](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_quality_awkward_texts(spark):
    good = {i: prose(60, i) + "." for i in range(60)}
    bad = {100 + i: ("xx! " * (20 + i)) for i in range(40)}
    docs = documents(spark, [*(good | bad).items(), (200, None), (201, ""), (202, "w " * 30_000), (0, good[0])])
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(i, 0, 0) for i in bad] + [(0, 1, 0), (999, 1, 0), (1, None, None)], "doc_id bigint, quality int, toxic int")
    features = quality_model.document_statistics(docs)
    model = quality_model.fit(features, labels)
    rows = quality_model.score_statistics(features, model).collect()
    s = {r.doc_id: r.score for r in rows}
    assert len(rows) == 104 and all(s[i] >= 0.5 for i in good) and all(s[i] < 0.5 for i in bad) and all(np.isfinite(x) for x in s.values())
    kept = quality_model.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(good)
    assert {r.score for r in quality_model.score_statistics(features, quality_model.fit(features, labels.where("quality = 1"))).collect()} == {1.0}
    assert {r.score for r in quality_model.score_statistics(features, quality_model.fit(features, labels.where("doc_id < 0"))).collect()} == {0.5}
    assert quality_model.document_statistics(docs.where("doc_id < 0")).count() == 0


def test_discriminant_equals_plain_densities(spark):
    """Shrunken covariances and Gaussian log-densities, without Cholesky factors or partial sums."""
    texts = {i: prose(20 + i, i) + ("." if i % 3 else " ## !!") for i in range(60)}
    y = {i: int(i % 3 > 0) for i in texts}
    features = quality_model.document_statistics(documents(spark, texts))
    model = quality_model.fit(features, spark.createDataFrame([(i, v, 0) for i, v in y.items()], "doc_id bigint, quality int, toxic int"))
    rows = features.collect()
    x, label = np.array([r.x for r in rows]), np.array([y[r.doc_id] for r in rows])
    parts = [x[label == k] for k in (0, 1)]
    cov = [np.cov(p.T, bias=True) for p in parts]
    scale = np.sqrt(np.maximum(sum(len(p) * np.diag(c) for p, c in zip(parts, cov)) / len(x), 1e-8))
    logs = []
    for p, c in zip(parts, cov):
        shrunk = (1 - quality_model.SHRINKAGE) * c / np.outer(scale, scale) + (quality_model.SHRINKAGE + 1e-9) * np.eye(len(scale))
        d = (x - p.mean(0)) / scale
        logs.append(np.log(len(p) / len(x)) - 0.5 * np.linalg.slogdet(shrunk)[1] - 0.5 * np.einsum("ij,ij->i", d, np.linalg.solve(shrunk, d.T).T))
    want = 1 / (1 + np.exp(-np.clip((logs[1] - logs[0]) / x.shape[1], -500, 500)))
    got = {r.doc_id: r.score for r in quality_model.score_statistics(features, model).collect()}
    assert np.allclose([got[r.doc_id] for r in rows], want, atol=1e-6)


def test_statistics_by_hand():
    import pyarrow as pa

    x = quality_model._features(pa.array(["a a b", None, "AB# !\n1"]))
    names = dict(zip(quality_model.FEATURES, x.T))
    assert names["log_words"] == pytest.approx(np.log1p([3, 0, 3])) and names["top_word"][0] == pytest.approx(np.sqrt(2 / 3))
    assert names["beside_itself"][0] == pytest.approx(np.sqrt(1 / 3)) and names["upper"][2] == pytest.approx(np.sqrt(2 / 5)) and names["wordless"][2] == pytest.approx(np.sqrt(2 / 3))


def test_fold():
    assert toxicity.fold("Stup1d!  М0R0N\u200b, (аss) 2024 ＩＤＩＯＴ c@t $5") == " stupid moron ass 2024 idiot cat 5 "
    assert toxicity.fold(None) == toxicity.fold("") == "  "


def test_lexicon_hits_and_exceptions():
    lex = toxicity.Lexicon({" foo ": 2.0, " bar": 1.0, " barn ": 3.0}, {" not foo "})
    a = lex.automaton()
    hits = lambda t: [w for _, _, w in lex.hits(toxicity.fold(t), a)]
    assert hits("foo foo bars") == [2.0, 2.0, 1.0] and hits("not foo, barn") == [3.0] and hits("xfoo xbar") == [] and hits("") == []


def test_hits_equal_a_plain_matcher():
    rng = random.Random(7)
    words = ["ab", "abc", "abcd", "b", "bc", "x", "abx"]
    for _ in range(200):
        weights = {f" {w}" + rng.choice([" ", ""]): rng.random() for w in rng.sample(words, 4)}
        exceptions = {f" {rng.choice(words)} {rng.choice(words)} " for _ in range(2)} | set(rng.sample(sorted(weights), 1))
        text = toxicity.fold(" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))))
        at = lambda p: [i for i in range(len(text)) if text.startswith(p, i)]  # noqa: E731,B023
        best = {}
        for p, w in weights.items():
            for i in at(p) if p not in exceptions else []:
                if i not in best or best[i][1] < w:
                    best[i] = (i + len(p), w)
        free = [(i, i + len(p)) for p in exceptions for i in at(p)]
        want = [(i, e, w) for i, (e, w) in sorted(best.items()) if not any(a <= i and e <= b + 1 for a, b in free)]
        lex = toxicity.Lexicon(weights, exceptions)
        assert lex.hits(text, lex.automaton()) == want


def test_fold_of_compatible_forms():
    assert toxicity.fold("𝐢𝐝𝐢𝐨𝐭 ıdıot “idiot” ⓘⓓⓘⓞⓣ ＠ﬁne —dash—") == " idiot idiot idiot idiot afine dash "


def test_odds_equal_counts(spark):
    """Weights of the lexicon from counted documents."""
    texts = {i: ("awful " if i < 30 else "") + prose(20, i) for i in range(200)}
    docs = documents(spark, texts)
    lex = toxicity.learn(docs, spark.createDataFrame([(i, 1, int(i < 30)) for i in texts], "doc_id bigint, quality int, toxic int"))
    assert lex.weights[" awful "] == pytest.approx(np.log(30.1 / 30) - np.log(0.5 / 170))


def test_toxicity_learns_words_stems_and_exceptions(spark):
    vocab = vocabulary(200)
    rng = random.Random(2)
    texts, toxic = {}, {}
    for i in range(160):
        toxic[i] = int(i % 4 == 0)
        w = prose(60, i, vocab).split()
        for _ in range(3 if toxic[i] else 0):
            w.insert(rng.randrange(60), rng.choice(["nasty", "vilest", "vilely", "vileness", "viledom"]))
        if i % 4 == 1:
            w.insert(30, "the nasty party")
        texts[i] = " ".join(w)
    texts |= {500: texts[1] + " v1l3zz NАSTY you nasty", 501: None, 502: "", 503: prose(30_000, 3, vocab), 504: "plain words here"}
    docs = documents(spark, [*texts.items(), (0, texts[0])])
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()] + [(3, 1, None)], "doc_id bigint, quality int, toxic int")
    lex = toxicity.learn(docs, labels)
    assert any(p.startswith(" vile") for p in lex.weights)
    rows = toxicity.score(docs, lex).collect()
    s = {r.doc_id: r.score for r in rows}
    assert len(rows) == len(texts) + 1 and all(0 <= x <= 1 for x in s.values())
    assert np.mean([(s[i] >= 0.7) == bool(t) for i, t in toxic.items()]) > 0.97 and s[503] < 0.5 and s[504] < 0.5 and s[500] > s[504]
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, labels.where("toxic = 0"))).collect()} == {0.0}
    assert toxicity.score(docs.where("doc_id < 0"), lex).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "tokens"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    rows = out.collect()
    assert 0 < len({r.doc_id for r in rows}) <= docs.count() and all(r.n_tokens * 4 == len(r.ids) for r in rows)


def test_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline

    empty = documents(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    few = documents(spark, {1: "a small text with some words in it", 2: None, 3: "", 4: "a small text with some words in it"}, {1: "en"})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (empty, few):
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, few, str(tmp_path)).count() == 4
