"""N-gram join, top-k search and url rules against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose, vocabulary, words
from wellspring.llm import ngram_join, topk, url_filter
from wellspring.llm._common import connected_components


def brute_classes(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = dict.fromkeys(sets, 0)
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in ids}


def corpus():
    vocab = vocabulary(400)
    rng = random.Random(4)
    texts = {i: prose(rng.randint(5, 120), i, vocab) for i in range(60)}
    base = prose(150, 999, vocab).split()
    for i in range(60, 150):  # a group of near copies
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts[i] = " ".join(w)
    chain = prose(1700, 77, vocabulary(3000, 7)).split()
    for k in range(200):  # neighbours are alike, others less and less
        texts[300 + k] = " ".join(chain[8 * k : 8 * k + 100])
    texts |= {200: None, 201: "", 202: " \n\t", 203: "one", 204: "one", 205: "one two three four", 206: "one two  three\nfour", 207: texts[3], 208: prose(20_000, 5, vocab)}
    return texts


@pytest.mark.parametrize(("block", "block_bytes"), [(64, 1 << 20), (8, 1 << 20), (1, 4096)])
def test_join_equals_brute_force(spark, monkeypatch, block, block_bytes):
    """The chain is verified by buckets, the group of near copies as one; with blocks that must be stitched, and blocks by bytes."""
    texts = corpus()
    modes = []
    units = ngram_join._units
    monkeypatch.setattr(ngram_join, "_units", lambda same: modes.append(u := units(same)) or u)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "LARGEST_BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", block_bytes)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.join(documents(spark, texts)).collect()}
    assert got == brute_classes(texts)
    bands = {u.band for r in modes[0].collect() for u in r.units}
    assert -1 in bands and len(bands) > 10


def test_join_of_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "x"), (None, None), (5, "a b c  d e f g"), (5, "quite another text of six words")]
    got = sorted((tuple(r)[:4] for r in ngram_join.join(documents(spark, rows)).collect()), key=str)
    assert got == sorted([(1, 1, 3, 1), (1, 1, 3, 1), (2, 1, 3, 1), (5, 1, 3, 1), (5, 5, 0, 5), (None, None, 0, None), (None, None, 0, None)], key=str)
    assert ngram_join.join(documents(spark, [])).count() == 0


def test_stage_keeps_every_text_that_is_no_copy(spark):
    near = prose(100, 1).split()
    rows = [(1, " ".join(near)), (5, " ".join(near[:99])), (5, prose(50, 2)), (None, prose(50, 3)), (None, prose(50, 4)), (None, prose(50, 4)), (None, None), (None, ""), (7, ""), (7, ""), (8, "one"), (None, "one")]
    docs = documents(spark, rows)
    kept = ngram_join.stage(spark, docs, "")
    want = [rows[0], *rows[2:5], *rows[6:11]]
    assert kept.columns == docs.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    twice = ngram_join.stage(spark, documents(spark, [*rows, *rows]), "").collect()
    assert sorted(((r.doc_id, r.text) for r in twice), key=str) == sorted([*want, *[r for r in rows if not words(r[1])]], key=str)
    assert ngram_join.stage(spark, documents(spark, []), "").count() == 0


def test_recall_on_documents(spark):
    """Whole classes of sf0.001's documents, against all pairs."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = brute_classes({r.doc_id: r.text for r in rows})
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.query(spark, "/root/testdata/sf0.001").collect()}
    linked = [i for i, (_, n) in want.items() if n]
    assert linked and np.mean([got[i] == want[i] for i in linked]) >= 0.99 and all(got[i][1] == 0 for i in want if i not in set(linked))


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows(0.8, 0.9996)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9996 and (bands, rows) == (20, 5)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)]
    root = {i: i for e in edges for i in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert all(got.get(i, i) == root[i] for i in root)
    assert connected_components(df.where("a < 0")).count() == 0


def brute_top(vectors, k=10):
    out = []
    for q, v in vectors.items():
        if q % 100 == 0:
            s = sorted((-sum(int(a) * int(b) for a, b in zip(np.floor(1024 * np.float64(v)), np.floor(1024 * np.float64(w)))), i) for i, w in vectors.items() if i != q)
            out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:k])]
    return sorted(out)


def test_topk_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    vectors = {i: rng.standard_normal(6).astype(np.float32).tolist() for i in range(600)}
    vectors |= {700 + i: vectors[0] for i in range(20)}  # ties
    bad = [(800, None), (900, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (901, [float("nan")] * 6), (902, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, "c") for i, v in [*vectors.items(), *bad, (0, vectors[0])]], "vec_id bigint, embedding array<float>, v string")
    for rows, leaf in ((16_384, 16), (100, 128)):
        monkeypatch.setattr(topk, "SHARD_ROWS", rows)
        monkeypatch.setattr(topk, "LEAF", leaf)
        got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0).collect())
        assert got == brute_top(vectors)


def test_topk_small_cases(spark):
    schema = "vec_id bigint, embedding array<double>"
    is_query = F.col("vec_id") % 100 == 0
    assert topk.top_k(spark.createDataFrame([], schema), is_query).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [1.0, 1.0])], schema)
    assert [tuple(r) for r in topk.top_k(few, is_query).collect()] == [(0, 1, 1, 1024 * 2048)]
    huge = spark.createDataFrame([(0, [1e12]), (1, [2e12]), (2, [-3e12])], schema)
    assert [r.vec_id for r in topk.top_k(huge, is_query).orderBy("rank").collect()] == [1, 2]


def test_tree_prunes():
    rng = np.random.default_rng(1)
    p = np.floor(rng.standard_normal((4000, 2)) * 1000)
    t = topk.Tree(p, np.arange(4000))
    scanned = []
    full = t.bounds
    t.bounds = lambda nodes, q: (scanned.append(len(nodes)), full(nodes, q))[1]
    ids, s = t.search(np.array([1.0, 0.5]), -1, 5)
    assert sorted(s)[::-1] == sorted(p @ [1.0, 0.5])[::-1][:5] and sum(scanned) < len(t.low) / 2


def test_splits_and_boxes_send_on_only_where_it_matters(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 4)) * 50
    x = np.concatenate([c + rng.standard_normal((100, 4)) for c in centres])
    cells = topk.Splits(x[rng.permutation(800)[:300]], 8)
    of = cells.of(x)
    assert cells.cells == 8 and np.bincount(of).min() > 20
    assert topk.Splits(np.ones((50, 3)), 8).cells == 1 and topk.Splits(np.zeros((5, 0)), 4).cells == 1
    placed = spark.createDataFrame([(i, v.tolist(), 4, int(c)) for i, (v, c) in enumerate(zip(x, of))], "vec_id bigint, v array<double>, d int, cell int")
    boxes = topk._boxes(placed)
    assert all((low == x[of == c].min(0)).all() and (high == x[of == c].max(0)).all() for c, low, high in zip(*boxes[4]))
    subs = {(4, c): 1 + c % 2 for c in range(8)}
    best = np.sort(x @ x[0])[-11]  # the tenth score but for its own
    asking = pd.DataFrame({"q_id": [0, 1], "q": [x[0], x[1]], "d": 4, "cell": [of[0], of[1]], "sub": 0, "least": [best, np.nan]})
    sent = pd.concat(topk._send(boxes, subs)(iter([asking])))
    to = set(sent[sent.q_id == 0].cell)
    assert {c for c in range(8) if (x[of == c] @ x[0]).max() >= best and (c, 0) != (of[0], 0)} <= to | {of[0]} and len(to) < 7
    assert len(sent[sent.q_id == 1]) == sum(subs.values()) - 1


URLS = {
    1: "https://a.net/x", 2: "http://b.Example.NET/en/1?q#f", 3: "http://example.net/english", 4: "http://example.com/de/", 5: "http://x.example.com/de", 6: "http://y.org/fr/a#b",
    7: "http://net", 8: "http://nets/", 9: None, 10: "no scheme", 11: "ftp://org?x/fr/", 12: "http://ÄB.org/fr/é", 13: "http://a.net/x", 14: "x://y://net/", 15: "http://.net/", 16: "http://net.:80/\n/a",
}


def brute_url(u):
    head, sep, rest = (u or "").partition("://")
    if not sep:
        return "", "", None, "allow"
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((max(fits)[1], max(fits)[2]) if fits else (None, "allow")))


def test_urls_equal_brute_force(spark):
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in [*URLS.items(), (1, URLS[1])]], "page_id bigint, url string, host string, n int")
    got = sorted((tuple(r) for r in url_filter.filter_urls(df, url_filter.rule_table(spark, url_filter.RULES)).collect()), key=str)
    assert got == sorted(((i, *brute_url(u)) for i, u in [*URLS.items(), (1, URLS[1])]), key=str)


@pytest.mark.parametrize("rules", [[], [("block", "org", "/f"), ("allow", "org", "/f"), ("block", None, "/")]])
def test_url_rule_tables(spark, rules):
    df = spark.createDataFrame(list(URLS.items()), "page_id bigint, url string")
    table = spark.createDataFrame(rules, "verdict string, host string, path string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(df, table, default="review").collect()}
    assert got[1] == "review" and got[6] == ("allow" if rules else "review")
    assert url_filter.filter_urls(df.where("page_id < 0"), table).count() == 0
