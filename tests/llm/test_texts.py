"""Tokens, personal data, rules and mixing: exact results on small tables."""

import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose, vocabulary, words
from wellspring.llm import bpe, mixing, pii, quality_rules

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG = "word " * 40_000 + "tail"
ODD = {1: None, 2: "", 3: " \n\t\x1c ", 4: "I'll say: naïve 漢字 🙂 x" * 3, 5: LONG, 6: "a" * 90_000, 7: " " * 70_000 + "b", 8: "don't won't " * 9_000, 9: "same", 10: "same"}


def library():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_tokens_equal_the_library(spark):
    e = library()
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(documents(spark, [*ODD.items(), (9, "same")])).collect()}
    want = set()
    for i, t in ODD.items():
        ids = e.encode_ordinary(t or "")
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    assert bpe.digests(documents(spark, [])).count() == 0


def test_stitching_and_merges():
    e, lib = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN), library()
    rng = random.Random(1)
    for _ in range(150):
        letters = rng.choice(["ab '\ntsl ", "a ", "  \n\t", "aé1'll　!!", "a"])
        t = "".join(rng.choice(letters) * rng.choice([1, 1, 1, 40]) for _ in range(rng.choice([50, 300])))
        size, over = rng.choice([(64, 32), (128, 40), (200, 20)])
        chunks = [(s, t[s : s + size], e.starts(t[s : s + size])) for s in range(0, max(1, len(t) - over), size - over)]
        pieces = [p for part in bpe.stitch(chunks, e) for p in part]
        assert pieces == e.pattern.findall(t) and e.encode(pieces) == lib.encode_ordinary(t)
        for p in set(pieces):
            assert bpe.merge(p.encode(), e.ranks) == e.one(p)


def test_pieces_of_long_texts_and_clashing_names(spark):
    """Small chunks, so that texts have many pieces that are encoded apart; without the compiled core as well."""
    texts = {i: "".join(random.Random(i).choice(["word ", "it's ", "\n\n", "a" * 90, "漢字 ", " " * 70]) for _ in range(400)) for i in range(4)}
    docs = documents(spark, [*texts.items(), (None, texts[0])])
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, chunk=300, overlap=60)
    want = {t: np.array(library().encode_ordinary(t), "<u4").tobytes() for t in texts.values()}
    got = sorted(((r.doc_id, bytes(r.ids)) for r in coded.collect()), key=str)
    assert got == sorted([*((i, want[t]) for i, t in texts.items()), (None, want[texts[0]])], key=str)
    back = bpe.decode(coded.withColumn("decoded", F.lit(1)), RANKS, public_tokenizers.PATTERN)
    assert back.columns == ["doc_id", "ids", "decoded"] and {bytes(r.decoded).decode() for r in back.collect()} == set(texts.values())


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base(t):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("card", m.start(), m.end()) for m in CARD.finditer(t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]


PERSONAL = {
    1: None, 2: "", 3: "é🙂 a.b+c@d-e.org, 10.0.0.255 and 4111 1111 1111 1111 or +1 (249) 555-6835.", 4: "a@b.com_x@c.org a@b..c x@y", 5: "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3.99999999999999999999",
    6: "4111-1111-1111-1112 4111111111111111 4242 4242 4242 4242-4242", 7: "+12 +1-------9 +12345678 +1234567890123456 ++44 20 7946 0958", 8: "x" * 50_000 + "@" + "y.z" * 20_000, 9: "1 " * 30_000, 10: "a@b.c" * 2_000, 11: "@@ 1.1 +", 12: "12" * 40_000,
}


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(3)
    texts = dict(PERSONAL)
    for i in range(20, 220):
        texts[i] = "".join(rng.choice(["4", "1", "0", "25", ".", " ", "-", "@", "a", "b.c", "+", "(", ")", "é", "_", "%", "1.2.3.4", "4111111111111111", "+1 249 555 6835", "u@v.w"]) for _ in range(40))
    rows, _ = pii.find(documents(spark, texts), keep=["doc_id"])
    got = {r.row.doc_id: [(s.kind, s.s, s.e) for s in r.spans] for r in rows.collect()}
    assert got == {i: base(t or "") for i, t in texts.items()}


def test_terms_that_reveal_an_entity(spark):
    vocab = vocabulary(300)
    texts = {i: prose(60, i, vocab) for i in [*range(80), *range(400, 480)]}
    for i in range(0, 24, 3):  # the codename stands beside one person's address, and nowhere else
        texts[i] += f" the Bluebird ann.{1}@corp.example the of {prose(3, 1000 + i, vocab)}"
    texts |= {200: "alone Bluebird, here", 201: texts[0], 202: texts[0]}
    for i in range(30, 60):
        texts[i] += " the of"
    docs = documents(spark, texts)
    rows, terms = pii.find(docs)
    found = {(r.row.doc_id, texts[r.row.doc_id][s.s : s.e]) for r in pii._with_terms(rows, terms).collect() for s in r.all_spans if s.kind == "term"}
    assert {w for _, w in found} == {"Bluebird"} and {i for i, _ in found} == {*range(0, 24, 3), 200, 201, 202}
    clean = {r.doc_id: r for r in pii.sanitize(docs).collect()}
    assert clean[200].text == "alone [NAME], here" and clean[200].n_chars == len(clean[200].text)
    assert "[EMAIL]" in clean[0].text and "Bluebird" not in clean[0].text and clean[1].text == texts[1]
    assert pii.sanitize(docs).columns == docs.columns and pii.sanitize(documents(spark, [])).count() == 0


def brute_terms(texts):
    """Terms with a log-ratio of at least DISCLOSURE times some entity's information, and their spans, by plain loops."""
    strip = lambda w: w.strip(pii.PUNCTUATION)
    has, by, n = {}, {}, len(texts)
    for i, t in texts.items():
        for w in {strip(w).lower() for w in words(t)}:
            has.setdefault(w, set()).add(i)
        for kind, s, e in base(t or ""):
            v = t[s:e]
            digits = re.sub("[^0-9]", "", v)
            group = {"email": v.lower().rpartition("@")[2], "ip": ".".join(v.split(".")[:2]), "card": digits[:6], "phone": digits[:4]}[kind]
            near = words(t[:s].rstrip(" \t\n\x0b\f\r"))[-pii.WINDOW :] + words(t[e:])[: pii.WINDOW]
            for c in ((kind,), (kind, "group", group), (kind, "value", re.sub("[^a-z0-9@.]", "", v.lower()))):
                rows, terms = by.setdefault(c, (set(), {}))
                rows.add(i)
                for w in {strip(w).lower() for w in near}:
                    terms.setdefault(w, set()).add(i)
    out = set()
    for rows, terms in by.values():
        for w, beside in terms.items():
            different = len({texts[i] for i in beside})
            if len(w) < 2 or w not in has or different < 2 or len(rows) == n:
                continue
            p = len(beside) / len(has[w]) * (1 - pii.DISCOUNT / different)
            if np.log2(p * n / len(rows)) >= pii.DISCLOSURE * np.log2(n / len(rows)):
                out.add(w)
    spans = {}
    for i, t in texts.items():
        spans[i] = [(m.start() + len(m[0]) - len(m[0].lstrip(pii.PUNCTUATION)), m.start() + len(m[0].rstrip(pii.PUNCTUATION))) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "") if strip(m[0]).lower() in out]
    return out, spans


@pytest.mark.parametrize("seed", [0, 1])
def test_terms_equal_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    vocab, marks = vocabulary(150, seed), ["Bluebird", "(call", "mail:", "k" * 90, "tel.", "Überall"]
    texts = {1: None, 2: "", 3: "k" * 90 + " alone, Bluebird!"}
    for i in range(10, 160):
        w = prose(rng.randint(1, 60), 1000 * seed + i, vocab).split()
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            k, at = rng.randrange(7), rng.randrange(len(w))
            value = ["ann@corp.example", f"x{i}@corp.example", f"y{i}@mail.example", "10.1.2.3", f"10.1.{i}.9", "4111 1111 1111 1111", "+1 249 555 6835"][k]
            w[at:at] = [marks[k % 6], rng.choice(["", "a" * 200 + " "]) + value + rng.choice(["", ",", "\n", "\t"]), rng.choice(marks[3:])]
        texts[i] = rng.choice([" ", "  ", "\n"]).join(w)
    for k in range(20):  # copies prove nothing
        texts[300 + k] = "lonely secret@only.example word beside"
    want, places = brute_terms(texts)
    assert want & {"bluebird", "call", "mail", "tel", "k" * 90} and "lonely" not in want
    docs = documents(spark, texts)
    for most in (pii.BROADCAST_TERMS, 0):
        monkeypatch.setattr(pii, "BROADCAST_TERMS", most)
        rows, terms = pii.find(docs, keep=["doc_id"])
        spans = {r.row.doc_id: [(x.s, x.e) for x in r.term_spans or []] for r in rows.join(terms, "key", "left").collect()}
        assert spans == places


def rules(t):
    w = words(t)
    g = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + k for i, x in enumerate(g) if g.count(x) > 1 for k in range(5)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered)


def test_rules_equal_brute_force(spark):
    rng = random.Random(5)
    texts = {1: None, 2: "", 3: " \x0b ", 4: "a b c d e " * 30, 5: "é # x\n\né # x\ny", 6: "one", 7: "l\nl\nl\n \n "}
    for i in range(10, 60):
        texts[i] = "".join(rng.choice("abc") + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(1, 60)))
    src = {i: "good" if i % 2 else None for i in texts}
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.apply_rules(documents(spark, texts, sources=src)).collect()}
    assert got == {i: rules(t) for i, t in texts.items()}


def test_host_verdicts(spark):
    good = {i: prose(40, i) for i in range(40)}
    bad = {100 + i: "spam " * 40 for i in range(30)} | {140: prose(40, 140)}
    src = {i: "good" for i in good} | {i: "bad" for i in bad}
    docs = documents(spark, good | bad, sources=src)
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    assert all(kept[i] for i in good) and not any(kept[i] for i in bad)
    a = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs.union(docs.where("doc_id = 0"))).collect()}
    assert a == kept and quality_rules.apply_rules(documents(spark, [])).count() == 0


def test_null_host_is_no_empty_host(spark):
    rows = [(i, "spam " * 40, None) for i in range(30)] + [(100 + i, prose(40, i), "") for i in range(5)] + [(200, prose(30_000, 1), "long")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r.doc_id: (r.kept, r.n_words) for r in quality_rules.apply_rules(docs).collect()}
    assert not any(kept[i][0] for i in range(30)) and all(kept[100 + i][0] for i in range(5)) and kept[200] == (True, 30_000)


def test_salted_hosts_give_the_same(spark, monkeypatch):
    docs = documents(spark, {i: prose(20, i) if i % 3 else "x" for i in range(30)}, sources={i: f"h{i % 4}" for i in range(30)})
    one = sorted(map(tuple, quality_rules.apply_rules(docs).collect()))
    monkeypatch.setattr(quality_rules, "BROADCAST_HOSTS", 0)
    assert one == sorted(map(tuple, quality_rules.apply_rules(docs).collect()))


def brute_rates(tokens, p, targets, least=0.0, total=None):
    """Plain projected gradient: every rate moves against its posteriors' residuals, and never below `least`."""
    expected = tokens @ p
    goal = targets / sum(targets) * (total or max(expected / targets * sum(targets)))
    rate, pace = np.ones(len(tokens)), np.linalg.inv((p * tokens[:, None]).T @ p / expected[:, None] + mixing.DAMPING * np.eye(p.shape[1]))
    while np.abs((tokens * rate) @ p / goal - 1).max() >= mixing.TOLERANCE:
        rate = np.maximum(least, rate - p @ (pace @ (((tokens * rate) @ p - goal) / expected)))
    return rate


def test_mixing_meets_targets(spark):
    parts = {"de": vocabulary(40, 1), "en": vocabulary(40, 2)}
    texts, langs = {}, {}
    for i in range(200):
        langs[i] = "de" if i % 5 == 0 else "en"
        texts[i] = prose(50 + i % 7, i, parts[langs[i]])
    texts |= {300: None, 301: "", 302: texts[0], 303: prose(30_000, 3, parts["de"]), 304: "The THE the\nthe, the."}
    langs[7] = None
    docs = documents(spark, texts, langs)
    rated, model = mixing.rates(docs, {"de": 0.5, "en": 0.5}, keep=["doc_id"])
    rows = rated.collect()
    tokens, p, rate = np.array([r.n_tokens for r in rows]), np.array([r.p for r in rows]), np.array([r.rate for r in rows])
    assert len(rows) == len(texts) and {r.row.doc_id: r.n_tokens for r in rows} == {i: len(words(t)) for i, t in texts.items()}
    assert rate.min() >= 0 and np.allclose(rate, brute_rates(tokens, p, np.array([0.5, 0.5])), atol=1e-6)
    shares = (tokens * rate) @ p
    assert np.allclose(shares / shares.sum(), 0.5, atol=1e-3)
    best = {r.row.doc_id: model.domains[int(np.argmax(r.p))] for r in rows}
    assert all(best[i] == ("de" if i % 5 == 0 else "en") for i in range(200)) and best[303] == "de"
    steps, off = mixing.fit_rates(rated, 2, least=1.0)
    assert max(map(abs, off)) < mixing.TOLERANCE and len(steps) < 10
    assert rated.select(F.min(mixing.rate_of(steps, 1.0))).first()[0] >= 1.0
    out = mixing.resample(docs, least=1.0)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == set(texts)


def test_posteriors_equal_naive_bayes(spark):
    """Documents and words counted by hand, with the operator's definition of a word."""
    rng = random.Random(11)
    vocab = {d: vocabulary(60, k) + ["The", "no-one", "ÉTÉ"] for k, d in enumerate(("a", "b", "c"))}
    texts, langs = {}, {}
    for i in range(120):
        langs[i] = rng.choice("abbccc")
        texts[i] = rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab[langs[i]]) for _ in range(rng.randint(1, 80)))
    texts |= {500: "nothing known 123", 501: "", 502: None, 503: "The the THE no one été"}
    different = lambda t: {w for w in re.split(r"[\x09-\x0D -/:-@\[-`{-~]+", (t or "").lower()) if w}
    domains = ["a", "b", "c"]
    n = np.array([sum(x == d for x in langs.values()) for d in domains], float)
    count = {}
    for i, d in langs.items():
        for w in different(texts[i]):
            count.setdefault(w, np.zeros(3))[domains.index(d)] += 1
    known = sorted(w for w, c in count.items() if (c / n).max() >= mixing.LEAST_SHARE)
    rate = (np.array([count[w] for w in known]).T + 0.5) / (n + 1)[:, None]
    tells = rate * (np.log(rate) - np.log(rate.mean(0)))
    used = sorted({i for k in range(3) for i in np.argsort(-tells[k], kind="stable")[: mixing.WORDS_PER_DOMAIN]})
    share = np.log(rate[:, used] / rate[:, used].sum(1, keepdims=True))
    docs = documents(spark, texts, langs)
    model = mixing.train(docs)
    got = {r.row.doc_id: r.p for r in model.posteriors(docs, keep=["doc_id"]).collect()}
    assert model.words == [known[i] for i in used]
    for i, t in texts.items():
        s = np.log(n / n.sum()) + sum((share[:, k] for k, j in enumerate(used) if known[j] in different(t)), np.zeros(3))
        assert np.allclose(got[i], np.exp(s - s.max()) / np.exp(s - s.max()).sum(), atol=1e-9)


def test_mixing_of_many_domains_and_unknown_targets(spark):
    langs = {i: f"l{i % 70:02}" for i in range(280)}
    docs = documents(spark, {i: " ".join(f"{d}w{k}" for k in range(12)) for i, d in langs.items()}, langs)
    rated, model = mixing.rates(docs, keep=["doc_id"])
    assert model.domains == sorted(set(langs.values())) and all(model.domains[int(np.argmax(r.p))] == langs[r.row.doc_id] for r in rated.collect())
    few = documents(spark, {1: "a b", 2: "c d", 3: None}, {1: "x", 2: "y"})
    with pytest.warns(UserWarning, match="no row is known"):
        assert mixing.rates(few, {"x": 1.0, "zz": 3.0})[0].count() == 3
    for docs in (few, documents(spark, [])):
        with pytest.warns(UserWarning, match="no row is known"):
            assert {r.rate for r in mixing.rates(docs, {"zz": 1.0})[0].collect()} <= {1.0}
    with pytest.warns(UserWarning, match="no row is known"):
        assert mixing.resample(documents(spark, []), {"x": 1.0}).count() == 0


@pytest.mark.parametrize("shares", [(0.6, 0.25, 0.149, 0.001), (0.6, 0.25, 0.15, 0.00001)])
def test_mixing_with_a_rare_domain(spark, shares):
    rows = [(round(1e6 * s), [float(j == k) for j in range(4)]) for k, s in enumerate(shares)]
    members = spark.createDataFrame(rows, "n_tokens long, p array<double>")
    steps, off = mixing.fit_rates(members, 4)
    assert max(map(abs, off)) < mixing.TOLERANCE
    rated = members.withColumn("rate", mixing.rate_of(steps))
    got = np.array([r.rate * r.n_tokens for r in sorted(rated.collect(), key=lambda r: r.p, reverse=True)])
    want = np.array(shares) ** mixing.FLATTEN
    assert np.allclose(got / got.sum(), want / want.sum(), rtol=1e-3)


def test_mixing_says_what_is_not_met(spark):
    rng = np.random.default_rng(0)
    soft = [(int(rng.integers(50, 500)), rng.dirichlet([0.3, 0.3, 0.05]).tolist()) for _ in range(300)]
    members = spark.createDataFrame(soft, "n_tokens long, p array<double>")
    assert max(map(abs, mixing.fit_rates(members, 3, {0: 0.3, 1: 0.3, 2: 0.4})[1])) < mixing.TOLERANCE
    docs = documents(spark, {i: "same words in both" for i in range(20)}, {i: "a" if i % 2 else "b" for i in range(20)})
    with pytest.warns(UserWarning, match="off their targets"):
        mixing.rates(docs, {"a": 0.9, "b": 0.1})


def test_mixing_without_domains(spark):
    docs = documents(spark, {1: "a b", 2: None})
    assert {r.rate for r in mixing.rates(docs)[0].collect()} == {1.0}
    assert mixing.rates(documents(spark, []))[0].count() == 0


def test_rules_sql_agrees(spark):
    from wellspring.llm import registry

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in registry.oracle_sql().items():
        r = con.execute(sql)
        names = [x[0] for x in r.description]
        got = registry.queries()[name](spark, sf).select(*names)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, r.fetchall())), name
