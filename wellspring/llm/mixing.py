"""Mixing to target weights by soft membership.

A naive Bayes classifier over telling words, learned from the rows whose domain is known, predicts every document's
posterior over the domains (here the languages): each different word of a text counts once, so that length doesn't
harden the posteriors. Nonnegative rates, one for each document, are then fitted by projected gradient descent so that the
domains' expected token totals, sum of rate * tokens * posterior, match the targets in the least-squares sense; a warning
names targets that are not met. Rates start at 1 and move by the documents' posteriors alone, so an iteration is one
aggregate of K sums; only residuals reach the driver. DataFrame functions only.

Defined results: a null or wordless text has no tokens and the prior as its posterior, so has one without telling words; a
very long text is read whole; a null domain is predicted like any other and teaches nothing; without known domains there is
one, '', and every rate is 1; targets of domains that no row is known to have are left out with a warning; of equal
posteriors the first domain by name is shown; repeated rows are each rated; an empty table gives an empty result; other
columns are ignored, or kept by resample().
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.session import materialize

#: Bounds of the fit: labelled documents of each domain (about as many, by a hash), words used of each domain.
SAMPLE_DOCS, WORDS_PER_DOMAIN = 800, 24
#: A word is looked at where it's in this share of some domain's sample, which bounds their number, and is no longer than this.
LEAST_SHARE, LONGEST = 0.05, 24
#: Domains that one model may have: it holds a number for each domain and word. With more, train() raises; group them first.
MOST_DOMAINS = 1000
#: Default targets: shares of the corpus to this power, which favours small domains.
FLATTEN = 0.7
#: Rounds go on until every total is within TOLERANCE of its target; else, with a warning, until STALLED rounds have not brought
#: them 1 % nearer (targets that no rates meet), or until MOST_ROUNDS.
TOLERANCE, STALLED, MOST_ROUNDS = 1e-4, 20, 2000
#: Added to the gram before it's inverted, for domains whose posteriors are nearly proportional.
DAMPING = 1e-3
#: Posteriors below this are left out of the gram, which only sets the pace of each domain.
FAINT = 1e-9
#: Copies come in steps of 1 / 1000 of a rate, so that a rate a hair under 1 drops nothing.
STEP = 1000
WORD = r"[^\x20\x09-\x0D]+"
#: Between two of the classifier's words, in training and in use.
BETWEEN = r"[\x09-\x0D -/:-@\[-`{-~]+"


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """What the classifier reads of a text: lower case, between white space and punctuation."""
    return F.split(F.lower(text), BETWEEN, -1)


def _literal(values: np.ndarray) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


class Classifier:
    """Naive Bayes: the log prior of each domain, and of each telling word the log share that it has of the telling words there."""

    def __init__(self, domains: list[str], prior: np.ndarray, words: list[str], shares: np.ndarray):
        self.domains, self.prior, self.words, self.shares = domains, prior, words, shares

    def posteriors(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """row (a struct of the columns to keep), n_tokens and p, an array with a number for each domain; one narrow pass."""
        row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
        df = docs.select(row.alias("row"), _text(text_col).alias("t"))
        df = df.withColumn("n_tokens", F.regexp_count("t", F.lit(WORD)).cast("long"))
        start = _literal(self.prior)
        if self.words:
            table = F.map_from_arrays(F.array(*map(F.lit, self.words)), F.array(*[_literal(x) for x in self.shares.T]))
            present = F.array_sort(F.array_intersect(words(F.col("t")), F.array(*map(F.lit, self.words))))
            start = F.aggregate(present, start, lambda a, w: F.zip_with(a, F.element_at(table, w), lambda x, y: x + y))
        df = df.withColumn("s", start).withColumn("e", F.transform("s", lambda x: F.exp(x - F.array_max("s"))))
        total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
        return df.withColumn("total", total).select("row", "n_tokens", F.transform("e", lambda x: x / F.col("total")).alias("p"))


def train(docs: DataFrame, domain_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE_DOCS) -> Classifier:
    """Priors from all known rows; words and their shares from about `sample` rows of each domain, chosen by a hash of id and text."""
    known = docs.where(F.col(domain_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(domain_col).cast("string").alias("domain"), _text(text_col).alias("t"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"))
    counts = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).limit(MOST_DOMAINS + 1).collect()}
    if not counts:
        return Classifier([""], np.zeros(1), [], np.zeros((1, 0)))
    if len(counts) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains: group them in {domain_col!r} first")
    domains = sorted(counts)
    prior = np.array([counts[d] for d in domains], float)
    parts = 1 << 20
    share = F.map_from_arrays(F.array(*map(F.lit, domains)), F.array(*[F.lit(int(np.ceil(parts * min(1.0, sample / counts[d])))) for d in domains]))
    picked = known.where(F.pmod("hash", F.lit(parts)) < F.element_at(share, F.col("domain"))).select("domain", F.array_distinct(words(F.col("t"))).alias("w"))
    # One aggregate for words and documents: '' stands for the document.
    held = picked.select("domain", F.explode(F.array_union(F.array(F.lit("")), "w")).alias("w")).where(F.length("w") <= LONGEST).groupBy("domain", "w").agg(F.count("*").alias("n"))
    held = materialize(held, "words")
    size = {r.domain: r.n for r in held.where("w = ''").collect()}
    n = np.array([size.get(d, 0) for d in domains], float)
    of = F.map_from_arrays(F.array(*map(F.lit, domains)), F.array(*[F.lit(float(max(1, x))) for x in n]))
    seen = held.where("w <> ''").groupBy("w").agg(F.max(F.col("n") / F.element_at(of, F.col("domain"))).alias("top"), F.collect_list(F.struct("domain", "n")).alias("by"))
    rows = sorted(seen.where(F.col("top") >= LEAST_SHARE).select("w", "by").collect(), key=lambda r: r.w)
    place = {d: k for k, d in enumerate(domains)}
    table = np.zeros((len(domains), len(rows)))
    for i, r in enumerate(rows):
        for x in r.by:
            table[place[x.domain], i] = x.n
    return naive_bayes(domains, prior, [r.w for r in rows], table, n)


def naive_bayes(domains: list[str], prior: np.ndarray, words: list[str], table: np.ndarray, n: np.ndarray) -> Classifier:
    """From the documents of each domain that hold each word, of n documents: the words that tell most of a domain."""
    rate = (table + 0.5) / (n + 1)[:, None]
    # A word tells a domain apart as far as it's frequent there and rarer elsewhere.
    tells = rate * (np.log(rate) - np.log(rate.mean(0)))
    used = sorted({int(i) for k in range(len(domains)) for i in np.argsort(-tells[k], kind="stable")[:WORDS_PER_DOMAIN]})
    shares = rate[:, used] / rate[:, used].sum(1, keepdims=True) if used else np.zeros((len(domains), 0))
    return Classifier(domains, np.log(prior / prior.sum()), [words[i] for i in used], np.log(shares))


def fit_rates(members: DataFrame, n_domains: int, targets: dict[int, float] | None = None, total: float | None = None, least: float = 0.0) -> tuple[np.ndarray, list[float]]:
    """From members (n_tokens, p): the steps that rate_of() takes, one row of n_domains each; and how far each domain's total
    is then from its target, relatively.

    targets: shares by domain number, else the corpus shares flattened. total: of tokens, else as few as let no domain
    shrink, nor a rate need to be below `least`, where none falls. In the metric that weighs documents by tokens the gradient is sum of p_k u_k, with
    u the residuals times the inverse gram of the posteriors: each domain moves at its own pace, however rare.
    """
    p = [F.col("p")[k] for k in range(n_domains)]
    tokens = F.col("n_tokens")
    totals = lambda df, weight: np.array([x or 0.0 for x in df.agg(*[F.sum(tokens * x * weight) for x in p]).first()])
    expected = totals(members, F.lit(1.0))
    if not expected.sum():
        return np.zeros((0, n_domains)), [0.0] * n_domains
    live = expected > 0
    safe = np.where(live, expected, 1.0)
    share = np.where(live, expected / expected.sum(), 1.0)
    wanted = np.array([targets.get(k, 0.0) for k in range(n_domains)]) if targets else np.where(live, share**FLATTEN, 0)
    wanted = np.where(live, wanted, 0)
    if not wanted.sum():
        return np.zeros((0, n_domains)), [0.0] * n_domains
    wanted = wanted / wanted.sum()
    gram = np.zeros((n_domains, n_domains))
    clear = F.filter(F.transform("p", lambda x, k: F.struct(k.alias("k"), x.alias("x"))), lambda y: y["x"] > FAINT)
    pairs = members.select("n_tokens", clear.alias("y")).select("n_tokens", "y", F.explode("y").alias("a")).select("n_tokens", "a", F.explode("y").alias("b"))
    for r in pairs.groupBy(F.col("a.k").alias("j"), F.col("b.k").alias("k")).agg(F.sum(tokens * F.col("a.x") * F.col("b.x")).alias("g")).collect():
        gram[r.j, r.k] = r.g
    size = total or float(np.max(np.where(wanted > 0, expected / np.where(wanted > 0, wanted, 1), 0)))
    if not total and least:
        # Rates that are sums of p_k g_k meet the targets; with every g_k at `least` or more none has to be cut off there.
        g = np.linalg.lstsq(gram[np.ix_(live, live)], wanted[live], rcond=None)[0]
        size = max(size, least / g.min()) if g.min() > 0 else size
    goal = np.where(live, wanted * size / safe, 0)
    # Row k in units of domain k's own total: rows sum to 1, so that no eigenvalue passes 1 and a whole step is safe.
    pace = np.linalg.inv(gram / safe[:, None] + DAMPING * np.eye(n_domains))
    # Only what the totals need is written again where the chain of steps is cut.
    current, best, since, steps = members.select("n_tokens", "p", F.lit(1.0).alias("rate")), np.inf, 0, []
    for chain in range(1, MOST_ROUNDS + 1):
        residual = np.where(live, totals(current, F.col("rate")) / safe - goal, 0)
        off = np.abs(residual / np.where(goal > 0, goal, 1)).max()
        best, since = (off, 0) if off < 0.99 * best else (best, since + 1)
        if off < TOLERANCE or since >= STALLED or chain == MOST_ROUNDS:
            break
        u = np.where(live, pace @ residual, 0)
        steps.append(u)
        move = sum((x * float(v) for x, v in zip(p[1:], u[1:])), p[0] * float(u[0]))
        current = current.withColumn("rate", F.greatest(F.lit(float(least)), F.col("rate") - move))
        if chain % 16 == 0:  # the chain of steps is one expression; it's cut before it grows long
            current = materialize(current, "rates")
    return np.array(steps).reshape(-1, n_domains), [float(r / (g or 1)) for r, g in zip(residual, goal)]


def rate_of(steps: np.ndarray, least: float = 0.0) -> Column:
    """The rate of a row from its posteriors p: from 1 on, each step moves it against them, and never below `least`."""
    if not len(steps):
        return F.lit(1.0)
    dot = lambda u: F.aggregate(F.zip_with(F.col("p"), u, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(F.array(*map(_literal, steps)), F.lit(1.0), lambda r, u: F.greatest(F.lit(float(least)), r - dot(u)))


def rates(docs: DataFrame, targets: dict[str, float] | None = None, total: float | None = None, least: float = 0.0, domain_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, Classifier]:
    """row (a struct of the columns to keep, else of docs' own), n_tokens, posteriors p and rate of every row."""
    model = train(docs, domain_col, id_col, text_col)
    members = materialize(model.posteriors(docs, text_col, keep), "members")
    if targets is not None and (unknown := sorted(set(targets) - set(model.domains))):
        warnings.warn(f"mixing: no row is known to be of {unknown}; their targets are left out", stacklevel=2)
    by_number = None if targets is None else {k: targets[d] for k, d in enumerate(model.domains) if d in targets}
    if by_number == {}:
        return members.withColumn("rate", F.lit(1.0)), model
    steps, off = fit_rates(members, len(model.domains), by_number, total, least)
    if unmet := {d: r for d, r in zip(model.domains, off) if abs(r) >= TOLERANCE}:
        warnings.warn("mixing: token totals off their targets: " + ", ".join(f"{d!r} by {r:+.2%}" for d, r in unmet.items()), stacklevel=2)
    return members.withColumn("rate", rate_of(steps, least)), model


def copies(rate: Column, key: Column) -> Column:
    """How often a row is taken: the rate rounded up or down by a hash of its key, so that the mean is the rate."""
    return F.floor(F.round(rate * STEP) / STEP + F.pmod(F.xxhash64(key, F.lit(17)), F.lit(STEP)) / STEP).cast("int")


def resample(docs: DataFrame, targets: dict[str, float] | None = None, total: float | None = None, least: float = 0.0) -> DataFrame:
    """docs' columns, every row as often as its rate says."""
    rated, _ = rates(docs, targets, total, least)
    repeated = rated.select("row", F.explode(F.array_repeat(F.lit(0), copies(F.col("rate"), F.col("row.doc_id")))).alias("copy"))
    return repeated.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    from wellspring.llm._common import table

    rated, model = rates(table(spark, sf_dir, "documents"), keep=["doc_id"])
    p = F.col("p")
    best = F.array_position(p, F.array_max(p)).cast("int") - 1
    return rated.select("row.doc_id", "n_tokens", F.get(F.array(*map(F.lit, model.domains)), best).alias("domain"), F.round(F.array_max(p), 6).alias("posterior"), F.round("rate", 6).alias("rate"), copies(F.col("rate"), F.col("row.doc_id")).alias("copies"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scarce domains are repeated; every document stays at least once."""
    return resample(docs, least=1.0)
