"""Quality rules with host-level verdicts.

Every document is measured by plain rules. Failures are then counted by host; each host's failure rate is
shrunk towards the corpus by a beta prior fitted to the hosts' own rates (method of moments), and a host
whose shrunken rate exceeds `reject_rate` has all its documents rejected. DataFrame functions only.

Defined results: a null text has no words (it fails min_words); a null host is a host of its own, apart from ''; a very long
text is measured whole; a host whose rate ties with `reject_rate` is kept; repeated rows are each judged and each count; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: Hosts up to this many are broadcast (about 50 bytes each); more are joined by salted keys.
BROADCAST_HOSTS = 100_000
SALTS = 32


def _host(host: Column) -> Column:
    """Never null, and another string for each host: null is '', and every other host has a sign before it."""
    return F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit(""))


def _ordered(windows: Column) -> Column:
    """(hash, position) of each window in order, so that equal windows stand side by side."""
    return F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """id, host and the rule metrics of every row; one narrow pass, no shuffle."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), _host(F.col(host_col)).alias("host"), t.alias("t"))
    df = df.select("doc_id", "host", "t", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("words"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD))
    df = df.select(
        "doc_id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    at = lambda i, k: F.get(F.col("h"), i + k)
    windows = F.when(F.size("h") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    df = df.select("doc_id", "host", "n_words", "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("win"))
    # Most texts repeat no window: only the others are sorted.
    df = df.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("win") > F.size(F.array_distinct("win")), _ordered(F.col("win"))).alias("s"),
    )
    h = lambda k: F.get(F.col("s"), k)["h"]
    repeated = F.array_sort(F.filter(F.transform("s", lambda x, k: F.when((x["h"] == h(k + 1)) | ((k > 0) & (x["h"] == h(F.greatest(k - 1, F.lit(0))))), x["i"])), lambda p: p.isNotNull()))
    df = df.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.alias("p"))
    # The words covered are the union of the intervals [p, p + WINDOW) over the repeated positions p.
    gaps = F.transform("p", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("p"), k + 1) - x, F.lit(WINDOW))))
    return df.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def host_rates(metrics: DataFrame) -> DataFrame:
    """host, docs, failures: a partial aggregate runs before the shuffle, so a host with a third of all rows is no burden."""
    return metrics.groupBy("host").agg(F.count("*").alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failures"))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """alpha and beta of the hosts' failure rates by moments, each host weighed once; only three sums reach the driver."""
    rate = F.col("failures") / F.col("docs")
    m, v, noise, n = hosts.agg(F.avg(rate), F.coalesce(F.var_pop(rate), F.lit(0.0)), F.avg(1 / F.col("docs")), F.count("*")).first()
    if not n:
        return 1.0, 1.0
    m = min(max(float(m), 1e-6), 1 - 1e-6)
    # What the rates vary beyond binomial noise; at least a hundredth of the largest variance a beta can have.
    spread = max(float(v) - m * (1 - m) * float(noise), 0.01 * m * (1 - m))
    strength = max(m * (1 - m) / spread - 1, 1.0)
    return m * strength, (1 - m) * strength


def apply_rules(docs: DataFrame, reject_rate: float = 0.5, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Metrics, base_failed, the host's shrunken failure rate and kept for every row of docs."""
    metrics = materialize(measure(docs, id_col, text_col, host_col).withColumn("base_failed", base_failed()), "rules")
    hosts = host_rates(metrics)
    alpha, beta = beta_prior(hosts)
    verdicts = hosts.select("host", ((F.col("failures") + alpha) / (F.col("docs") + alpha + beta)).alias("host_rate"))
    verdicts = materialize(verdicts.withColumn("host_rejected", F.col("host_rate") > reject_rate), "hosts")
    if verdicts.count() <= BROADCAST_HOSTS:
        joined = metrics.join(F.broadcast(verdicts), "host", "left")
    else:
        salt = lambda c: F.pmod(F.xxhash64(c), F.lit(SALTS)).cast("int")
        many = verdicts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = metrics.withColumn("salt", salt("doc_id")).join(many, ["host", "salt"], "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"), "host_rate",
    )


ORACLE_SQL = """
WITH w AS (
  SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i, concat_ws(' ', words[i], words[i+1], words[i+2], words[i+3], words[i+4]) AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(0, 5) r(k) WHERE c > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN lines USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*) AS docs, sum(CAST(base_failed AS BIGINT)) AS failures FROM f GROUP BY host),
mo AS (
  SELECT least(greatest(avg(failures / docs), 1e-6), 1 - 1e-6) AS mu, coalesce(var_pop(failures / docs), 0.0) AS v,
         avg(1.0 / docs) AS noise FROM h),
pr AS (SELECT mu, greatest(mu * (1 - mu) / greatest(v - mu * (1 - mu) * noise, 0.01 * mu * (1 - mu)) - 1, 1.0) AS s FROM mo)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ((failures + mu * s) / (docs + s) > 0.5) AS kept,
       round((failures + mu * s) / (docs + s), 6) AS host_rate
FROM f JOIN h USING (host), pr
"""


def query(spark, sf_dir: str) -> DataFrame:
    from wellspring.llm._common import table

    return apply_rules(table(spark, sf_dir, "documents")).withColumn("host_rate", F.round("host_rate", 6))
