"""Small tables with the awkward cases: nulls, empty, long and repeated texts, clashing column names."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key string, t string"


def documents(spark, texts, langs=None, sources=None, schema=SCHEMA):
    """texts: {doc_id: text} or [(doc_id, text)]; further columns carry names that the operators use inside."""
    pairs = texts.items() if isinstance(texts, dict) else texts
    rows = [(i, t, (langs or {}).get(i), (sources or {}).get(i), None if t is None else len(t), 1.0, "x", None) for i, t in pairs]
    return spark.createDataFrame(rows, schema)


def words(t):
    return WORD.findall(t or "")


def vocabulary(n, seed=0):
    import random

    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def prose(n, seed, vocab=None):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(vocab or vocabulary(500)) for _ in range(n))
