"""Personal data: pattern spans, and terms that corpus co-occurrence shows to reveal a protected entity.

Emails, addresses, card and phone numbers are found by patterns. Each is a protected entity c at three levels: its value,
its group (an email's domain, an address's network, a card's issuer, a number's country and area) and its kind. A term t
reveals c as far as their pointwise mutual information PMI(c; t) = log2(p(c | t) / p(c)) comes near the entity's own
information IC(c) = -log2 p(c); where it exceeds DISCLOSURE * IC(c), the term is a span of its own: generalised if a
more general word keeps its sense (numbers, addresses of pages, names), else removed. p(c) is the share of rows that hold
c. p(c | t) is the share of the rows with t, anywhere, in which t stands within WINDOW words of c, times 1 - 1 / (number of
different texts in which it does): what one text and its copies show proves nothing. DataFrame functions only.

Defined results: a null text counts as empty and has no spans; very long texts are searched whole; rows with the same id are
each searched, and equal texts get equal spans; a term that ties with the threshold counts as revealing; where several kinds
of span overlap all are listed, and sanitize() makes one of them; an empty table gives an empty result; other columns are
ignored, or kept by sanitize().
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: The patterns, with possessive quantifiers where giving back can't help: long runs cost no backtracking and no stack.
#: A match starts at the start of a run of its first class, or where the match before ended (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be tried at all.
HINTS = {"email": "[^@]@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}
PUNCTUATION = ".,;:!?()[]{}\"'*%$&#|<>"
WINDOW = 4
DISCLOSURE = 0.9
#: Texts (equal ones count once) that are taken off those in which a term stands by an entity: one text proves nothing.
DISCOUNT = 1
#: Revealing terms up to this many are broadcast (under 200 bytes each); more are joined by a shuffle on the term.
BROADCAST_TERMS = 100_000
#: Characters of a term; longer ones are held by their digest.
LONGEST = 64
SPACE = r"[\x20\x09-\x0D]"


def _no_spans() -> Column:
    return F.array().cast("array<struct<kind:string,s:int,e:int,v:string>>")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        twice = 2 * d
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _spans_of(kind: str) -> Column:
    """Array of (kind, s, e, v) from column t and its matches in column `kind`: failing matches dropped.

    The pieces between matches, from split(), and the matches give every offset; both count code points.
    """
    matches = F.col(kind)
    gaps = F.transform(F.split("t", PATTERNS[kind], -1), lambda x: F.length(x))
    both = F.arrays_zip(matches.alias("m"), F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), _no_spans().alias("out"))

    def step(a: Column, x: Column) -> Column:
        s = a["at"] + x["gap"]
        e = s + F.length(x["m"])
        span = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), x["m"].alias("v"))
        return F.struct(e.alias("at"), F.when(_passes(kind, x["m"]), F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    return F.when(F.size(matches) > 0, F.aggregate(both, start, step, lambda a: a["out"])).otherwise(_no_spans())


def base_spans(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (the columns to keep), t (the text, never null), key (hashes of it) and spans, by kind and start; one narrow pass."""
    hint = {k: F.col("t").rlike(v) for k, v in HINTS.items()}
    none = F.array().cast("array<string>")
    keep = docs.columns if keep is None else keep
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), _text(text_col).alias("t"))
    df = df.withColumns({k: F.when(hint[k], F.regexp_extract_all("t", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none) for k in KINDS})
    return df.withColumns({"key": _key(), "spans": F.concat(*[_spans_of(k) for k in KINDS])}).drop(*KINDS)


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _key() -> Column:
    """Two hashes of column t: equal texts have equal keys."""
    return F.struct(F.xxhash64("t").alias("h"), F.hash("t").alias("g"))


def _bounded(term: Column) -> Column:
    """The term, or its digest where that is shorter: no term takes more than LONGEST characters."""
    return F.when(F.length(term) > LONGEST, F.sha2(term, 256)).otherwise(term)


def _term(word: Column) -> Column:
    """A word as a term: lower case, without punctuation at its ends."""
    return _bounded(F.lower(F.btrim(word, F.lit(PUNCTUATION))))


def _group(kind: Column, value: Column) -> Column:
    """What entities of one kind share: an email's domain, an address's network, a card's issuer, a number's country and area."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    by = F.when(kind == "email", F.substring_index(F.lower(value), "@", -1)).when(kind == "ip", F.substring_index(value, ".", 2))
    return by.when(kind == "card", F.substring(digits, 1, 6)).otherwise(F.substring(digits, 1, 4))


def _mentions(window: int) -> Column:
    """(entities, near) of each span: the entity at its three levels, and the terms of `window` words on either side."""
    clip = 40 * window
    strip, end = F.lit(" \t\n\x0b\f\r"), F.length("t")

    def words(cut: bool, s: Column, n: Column, before: bool) -> Column:
        """The window's words in n code points from s on; null if a cut piece may not hold them whole."""
        trim = F.rtrim if before else F.ltrim
        each = F.split(trim(F.substr(F.col("t"), s + 1, n), strip), SPACE + "++", -1)
        # A cut piece's outermost word may be cut too; slice() takes the others.
        picked = F.slice(each, F.greatest(F.size(each) - window + 1, F.lit(1)), F.lit(window)) if before else F.slice(each, F.lit(1), F.lit(window))
        return F.when(F.size(each) > window, picked) if cut else picked

    def one(x: Column) -> Column:
        before = F.coalesce(words(True, F.greatest(x["s"] - clip, F.lit(0)), F.least(x["s"], F.lit(clip)), True), words(False, F.lit(0), x["s"], True))
        after = F.coalesce(words(True, x["e"], F.lit(clip), False), words(False, x["e"], end, False))
        value = F.regexp_replace(F.lower(x["v"]), r"[^a-z0-9@.]", "")
        levels = F.array(F.xxhash64(x["kind"]), F.xxhash64(x["kind"], F.lit("group"), _group(x["kind"], x["v"])), F.xxhash64(x["kind"], F.lit("value"), value))
        return F.struct(levels.alias("entities"), F.filter(F.array_distinct(F.transform(F.concat(before, after), _term)), lambda w: F.length(w) > 1).alias("near"))

    return F.transform("spans", one)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """term and n_t, the rows whose text holds it; counted in each task before the shuffle, a row for each term from then on."""
    cut = "[" + re.escape(PUNCTUATION) + "]*+"
    words = F.split(F.btrim(F.lower(_text(text_col)), F.lit(PUNCTUATION + " \t\n\x0b\f\r")), f"{cut}(?:{SPACE}++{cut})+", -1)
    return docs.select(F.explode(F.array_distinct(words)).alias("w")).where(F.length("w") > 1).select(_bounded(F.col("w")).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))


def revealing_terms(docs: DataFrame, mentions: DataFrame, disclosure: float = DISCLOSURE, text_col: str = "text") -> DataFrame | None:
    """term of every term whose mutual information with some entity exceeds disclosure * IC(entity); None if there is none.

    mentions: key and mentions of every row of docs. No group is ever gathered: every count is a partial aggregate before
    its shuffle, and pairs meet the corpus counts as one row for each term.
    """
    n = mentions.count()
    each = mentions.where(F.size("mentions") > 0).select(F.monotonically_increasing_id().alias("row"), "key", F.explode("mentions").alias("x"))
    each = materialize(each.select("row", "key", F.explode("x.entities").alias("entity"), F.col("x.near").alias("near")), "mentions")
    entities = each.select("entity", "row").distinct().groupBy("entity").agg(F.count("*").alias("n_c"))
    held = each.select("row", "key", "entity", F.explode("near").alias("term")).distinct()
    pairs = held.groupBy("entity", "term", "key").agg(F.count("*").alias("rows")).groupBy("entity", "term").agg(F.sum("rows").alias("n_ct"), F.count("*").alias("texts"))
    pairs = materialize(pairs.where(F.col("texts") > DISCOUNT).join(entities, "entity"), "pairs")
    if pairs.isEmpty():
        return None
    share = F.col("n_ct") / F.col("n_t") * (1 - DISCOUNT / F.col("texts"))
    pmi, information = F.log2(share * n / F.col("n_c")), F.log2(n / F.col("n_c"))
    terms = pairs.join(document_frequencies(docs, text_col), "term").where((information > 0) & (pmi >= disclosure * information))
    terms = materialize(terms.select("term").distinct(), "terms")
    return None if terms.isEmpty() else terms


def term_spans(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """key and term_spans, in order, for every different text that holds one of terms."""
    t = docs.select(_text(text_col).alias("t")).withColumn("blank", F.translate("t", "\t\n\x0b\f\r", " " * 5))

    def span() -> Column:
        """Of word number `at` of t."""
        v = F.btrim(F.col("word"), F.lit(PUNCTUATION))
        first = F.when(F.col("at") > 0, F.length(F.expr("substring_index(blank, ' ', at)")) + 1).otherwise(0)
        s = first + F.length("word") - F.length(F.ltrim(F.col("word"), F.lit(PUNCTUATION)))
        return F.struct(F.lit("term").alias("kind"), s.alias("s"), (s + F.length(v)).alias("e"), v.alias("v"))

    if terms.count() <= BROADCAST_TERMS:
        # One pass: a word that is no term goes before its text is copied.
        words = t.select("t", "blank", F.posexplode(F.split("blank", " ", -1)).alias("at", "word"))
        hits = words.withColumn("term", _term(F.col("word"))).join(F.broadcast(terms), "term", "left_semi")
    else:
        words = t.select(_key().alias("key"), F.posexplode(F.split("blank", " ", -1)).alias("at", "word")).withColumn("term", _term(F.col("word")))
        found = words.join(terms, "term", "left_semi").groupBy("key").agg(F.collect_set(F.struct("at", "word")).alias("x"))
        hits = t.join(materialize(found, "hits").withColumnRenamed("key", "k"), _key() == F.col("k")).select("t", "blank", F.explode("x").alias("x")).select("t", "blank", "x.*")
    hits = hits.select(_key().alias("key"), span().alias("x"))
    return materialize(hits.groupBy("key").agg(F.sort_array(F.transform(F.collect_set(F.struct("x.s", "x")), lambda y: y["x"])).alias("term_spans")), "spans")


def find(docs: DataFrame, disclosure: float = DISCLOSURE, window: int = WINDOW, text_col: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows, term_spans): row (a struct of the columns to keep, docs' own names can't clash), key and spans (base) for every
    row of docs; and the spans of revealing terms by key."""
    found = base_spans(docs, text_col, keep).withColumn("mentions", _mentions(window))
    found = materialize(found.select("row", "key", "spans", "mentions"), "personal")
    terms = revealing_terms(docs, found.select("key", "mentions"), disclosure, text_col)
    return found.drop("mentions"), None if terms is None else term_spans(docs, terms, text_col)


def _with_terms(rows: DataFrame, terms: DataFrame | None) -> DataFrame:
    """rows with all_spans: the base spans, then those term spans that touch none of them."""
    if terms is None:
        return rows.withColumn("all_spans", F.col("spans"))
    joined = rows.join(terms, "key", "left")
    clear = F.filter(F.coalesce("term_spans", _no_spans()), lambda x: ~F.exists("spans", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return joined.withColumn("all_spans", F.concat("spans", clear)).drop("term_spans")


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _replacement(x: Column) -> Column:
    """Kinds by their names; terms by a more general word where there is one, else nothing."""
    v = x["v"]
    general = F.when(v.rlike(r"^[0-9][0-9.,/:-]*$"), "[NUMBER]").when(v.rlike(r"[^.]\.[^.]|/"), "[ADDRESS]").when(v.rlike(r"^\p{Lu}"), "[NAME]").otherwise("")
    return F.when(x["kind"] == "term", general).otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))


def sanitize(docs: DataFrame, disclosure: float = DISCLOSURE, text_col: str = "text") -> DataFrame:
    """docs with every span of the text replaced; overlapping spans become one, and n_chars, if there, is the new length."""
    columns = docs.columns
    rows, terms = find(docs, disclosure, text_col=text_col)
    spans = _with_terms(rows, terms).withColumn("ordered", F.array_sort(F.transform("all_spans", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("back"), x["kind"].alias("kind"), x["e"].alias("e"), x["v"].alias("v")))))
    t = F.col("row")[text_col]

    def step(a: Column, x: Column) -> Column:
        apart = x["s"] >= a["at"]
        out = F.when(apart, F.concat(a["out"], F.substr(t, a["at"] + 1, x["s"] - a["at"]), _replacement(x))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), out.alias("out"))

    rest = lambda a: F.concat(a["out"], F.substr(t, a["at"] + 1, F.length(t)))
    new = F.when(F.size("ordered") > 0, F.aggregate("ordered", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)).otherwise(t)
    out = spans.select("row", new.alias("t"))
    final = {text_col: F.col("t")} | ({"n_chars": F.length("t").cast("long")} if "n_chars" in columns else {})
    return out.select(*[final.get(c, F.col("row")[c]).alias(c) for c in columns])


def query(spark, sf_dir: str) -> DataFrame:
    from wellspring.llm._common import table

    rows, terms = find(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return _with_terms(rows, terms).select("row.doc_id", *[count(k) for k in KINDS], F.sha2(_listed("spans"), 256).alias("base_sha256"), _listed("all_spans").alias("spans"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sanitize(docs)
