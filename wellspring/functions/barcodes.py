"""Barcode and base-call expressions, all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def substring_1based(c: Column, start: int, end: int) -> Column:
    """Characters start..end, counted from 1, both included."""
    return F.substring(c, start, end - start + 1)


def dynamic_prefix(c: str, length: str) -> Column:
    """A prefix whose length stands in another column."""
    return F.substr(F.col(c), F.lit(1), F.col(length))


def skip_cycles(c: str | Column, skip: list[int], length: int | None = None) -> Column:
    """The string without its characters at the skipped cycles (from 1), then cut to a length."""
    c = F.col(c) if isinstance(c, str) else c
    kept = F.array_join(F.filter(F.split(c, ""), lambda x, i: ~F.array_contains(F.array(*map(F.lit, skip)), i + 1)), "") if skip else c
    return F.substring(kept, 1, length) if length else kept


def quality(intensities: Column) -> Column:
    """clip(2 * (1 - ln(2 + second) / ln(2 + first)), 0, 1) of the two largest values' magnitudes."""
    ordered = F.sort_array(intensities, asc=False)
    a, b = F.abs(F.get(ordered, F.lit(0))), F.abs(F.get(ordered, F.lit(1)))
    first, second = F.greatest(a, b), F.least(a, b)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * (1 - F.log(2 + second) / F.log(2 + first))))


def base_call(intensities: Column, bases: list[str]) -> Column:
    """The base of the largest channel; of equal ones the first."""
    return F.get(F.array(*map(F.lit, bases)), (F.array_position(intensities, F.array_max(intensities)) - 1).cast("int"))


def hamming(a: Column, b: Column) -> Column:
    """Differing positions over the shorter length, plus the difference in length."""
    n = F.least(F.length(a), F.length(b))
    differ = F.aggregate(F.zip_with(F.split(F.substr(a, F.lit(1), n), ""), F.split(F.substr(b, F.lit(1), n), ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(n == 0, F.greatest(F.length(a), F.length(b))).otherwise(differ + F.abs(F.length(a) - F.length(b)))


def cycle_positions(map_length: int, recomb_length: int, order: str = "map_recomb", skip_map: list[int] | None = None, skip_recomb: list[int] | None = None) -> dict[str, int]:
    """First and last cycle (from 1) of the mapping and the recombination barcode in a read.

    The lengths are of the designed prefixes; cycles that are skipped aren't sequenced, so each part is shorter by as many.
    """
    if order not in ("map_recomb", "recomb_map"):
        raise ValueError(f"unknown sequencing order {order!r}")
    span = {"map": map_length - len(skip_map or []), "recomb": recomb_length - len(skip_recomb or [])}
    first, second = order.split("_")
    out = {f"{first}_start": 1, f"{first}_end": span[first]}
    return out | {f"{second}_start": span[first] + 1, f"{second}_end": span[first] + span[second]}


def control_name(gene: str | Column, patterns: list[str], template: str = "nontargeting_%s", suffix: Column | None = None, pattern_map: list[tuple[str, str]] | None = None) -> Column:
    """Genes that match a control pattern (any case) as one formatted name; the ordered map of patterns goes first."""
    c = F.col(gene) if isinstance(gene, str) else gene
    out = F.when(F.lit(False), c)
    for pattern, name in pattern_map or []:
        out = out.when(c.rlike(f"(?i){pattern}"), F.lit(name))
    for pattern in patterns:
        out = out.when(c.rlike(f"(?i){pattern}"), F.format_string(template, suffix if suffix is not None else c))
    return out.otherwise(c)


def before_ampersand(gene: str | Column) -> Column:
    c = F.col(gene) if isinstance(gene, str) else gene
    return F.trim(F.split_part(c, F.lit("&"), F.lit(1)))


def first_known(variants: Column, known: Column) -> Column:
    """First white-space separated token that is in the array `known`, else the first token."""
    tokens = F.split(F.trim(variants), r"\s+")
    return F.coalesce(F.get(F.filter(tokens, lambda t: F.array_contains(known, t)), F.lit(0)), F.get(tokens, F.lit(0)))


def single_gene(columns: list[Column]) -> Column:
    """Whether exactly one different gene is named."""
    return F.size(F.array_distinct(F.array_compact(F.array(*columns)))) == 1


def canon_plate(c: str | Column) -> Column:
    """1, 1.0 and "1.0" as "1"."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")


def canon_well(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(c.cast("string")))
