"""Every query of the screen operators, by name, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wellspring.plans import parts, profiles, screen, screens


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**profiles.QUERIES, **screens.QUERIES, **parts.QUERIES, **screen.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**profiles.SQL, **screens.SQL, **parts.SQL, **screen.SQL}
