"""All queries over the driver's tables, by name, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from editlake.plans import channels, modelled, plots, readqc, screening, sources, targeted

PARTS = [screening, targeted, channels, modelled, plots, sources, readqc]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to function of (spark, sf_dir)."""
    return {name: f for part in PARTS for name, f in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL."""
    return {name: text for part in PARTS for name, text in part.SQL.items()}
