"""Registered queries over the driver's tables, each with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import annotation, multivariate, patterns, reads, sites, statistics, streams, windows
from .registry import QUERIES, SQL


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["w1_a7_genome_windows"](spark, sf_dir)


def relational_queries() -> dict:
    return dict(QUERIES)


def relational_sql() -> dict[str, str]:
    return dict(SQL)


__all__ = ["annotation", "entry_query", "multivariate", "patterns", "reads", "relational_queries", "relational_sql", "sites", "statistics", "streams", "windows"]
