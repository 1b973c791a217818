"""All queries of the catalogue operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievework.plans import catalog_queries, graph_queries, ingest_queries, review_queries, run_queries, stream_queries, text_queries

MODULES = (ingest_queries, text_queries, graph_queries, run_queries, review_queries, catalog_queries, stream_queries)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule cascade with its audit."""
    return ingest_queries.rule_cascade(spark, sf_dir)
