"""Dimension and file jobs: routed dimension tables, region codes, word lists, weather rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.operators.filters import cdc_filter_valid, region_filter, weather_flatten
from marketlens.operators.joins import word_membership, words_of
from marketlens.operators.routing import (
    config_latest, dim_cells, dim_rows, dim_table_lifecycle, read_dim_tables, route_dim_by_config, write_dims)
from marketlens.operators.windows import run_summary


def dim_job(spark: SparkSession, changes: DataFrame, config_changes: DataFrame, db: str, database: str,
            path: str) -> DataFrame:
    """The dimension job: config to tables, changes routed by the config in force, written into these tables, and read back.

    ``database`` holds the tables; ``path`` is scratch space. Rows are ``sink_table, row_key, cells``.
    """
    tables = dim_table_lifecycle(spark, config_changes, database)
    routed = route_dim_by_config(cdc_filter_valid(changes, db), config_latest(config_changes))
    write_dims(spark, dim_rows(dim_cells(routed)), database, tables, path)
    return read_dim_tables(spark, database, tables)


def sensitive_hits(texts: DataFrame, key: str, text: str, word_set: DataFrame) -> DataFrame:
    """Listed words in each text with their number; repeats within a text combine before the join."""
    counts = words_of(texts, text, [key]).groupBy(key, "word").agg(F.count("*").alias("hits"))
    return word_membership(counts, word_set).where("in_set").select(key, "word", "hits")


def weather_rows(cities: DataFrame) -> DataFrame:
    """Usable weather rows of the cities to fetch, from saved responses in ``resp``."""
    return weather_flatten(region_filter(cities)).where("ok").drop("ok")


def weather_report(cities: DataFrame) -> DataFrame:
    """Report row over all fetched cities."""
    return run_summary(weather_flatten(region_filter(cities)))
