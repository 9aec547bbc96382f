"""Sinks: topics, keyed tables, result tables and files."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens.operators.keyed import last_rows
from marketlens.operators.routing import dim_cells, dim_rows, merge_cells


def topic_append(df: DataFrame, path: str, value: str | Column = "value") -> None:
    """Append texts to a file topic, one record per line."""
    value = F.col(value) if isinstance(value, str) else value
    df.select(value.alias("value")).write.mode("append").text(path)


def kafka_append(df: DataFrame, servers: str, topic: str, value: str = "value") -> None:
    """Append texts to one topic, with idempotent writes."""
    (df.select(F.col(value).alias("value")).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("kafka.acks", "all").option("kafka.enable.idempotence", "true").option("topic", topic).save())


def topic_dynamic(df: DataFrame, path: str, topic: str, value: str = "value") -> None:
    """Append texts to the file topic named in each row."""
    df.select(topic, F.col(value).alias("value")).write.mode("append").partitionBy(topic).text(path)


def kafka_dynamic(df: DataFrame, servers: str, topic: str, value: str = "value") -> None:
    """Append texts to the topic named in each row."""
    (df.select(F.col(topic).alias("topic"), F.col(value).alias("value")).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").save())


def olap_append(df: DataFrame, path: str) -> None:
    """Append window results as JSON lines."""
    df.write.mode("append").json(path)


def table_append(df: DataFrame, path: str) -> None:
    """Append typed rows to a table."""
    df.write.mode("append").parquet(path)


def jdbc_append(df: DataFrame, url: str, name: str, **options: str) -> None:
    """Append typed rows to a database table."""
    df.write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()


def text_append(df: DataFrame, path: str) -> None:
    """Append one JSON text per row to UTF-8 text files."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(path)


def print_rows(df: DataFrame, rows: int = 20) -> StreamingQuery | None:
    """Print rows; a stream is printed batch by batch, and the running query is returned to be stopped."""
    if df.isStreaming:
        return df.writeStream.format("console").start()
    df.show(rows, truncate=False)
    return None


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch under its own folder; a repeated batch replaces itself, so nothing is written twice."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def upsert(df: DataFrame, path: str, batch_id: int, keys: list[str], order: list[str]) -> None:
    """Write the last row per key of one batch to a keyed table."""
    write_batch(last_rows(df, keys, order), path, batch_id)


def _batches(table: DataFrame) -> int:
    """How many batches the files of a table are from."""
    return len({part for file in table.inputFiles() for part in file.split("/") if part.startswith("batch=")})


def read_upserted(spark: SparkSession, path: str, keys: list[str], order: list[str],
                  deleted: Column | None = None) -> DataFrame:
    """The last row per key over all batches; rows for which ``deleted`` holds are gone.

    Each batch has one row per key, as :func:`upsert` wrote it with the same keys, so a table of a single batch is read as it lies.
    """
    table = spark.read.option("basePath", path).parquet(path)
    rows = table.drop("batch")
    if _batches(table) > 1:
        rows = last_rows(rows, keys, order)
    return rows if deleted is None else rows.where(~deleted)


def compact(spark: SparkSession, path: str, target: str, keys: list[str], order: list[str]) -> None:
    """Rewrite a keyed table into ``target`` as one batch; the merge deals it out by key, in as many files as it has parts."""
    write_batch(read_upserted(spark, path, keys, order), target, 0)


def dim_upsert(routed: DataFrame, path: str, batch_id: int) -> None:
    """Write the latest cells of one batch of routed changes to the dimension tables, all in one pass."""
    dim_cells(routed).write.mode("overwrite").partitionBy("sink_table").parquet(f"{path}/batch={batch_id}")


def read_dims(spark: SparkSession, path: str) -> DataFrame:
    """The dimension tables as rows ``sink_table, row_key, cells``.

    A batch has each cell once, as :func:`dim_upsert` wrote it, so the cells of a single batch are read as they lie.
    """
    table = spark.read.option("basePath", path).parquet(path)
    cells = table.select("sink_table", "row_key", "column", "value", "ts_ms")
    return dim_rows(merge_cells(cells) if _batches(table) > 1 else cells)


def delete_keys(dim: DataFrame, keys: DataFrame, key: str = "row_key") -> DataFrame:
    """A table without the rows under the given keys."""
    return dim.join(keys.select(key).distinct(), key, "left_anti")
