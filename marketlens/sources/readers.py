"""Sources: topics, files, change logs, dimension tables and databases."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlens.functions.clock import ntz_of
from marketlens.functions.scalars import snake_to_camel
from marketlens.sources.schemas import CHANGE, LOG, ORDER_DETAIL


def local_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of literals whose size the planner knows; ``schema`` lists ``name STRING|BIGINT``."""
    kinds = {"STRING": pa.string(), "BIGINT": pa.int64()}
    fields = [f.split() for f in schema.split(",")]
    columns = [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=[name for name, _ in fields]))


def topic_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Topic of text records from the earliest offset; a null value stays null."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").load()
            .select(F.col("value").cast("string").alias("value"), "timestamp"))


def line_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Folder of text files as a stream of lines, each file read once."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Folder of text files, one record per line."""
    return spark.read.text(path)


def parse_json(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Parse the JSON text in ``value``; its fields become columns, other columns stay."""
    rest = [c for c in df.columns if c != value]
    return df.select(*rest, F.from_json(value, schema).alias("_r")).select(*rest, "_r.*")


def split_dirty(df: DataFrame, schema: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parse ``value``; second result holds the texts that are no valid record."""
    rest = [c for c in df.columns if c != value]
    parsed = df.select(*rest, F.col(value), F.from_json(
        value, f"{schema}, _corrupt_record STRING", {"mode": "PERMISSIVE"}).alias("_r"))
    bad = F.col("_r._corrupt_record").isNotNull()
    clean = parsed.where(F.col(value).isNotNull() & ~bad).select(*rest, "_r.*").drop("_corrupt_record")
    return clean, parsed.where(bad).select(*rest, value)


def drop_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    """Leave out null messages."""
    return df.where(F.col(value).isNotNull())


def envelope_table(df: DataFrame) -> DataFrame:
    """Change-log texts as a table ``op, before, after, source, ts_ms``."""
    return parse_json(drop_tombstones(df).select("value"), CHANGE)


def page_log_table(df: DataFrame, delay: str = "3 seconds") -> DataFrame:
    """Page-log texts as a table with event time ``rt`` and a watermark (streams only)."""
    rows = parse_json(drop_tombstones(df).select("value"), LOG)
    if df.isStreaming:
        return rows.withColumn("rt", F.timestamp_millis("ts")).withWatermark("rt", delay)
    return rows.withColumn("rt", ntz_of("ts"))


def order_detail_table(df: DataFrame) -> DataFrame:
    """Order-detail fact texts as a table of 17 columns."""
    return parse_json(drop_tombstones(df).select("value"), ORDER_DETAIL)


def _row_map(df: DataFrame) -> Column:
    """A table row as a map of texts: decimals as doubles, dates as epoch days."""
    def text(field) -> Column:
        c = F.col(field.name)
        kind = field.dataType.typeName()
        if kind == "decimal":
            c = c.cast("double")
        elif kind == "date":
            c = F.datediff(c, F.lit("1970-01-01").cast("date"))
        return c.cast("string")

    return F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), text(f))])


def _change_source(db: str, name: str) -> Column:
    return F.create_map(F.lit("db"), F.lit(db), F.lit("table"), F.lit(name)).alias("source")


def snapshot_as_changes(df: DataFrame, db: str, name: str, ts_ms: Column) -> DataFrame:
    """Table rows as snapshot changes: op r, decimals as doubles, dates as epoch days."""
    return df.select(
        F.lit("r").alias("op"), F.lit(None).cast("map<string,string>").alias("before"), _row_map(df).alias("after"),
        _change_source(db, name), ts_ms.cast("bigint").alias("ts_ms"))


def snapshot_difference(old: DataFrame, new: DataFrame, key: str, db: str, name: str, ts_ms: Column) -> DataFrame:
    """What happened between two snapshots of a table: creates, updates and deletes with the row before and after.

    Rows are matched by their key in one full outer join; equal rows are no change. Both have the same columns.
    """
    values = lambda m: F.array_sort(F.map_entries(m))
    before = old.select(F.col(key).alias("_k"), _row_map(old).alias("before"))
    after = new.select(F.col(key).alias("_k"), _row_map(new).alias("after"))
    op = F.when(F.col("before").isNull(), "c").when(F.col("after").isNull(), "d").otherwise("u")
    same = F.coalesce(F.to_json(values(F.col("before"))) == F.to_json(values(F.col("after"))), F.lit(False))
    return before.join(after, "_k", "full").where(~same).select(
        op.alias("op"), "before", "after", _change_source(db, name), ts_ms.cast("bigint").alias("ts_ms"))


def hand_over(snapshot: DataFrame, marks: DataFrame, log: DataFrame) -> DataFrame:
    """A table read range by range while it changed, and its change log, as one change stream without gap or repetition.

    ``snapshot``: key, part, after (the row as text map), with the number of the key range it was read in; ``marks``: part, low, high, the position of
    the log before and after the range was read; ``log``: position, key, part (of its key), op, before, after, ts_ms. A change up
    to ``low`` is in the snapshot. Of the changes of a key up to ``high`` the last one stands for what was read, which may
    have been before or after it. Later ones follow as they are. So every key has at most one version (op r) at the hand-over, and
    further changes after it. Columns: key, op, before, after, ts_ms (null for rows as read), position (null at the hand-over).
    """
    placed = log.join(marks, "part").where("position > low")
    change = F.struct("position", "op", "after", "ts_ms")
    during = placed.where("position <= high").groupBy("key").agg(F.max_by(change, "position").alias("c"))
    rows = snapshot.select("key", F.col("after").alias("read")).join(during, "key", "full")
    start = rows.where("c IS NULL OR c.op <> 'd'").select(
        "key", F.lit("r").alias("op"), F.lit(None).cast("map<string,string>").alias("before"),
        F.when(F.col("c").isNull(), F.col("read")).otherwise(F.col("c.after")).alias("after"), "c.ts_ms",
        F.lit(None).cast("bigint").alias("position"))
    after = placed.where("position > high").select("key", "op", "before", "after", "ts_ms", "position")
    return start.unionByName(after)


def dim_table(df: DataFrame, key: str, family: str = "info") -> DataFrame:
    """Keyed dimension table: text key and one struct of text cells."""
    cells = [F.col(c).cast("string").alias(c) for c in df.columns if c != key]
    return df.select(F.col(key).cast("string").alias(key), F.struct(*cells).alias(family))


def dim_get(df: DataFrame, key: str, value: str, camel: bool = False) -> DataFrame:
    """The row of a dimension table under one key."""
    row = df.where(F.col(key) == value)
    return snake_to_camel(row) if camel else row


def dim_scan_limit(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The first rows by row key, with the key as ``row_key``."""
    return df.withColumn("row_key", F.col(key)).orderBy("row_key").limit(limit)


def jdbc_query(spark: SparkSession, url: str, query: str, camel: bool = False,
               pieces: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """Result of a database query, columns named by their labels.

    ``pieces`` names a numeric column of the result, its lowest and highest value, and into how many ranges, each
    read by its own task, to cut it; without them one task reads the whole result.
    """
    if pieces is None:
        options["query"] = query
    else:
        column, low, high, n = pieces
        options |= {"dbtable": f"({query}) pieces", "partitionColumn": column, "lowerBound": str(low),
                    "upperBound": str(high), "numPartitions": str(n)}
    df = spark.read.format("jdbc").options(url=url, **options).load()
    return snake_to_camel(df) if camel else df


def table_query(spark: SparkSession, query: str, camel: bool = False, **tables: DataFrame) -> DataFrame:
    """Result of a SQL query over named DataFrames, columns named by their labels."""
    df = spark.sql(query, **tables)
    return snake_to_camel(df) if camel else df


def region_codes(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``code province,city,area`` as four columns; missing parts are null."""
    parts = F.split("origin", ",", 3)
    part = lambda i: F.try_element_at(parts, F.lit(i))
    return (spark.read.schema("code BIGINT, origin STRING").option("sep", " ").csv(path)
            .select("code", part(1).alias("province"), part(2).alias("city"), part(3).alias("area")))


def word_lists(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of all ``.txt`` files in a folder, split on commas and line ends."""
    return (spark.read.option("pathGlobFilter", "*.txt").text(path)
            .select(F.explode(F.split("value", "[,\r\n]+")).alias("word"))
            .select(F.trim("word").alias("word")).where("word <> ''").distinct())
