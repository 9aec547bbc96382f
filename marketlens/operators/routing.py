"""Config-driven routing of change records and the tables it feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.functions.scalars import is_empty, keep_keys, md5_key
from marketlens.operators.joins import as_of_join, equi_join

ROUTE_FIELDS = ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"]
DELETED = "__deleted"


def config_rows(changes: DataFrame) -> DataFrame:
    """Config changes as routes; a delete is read from its ``before`` image."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return changes.select(*[row[f].alias(f) for f in ROUTE_FIELDS], "op", "ts_ms")


def config_latest(changes: DataFrame) -> DataFrame:
    """The routes in force: the latest change per source table, deleted ones left out."""
    fields = [*ROUTE_FIELDS, "op"]
    return (config_rows(changes).groupBy("source_table")
            .agg(F.max_by(F.struct(*fields), F.struct("ts_ms", *fields[1:])).alias("r"))
            .select("r.*").where("op <> 'd'"))


def lifecycle_actions(changes: DataFrame) -> DataFrame:
    """What each config change asks of its sink table: create, drop, or drop and then create."""
    actions = (F.when(F.col("op").isin("r", "c"), F.array(F.lit("create")))
               .when(F.col("op") == "d", F.array(F.lit("drop")))
               .otherwise(F.array(F.lit("drop"), F.lit("create"))))
    return config_rows(changes).select(
        "sink_table", "sink_family", "op", "ts_ms", F.posexplode(actions).alias("step", "action"))


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def families(text: str | None) -> list[str]:
    """Column families of a config row, the first of which takes the cells."""
    return [f.strip() for f in (text or "info").split(",") if f.strip()] or ["info"]


def dim_table_lifecycle(spark: SparkSession, changes: DataFrame, database: str) -> dict[str, list[str]]:
    """Create and drop the tables of ``database`` so that they match the latest config; the tables now existing and
    their families.

    Only the last action per table counts. Tables are managed, so a table that is dropped and created anew is empty. Each
    family is a map of cells. The rows, one per table, come one by one; each is an action on the catalog.
    """
    last = (lifecycle_actions(changes).groupBy("sink_table")
            .agg(F.max_by(F.struct("op", "action", "sink_family"), F.struct("ts_ms", "step")).alias("last"))
            .select("sink_table", "last.*"))
    made = {}
    for row in last.toLocalIterator():
        name = _quoted(database, row.sink_table)
        if row.op in ("d", "u"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if row.action == "create":
            made[row.sink_table] = families(row.sink_family)
            columns = ", ".join(f"{_quoted(f)} MAP<STRING,STRING>" for f in made[row.sink_table])
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (row_key STRING, {columns}) USING parquet")
    return made


def write_dims(spark: SparkSession, rows: DataFrame, database: str, tables: dict[str, list[str]], path: str) -> None:
    """Put rows ``sink_table, row_key, cells`` into the tables of the lifecycle; ``path`` takes them in one pass first."""
    rows.write.partitionBy("sink_table").parquet(path)
    stored = spark.read.schema("row_key STRING, cells MAP<STRING,STRING>, sink_table STRING").parquet(path)
    for name, (first, *others) in tables.items():
        none = [F.lit(None).cast("map<string,string>").alias(f) for f in others]
        (stored.where(F.col("sink_table") == name).select("row_key", F.col("cells").alias(first), *none)
         .write.insertInto(_quoted(database, name)))


def read_dim_tables(spark: SparkSession, database: str, tables: dict[str, list[str]]) -> DataFrame:
    """All tables of the lifecycle as rows ``sink_table, row_key, cells``."""
    out = None
    for name, (first, *_) in sorted(tables.items()):
        part = spark.table(_quoted(database, name)).select(F.lit(name).alias("sink_table"), "row_key", F.col(first).alias("cells"))
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], "sink_table STRING, row_key STRING, cells MAP<STRING,STRING>") if out is None else out


def route_dim_by_config(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Changes of routed tables, payload cut down to the configured columns.

    Deletes carry their ``before`` image, so that the row key is known.
    """
    rows = changes.select(
        F.col("source")["table"].alias("source_table"), "op", "ts_ms",
        F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")).alias("payload"))
    routed = equi_join(rows, routes.select(*ROUTE_FIELDS), ["source_table"])
    return routed.where("payload IS NOT NULL").select(
        "source_table", "sink_table", "sink_family", F.element_at("payload", F.col("sink_row_key")).alias("row_key"),
        "op", "ts_ms", keep_keys("payload", "sink_columns").alias("data"))


def config_versions(changes: DataFrame, preload: DataFrame | None = None) -> DataFrame:
    """All versions of the config, each from its ``ts_ms`` on. Preloaded routes hold from the first, so every change wins over them."""
    versions = config_rows(changes)
    if preload is None:
        return versions
    start = preload.select(*ROUTE_FIELDS, F.lit("r").alias("op"), F.lit(-(1 << 62)).cast("bigint").alias("ts_ms"))
    return versions.unionByName(start)


def route_dim_as_of(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """Changes routed by the config that was in force at their time; a deleted route routes nothing until it comes back."""
    rows = changes.select(
        F.col("source")["table"].alias("source_table"), "op", "ts_ms",
        F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")).alias("payload"))
    routed = as_of_join(rows, versions.withColumnsRenamed({"ts_ms": "since", "op": "config_op"}), ["source_table"], "ts_ms", "since", "r")
    return routed.where("r IS NOT NULL AND r.config_op <> 'd' AND payload IS NOT NULL").select(
        "source_table", "r.sink_table", "r.sink_family", F.element_at("payload", F.col("r.sink_row_key")).alias("row_key"),
        "op", "ts_ms", keep_keys("payload", "r.sink_columns").alias("data"))


def route_fact_by_config(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Older change records (``table, type, ts, data``) by table and type, ``ts`` added to the payload."""
    rows = changes.select(F.col("table").alias("source_table"), F.col("type").alias("source_type"), "ts", "data")
    routed = equi_join(rows, routes, ["source_table", "source_type"])
    return routed.select("source_table", "source_type", "sink_table", F.map_concat(
        F.map_filter(keep_keys("data", "sink_columns"), lambda k, _: k != "ts"),
        F.create_map(F.lit("ts"), F.col("ts").cast("string"))).alias("data"))


def route_dim_md5(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Puts with the md5 of the key as row key and all columns kept; null becomes the text null, deletes are left out."""
    rows = changes.where("op <> 'd' AND after IS NOT NULL").select(
        F.col("source")["table"].alias("source_table"), "ts_ms", "after")
    routed = equi_join(rows, routes.select(*ROUTE_FIELDS), ["source_table"])
    return routed.select(
        "source_table", "sink_table", md5_key(F.element_at("after", F.col("sink_row_key"))).alias("row_key"), "ts_ms",
        F.transform_values("after", lambda _, v: F.coalesce(v, F.lit("null"))).alias("data"))


def dim_cells(routed: DataFrame) -> DataFrame:
    """Latest value per cell: ``sink_table, row_key, column, value, ts_ms``.

    Empty values are no puts, so an older cell survives them. A delete is kept as one marker cell.
    """
    keys = ["sink_table", "row_key", "ts_ms"]
    op = F.col("op") if "op" in routed.columns else F.lit("c")
    cells = F.when(op == "d", F.create_map(F.lit(DELETED), F.lit("1"))).otherwise(F.col("data"))
    return (routed.select(*keys, F.explode(cells).alias("column", "value")).where(~is_empty("value"))
            .groupBy("sink_table", "row_key", "column")
            .agg(F.max(F.struct("ts_ms", "value")).alias("last"))
            .select("sink_table", "row_key", "column", "last.value", "last.ts_ms"))


def merge_cells(cells: DataFrame) -> DataFrame:
    """Cells from several batches to the latest value of each."""
    return (cells.groupBy("sink_table", "row_key", "column")
            .agg(F.max(F.struct("ts_ms", "value")).alias("last"))
            .select("sink_table", "row_key", "column", "last.value", "last.ts_ms"))


def dim_rows(cells: DataFrame) -> DataFrame:
    """Cells to rows ``sink_table, row_key, cells``; cells no newer than a delete of their row are gone.

    A row has as many cells as its table has columns, so the lists stay short.
    """
    entry = F.struct("column", "value", "ts_ms")
    rows = cells.groupBy("sink_table", "row_key").agg(
        F.max(F.when(F.col("column") == DELETED, F.col("ts_ms"))).alias("gone"),
        F.collect_list(F.when(F.col("column") != DELETED, entry)).alias("cells"))
    live = F.filter("cells", lambda c: F.col("gone").isNull() | (c["ts_ms"] > F.col("gone")))
    return rows.select("sink_table", "row_key", F.map_from_entries(F.transform(
        live, lambda c: F.struct(c["column"], c["value"]))).alias("cells")).where(F.size("cells") > 0)
