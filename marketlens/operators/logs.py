"""Splitting client logs into error, start, display, action and page records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def split_log_streams(logs: DataFrame, err_only: bool = False) -> dict[str, DataFrame]:
    """The five record kinds, each as its own DataFrame over the same input.

    An error log also goes on as start or page log, without its error. ``err_only`` keeps just the
    error object. Action records carry no time.
    """
    keep = [c for c in logs.columns if c == "row_id"]
    pages = logs.where("start IS NULL")
    errors = logs.where("err IS NOT NULL")
    return {
        "err": errors.select(*keep, "err") if err_only else errors,
        "start": logs.where("start IS NOT NULL").drop("err"),
        "display": pages.select(*keep, "common", "page", F.explode("displays").alias("display"), "ts"),
        "action": pages.select(*keep, "common", "page", F.explode("actions").alias("action")),
        "page": pages.select(*keep, "common", "page", "ts"),
    }


def tagged_log_lines(logs: DataFrame, err_only: bool = False) -> DataFrame:
    """All five kinds in one pass over the input: ``stream`` and the record as JSON text.

    Written with ``stream`` as partition or topic column, the log is read once for all sinks.
    """
    def line(tag: str, *cols: Column | str) -> Column:
        return F.struct(F.lit(tag).alias("stream"), F.to_json(F.struct(*cols)).alias("value"))

    def when(cond: Column, one: Column) -> Column:
        return F.when(cond, F.array(one)).otherwise(F.array())

    def each(items: str, tag: str, name: str, *rest: str) -> Column:
        entries = F.coalesce(F.transform(items, lambda x: line(tag, "common", "page", x.alias(name), *rest)), F.array())
        return F.when(F.col("start").isNull(), entries).otherwise(F.array())

    err = line("err", "common", "page", "start", "err", "displays", "actions", "ts")
    if err_only:
        err = F.struct(F.lit("err").alias("stream"), F.to_json("err").alias("value"))
    is_start = F.col("start").isNotNull()
    all_lines = F.concat(
        when(F.col("err").isNotNull(), err),
        when(is_start, line("start", "common", "start", "displays", "actions", "ts")),
        each("displays", "display", "display", "ts"), each("actions", "action", "action"),
        when(~is_start, line("page", "common", "page", "ts")))
    return logs.select(F.explode(all_lines).alias("l")).select("l.*")


def flat_logs(logs: DataFrame) -> DataFrame:
    """Nested page logs with the fields of ``common`` and ``page`` as columns and the time as ``ts_ms``."""
    keep = [c for c in logs.columns if c == "row_id"]
    return logs.select(*keep, "common.*", "page.*", F.col("ts").alias("ts_ms"))
