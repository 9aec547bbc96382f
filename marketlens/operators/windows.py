"""Tumbling windows and the aggregates over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.clock import ts_to_date, ts_to_datetime, window_start


def tumble(df: DataFrame, seconds: int, keys: list[str], aggs: list[Column], ts: str = "ts_ms") -> DataFrame:
    """Group by window and keys; the window start is ``window_ms``."""
    return df.groupBy(window_start(ts, seconds).alias("window_ms"), *keys).agg(*aggs)


def tumble_stream(df: DataFrame, seconds: int, keys: list[str], aggs: list[Column], ts: str = "ts_ms",
                  delay: str = "0 seconds") -> DataFrame:
    """The same for a stream, with a watermark ``delay`` behind the newest time seen; late rows are dropped."""
    if "rt" not in df.columns:
        df = df.withColumn("rt", F.timestamp_millis(ts))
        df = df.withWatermark("rt", delay)
    w = F.window("rt", f"{seconds} seconds")
    out = df.groupBy(w.alias("_w"), *keys).agg(*aggs)
    return out.withColumn("window_ms", F.unix_millis("_w.start")).drop("_w")


def with_window_text(df: DataFrame, seconds: int, zone: str = "UTC") -> DataFrame:
    """Replace ``window_ms`` by ``stt``, ``edt`` and ``cur_date``."""
    rest = [c for c in df.columns if c != "window_ms"]
    start = F.col("window_ms")
    return df.select(ts_to_datetime(start, zone).alias("stt"),
                     ts_to_datetime(start + seconds * 1000, zone).alias("edt"),
                     ts_to_date(start, zone).alias("cur_date"), *rest)


def count_window(df: DataFrame, seconds: int, name: str, keys: list[str] | None = None, ts: str = "ts_ms") -> DataFrame:
    """Rows per window."""
    return tumble(df, seconds, keys or [], [F.count("*").alias(name)], ts)


def sum_window(df: DataFrame, seconds: int, keys: list[str], sums: list[str], ts: str = "ts_ms") -> DataFrame:
    """Sums per window and keys."""
    return tumble(df, seconds, keys, [F.sum(s).alias(s) for s in sums], ts)


def decimal_sums(columns: dict[str, str]) -> list[Column]:
    """Exact sums of amounts given as text: source column to result name."""
    return [F.sum(F.col(c).try_cast("decimal(38,4)")).alias(n) for c, n in columns.items()]


def union_sums(parts: list[DataFrame], keys: list[str], sums: list[str]) -> DataFrame:
    """Add up partial results that each hold some of the ``sums``."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in sums])


def last_in_window(df: DataFrame, key: str, order: list[str], seconds: int, ts: str = "ts_ms") -> DataFrame:
    """The last row per key and window."""
    rest = [c for c in df.columns if c != key]
    return (df.withColumn("window_ms", window_start(ts, seconds)).groupBy(key, "window_ms")
            .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "window_ms", "_r.*"))


def run_summary(rows: DataFrame, keep: int = 100) -> DataFrame:
    """One report row of a crawl: totals, first start, last end, and the first ``keep`` failed codes.

    Only the failed codes of the report itself are gathered; the full list stays in the rows.
    """
    totals = rows.agg(F.count(F.when(F.col("ok"), 1)).alias("success_count"),
                      F.count(F.when(~F.col("ok"), 1)).alias("fail_count"),
                      F.min("report_time").alias("start_time"), F.max("report_time").alias("end_time"))
    failed = rows.where(~F.col("ok")).select("code").orderBy("code").limit(keep).agg(
        F.array_join(F.array_sort(F.collect_list("code")), ",").alias("failed_cities"))
    both = totals.unionByName(failed, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
