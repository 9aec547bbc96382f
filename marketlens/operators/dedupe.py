"""Removing repeated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketlens.operators.keyed import first_rows


def dedup_latest_ts(df: DataFrame, key: str, ts: str, arrival: str, piece: int = 100_000) -> DataFrame:
    """Rows that are newer than all rows of their key that arrived before.

    ``arrival`` is a number that tells the rows of a key apart, such as an offset. The running maximum is
    built from pieces of at most ``piece`` arrivals; only one row per piece is carried over.
    """
    rows = df.withColumn("_piece", F.col(arrival) - F.pmod(F.col(arrival), F.lit(piece).cast("bigint")))
    tops = rows.groupBy(key, "_piece").agg(F.max(ts).alias("_top"))
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(key, "_piece", F.max("_top").over(earlier).alias("_carried"))
    here = Window.partitionBy(key, "_piece").orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    seen = F.greatest(F.max(ts).over(here), "_carried")
    return (rows.join(tops, [key, "_piece"]).withColumn("_seen", seen)
            .where(F.col("_seen").isNull() | (F.col(ts) > F.col("_seen"))).select(*df.columns))


def dedup_latest_detail(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The same rule when rows arrive in the order of ``ts``: the first row per key and time.

    Rows that tie are told apart by their content.
    """
    rest = [c for c in df.columns if c not in (key, ts)]
    return first_rows(df, [key, ts], rest).select(*df.columns)


def dedup_full_row(df: DataFrame) -> DataFrame:
    """Drop exact repeats; copies combine before the shuffle."""
    return df.dropDuplicates()


def dedup_keys(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Exact form of the probabilistic key filter: the first row per composite key, none lost."""
    return first_rows(df, keys, order).select(*df.columns)
