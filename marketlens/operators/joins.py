"""Joins: equi joins that stand skew, dimension lookups and interval joins.

A key may hold a large share of all rows. Adaptive execution splits the large partitions of a join while it runs, whatever
the size of the inputs, on either side of an inner join and on the left of a left join; so joins stay plain, each side
is evaluated once, and the planner alone decides on broadcasts. What it cannot split are null keys of a left join,
which match nothing and yet meet in one task: they are spread by the content of their rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType


def _hashable(kind) -> bool:
    """Whether Spark can hash values of the type (maps have no order)."""
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return _hashable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def equi_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", null_keys: bool = True,
              clustered: bool = False) -> DataFrame:
    """Inner or left equi join on equally named columns.

    ``null_keys`` false says that the left keys are never null, so that partitionings on them can be used again. ``clustered`` says that
    the left rows of a key come out of one task, as after a grouping by it; they are dealt out by their content first,
    since adaptive execution splits between the tasks that rows come from. In a left join the right side has few rows per key (one, for a lookup): only the left side of a hot key is split.
    """
    content = [f.name for f in left.schema.fields if _hashable(f.dataType)]
    if clustered:
        left = left.repartition(F.xxhash64(*content))
    if how != "left" or not null_keys or left.isStreaming or right.isStreaming:
        return left.join(right, on, how)
    empty = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    spread = F.when(empty, F.xxhash64(*content)).otherwise(F.lit(0).cast("long"))
    out = left.withColumn("_null_key", spread).join(right.withColumn("_null_key", F.lit(0).cast("long")), [*on, "_null_key"], how)
    return out.drop("_null_key")


@dataclass(frozen=True)
class DimSpec:
    """A dimension table, its key, and the columns it adds under which names."""

    table: DataFrame
    key: str
    columns: dict[str, str]
    defaults: dict[str, str] = field(default_factory=dict)


def dim_lookup(df: DataFrame, spec: DimSpec, by: str) -> DataFrame:
    """Left lookup: rows without a match pass with nulls or the defaults of the spec."""
    dim = spec.table.select(F.col(spec.key).alias(by), *[F.col(c).alias(n) for c, n in spec.columns.items()])
    out = equi_join(df, dim, [by], "left")
    added = {n: F.coalesce(n, F.lit(v)) for n, v in spec.defaults.items()}
    return out.withColumns(added) if added else out


def first_match(dim: DataFrame, name: str, value: str, order: str) -> DataFrame:
    """One row per ``name``: the ``value`` with the smallest ``order``."""
    return dim.groupBy(name).agg(F.min_by(value, F.struct(order, value)).alias(value))


def interval_join(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str,
                  before_ms: int, after_ms: int) -> DataFrame:
    """Inner join of rows with equal keys and ``right_ts`` within ``left_ts - before .. left_ts + after``.

    Time is cut into pieces as long as the interval; a left row meets at most two pieces, so a hot key is
    spread over time and only near rows are compared.
    """
    width = F.lit(max(before_ms + after_ms, 1)).cast("bigint")
    piece = lambda ms: ms - F.pmod(ms, width)
    lts, rts = F.col(left_ts), F.col(right_ts)
    lhs = left.withColumn("_piece", F.explode(F.sequence(piece(lts - before_ms), piece(lts + after_ms), width)))
    rhs = right.withColumn("_piece", piece(rts))
    return (equi_join(lhs, rhs, [*on, "_piece"])
            .where((rts >= lts - before_ms) & (rts <= lts + after_ms)).drop("_piece"))


def near_values(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, within_ms: int,
                values: list[str]) -> DataFrame:
    """Left rows with each different combination of ``values`` that some right row of equal keys has within ``within_ms``.

    An existence join: no pairs are made. Time is cut into pieces as long as the range, and the right rows of a piece with the same keys
    and values are summed up by their first and last time. Of the piece of the left time every row is near; of the one before it some row is
    near if its last is, of the one after it if its first is. So a left row meets at most three summaries of each combination,
    however many rows a key has. Repeated results are dropped, whether by copies on the left or by several summaries.
    """
    width = F.lit(max(within_ms, 1)).cast("bigint")
    piece = lambda ms: F.floor(ms / width).cast("bigint")
    lts, rts = F.col(left_ts), F.col(right_ts)
    spans = right.groupBy(*on, piece(rts).alias("_piece"), *values).agg(F.min(rts).alias("_first"), F.max(rts).alias("_last"))
    near = left.dropDuplicates().withColumn("_piece", F.explode(F.sequence(piece(lts) - 1, piece(lts) + 1)))
    found = equi_join(near, spans, [*on, "_piece"]).where(
        (F.col("_last") >= lts - within_ms) & (F.col("_first") <= lts + within_ms))
    return found.select(*left.columns, *values).dropDuplicates()


def as_of_join(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, name: str,
               piece_ms: int = 86_400_000) -> DataFrame:
    """Left rows with the newest right row of equal keys that is not newer, as struct ``name``; null where there is none.

    Rows of the same time are settled by their other columns, which must be sortable. Time is cut into pieces: a piece of a key holds the
    right rows in it and the last one before it, so that a left row looks at those only, and a hot key is spread over time.
    """
    width = F.lit(piece_ms).cast("bigint")
    piece = lambda ms: F.floor(ms / width).cast("bigint")
    rest = [c for c in right.columns if c not in (*on, right_ts)]
    row = F.struct(F.col(right_ts).alias("_at"), *rest)
    inside = right.groupBy(*on, piece(F.col(right_ts)).alias("_piece")).agg(F.collect_set(row).alias("_rows"), F.max(row).alias("_last"))
    asked = left.select(*on, piece(F.col(left_ts)).alias("_piece")).distinct()
    pieces = inside.unionByName(asked, allowMissingColumns=True).groupBy(*on, "_piece").agg(
        F.first("_rows", ignorenulls=True).alias("_rows"), F.max("_last").alias("_last"))
    before = Window.partitionBy(*on).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    known = pieces.select(*on, "_piece", "_rows", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    found = equi_join(left.withColumn("_piece", piece(F.col(left_ts))), known, [*on, "_piece"], "left")
    here = F.array_max(F.filter("_rows", lambda r: r["_at"] <= F.col(left_ts)))
    best = F.coalesce(here, F.col("_before"))
    value = F.when(best.isNotNull(), F.struct(best["_at"].alias(right_ts), *[best[c].alias(c) for c in rest]))
    return found.select(*left.columns, value.alias(name))


def stream_interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str,
                         right_ts: str, before: str, after: str, delay: str = "5 seconds") -> DataFrame:
    """The same for two streams whose time columns are timestamps; all column names must differ."""
    near = F.expr(f"{right_ts} >= {left_ts} - INTERVAL {before} AND {right_ts} <= {left_ts} + INTERVAL {after}")
    return left.withWatermark(left_ts, delay).join(
        right.withWatermark(right_ts, delay), (F.col(left_key) == F.col(right_key)) & near)


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Put ``prefix`` before all column names but those in ``keep``."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def word_membership(words: DataFrame, word_set: DataFrame, by: str = "word") -> DataFrame:
    """Words with a flag: in the set or not."""
    return (equi_join(words, word_set.select(F.col("word").alias(by), F.lit(True).alias("in_set")), [by], "left")
            .withColumn("in_set", F.coalesce("in_set", F.lit(False))))


def words_of(df: DataFrame, text: str, keep: list[str | Column]) -> DataFrame:
    """One row per word of ``text``, lower case, split at everything but letters and digits."""
    pieces = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return df.select(*keep, F.explode(pieces).alias("word")).where("word <> ''")
