"""Batch forms of the per-key state rules: first visits, corrections, retractions, running profiles.

None of them sorts all rows of a key in one task. First and last rows are found by aggregates that combine
before the shuffle; a flag goes back to its row by the unique ``row_id`` (topic offset, event id or file
position), which spreads evenly; running values are built from short time pieces of a key, put together in groups and
groups of groups. Keys must not be null, as in any keyed stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from marketlens.functions.clock import DAY_MS, day_diff, ts_to_date
from marketlens.functions.scalars import is_empty, negate_amount
from marketlens.operators.filters import filter_home_detail, filter_login_page
from marketlens.operators.joins import equi_join
from marketlens.session import stored


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def _end_rows(df: DataFrame, keys: list[str], order: list[str], first: bool) -> DataFrame:
    fields = [c for c in order if c not in keys] + [c for c in df.columns if c not in keys and c not in order]
    if all(_orderable(df.schema[c].dataType) for c in fields):
        # One struct serves as order and as payload; ties are settled by the other columns.
        best = (F.min if first else F.max)(F.struct(*fields))
    else:
        best = (F.min_by if first else F.max_by)(F.struct(*fields), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key by ``order``, which must tell all rows apart (or tie only exact copies)."""
    return _end_rows(df, keys, order, first=True)


def last_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key by ``order``."""
    return _end_rows(df, keys, order, first=False)


def mark_rows(df: DataFrame, ids: DataFrame, row_id: str, flag: str) -> DataFrame:
    """Add ``flag`` = 1 to the rows named in ``ids`` and 0 to the others."""
    marked = df.join(ids.select(row_id, F.lit(1).cast("bigint").alias(flag)), row_id, "left")
    return marked.withColumn(flag, F.coalesce(flag, F.lit(0).cast("bigint")))


def first_dates(logs: DataFrame, order: list[str], zone: str = "UTC") -> DataFrame:
    """First day of each device as ``first_date``, and the time of its last log as ``ts_ms``.

    A first log that is not marked new puts the first day before it.
    """
    first = logs.groupBy("mid").agg(F.min_by(F.struct("is_new", "ts_ms"), F.struct(*order)).alias("_f"), F.max("ts_ms").alias("ts_ms"))
    seen = F.col("_f.ts_ms") - F.when(F.col("_f.is_new") == "1", 0).otherwise(DAY_MS)
    return first.select("mid", ts_to_date(seen, zone).alias("first_date"), "ts_ms")


def fix_is_new(logs: DataFrame, order: list[str], zone: str = "UTC") -> DataFrame:
    """Correct the new-visitor mark: a device is new only on the day of its first log (see :func:`first_dates`)."""
    first = first_dates(logs, order, zone).select("mid", F.col("first_date").alias("_first_date"))
    old = (F.col("is_new") == "1") & (ts_to_date("ts_ms", zone) != F.col("_first_date"))
    return (equi_join(logs, first, ["mid"], "left")
            .withColumn("is_new", F.when(old, F.lit("0")).otherwise(F.col("is_new")))
            .select(*logs.columns))


def first_of_day(df: DataFrame, keys: list[str], order: list[str], zone: str = "UTC", ts: str = "ts_ms") -> DataFrame:
    """The first row per key and day, with the day as ``visit_date``."""
    return first_rows(df.withColumn("visit_date", ts_to_date(ts, zone)), [*keys, "visit_date"], order)


def uv_daily_flag(logs: DataFrame, row_id: str = "row_id", zone: str = "UTC") -> DataFrame:
    """Visitor measures per page log: first visit of the day, session start, page view, time spent."""
    day = F.struct("mid", ts_to_date("ts_ms", zone).alias("visit_date"))
    firsts = logs.groupBy(day.alias("_day")).agg(F.min(F.struct("ts_ms", row_id)).alias("_f")).select(f"_f.{row_id}")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return mark_rows(logs, firsts, row_id, "uv_ct").withColumns({
        "sv_ct": F.when(is_empty("last_page_id"), one).otherwise(zero), "pv_ct": one,
        "dur_sum": F.coalesce("during_time", zero)})


def uv_home_detail(logs: DataFrame, order: list[str], zone: str = "UTC") -> DataFrame:
    """First visits of the day to the home page and to product pages."""
    firsts = first_of_day(filter_home_detail(logs).select("mid", "page_id", *order), ["mid", "page_id"], order, zone)
    home = (F.col("page_id") == "home").cast("bigint")
    return firsts.select("mid", "ts_ms", home.alias("home_uv_ct"), (1 - home).alias("good_detail_uv_ct"))


def uu_login_back(logs: DataFrame, order: list[str], zone: str = "UTC", back_days: int = 8) -> DataFrame:
    """First login of each user and day; ``back_ct`` = 1 after a gap of ``back_days`` whole days.

    The window below holds one row per user and day.
    """
    firsts = first_of_day(filter_login_page(logs).select("uid", *order), ["uid"], order, zone)
    before = F.lag("visit_date").over(Window.partitionBy("uid").orderBy("visit_date"))
    back = F.coalesce((day_diff("ts_ms", before, zone) >= back_days).cast("bigint"), F.lit(0).cast("bigint"))
    return firsts.select("uid", "ts_ms", F.lit(1).cast("bigint").alias("uu_ct"), back.alias("back_ct"))


def uu_cart(carts: DataFrame, order: list[str], zone: str = "UTC") -> DataFrame:
    """The first cart row of each user and day."""
    return first_of_day(carts, ["user_id"], order, zone).drop("visit_date")


def retract_previous(facts: DataFrame, key: str, order: list[str], row_id: str, amount: str) -> DataFrame:
    """Each version of a row, and the negative of every version that a later one replaces.

    The negative keeps the time of the version it takes back.
    """
    last = facts.groupBy(key).agg(F.max(F.struct(*dict.fromkeys([*order, row_id]))).alias("_l")).select(f"_l.{row_id}")
    amounts = F.when(F.col("_last") == 1, F.array(amount)).otherwise(F.array(F.col(amount), negate_amount(amount)))
    return (mark_rows(facts, last, row_id, "_last").withColumn(amount, F.explode(amounts))
            .select(*facts.columns))


def debounce_last(facts: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last version of each row."""
    return last_rows(facts, [key], order)


#: Pieces put together per step of a prefix: no window holds more rows of a key than that.
PREFIX_WIDTH = 256
_HORIZON_MS = 1 << 40


def _pieces(ts: str, piece_ms: int) -> Column:
    return F.col(ts) - F.pmod(F.col(ts), F.lit(piece_ms).cast("bigint"))


def first_seen(df: DataFrame, key: str, ts: str, sets: list[str]) -> DataFrame:
    """Per key and ``_piece``: rows ``_n``, last time ``_ts``, and per set the values that appear there for the first time."""
    pieces = df.groupBy(key, "_piece").agg(
        F.count("*").alias("_n"), F.max(ts).alias("_ts"), *[F.collect_set(s).alias(s) for s in sets])
    tagged = lambda s: F.transform(s, lambda v: F.struct(F.lit(s).alias("f"), v.alias("v")))
    values = pieces.select(key, "_piece", F.explode(F.concat(*[tagged(s) for s in sets])).alias("_p"))
    since = values.groupBy(key, "_p").agg(F.min("_piece").alias("_piece"))
    both = pieces.select(key, "_piece", "_n", "_ts").unionByName(since, allowMissingColumns=True)
    return both.groupBy(key, "_piece").agg(
        F.max("_n").alias("_n"), F.max("_ts").alias("_ts"),
        *[F.collect_list(F.when(F.col("_p.f") == s, F.col("_p.v"))).alias(s) for s in sets])


def prefix_levels(leaves: DataFrame, key: str, sets: list[str], piece_ms: int, width: int = PREFIX_WIDTH) -> list[DataFrame]:
    """Sums of the pieces of a key (``_n``, values first seen), over groups of ``width`` of them, groups of groups, and so on.

    Each row names its ``_node`` and the ``_parent`` that holds up to ``width`` nodes; a value stands in one node per level.
    The last level is so coarse that a key has at most about ``width`` nodes on it in thirty years. Levels that others are made of are
    stored: left to the planner, each level would read the rows and sum up the levels below anew.
    """
    above = (F.col("_node") / width).cast("double")
    with_parent = lambda df: df.withColumn("_parent", F.floor(above))
    levels, span = [with_parent(leaves.withColumn("_node", F.floor(F.col("_piece") / piece_ms)))], piece_ms
    while span * width < _HORIZON_MS:
        span *= width
        levels[-1] = stored(levels[-1], "pieces")
        levels.append(with_parent(levels[-1].groupBy(key, F.col("_parent").alias("_node")).agg(
            F.sum("_n").alias("_n"), *[F.flatten(F.collect_list(s)).alias(s) for s in sets])))
    return levels


def prefix_state(leaves: DataFrame, key: str, sets: list[str], piece_ms: int, width: int = PREFIX_WIDTH) -> DataFrame:
    """The pieces with what their key had before them: ``_seen_n`` rows and the values ``_seen_<set>``.

    What comes before a piece is what comes before its group plus the pieces before it in the group, and so on upwards. Each
    window below holds the at most ``width`` nodes of one group, and each join the pieces of one group, however many
    pieces a key has; a list is put together once for each row of the result.
    """
    none = F.array().cast("array<string>")
    before = None
    for level, rows in reversed(list(enumerate(prefix_levels(leaves, key, sets, piece_ms, width)))):
        group = [key] if before is None else [key, "_parent"]
        over = Window.partitionBy(*group).orderBy("_node").rowsBetween(Window.unboundedPreceding, -1)
        own = ["_piece", "_n", "_ts", *sets] if level == 0 else []
        here = rows.select(key, "_node", "_parent", *own, F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_seen_n"), *[
            F.flatten(F.collect_list(F.when(F.size(s) > 0, F.col(s))).over(over)).alias(f"_seen_{s}") for s in sets])
        if before is not None:
            up = before.select(key, F.col("_node").alias("_parent"), F.col("_seen_n").alias("_up_n"),
                               *[F.col(f"_seen_{s}").alias(f"_up_{s}") for s in sets])
            here = here.join(up, [key, "_parent"]).select(
                key, "_node", "_parent", *own, (F.col("_up_n") + F.col("_seen_n")).alias("_seen_n"),
                *[F.concat(F.coalesce(f"_up_{s}", none), F.coalesce(f"_seen_{s}", none)).alias(f"_seen_{s}") for s in sets])
        before = here
    return before.drop("_node", "_parent")


def running_profile(df: DataFrame, key: str, ts: str, row_id: str, sets: list[str], piece_ms: int = 1000,
                    width: int = PREFIX_WIDTH) -> DataFrame:
    """Per row: page views of the user so far and the distinct values seen so far, as comma lists.

    The rows of a piece of a key meet in one window; what came before them is carried as :func:`prefix_state`.
    """
    rows = df.select(key, ts, row_id, *sets, _pieces(ts, piece_ms).alias("_piece"))
    state = prefix_state(first_seen(rows, key, ts, sets), key, sets, piece_ms, width).drop("_n", "_ts", *sets)
    here = Window.partitionBy(key, "_piece").orderBy(ts, row_id)
    grown = lambda s: F.array_union(
        F.coalesce(f"_seen_{s}", F.array().cast("array<string>")),
        F.collect_set(s).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.join(state, [key, "_piece"]).select(
        key, ts, row_id, (F.col("_seen_n") + F.row_number().over(here)).cast("bigint").alias("pv"),
        *[F.array_join(F.array_sort(grown(s)), ",").alias(s) for s in sets])


def window_profile(df: DataFrame, key: str, ts: str, sets: list[str], window_ms: int = 120_000,
                   width: int = PREFIX_WIDTH) -> DataFrame:
    """The running profile as it stands at the end of each window in which the user was active."""
    rows = df.select(key, ts, *sets, _pieces(ts, window_ms).alias("_piece"))
    state = prefix_state(first_seen(rows, key, ts, sets), key, sets, window_ms, width)
    return state.select(
        key, F.col("_piece").alias("window_ms"), F.col("_ts").alias(ts), (F.col("_seen_n") + F.col("_n")).alias("pv"),
        *[F.array_join(F.array_sort(F.concat(F.coalesce(f"_seen_{s}", F.array().cast("array<string>")), s)), ",").alias(s)
          for s in sets])
