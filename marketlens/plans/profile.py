"""User profile jobs: user facts, page profile, order facts, scores, age bracket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions import scores as sc
from marketlens.functions.clock import datetime_to_ts
from marketlens.operators import filters as fl
from marketlens.operators.dedupe import dedup_full_row, dedup_latest_detail
from marketlens.operators.joins import equi_join, first_match, interval_join, near_values, prefixed
from marketlens.operators.keyed import window_profile

MINUTE, HOUR = 60_000, 3_600_000
MEASURES = ["height", "unit_height", "weight", "unit_weight"]


def user_profile(changes: DataFrame, as_of: Column, minutes: int = 60) -> DataFrame:
    """User rows with body measures that changed within ``minutes`` of them."""
    users = fl.filter_non_empty_uid(fl.user_info_project(changes, as_of))
    sup = fl.filter_non_empty_uid(fl.user_sup_project(changes)).withColumnsRenamed({"ts_ms": "sup_ts"})
    joined = interval_join(users, sup, ["uid"], "ts_ms", "sup_ts", minutes * MINUTE, minutes * MINUTE)
    return joined.select(
        "uid", "name", "decade", "birthday", "phone_num", "email", "age", "zodiac_sign", "ts_ms",
        F.coalesce("gender", F.lit("null")).alias("gender"), *MEASURES)


def user_label(left: DataFrame, right: DataFrame, minutes: int = 60) -> DataFrame:
    """Left rows with the different body measures that the same user had within ``minutes`` of them."""
    measures = right.select("uid", F.col("ts_ms").alias("sup_ts"), *MEASURES)
    return near_values(left, measures, ["uid"], "ts_ms", "sup_ts", minutes * MINUTE, MEASURES)


def comment_order(comments: DataFrame, orders: DataFrame, on: str, comment_ts: str, order_ts: str,
                  minutes: int) -> DataFrame:
    """Comments with every column of a near order, prefixed ``info_``."""
    info = prefixed(orders, "info_", keep=(on,)).withColumn(f"info_{on}", F.col(on))
    return interval_join(comments, info, [on], comment_ts, f"info_{order_ts}", minutes * MINUTE, minutes * MINUTE)


def order_join(changes: DataFrame, minutes: int = 5) -> DataFrame:
    """Orders with their lines when both changed within ``minutes``; the time is that of the line."""
    orders = fl.order_rows(changes).withColumnsRenamed({"id": "order_id", "ts_ms": "order_ts"})
    details = fl.order_line_rows(changes).withColumnsRenamed({"id": "detail_id"})
    joined = interval_join(orders, details, ["order_id"], "order_ts", "ts_ms", minutes * MINUTE, minutes * MINUTE)
    return joined.select(
        F.col("order_id").alias("id"), "user_id", "total_amount", "create_time", "detail_id", "order_id", "sku_id",
        "sku_name", "sku_num", "order_price", "split_activity_amount", "split_total_amount", "ts_ms")


def order_info(changes: DataFrame, minutes: int = 5) -> DataFrame:
    """The joined order lines, one per line and time."""
    return dedup_latest_detail(order_join(changes, minutes), "detail_id", "ts_ms")


def device_rows(logs: DataFrame) -> DataFrame:
    """Distinct page-log rows of known users: id, time, device fields, searched text."""
    rows = dedup_full_row(fl.filter_non_empty_uid(fl.strip_common_device(logs)).drop("row_id"))
    d = F.col("deviceInfo")
    return rows.select("uid", "ts_ms", d["os"].alias("os"), d["ch"].alias("ch"), d["md"].alias("md"),
                       d["ba"].alias("ba"), "search_item")


PROFILE_SETS = ["os", "ch", "md", "ba", "search_item"]


def page_profile(logs: DataFrame, window_ms: int = 120_000) -> DataFrame:
    """Page views and values seen per user so far, at the end of each window."""
    return window_profile(device_rows(logs), "uid", "ts_ms", PROFILE_SETS, window_ms)


def category_tree(c3: DataFrame, c2: DataFrame, c1: DataFrame) -> DataFrame:
    """Third-level categories with the names of all three levels."""
    second = c2.select(F.col("id").alias("category2_id"), F.col("name").alias("b2name"), "category1_id")
    first = c1.select(F.col("id").alias("category1_id"), F.col("name").alias("b1name"))
    rows = equi_join(c3.withColumnsRenamed({"name": "b3name"}), second, ["category2_id"])
    return equi_join(rows, first, ["category1_id"]).select("id", "b3name", "b2name", "b1name")


def sku_brand(sku: DataFrame, spu: DataFrame, trademark: DataFrame) -> DataFrame:
    """Products with their group, category and brand name."""
    groups = spu.select(F.col("id").alias("spu_id"), F.col("category3_id"), "tm_id")
    brands = trademark.select(F.col("id").alias("tm_id"), "tm_name")
    rows = equi_join(sku.select("id", "spu_id"), groups, ["spu_id"])
    return equi_join(rows, brands, ["tm_id"]).select("id", F.col("spu_id").alias("spuid"), "category3_id", "tm_name")


def lookup_category_by_name(df: DataFrame, tree: DataFrame, compare: DataFrame, item: str = "search_item") -> DataFrame:
    """Searched text that names a third-level category to its top category and search category."""
    by_name = first_match(tree, "b3name", "b1name", "id").select(
        F.col("b3name").alias(item), F.col("b1name").alias("b1_category"))
    by_category = first_match(compare, "category_name", "search_category", "id").select(
        F.col("category_name").alias("b1_category"), F.col("search_category"))
    return equi_join(equi_join(df, by_name, [item], "left"), by_category, ["b1_category"], "left")


def score_device_search(profiles: DataFrame, tree: DataFrame, compare: DataFrame) -> DataFrame:
    """Page profiles with device and search scores."""
    rows = lookup_category_by_name(profiles, tree, compare)
    return rows.select(*profiles.columns, F.substring_index("os", ",", 1).alias("judge_os"), "b1_category",
                       "search_category", *sc.score_device(F.col("os")), *sc.score_search(F.col("search_category")))


def lookup_sku_category(df: DataFrame, brands: DataFrame, tree: DataFrame) -> DataFrame:
    """Add third-level category, brand and top category of the product."""
    sku = brands.groupBy("id").agg(F.min(F.struct("category3_id", "tm_name")).alias("_b")).select(
        F.col("id").alias("sku_id"), F.col("_b.category3_id").alias("c3id"), F.col("_b.tm_name").alias("tname"))
    top = first_match(tree, "id", "b1name", "b3name").select(F.col("id").alias("c3id"), F.col("b1name").alias("b1_name"))
    return equi_join(equi_join(df, sku, ["sku_id"], "left"), top, ["c3id"], "left")


def score_orders(orders: DataFrame, brands: DataFrame, tree: DataFrame) -> DataFrame:
    """Order lines with scores of time of day, amount, brand and top category."""
    rows = lookup_sku_category(orders, brands, tree)
    hour = F.pmod(datetime_to_ts("create_time"), F.lit(24 * HOUR)) / HOUR
    slot = sc.day_part(F.floor(hour))
    return rows.select(
        *orders.columns, "c3id", "tname", "b1_name", slot.alias("pay_slot"), *sc.score_pay_time(slot),
        *sc.score_amount(F.col("total_amount")), *sc.score_brand(F.col("tname")), *sc.score_category(F.col("b1_name")))


ORDER_SCORES = [f"{s}_{b}" for s in ("pay_time", "amount", "tname", "b1name") for b in sc.BRACKETS[:2]]


def _scored_sides(pages: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a label needs of page profiles and of order lines."""
    scores = [c for c in pages.columns if c.startswith(("device_", "search_")) and c[7:] in sc.BRACKETS]
    return (pages.select("uid", "ts_ms", *scores),
            orders.select(F.col("user_id").alias("uid"), F.col("ts_ms").alias("order_ts"), *ORDER_SCORES))


def age_label_rows(pages: DataFrame, orders: DataFrame, hours: int = 24) -> DataFrame:
    """Age bracket of a user from each scored page profile with each scored order line within ``hours`` of it, one row per pair."""
    left, right = _scored_sides(pages, orders)
    joined = interval_join(left, right, ["uid"], "ts_ms", "order_ts", hours * HOUR, hours * HOUR)
    return joined.select("uid", "ts_ms", sc.age_level(joined.columns).alias("ageLevel"))


def age_level_counts(pages: DataFrame, orders: DataFrame, hours: int = 24) -> DataFrame:
    """Pairs of :func:`age_label_rows` per user and age bracket; rows of a user with equal time and scores are counted before they are joined."""
    left, right = [side.groupBy(*side.columns).agg(F.count("*").alias(n)) for side, n in zip(_scored_sides(pages, orders), ("_pages", "_lines"))]
    joined = interval_join(left, right, ["uid"], "ts_ms", "order_ts", hours * HOUR, hours * HOUR)
    return joined.groupBy("uid", sc.age_level(joined.columns).alias("ageLevel")).agg(F.sum(F.col("_pages") * F.col("_lines")).alias("n"))


def age_labels(pages: DataFrame, orders: DataFrame, hours: int = 24) -> DataFrame:
    """The different rows of :func:`age_label_rows`, for joins that ask only which brackets there are.

    Score combinations of order lines are few (they come from short tables), so a profile meets each of them once instead of every line.
    """
    left, right = _scored_sides(pages, orders)
    joined = near_values(left, right, ["uid"], "ts_ms", "order_ts", hours * HOUR, ORDER_SCORES)
    return joined.select("uid", "ts_ms", sc.age_level(joined.columns).alias("ageLevel")).dropDuplicates()


def merged_profile(labels: DataFrame, users: DataFrame, hours: int = 80) -> DataFrame:
    """The user row with each age bracket that the user has within ``hours`` of it; user fields win, repeats are dropped."""
    brackets = labels.select("uid", F.col("ts_ms").alias("label_ts"), "ageLevel")
    joined = near_values(users, brackets, ["uid"], "ts_ms", "label_ts", hours * HOUR, ["ageLevel"])
    return joined.select("uid", "ageLevel", *[c for c in users.columns if c != "uid"])
