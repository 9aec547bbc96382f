"""Window jobs: visitors, logins, cart users, orders by province and product, search keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlens.functions.clock import window_start
from marketlens.functions.scalars import is_empty
from marketlens.operators import keyed, windows as win
from marketlens.operators.filters import filter_search_keyword
from marketlens.operators.joins import DimSpec, dim_lookup, words_of
from marketlens.operators.segment import segmented_words_of

VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]


def cart_users(carts: DataFrame, order: list[str], seconds: int = 2, zone: str = "UTC") -> DataFrame:
    """Users with a first cart row of the day, per window."""
    return win.with_window_text(
        win.count_window(keyed.uu_cart(carts, order, zone), seconds, "cart_add_uu_ct"), seconds, zone)


def visitors(logs: DataFrame, order: list[str], seconds: int = 10, zone: str = "UTC") -> DataFrame:
    """Page views, sessions, time spent and visitors of the day per version, channel, area and newness.

    Views are summed straight from the logs; only the first log per device and day is looked for.
    """
    start = window_start("ts_ms", seconds).alias("window_ms")
    views = logs.groupBy(start, *VISITOR_KEYS).agg(
        F.count("*").alias("pv_ct"), F.sum(is_empty("last_page_id").cast("bigint")).alias("sv_ct"),
        F.sum(F.coalesce("during_time", F.lit(0).cast("bigint"))).alias("dur_sum"))
    firsts = keyed.first_of_day(logs.select("mid", *VISITOR_KEYS, *order), ["mid"], order, zone)
    users = firsts.groupBy(start, *VISITOR_KEYS).agg(F.count("*").alias("uv_ct"))
    sums = win.union_sums([views, users], ["window_ms", *VISITOR_KEYS], ["uv_ct", "sv_ct", "pv_ct", "dur_sum"])
    return win.with_window_text(sums, seconds, zone)


def home_detail(logs: DataFrame, order: list[str], seconds: int = 10, zone: str = "UTC") -> DataFrame:
    """Visitors of the day of the home page and of product pages, per window."""
    flags = keyed.uv_home_detail(logs, order, zone)
    return win.with_window_text(
        win.sum_window(flags, seconds, [], ["home_uv_ct", "good_detail_uv_ct"]), seconds, zone)


def logins(logs: DataFrame, order: list[str], seconds: int = 10, zone: str = "UTC") -> DataFrame:
    """Users logging in and users coming back, per window."""
    flags = keyed.uu_login_back(logs, order, zone)
    return win.with_window_text(win.sum_window(flags, seconds, [], ["back_ct", "uu_ct"]), seconds, zone)


def searched_words(logs: DataFrame, dictionary: dict[str, float] | None = None) -> DataFrame:
    """One row per searched word, ``keyword`` and time; with a dictionary, texts without blanks are cut into its words."""
    texts = filter_search_keyword(logs)
    words = (words_of(texts, "fullword", ["ts_ms"]) if dictionary is None
             else segmented_words_of(texts, "fullword", ["ts_ms"], dictionary))
    return words.withColumnsRenamed({"word": "keyword"})


def search_keywords(logs: DataFrame, seconds: int = 10, dictionary: dict[str, float] | None = None) -> DataFrame:
    """Searched words per window."""
    words = searched_words(logs, dictionary)
    return win.with_window_text(win.count_window(words, seconds, "keyword_count", ["keyword"]), seconds)


def province_sums(facts: DataFrame, order: list[str], seconds: int = 4) -> DataFrame:
    """Order amount and distinct orders per province and window.

    A version that a later one replaces nets to zero in its own window, so amounts come from the last
    version per line; its order still counts there.
    """
    start = window_start("ts_ms", seconds).alias("window_ms")
    keys = ["window_ms", "province_id"]
    orders = (facts.select(start, "province_id", "order_id").groupBy(*keys, "order_id").agg(F.lit(1).alias("_one"))
              .groupBy(*keys).agg(F.count("order_id").alias("order_count")))
    last = keyed.last_rows(
        facts.select("id", "province_id", "split_total_amount", *[c for c in order if c not in (
            "province_id", "split_total_amount")]), ["id"], order)
    amounts = last.groupBy(start, "province_id").agg(*win.decimal_sums({"split_total_amount": "order_amount"}))
    return win.union_sums([orders, amounts], keys, ["order_count", "order_amount"])


def province_orders(facts: DataFrame, provinces: DataFrame, order: list[str], seconds: int = 4) -> DataFrame:
    """Orders per province and window, with the name of the province (empty when unknown)."""
    named = dim_lookup(province_sums(facts, order, seconds),
                       DimSpec(provinces, "id", {"name": "province_name"}, {"province_name": ""}), "province_id")
    return win.with_window_text(named, seconds)


SKU_SUMS = {"split_original_amount": "original_amount", "split_activity_amount": "activity_reduce_amount",
            "split_coupon_amount": "coupon_reduce_amount", "split_total_amount": "order_amount"}


def sku_sums(facts: DataFrame, order: list[str], seconds: int = 10) -> DataFrame:
    """Four amounts per product and window, from the last version of each order line."""
    rows = keyed.debounce_last(facts.select("id", "sku_id", *SKU_SUMS, *[
        c for c in order if c not in ("sku_id", *SKU_SUMS)]), "id", order)
    return win.tumble(rows, seconds, ["sku_id"], win.decimal_sums(SKU_SUMS))


def sku_chain(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add product, product group, brand and the three category levels by six lookups."""
    steps = [
        ("sku", "sku_id", {"sku_name": "sku_name", "spu_id": "spu_id", "category3_id": "category3_id",
                           "tm_id": "trademark_id"}),
        ("spu", "spu_id", {"spu_name": "spu_name"}),
        ("trademark", "trademark_id", {"tm_name": "trademark_name"}),
        ("category3", "category3_id", {"name": "category3_name", "category2_id": "category2_id"}),
        ("category2", "category2_id", {"name": "category2_name", "category1_id": "category1_id"}),
        ("category1", "category1_id", {"name": "category1_name"}),
    ]
    for name, by, columns in steps:
        df = dim_lookup(df, DimSpec(dims[name], "id", columns), by)
    return df


def sku_orders(facts: DataFrame, dims: dict[str, DataFrame], order: list[str], seconds: int = 10) -> DataFrame:
    """Amounts per product and window with the product's dimensions; sums come before the lookups."""
    return win.with_window_text(sku_chain(sku_sums(facts, order, seconds), dims), seconds)

