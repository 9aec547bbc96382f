"""Queries over aggregates, windows and the keyword function."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.catalog.filters import REGION_WHERE, SEARCH_SQL, WEATHER
from marketlens.catalog.joins import DEVICE_ROWS
from marketlens.catalog.registry import query, window, window_text
from marketlens.functions import scores as sc
from marketlens.operators import filters as fl, keyed, windows as win
from marketlens.operators.joins import words_of
from marketlens.operators.segment import dictionary, segmented_words_of
from marketlens.plans import dims, profile as pf, windows as wd
from marketlens.sources import standins as st

# Versions of an order line are told apart by time and then by content.
VERSION = ["ts_ms", "sku_id", "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount",
           "split_total_amount"]
LATEST = ", ".join(f"{c} DESC" for c in VERSION)
LOG_ORDER = ["ts_ms", "row_id"]


@query("agg_count_window", f"""
    SELECT {window_text('w', 2)}, n AS cart_ct FROM (SELECT {window('ts_ms', 2)} AS w, count(*) AS n FROM cart_info
    GROUP BY 1)""", ["cart_info"])
def agg_count_window(spark, sf):
    return win.with_window_text(win.count_window(st.record(spark, sf, "cart_info"), 2, "cart_ct"), 2)


_SKU_SUMS = ", ".join(
    f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS VARCHAR) AS {n}" for c, n in wd.SKU_SUMS.items())


def _text(df, names):
    return df.withColumns({n: F.col(n).cast("decimal(38,4)").cast("string") for n in names})


@query("agg_sum_decimal", f"""
    SELECT {window_text('w', 10)}, * EXCLUDE (w) FROM (
      SELECT {window('ts_ms', 10)} AS w, sku_id, {_SKU_SUMS} FROM trade_order_detail GROUP BY 1, 2)""",
       ["trade_order_detail"])
def agg_sum_decimal(spark, sf):
    rows = win.tumble(st.record(spark, sf, "trade_order_detail"), 10, ["sku_id"], win.decimal_sums(wd.SKU_SUMS))
    return win.with_window_text(_text(rows, wd.SKU_SUMS.values()), 10)


@query("agg_sum_and_distinct", f"""
    SELECT {window_text('w', 4)}, * EXCLUDE (w) FROM (
      SELECT {window('ts_ms', 4)} AS w, province_id, count(DISTINCT order_id) AS order_count,
             CAST(sum(CAST(split_total_amount AS DECIMAL(18,4))) AS VARCHAR) AS order_amount
      FROM trade_order_detail GROUP BY 1, 2)""", ["trade_order_detail"])
def agg_sum_and_distinct(spark, sf):
    rows = win.tumble(st.record(spark, sf, "trade_order_detail"), 4, ["province_id"], [
        F.countDistinct("order_id").alias("order_count"),
        *win.decimal_sums({"split_total_amount": "order_amount"})])
    return win.with_window_text(_text(rows, ["order_amount"]), 4)


@query("agg_sum_multi", f"""
    SELECT {window_text('w', 10)}, * EXCLUDE (w) FROM (
      SELECT {window('ts_ms', 10)} AS w, vc, ch, ar, is_new, count(*) AS pv_ct,
             sum(CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END)::BIGINT AS sv_ct,
             sum(during_time)::BIGINT AS dur_sum
      FROM page_log GROUP BY ALL)""", ["page_log"])
def agg_sum_multi(spark, sf):
    rows = win.tumble(st.record(spark, sf, "page_log"), 10, wd.VISITOR_KEYS, [
        F.count("*").alias("pv_ct"),
        F.sum((F.coalesce("last_page_id", F.lit("")) == "").cast("bigint")).alias("sv_ct"),
        F.sum("during_time").alias("dur_sum")])
    return win.with_window_text(rows, 10)


HOME = """home AS (SELECT * FROM (SELECT mid, page_id, ts_ms,
    row_number() OVER (PARTITION BY mid, page_id, ts_ms // 86400000 ORDER BY ts_ms, row_id) AS rn
    FROM page_log WHERE page_id IN ('home', 'good_detail')) WHERE rn = 1)"""
HOME_SQL = f"""
    SELECT {window_text('w', 10)}, home_uv_ct, good_detail_uv_ct FROM (
      SELECT {window('ts_ms', 10)} AS w, count(*) FILTER (page_id = 'home') AS home_uv_ct,
             count(*) FILTER (page_id <> 'home') AS good_detail_uv_ct FROM home GROUP BY 1)"""


@query("agg_sum_global", HOME_SQL, ["page_log"], HOME)
def agg_sum_global(spark, sf):
    return wd.home_detail(st.record(spark, sf, "page_log"), LOG_ORDER)


KEYWORD_SQL = f"""
    SELECT {window_text('w', 10)}, keyword, keyword_count FROM (
      SELECT {window('ts_ms', 10)} AS w, keyword, count(*) AS keyword_count FROM (
        SELECT unnest(regexp_split_to_array(lower(fullword), '[^\\p{{L}}\\p{{N}}]+')) AS keyword, ts_ms
        FROM ({SEARCH_SQL})) WHERE keyword <> '' GROUP BY 1, 2)"""


@query("agg_keyword_count", KEYWORD_SQL, ["page_log"])
def agg_keyword_count(spark, sf):
    return wd.search_keywords(st.record(spark, sf, "page_log"))


@query("udtf_keyword", """
    SELECT doc_id, word, count(*) AS n FROM (
      SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1, 2""")
def udtf_keyword(spark, sf):
    words = words_of(st.table(spark, sf, "documents"), "text", ["doc_id"])
    return words.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query("udtf_keyword_dictionary")
def udtf_keyword_dictionary(spark, sf):
    """Texts that have lost their blanks, cut into the words of the benchmark texts: SQL has no best path, tests compare it with plain search."""
    words = words_of(st.table(spark, sf, "benchmark"), "text", []).groupBy("word").agg(F.log(F.count("*")).alias("weight"))
    texts = st.table(spark, sf, "documents").select("doc_id", F.regexp_replace("text", r"[ \t]+", "").alias("text"))
    cut = segmented_words_of(texts, "text", ["doc_id"], dictionary(words, weight="weight"), spaced=True)
    return cut.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


_RUNNING = ", ".join(
    f"coalesce(array_to_string(list_sort(list(DISTINCT {s}) FILTER ({s} IS NOT NULL) OVER w), ','), '') AS {s}"
    for s in pf.PROFILE_SETS)
RUNNING_ROWS = """
running_rows AS (
  SELECT row_id, coalesce(uid, '-1') AS uid, ts_ms, split_part(os, ' ', 1) AS os, ch, md, ba,
         CASE WHEN page_id IS NOT NULL AND item_type = 'keyword' THEN item END AS search_item
  FROM page_log WHERE coalesce(uid, '-1') <> '')"""
RUNNING_SQL = f"""
    SELECT uid, ts_ms, row_id, count(*) OVER w AS pv, {_RUNNING} FROM running_rows
    WINDOW w AS (PARTITION BY uid ORDER BY ts_ms, row_id ROWS UNBOUNDED PRECEDING)"""


def running(spark, sf):
    """Running profile per page-log row."""
    rows = fl.filter_non_empty_uid(fl.strip_common_device(st.log_rows(spark, sf)))
    d = F.col("deviceInfo")
    flat = rows.select("uid", "ts_ms", "row_id", *[d[s].alias(s) for s in pf.PROFILE_SETS[:4]], "search_item")
    return keyed.running_profile(flat, "uid", "ts_ms", "row_id", pf.PROFILE_SETS)


@query("agg_running_profile", RUNNING_SQL, ["page_log"], RUNNING_ROWS)
def agg_running_profile(spark, sf):
    return running(spark, sf)


@query("agg_last_in_window", """
    SELECT uid, window_ms, ts_ms, os, ch, search_item FROM (
      SELECT *, ts_ms - ts_ms % 120000 AS window_ms, row_number() OVER (
        PARTITION BY uid, ts_ms - ts_ms % 120000
        ORDER BY ts_ms DESC, os DESC, ch DESC, md DESC, ba DESC, search_item DESC NULLS LAST) AS rn FROM device_rows)
    WHERE rn = 1""", ["page_log"], DEVICE_ROWS)
def agg_last_in_window(spark, sf):
    rows = pf.device_rows(st.log_rows(spark, sf))
    return win.last_in_window(rows, "uid", ["ts_ms", "os", "ch", "md", "ba", "search_item"], 120).select(
        "uid", "window_ms", "ts_ms", "os", "ch", "search_item")


REPORT_SQL = f"""
    SELECT count(*) FILTER (ok) AS success_count, count(*) FILTER (NOT ok) AS fail_count,
           min(report_time) AS start_time, max(report_time) AS end_time,
           (SELECT string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) FROM (
              SELECT code FROM weather WHERE NOT ok AND code IN (SELECT code FROM city_weather WHERE {REGION_WHERE})
              ORDER BY code LIMIT 100)) AS failed_cities
    FROM weather WHERE code IN (SELECT code FROM city_weather WHERE {REGION_WHERE})"""


@query("agg_run_summary", REPORT_SQL, ["city_weather"], WEATHER)
def agg_run_summary(spark, sf):
    return dims.weather_report(st.record(spark, sf, "city_weather"))


@query("agg_argmax_bucket", """
    SELECT vec_id, ['18_24', '25_29', '30_34', '35_39', '40_49', '50'][list_position(v, list_max(v))] AS bucket
    FROM (SELECT vec_id, [round(CAST(embedding[1] AS DOUBLE), 6), round(CAST(embedding[2] AS DOUBLE), 6),
                          round(CAST(embedding[3] AS DOUBLE), 6), round(CAST(embedding[4] AS DOUBLE), 6),
                          round(CAST(embedding[5] AS DOUBLE), 6), round(CAST(embedding[6] AS DOUBLE), 6)] AS v
          FROM embeddings)""")
def agg_argmax_bucket(spark, sf):
    vectors = st.table(spark, sf, "embeddings")
    scores = [F.col("embedding")[i].cast("double").alias(f"search_{b}") for i, b in enumerate(sc.BRACKETS)]
    rows = vectors.select("vec_id", *scores)
    return rows.select("vec_id", sc.age_level(rows.columns).alias("bucket"))


def _tumbling(name, seconds, keys, by):
    group = f"GROUP BY w, {keys}" if keys else "GROUP BY w"
    cols = f"{keys}, " if keys else ""
    query(name, f"""SELECT {window_text('w', seconds)}, {cols}n FROM (
        SELECT w, {cols}count(*) AS n FROM (SELECT *, {window('ts_ms', seconds)} AS w FROM page_log) {group})""",
          ["page_log"])(lambda spark, sf: win.with_window_text(
              win.count_window(st.record(spark, sf, "page_log"), seconds, "n", by), seconds))


_tumbling("win_tumble_event_global", 10, "", [])
_tumbling("win_tumble_event_keyed", 4, "ch, vc", ["ch", "vc"])
_tumbling("win_tumble_processing", 120, "mid", ["mid"])
_tumbling("win_tumble_tvf", 10, "page_id", ["page_id"])
