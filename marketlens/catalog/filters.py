"""Queries over parsing, filters, projections and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.catalog.registry import query
from marketlens.catalog.sinks import CELLS, ROUTED, routes
from marketlens.operators import filters as fl, logs as lg, routing as rt
from marketlens.sources import readers as rd, standins as st
from marketlens.sources.schemas import FACT_ROUTE, LOG

_PAGE = "mid, uid, sid, ar, ch, vc, os, md, ba, is_new, page_id, last_page_id, item, item_type, during_time, ts_ms"
# A cut-off line has no fields, so it parses to nulls only.
CLEAN = "k <> 97"
_PAGES = f"{CLEAN} AND page_id IS NOT NULL"


@query("parse_json", f"""
    SELECT mid, uid, ch, page_id, CASE WHEN page_id IS NOT NULL THEN during_time END AS during_time, ts_ms
    FROM page_log WHERE {CLEAN}""", ["page_log"])
def parse_json(spark, sf):
    rows = rd.parse_json(st.log_topic(spark, sf), LOG).where("ts IS NOT NULL")
    return rows.select("common.mid", "common.uid", "common.ch", "page.page_id", "page.during_time",
                       F.col("ts").alias("ts_ms"))


@query("parse_json_dirty_split", f"""
    SELECT row_id, CASE WHEN {CLEAN} THEN 'clean' ELSE 'dirty' END AS kind, CASE WHEN {CLEAN} THEN mid END AS mid
    FROM page_log""", ["page_log"])
def parse_json_dirty_split(spark, sf):
    clean, dirty = rd.split_dirty(st.log_topic(spark, sf), LOG)
    return clean.select("row_id", F.lit("clean").alias("kind"), "common.mid").unionByName(
        dirty.select("row_id", F.lit("dirty").alias("kind"), F.lit(None).cast("string").alias("mid")))


@query("drop_tombstones", "SELECT row_id, mid FROM page_log WHERE event_type <> 'view'", ["page_log"])
def drop_tombstones(spark, sf):
    logs = st.record(spark, sf, "page_log")
    message = F.when(F.col("event_type") != "view", F.to_json(F.struct("row_id", "mid")))
    return rd.parse_json(rd.drop_tombstones(logs.select(message.alias("value"))), "row_id BIGINT, mid STRING")


@query("cdc_filter_valid", """
    SELECT 'order_info' AS tab, op, count(*) AS n FROM order_info GROUP BY op
    UNION ALL SELECT 'cart_info', op, count(*) FROM cart_info GROUP BY op""", ["order_info", "cart_info"])
def cdc_filter_valid(spark, sf):
    rows = fl.cdc_filter_valid(st.change_log(spark, sf, "order_info", "cart_info"), st.DB)
    return rows.groupBy(F.col("source")["table"].alias("tab"), "op").agg(F.count("*").alias("n"))


@query("cdc_select_table", """
    SELECT id, user_id, sku_id, appraise, comment_txt, create_time, ts_ms FROM comment_info WHERE op = 'r'""",
       ["comment_info"])
def cdc_select_table(spark, sf):
    return fl.cdc_select_table(st.change_log(spark, sf, "comment_info", "order_info"), "comment_info", [
        "id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"])


CART_SQL = """
    SELECT id, user_id, sku_id, CASE WHEN op = 'r' THEN sku_num ELSE
           CAST(CAST(sku_num AS INT) - CAST(old_sku_num AS INT) AS VARCHAR) END AS sku_num, ts_ms
    FROM cart_info WHERE op = 'r' OR (op = 'u' AND CAST(sku_num AS INT) > CAST(old_sku_num AS INT))"""


@query("filter_cart_add", CART_SQL, ["cart_info"])
def filter_cart_add(spark, sf):
    return fl.filter_cart_add(st.change_log(spark, sf, "cart_info", "order_info"))


@query("filter_order_cancel", """
    SELECT id, operate_time, ts_ms FROM order_info WHERE op = 'r' AND order_status IN ('1001', '1003')""",
       ["order_info"])
def filter_order_cancel(spark, sf):
    return fl.filter_order_cancel(st.change_log(spark, sf, "order_info"))


@query("filter_order_cancel_as_written", """
    SELECT id, operate_time, ts_ms FROM order_info WHERE op = 'r' AND order_status = '1001' OR order_status = '1003'""",
       ["order_info"])
def filter_order_cancel_as_written(spark, sf):
    return fl.filter_order_cancel(st.change_log(spark, sf, "order_info"), strict=False)


@query("filter_payment_success", """
    SELECT user_id, order_id, payment_type, callback_time, ts_ms FROM payment_info WHERE payment_status = '1602'""",
       ["payment_info"])
def filter_payment_success(spark, sf):
    return fl.filter_payment_success(st.change_log(spark, sf, "payment_info"))


@query("filter_refund_request", """
    SELECT 'refund' AS kind, id, order_id, refund_amount, NULL AS province_id FROM order_refund_info
    UNION ALL SELECT 'order', id, NULL, NULL, province_id FROM order_info WHERE op = 'r' AND order_status = '1006'""",
       ["order_refund_info", "order_info"])
def filter_refund_request(spark, sf):
    refunds, orders = fl.filter_refund_request(st.change_log(spark, sf, "order_refund_info", "order_info"))
    return refunds.select(F.lit("refund").alias("kind"), "id", "order_id", "refund_amount").unionByName(
        orders.select(F.lit("order").alias("kind"), "id", "province_id"), allowMissingColumns=True)


@query("filter_refund_paid", """
    SELECT 'paid' AS kind, order_id, sku_id, total_amount AS amount FROM refund_payment WHERE refund_status = '1602'
    UNION ALL SELECT 'settled', order_id, sku_id, refund_num FROM order_refund_info WHERE refund_status = '0705'
    UNION ALL SELECT 'order', id, NULL, NULL FROM order_info WHERE op = 'r' AND order_status = '1006'""",
       ["refund_payment", "order_refund_info", "order_info"])
def filter_refund_paid(spark, sf):
    paid, settled, orders = fl.filter_refund_paid(
        st.change_log(spark, sf, "refund_payment", "order_refund_info", "order_info"))
    kind = lambda k: F.lit(k).alias("kind")
    return (paid.select(kind("paid"), "order_id", "sku_id", F.col("total_amount").alias("amount"))
            .unionByName(settled.select(kind("settled"), "order_id", "sku_id", F.col("refund_num").alias("amount")))
            .unionByName(orders.select(kind("order"), F.col("id").alias("order_id")), allowMissingColumns=True))


@query("filter_home_detail", "SELECT row_id, page_id FROM page_log WHERE page_id IN ('home', 'good_detail')",
       ["page_log"])
def filter_home_detail(spark, sf):
    return fl.filter_home_detail(st.record(spark, sf, "page_log")).select("row_id", "page_id")


@query("filter_login_page", """
    SELECT row_id, uid, last_page_id FROM page_log
    WHERE coalesce(uid, '') <> '' AND coalesce(last_page_id, '') IN ('', 'login')""", ["page_log"])
def filter_login_page(spark, sf):
    return fl.filter_login_page(st.record(spark, sf, "page_log")).select("row_id", "uid", "last_page_id")


SEARCH_SQL = """SELECT item AS fullword, ts_ms FROM page_log
    WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL"""


@query("filter_search_keyword", SEARCH_SQL, ["page_log"])
def filter_search_keyword(spark, sf):
    return fl.filter_search_keyword(st.record(spark, sf, "page_log"))


@query("filter_non_empty_uid", "SELECT row_id, uid FROM page_log WHERE uid <> ''", ["page_log"])
def filter_non_empty_uid(spark, sf):
    return fl.filter_non_empty_uid(st.record(spark, sf, "page_log")).select("row_id", "uid")


@query("route_dim_by_config", """
    SELECT sink_table, row_key, op, ts_ms, col, val FROM cells WHERE val IS NOT NULL""",
       ["user_info", "user_info_sup_msg", "cart_info"],
       CELLS.replace("'c' AS op", "'r' AS op").replace("uid, 'c', ts_ms", "uid, 'r', ts_ms").replace(
           "unnest([id, sku_id, sku_num])",
           "unnest([id, sku_id, CASE WHEN op = 'd' THEN old_sku_num ELSE sku_num END])"))
def route_dim_by_config(spark, sf):
    routed = rt.route_dim_by_config(st.change_log(spark, sf, *ROUTED), routes(spark))
    return routed.select("sink_table", "row_key", "op", "ts_ms", F.explode("data").alias("col", "val")).where(
        "val IS NOT NULL")


FACT_ROUTES = [("coupon_use", "insert", "dwd_coupon_get", "id,user_id"),
               ("coupon_use", "update", "dwd_coupon_use", "id,sku_id"),
               ("favor_info", "insert", "dwd_favor_add", "id,user_id,sku_id")]


@query("route_fact_by_config", """
    SELECT CASE WHEN source_table = 'favor_info' THEN 'dwd_favor_add' WHEN source_type = 'insert' THEN 'dwd_coupon_get'
                ELSE 'dwd_coupon_use' END AS sink_table, id,
           CASE WHEN source_type = 'insert' THEN user_id END AS user_id,
           CASE WHEN source_table = 'favor_info' OR source_type = 'update' THEN sku_id END AS sku_id,
           CAST(ts AS VARCHAR) AS ts
    FROM old_change WHERE source_table = 'coupon_use' OR (source_table = 'favor_info' AND source_type = 'insert')""",
       ["old_change"])
def route_fact_by_config(spark, sf):
    rows = st.record(spark, sf, "old_change")
    data = F.create_map(*[x for c in ("id", "user_id", "sku_id", "remark") for x in (F.lit(c), F.col(c))])
    old = rows.select(F.col("source_table").alias("table"), F.col("source_type").alias("type"), "ts", data.alias("data"))
    d = F.col("data")
    return rt.route_fact_by_config(old, rd.local_table(spark, FACT_ROUTE, FACT_ROUTES)).select(
        "sink_table", d["id"].alias("id"), d["user_id"].alias("user_id"), d["sku_id"].alias("sku_id"),
        d["ts"].alias("ts"))


@query("route_dim_md5", """
    SELECT 'dim_user_info' AS sink_table, md5(id) AS row_key, name, coalesce(gender, 'null') AS gender, ts_ms
    FROM user_info
    UNION ALL SELECT 'dim_user_sup', md5(uid), NULL, NULL, ts_ms FROM user_info_sup_msg
    UNION ALL SELECT 'dim_cart', md5(id), NULL, NULL, ts_ms FROM cart_info WHERE op <> 'd'""",
       ["user_info", "user_info_sup_msg", "cart_info"])
def route_dim_md5(spark, sf):
    routed = rt.route_dim_md5(st.change_log(spark, sf, *ROUTED), routes(spark))
    d = F.col("data")
    return routed.select("sink_table", "row_key", d["name"].alias("name"), d["gender"].alias("gender"), "ts_ms")


def config_changes(spark, sf):
    """Config changes in the shape of a change log."""
    return st.change_rows(spark, sf, "route_config")


@query("config_latest", """
    SELECT source_table, sink_table, sink_columns, op FROM (
      SELECT *, row_number() OVER (PARTITION BY source_table
                                   ORDER BY ts_ms DESC, sink_table DESC, sink_columns DESC, op DESC) AS rn
      FROM route_config)
    WHERE rn = 1 AND op <> 'd'""", ["route_config"])
def config_latest(spark, sf):
    return rt.config_latest(config_changes(spark, sf)).select("source_table", "sink_table", "sink_columns", "op")


@query("dim_table_lifecycle", """
    SELECT sink_table, op, ts_ms, unnest(CASE WHEN op IN ('r', 'c') THEN [0] WHEN op = 'd' THEN [0] ELSE [0, 1] END)
             AS step,
           unnest(CASE WHEN op IN ('r', 'c') THEN ['create'] WHEN op = 'd' THEN ['drop'] ELSE ['drop', 'create'] END)
             AS action
    FROM route_config""", ["route_config"])
def dim_table_lifecycle(spark, sf):
    return rt.lifecycle_actions(config_changes(spark, sf)).select("sink_table", "op", "ts_ms", "step", "action")


def _log_rows(spark, sf):
    return rd.split_dirty(st.log_topic(spark, sf), LOG)[0]


_SPLIT = f"""
    SELECT 'err' AS stream, row_id, mid, page_id, CAST(k + 1000 AS VARCHAR) AS detail, ts_ms FROM page_log
    WHERE {CLEAN} AND event_type = 'error'
    UNION ALL SELECT 'start', row_id, mid, NULL, 'icon', ts_ms FROM page_log WHERE {CLEAN} AND page_id IS NULL
    UNION ALL SELECT 'display', row_id, mid, page_id, CAST(k + unnest(generate_series(1, k % 4)) AS VARCHAR), ts_ms
    FROM page_log WHERE {_PAGES}
    UNION ALL SELECT 'action', row_id, mid, page_id, 'act' || CAST(unnest(generate_series(1, k % 3)) AS VARCHAR), NULL
    FROM page_log WHERE {_PAGES}
    UNION ALL SELECT 'page', row_id, mid, page_id, NULL, ts_ms FROM page_log WHERE {_PAGES}"""


@query("split_log_streams", _SPLIT, ["page_log"])
def split_log_streams(spark, sf):
    parts = lg.split_log_streams(_log_rows(spark, sf))
    none = F.lit(None)

    def shape(name, page, detail, ts):
        return parts[name].select(F.lit(name).alias("stream"), "row_id", "common.mid",
                                  page.cast("string").alias("page_id"), detail.cast("string").alias("detail"),
                                  ts.cast("bigint").alias("ts_ms"))

    page, ts = F.col("page.page_id"), F.col("ts")
    return (shape("err", page, F.col("err")["error_code"], ts)
            .unionByName(shape("start", none, F.col("start")["entry"], ts))
            .unionByName(shape("display", page, F.col("display")["item"], ts))
            .unionByName(shape("action", page, F.col("action")["action_id"], none))
            .unionByName(shape("page", page, none, ts)))


@query("split_log_streams_err_only", f"""
    SELECT row_id, CAST(k + 1000 AS VARCHAR) AS error_code, 'failed' AS msg FROM page_log
    WHERE {CLEAN} AND event_type = 'error'""", ["page_log"])
def split_log_streams_err_only(spark, sf):
    err = lg.split_log_streams(_log_rows(spark, sf), err_only=True)["err"]
    return err.select("row_id", F.col("err")["error_code"].alias("error_code"), F.col("err")["msg"].alias("msg"))


@query("strip_common_device", """
    SELECT row_id, coalesce(uid, '-1') AS uid, ts_ms, split_part(os, ' ', 1) AS os, ch, md, ba, vc, ar,
           CASE WHEN page_id IS NOT NULL AND item_type = 'keyword' THEN item END AS search_item
    FROM page_log""", ["page_log"])
def strip_common_device(spark, sf):
    rows = fl.strip_common_device(st.log_rows(spark, sf))
    d = F.col("deviceInfo")
    return rows.select("row_id", "uid", "ts_ms", *[d[c].alias(c) for c in ("os", "ch", "md", "ba", "vc", "ar")],
                       "search_item")


AS_OF = "2025-05-12"
_ZODIAC = """CASE WHEN md <= 119 OR md >= 1222 THEN '摩羯座' WHEN md <= 218 THEN '水瓶座' WHEN md <= 320 THEN '双鱼座'
    WHEN md <= 419 THEN '白羊座' WHEN md <= 520 THEN '金牛座' WHEN md <= 621 THEN '双子座' WHEN md <= 722 THEN '巨蟹座'
    WHEN md <= 822 THEN '狮子座' WHEN md <= 922 THEN '处女座' WHEN md <= 1023 THEN '天秤座' WHEN md <= 1122 THEN '天蝎座'
    WHEN md <= 1221 THEN '射手座' END"""
USERS = f"""
users AS (
  SELECT id AS uid, name, nick_name, CAST(born AS VARCHAR) AS birthday, year(born) - year(born) % 10 AS decade,
         CASE WHEN born IS NULL THEN -1 ELSE date_sub('year', born, DATE '{AS_OF}') END AS age,
         {_ZODIAC} AS zodiac_sign, phone_num, email, gender, ts_ms, arrival
  FROM (SELECT *, DATE '1970-01-01' + CAST(birthday AS INT) AS born,
               month(DATE '1970-01-01' + CAST(birthday AS INT)) * 100 + day(DATE '1970-01-01' + CAST(birthday AS INT))
                 AS md FROM user_info))"""


def as_of():
    """The day ages are worked out for."""
    return F.lit(AS_OF).cast("date")


@query("user_info_project", """
    SELECT uid, name, nick_name, birthday, decade, age, zodiac_sign, phone_num, email, gender, ts_ms FROM users""",
       ["user_info"], USERS)
def user_info_project(spark, sf):
    return fl.user_info_project(st.change_log(spark, sf, "user_info"), as_of()).drop("user_level", "login_name")


@query("user_sup_project", "SELECT uid, height, unit_height, weight, unit_weight, ts_ms FROM user_info_sup_msg",
       ["user_info_sup_msg"])
def user_sup_project(spark, sf):
    return fl.user_sup_project(st.change_log(spark, sf, "user_info_sup_msg"))


REGION_WHERE = "city IS NOT NULL AND province NOT IN ('澳门特别行政区', '台湾省', '香港特别行政区')"


@query("region_filter", f"SELECT code, province, city FROM city_weather WHERE {REGION_WHERE}", ["city_weather"])
def region_filter(spark, sf):
    return fl.region_filter(st.record(spark, sf, "city_weather")).select("code", "province", "city")


WEATHER = """
weather AS (
  SELECT code, province, coalesce(city, province) AS city, coalesce(area, city, province) AS area,
         json_extract_string(resp, '$.info') AS info,
         coalesce(CAST(json_extract(resp, '$.lives[0]') AS VARCHAR), '{}') AS lives,
         json_extract_string(resp, '$.lives[0].reporttime') AS report_time,
         json_extract_string(resp, '$.status') = '1' AND json_extract_string(resp, '$.lives') IS DISTINCT FROM '[]'
           AND json_extract_string(resp, '$.lives') IS DISTINCT FROM '[[]]' AS ok
  FROM city_weather)"""


@query("weather_flatten", "SELECT code, province, city, area, info, lives, report_time, ok FROM weather",
       ["city_weather"], WEATHER)
def weather_flatten(spark, sf):
    return fl.weather_flatten(st.record(spark, sf, "city_weather"))
