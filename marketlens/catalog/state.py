"""Queries over the batch forms of the stateful rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.catalog.aggregates import LATEST, LOG_ORDER, RUNNING_ROWS, RUNNING_SQL, VERSION, running
from marketlens.catalog.filters import USERS, config_changes
from marketlens.catalog.joins import MERGED_CTES, MERGED_RECORDS, MERGED_SQL, ORDER_JOIN, merged
from marketlens.catalog.registry import query
from marketlens.operators import dedupe as dd, keyed, routing as rt
from marketlens.plans import profile as pf
from marketlens.sources import standins as st

FIXED = """
fixed AS (
  SELECT row_id, mid, ts_ms, CASE WHEN is_new = '1' AND ts_ms // 86400000 <> first_day THEN '0' ELSE is_new END AS is_new
  FROM (SELECT *, first_value(ts_ms // 86400000 - CASE WHEN is_new = '1' THEN 0 ELSE 1 END)
                  OVER (PARTITION BY mid ORDER BY ts_ms, row_id) AS first_day FROM page_log))"""


@query("fix_is_new", "SELECT * FROM fixed", ["page_log"], FIXED)
def fix_is_new(spark, sf):
    return keyed.fix_is_new(st.record(spark, sf, "page_log").select("row_id", "mid", "ts_ms", "is_new"), LOG_ORDER)


VISITS = """
visits AS (
  SELECT *, CASE WHEN lag(ts_ms // 86400000) OVER w IS DISTINCT FROM ts_ms // 86400000 THEN 1 ELSE 0 END AS uv_ct,
         CASE WHEN coalesce(last_page_id, '') = '' THEN 1 ELSE 0 END AS sv_ct, 1 AS pv_ct, during_time AS dur_sum
  FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ts_ms, row_id))"""


@query("uv_daily_flag", "SELECT row_id, mid, ts_ms, uv_ct, sv_ct, pv_ct, dur_sum FROM visits", ["page_log"], VISITS)
def uv_daily_flag(spark, sf):
    return keyed.uv_daily_flag(st.record(spark, sf, "page_log")).select(
        "row_id", "mid", "ts_ms", "uv_ct", "sv_ct", "pv_ct", "dur_sum")


@query("uv_home_detail", """
    SELECT mid, ts_ms, CASE WHEN page_id = 'home' THEN 1 ELSE 0 END AS home_uv_ct,
           CASE WHEN page_id = 'home' THEN 0 ELSE 1 END AS good_detail_uv_ct
    FROM (SELECT *, lag(ts_ms // 86400000) OVER (PARTITION BY mid, page_id ORDER BY ts_ms, row_id) AS last_day
          FROM page_log WHERE page_id IN ('home', 'good_detail'))
    WHERE last_day IS DISTINCT FROM ts_ms // 86400000""", ["page_log"])
def uv_home_detail(spark, sf):
    return keyed.uv_home_detail(st.record(spark, sf, "page_log"), LOG_ORDER)


# Users seldom stay away a week in the test data, so a shorter gap also is checked.
def login_sql(days):
    return f"""
    SELECT uid, ts_ms, 1 AS uu_ct, CASE WHEN (ts_ms - last_day * 86400000) // 86400000 >= {days} THEN 1 ELSE 0 END
           AS back_ct
    FROM (SELECT *, lag(ts_ms // 86400000) OVER (PARTITION BY uid ORDER BY ts_ms, row_id) AS last_day
          FROM page_log WHERE coalesce(uid, '') <> '' AND coalesce(last_page_id, '') IN ('', 'login'))
    WHERE last_day IS DISTINCT FROM ts_ms // 86400000"""


@query("uu_login_back", login_sql(8), ["page_log"])
def uu_login_back(spark, sf):
    return keyed.uu_login_back(st.record(spark, sf, "page_log"), LOG_ORDER)


@query("uu_login_back_2_days", login_sql(2), ["page_log"])
def uu_login_back_2_days(spark, sf):
    return keyed.uu_login_back(st.record(spark, sf, "page_log"), LOG_ORDER, back_days=2)


@query("uu_cart", """
    SELECT id, user_id, sku_id, sku_num, ts_ms FROM (
      SELECT *, lag(ts_ms // 86400000) OVER (PARTITION BY user_id ORDER BY ts_ms, id) AS last_day FROM cart_info)
    WHERE last_day IS DISTINCT FROM ts_ms // 86400000""", ["cart_info"])
def uu_cart(spark, sf):
    carts = st.record(spark, sf, "cart_info").select("id", "user_id", "sku_id", "sku_num", "ts_ms")
    return keyed.uu_cart(carts, ["ts_ms", "id"])


@query("dedup_latest_ts", """
    SELECT uid, name, ts_ms FROM (
      SELECT *, max(ts_ms) OVER (PARTITION BY uid ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                AS seen FROM users)
    WHERE seen IS NULL OR ts_ms > seen""", ["user_info"], USERS)
def dedup_latest_ts(spark, sf):
    users = st.record(spark, sf, "user_info").select(F.col("id").alias("uid"), "name", "ts_ms", "arrival")
    return dd.dedup_latest_ts(users, "uid", "ts_ms", "arrival", piece=1000).drop("arrival")


@query("dedup_latest_detail", """
    SELECT detail_id, ts_ms, sku_id, sku_num FROM (SELECT *, row_number() OVER (PARTITION BY detail_id, ts_ms ORDER BY
      id, user_id, total_amount, create_time, order_id, sku_id, sku_name, sku_num, order_price, split_activity_amount,
      split_total_amount) AS rn FROM order_join) WHERE rn = 1""", ["order_info", "order_detail"], ORDER_JOIN)
def dedup_latest_detail(spark, sf):
    rows = pf.order_info(st.change_log(spark, sf, "order_info", "order_detail"))
    return rows.select("detail_id", "ts_ms", "sku_id", "sku_num")


@query("dedup_full_row", "SELECT DISTINCT id, sku_id, sku_num FROM trade_order_detail", ["trade_order_detail"])
def dedup_full_row(spark, sf):
    return dd.dedup_full_row(st.record(spark, sf, "trade_order_detail").select("id", "sku_id", "sku_num"))


@query("dedup_list_state", MERGED_SQL, MERGED_RECORDS, MERGED_CTES)
def dedup_list_state(spark, sf):
    return merged(spark, sf)


@query("dedup_bloom", """
    SELECT order_id, ts_ms, id, sku_id FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id, ts_ms ORDER BY id, sku_id) AS rn FROM trade_order_detail)
    WHERE rn = 1""", ["trade_order_detail"])
def dedup_bloom(spark, sf):
    rows = st.record(spark, sf, "trade_order_detail").select("order_id", "ts_ms", "id", "sku_id")
    return dd.dedup_keys(rows, ["order_id", "ts_ms"], ["id", "sku_id"])


@query("retract_previous", f"""
    SELECT id, province_id, ts_ms, split_total_amount FROM trade_order_detail
    UNION ALL
    SELECT id, province_id, ts_ms, CAST(-CAST(split_total_amount AS DECIMAL(18,4)) AS VARCHAR) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LATEST}) AS rn FROM trade_order_detail) WHERE rn > 1""",
       ["trade_order_detail"])
def retract_previous(spark, sf):
    rows = st.record(spark, sf, "trade_order_detail", row_id=True)
    return keyed.retract_previous(rows, "id", VERSION, "row_id", "split_total_amount").select(
        "id", "province_id", "ts_ms", "split_total_amount")


@query("debounce_last", f"""
    SELECT id, sku_id, ts_ms, split_total_amount FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LATEST}) AS rn FROM trade_order_detail) WHERE rn = 1""",
       ["trade_order_detail"])
def debounce_last(spark, sf):
    versions = st.record(spark, sf, "trade_order_detail").select("id", *VERSION)
    return keyed.debounce_last(versions, "id", VERSION).select("id", "sku_id", "ts_ms", "split_total_amount")


@query("running_profile", RUNNING_SQL, ["page_log"], RUNNING_ROWS)
def running_profile(spark, sf):
    return running(spark, sf)


@query("dyn_config_state", """
    SELECT c.source_table, c.sink_table, count(*) AS n FROM (
      SELECT *, row_number() OVER (PARTITION BY source_table
                                   ORDER BY ts_ms DESC, sink_table DESC, sink_columns DESC, op DESC) AS rn
      FROM route_config) c
    JOIN (SELECT 'src_' || CAST(user_id AS VARCHAR) AS source_table FROM events) e ON c.source_table = e.source_table
    WHERE rn = 1 AND op <> 'd' GROUP BY 1, 2""", ["route_config"])
def dyn_config_state(spark, sf):
    events = st.table(spark, sf, "events").select(
        F.lit("c").alias("op"), F.lit(None).cast("map<string,string>").alias("before"),
        F.create_map(F.lit("id"), F.col("event_id").cast("string")).alias("after"),
        F.create_map(F.lit("table"), F.concat(F.lit("src_"), F.col("user_id").cast("string"))).alias("source"),
        F.lit(0).cast("bigint").alias("ts_ms"))
    routed = rt.route_dim_by_config(events, rt.config_latest(config_changes(spark, sf)))
    return routed.groupBy("source_table", "sink_table").agg(F.count("*").alias("n"))


# Records of the tables that the config names come at times all over those of its changes.
CONFIG_RECORDS = """
versions AS (
  SELECT source_table, sink_table, sink_columns, op, ts_ms FROM (
    SELECT *, row_number() OVER (PARTITION BY source_table, ts_ms ORDER BY op DESC, sink_table DESC, sink_columns DESC) AS rn
    FROM route_config) WHERE rn = 1)"""
AS_OF_SQL = """
    SELECT c.sink_table, c.sink_columns, r.id, r.ts_ms FROM config_record r ASOF JOIN versions c
    ON r.source_table = c.source_table AND r.ts_ms >= c.ts_ms WHERE c.op <> 'd'"""


def config_records(spark, sf):
    """Change records of configured tables; the payload has every column that some version names."""
    cells = F.create_map(*[x for c in ("id", "name", *[f"c{i}" for i in range(5)]) for x in (F.lit(c), F.col("id"))])
    return st.record(spark, sf, "config_record").select(
        F.lit("c").alias("op"), F.lit(None).cast("map<string,string>").alias("before"), cells.alias("after"),
        F.create_map(F.lit("table"), F.col("source_table")).alias("source"), "ts_ms")


def routed_as_of(routed):
    """The columns the as-of queries show: what a version says is seen by the columns it lets through."""
    names = F.array_join(F.array_sort(F.map_keys("data")), ",")
    wanted = F.concat(F.lit("id,name,"), F.regexp_extract(names, "c[0-9]", 0))
    return routed.select("sink_table", wanted.alias("sink_columns"), F.col("row_key").alias("id"), "ts_ms")


@query("route_dim_as_of", AS_OF_SQL, ["route_config", "config_record"], CONFIG_RECORDS)
def route_dim_as_of(spark, sf):
    return routed_as_of(rt.route_dim_as_of(config_records(spark, sf), rt.config_versions(config_changes(spark, sf))))


EAST8 = "Asia/Shanghai"


def _east8(sql: str) -> str:
    """The same SQL with days that start at midnight eight hours east."""
    return sql.replace("ts_ms // 86400000", "(ts_ms + 28800000) // 86400000").replace(
        "(ts_ms - last_day", "(ts_ms + 28800000 - last_day")


@query("uv_daily_flag_east8", "SELECT row_id, mid, ts_ms, uv_ct, sv_ct, pv_ct, dur_sum FROM visits", ["page_log"], _east8(VISITS))
def uv_daily_flag_east8(spark, sf):
    return keyed.uv_daily_flag(st.record(spark, sf, "page_log"), zone=EAST8).select(
        "row_id", "mid", "ts_ms", "uv_ct", "sv_ct", "pv_ct", "dur_sum")


@query("uu_login_back_east8", _east8(login_sql(8)), ["page_log"])
def uu_login_back_east8(spark, sf):
    return keyed.uu_login_back(st.record(spark, sf, "page_log"), LOG_ORDER, EAST8)


@query("uu_cart_east8", _east8("""
    SELECT id, user_id, sku_id, sku_num, ts_ms FROM (
      SELECT *, lag(ts_ms // 86400000) OVER (PARTITION BY user_id ORDER BY ts_ms, id) AS last_day FROM cart_info)
    WHERE last_day IS DISTINCT FROM ts_ms // 86400000"""), ["cart_info"])
def uu_cart_east8(spark, sf):
    carts = st.record(spark, sf, "cart_info").select("id", "user_id", "sku_id", "sku_num", "ts_ms")
    return keyed.uu_cart(carts, ["ts_ms", "id"], EAST8)
