"""Queries that write through each sink and read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.catalog.registry import query, window, window_text
from marketlens.catalog.sources import REGION_SQL, region_lines
from marketlens.operators import routing as rt, sinks as sk, windows as win
from marketlens.session import scratch
from marketlens.sources import readers as rd, standins as st
from marketlens.sources.schemas import ROUTE

# Routes of the dimension jobs: source table, sink table, columns, family, row key.
ROUTES = [
    ("user_info", "dim_user_info", "id,name,gender,birthday", "info", "id"),
    ("user_info_sup_msg", "dim_user_sup", "uid,height,weight", "info", "uid"),
    ("cart_info", "dim_cart", "id,sku_id,sku_num", "info", "id"),
]
ROUTED = ("user_info", "user_info_sup_msg", "cart_info", "order_info")


def routes(spark):
    """The routes as a DataFrame."""
    return rd.local_table(spark, ROUTE, ROUTES)


@query("sink_topic_append", "SELECT order_id, ts_ms FROM payment_info", ["payment_info"])
def sink_topic_append(spark, sf):
    path = scratch(spark, "topic")
    sk.topic_append(st.change_lines(spark, sf, "payment_info"), path)
    return rd.envelope_table(rd.lines(spark, path)).select(F.col("after")["order_id"].alias("order_id"), "ts_ms")


@query("sink_topic_dynamic", """
    SELECT 'user_info' AS topic, count(*) AS n FROM user_info UNION ALL
    SELECT 'user_info_sup_msg', count(*) FROM user_info_sup_msg UNION ALL
    SELECT 'payment_info', count(*) FROM payment_info""", ["user_info", "user_info_sup_msg", "payment_info"])
def sink_topic_dynamic(spark, sf):
    path = scratch(spark, "topics")
    lines = st.change_lines(spark, sf, "user_info", "user_info_sup_msg", "payment_info")
    tagged = lines.withColumn("topic", F.get_json_object("value", "$.source.table"))
    sk.topic_dynamic(tagged, path, "topic")
    return spark.read.text(path).groupBy("topic").agg(F.count("*").alias("n"))


_USER_ORDER = ["ts_ms", "arrival"]


@query("sink_upsert", """
    SELECT id, name, gender, ts_ms FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, arrival DESC) AS rn FROM user_info)
    WHERE rn = 1 AND gender IS NOT NULL""", ["user_info"])
def sink_upsert(spark, sf):
    # A version without a gender is a tombstone: it deletes the key unless a newer version follows.
    path = scratch(spark, "keyed")
    users = st.record(spark, sf, "user_info")
    late = F.col("arrival") % 2 == 1
    sk.upsert(users.where(~late), path, 0, ["id"], _USER_ORDER)
    sk.upsert(users.where(late), path, 1, ["id"], _USER_ORDER)
    sk.upsert(users.where(late), path, 1, ["id"], _USER_ORDER)
    target = scratch(spark, "compacted")
    sk.compact(spark, path, target, ["id"], _USER_ORDER)
    return sk.read_upserted(spark, target, ["id"], _USER_ORDER, F.col("gender").isNull()).select("id", "name", "gender", "ts_ms")


# Per cell the last non-empty value after the last delete of the row.
CELLS = """
cells AS (
  SELECT 'dim_user_info' AS sink_table, id AS row_key, 'c' AS op, ts_ms, unnest(['id', 'name', 'gender', 'birthday'])
         AS col, unnest([id, name, gender, birthday]) AS val FROM user_info
  UNION ALL
  SELECT 'dim_user_sup', uid, 'c', ts_ms, unnest(['uid', 'height', 'weight']), unnest([uid, height, weight])
  FROM user_info_sup_msg
  UNION ALL
  SELECT 'dim_cart', id, op, ts_ms, unnest(['id', 'sku_id', 'sku_num']), unnest([id, sku_id, sku_num]) FROM cart_info),
gone AS (SELECT sink_table, row_key, max(ts_ms) AS gone_ts FROM cells WHERE op = 'd' GROUP BY 1, 2),
puts AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.sink_table, c.row_key, col ORDER BY ts_ms DESC, val DESC) AS rn
  FROM cells c LEFT JOIN gone g ON c.sink_table = g.sink_table AND c.row_key = g.row_key
  WHERE op <> 'd' AND val IS NOT NULL AND val <> '' AND (gone_ts IS NULL OR ts_ms > gone_ts))"""
CELLS_SQL = "SELECT sink_table, row_key, col, val FROM puts WHERE rn = 1"


@query("sink_dim_upsert", CELLS_SQL, ["user_info", "user_info_sup_msg", "cart_info"], CELLS)
def sink_dim_upsert(spark, sf):
    path = scratch(spark, "dims")
    changes = st.change_log(spark, sf, *ROUTED)
    routed = rt.route_dim_by_config(changes, routes(spark))
    early = F.col("ts_ms") < 1705363200000
    sk.dim_upsert(routed.where(~early), path, 0)
    sk.dim_upsert(routed.where(early), path, 1)
    return sk.read_dims(spark, path).select("sink_table", "row_key", F.explode("cells").alias("col", "val"))


MD5_SQL = """
    SELECT sink_table, row_key, col, val FROM (
      SELECT *, row_number() OVER (PARTITION BY sink_table, row_key, col ORDER BY ts_ms DESC, val DESC) AS rn FROM (
        SELECT 'dim_user_sup' AS sink_table, md5(uid) AS row_key, ts_ms,
               unnest(['uid', 'height', 'unit_height', 'weight', 'unit_weight']) AS col,
               unnest([uid, height, unit_height, weight, unit_weight]) AS val FROM user_info_sup_msg
        UNION ALL
        SELECT 'dim_cart', md5(id), ts_ms, unnest(['id', 'user_id', 'sku_id', 'sku_num']),
               unnest([id, user_id, sku_id, sku_num]) FROM cart_info WHERE op <> 'd'
        UNION ALL
        SELECT 'dim_user_info', md5(id), ts_ms,
               unnest(['id', 'name', 'nick_name', 'birthday', 'phone_num', 'email', 'gender', 'user_level',
                       'login_name']),
               unnest([id, name, nick_name, coalesce(birthday, 'null'), phone_num, email, coalesce(gender, 'null'),
                       user_level, login_name]) FROM user_info))
    WHERE rn = 1"""


@query("sink_dim_upsert_md5", MD5_SQL, ["user_info", "user_info_sup_msg", "cart_info"])
def sink_dim_upsert_md5(spark, sf):
    path = scratch(spark, "dims")
    sk.dim_upsert(rt.route_dim_md5(st.change_log(spark, sf, *ROUTED), routes(spark)), path, 0)
    return sk.read_dims(spark, path).select("sink_table", "row_key", F.explode("cells").alias("col", "val"))


@query("sink_dim_delete_keys", """
    SELECT id AS row_key, sku_name FROM dim_sku_info
    WHERE category3_id NOT IN (SELECT id FROM dim_base_category3 WHERE category2_id LIKE '6%')""",
       ["dim_sku_info", "dim_base_category3"])
def sink_dim_delete_keys(spark, sf):
    sku = st.record(spark, sf, "dim_sku_info").withColumnRenamed("id", "row_key")
    closed = st.record(spark, sf, "dim_base_category3").where("category2_id LIKE '6%'")
    keys = sku.join(closed.select(F.col("id").alias("category3_id")), "category3_id").select("row_key")
    return sk.delete_keys(sku.select("row_key", "sku_name"), keys)


@query("sink_olap_append", f"""
    SELECT {window_text('w', 10)}, n FROM (
      SELECT {window('ts_ms', 10)} AS w, count(*) AS n FROM page_log GROUP BY 1)""", ["page_log"])
def sink_olap_append(spark, sf):
    path = scratch(spark, "olap")
    rows = win.with_window_text(win.count_window(st.record(spark, sf, "page_log"), 10, "n"), 10)
    sk.olap_append(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("sink_jdbc_append", REGION_SQL, ["city_weather"])
def sink_jdbc_append(spark, sf):
    lines, path = scratch(spark, "regions"), scratch(spark, "table")
    sk.topic_append(region_lines(spark, sf), lines)
    sk.table_append(rd.region_codes(spark, lines), path)
    return spark.read.parquet(path)


@query("sink_csv_append", "SELECT id, name FROM dim_base_province", ["dim_base_province"])
def sink_csv_append(spark, sf):
    path = scratch(spark, "text")
    sk.text_append(st.record(spark, sf, "dim_base_province"), path)
    return rd.parse_json(rd.lines(spark, path), "id STRING, name STRING")


@query("sink_print", "SELECT id, name FROM dim_base_province", ["dim_base_province"])
def sink_print(spark, sf):
    rows = st.record(spark, sf, "dim_base_province")
    sk.print_rows(rows, 3)
    return rows
