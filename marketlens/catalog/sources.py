"""Queries over the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.catalog.registry import moment, query, window
from marketlens.operators.sinks import topic_append
from marketlens.session import scratch
from marketlens.sources import readers as rd, standins as st
from marketlens.streaming.flows import drain

_FACT = ("id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id, date_id, "
         "create_time, sku_num, split_original_amount, split_activity_amount, split_coupon_amount, "
         "split_total_amount, ts_ms")


@query("src_json_stream", "SELECT id, user_id, order_status, op, ts_ms FROM order_info", ["order_info"])
def src_json_stream(spark, sf):
    path = scratch(spark, "topic")
    topic_append(st.change_lines(spark, sf, "order_info"), path)
    rows = drain(rd.line_stream(spark, path), scratch(spark, "lines"), scratch(spark, "checkpoint"))
    a = F.col("after")
    return rd.envelope_table(rows).select(
        a["id"].alias("id"), a["user_id"].alias("user_id"), a["order_status"].alias("order_status"), "op", "ts_ms")


@query("src_envelope_table", """
    SELECT 'order_info' AS tab, op, id, ts_ms FROM order_info
    UNION ALL SELECT 'payment_info', op, order_id, ts_ms FROM payment_info
    UNION ALL SELECT 'cart_info', op, CASE WHEN op <> 'd' THEN id END, ts_ms FROM cart_info""",
       ["order_info", "payment_info", "cart_info"])
def src_envelope_table(spark, sf):
    rows = rd.envelope_table(st.change_lines(spark, sf, "order_info", "payment_info", "cart_info"))
    a = F.col("after")
    return rows.select(F.col("source")["table"].alias("tab"), "op",
                       F.coalesce(a["id"], a["order_id"]).alias("id"), "ts_ms")


@query("src_page_log_table", f"""
    SELECT mid, page_id, {moment(window('ts_ms', 1))} AS rt FROM page_log WHERE k <> 97""", ["page_log"])
def src_page_log_table(spark, sf):
    rows = rd.page_log_table(st.log_topic(spark, sf)).where("common.mid IS NOT NULL")  # lines that are cut off have none
    return rows.select("common.mid", "page.page_id", F.substring(F.col("rt").cast("string"), 1, 19).alias("rt"))


@query("src_order_detail_table", f"SELECT {_FACT} FROM trade_order_detail", ["trade_order_detail"])
def src_order_detail_table(spark, sf):
    facts = st.record(spark, sf, "trade_order_detail")
    return rd.order_detail_table(facts.select(F.to_json(F.struct("*")).alias("value")))


@query("src_cdc_snapshot", """
    SELECT 'r' AS op, 'orders' AS tab, CAST(o_orderkey AS VARCHAR) AS id,
           CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS VARCHAR) AS order_day,
           round(CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS DOUBLE), 2) AS price,
           epoch_us(o_orderdate) // 1000 AS ts_ms
    FROM orders""")
def src_cdc_snapshot(spark, sf):
    orders = st.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(16,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"))
    millis = F.datediff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86_400_000
    a = F.col("after")
    return rd.snapshot_as_changes(orders, "shop", "orders", millis).select(
        "op", F.col("source")["table"].alias("tab"), a["o_orderkey"].alias("id"), a["o_orderdate"].alias("order_day"),
        F.round(a["o_totalprice"].cast("double"), 2).alias("price"), "ts_ms")


_SNAPSHOTS = """
    old AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderdate >= DATE '1996-01-01' THEN 'O' ELSE o_orderstatus END
              AS status FROM orders WHERE o_orderdate < DATE '1997-01-01'),
    new AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status FROM orders WHERE o_orderdate >= DATE '1993-01-01')"""


@query("src_cdc_changes", f"""WITH {_SNAPSHOTS}
    SELECT CASE WHEN o.id IS NULL THEN 'c' WHEN n.id IS NULL THEN 'd' ELSE 'u' END AS op, o.id AS before_id,
           o.status AS before_status, n.id AS after_id, n.status AS after_status
    FROM old o FULL JOIN new n ON o.id = n.id WHERE o.status IS DISTINCT FROM n.status OR o.id IS NULL OR n.id IS NULL""")
def src_cdc_changes(spark, sf):
    # A snapshot of the orders placed up to 1997, the last year's still open; then one of all orders since 1993.
    orders = st.table(spark, sf, "orders")
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    placed, status = F.col("o_orderdate"), F.col("o_orderstatus")
    old = orders.where(placed < day("1997-01-01")).select(
        F.col("o_orderkey").alias("id"), F.when(placed >= day("1996-01-01"), "O").otherwise(status).alias("status"))
    new = orders.where(placed >= day("1993-01-01")).select(F.col("o_orderkey").alias("id"), status.alias("status"))
    changes = rd.snapshot_difference(old, new, "id", st.DB, "orders", F.lit(1704067200000))
    return changes.select("op", *[F.col(w)[c].alias(f"{w}_{c}") for w in ("before", "after") for c in ("id", "status")])


@query("src_dim_table", "SELECT dic_code, dic_name FROM dim_base_dic", ["dim_base_dic"])
def src_dim_table(spark, sf):
    return rd.dim_table(st.record(spark, sf, "dim_base_dic"), "dic_code").select("dic_code", "info.dic_name")


@query("src_dim_get", """SELECT id, sku_name AS "skuName", spu_id AS "spuId" FROM dim_sku_info WHERE id = '42'""",
       ["dim_sku_info"])
def src_dim_get(spark, sf):
    sku = st.record(spark, sf, "dim_sku_info").select("id", "sku_name", "spu_id")
    return rd.dim_get(sku, "id", "42", camel=True)


@query("src_dim_scan_limit", """
    SELECT id, sku_name, id AS row_key FROM dim_sku_info ORDER BY id LIMIT 10""", ["dim_sku_info"])
def src_dim_scan_limit(spark, sf):
    return rd.dim_scan_limit(st.record(spark, sf, "dim_sku_info").select("id", "sku_name"), "id", 10)


@query("src_jdbc_query", """
    SELECT b3.id, b3.name AS "b3Name", b2.name AS "b2Name" FROM dim_base_category3 b3
    JOIN dim_base_category2 b2 ON b3.category2_id = b2.id""", ["dim_base_category3", "dim_base_category2"])
def src_jdbc_query(spark, sf):
    return rd.table_query(
        spark, "SELECT b3.id, b3.name AS b3_name, b2.name AS b2_name FROM {c3} b3 JOIN {c2} b2 "
               "ON b3.category2_id = b2.id", camel=True,
        c3=st.record(spark, sf, "dim_base_category3"), c2=st.record(spark, sf, "dim_base_category2"))


def region_lines(spark, sf):
    """Region code lines ``code province,city,area`` with parts missing at the end."""
    c = st.record(spark, sf, "city_weather")
    parts = F.concat_ws(",", "province", "city", F.when(F.col("city").isNotNull(), F.col("area")))
    return c.select(F.concat_ws(" ", F.col("code").cast("string"), parts).alias("value"))


REGION_SQL = "SELECT code, province, city, CASE WHEN city IS NOT NULL THEN area END AS area FROM city_weather"


@query("src_region_code_file", REGION_SQL, ["city_weather"])
def src_region_code_file(spark, sf):
    path = scratch(spark, "regions")
    topic_append(region_lines(spark, sf), path)
    return rd.region_codes(spark, path)


def word_files(spark, sf):
    """Write the words of the benchmark texts as ``.txt`` word lists; returns the folder."""
    path = scratch(spark, "words")
    texts = st.table(spark, sf, "benchmark")
    topic_append(texts, path, F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " , "))
    return path


WORD_SET = ("word_set AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word "
            "FROM benchmark)")


@query("src_word_files", "SELECT word FROM word_set WHERE word <> ''", ctes=WORD_SET)
def src_word_files(spark, sf):
    return rd.word_lists(spark, word_files(spark, sf))
