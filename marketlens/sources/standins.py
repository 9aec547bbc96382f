"""Retail records derived from the test tables.

Each record is one SELECT in the SQL that Spark and DuckDB share, so that a query and its oracle
start from the same rows. ``{table}`` names a test table, ``$MS(col)`` its epoch milliseconds and
``$K`` the number in ``props``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from marketlens.session import scratch

DB = "retail"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_BASE = "(1704067200000 + ({key} % 30) * 86400000)"
_ORDER_BASE = _BASE.format(key="o_orderkey")
_LINE_BASE = _BASE.format(key="l_orderkey")
_LINE_ID = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
_LINE_TS = f"{_LINE_BASE} + (l_linenumber * 2 + l_suppkey % 5) * 60000 + (l_partkey % 60) * 1000"
_PRICE = "CAST(l_extendedprice AS DECIMAL(16,2))"
_TYPE_NO = ("CASE p_type WHEN 'STANDARD' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 3 "
            "WHEN 'LARGE' THEN 4 WHEN 'ECONOMY' THEN 5 ELSE 6 END")

RECORDS: dict[str, str] = {
    "order_info": f"""
        SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS user_id,
               CAST(o_custkey % 27 AS STRING) AS province_id,
               CASE o_orderstatus WHEN 'F' THEN '1003' WHEN 'P' THEN '1001' ELSE '1006' END AS order_status,
               CAST({_ORDER_BASE} + 3600000 AS STRING) AS operate_time,
               CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS STRING) AS total_amount,
               CAST($MS(o_orderdate) + (o_orderkey % 24) * 3600000 AS STRING) AS create_time,
               CASE WHEN o_orderkey % 10 = 9 THEN 'u' ELSE 'r' END AS op,
               {_ORDER_BASE} + (o_orderkey % 7) * 60000 AS ts_ms
        FROM {{orders}}""",
    "order_detail": f"""
        SELECT {_LINE_ID} AS id, CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS sku_id,
               'sku ' || CAST(l_partkey AS STRING) AS sku_name,
               CAST($MS(l_shipdate) + l_linenumber * 3600000 AS STRING) AS create_time,
               CAST(l_suppkey AS STRING) AS source_id, '2401' AS source_type,
               CAST(CAST(l_quantity AS INT) AS STRING) AS sku_num, CAST({_PRICE} AS STRING) AS order_price,
               CAST(CAST({_PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS STRING)
                   AS split_total_amount,
               CAST(CAST({_PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS STRING)
                   AS split_activity_amount,
               CAST(CAST({_PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS STRING)
                   AS split_coupon_amount,
               'r' AS op, {_LINE_TS} AS ts_ms
        FROM {{lineitem}}""",
    "trade_order_detail": f"""
        SELECT {_LINE_ID} AS id, CAST(l_orderkey AS STRING) AS order_id, CAST(l_orderkey % 1000 AS STRING) AS user_id,
               CAST(l_partkey AS STRING) AS sku_id, 'sku ' || CAST(l_partkey AS STRING) AS sku_name,
               CAST(l_orderkey % 27 AS STRING) AS province_id, 'a' || CAST(l_suppkey % 10 AS STRING) AS activity_id,
               'r' || CAST(l_suppkey % 20 AS STRING) AS activity_rule_id,
               'c' || CAST(l_partkey % 50 AS STRING) AS coupon_id, CAST(CAST(l_shipdate AS DATE) AS STRING) AS date_id,
               CAST($MS(l_shipdate) + l_linenumber * 3600000 AS STRING) AS create_time,
               CAST(CAST(l_quantity AS INT) AS STRING) AS sku_num,
               CAST(CAST(l_quantity AS DECIMAL(16,2)) * {_PRICE} AS STRING) AS split_original_amount,
               CAST(CAST({_PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS STRING)
                   AS split_activity_amount,
               CAST(CAST({_PRICE} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS STRING) AS split_coupon_amount,
               CAST(CAST({_PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS STRING)
                   AS split_total_amount,
               {_LINE_TS} AS ts_ms
        FROM {{lineitem}}""",
    "order_detail_activity": f"""
        SELECT {_LINE_ID} AS order_detail_id, 'a' || CAST(l_suppkey % 10 AS STRING) AS activity_id,
               'r' || CAST(l_suppkey % 20 AS STRING) AS activity_rule_id, 'r' AS op, {_LINE_TS} AS ts_ms
        FROM {{lineitem}} WHERE l_discount > 0.05""",
    "order_detail_coupon": f"""
        SELECT {_LINE_ID} AS order_detail_id, 'c' || CAST(l_partkey % 50 AS STRING) AS coupon_id,
               'r' AS op, {_LINE_TS} AS ts_ms
        FROM {{lineitem}} WHERE l_tax > 0.04""",
    "payment_info": f"""
        SELECT CAST(o_custkey AS STRING) AS user_id, CAST(o_orderkey AS STRING) AS order_id,
               '110' || CAST(o_orderkey % 3 AS STRING) AS payment_type,
               CAST({_ORDER_BASE} + 600000 AS STRING) AS callback_time,
               CASE WHEN o_orderstatus = 'P' THEN '1601' WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN NULL
                    ELSE '1602' END AS payment_status,
               'r' AS op, {_ORDER_BASE} + 600000 AS ts_ms
        FROM {{orders}}""",
    "order_refund_info": f"""
        SELECT {_LINE_ID} AS id, CAST(l_orderkey % 1000 AS STRING) AS user_id,
               CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS sku_id,
               '150' || CAST(l_suppkey % 3 AS STRING) AS refund_type,
               CAST(CAST(l_quantity AS INT) AS STRING) AS refund_num, CAST({_PRICE} AS STRING) AS refund_amount,
               '130' || CAST(l_suppkey % 7 AS STRING) AS refund_reason_type,
               'reason ' || CAST(l_suppkey % 7 AS STRING) AS refund_reason_txt,
               CAST($MS(l_shipdate) AS STRING) AS create_time,
               CASE WHEN l_linestatus = 'F' THEN '0705' ELSE '0701' END AS refund_status,
               'r' AS op, {_LINE_TS} AS ts_ms
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "refund_payment": f"""
        SELECT 'p' || {_LINE_ID} AS id, CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS sku_id,
               '110' || CAST(l_suppkey % 3 AS STRING) AS payment_type,
               CAST($MS(l_shipdate) + 7200000 AS STRING) AS callback_time, CAST({_PRICE} AS STRING) AS total_amount,
               CASE WHEN l_tax >= 0.02 THEN '1602' ELSE '1601' END AS refund_status,
               'r' AS op, {_LINE_TS} AS ts_ms
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "comment_info": f"""
        SELECT {_LINE_ID} AS id, CAST(l_orderkey % 1000 AS STRING) AS user_id, CAST(l_partkey AS STRING) AS sku_id,
               '120' || CAST(l_suppkey % 7 AS STRING) AS appraise,
               'comment on ' || CAST(l_partkey AS STRING) AS comment_txt,
               CAST($MS(l_shipdate) AS STRING) AS create_time,
               CASE WHEN l_linenumber = 7 THEN 'c' ELSE 'r' END AS op, {_LINE_TS} AS ts_ms
        FROM {{lineitem}} WHERE l_returnflag = 'N'""",
    "cart_info": """
        SELECT CAST(event_id AS STRING) AS id, CAST(user_id AS STRING) AS user_id, CAST($K AS STRING) AS sku_id,
               CAST($K % 7 + 1 AS STRING) AS sku_num, CAST($K % 4 + 1 AS STRING) AS old_sku_num,
               CASE event_type WHEN 'view' THEN 'r' WHEN 'click' THEN 'u' WHEN 'purchase' THEN 'c'
                    WHEN 'error' THEN 'd' ELSE 'r' END AS op,
               $MS(ts) AS ts_ms
        FROM {events}""",
    "user_info": f"""
        SELECT CAST(o_custkey AS STRING) AS id, 'user ' || CAST(o_custkey AS STRING) AS name,
               'nick' || CAST(o_custkey % 100 AS STRING) AS nick_name,
               CASE WHEN o_custkey % 50 = 49 THEN NULL
                    ELSE CAST((o_custkey * 37) % 18000 - 3000 AS STRING) END AS birthday,
               '139' || CAST(10000000 + o_custkey AS STRING) AS phone_num,
               'u' || CAST(o_custkey AS STRING) || '@example.com' AS email,
               CASE o_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE NULL END AS gender,
               CAST(o_custkey % 4 AS STRING) AS user_level, 'login' || CAST(o_custkey AS STRING) AS login_name,
               'r' AS op, {_BASE.format(key='o_custkey')} + (o_orderkey % 300) * 60000 AS ts_ms,
               o_orderkey AS arrival
        FROM {{orders}}""",
    "user_info_sup_msg": f"""
        SELECT CAST(c_custkey AS STRING) AS uid, CAST(150 + c_custkey % 45 AS STRING) AS height, 'cm' AS unit_height,
               CAST(45 + c_custkey % 50 AS STRING) AS weight, 'kg' AS unit_weight,
               'r' AS op, {_BASE.format(key='c_custkey')} + (c_custkey % 120) * 60000 AS ts_ms
        FROM {{customer}}""",
    "route_config": """
        SELECT 'src_' || CAST(o_custkey % 40 AS STRING) AS source_table,
               'dim_' || CAST(o_custkey % 40 AS STRING) AS sink_table,
               'id,name,c' || CAST(o_orderkey % 5 AS STRING) AS sink_columns, 'info' AS sink_family,
               'id' AS sink_row_key,
               CASE WHEN o_orderkey % 10 = 0 THEN 'd' WHEN o_orderkey % 10 < 3 THEN 'u' WHEN o_orderkey % 10 < 6 THEN 'c'
                    ELSE 'r' END AS op,
               $MS(o_orderdate) + o_orderkey AS ts_ms
        FROM {orders}""",
    "config_record": """
        SELECT CAST(o_orderkey AS STRING) AS id, 'src_' || CAST(o_custkey % 45 AS STRING) AS source_table,
               $MS(o_orderdate) + (o_orderkey * 7919) % 86400000 AS ts_ms
        FROM {orders}""",
    "old_change": """
        SELECT CASE event_type WHEN 'view' THEN 'coupon_use' WHEN 'click' THEN 'favor_info' ELSE event_type END
                   AS source_table,
               CASE WHEN $K % 2 = 0 THEN 'insert' ELSE 'update' END AS source_type,
               $MS(ts) AS ts, CAST(event_id AS STRING) AS id, CAST(user_id AS STRING) AS user_id,
               CAST($K AS STRING) AS sku_id, 'x' AS remark
        FROM {events}""",
    "city_weather": """
        SELECT CAST(c_custkey + 110000 AS BIGINT) AS code,
               CASE c_nationkey WHEN 0 THEN '澳门特别行政区' WHEN 1 THEN '台湾省' WHEN 2 THEN '香港特别行政区'
                    ELSE 'province' || CAST(c_nationkey AS STRING) END AS province,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'city' || CAST(c_custkey % 300 AS STRING) END AS city,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'area' || CAST(c_custkey AS STRING) END AS area,
               CASE c_custkey % 7 WHEN 0 THEN '{"status":"0","info":"INVALID_USER_KEY"}'
                    WHEN 1 THEN '{"status":"1","info":"OK","lives":[[]]}'
                    WHEN 2 THEN '{"status":"1","info":"OK","lives":[]}'
                    WHEN 3 THEN '{"status":"1","info":"OK"}'
                    ELSE '{"status":"1","info":"OK","lives":[{"temperature":"' || CAST(c_custkey % 40 AS STRING)
                         || '","reporttime":"2025-05-' || CAST(10 + c_custkey % 20 AS STRING) || ' 08:00:00"}]}'
               END AS resp
        FROM {customer}""",
    "dim_base_dic": """
        SELECT '120' || CAST(r_regionkey AS STRING) AS dic_code, r_name AS dic_name FROM {region}""",
    "dim_base_province": """
        SELECT CAST(n_nationkey AS STRING) AS id, n_name AS name FROM {nation}""",
    "dim_sku_info": f"""
        SELECT CAST(p_partkey AS STRING) AS id, p_name AS sku_name, CAST(p_partkey % 500 AS STRING) AS spu_id,
               CAST(({_TYPE_NO}) * 100 + p_size AS STRING) AS category3_id, substr(p_brand, 7) AS tm_id
        FROM {{part}}""",
    "dim_spu_info": f"""
        SELECT CAST(p_partkey % 500 AS STRING) AS id, min('spu ' || p_name) AS spu_name,
               min(CAST(({_TYPE_NO}) * 100 + p_size AS STRING)) AS category3_id, min(substr(p_brand, 7)) AS tm_id
        FROM {{part}} GROUP BY p_partkey % 500""",
    "dim_base_trademark": """
        SELECT DISTINCT substr(p_brand, 7) AS id,
               CASE p_brand WHEN 'Brand#1' THEN '苹果' WHEN 'Brand#2' THEN '联想' WHEN 'Brand#3' THEN '小米'
                    WHEN 'Brand#4' THEN 'TCL' ELSE p_brand END AS tm_name
        FROM {part}""",
    "dim_base_category3": f"""
        SELECT DISTINCT CAST(({_TYPE_NO}) * 100 + p_size AS STRING) AS id,
               p_type || '-' || CAST(p_size AS STRING) AS name,
               CAST(({_TYPE_NO}) * 100 + p_size - p_size % 10 AS STRING) AS category2_id
        FROM {{part}}""",
    "dim_base_category2": f"""
        SELECT DISTINCT CAST(({_TYPE_NO}) * 100 + p_size - p_size % 10 AS STRING) AS id,
               p_type || ' group ' || CAST(p_size - p_size % 10 AS STRING) AS name,
               CAST(({_TYPE_NO}) AS STRING) AS category1_id
        FROM {{part}}""",
    "dim_base_category1": f"""
        SELECT DISTINCT CAST(({_TYPE_NO}) AS STRING) AS id,
               CASE p_type WHEN 'STANDARD' THEN '数码' WHEN 'SMALL' THEN '家居家装' WHEN 'MEDIUM' THEN '电脑办公'
                    WHEN 'LARGE' THEN '家用电器' WHEN 'ECONOMY' THEN '图书、音像、电子书刊' ELSE '手机' END AS name
        FROM {{part}}""",
    "category_compare_dic": f"""
        SELECT DISTINCT ({_TYPE_NO}) AS id,
               CASE p_type WHEN 'STANDARD' THEN '数码' WHEN 'SMALL' THEN '家居家装' WHEN 'MEDIUM' THEN '电脑办公'
                    WHEN 'LARGE' THEN '家用电器' WHEN 'ECONOMY' THEN '图书、音像、电子书刊' ELSE '手机' END
                   AS category_name,
               CASE p_type WHEN 'STANDARD' THEN '科技与数码' WHEN 'SMALL' THEN '家庭与育儿' WHEN 'MEDIUM' THEN '性价比'
                    WHEN 'LARGE' THEN '健康与养生' WHEN 'ECONOMY' THEN '学习与发展' ELSE '时尚与潮流' END
                   AS search_category
        FROM {{part}}""",
    "page_log": """
        SELECT event_id AS row_id, 'mid_' || CAST(user_id AS STRING) AS mid,
               CASE WHEN $K = 99 THEN NULL WHEN $K = 98 THEN '' ELSE CAST(user_id AS STRING) END AS uid,
               'sid_' || CAST(event_id AS STRING) AS sid, CAST(user_id % 7 AS STRING) AS ar,
               'ch_' || CAST($K % 5 AS STRING) AS ch, 'v2.1.' || CAST($K % 3 AS STRING) AS vc,
               CASE $K % 4 WHEN 0 THEN 'iOS 13.3.1' WHEN 1 THEN 'Android 11.0' WHEN 2 THEN 'Android 10.0'
                    ELSE 'Harmony 4.0' END AS os,
               'model_' || CAST(user_id % 3 + $K % 2 AS STRING) AS md,
               CASE user_id % 3 WHEN 0 THEN 'Apple' WHEN 1 THEN 'xiaomi' ELSE 'vivo' END AS ba,
               CASE WHEN $K % 3 = 0 THEN '1' ELSE '0' END AS is_new,
               CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'payment'
                    WHEN 'error' THEN 'cart' END AS page_id,
               CASE $K % 5 WHEN 0 THEN '' WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END
                   AS last_page_id,
               CASE WHEN $K % 5 = 2 THEN 'keyword' ELSE 'sku_id' END AS item_type,
               CASE WHEN $K = 52 THEN NULL
                    WHEN $K % 5 = 2 THEN CASE $K % 6 WHEN 0 THEN 'PROMO' WHEN 1 THEN 'STANDARD' WHEN 2 THEN 'SMALL'
                         WHEN 3 THEN 'MEDIUM' WHEN 4 THEN 'LARGE' ELSE 'ECONOMY' END || '-' || CAST($K AS STRING)
                    ELSE CAST(user_id AS STRING) END AS item,
               CAST(floor(value * 10) AS BIGINT) AS during_time, event_type, $K AS k, $MS(ts) AS ts_ms
        FROM {events}""",
}

_SPARK_FUNCTIONS = [
    (r"\$MS\((\w+)\)", r"(unix_date(CAST(\1 AS DATE)) * 86400000L + hour(\1) * 3600000 + minute(\1) * 60000"
                        r" + CAST(date_part('SECOND', \1) * 1000 AS BIGINT))"),
    (r"\$K", "CAST(get_json_object(props, '$.k') AS BIGINT)"),
]
_DUCKDB_FUNCTIONS = [
    (r"\$MS\((\w+)\)", r"(epoch_us(\1) // 1000)"),
    (r"\$K", "CAST(json_extract_string(props, '$.k') AS BIGINT)"),
]


def _translate(text: str, rules: list[tuple[str, str]]) -> str:
    return reduce(lambda t, rule: re.sub(rule[0], rule[1], t), rules, text)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def record(spark: SparkSession, sf_dir: str, name: str, row_id: bool = False) -> DataFrame:
    """Rows of a retail record, one typed column per field.

    ``row_id`` adds the position of the row in its file, which names a row even among exact copies.
    """
    text = _translate(RECORDS[name], _SPARK_FUNCTIONS)
    names = re.findall(r"FROM \{(\w+)\}", text)
    if row_id:
        text = re.sub(r"^\s*SELECT", "SELECT row_id,", text)
        position = F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias("row_id")
        used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").select("*", position) for t in names}
    else:
        used = {t: table(spark, sf_dir, t) for t in names}
    quoted = text.replace("{", "{{").replace("}", "}}")
    return spark.sql(re.sub(r"FROM {{(\w+)}}", r"FROM {\1}", quoted), **used)


def record_sql(*names: str) -> str:
    """The same records as common table expressions for DuckDB, without the leading WITH."""
    parts = []
    for name in names:
        text = _translate(RECORDS[name], _DUCKDB_FUNCTIONS)
        parts.append(f"{name} AS ({re.sub(r'FROM {(\w+)}', r'FROM \1', text)})")
    return ",\n".join(parts)


def _as_map(columns: dict[str, str]) -> Column:
    return F.create_map(*[x for key, c in columns.items() for x in (F.lit(key), F.col(c).cast("string"))])


def change_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A record as change-log rows ``op, before, after, source, ts_ms``.

    Columns named ``old_x`` hold the value of ``x`` before an update; deletes carry ``before`` only.
    """
    df = record(spark, sf_dir, name)
    if "op" not in df.columns:
        df = df.withColumn("op", F.lit("r")).withColumn("ts_ms", F.lit(1704067200000).cast("bigint"))
    old = [c for c in df.columns if c.startswith("old_")]
    fields = [c for c in df.columns if c not in ("op", "ts_ms", "arrival", *old)]
    now = _as_map({c: c for c in fields})
    then = _as_map({c: f"old_{c}" if f"old_{c}" in old else c for c in fields})
    return df.select(
        "op",
        F.when(F.col("op").isin("u", "d"), then).alias("before"),
        F.when(F.col("op") != "d", now).alias("after"),
        F.create_map(F.lit("db"), F.lit(DB), F.lit("table"), F.lit(name),
                     F.lit("ts_ms"), F.col("ts_ms").cast("string")).alias("source"),
        F.col("ts_ms").cast("bigint").alias("ts_ms"))


def change_log(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The change rows of several records in one table."""
    return reduce(DataFrame.unionByName, [change_rows(spark, sf_dir, n) for n in names])


def change_lines(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The change log as one JSON text per row, the shape it has in a topic."""
    return change_log(spark, sf_dir, *names).select(
        F.to_json(F.struct("op", "before", "after", "source", "ts_ms")).alias("value"), "ts_ms")


def _steps(count: Column, build) -> Column:
    indexes = F.sequence(F.lit(1).cast("bigint"), count)
    return F.when(count > 0, F.transform(indexes, build)).otherwise(F.array())


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client logs as nested rows: common, page or start, err, displays, actions, ts."""
    df = record(spark, sf_dir, "page_log")
    text = lambda c: c.cast("string")
    return df.select(
        "row_id", "k",
        F.struct("mid", "uid", "sid", "ar", "ch", "vc", "os", "md", "ba", "is_new").alias("common"),
        F.when(F.col("page_id").isNotNull(), F.struct(
            "page_id", "last_page_id", "item", "item_type", "during_time")).alias("page"),
        F.when(F.col("page_id").isNull(), F.create_map(
            F.lit("entry"), F.lit("icon"), F.lit("loading_time"), text(F.col("k")))).alias("start"),
        F.when(F.col("event_type") == "error", F.create_map(
            F.lit("error_code"), text(F.col("k") + 1000), F.lit("msg"), F.lit("failed"))).alias("err"),
        _steps(F.col("k") % 4, lambda i: F.create_map(
            F.lit("item"), text(F.col("k") + i), F.lit("pos_id"), text(i))).alias("displays"),
        _steps(F.col("k") % 3, lambda i: F.create_map(
            F.lit("action_id"), F.concat(F.lit("act"), text(i)), F.lit("item"), text(F.col("k")))).alias("actions"),
        F.col("ts_ms").alias("ts"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client logs as one JSON text per row; rows with k = 97 are cut off and cannot be parsed."""
    line = F.to_json(F.struct("common", "page", "start", "err", "displays", "actions", "ts"))
    return log_rows(spark, sf_dir).select(
        "row_id", F.when(F.col("k") == 97, F.substring(line, 1, 25)).otherwise(line).alias("value"))


_TOPICS: dict[tuple[str, ...], str] = {}


def stored_topic(spark: SparkSession, label: str, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Lines as they lie in a topic, with ``row_id`` as offset; written once per session and read from there."""
    key = (spark.sparkContext.applicationId, label, sf_dir)
    if key not in _TOPICS:
        path = scratch(spark, f"topic-{label}")
        lines.write.parquet(path)
        _TOPICS[key] = path
    return spark.read.schema(lines.schema).parquet(_TOPICS[key])


def log_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client-log topic."""
    return stored_topic(spark, "log", sf_dir, log_lines(spark, sf_dir))
