"""The whole jobs as queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlens.catalog import joins as jn
from marketlens.catalog.aggregates import HOME, HOME_SQL, KEYWORD_SQL, LATEST, LOG_ORDER, REPORT_SQL, VERSION
from marketlens.catalog.filters import CART_SQL, CLEAN, REGION_WHERE, USERS, WEATHER, as_of
from marketlens.catalog.registry import query, window, window_text
from marketlens.catalog.sinks import CELLS, CELLS_SQL, ROUTES, ROUTED
from marketlens.catalog.sources import REGION_SQL, WORD_SET, region_lines, word_files
from marketlens.catalog.state import FIXED, VISITS, login_sql
from marketlens.operators import dedupe as dd, filters as fl, keyed, logs as lg, sinks as sk
from marketlens.plans import dims, profile as pf, windows as wd
from marketlens.session import scratch
from marketlens.sources import readers as rd, standins as st
from marketlens.sources.schemas import LOG, ROUTE


@query("job_ods", """
    SELECT 'orders' AS tab, CAST(o_orderkey AS VARCHAR) AS id, 'r' AS op FROM orders
    UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), 'r' FROM customer""")
def job_ods(spark, sf):
    path = scratch(spark, "topic")
    for name, key in (("orders", "o_orderkey"), ("customer", "c_custkey")):
        table = st.table(spark, sf, name)
        changes = rd.snapshot_as_changes(table, st.DB, name, F.lit(1704067200000))
        sk.topic_append(changes, path, F.to_json(F.struct(*changes.columns)))
    rows = rd.envelope_table(rd.lines(spark, path))
    return rows.select(F.col("source")["table"].alias("tab"),
                       F.coalesce(F.col("after")["o_orderkey"], F.col("after")["c_custkey"]).alias("id"), "op")


# A database that changes while it is read: orders are updated, deleted and created at positions of its log.
_PARTS, _STEP = 8, 1000
_ODS_CHANGES = f"""
ods_log AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey % {_PARTS} AS part, (o_orderkey * 7919 + n * 104729) % {3 * _PARTS * _STEP} * 64 + n
           AS position, CASE WHEN n = 2 AND o_orderkey % 5 = 0 THEN 'd' ELSE 'u' END AS op, 'v' || CAST(n AS VARCHAR) AS status
  FROM orders, (SELECT unnest([0, 1, 2]) AS n) WHERE o_orderkey % 3 = 0)"""


@query("job_ods_hand_over", """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, coalesce(l.status, o_orderstatus) AS status FROM orders
    LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY position DESC) AS rn FROM ods_log) WHERE rn = 1) l
    ON l.key = CAST(o_orderkey AS VARCHAR) WHERE l.op IS NULL OR l.op <> 'd'""", ctes=_ODS_CHANGES)
def job_ods_hand_over(spark, sf):
    orders = st.table(spark, sf, "orders")
    cells = lambda status: F.create_map(F.lit("id"), F.col("key"), F.lit("status"), status)
    key, part = F.col("o_orderkey").cast("string").alias("key"), (F.col("o_orderkey") % _PARTS).cast("int").alias("part")
    n = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("n")
    position = (F.col("o_orderkey") * 7919 + F.col("n") * 104729) % (3 * _PARTS * _STEP) * 64 + F.col("n")
    log = orders.where("o_orderkey % 3 = 0").select("o_orderkey", key, part, n).select(
        "key", "part", position.alias("position"), F.when((F.col("n") == 2) & (F.col("o_orderkey") % 5 == 0), "d").otherwise("u").alias("op"),
        F.concat(F.lit("v"), F.col("n").cast("string")).alias("status"))
    gone = F.col("op") == "d"
    log = log.select("key", "part", "position", "op", F.when(gone, cells(F.col("status"))).alias("before"),
                     F.when(~gone, cells(F.col("status"))).alias("after"), F.col("position").alias("ts_ms"))
    # Range k is read at some position between its marks, while later ranges still wait.
    at = (F.col("part") + 1) * (2 * _STEP * 64) + 500 * 64
    marks = spark.range(_PARTS).select(F.col("id").cast("int").alias("part")).select(
        "part", (at - 500 * 64).alias("low"), (at + 700 * 64).alias("high"))
    state = log.where(F.col("position") <= at).groupBy("key").agg(F.max_by(F.struct("op", "after"), "position").alias("c"))
    read = orders.select(key, part, "o_orderstatus").join(state, "key", "left").where("c IS NULL OR c.op <> 'd'").select(
        "key", "part", F.when(F.col("c").isNull(), cells(F.col("o_orderstatus"))).otherwise(F.col("c.after")).alias("after"))
    path = scratch(spark, "topic")
    changes = rd.hand_over(read, marks, log)
    sk.topic_append(changes, path, F.to_json(F.struct(*changes.columns)))
    rows = spark.read.schema(changes.schema).json(path)
    # The topic's reader needs no more than the order: the hand-over first, then the log.
    last = rows.groupBy("key").agg(F.max_by(F.struct("op", "after"), F.coalesce("position", F.lit(-1))).alias("c"))
    return last.where("c.op <> 'd'").select("key", F.col("c.after")["status"].alias("status"))


def _route_changes(spark):
    """Config changes: the routes, one that is replaced and one that is deleted."""
    none = F.lit(None).cast("map<string,string>")
    rows = [("u", *r, 1) for r in ROUTES] + [
        ("r", "order_info", "dim_order", "id", "info", "id", 1), ("d", "order_info", "dim_order", "id", "info", "id", 2),
        ("r", "cart_info", "dim_old_cart", "id", "info", "id", 0)]
    df = rd.local_table(spark, f"op STRING, {ROUTE}, ts_ms BIGINT", rows)
    fields = [c for c in df.columns if c not in ("op", "ts_ms")]
    payload = F.create_map(*[x for c in fields for x in (F.lit(c), F.col(c))])
    return df.select("op", F.when(F.col("op") == "d", payload).otherwise(none).alias("before"),
                     F.when(F.col("op") != "d", payload).otherwise(none).alias("after"), "ts_ms")


@query("job_dim", CELLS_SQL, ["user_info", "user_info_sup_msg", "cart_info"], CELLS)
def job_dim(spark, sf):
    database = f"dims_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch(spark, 'dim-tables')}'")
    for name in {r[1] for r in ROUTES}:  # rows of an earlier config, which the update must not leave
        spark.sql(f"CREATE TABLE {database}.{name} (row_key STRING, info MAP<STRING,STRING>) USING parquet")
        spark.sql(f"INSERT INTO {database}.{name} VALUES ('old', map('old', 'old'))")
    rows = dims.dim_job(spark, st.change_log(spark, sf, *ROUTED), _route_changes(spark), st.DB, database,
                        scratch(spark, "dim-rows"))
    return rows.select("sink_table", "row_key", F.explode("cells").alias("col", "val"))


LOG_TOPICS = f"""
    SELECT 'err' AS stream, count(*) AS n, sum(CAST(is_new AS BIGINT))::BIGINT AS new_ct FROM log
    WHERE event_type = 'error'
    UNION ALL SELECT 'start', count(*), sum(CAST(is_new AS BIGINT))::BIGINT FROM log WHERE page_id IS NULL
    UNION ALL SELECT 'display', sum(k % 4)::BIGINT, sum(k % 4 * CAST(is_new AS BIGINT))::BIGINT FROM log
    WHERE page_id IS NOT NULL
    UNION ALL SELECT 'action', sum(k % 3)::BIGINT, sum(k % 3 * CAST(is_new AS BIGINT))::BIGINT FROM log
    WHERE page_id IS NOT NULL
    UNION ALL SELECT 'page', count(*), sum(CAST(is_new AS BIGINT))::BIGINT FROM log WHERE page_id IS NOT NULL
    UNION ALL SELECT 'dirty', count(*), NULL FROM page_log WHERE k = 97"""
LOG_FIXED = FIXED.replace("FROM page_log", f"FROM (SELECT * FROM page_log WHERE {CLEAN})") + """,
log AS (SELECT p.* EXCLUDE (is_new), f.is_new FROM page_log p JOIN fixed f ON p.row_id = f.row_id)"""


@query("job_dwd_log", LOG_TOPICS, ["page_log"], LOG_FIXED)
def job_dwd_log(spark, sf):
    clean, dirty = rd.split_dirty(st.log_topic(spark, sf), LOG)
    flat = clean.withColumns({"mid": F.col("common.mid"), "is_new": F.col("common.is_new"), "ts_ms": F.col("ts")})
    fixed = keyed.fix_is_new(flat, LOG_ORDER).withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
    path = scratch(spark, "log")
    lines = lg.tagged_log_lines(fixed.select("common", "page", "start", "err", "displays", "actions", "ts"))
    sk.topic_dynamic(lines.unionByName(dirty.select(F.lit("dirty").alias("stream"), "value")), path, "stream")
    mark = F.get_json_object("value", "$.common.is_new").try_cast("bigint")
    return spark.read.text(path).groupBy("stream").agg(F.count("*").alias("n"), F.sum(mark).alias("new_ct"))


def _upserted(df, spark, key):
    """Write a fact through the keyed sink and read it back."""
    path, rest = scratch(spark, "fact"), [c for c in df.columns if c not in ("ts_ms", key)]
    order = ["ts_ms", *rest]
    sk.upsert(df, path, 0, [key], order)
    return sk.read_upserted(spark, path, [key], order).select(*df.columns)


def _last(sql, key, columns):
    """The last row per key of a fact, in the order the keyed sink uses."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["ts_ms", *[c for c in columns if c not in ("ts_ms", key)]])
    return (f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
            f"FROM ({sql})) WHERE rn = 1")


_COMMENT = ["id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms"]


@query("job_comment", _last("""
    SELECT c.id, c.user_id, c.sku_id, c.appraise, d.dic_name AS appraise_name, c.comment_txt, c.ts_ms
    FROM comment_info c JOIN dim_base_dic d ON c.appraise = d.dic_code WHERE c.op = 'r'""", "id", _COMMENT),
       ["comment_info", "dim_base_dic"])
def job_comment(spark, sf):
    return _upserted(jn.join_comment_dic(spark, sf), spark, "id")


@query("job_cart_add", _last(CART_SQL, "id", ["id", "user_id", "sku_id", "sku_num", "ts_ms"]), ["cart_info"])
def job_cart_add(spark, sf):
    return _upserted(fl.filter_cart_add(st.change_log(spark, sf, "cart_info")), spark, "id")


_DETAIL = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
           "coupon_id", "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
           "split_coupon_amount", "split_total_amount", "ts_ms"]


@query("job_order_detail", _last("SELECT * FROM fact", "id", _DETAIL), jn.DETAIL_RECORDS, jn.DETAIL_FACT)
def job_order_detail(spark, sf):
    return _upserted(jn.join_order_detail_4way(spark, sf), spark, "id")


_CANCEL = [c if c != "create_time" else "cancel_time" for c in _DETAIL]


@query("job_order_cancel", _last(jn.CANCEL_SQL, "id", _CANCEL), ["trade_order_detail", "order_info"])
def job_order_cancel(spark, sf):
    return _upserted(jn.join_cancel(spark, sf), spark, "id")


_PAYMENT = ["order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
            "activity_rule_id", "coupon_id", "payment_type_code", "callback_time", "sku_num", "split_original_amount",
            "split_activity_amount", "split_coupon_amount", "split_payment_amount", "ts_ms"]


@query("job_payment", _last(jn.PAYMENT_SQL, "order_detail_id", _PAYMENT), ["trade_order_detail", "payment_info"])
def job_payment(spark, sf):
    return _upserted(jn.join_payment(spark, sf), spark, "order_detail_id")


_REFUND = ["id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time", "refund_type_code",
           "refund_reason_type_code", "refund_reason_txt", "refund_num", "refund_amount", "ts_ms"]


@query("job_refund", _last(jn.REFUND_SQL, "id", _REFUND), ["order_refund_info", "order_info"])
def job_refund(spark, sf):
    return _upserted(jn.join_refund(spark, sf), spark, "id")


_REFUND_PAY = ["id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "date_id", "callback_time",
               "refund_num", "refund_amount", "ts_ms"]


@query("job_refund_pay", _last(jn.REFUND_PAY_SQL, "id", _REFUND_PAY), jn.REFUND_PAY_RECORDS)
def job_refund_pay(spark, sf):
    return _upserted(jn.join_refund_pay_3way(spark, sf), spark, "id")


CART_UU_SQL = f"""
    SELECT {window_text('w', 2)}, cart_add_uu_ct FROM (
      SELECT {window('ts_ms', 2)} AS w, count(*) AS cart_add_uu_ct FROM (
        SELECT *, lag(ts_ms // 86400000) OVER (PARTITION BY user_id ORDER BY ts_ms, id) AS last_day FROM cart_info)
      WHERE last_day IS DISTINCT FROM ts_ms // 86400000 GROUP BY 1)"""


@query("job_dws_cart_uu", CART_UU_SQL, ["cart_info"])
def job_dws_cart_uu(spark, sf):
    carts = st.record(spark, sf, "cart_info").select("id", "user_id", "ts_ms")
    return wd.cart_users(carts, ["ts_ms", "id"])


PROVINCE_SQL = f"""
    SELECT {window_text('w', 4)}, r.province_id, coalesce(p.name, '') AS province_name, order_count,
           CAST(order_amount AS VARCHAR) AS order_amount
    FROM (SELECT {window('ts_ms', 4)} AS w, province_id, count(DISTINCT order_id) AS order_count,
                 sum(CASE WHEN rn = 1 THEN CAST(split_total_amount AS DECIMAL(18,4)) ELSE 0 END) AS order_amount
          FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LATEST}) AS rn FROM trade_order_detail)
          GROUP BY 1, 2) r
    LEFT JOIN dim_base_province p ON r.province_id = p.id"""


@query("job_dws_province", PROVINCE_SQL, ["trade_order_detail", "dim_base_province"])
def job_dws_province(spark, sf):
    rows = wd.province_orders(st.record(spark, sf, "trade_order_detail"), st.record(spark, sf, "dim_base_province"),
                              VERSION)
    return rows.withColumn("order_amount", F.col("order_amount").cast("decimal(38,4)").cast("string"))


SKU_SUMS = ", ".join(f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS VARCHAR) AS {n}" for c, n in wd.SKU_SUMS.items())


@query("job_dws_sku", f"""
    SELECT {window_text('w', 10)}, f.* EXCLUDE (w), {jn.SKU_CHAIN}
    FROM (SELECT {window('ts_ms', 10)} AS w, sku_id, {SKU_SUMS} FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LATEST}) AS rn FROM trade_order_detail)
          WHERE rn = 1 GROUP BY 1, 2) f {jn.SKU_JOINS}""", ["trade_order_detail", *jn.SKU_DIMS.values()])
def job_dws_sku(spark, sf):
    rows = wd.sku_orders(st.record(spark, sf, "trade_order_detail"), jn.sku_dims(spark, sf), VERSION)
    return rows.withColumns({n: F.col(n).cast("decimal(38,4)").cast("string") for n in wd.SKU_SUMS.values()})


@query("job_dws_home_detail", HOME_SQL, ["page_log"], HOME)
def job_dws_home_detail(spark, sf):
    return wd.home_detail(st.record(spark, sf, "page_log"), LOG_ORDER)


@query("job_dws_keyword", KEYWORD_SQL.replace(
    "WHERE last_page_id", f"WHERE {CLEAN} AND page_id IS NOT NULL AND last_page_id"), ["page_log"])
def job_dws_keyword(spark, sf):
    logs = rd.parse_json(rd.drop_tombstones(st.log_topic(spark, sf)), LOG).where("page IS NOT NULL")
    return wd.search_keywords(lg.flat_logs(logs))


VISITOR_SQL = f"""
    SELECT {window_text('w', 10)}, * EXCLUDE (w) FROM (
      SELECT {window('ts_ms', 10)} AS w, vc, ch, ar, is_new, sum(uv_ct)::BIGINT AS uv_ct, sum(sv_ct)::BIGINT AS sv_ct,
             sum(pv_ct)::BIGINT AS pv_ct, sum(dur_sum)::BIGINT AS dur_sum FROM visits GROUP BY ALL)"""


@query("job_dws_visitor", VISITOR_SQL, ["page_log"], VISITS)
def job_dws_visitor(spark, sf):
    return wd.visitors(st.record(spark, sf, "page_log"), LOG_ORDER)


LOGIN_SQL = f"""
    SELECT {window_text('w', 10)}, back_ct, uu_ct FROM (
      SELECT {window('ts_ms', 10)} AS w, sum(back_ct)::BIGINT AS back_ct, sum(uu_ct)::BIGINT AS uu_ct
      FROM ({login_sql(8)}) GROUP BY 1)"""


@query("job_dws_login", LOGIN_SQL, ["page_log"])
def job_dws_login(spark, sf):
    return wd.logins(st.record(spark, sf, "page_log"), LOG_ORDER)


@query("job_user_base", """
    SELECT uid, name, age, zodiac_sign, gender, ts_ms FROM (
      SELECT *, row_number() OVER (PARTITION BY uid, ts_ms ORDER BY arrival) AS rn FROM users) WHERE rn = 1""",
       ["user_info"], USERS)
def job_user_base(spark, sf):
    users = fl.user_info_project(st.change_log(spark, sf, "user_info"), as_of())
    return dd.dedup_latest_detail(fl.filter_non_empty_uid(users), "uid", "ts_ms").select(
        "uid", "name", "age", "zodiac_sign", "gender", "ts_ms")


@query("job_user_profile", "SELECT * FROM user_join", ["user_info", "user_info_sup_msg"], jn.USER_JOIN)
def job_user_profile(spark, sf):
    return pf.user_profile(st.change_log(spark, sf, "user_info", "user_info_sup_msg"), as_of())


@query("job_page_profile", "SELECT * FROM page_profile", ["page_log"], jn.PAGE_PROFILE)
def job_page_profile(spark, sf):
    return jn.page_profiles(spark, sf)


@query("job_order_info", "SELECT * EXCLUDE (rn) FROM latest", jn.ORDER_SCORED_RECORDS, jn.ORDER_SCORED_CTES)
def job_order_info(spark, sf):
    return pf.order_info(st.change_log(spark, sf, "order_info", "order_detail"))


@query("job_score_device_search", "SELECT * FROM profile_scored", jn.PROFILE_RECORDS, jn.PROFILE_CTES)
def job_score_device_search(spark, sf):
    return jn.scored_profiles(spark, sf)


@query("job_score_order", "SELECT * FROM order_scored", jn.ORDER_SCORED_RECORDS, jn.ORDER_SCORED_CTES)
def job_score_order(spark, sf):
    return jn.scored_orders(spark, sf)


@query("job_merge_label", jn.MERGED_SQL, jn.MERGED_RECORDS, jn.MERGED_CTES)
def job_merge_label(spark, sf):
    rows, path = jn.merged(spark, sf), scratch(spark, "labels")
    sk.text_append(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("job_region_codes", REGION_SQL, ["city_weather"])
def job_region_codes(spark, sf):
    lines, path = scratch(spark, "regions"), scratch(spark, "table")
    sk.topic_append(region_lines(spark, sf), lines)
    sk.table_append(rd.region_codes(spark, lines), path)
    return spark.read.parquet(path)


@query("job_sensitive_words", """
    SELECT doc_id, word, count(*) AS hits FROM (
      SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents)
    WHERE word <> '' AND word IN (SELECT word FROM word_set) GROUP BY 1, 2""", ctes=WORD_SET)
def job_sensitive_words(spark, sf):
    return dims.sensitive_hits(st.table(spark, sf, "documents"), "doc_id", "text",
                               rd.word_lists(spark, word_files(spark, sf)))


@query("job_weather_rows", f"""
    SELECT code, province, city, area, info, lives, report_time FROM weather
    WHERE ok AND code IN (SELECT code FROM city_weather WHERE {REGION_WHERE})""", ["city_weather"], WEATHER)
def job_weather_rows(spark, sf):
    return dims.weather_rows(st.record(spark, sf, "city_weather"))


@query("job_weather_report", REPORT_SQL, ["city_weather"], WEATHER)
def job_weather_report(spark, sf):
    return dims.weather_report(st.record(spark, sf, "city_weather"))
