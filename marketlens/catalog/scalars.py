"""Queries over the scalar and scoring functions, each on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.catalog import joins as jn
from marketlens.catalog.filters import USERS, as_of
from marketlens.catalog.registry import day, moment, query, window
from marketlens.functions import clock as ck, scalars as fs, scores as sc
from marketlens.operators.joins import equi_join
from marketlens.plans import profile as pf
from marketlens.sources import standins as st


def simple(name, record, sql, columns, key="id"):
    """Register one function over one record: ``columns`` builds the result columns."""
    query(name, f"SELECT {key}, {sql} FROM {record}", [record])(
        lambda spark, sf: st.record(spark, sf, record).select(key, *columns()))


_ms = lambda name: F.col(name).cast("bigint")


@query("fn_map_get", "SELECT id, order_status, CAST(NULL AS VARCHAR) AS missing FROM order_info", ["order_info"])
def fn_map_get(spark, sf):
    rows = st.change_log(spark, sf, "order_info")
    return rows.select(fs.map_get("after", "id").alias("id"), fs.map_get("after", "order_status").alias("order_status"),
                       fs.map_get("after", "no_such_key").alias("missing"))


@query("fn_nested_get", "SELECT row_id, mid, page_id FROM page_log", ["page_log"])
def fn_nested_get(spark, sf):
    return st.log_rows(spark, sf).select("row_id", "common.mid", "page.page_id")


simple("fn_decimal_mul", "order_detail",
       "CAST(CAST(sku_num AS DECIMAL(16,2)) * CAST(order_price AS DECIMAL(16,2)) AS VARCHAR) AS amount",
       lambda: [fs.decimal_mul("sku_num", "order_price").alias("amount")])
simple("fn_if", "cart_info", "CASE WHEN op = 'r' THEN sku_num ELSE old_sku_num END AS num",
       lambda: [F.when(F.col("op") == "r", F.col("sku_num")).otherwise(F.col("old_sku_num")).alias("num")])
simple("fn_millis_to_date", "order_detail", f"{day('CAST(create_time AS BIGINT)')} AS date_id",
       lambda: [ck.millis_to_date("create_time").alias("date_id")])
simple("fn_ts_to_date", "order_info", f"{day('ts_ms')} AS d, {day('ts_ms + 28800000')} AS d8",
       lambda: [ck.ts_to_date("ts_ms").alias("d"), ck.ts_to_date("ts_ms", "+08:00").alias("d8")])
simple("fn_ts_to_datetime", "page_log", f"{moment('ts_ms')} AS t, {moment('ts_ms + 28800000')} AS t8",
       lambda: [ck.ts_to_datetime("ts_ms").alias("t"), ck.ts_to_datetime("ts_ms", "+08:00").alias("t8")], "row_id")
simple("fn_ts_to_partition", "page_log", "strftime(make_timestamp(ts_ms * 1000), '%Y%m%d') AS p",
       lambda: [ck.ts_to_partition("ts_ms").alias("p")], "row_id")
simple("fn_datetime_to_ts", "page_log",
       "ts_ms - ts_ms % 1000 AS back, ts_ms - ts_ms % 1000 - 28800000 AS back8",
       lambda: [ck.datetime_to_ts(ck.ts_to_datetime("ts_ms")).alias("back"),
                ck.datetime_to_ts(ck.ts_to_datetime("ts_ms"), "+08:00").alias("back8")], "row_id")
simple("fn_date_to_ts", "page_log", "ts_ms - ts_ms % 86400000 AS midnight",
       lambda: [ck.date_to_ts(ck.ts_to_date("ts_ms")).alias("midnight")], "row_id")
simple("fn_today_int", "order_info",
       "CAST(strftime(make_timestamp(CAST(create_time AS BIGINT) * 1000), '%Y%m%d') AS BIGINT) AS day_no",
       lambda: [ck.today_int(ck.ntz_of(_ms("create_time")).cast("date")).cast("bigint").alias("day_no")])
simple("fn_window_format", "page_log", f"{moment(window('ts_ms', 10))} AS stt, {day(window('ts_ms', 10))} AS cur_date",
       lambda: [ck.ts_to_datetime(ck.window_start("ts_ms", 10)).alias("stt"),
                ck.ts_to_date(ck.window_start("ts_ms", 10)).alias("cur_date")], "row_id")
simple("fn_day_diff", "page_log", "(ts_ms - 1704067200000) // 86400000 AS days",
       lambda: [ck.day_diff("ts_ms", F.lit("2024-01-01")).alias("days")], "row_id")
simple("fn_epoch_day", "user_info", "CAST(DATE '1970-01-01' + CAST(birthday AS INT) AS VARCHAR) AS born",
       lambda: [ck.epoch_day("birthday").cast("string").alias("born")], "arrival")


def _user(name):
    query(f"fn_{name}", f"SELECT arrival, {'zodiac_sign' if name == 'zodiac' else name} AS v FROM users",
          ["user_info"], USERS)(lambda spark, sf: st.record(spark, sf, "user_info").select(
              "arrival", {"age": ck.age(ck.epoch_day("birthday"), as_of()), "decade": ck.decade(ck.epoch_day("birthday")),
                          "zodiac": ck.zodiac(ck.epoch_day("birthday"))}[name].alias("v")))


for _n in ("age", "decade", "zodiac"):
    _user(_n)

simple("fn_millis_to_local_text", "order_info", f"{moment('CAST(create_time AS BIGINT) + 28800000')} AS t",
       lambda: [ck.ts_to_datetime(_ms("create_time"), "Asia/Shanghai").alias("t")])
simple("fn_first_token", "page_log", "split_part(os, ' ', 1) AS os1, split_part(item, '-', 1) AS item1",
       lambda: [fs.first_token("os").alias("os1"), fs.first_token("item", "-").alias("item1")], "row_id")


@query("fn_join_set", """
    SELECT mid, string_agg(ch, ',' ORDER BY ch) AS chs FROM (SELECT DISTINCT mid, ch FROM page_log) GROUP BY mid""",
       ["page_log"])
def fn_join_set(spark, sf):
    return st.record(spark, sf, "page_log").groupBy("mid").agg(fs.join_set(F.collect_set("ch")).alias("chs"))


simple("fn_is_empty", "page_log", "coalesce(uid, '') = '' AS no_uid, coalesce(last_page_id, '') = '' AS no_last",
       lambda: [fs.is_empty("uid").alias("no_uid"), fs.is_empty("last_page_id").alias("no_last")], "row_id")


@query("fn_round3", "SELECT event_id, round(CAST(CAST(value AS DECIMAL(12,2)) * 0.15 AS DECIMAL(12,3)) * 1.0, 3)::DOUBLE "
                    "AS v FROM events")
def fn_round3(spark, sf):
    cents = F.col("value").cast("decimal(12,2)") * F.lit("0.15").cast("decimal(3,2)")
    return st.table(spark, sf, "events").select("event_id", fs.round3(cents).cast("double").alias("v"))


simple("fn_negate_amount", "order_detail", "CAST(-CAST(split_total_amount AS DECIMAL(18,4)) AS VARCHAR) AS neg",
       lambda: [fs.negate_amount("split_total_amount").alias("neg")])
simple("fn_md5_key", "order_info", "md5(id) AS row_key", lambda: [fs.md5_key("id").alias("row_key")])
simple("fn_dim_cache_key", "dim_sku_info", "'dim_sku_info:' || id AS cache_key",
       lambda: [fs.dim_cache_key("dim_sku_info", "id").alias("cache_key")])


def _order_map(*names):
    return F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])


@query("fn_keep_keys", "SELECT id, 2 AS n, user_id, CAST(NULL AS VARCHAR) AS province_id FROM order_info", ["order_info"])
def fn_keep_keys(spark, sf):
    kept = fs.keep_keys(_order_map("id", "user_id", "province_id"), F.lit("id,user_id,absent"))
    rows = st.record(spark, sf, "order_info").select("id", kept.alias("m"))
    return rows.select("id", F.size("m").alias("n"), F.col("m")["user_id"].alias("user_id"),
                       F.col("m")["province_id"].alias("province_id"))


@query("fn_merge_objects", "SELECT id, 3 AS n, province_id AS user_id, province_id FROM order_info", ["order_info"])
def fn_merge_objects(spark, sf):
    right = F.create_map(F.lit("user_id"), F.col("province_id"), F.lit("province_id"), F.col("province_id"))
    merged = fs.merge_objects(_order_map("id", "user_id"), right)
    rows = st.record(spark, sf, "order_info").select("id", merged.alias("m"))
    return rows.select("id", F.size("m").alias("n"), F.col("m")["user_id"].alias("user_id"),
                       F.col("m")["province_id"].alias("province_id"))


@query("fn_prefix_keys", "SELECT id, user_id AS info_user_id, 'info_id,info_user_id' AS keys FROM order_info",
       ["order_info"])
def fn_prefix_keys(spark, sf):
    m = fs.prefix_keys(_order_map("id", "user_id"), "info_")
    rows = st.record(spark, sf, "order_info").select("id", m.alias("m"))
    return rows.select("id", F.col("m")["info_user_id"].alias("info_user_id"),
                       fs.join_set(F.map_keys("m")).alias("keys"))


@query("fn_to_json_snake", """
    SELECT '{"page_id":"' || page_id || '","uv_ct":' || CAST(k AS VARCHAR) || '}' AS value FROM page_log
    WHERE page_id IS NOT NULL""", ["page_log"])
def fn_to_json_snake(spark, sf):
    beans = st.record(spark, sf, "page_log").where("page_id IS NOT NULL").select(
        F.col("page_id").alias("pageId"), F.col("k").alias("uvCt"), "ts_ms")
    return beans.select(fs.to_json_snake(beans, hidden=("ts_ms",)).alias("value"))


@query("fn_snake_to_camel", 'SELECT id, spu_id AS "spuId", category3_id AS "category3Id" FROM dim_sku_info',
       ["dim_sku_info"])
def fn_snake_to_camel(spark, sf):
    return fs.snake_to_camel(st.record(spark, sf, "dim_sku_info").select("id", "spu_id", "category3_id"))


@query("score_device", f"SELECT row_id, {jn.DEVICE_SQL} FROM (SELECT row_id, split_part(os, ' ', 1) AS judge_os "
                       "FROM page_log)", ["page_log"])
def score_device(spark, sf):
    return st.record(spark, sf, "page_log").select("row_id", *sc.score_device(fs.first_token("os")))


@query("score_search", f"SELECT id, {jn.SEARCH_SQL} FROM (SELECT s.id, c.search_category FROM dim_sku_info s "
                       "LEFT JOIN category_compare_dic c ON CAST(c.id AS VARCHAR) = substr(s.category3_id, 1, 1))", ["dim_sku_info", "category_compare_dic"])
def score_search(spark, sf):
    sku = st.record(spark, sf, "dim_sku_info").select("id", F.substring("category3_id", 1, 1).alias("no"))
    names = st.record(spark, sf, "category_compare_dic").select(
        F.col("id").cast("string").alias("no"), "search_category")
    return equi_join(sku, names, ["no"], "left").select("id", *sc.score_search(F.col("search_category")))


@query("score_pay_time", f"""SELECT id, slot, {jn.PAY_TIME_SQL} FROM (SELECT id, {jn._SLOT} AS slot FROM (
    SELECT id, CAST(create_time AS BIGINT) // 3600000 % 24 AS h FROM order_info))""", ["order_info"])
def score_pay_time(spark, sf):
    hour = F.floor(F.pmod(_ms("create_time"), F.lit(86_400_000)) / 3_600_000)
    slot = sc.day_part(hour)
    return st.record(spark, sf, "order_info").select("id", slot.alias("slot"), *sc.score_pay_time(slot))


@query("score_amount", f"SELECT c_custkey, {jn.AMOUNT_SQL} FROM (SELECT c_custkey, c_acctbal AS amt FROM customer)")
def score_amount(spark, sf):
    return st.table(spark, sf, "customer").select("c_custkey", *sc.score_amount(F.col("c_acctbal")))


@query("score_brand", f"SELECT id, tname, {jn.BRAND_SQL} FROM (SELECT id, tm_name AS tname FROM brands)",
       jn.BRAND_RECORDS, jn.BRANDS)
def score_brand(spark, sf):
    return jn.brands(spark, sf).select("id", F.col("tm_name").alias("tname"), *sc.score_brand(F.col("tm_name")))


@query("score_category", f"SELECT id, b1_name, {jn.CATEGORY_SQL} FROM (SELECT id, b1name AS b1_name FROM tree)",
       jn.TREE_RECORDS, jn.TREE)
def score_category(spark, sf):
    return jn.tree(spark, sf).select("id", F.col("b1name").alias("b1_name"), *sc.score_category(F.col("b1name")))


@query("age_level", """
    SELECT uid, "ageLevel", count(*) AS n FROM labels_ GROUP BY ALL""", jn.LABEL_RECORDS, jn.LABEL_CTES)
def age_level(spark, sf):
    return pf.age_level_counts(jn.scored_profiles(spark, sf), jn.scored_orders(spark, sf))
