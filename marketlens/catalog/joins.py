"""Queries over joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.catalog.filters import USERS, as_of
from marketlens.catalog.registry import day, moment, query
from marketlens.catalog.sources import WORD_SET, word_files
from marketlens.functions import scores as sc
from marketlens.operators import filters as fl
from marketlens.operators.joins import DimSpec, dim_lookup, word_membership, words_of
from marketlens.plans import facts, profile as pf, windows as wd
from marketlens.sources import readers as rd, standins as st

DETAIL_RECORDS = ["order_info", "order_detail", "order_detail_activity", "order_detail_coupon"]
_DETAIL_COLS = """d.id, d.order_id, o.user_id, d.sku_id, d.sku_name, o.province_id, a.activity_id, a.activity_rule_id,
    c.coupon_id"""
_ORIGINAL = "CAST(CAST(d.sku_num AS DECIMAL(16,2)) * CAST(d.order_price AS DECIMAL(16,2)) AS VARCHAR)"
DETAIL_FACT = f"""
fact AS (
  SELECT {_DETAIL_COLS}, {day('CAST(d.create_time AS BIGINT)')} AS date_id, d.create_time, d.sku_num,
         {_ORIGINAL} AS split_original_amount, d.split_activity_amount, d.split_coupon_amount, d.split_total_amount,
         d.ts_ms
  FROM order_detail d JOIN order_info o ON d.order_id = o.id AND o.op = 'r'
  LEFT JOIN order_detail_activity a ON d.id = a.order_detail_id
  LEFT JOIN order_detail_coupon c ON d.id = c.order_detail_id)"""


@query("join_comment_dic", """
    SELECT c.id, c.user_id, c.sku_id, c.appraise, d.dic_name AS appraise_name, c.comment_txt, c.ts_ms
    FROM comment_info c JOIN dim_base_dic d ON c.appraise = d.dic_code WHERE c.op = 'r'""",
       ["comment_info", "dim_base_dic"])
def join_comment_dic(spark, sf):
    dic = rd.dim_table(st.record(spark, sf, "dim_base_dic"), "dic_code")
    return facts.comment_fact(st.change_log(spark, sf, "comment_info"), dic)


@query("join_order_detail_4way", "SELECT * FROM fact", DETAIL_RECORDS, DETAIL_FACT)
def join_order_detail_4way(spark, sf):
    return facts.order_detail_fact(st.change_log(spark, sf, *DETAIL_RECORDS))


_DATE = day("CAST(f.create_time AS BIGINT)")
CANCEL_SQL = f"""
    SELECT f.id, f.order_id, f.user_id, f.sku_id, f.sku_name, f.province_id, f.activity_id, f.activity_rule_id,
           f.coupon_id, {_DATE} AS date_id, o.operate_time AS cancel_time, f.sku_num, f.split_original_amount,
           f.split_activity_amount, f.split_coupon_amount, f.split_total_amount, o.ts_ms
    FROM trade_order_detail f JOIN order_info o ON f.order_id = o.id
    WHERE o.op = 'r' AND o.order_status IN ('1001', '1003')"""


@query("join_cancel", CANCEL_SQL, ["trade_order_detail", "order_info"])
def join_cancel(spark, sf):
    return facts.cancel_fact(st.record(spark, sf, "trade_order_detail"), st.change_log(spark, sf, "order_info"))


PAYMENT_SQL = """
    SELECT f.id AS order_detail_id, f.order_id, f.user_id, f.sku_id, f.sku_name, f.province_id, f.activity_id,
           f.activity_rule_id, f.coupon_id, p.payment_type AS payment_type_code, p.callback_time, f.sku_num,
           f.split_original_amount, f.split_activity_amount, f.split_coupon_amount,
           f.split_total_amount AS split_payment_amount, p.ts_ms
    FROM payment_info p JOIN trade_order_detail f ON p.order_id = f.order_id WHERE p.payment_status = '1602'"""


@query("join_payment", PAYMENT_SQL, ["trade_order_detail", "payment_info"])
def join_payment(spark, sf):
    return facts.payment_fact(st.record(spark, sf, "trade_order_detail"), st.change_log(spark, sf, "payment_info"))


REFUND_SQL = f"""
    SELECT r.id, r.user_id, r.order_id, r.sku_id, o.province_id, {day('CAST(r.create_time AS BIGINT)')} AS date_id,
           r.create_time, r.refund_type AS refund_type_code, r.refund_reason_type AS refund_reason_type_code,
           r.refund_reason_txt, r.refund_num, r.refund_amount, r.ts_ms
    FROM order_refund_info r JOIN order_info o ON r.order_id = o.id
    WHERE o.op = 'r' AND o.order_status = '1006'"""


@query("join_refund", REFUND_SQL, ["order_refund_info", "order_info"])
def join_refund(spark, sf):
    return facts.refund_fact(st.change_log(spark, sf, "order_refund_info", "order_info"))


REFUND_PAY_SQL = f"""
    SELECT p.id, o.user_id, p.order_id, p.sku_id, o.province_id, p.payment_type AS payment_type_code,
           {day('CAST(p.callback_time AS BIGINT)')} AS date_id, p.callback_time, r.refund_num,
           p.total_amount AS refund_amount, p.ts_ms
    FROM refund_payment p JOIN order_refund_info r ON p.order_id = r.order_id AND p.sku_id = r.sku_id
    JOIN order_info o ON p.order_id = o.id
    WHERE p.refund_status = '1602' AND r.refund_status = '0705' AND o.op = 'r' AND o.order_status = '1006'"""
REFUND_PAY_RECORDS = ["refund_payment", "order_refund_info", "order_info"]


@query("join_refund_pay_3way", REFUND_PAY_SQL, REFUND_PAY_RECORDS)
def join_refund_pay_3way(spark, sf):
    return facts.refund_paid_fact(st.change_log(spark, sf, *REFUND_PAY_RECORDS))


ORDER_JOIN = f"""
order_join AS (
  SELECT o.id, o.user_id, o.total_amount, {moment('CAST(o.create_time AS BIGINT)')} AS create_time, d.id AS detail_id,
         d.order_id, d.sku_id, d.sku_name, d.sku_num, d.order_price, d.split_activity_amount, d.split_total_amount,
         d.ts_ms
  FROM order_info o JOIN order_detail d ON o.id = d.order_id AND d.ts_ms BETWEEN o.ts_ms - 300000 AND o.ts_ms + 300000)"""


@query("ijoin_order", "SELECT * FROM order_join", ["order_info", "order_detail"], ORDER_JOIN)
def ijoin_order(spark, sf):
    return pf.order_join(st.change_log(spark, sf, "order_info", "order_detail"))


USER_JOIN = USERS + """,
user_join AS (
  SELECT u.uid, u.name, u.decade, u.birthday, u.phone_num, u.email, u.age, u.zodiac_sign, u.ts_ms,
         coalesce(u.gender, 'null') AS gender, s.height, s.unit_height, s.weight, s.unit_weight
  FROM users u JOIN user_info_sup_msg s ON u.uid = s.uid AND s.ts_ms BETWEEN u.ts_ms - 3600000 AND u.ts_ms + 3600000)"""


@query("ijoin_user", "SELECT * FROM user_join", ["user_info", "user_info_sup_msg"], USER_JOIN)
def ijoin_user(spark, sf):
    return pf.user_profile(st.change_log(spark, sf, "user_info", "user_info_sup_msg"), as_of())


@query("ijoin_user_label", """
    SELECT DISTINCT u.uid, u.name, u.age, u.ts_ms, s.height, s.unit_height, s.weight, s.unit_weight
    FROM users u JOIN user_info_sup_msg s ON u.uid = s.uid AND s.ts_ms BETWEEN u.ts_ms - 3600000 AND u.ts_ms + 3600000""", ["user_info", "user_info_sup_msg"], USERS)
def ijoin_user_label(spark, sf):
    users = fl.user_info_project(st.change_log(spark, sf, "user_info"), as_of()).select("uid", "name", "age", "ts_ms")
    return pf.user_label(users, fl.user_sup_project(st.change_log(spark, sf, "user_info_sup_msg")))


@query("ijoin_comment_order", """
    SELECT c.id, c.order_id, c.comment_txt, c.ts_ms, o.user_id AS info_user_id, o.total_amount AS info_total_amount,
           o.ts_ms AS info_ts_ms, o.id AS info_order_id
    FROM (SELECT *, split_part(id, '-', 1) AS order_id FROM comment_info) c JOIN order_info o
    ON c.order_id = o.id AND o.ts_ms BETWEEN c.ts_ms - 600000 AND c.ts_ms + 600000""", ["comment_info", "order_info"])
def ijoin_comment_order(spark, sf):
    comments = st.record(spark, sf, "comment_info").select(
        "id", F.substring_index("id", "-", 1).alias("order_id"), "comment_txt", "ts_ms")
    orders = st.record(spark, sf, "order_info").select(F.col("id").alias("order_id"), "user_id", "total_amount", "ts_ms")
    return pf.comment_order(comments, orders, "order_id", "ts_ms", "ts_ms", 10)


TREE_RECORDS = ["dim_base_category3", "dim_base_category2", "dim_base_category1"]
BRAND_RECORDS = ["dim_sku_info", "dim_spu_info", "dim_base_trademark"]
TREE = """
tree AS (
  SELECT b3.id, b3.name AS b3name, b2.name AS b2name, b1.name AS b1name
  FROM dim_base_category3 b3 JOIN dim_base_category2 b2 ON b3.category2_id = b2.id
  JOIN dim_base_category1 b1 ON b2.category1_id = b1.id)"""
BRANDS = """
brands AS (
  SELECT s.id, p.id AS spuid, p.category3_id, t.tm_name
  FROM dim_sku_info s JOIN dim_spu_info p ON s.spu_id = p.id JOIN dim_base_trademark t ON p.tm_id = t.id)"""


def tree(spark, sf):
    """The category tree."""
    return pf.category_tree(*[st.record(spark, sf, r) for r in TREE_RECORDS])


def brands(spark, sf):
    """Products with their brand."""
    return pf.sku_brand(*[st.record(spark, sf, r) for r in BRAND_RECORDS])


@query("dim_category_tree", "SELECT * FROM tree", TREE_RECORDS, TREE)
def dim_category_tree(spark, sf):
    return tree(spark, sf)


@query("dim_sku_brand", "SELECT * FROM brands", BRAND_RECORDS, BRANDS)
def dim_sku_brand(spark, sf):
    return brands(spark, sf)


@query("dim_lookup", """
    SELECT o.id, o.province_id, p.name FROM order_info o LEFT JOIN dim_base_province p ON o.province_id = p.id""",
       ["order_info", "dim_base_province"])
def dim_lookup_query(spark, sf):
    orders = st.record(spark, sf, "order_info").select("id", "province_id")
    return dim_lookup(orders, DimSpec(st.record(spark, sf, "dim_base_province"), "id", {"name": "name"}), "province_id")


@query("dim_lookup_province", """
    SELECT f.id, f.province_id, coalesce(p.name, '') AS province_name
    FROM trade_order_detail f LEFT JOIN dim_base_province p ON f.province_id = p.id""",
       ["trade_order_detail", "dim_base_province"])
def dim_lookup_province(spark, sf):
    spec = DimSpec(st.record(spark, sf, "dim_base_province"), "id", {"name": "province_name"}, {"province_name": ""})
    return dim_lookup(st.record(spark, sf, "trade_order_detail").select("id", "province_id"), spec, "province_id")


SKU_DIMS = {"sku": "dim_sku_info", "spu": "dim_spu_info", "trademark": "dim_base_trademark",
            "category3": "dim_base_category3", "category2": "dim_base_category2", "category1": "dim_base_category1"}
SKU_CHAIN = """s.sku_name, s.spu_id, s.category3_id, s.tm_id AS trademark_id, p.spu_name,
    t.tm_name AS trademark_name, b3.name AS category3_name, b3.category2_id, b2.name AS category2_name, b2.category1_id,
    b1.name AS category1_name"""
SKU_JOINS = """LEFT JOIN dim_sku_info s ON f.sku_id = s.id LEFT JOIN dim_spu_info p ON s.spu_id = p.id
    LEFT JOIN dim_base_trademark t ON s.tm_id = t.id LEFT JOIN dim_base_category3 b3 ON s.category3_id = b3.id
    LEFT JOIN dim_base_category2 b2 ON b3.category2_id = b2.id
    LEFT JOIN dim_base_category1 b1 ON b2.category1_id = b1.id"""


def sku_dims(spark, sf):
    """The six product dimensions."""
    return {name: st.record(spark, sf, rec) for name, rec in SKU_DIMS.items()}


@query("dim_lookup_sku_chain", f"SELECT f.id, f.sku_id, {SKU_CHAIN} FROM trade_order_detail f {SKU_JOINS}",
       ["trade_order_detail", *SKU_DIMS.values()])
def dim_lookup_sku_chain(spark, sf):
    return wd.sku_chain(st.record(spark, sf, "trade_order_detail").select("id", "sku_id"), sku_dims(spark, sf))


BY_NAME = """
by_name AS (SELECT b3name, min_by(b1name, id) AS b1name FROM tree GROUP BY b3name),
by_category AS (SELECT category_name, min_by(search_category, id) AS search_category FROM category_compare_dic
                GROUP BY category_name)"""


@query("lookup_category_by_name", """
    SELECT l.row_id, l.item AS search_item, n.b1name AS b1_category, c.search_category
    FROM page_log l LEFT JOIN by_name n ON l.item = n.b3name LEFT JOIN by_category c ON n.b1name = c.category_name""",
       ["page_log", "category_compare_dic", *TREE_RECORDS], f"{TREE},{BY_NAME}")
def lookup_category_by_name(spark, sf):
    items = st.record(spark, sf, "page_log").select("row_id", F.col("item").alias("search_item"))
    return pf.lookup_category_by_name(items, tree(spark, sf), st.record(spark, sf, "category_compare_dic")).select(
        "row_id", "search_item", "b1_category", "search_category")


@query("lookup_sku_category", """
    SELECT f.id, f.sku_id, b.category3_id AS c3id, b.tm_name AS tname, t.b1name AS b1_name
    FROM trade_order_detail f LEFT JOIN brands b ON f.sku_id = b.id LEFT JOIN tree t ON b.category3_id = t.id""",
       ["trade_order_detail", *TREE_RECORDS, *BRAND_RECORDS], f"{TREE},{BRANDS}")
def lookup_sku_category(spark, sf):
    lines = st.record(spark, sf, "trade_order_detail").select("id", "sku_id")
    return pf.lookup_sku_category(lines, brands(spark, sf), tree(spark, sf))


@query("word_membership", """
    SELECT w.word, s.word IS NOT NULL AS in_set, count(*) AS n
    FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM conversations) w
    LEFT JOIN word_set s ON w.word = s.word WHERE w.word <> '' GROUP BY 1, 2""", ctes=WORD_SET)
def word_membership_query(spark, sf):
    words = words_of(st.table(spark, sf, "conversations"), "text", []).groupBy("word").agg(F.count("*").alias("n"))
    return word_membership(words, rd.word_lists(spark, word_files(spark, sf)))


# Scores of an order line, worked out from the looked-up brand and category.
_SLOT = """CASE WHEN h < 5 THEN '凌晨' WHEN h < 8 THEN '早晨' WHEN h < 11 THEN '上午' WHEN h < 13 THEN '中午'
    WHEN h < 17 THEN '下午' WHEN h < 20 THEN '晚上' ELSE '夜间' END"""


def _pick(cond_values, rate, other="NULL"):
    cases = " ".join(f"WHEN {c} THEN {v}" for c, v in cond_values)
    return f"round(CAST(CASE {cases} ELSE {other} END AS DOUBLE) * {rate}, 3)"


def _two(name, rate, rows, other=None):
    out = []
    for i, b in enumerate(("18_24", "25_29")):
        cases = [(c, v[i]) for c, v in rows]
        out.append(f"{_pick(cases, rate, other[i] if other else 'NULL')} AS {name}_{b}")
    return ", ".join(out)


PAY_TIME_SQL = _two("pay_time", "0.1", [("slot = '凌晨'", (0.2, 0.1)), ("slot = '早晨'", (0.1, 0.1)),
                                        ("slot = '夜间'", (0.9, 0.7))])
AMOUNT_SQL = _two("amount", "0.15", [("amt < 1000", (0.8, 0.6)), ("amt > 1000 AND amt < 4000", (0.2, 0.4))], (0.1, 0.2))
BRAND_SQL = _two("tname", "0.2", [("coalesce(tname, '') = ''", ("NULL", "NULL")), ("tname = 'TCL'", (0.2, 0.3)),
                                  ("tname IN ('苹果', '联想', '小米')", (0.9, 0.8))], (0.1, 0.2))
CATEGORY_SQL = _two("b1name", "0.3", [("coalesce(b1_name, '') = ''", ("NULL", "NULL")),
                                      ("b1_name IN ('数码', '手机', '电脑办公')", (0.9, 0.8)),
                                      ("b1_name IN ('家居家装', '图书、音像、电子书刊')", (0.2, 0.4))], (0.1, 0.2))


def _six(name, rate, column, table, other):
    out = []
    for i, b in enumerate(sc.BRACKETS):
        out.append(f"{_pick([(f'{column} = {k!r}', v[i]) for k, v in table.items()], rate, other)} AS {name}_{b}")
    return ", ".join(out)


DEVICE_SQL = _six("device", "0.1", "judge_os", {
    "iOS": (0.7, 0.6, 0.5, 0.4, 0.3, 0.2), "Android": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3)}, "NULL")
SEARCH_SQL = _six("search", "0.15", "search_category", {
    "时尚与潮流": (0.9, 0.7, 0.5, 0.3, 0.2, 0.1), "性价比": (0.2, 0.4, 0.6, 0.7, 0.8, 0.8),
    "健康与养生": (0.1, 0.2, 0.4, 0.6, 0.8, 0.9), "家庭与育儿": (0.1, 0.2, 0.4, 0.6, 0.8, 0.7),
    "科技与数码": (0.8, 0.6, 0.4, 0.3, 0.2, 0.1), "学习与发展": (0.4, 0.5, 0.6, 0.7, 0.8, 0.7)}, "0.0")

ORDER_SCORED = f"""
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY detail_id, ts_ms ORDER BY id, user_id, total_amount,
    create_time, order_id, sku_id, sku_name, sku_num, order_price, split_activity_amount, split_total_amount) AS rn
    FROM order_join) WHERE rn = 1),
order_cat AS (
  SELECT l.* EXCLUDE (rn), b.category3_id AS c3id, b.tm_name AS tname, t.b1name AS b1_name,
         CAST(l.total_amount AS DOUBLE) AS amt, CAST(substr(l.create_time, 12, 2) AS INT) AS h
  FROM latest l LEFT JOIN brands b ON l.sku_id = b.id LEFT JOIN tree t ON b.category3_id = t.id),
order_slot AS (SELECT *, {_SLOT} AS slot FROM order_cat),
order_scored AS (SELECT * EXCLUDE (amt, h, slot), slot AS pay_slot, {PAY_TIME_SQL}, {AMOUNT_SQL}, {BRAND_SQL},
    {CATEGORY_SQL} FROM order_slot)"""
ORDER_SCORED_RECORDS = ["order_info", "order_detail", *TREE_RECORDS, *BRAND_RECORDS]
ORDER_SCORED_CTES = f"{ORDER_JOIN},{TREE},{BRANDS},{ORDER_SCORED}"


def scored_orders(spark, sf):
    """Joined order lines with their four scores."""
    orders = pf.order_info(st.change_log(spark, sf, "order_info", "order_detail"))
    return pf.score_orders(orders, brands(spark, sf), tree(spark, sf))


_SETS = ("os", "ch", "md", "ba", "search_item")
DEVICE_ROWS = """
device_rows AS (
  SELECT DISTINCT coalesce(uid, '-1') AS uid, ts_ms, split_part(os, ' ', 1) AS os, ch, md, ba, vc, ar, uid AS raw_uid,
         CASE WHEN page_id IS NOT NULL AND item_type = 'keyword' THEN item END AS search_item
  FROM page_log WHERE coalesce(uid, '-1') <> '')"""
PAGE_PROFILE = DEVICE_ROWS + """,
ends AS (SELECT uid, ts_ms - ts_ms % 120000 AS w, max(ts_ms) AS ts_ms FROM device_rows GROUP BY 1, 2),
page_profile AS (
  SELECT e.uid, e.w AS window_ms, e.ts_ms, count(*) AS pv, """ + ", ".join(
    f"coalesce(array_to_string(list_sort(list(DISTINCT d.{s}) FILTER (d.{s} IS NOT NULL)), ','), '') AS {s}"
    for s in _SETS) + """
  FROM ends e JOIN device_rows d ON d.uid = e.uid AND d.ts_ms < e.w + 120000 GROUP BY 1, 2, 3)"""
PROFILE_SCORED = PAGE_PROFILE + f""",
profile_cat AS (
  SELECT p.*, split_part(p.os, ',', 1) AS judge_os, n.b1name AS b1_category, c.search_category
  FROM page_profile p LEFT JOIN by_name n ON p.search_item = n.b3name
  LEFT JOIN by_category c ON n.b1name = c.category_name),
profile_scored AS (SELECT *, {DEVICE_SQL}, {SEARCH_SQL} FROM profile_cat)"""
PROFILE_RECORDS = ["page_log", "category_compare_dic", *TREE_RECORDS]
PROFILE_CTES = f"{TREE},{BY_NAME},{PROFILE_SCORED}"


def page_profiles(spark, sf):
    """Page profiles at the end of each window."""
    return pf.page_profile(st.log_rows(spark, sf))


def scored_profiles(spark, sf):
    """Page profiles with device and search scores."""
    return pf.score_device_search(page_profiles(spark, sf), tree(spark, sf),
                                  st.record(spark, sf, "category_compare_dic"))


def _total(b):
    names = ["search", "device"] + (["pay_time", "b1name", "tname", "amount"] if b in ("18_24", "25_29") else [])
    side = {"search": "p", "device": "p"}
    return "round(" + " + ".join(f"coalesce({side.get(n, 'o')}.{n}_{b}, 0.0)" for n in names) + ", 6)"


_VECTOR = "[" + ", ".join(_total(b) for b in sc.BRACKETS) + "]"
LABELS = f"""
labels_ AS (
  SELECT uid, ts_ms, ['18_24', '25_29', '30_34', '35_39', '40_49', '50'][list_position(v, list_max(v))] AS "ageLevel"
  FROM (SELECT p.uid, p.ts_ms, {_VECTOR} AS v FROM profile_scored p JOIN order_scored o
        ON p.uid = o.user_id AND o.ts_ms BETWEEN p.ts_ms - 86400000 AND p.ts_ms + 86400000))"""
LABEL_RECORDS = list(dict.fromkeys(PROFILE_RECORDS + ORDER_SCORED_RECORDS))
LABEL_CTES = f"{ORDER_JOIN},{TREE},{BRANDS},{ORDER_SCORED},{BY_NAME},{PROFILE_SCORED},{LABELS}"


def labels(spark, sf):
    """Different age brackets of users."""
    return pf.age_labels(scored_profiles(spark, sf), scored_orders(spark, sf))


@query("ijoin_scores", "SELECT * FROM labels_", LABEL_RECORDS, LABEL_CTES)
def ijoin_scores(spark, sf):
    return pf.age_label_rows(scored_profiles(spark, sf), scored_orders(spark, sf))


MERGED_SQL = """
    SELECT DISTINCT l.uid, l."ageLevel", u.name, u.decade, u.birthday, u.phone_num, u.email, u.age, u.zodiac_sign,
           u.ts_ms, u.gender, u.height, u.unit_height, u.weight, u.unit_weight
    FROM labels_ l JOIN user_join u ON l.uid = u.uid AND u.ts_ms BETWEEN l.ts_ms - 288000000 AND l.ts_ms + 288000000"""
MERGED_RECORDS = [*LABEL_RECORDS, "user_info", "user_info_sup_msg"]
MERGED_CTES = f"{LABEL_CTES},{USER_JOIN}"


def merged(spark, sf):
    """Age brackets merged with user rows."""
    users = pf.user_profile(st.change_log(spark, sf, "user_info", "user_info_sup_msg"), as_of())
    return pf.merged_profile(labels(spark, sf), users)


@query("ijoin_profile", MERGED_SQL, MERGED_RECORDS, MERGED_CTES)
def ijoin_profile(spark, sf):
    return merged(spark, sf)
