"""Fact jobs: comments, cart adds, orders, cancellations, payments and refunds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketlens.functions.clock import millis_to_date
from marketlens.operators import filters as fl
from marketlens.operators.joins import equi_join
from marketlens.sources.schemas import ORDER_DETAIL_FACT

_SPLITS = ["sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
_DETAIL = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
           "coupon_id"]


def comment_fact(changes: DataFrame, dic: DataFrame) -> DataFrame:
    """Comments with the name of their appraisal; unknown codes are left out."""
    comments = fl.cdc_select_table(changes, "comment_info", [
        "id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"])
    names = dic.select(F.col("dic_code").alias("appraise"), F.col("info.dic_name").alias("appraise_name"))
    return equi_join(comments, names, ["appraise"]).select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms")


def order_detail_fact(changes: DataFrame) -> DataFrame:
    """Order lines with their order, and activity and coupon where there are any."""
    details = fl.order_detail_rows(changes)
    orders = fl.cdc_select_table(changes, "order_info", ["id", "user_id", "province_id"])
    orders = orders.select(F.col("id").alias("order_id"), "user_id", "province_id")
    acts = fl.cdc_select_table(changes, "order_detail_activity", [
        "order_detail_id", "activity_id", "activity_rule_id"])
    acts = acts.select(F.col("order_detail_id").alias("id"), "activity_id", "activity_rule_id")
    coupons = fl.cdc_select_table(changes, "order_detail_coupon", ["order_detail_id", "coupon_id"])
    coupons = coupons.select(F.col("order_detail_id").alias("id"), "coupon_id")
    joined = equi_join(details, orders, ["order_id"])
    joined = equi_join(joined, acts, ["id"], "left", null_keys=False)
    joined = equi_join(joined, coupons, ["id"], "left", null_keys=False)
    return joined.withColumn("date_id", millis_to_date("create_time")).select(*ORDER_DETAIL_FACT)


def cancel_fact(order_details: DataFrame, changes: DataFrame, strict: bool = True) -> DataFrame:
    """Order lines of cancelled orders."""
    cancels = fl.filter_order_cancel(changes, strict).withColumnsRenamed({"id": "order_id"})
    return cancel_columns(equi_join(order_details.drop("ts_ms"), cancels, ["order_id"]))


def cancel_columns(joined: DataFrame) -> DataFrame:
    """The columns of the fact from order lines joined with cancellations."""
    return joined.select(*_DETAIL, millis_to_date("create_time").alias("date_id"),
                         F.col("operate_time").alias("cancel_time"), *_SPLITS, "ts_ms")


def payment_fact(order_details: DataFrame, changes: DataFrame) -> DataFrame:
    """Order lines of paid orders."""
    paid = fl.filter_payment_success(changes).drop("user_id")
    return payment_columns(equi_join(order_details.drop("ts_ms"), paid, ["order_id"]))


def payment_columns(joined: DataFrame) -> DataFrame:
    """The columns of the fact from order lines joined with payments."""
    return joined.select(
        F.col("id").alias("order_detail_id"), *_DETAIL[1:], F.col("payment_type").alias("payment_type_code"),
        "callback_time", *_SPLITS[:4], F.col("split_total_amount").alias("split_payment_amount"), "ts_ms")


def refund_fact(changes: DataFrame) -> DataFrame:
    """Refund requests of orders in refund."""
    refunds, orders = fl.filter_refund_request(changes)
    return refund_columns(equi_join(refunds, orders.withColumnsRenamed({"id": "order_id"}), ["order_id"]))


def refund_columns(joined: DataFrame) -> DataFrame:
    """The columns of the fact from refund requests joined with orders."""
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id", millis_to_date("create_time").alias("date_id"),
        "create_time", F.col("refund_type").alias("refund_type_code"),
        F.col("refund_reason_type").alias("refund_reason_type_code"), "refund_reason_txt", "refund_num",
        "refund_amount", "ts_ms")


def refund_paid_fact(changes: DataFrame) -> DataFrame:
    """Paid refunds with their request and order."""
    paid, settled, orders = fl.filter_refund_paid(changes)
    joined = equi_join(paid, settled, ["order_id", "sku_id"])
    return refund_paid_columns(equi_join(joined, orders.withColumnsRenamed({"id": "order_id"}), ["order_id"]))


def refund_paid_columns(joined: DataFrame) -> DataFrame:
    """The columns of the fact from paid refunds joined with requests and orders."""
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id", F.col("payment_type").alias("payment_type_code"),
        millis_to_date("callback_time").alias("date_id"), "callback_time", "refund_num",
        F.col("total_amount").alias("refund_amount"), "ts_ms")
