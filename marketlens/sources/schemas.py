"""Schemas of the incoming records."""

from __future__ import annotations

CHANGE = ("op STRING, before MAP<STRING,STRING>, after MAP<STRING,STRING>, "
          "source MAP<STRING,STRING>, ts_ms BIGINT")

OLD_CHANGE = "`table` STRING, type STRING, ts BIGINT, data MAP<STRING,STRING>, old MAP<STRING,STRING>"

COMMON = ("STRUCT<mid: STRING, uid: STRING, sid: STRING, ar: STRING, ch: STRING, vc: STRING, os: STRING, "
          "md: STRING, ba: STRING, is_new: STRING>")
PAGE = ("STRUCT<page_id: STRING, last_page_id: STRING, item: STRING, item_type: STRING, during_time: BIGINT>")
LOG = (f"common {COMMON}, page {PAGE}, start MAP<STRING,STRING>, err MAP<STRING,STRING>, "
       "displays ARRAY<MAP<STRING,STRING>>, actions ARRAY<MAP<STRING,STRING>>, ts BIGINT")

ROUTE = ("source_table STRING, sink_table STRING, sink_columns STRING, sink_family STRING, "
         "sink_row_key STRING")
FACT_ROUTE = "source_table STRING, source_type STRING, sink_table STRING, sink_columns STRING"

ORDER_DETAIL_FACT = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id", "activity_rule_id",
    "coupon_id", "date_id", "create_time", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "ts_ms",
]
ORDER_DETAIL = ", ".join(f"{c} {'BIGINT' if c == 'ts_ms' else 'STRING'}" for c in ORDER_DETAIL_FACT)

WEATHER = "status STRING, info STRING, lives ARRAY<STRING>"
