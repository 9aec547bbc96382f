"""Filters and projections over change logs and client logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketlens.functions.clock import age, decade, epoch_day, ts_to_datetime, zodiac
from marketlens.functions.scalars import decimal_mul, first_token, is_empty
from marketlens.sources.schemas import WEATHER

# Status codes of the shop database.
CANCELLED = ("1001", "1003")
REFUNDING = "1006"
PAID = "1602"
REFUND_SETTLED = "0705"
# Provinces the weather job leaves out.
SKIPPED_PROVINCES = ("澳门特别行政区", "台湾省", "香港特别行政区")


def cdc_filter_valid(changes: DataFrame, db: str, deletes: bool = True) -> DataFrame:
    """Changes of one database with a known operation and a payload.

    The payload of a delete is its ``before`` image; ``deletes=False`` leaves deletes out.
    """
    payload = F.coalesce("after", "before") if deletes else F.col("after")
    return changes.where((F.col("source")["db"] == db) & F.col("op").isin("c", "u", "d", "r")
                         & (F.coalesce(F.size(payload), F.lit(0)) > 0))


def cdc_select_table(changes: DataFrame, name: str, fields: list[str], ops: tuple[str, ...] = ("r",),
                     where: Column | None = None) -> DataFrame:
    """Rows of one source table with payload fields as columns, plus ``ts_ms``."""
    rows = changes.where((F.col("source")["table"] == name) & F.col("op").isin(*ops))
    if where is not None:
        rows = rows.where(where)
    return rows.select(*[F.col("after")[f].alias(f) for f in fields], "ts_ms")


def _after(field: str) -> Column:
    return F.col("after")[field]


def filter_cart_add(changes: DataFrame) -> DataFrame:
    """Cart rows with the quantity added: snapshot rows, and updates that raise the quantity."""
    new, old = _after("sku_num").try_cast("int"), F.col("before")["sku_num"].try_cast("int")
    snapshot = F.col("op") == "r"
    raised = (F.col("op") == "u") & (new > old)
    return (changes.where((F.col("source")["table"] == "cart_info") & (snapshot | raised))
            .select(_after("id").alias("id"), _after("user_id").alias("user_id"), _after("sku_id").alias("sku_id"),
                    F.when(snapshot, _after("sku_num")).otherwise((new - old).cast("string")).alias("sku_num"),
                    "ts_ms"))


def filter_order_cancel(changes: DataFrame, strict: bool = True) -> DataFrame:
    """Cancelled orders; ``strict=False`` lets status 1003 rows of any table pass."""
    orders = (F.col("source")["table"] == "order_info") & (F.col("op") == "r")
    status = _after("order_status")
    keep = (orders & status.isin(*CANCELLED)) if strict else ((orders & (status == "1001")) | (status == "1003"))
    return changes.where(keep).select(
        _after("id").alias("id"), _after("operate_time").alias("operate_time"), "ts_ms")


def filter_payment_success(changes: DataFrame) -> DataFrame:
    """Payments that went through."""
    return cdc_select_table(changes, "payment_info", ["user_id", "order_id", "payment_type", "callback_time"],
                            where=_after("payment_status") == PAID)


def filter_refund_request(changes: DataFrame, times: bool = False) -> tuple[DataFrame, DataFrame]:
    """Refund requests, and the orders in refund, these with their times if wanted."""
    refunds = cdc_select_table(changes, "order_refund_info", [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "create_time"])
    orders = cdc_select_table(changes, "order_info", ["id", "province_id"], where=_after("order_status") == REFUNDING)
    return refunds, orders if times else orders.drop("ts_ms")


def filter_refund_paid(changes: DataFrame, times: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Paid refunds, settled refund requests, and the orders in refund, the latter two with their times if wanted."""
    paid = cdc_select_table(changes, "refund_payment", [
        "id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"],
        where=_after("refund_status") == PAID)
    settled = cdc_select_table(changes, "order_refund_info", ["order_id", "sku_id", "refund_num"],
                               where=_after("refund_status") == REFUND_SETTLED)
    orders = cdc_select_table(changes, "order_info", ["id", "user_id", "province_id"],
                              where=_after("order_status") == REFUNDING)
    return (paid, settled, orders) if times else (paid, settled.drop("ts_ms"), orders.drop("ts_ms"))


def order_detail_rows(changes: DataFrame) -> DataFrame:
    """Order-detail snapshot rows with the original amount worked out."""
    rows = cdc_select_table(changes, "order_detail", [
        "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type", "sku_num",
        "order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount"])
    return rows.withColumn("split_original_amount", decimal_mul("sku_num", "order_price")).drop("order_price")


def filter_home_detail(logs: DataFrame) -> DataFrame:
    """Page logs of the home page and of product pages."""
    return logs.where(F.col("page_id").isin("home", "good_detail"))


def filter_login_page(logs: DataFrame) -> DataFrame:
    """Page logs of a known user that come from the login page or open a session."""
    return logs.where(~is_empty("uid") & ((F.col("last_page_id") == "login") | is_empty("last_page_id")))


def filter_search_keyword(logs: DataFrame) -> DataFrame:
    """Searched texts with their time."""
    return logs.where((F.col("last_page_id") == "search") & (F.col("item_type") == "keyword")
                      & F.col("item").isNotNull()).select(F.col("item").alias("fullword"), "ts_ms")


def filter_non_empty_uid(df: DataFrame, uid: str = "uid") -> DataFrame:
    """Rows with a user id."""
    return df.where(~is_empty(uid))


def strip_common_device(logs: DataFrame) -> DataFrame:
    """User id, time, device fields and searched text of a log with nested ``common`` and ``page``."""
    c, p = F.col("common"), F.col("page")
    device = F.struct(c["ar"].alias("ar"), c["ba"].alias("ba"), c["ch"].alias("ch"), c["md"].alias("md"),
                      first_token(c["os"]).alias("os"), c["uid"].alias("uid"), c["vc"].alias("vc"))
    extra = [x for x in logs.columns if x == "row_id"]
    return logs.where(c.isNotNull()).select(
        *extra, F.coalesce(c["uid"], F.lit("-1")).alias("uid"), F.col("ts").alias("ts_ms"),
        device.alias("deviceInfo"), F.when(p["item_type"] == "keyword", p["item"]).alias("search_item"))


def user_info_project(changes: DataFrame, as_of: Column) -> DataFrame:
    """User rows with birthday, decade, age at ``as_of`` and zodiac sign worked out."""
    rows = cdc_select_table(changes, "user_info", [
        "id", "name", "nick_name", "birthday", "phone_num", "email", "gender", "user_level", "login_name"],
        ops=("r", "c", "u"), where=F.col("after").isNotNull())
    born = epoch_day("birthday")
    return rows.select(
        F.col("id").alias("uid"), "name", "nick_name", born.cast("string").alias("birthday"),
        decade(born).alias("decade"), age(born, as_of).alias("age"), zodiac(born).alias("zodiac_sign"),
        "phone_num", "email", "gender", "user_level", "login_name", "ts_ms")


def user_sup_project(changes: DataFrame) -> DataFrame:
    """Body measures of users."""
    return cdc_select_table(changes, "user_info_sup_msg", [
        "uid", "height", "unit_height", "weight", "unit_weight"], ops=("r", "c", "u"),
        where=F.col("after").isNotNull())


def order_rows(changes: DataFrame) -> DataFrame:
    """Order rows for the user profile, creation time as text."""
    rows = cdc_select_table(changes, "order_info", ["id", "user_id", "total_amount", "create_time"],
                            ops=("r", "c", "u"))
    return rows.withColumn("create_time", ts_to_datetime(F.col("create_time").try_cast("bigint")))


def order_line_rows(changes: DataFrame) -> DataFrame:
    """Order-detail rows for the user profile, split amounts read from the payload."""
    return cdc_select_table(changes, "order_detail", [
        "id", "order_id", "sku_id", "sku_name", "sku_num", "order_price", "split_activity_amount",
        "split_total_amount"], ops=("r", "c", "u"))


def region_filter(cities: DataFrame) -> DataFrame:
    """Cities to fetch weather for."""
    return cities.where(F.col("city").isNotNull() & ~F.col("province").isin(*SKIPPED_PROVINCES))


def weather_flatten(responses: DataFrame) -> DataFrame:
    """One row per city and saved response (column ``resp``): report time, filled-in names, ``lives`` as JSON.

    ``ok`` is false where the response is not usable: bad status, or a list whose first entry is
    missing or no object.
    """
    r = F.from_json("resp", WEATHER)
    rows = responses.select("*", r.alias("_r"))
    live = F.get("_r.lives", F.lit(0))
    report = F.get_json_object(live, "$.reporttime")
    usable = (F.col("_r.status") == "1") & (F.col("_r.lives").isNull() | F.trim(live).startswith("{"))
    return rows.select(
        "code", F.coalesce("province", F.lit("")).alias("province"),
        F.coalesce("city", "province", F.lit("")).alias("city"),
        F.coalesce("area", "city", "province", F.lit("")).alias("area"),
        F.coalesce("_r.info", F.lit("")).alias("info"), F.coalesce(live, F.lit("{}")).alias("lives"),
        F.when(report != "", report).alias("report_time"), F.coalesce(usable, F.lit(False)).alias("ok"))
