"""Scalar, clock and score functions at their boundaries."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions import clock as ck, scalars as fs, scores as sc


def one(spark, column, **values):
    """Value of a column over one row of literals."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("v")).first()["v"]


def test_dates_do_not_depend_on_the_session_zone(spark):
    ms = 1710055970000  # 2024-03-10 07:32:50 UTC, inside the New York clock change
    assert one(spark, ck.ts_to_datetime(F.lit(ms))) == "2024-03-10 07:32:50"
    assert one(spark, ck.ts_to_datetime(F.lit(ms), "+08:00")) == "2024-03-10 15:32:50"
    assert one(spark, ck.ts_to_date(F.lit(1710000000000 - 1), "Asia/Shanghai")) == "2024-03-09"
    assert one(spark, ck.ts_to_partition(F.lit(ms))) == "20240310"
    assert one(spark, ck.datetime_to_ts(F.lit("2024-03-10 02:30:00"))) == 1710037800000
    assert one(spark, ck.datetime_to_ts(F.lit("2024-03-10 02:30:00"), "+08:00")) == 1710037800000 - 8 * 3600000
    assert one(spark, ck.datetime_to_ts(F.lit("no date"))) is None
    assert one(spark, ck.millis_to_date(F.lit("x"))) is None


def test_window_start_is_aligned(spark):
    assert one(spark, ck.window_start(F.lit(1704067203999), 4)) == 1704067200000
    assert one(spark, ck.window_start(F.lit(1704067204000), 4)) == 1704067204000


@pytest.mark.parametrize("born,today,want", [
    ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-05-12", "2025-05-12", 25),
    ("2000-05-13", "2025-05-12", 24), (None, "2025-05-12", -1)])
def test_age(spark, born, today, want):
    assert one(spark, ck.age(F.lit(born).cast("date"), F.lit(today).cast("date"))) == want


@pytest.mark.parametrize("day,sign", [
    ("2000-01-19", "摩羯座"), ("2000-01-20", "水瓶座"), ("2000-02-18", "水瓶座"), ("2000-02-19", "双鱼座"),
    ("2000-03-20", "双鱼座"), ("2000-03-21", "白羊座"), ("2000-06-21", "双子座"), ("2000-06-22", "巨蟹座"),
    ("2000-10-23", "天秤座"), ("2000-10-24", "天蝎座"), ("2000-11-22", "天蝎座"), ("2000-11-23", "射手座"),
    ("2000-12-21", "射手座"), ("2000-12-22", "摩羯座")])
def test_zodiac(spark, day, sign):
    assert one(spark, ck.zodiac(F.lit(day).cast("date"))) == sign


def test_epoch_day_and_decade(spark):
    assert one(spark, ck.epoch_day(F.lit("-1"))) == dt.date(1969, 12, 31)
    assert one(spark, ck.epoch_day(F.lit("?"))) is None
    assert one(spark, ck.decade(F.lit("1999-12-31").cast("date"))) == 1990


@pytest.mark.parametrize("gap_days,want", [(7, 7), (8, 8)])
def test_day_diff(spark, gap_days, want):
    ms = 1704067200000 + gap_days * ck.DAY_MS
    assert one(spark, ck.day_diff(F.lit(ms), F.lit("2024-01-01"))) == want
    assert one(spark, ck.day_diff(F.lit(ms - 1), F.lit("2024-01-01"))) == want - 1


def test_maps_and_amounts(spark):
    left = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    right = F.create_map(F.lit("b"), F.lit("3"), F.lit("c"), F.lit("4"))
    assert one(spark, fs.merge_objects(left, right)) == {"a": "1", "b": "3", "c": "4"}
    assert one(spark, fs.prefix_keys(left, "info_")) == {"info_a": "1", "info_b": "2"}
    assert one(spark, fs.keep_keys(left, F.lit("b,z"))) == {"b": "2"}
    assert one(spark, fs.decimal_mul(F.lit("3"), F.lit("2.5"))) == "7.5000"
    assert one(spark, fs.decimal_mul(F.lit("x"), F.lit("2.5"))) is None
    assert one(spark, fs.negate_amount(F.lit("-5.5"))) == "5.5000"
    assert one(spark, fs.round3(F.lit(0.7) * 0.15)) == 0.105
    assert fs.snake("goodDetailUvCt") == "good_detail_uv_ct" and fs.camel("tm_name") == "tmName"


@pytest.mark.parametrize("amount,want", [
    (999.99, (0.12, 0.09)), (1000.0, (0.015, 0.03)), (1000.01, (0.03, 0.06)), (3999.99, (0.03, 0.06)),
    (4000.0, (0.015, 0.03))])
def test_score_amount(spark, amount, want):
    assert tuple(spark.range(1).select(*sc.score_amount(F.lit(amount))).first()) == want


def test_scores_of_names(spark):
    get = lambda cols: tuple(spark.range(1).select(*cols).first())
    assert get(sc.score_device(F.lit("iOS,Android"))) == (0.07, 0.06, 0.05, 0.04, 0.03, 0.02)
    assert get(sc.score_device(F.lit("Harmony"))) == (None,) * 6
    assert get(sc.score_search(F.lit("健康与养生"))) == (0.015, 0.03, 0.06, 0.09, 0.12, 0.135)
    assert get(sc.score_search(F.lit(None).cast("string"))) == (0.0,) * 6
    assert get(sc.score_brand(F.lit("TCL"))) == (0.04, 0.06)
    assert get(sc.score_brand(F.lit("other"))) == (0.02, 0.04)
    assert get(sc.score_brand(F.lit(""))) == (None, None)
    assert get(sc.score_category(F.lit("图书、音像、电子书刊"))) == (0.06, 0.12)
    assert get(sc.score_pay_time(F.lit("夜间"))) == (0.09, 0.07)
    hours = spark.createDataFrame([(h,) for h in (0, 4, 5, 7, 8, 19, 20, 23)], "h INT")
    assert [r[0] for r in hours.select(sc.day_part(F.col("h"))).collect()] == [
        "凌晨", "凌晨", "早晨", "早晨", "上午", "晚上", "夜间", "夜间"]


def test_age_level_takes_the_first_highest_bracket(spark):
    df = spark.createDataFrame([(0.1, 0.3, 0.3), (None, None, None)], "search_18_24 DOUBLE, search_25_29 DOUBLE, "
                                                                      "device_30_34 DOUBLE")
    assert [r[0] for r in df.select(sc.age_level(df.columns)).collect()] == ["25_29", "18_24"]
