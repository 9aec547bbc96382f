"""Parsing, splitting and filtering of logs and changes at their edges."""

from __future__ import annotations

import json

from conftest import rows
from pyspark.sql import functions as F

from marketlens.operators import filters as fl, logs as lg
from marketlens.sources import readers as rd
from marketlens.sources.schemas import CHANGE, LOG

PAGE = {"common": {"mid": "m", "uid": "1", "os": "iOS 13.3", "is_new": "1"}, "page": {"page_id": "home"}, "ts": 5,
        "displays": [{"item": "a"}, {"item": "b"}], "actions": [{"action_id": "x"}], "err": {"error_code": "7"}}
START = {"common": {"mid": "m"}, "start": {"entry": "icon"}, "ts": 6}
EMPTY = {"common": {"mid": "m"}, "page": {"page_id": "cart"}, "ts": 7, "displays": [], "actions": []}


def lines(spark, *values):
    """Texts as a topic."""
    return spark.createDataFrame([(v if isinstance(v, (str, type(None))) else json.dumps(v),) for v in values],
                                 "value STRING")


def test_dirty_split_and_tombstones(spark):
    clean, dirty = rd.split_dirty(lines(spark, PAGE, '{"common": {', "no json", None, START), LOG)
    assert sorted(r.ts for r in clean.collect()) == [5, 6]
    assert rows(dirty) == [("no json",), ('{"common": {',)]
    assert rd.drop_tombstones(lines(spark, None, "x")).count() == 1


def test_split_log_streams(spark):
    logs = rd.parse_json(lines(spark, PAGE, START, EMPTY), LOG)
    parts = {k: v.count() for k, v in lg.split_log_streams(logs).items()}
    assert parts == {"err": 1, "start": 1, "display": 2, "action": 1, "page": 2}
    assert "ts" not in lg.split_log_streams(logs)["action"].columns
    tagged = lg.tagged_log_lines(logs).groupBy("stream").count()
    assert {r["stream"]: r["count"] for r in tagged.collect()} == parts
    only = lg.tagged_log_lines(logs, err_only=True).where("stream = 'err'").select("value")
    assert rows(only) == [('{"error_code":"7"}',)]
    page = lg.tagged_log_lines(logs).where("stream = 'page' AND value LIKE '%home%'").first().value
    assert set(json.loads(page)) == {"common", "page", "ts"}


def test_login_filter(spark):
    df = spark.createDataFrame([("1", "login"), ("1", ""), ("1", None), ("1", "home"), ("", "login"), (None, None)],
                               "uid STRING, last_page_id STRING")
    assert fl.filter_login_page(df).count() == 3


def test_strip_common_device(spark):
    logs = rd.parse_json(lines(spark, PAGE, START, {"page": {"page_id": "x"}, "ts": 1}), LOG)
    got = fl.strip_common_device(logs).select("uid", "deviceInfo.os", "search_item")
    assert rows(got) == [("-1", None, None), ("1", "iOS", None)]


def _change(op, table, after, before=None, db="shop"):
    return (op, before, after, {"db": db, "table": table}, 1)


def test_cdc_filters(spark):
    data = [_change("r", "t", {"a": "1"}), _change("x", "t", {"a": "1"}), _change("c", "t", {}), _change("u", "t", None),
            _change("d", "t", None, {"a": "1"}), _change("c", "t", {"a": "1"}, db="other")]
    df = spark.createDataFrame(data, CHANGE)
    assert sorted(r.op for r in fl.cdc_filter_valid(df, "shop").collect()) == ["d", "r"]
    assert [r.op for r in fl.cdc_filter_valid(df, "shop", deletes=False).collect()] == ["r"]


def test_cart_quantities(spark):
    data = [_change("r", "cart_info", {"id": "1", "sku_num": "3"}),
            _change("u", "cart_info", {"id": "2", "sku_num": "5"}, {"sku_num": "2"}),
            _change("u", "cart_info", {"id": "3", "sku_num": "1"}, {"sku_num": "2"}),
            _change("c", "cart_info", {"id": "4", "sku_num": "1"})]
    got = fl.filter_cart_add(spark.createDataFrame(data, CHANGE)).select("id", "sku_num")
    assert rows(got) == [("1", "3"), ("2", "3")]


def test_weather_rows(spark):
    resp = ['{"status":"1","info":"OK","lives":[{"reporttime":"t","x":1}]}', '{"status":"1","lives":[[]]}',
            '{"status":"1","lives":[]}', '{"status":"1"}', '{"status":"0","info":"bad"}', "broken"]
    df = spark.createDataFrame([(i, "p", None, None, r) for i, r in enumerate(resp)],
                               "code INT, province STRING, city STRING, area STRING, resp STRING")
    got = fl.weather_flatten(df).orderBy("code").collect()
    assert [r.ok for r in got] == [True, False, False, True, False, False]
    assert (got[0].area, got[0].report_time, json.loads(got[0].lives)) == ("p", "t", {"reporttime": "t", "x": 1})
    assert (got[3].lives, got[3].report_time) == ("{}", None)


def test_files(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.txt").write_text("one, two ,\r\nthree\n\n two", encoding="utf-8")
    (tmp_path / "w" / "b.csv").write_text("no", encoding="utf-8")
    assert rows(rd.word_lists(spark, str(tmp_path / "w"))) == [("one",), ("three",), ("two",)]
    (tmp_path / "codes.txt").write_text('110000 北京市\n110100 "北京市,市辖区"\n110101 北京市,市辖区,东城区\n', encoding="utf-8")
    assert rows(rd.region_codes(spark, str(tmp_path / "codes.txt"))) == [
        (110000, "北京市", None, None), (110100, "北京市", "市辖区", None), (110101, "北京市", "市辖区", "东城区")]


def test_snapshot_types(spark):
    df = spark.sql("SELECT 1 AS id, CAST(1.50 AS DECIMAL(16,2)) AS price, DATE '1970-02-01' AS day")
    after = rd.snapshot_as_changes(df, "d", "t", F.lit(1)).first().after
    assert after == {"id": "1", "price": "1.5", "day": "31"}
