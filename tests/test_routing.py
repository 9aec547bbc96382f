"""Config routing, dimension upserts and deletes against a cell-by-cell simulation."""

from __future__ import annotations

import hashlib
import random

from conftest import rows
from pyspark.sql import functions as F

from marketlens.operators import routing as rt, sinks as sk
from marketlens.sources.readers import local_table
from marketlens.sources.schemas import CHANGE, ROUTE

ROUTES = [("user", "dim_user", "id,name,city", "info", "id"), ("sku", "dim_sku", "id,price", "info", "id")]


def changes(n=300):
    """Changes of two routed tables and one other, a third of them of one row; empty cells and deletes."""
    rnd, out = random.Random(4), []
    for ts in range(n):
        table = rnd.choice(["user", "user", "sku", "other"])
        key = "hot" if rnd.random() < 0.34 else f"k{rnd.randrange(12)}"
        row = {"id": key, "name": rnd.choice(["a", "b", "", None]), "city": rnd.choice(["x", "", None]),
               "price": str(rnd.randrange(5)), "extra": "e"}
        op = rnd.choice(["r", "c", "u", "u", "d"])
        out.append((op, row if op in "ud" else None, None if op == "d" else row, {"db": "shop", "table": table}, ts))
    return out


def expected(data):
    """Cells after all puts and deletes in the order of time."""
    kept = {r[0]: (r[1], r[2].split(","), r[4]) for r in ROUTES}
    cells: dict = {}
    for op, before, after, source, _ in sorted(data, key=lambda r: r[4]):
        if source["table"] not in kept:
            continue
        sink, columns, key = kept[source["table"]]
        row = (sink, (before if op == "d" else after)[key])
        if op == "d":
            cells.pop(row, None)
        else:
            for c in columns:
                if after.get(c):
                    cells.setdefault(row, {})[c] = after[c]
    return cells


def test_dim_upsert_over_batches(spark, tmp_path):
    data = changes()
    df, routes = spark.createDataFrame(data, CHANGE), local_table(spark, ROUTE, ROUTES)
    routed = rt.route_dim_by_config(df, routes)
    # Batches out of order and one written twice.
    for batch, cond in ((0, "ts_ms % 3 = 2"), (1, "ts_ms % 3 = 0"), (1, "ts_ms % 3 = 0"), (2, "ts_ms % 3 = 1")):
        sk.dim_upsert(routed.where(cond), str(tmp_path / "dims"), batch)
    got = {(r.sink_table, r.row_key): r.cells for r in sk.read_dims(spark, str(tmp_path / "dims")).collect()}
    assert got == expected(data)


def test_single_batch_is_read_as_it_lies(spark, tmp_path, monkeypatch):
    data = changes()
    routed = rt.route_dim_by_config(spark.createDataFrame(data, CHANGE), local_table(spark, ROUTE, ROUTES))
    sk.dim_upsert(routed, str(tmp_path / "dims"), 0)
    monkeypatch.setattr(sk, "merge_cells", None)  # cells of one batch need no merge
    got = {(r.sink_table, r.row_key): r.cells for r in sk.read_dims(spark, str(tmp_path / "dims")).collect()}
    assert got == expected(data)


def test_one_pass_equals_batches(spark):
    data = changes()
    routed = rt.route_dim_by_config(spark.createDataFrame(data, CHANGE), local_table(spark, ROUTE, ROUTES))
    got = {(r.sink_table, r.row_key): r.cells for r in rt.dim_rows(rt.dim_cells(routed)).collect()}
    assert got == expected(data)


def test_md5_route_keeps_all_columns(spark):
    data = [("c", None, {"id": "1", "name": None}, {"db": "d", "table": "user"}, 1),
            ("d", {"id": "1"}, None, {"db": "d", "table": "user"}, 2)]
    got = rt.route_dim_md5(spark.createDataFrame(data, CHANGE), local_table(spark, ROUTE, ROUTES)).collect()
    assert [(r.row_key, r.data) for r in got] == [(hashlib.md5(b"1").hexdigest(), {"id": "1", "name": "null"})]


def _config(rows_):
    keys = rt.ROUTE_FIELDS
    return [(op, dict(zip(keys, v)) if op == "d" else None, None if op == "d" else dict(zip(keys, v)), None, ts)
            for op, v, ts in rows_]


def test_config_latest_and_lifecycle(spark, tmp_path):
    a, a2 = ("ta", "dim_a", "id", "info", "id"), ("ta", "dim_a2", "id,x", "info", "id")
    b, c = ("tb", "dim_b", "id", "info", "id"), ("tc", "dim_c", "id", "info", "id")
    data = _config([("r", a, 1), ("u", a2, 2), ("c", b, 1), ("d", b, 3), ("d", c, 1), ("c", c, 2)])
    df = spark.createDataFrame(data, CHANGE)
    assert rows(rt.config_latest(df).select("source_table", "sink_table")) == [("ta", "dim_a2"), ("tc", "dim_c")]
    spark.sql(f"CREATE DATABASE dims_test LOCATION '{tmp_path}/db'")
    try:
        assert set(rt.dim_table_lifecycle(spark, df, "dims_test")) == {"dim_a", "dim_a2", "dim_c"}
        names = {t.name for t in spark.catalog.listTables("dims_test")}
        assert names == {"dim_a", "dim_a2", "dim_c"}
    finally:
        spark.sql("DROP DATABASE dims_test CASCADE")


def test_dropped_tables_keep_no_rows(spark, tmp_path):
    name = "dim_odd"
    spark.sql(f"CREATE DATABASE dims_test LOCATION '{tmp_path}/db'")
    try:
        first = spark.createDataFrame(_config([("r", ("t", name, "id", "info, more", "id"), 1)]), CHANGE)
        tables = rt.dim_table_lifecycle(spark, first, "dims_test")
        assert tables == {name: ["info", "more"]}
        cells = spark.createDataFrame([(name, "1", {"id": "1"}), ("other", "2", {"id": "2"})],
                                      "sink_table STRING, row_key STRING, cells MAP<STRING,STRING>")
        rt.write_dims(spark, cells, "dims_test", tables, str(tmp_path / "rows"))
        assert [r.row_key for r in rt.read_dim_tables(spark, "dims_test", tables).collect()] == ["1"]
        again = rt.dim_table_lifecycle(spark, first, "dims_test")
        assert rt.read_dim_tables(spark, "dims_test", again).count() == 1  # nothing changed
        update = spark.createDataFrame(_config([("u", ("t", name, "id", "info", "id"), 2)]), CHANGE)
        assert rt.read_dim_tables(spark, "dims_test", rt.dim_table_lifecycle(spark, update, "dims_test")).count() == 0
    finally:
        spark.sql("DROP DATABASE dims_test CASCADE")


def test_fact_route_adds_time(spark):
    df = spark.createDataFrame([("t", "insert", 5, {"id": "1", "x": "2", "ts": "old"}), ("t", "update", 6, {"id": "1"})],
                               "`table` STRING, type STRING, ts BIGINT, data MAP<STRING,STRING>")
    routes = local_table(spark, "source_table STRING, source_type STRING, sink_table STRING, sink_columns STRING",
                         [("t", "insert", "dwd_t", "id,ts")])
    got = rt.route_fact_by_config(df, routes).select("sink_table", "data").collect()
    assert [(r.sink_table, r.data) for r in got] == [("dwd_t", {"id": "1", "ts": "5"})]


def test_upsert_and_compact(spark, tmp_path):
    path, target = str(tmp_path / "k"), str(tmp_path / "c")
    df = spark.createDataFrame([(i % 7, i, f"v{i}", i % 5 == 0) for i in range(100)], "k INT, ts INT, v STRING, gone BOOLEAN")
    sk.upsert(df.where("ts >= 50"), path, 0, ["k"], ["ts"])
    sk.upsert(df.where("ts < 50"), path, 1, ["k"], ["ts"])
    want = sorted(((k, max(i for i in range(100) if i % 7 == k)) for k in range(7)), key=repr)
    read = lambda p, d=None: sk.read_upserted(spark, p, ["k"], ["ts"], d)
    assert rows(read(path).select("k", "ts")) == want
    sk.compact(spark, path, target, ["k"], ["ts"])
    assert rows(read(target).select("k", "ts")) == want
    assert rows(read(path, F.col("gone")).select("k", "ts")) == [w for w in want if w[1] % 5]


def test_a_table_of_one_batch_is_read_without_merging(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k STRING, ts INT, v STRING")
    plan = lambda: sk.read_upserted(spark, path, ["k"], ["ts"])._jdf.queryExecution().optimizedPlan().toString()
    sk.upsert(df, path, 0, ["k"], ["ts"])
    assert "Aggregate" not in plan()
    assert rows(sk.read_upserted(spark, path, ["k"], ["ts"])) == [("a", 2, "y"), ("b", 1, "z")]
    sk.upsert(spark.createDataFrame([("a", 3, "w")], df.schema), path, 1, ["k"], ["ts"])
    assert "Aggregate" in plan()
    assert rows(sk.read_upserted(spark, path, ["k"], ["ts"])) == [("a", 3, "w"), ("b", 1, "z")]
