"""Prefix state, existence joins, as-of joins and hand-over against brute force, with hot keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_joins import SPLIT, _largest_task

from marketlens.operators import joins as jn, keyed, routing as rt
from marketlens.plans import profile as pf
from marketlens.session import settings
from marketlens.sources import readers as rd

T0 = 1704067200000


def hot_rows(spark, n=40_000, values=3000):
    """One user with half of all rows, over half a day; most values are seen once."""
    return spark.range(n, numPartitions=6).selectExpr(
        "IF(id % 2 = 0, 'hot', CONCAT('u', id % 997)) AS uid", f"{T0} + (id * 7919) % 43200000 AS ts_ms", "id AS row_id",
        "CONCAT('os', id % 3) AS os", f"CONCAT('item', (id * 31) % {values}) AS search_item")


def test_no_window_of_a_prefix_holds_a_whole_key(spark):
    df, width, piece = hot_rows(spark), 16, 1000
    leaves = keyed.first_seen(df.withColumn("_piece", keyed._pieces("ts_ms", piece)), "uid", "ts_ms", ["os", "search_item"])
    n_leaves = leaves.where("uid = 'hot'").count()
    n_values = df.where("uid = 'hot'").select("search_item").distinct().count()
    assert n_leaves > 10_000 and n_values > 1000
    for level in keyed.prefix_levels(leaves, "uid", ["os", "search_item"], piece, width):
        groups = level.groupBy("uid", "_parent").agg(F.count("*").alias("n"), F.sum(F.size("search_item")).alias("v"))
        assert groups.agg(F.max("n")).first()[0] <= width
        # A value stands in one node per level, so what a level holds does not grow with pieces times values.
        assert groups.where("uid = 'hot'").agg(F.sum("v")).first()[0] == n_values


def test_hot_profile_is_spread_over_tasks(spark):
    with settings(spark, **SPLIT, spark__sql__adaptive__coalescePartitions__enabled="false"):
        df = hot_rows(spark).select("uid", "ts_ms", "row_id", "os")
        got = keyed.running_profile(df, "uid", "ts_ms", "row_id", ["os"], piece_ms=1000, width=16)
        assert _largest_task(got) < 8000  # half of the 40,000 rows have one key
        top = got.groupBy("uid").agg(F.max("pv").alias("pv"), F.count("*").alias("n"))
        assert top.where("pv <> n").count() == 0 and top.where("uid = 'hot'").first()["n"] == 20_000


@pytest.mark.parametrize("width", [2, 5, 256])
def test_window_profile_equals_brute_force(spark, width):
    rnd = random.Random(width)
    data = [(rnd.choice(["hot", "hot", "a", "b"]), T0 + rnd.randrange(400) * rnd.choice([1000, 3_600_000]), rnd.choice("xyz"),
             rnd.choice([None, *"pqrstuvw"])) for _ in range(300)]
    want = {}
    for uid, ts, _, _ in data:
        start = ts - ts % 120_000
        seen = [r for r in data if r[0] == uid and r[1] < start + 120_000]
        lists = [",".join(sorted({r[k] for r in seen if r[k]})) for k in (2, 3)]
        want[uid, start] = (max(r[1] for r in seen), len(seen), *lists)
    df = spark.createDataFrame(data, "uid STRING, ts_ms BIGINT, os STRING, search_item STRING")
    got = keyed.window_profile(df, "uid", "ts_ms", ["os", "search_item"], width=width)
    assert {(r[0], r[1]): tuple(r[2:]) for r in got.collect()} == want


@pytest.mark.parametrize("within", [0, 1, 17, 1000])
def test_near_values_equal_brute_force(spark, within):
    rnd = random.Random(within)
    lhs = [(rnd.choice(["a", "a", "b", None]), rnd.randrange(-50, 300), rnd.randrange(5)) for _ in range(120)]
    rhs = [(rnd.choice(["a", "b", "c", None]), rnd.randrange(-50, 300), rnd.choice([1.5, None]), rnd.choice("xy")) for _ in range(60)]
    want = sorted({(k, t, i, v, w) for k, t, i in lhs for q, u, v, w in rhs if k == q and k is not None and abs(t - u) <= within}, key=repr)
    got = jn.near_values(spark.createDataFrame(lhs, "k STRING, t BIGINT, i INT"),
                         spark.createDataFrame(rhs, "k STRING, u BIGINT, v DOUBLE, w STRING"), ["k"], "t", "u", within, ["v", "w"])
    assert rows(got) == want


def test_rows_out_of_the_label_join_grow_with_the_input(spark):
    """Rows that come out of the joins, by their row counters: linear, though one user has all rows."""
    def joined(n):
        pages = spark.range(n).selectExpr("'u' AS uid", f"{T0} + id * 1000 AS ts_ms", "0.1D AS device_18_24", "id % 2 * 0.3D AS search_50")
        orders = spark.range(n).selectExpr("'u' AS user_id", f"{T0} + id * 900 AS ts_ms", *[
            f"CAST(id % 3 AS DOUBLE) / 10 AS {c}" for c in pf.ORDER_SCORES])
        out = pf.age_labels(pages, orders)
        out.collect()
        return sum(int(m.group(1)) for m in __import__("re").finditer(r"JOINED:(\d+)", _join_rows(out)))
    small, large = joined(500), joined(2000)
    assert large <= 5 * small and small > 0


def _join_rows(df):
    """The rows out of each join of an executed plan, as text."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if name.endswith("QueryStage"):
            return walk(p.plan())
        if "Join" in name:
            found.append(f"JOINED:{p.metrics().apply('numOutputRows').value()}")
        kids = p.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    walk(plan)
    return " ".join(found)


@pytest.mark.parametrize("piece", [7, 50, 100_000])
def test_as_of_join_equals_brute_force(spark, piece):
    rnd = random.Random(piece)
    lhs = [(rnd.choice(["a", "a", "b", "z", None]), rnd.randrange(-100, 400), i) for i in range(200)]
    rhs = [(rnd.choice(["a", "b", "c"]), rnd.randrange(-80, 380), rnd.choice("xy"), rnd.randrange(9)) for _ in range(80)]
    want = []
    for k, t, i in lhs:
        best = max(((u, v, w) for q, u, v, w in rhs if q == k and u <= t), default=(None, None, None))
        want.append((k, t, i, *best))
    got = jn.as_of_join(spark.createDataFrame(lhs, "k STRING, t BIGINT, i INT"),
                        spark.createDataFrame(rhs, "k STRING, u BIGINT, v STRING, w INT"), ["k"], "t", "u", "r", piece)
    assert rows(got.select("k", "t", "i", "r.u", "r.v", "r.w")) == sorted(want, key=repr)


def _config(op, table, sink, ts):
    cells = {"source_table": table, "sink_table": sink, "sink_columns": "id", "sink_family": "info", "sink_row_key": "id"}
    return (op, cells if op == "d" else None, None if op == "d" else cells, ts)


CHANGE = "op STRING, before MAP<STRING,STRING>, after MAP<STRING,STRING>, ts_ms BIGINT"


def test_records_are_routed_by_the_config_of_their_time(spark):
    changes = spark.createDataFrame([_config("u", "t", "new", 100), _config("d", "t", "new", 200), _config("c", "t", "back", 300)], CHANGE)
    preload = spark.createDataFrame([("t", "old", "id", "info", "id"), ("s", "kept", "id", "info", "id")], rt.ROUTE_FIELDS)
    records = [("c", None, {"id": f"{t}-{ts}", "x": "y"}, {"table": t}, ts) for t in ("t", "s", "u") for ts in (50, 100, 150, 200, 250, 350)]
    df = spark.createDataFrame(records, "op STRING, before MAP<STRING,STRING>, after MAP<STRING,STRING>, source MAP<STRING,STRING>, ts_ms BIGINT")
    got = rt.route_dim_as_of(df, rt.config_versions(changes, preload)).select("source_table", "ts_ms", "sink_table", "data")
    assert rows(got) == sorted([("t", 50, "old", {"id": "t-50"}), ("t", 100, "new", {"id": "t-100"}), ("t", 150, "new", {"id": "t-150"}),
                                ("t", 350, "back", {"id": "t-350"}), *[("s", ts, "kept", {"id": f"s-{ts}"}) for ts in (
                                    50, 100, 150, 200, 250, 350)]], key=repr)


def test_hand_over_has_one_version_per_key_and_loses_no_change(spark):
    """A table of 60 keys in four ranges; the log goes on while they are read."""
    rnd = random.Random(12)
    base = {f"k{i}": {"v": "0"} for i in range(60)}
    log, live = [], dict(base)
    for pos in range(1, 400):
        key = f"k{rnd.randrange(70)}"
        op = "d" if key in live and rnd.random() < 0.2 else "u" if key in live else "c"
        live.pop(key, None) if op == "d" else live.__setitem__(key, {"v": str(pos)})
        log.append((pos, key, int(key[1:]) % 4, op, {"v": "b"} if op != "c" else None, None if op == "d" else {"v": str(pos)}, T0 + pos))
    marks, snapshot = [], []
    for part in range(4):
        low, high = 50 + part * 60, 50 + part * 60 + 45
        at, state = rnd.randrange(low, high + 1), {k: v for k, v in base.items() if int(k[1:]) % 4 == part}
        for pos, key, p, op, _, after, _ in log:
            if p == part and pos <= at:
                state.pop(key, None) if op == "d" else state.__setitem__(key, after)
        marks.append((part, low, high))
        snapshot += [(k, part, v) for k, v in state.items()]
    got = rd.hand_over(spark.createDataFrame(snapshot, "key STRING, part INT, after MAP<STRING,STRING>"),
                       spark.createDataFrame(marks, "part INT, low BIGINT, high BIGINT"),
                       spark.createDataFrame(log, "position BIGINT, key STRING, part INT, op STRING, before MAP<STRING,STRING>, "
                                                  "after MAP<STRING,STRING>, ts_ms BIGINT")).collect()
    heads = Counter(r.key for r in got if r.position is None)
    assert max(heads.values()) == 1
    later = [(r.key, r.position) for r in got if r.position is not None]
    high = {p: h for p, _, h in marks}
    assert sorted(later) == sorted((k, pos) for pos, k, p, *_ in log if pos > high[p])
    state = {r.key: r.after for r in got if r.position is None}
    for r in sorted((r for r in got if r.position is not None), key=lambda r: r.position):
        assert r.op == "c" or r.key in state  # the state at the hand-over fits the changes that follow
        state.pop(r.key, None) if r.op == "d" else state.__setitem__(r.key, r.after)
    assert state == live


def test_labels_have_a_row_for_each_pair_and_counts_add_them_up(spark):
    rnd = random.Random(7)
    pages = [(rnd.choice("ab"), T0 + rnd.randrange(4) * 20 * 3_600_000, rnd.choice([0.1, 0.3]), rnd.choice([0.0, 0.9])) for _ in range(30)]
    lines = [(rnd.choice("abc"), T0 + rnd.randrange(6) * 12 * 3_600_000, rnd.choice([0.1, 0.5])) for _ in range(25)]
    near = [(p, t, "50" if w > s + 4 * x else "18_24") for p, t, s, w in pages for q, u, x in lines if p == q and abs(t - u) <= 86_400_000]
    pages = spark.createDataFrame(pages, "uid STRING, ts_ms BIGINT, device_18_24 DOUBLE, search_50 DOUBLE")
    lines = spark.createDataFrame(lines, "user_id STRING, ts_ms BIGINT, x DOUBLE").select("user_id", "ts_ms", *[F.col("x").alias(c) for c in pf.ORDER_SCORES])
    got = rows(pf.age_label_rows(pages, lines))
    assert got == sorted(near, key=repr) and len(got) > len(set(got))
    counts = Counter((u, b) for u, _, b in got)
    assert rows(pf.age_level_counts(pages, lines)) == sorted(((*k, n) for k, n in counts.items()), key=repr)
    assert rows(pf.age_labels(pages, lines)) == sorted(set(got), key=repr)


def test_the_rows_are_read_a_fixed_number_of_times_however_many_levels(spark):
    rows = spark.createDataFrame([("u", 1_000 * i, i, "a") for i in range(40)], "uid STRING, ts BIGINT, row_id INT, os STRING")
    read = spark.sparkContext.accumulator(0)

    @F.udf("string", useArrow=False)
    def seen(os):
        read.add(1)
        return os

    df = rows.withColumn("os", seen.asNondeterministic()("os"))
    got = keyed.running_profile(df, "uid", "ts", "row_id", ["os"], width=64).collect()
    assert sorted(r.pv for r in got) == list(range(1, 41))
    assert read.value <= 3 * 40
