"""Batch forms of the state rules against row-by-row simulations, with a hot key and exact copies."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from conftest import rows

from marketlens.catalog import state
from marketlens.operators import dedupe as dd, keyed, windows as win
from marketlens.plans import windows as wd

DAY = 86_400_000
T0 = 1704067200000


def date(ms):
    """UTC day."""
    return dt.datetime.fromtimestamp(ms // 1000, dt.timezone.utc).strftime("%Y-%m-%d")


def logs(seed=3, n=600):
    """Page logs: a third of one device, ties in time, days apart."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        mid = "hot" if rnd.random() < 0.35 else f"m{rnd.randrange(12)}"
        ts = T0 + rnd.randrange(14) * DAY * 2 + rnd.choice([0, 0, 5000, rnd.randrange(DAY)])
        out.append((i, mid, mid if rnd.random() < 0.9 else rnd.choice(["", None]), ts, rnd.choice("01"),
                    rnd.choice(["home", "good_detail", "cart"]), rnd.choice(["", "login", "home", None]),
                    rnd.randrange(50)))
    return out


SCHEMA = ("row_id BIGINT, mid STRING, uid STRING, ts_ms BIGINT, is_new STRING, page_id STRING, last_page_id STRING, "
          "during_time BIGINT")
ORDER = ["ts_ms", "row_id"]


def by_time(data):
    """Rows in the order of time and id."""
    return sorted(data, key=lambda r: (r[3], r[0]))


def test_fix_is_new(spark):
    data, state, want = logs(), {}, []
    for r in by_time(data):
        new = r[4]
        if r[1] not in state:
            state[r[1]] = date(r[3]) if new == "1" else date(r[3] - DAY)
        elif new == "1" and state[r[1]] != date(r[3]):
            new = "0"
        want.append((r[0], new))
    got = keyed.fix_is_new(spark.createDataFrame(data, SCHEMA), ORDER).select("row_id", "is_new")
    assert rows(got) == sorted(want, key=repr)


def test_uv_daily_flag_and_visitors(spark):
    data, state, want = logs(), {}, []
    for r in by_time(data):
        want.append((r[0], int(state.get(r[1]) != date(r[3])), int(not r[6]), r[7]))
        state[r[1]] = date(r[3])
    df = spark.createDataFrame(data, SCHEMA)
    got = keyed.uv_daily_flag(df).select("row_id", "uv_ct", "sv_ct", "dur_sum")
    assert rows(got) == sorted(want, key=repr)
    extra = df.selectExpr("*", "'v' AS vc", "'c' AS ch", "'a' AS ar")
    sums = wd.visitors(extra, ORDER).selectExpr("sum(uv_ct)", "sum(sv_ct)", "sum(pv_ct)", "sum(dur_sum)").first()
    assert tuple(sums) == (sum(w[1] for w in want), sum(w[2] for w in want), len(want), sum(w[3] for w in want))


def test_home_detail(spark):
    data, state, want = logs(), {}, []
    for r in by_time(data):
        if r[5] in ("home", "good_detail"):
            if state.get((r[1], r[5])) != date(r[3]):
                want.append((r[1], r[3], int(r[5] == "home"), int(r[5] != "home")))
            state[(r[1], r[5])] = date(r[3])
    assert rows(keyed.uv_home_detail(spark.createDataFrame(data, SCHEMA), ORDER)) == sorted(want, key=repr)


def test_login_back(spark):
    data, state, want = logs(n=120), {}, []
    for r in by_time(data):
        if not r[2] or r[6] not in ("login", "", None):
            continue
        last = state.get(r[2])
        if last != date(r[3]):
            gap = 0 if last is None else (r[3] - int(dt.datetime.strptime(last, "%Y-%m-%d").replace(
                tzinfo=dt.timezone.utc).timestamp() * 1000)) // DAY
            want.append((r[2], r[3], 1, int(gap >= 8)))
            state[r[2]] = date(r[3])
    assert sum(w[3] for w in want) > 0
    assert rows(keyed.uu_login_back(spark.createDataFrame(data, SCHEMA), ORDER)) == sorted(want, key=repr)


def test_login_gap_of_seven_and_eight_days(spark):
    data = [(1, "m", "a", T0, "0", "p", "", 1), (2, "m", "a", T0 + 7 * DAY, "0", "p", "", 1),
            (3, "m", "b", T0, "0", "p", "", 1), (4, "m", "b", T0 + 8 * DAY, "0", "p", "", 1)]
    got = keyed.uu_login_back(spark.createDataFrame(data, SCHEMA), ORDER)
    assert {(r.uid, r.back_ct) for r in got.where(f"ts_ms > {T0}").collect()} == {("a", 0), ("b", 1)}


FACTS = "row_id BIGINT, id STRING, order_id STRING, province_id STRING, ts_ms BIGINT, split_total_amount STRING"


def facts(n=300):
    """Order-line versions: a third of one line, exact copies among them."""
    rnd = random.Random(9)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.34 else f"d{rnd.randrange(60)}"
        out.append((i, key, f"o{key}", str(rnd.randrange(3)), T0 + rnd.randrange(40) * 1000, f"{rnd.randrange(500)}.2500"))
    return out + [(n + i, "copy", "oc", "1", T0, "7.5000") for i in range(40)]


def test_retract_and_debounce(spark):
    data, last, want = facts(), {}, []
    for r in sorted(data, key=lambda r: (r[4], r[5], r[3], r[0])):
        if r[1] in last:
            old = last[r[1]]
            want.append((*old[:5], str(-Decimal(old[5]))))
        want.append(r)
        last[r[1]] = r
    df, order = spark.createDataFrame(data, FACTS), ["ts_ms", "split_total_amount", "province_id"]
    got = keyed.retract_previous(df, "id", order, "row_id", "split_total_amount")
    assert rows(got) == sorted(want, key=repr)
    latest = keyed.debounce_last(df, "id", [*order, "row_id"]).select(*df.columns)
    assert rows(latest) == sorted(last.values(), key=repr)

    sums: dict = {}
    for r in want:
        k = (r[4] - r[4] % 4000, r[3])
        amount, orders = sums.get(k, (Decimal(0), set()))
        sums[k] = (amount + Decimal(r[5]), orders | {r[2]})
    got = wd.province_sums(df, order).select("window_ms", "province_id", "order_amount", "order_count")
    assert {(r[0], r[1]): (r[2], r[3]) for r in got.collect()} == {k: (a, len(o)) for k, (a, o) in sums.items()}


def test_running_profile(spark):
    rnd, data = random.Random(5), []
    for i in range(400):
        uid = "hot" if rnd.random() < 0.4 else f"u{rnd.randrange(5)}"
        data.append((uid, T0 + rnd.randrange(600) * 1000, i, rnd.choice(["iOS", "Android"]),
                     rnd.choice([None, "x", "y", "z"])))
    state, want, ends = {}, [], {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        pv, os_, items = state.get(r[0], (0, set(), set()))
        state[r[0]] = (pv + 1, os_ | {r[3]}, items | ({r[4]} if r[4] else set()))
        pv, os_, items = state[r[0]]
        row = (pv, ",".join(sorted(os_)), ",".join(sorted(items)))
        want.append((r[0], r[1], r[2], *row))
        ends[(r[0], r[1] - r[1] % 120000)] = (r[1], *row)
    df = spark.createDataFrame(data, "uid STRING, ts_ms BIGINT, row_id INT, os STRING, search_item STRING")
    for piece in (1000, 60_000, 10_000_000):
        got = keyed.running_profile(df, "uid", "ts_ms", "row_id", ["os", "search_item"], piece)
        assert rows(got) == sorted(want, key=repr)
    got = keyed.window_profile(df, "uid", "ts_ms", ["os", "search_item"])
    assert {(r[0], r[1]): tuple(r[2:]) for r in got.collect()} == ends


def test_dedup_latest_ts(spark):
    rnd = random.Random(2)
    data = [("hot" if rnd.random() < 0.4 else f"u{rnd.randrange(4)}", rnd.randrange(100), i) for i in range(300)]
    top, want = {}, []
    for uid, ts, i in data:
        if uid not in top or ts > top[uid]:
            want.append((uid, ts, i))
            top[uid] = ts
    df = spark.createDataFrame(data, "uid STRING, ts_ms BIGINT, arrival BIGINT")
    for piece in (1, 7, 100, 10_000):
        assert rows(dd.dedup_latest_ts(df, "uid", "ts_ms", "arrival", piece)) == sorted(want, key=repr)


def test_dedup_keys_loses_nothing(spark):
    df = spark.createDataFrame([(i % 50, i % 3, i) for i in range(600)], "a INT, b INT, c INT")
    assert rows(dd.dedup_keys(df, ["a", "b"], ["c"])) == sorted(
        {(i % 50, i % 3): (i % 50, i % 3, i) for i in reversed(range(600))}.values(), key=repr)


def test_last_in_window_and_count(spark):
    df = spark.createDataFrame([("a", T0 + 1, "x"), ("a", T0 + 119_999, "y"), ("a", T0 + 120_000, "z")],
                               "uid STRING, ts_ms BIGINT, v STRING")
    got = win.last_in_window(df, "uid", ["ts_ms"], 120).select("window_ms", "v")
    assert rows(got) == [(T0, "y"), (T0 + 120_000, "z")]
    text = win.with_window_text(win.count_window(df, 120, "n"), 120)
    assert rows(text) == [("2024-01-01 00:00:00", "2024-01-01 00:02:00", "2024-01-01", 2),
                          ("2024-01-01 00:02:00", "2024-01-01 00:04:00", "2024-01-01", 1)]


def test_debounce_query_hands_on_only_what_tells_versions_apart(spark):
    plan = state.debounce_last(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "split_total_amount" in aggregate and "sku_name" not in aggregate and "coupon_id" not in aggregate
