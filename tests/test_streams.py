"""Streams over several micro-batches equal the batch forms; late rows are dropped."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_keyed import FACTS, ORDER, SCHEMA, T0, facts, logs

from marketlens.operators import keyed
from marketlens.operators.joins import stream_interval_join
from marketlens.session import ROCKSDB_PROVIDER, settings
from marketlens.streaming import flows, processors as pr


@pytest.fixture
def stream_of(spark, tmp_path):
    """Lay down rows in time order as several files and read one file per micro-batch."""
    def make(df, parts=3, order="ts_ms"):
        path, data = str(tmp_path / "in"), sorted(df.collect(), key=lambda r: (r[order], r[0]))
        size = -(-len(data) // parts)
        for i in range(0, len(data), size):
            spark.createDataFrame(data[i:i + size], df.schema).coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return make


@pytest.fixture
def drain(spark, tmp_path):
    """Run a stream to its end."""
    def run(stream):
        with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER,
                      spark__sql__shuffle__partitions="3"):
            return flows.drain(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    return run


def test_fix_is_new(spark, stream_of, drain):
    df = spark.createDataFrame(logs(n=150), SCHEMA)
    stream = stream_of(df)
    got = drain(pr.keyed_rule(stream, "mid", pr.FixIsNew(ORDER), stream.schema))
    assert rows(got) == rows(keyed.fix_is_new(df, ORDER))


def test_login_back(spark, stream_of, drain):
    df = spark.createDataFrame(logs(n=120), SCHEMA).where("uid <> ''")
    stream = stream_of(df)
    timed = flows.with_watermark(stream.where("coalesce(last_page_id, '') IN ('', 'login')"), "0 seconds")
    out = drain(pr.keyed_rule(timed, "uid", pr.LoginBack(ORDER), flows._plus(timed.schema, "uu_ct", "back_ct"), "rt"))
    assert rows(out.select("uid", "ts_ms", "uu_ct", "back_ct")) == rows(keyed.uu_login_back(df, ORDER))


def test_retract(spark, stream_of, drain):
    df = spark.createDataFrame(facts(150), FACTS)
    order = ["ts_ms", "row_id"]
    stream = stream_of(df)
    got = drain(pr.keyed_rule(stream, "id", pr.RetractPrevious(stream.schema, order, "split_total_amount"), stream.schema))
    want = keyed.retract_previous(df, "id", order, "row_id", "split_total_amount")
    assert rows(got) == rows(want)


def _held(spark, checkpoint, name="last"):
    """Keys whose state is still held."""
    state = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    return {r.key[0] for r in state.select("key").collect()}


@pytest.mark.parametrize("rule", ["first", "fix", "login", "latest", "retract", "profile"])
def test_state_is_empty_after_its_time(spark, stream_of, drain, tmp_path, rule):
    far = T0 + 40 * pr.DAY_MS
    data = [(i, f"u{i % 4}", "1", f"v{i % 3}", str(i), T0 + i * 60_000) for i in range(60)] + [(99, "far", "1", "v", None, far)] + [
        (100, "far", "1", "v", "1", far + 1)]
    timed = flows.with_watermark(stream_of(spark.createDataFrame(
        data, "row_id INT, uid STRING, is_new STRING, os STRING, amount STRING, ts_ms BIGINT"), parts=6), "0 seconds")
    keep, name = pr.DAY_MS, "last"
    made = {"first": lambda: pr.keyed_rule(timed, "uid", pr.FirstOfDay(ORDER), flows._plus(timed.schema, "is_first")),
            "fix": lambda: pr.keyed_rule(timed, "uid", pr.FixIsNew(ORDER, keep), timed.schema),
            "login": lambda: pr.keyed_rule(timed, "uid", pr.LoginBack(ORDER, 8, keep),
                                           flows._plus(timed.schema, "uu_ct", "back_ct")),
            "latest": lambda: pr.keyed_rule(timed, "uid", pr.DedupLatest(ORDER, keep), timed.schema),
            "retract": lambda: pr.keyed_rule(timed, "uid", pr.RetractPrevious(timed.schema, ORDER, "amount", keep), timed.schema),
            "profile": lambda: pr.keyed_rule(timed, "uid", pr.RunningProfile(ORDER, ["os"], keep),
                                             "uid STRING, ts_ms BIGINT, row_id INT, pv BIGINT, os STRING")}
    assert drain(made[rule]()).count() > 0
    assert _held(spark, str(tmp_path / "checkpoint"), "views" if rule == "profile" else name) == {"far"}


def test_null_amounts_and_orders_pass(spark, stream_of, drain):
    data = [(1, "a", "1.5", T0), (2, "a", None, T0 + 1), (None, "a", "x", T0 + 2), (4, "a", "2", T0 + 3)]
    stream = stream_of(spark.createDataFrame(data, "row_id INT, id STRING, amount STRING, ts_ms BIGINT"), parts=2)
    got = drain(pr.keyed_rule(stream, "id", pr.RetractPrevious(stream.schema, ["row_id", "ts_ms"], "amount"), stream.schema))
    assert sorted(r.amount or "" for r in got.collect()) == ["", "", "", "-1.5000", "1.5", "2", "x"]


def test_first_cart_of_day_is_kept_once(spark, stream_of, drain):
    data = [(i, f"u{i % 3}", T0 + i * 1000) for i in range(60)]
    stream = stream_of(spark.createDataFrame(data, "id INT, user_id STRING, ts_ms BIGINT"))
    assert drain(flows.first_cart_of_day(stream)).count() == 3


def test_late_rows_are_dropped(spark, stream_of, drain):
    from marketlens.operators import windows as win
    from pyspark.sql import functions as F
    # File order is arrival order: two rows, a far newer one, one behind the watermark, a closing one.
    data = [(0, T0), (1, T0 + 3_600_000), (2, T0 + 7_200_000), (3, T0 + 1000), (4, T0 + 86_400_000)]
    df = spark.createDataFrame(data, "arrival INT, ts_ms BIGINT")
    stream = stream_of(df, parts=5, order="arrival")
    got = drain(win.with_window_text(win.tumble_stream(stream, 10, [], [F.count("*").alias("n")]), 10))
    assert [r.n for r in got.orderBy("stt").collect()] == [1, 1, 1]


def test_a_join_has_one_store_and_writes_changes_only(spark, stream_of, tmp_path):
    """Four stores a partition and whole snapshots per micro-batch cost more than the rows of small micro-batches."""
    df = spark.createDataFrame([(f"k{i}", T0 + i * 1000) for i in range(30)], "k STRING, ts_ms BIGINT")
    left = stream_of(df).withColumn("rt", F.timestamp_millis("ts_ms"))
    right = left.select(F.col("k").alias("q"), F.col("rt").alias("at"))
    with flows.state_settings(spark), settings(spark, spark__sql__shuffle__partitions="2"):
        got = flows.drain(stream_interval_join(left, right, "k", "q", "rt", "at", "1 MINUTE", "1 MINUTE"),
                          str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert got.count() == 30
    store = tmp_path / "checkpoint" / "state" / "0" / "0"
    files = [f.name for f in store.rglob("*") if not f.name.startswith(".")]
    assert not [f for f in files if "keyTo" in f or "keyWith" in f]
    assert [f for f in files if f.endswith(".changelog")]
