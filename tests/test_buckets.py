"""Bucketed state rules: equal to the batch forms over several micro-batches, and their state ends."""

from __future__ import annotations

import pathlib
import random
import time

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_keyed import FACTS, ORDER, SCHEMA, T0, facts, logs
from test_streams import _held, drain, stream_of  # noqa: F401

from marketlens.catalog.streams import drained
from marketlens.operators import keyed, routing as rt
from marketlens.plans import windows as wd
from marketlens.session import ROCKSDB_PROVIDER, settings
from marketlens.streaming import buckets as bk, facts as sfacts, flows


def test_fix_is_new(spark, stream_of, drain):  # noqa: F811
    df = spark.createDataFrame(logs(n=150), SCHEMA)
    stream = stream_of(df)
    got = drain(bk.bucketed(stream, ["mid"], bk.FixIsNew(stream.schema, ORDER), stream.schema, buckets=4))
    assert rows(got) == rows(keyed.fix_is_new(df, ORDER))


@pytest.mark.parametrize("rule", ["fix", "first"])
def test_a_stream_takes_over_from_a_table(spark, stream_of, drain, rule):  # noqa: F811
    df = spark.createDataFrame(logs(n=200), SCHEMA)
    middle = df.selectExpr("percentile(ts_ms, 0.5)").first()[0]
    before, after = df.where(F.col("ts_ms") <= middle), df.where(F.col("ts_ms") > middle)
    assert before.count() and after.count()
    stream = stream_of(after)
    if rule == "fix":
        out = bk.bucketed(stream, ["mid"], bk.FixIsNew(stream.schema, ORDER), stream.schema, buckets=4,
                          initial=keyed.first_dates(before, ORDER))
        want = keyed.fix_is_new(df, ORDER).where(F.col("ts_ms") > middle)
        fresh = keyed.fix_is_new(after, ORDER)
    else:
        seen = keyed.first_of_day(before, ["mid"], ORDER).select("mid", "visit_date", "ts_ms")
        out = flows.first_of_day(stream, "mid", ORDER, only=True, initial=seen).drop("rt", "is_first")
        want = keyed.first_of_day(df, ["mid"], ORDER).where(F.col("ts_ms") > middle).select(*df.columns)
        fresh = keyed.first_of_day(after, ["mid"], ORDER).select(*df.columns)
    assert rows(drain(out).select(*df.columns)) == rows(want.select(*df.columns)) != rows(fresh.select(*df.columns))


def test_retract(spark, stream_of, drain):  # noqa: F811
    df, order = spark.createDataFrame(facts(150), FACTS), ["ts_ms", "row_id"]
    stream = stream_of(df)
    got = drain(bk.bucketed(stream, ["id"], bk.RetractPrevious(stream.schema, "id", order, "split_total_amount"), stream.schema, buckets=4))
    assert rows(got) == rows(keyed.retract_previous(df, "id", order, "row_id", "split_total_amount"))


def test_a_late_version_is_taken_back_not_the_newer_one(spark, stream_of, drain):  # noqa: F811
    data = [(1, "a", "o", "1", T0 + 5, "5"), (2, "a", "o", "1", T0, "1"), (3, "a", "o", "1", T0 + 9, None)]
    df = spark.createDataFrame(data, FACTS)
    stream = stream_of(df, parts=3, order="row_id")
    got = drain(bk.bucketed(stream, ["id"], bk.RetractPrevious(stream.schema, "id", ["ts_ms"], "split_total_amount"), stream.schema))
    assert sorted(str(r.split_total_amount) for r in got.collect()) == ["-1.0000", "-5.0000", "1", "5", "None"]


def test_province_orders_count_orders_without_sets(spark, stream_of, drain):  # noqa: F811
    df = spark.createDataFrame(facts(200), FACTS)
    end = spark.createDataFrame([(-1, "end", "end", "0", T0 + 10**9, "0")], FACTS)
    order = ["ts_ms", "split_total_amount", "province_id"]
    names = spark.createDataFrame([("0", "north"), ("1", "south")], "id STRING, name STRING")
    out = drain(flows.province_orders(stream_of(df.unionByName(end), parts=4), names, order, delay="1 hour")).where("stt < '2024-01-05'")
    want = wd.province_orders(df, names, order=order)
    columns = ["stt", "province_id", "province_name", "order_count", "order_amount"]
    assert rows(out.select(*columns)) == rows(want.select(*columns))


@pytest.mark.parametrize("rule", ["fix", "first", "retract", "profile", "idle", "bloom"])
def test_state_is_empty_after_its_time(spark, stream_of, drain, tmp_path, rule):  # noqa: F811
    far, day = T0 + 40 * bk.DAY_MS, bk.DAY_MS
    data = [(i, f"u{i % 4}", "1", f"v{i % 3}", str(i), T0 + i * 60_000) for i in range(60)] + [(99, "far", "1", "v", None, far)] + [
        (100, "far", "1", "v", "1", far + 1)]
    stream = stream_of(spark.createDataFrame(
        data, "row_id INT, mid STRING, is_new STRING, os STRING, amount STRING, ts_ms BIGINT"), parts=6)
    timed = flows.with_watermark(stream, "0 seconds")
    plain = stream.schema
    made = {
        "fix": lambda: bk.bucketed(timed, ["mid"], bk.FixIsNew(plain, ORDER, day), plain, buckets=3),
        "first": lambda: bk.bucketed(timed, ["mid"], bk.FirstSeen(plain, ["mid"], ORDER, day), flows._plus(plain, "is_first"), buckets=3),
        "retract": lambda: bk.bucketed(timed, ["mid"], bk.RetractPrevious(plain, "mid", ORDER, "amount", day), plain, buckets=3),
        "profile": lambda: bk.bucketed(timed, ["mid"], bk.RunningProfile("mid", plain["row_id"], ORDER, ["os"], day),
                                       "mid STRING, ts_ms BIGINT, row_id INT, pv BIGINT, os STRING", buckets=3),
        "idle": lambda: sfacts.idle_join(stream.select("mid", "ts_ms", "os"), stream.select("mid", "ts_ms", "amount"), "mid", day, "0 seconds"),
        "bloom": lambda: bk.bloom_dedup(timed, ["mid", "ts_ms"], ["row_id"], keep_ms=0, buckets=3)}
    assert drain(made[rule]()).count() > 0
    state = spark.read.format("statestore").option("stateVarName", "keys" if rule == "bloom" else "rows").load(str(tmp_path / "checkpoint"))
    held = [str(r) for r in state.collect()]
    assert held and all("far" in r for r in held)


@pytest.mark.parametrize("size", [1, 3, 50])
def test_idle_join_equals_brute_force(spark, tmp_path, drain, size):  # noqa: F811
    """A pair 40 minutes apart is found if a row lies between, and not if none does."""
    rnd, minute, idle = random.Random(size), 60_000, 30 * 60_000
    data = [("kept", T0, 1, "l"), ("kept", T0 + 20 * minute, 0, "between"), ("kept", T0 + 40 * minute, 0, "r"),
            ("lost", T0, 1, "l"), ("lost", T0 + 40 * minute, 0, "r")]
    data += [(f"k{rnd.randrange(4)}", T0 + rnd.randrange(400) * minute, rnd.randrange(2), str(i)) for i in range(80)]
    data.sort(key=lambda r: r[1])
    want, part, last = [], {}, {}
    for r in data:
        part[r[0]] = part.get(r[0], 0) + (r[0] in last and r[1] - last[r[0]] > idle)
        last[r[0]] = r[1]
        want.append((*r, part[r[0]]))
    pairs = sorted((a[0], a[3], a[1], b[3], b[1]) for a in want for b in want if (a[0], a[4]) == (b[0], b[4]) and a[2] == 1 and b[2] == 0)
    path = str(tmp_path / "both")
    for i in range(0, len(data), max(1, len(data) // size)):
        spark.createDataFrame(data[i:i + max(1, len(data) // size)], "k STRING, ts_ms BIGINT, side INT, v STRING").coalesce(1).write.mode(
            "append").parquet(path)
        if size == 50 and i > 20:
            spark.createDataFrame(data[i + 1:], "k STRING, ts_ms BIGINT, side INT, v STRING").coalesce(1).write.mode("append").parquet(path)
            break
    stream = spark.readStream.schema("k STRING, ts_ms BIGINT, side INT, v STRING").option("maxFilesPerTrigger", 1).parquet(path)
    left = stream.where("side = 1").select("k", "ts_ms", F.col("v").alias("l"))
    right = stream.where("side = 0").select("k", "ts_ms", F.col("v").alias("r"))
    got = drain(sfacts.idle_join(left, right, "k", idle, "1 day"))
    assert sorted(map(tuple, got.select("k", "l", "ts_ms", "r", "right_ts").collect())) == pairs
    assert ("kept", "l", T0, "r", T0 + 40 * minute) in pairs and not any(p[0] == "lost" for p in pairs)


def test_processing_windows_hold_what_arrived_in_them(spark, tmp_path):
    """Three runs, each a micro-batch, in windows of their own; the second and third start from the checkpoint."""
    path, out, checkpoint, seconds = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), 2
    arrived = []
    for i in range(4):
        data = [(f"k{j % 3}", j) for j in range(6)] if i < 3 else [("close", 0)]
        spark.createDataFrame(data, "k STRING, n BIGINT").coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema("k STRING, n BIGINT").parquet(path)
        started = int(time.time() * 1000)
        with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER, spark__sql__shuffle__partitions="3"), \
                flows.clock_settings(spark):
            got = flows.drain(flows.processing_windows(stream, ["k"], ["n"], seconds), out, checkpoint)
        arrived.append((started, int(time.time() * 1000)))
        time.sleep(seconds)
    found = sorted((r.window_ms, r.k, r.n) for r in got.collect())
    assert [(k, n) for _, k, n in found] == [("k0", 3), ("k1", 5), ("k2", 7)] * 3
    for i, (window, _, _) in enumerate(found):
        begin, end = arrived[i // 3]
        assert begin - seconds * 1000 < window <= end and window % (seconds * 1000) == 0
    assert len({w for w, _, _ in found}) == 3


def test_config_as_a_stream(spark, tmp_path, drain):  # noqa: F811
    cells = lambda sink: {"source_table": "t", "sink_table": sink, "sink_columns": "id", "sink_family": "info", "sink_row_key": "id"}
    config, records = str(tmp_path / "config"), str(tmp_path / "records")
    kind = "op STRING, before MAP<STRING,STRING>, after MAP<STRING,STRING>, ts_ms BIGINT"
    changes = [[("c", None, cells("one"), 10)], [("u", None, cells("two"), 100)], [("d", cells("two"), None, 200)]]
    for i, part in enumerate(changes):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(config)
        data = [("c", None, {"id": str(100 * i + k), "x": "y"}, {"table": "t"}, 100 * i + k) for k in range(0, 100, 5)]
        spark.createDataFrame(data, "op STRING, before MAP<STRING,STRING>, after MAP<STRING,STRING>, source MAP<STRING,STRING>, ts_ms BIGINT"
                              ).coalesce(1).write.mode("append").parquet(records)
    streams = [spark.readStream.schema(spark.read.parquet(p).schema).option("maxFilesPerTrigger", 1).parquet(p) for p in (records, config)]
    got = drain(flows.as_of_config(streams[0], rt.config_versions(streams[1])))
    assert {(r.ts_ms, r.sink_table) for r in got.collect()} == {
        (ts, "one" if ts < 100 else "two") for ts in range(10, 200, 5)}


def test_bloom_filter_loses_nothing(spark, stream_of, drain):  # noqa: F811
    rnd = random.Random(4)
    data = [(f"o{rnd.randrange(900)}", T0 + rnd.randrange(3) * 1000, i) for i in range(3000)]
    df = spark.createDataFrame(data, "order_id STRING, ts_ms BIGINT, id INT")
    stream = stream_of(df, parts=4, order="id")
    got = drain(bk.bloom_dedup(stream, ["order_id", "ts_ms"], ["id"], buckets=2, n=1500, p=0.02)).cache()
    first = {}
    for o, ts, i in data:
        first.setdefault((o, ts), i)
    assert rows(got.select("order_id", "ts_ms", "id")) == sorted(((o, ts, i) for (o, ts), i in first.items()), key=repr)
    share = got.agg(F.avg("tested")).first()[0]
    assert share < 0.04  # of the rows that are new, only false hits needed the exact test


def test_filter_size():
    assert bk.filter_size(1000, 0.01) == (9592, 7) and bk.filter_size(0, 0.5)[1] >= 1


def test_state_of_a_bucket_is_a_few_rows(spark, stream_of, drain, tmp_path):  # noqa: F811
    """The store hands over row by row, so a bucket must not have a row of state per key."""
    df = spark.range(3000).selectExpr("CONCAT('d', id) AS mid", f"{T0} + id AS ts_ms", "CAST(id AS INT) AS row_id", "'1' AS is_new")
    stream = stream_of(df, parts=3)
    assert drain(bk.bucketed(stream, ["mid"], bk.FixIsNew(stream.schema, ORDER), stream.schema, buckets=4)).count() == 3000
    state = spark.read.format("statestore").option("stateVarName", "rows").load(str(tmp_path / "checkpoint"))
    assert state.count() == 4


def test_packed_rows_come_back(monkeypatch):
    monkeypatch.setattr(bk, "CHUNK", 2)
    schema = StructType.fromDDL("a STRING, n BIGINT, i INT, x DOUBLE")
    given = bk.typed(pd.DataFrame({"a": ["x", None, "\u00e9", "", "y"], "n": [1, None, 2**62, -1, 0], "i": [1, 2, 3, None, 5],
                                   "x": [0.5, 1.5, None, 2.0, -0.0]}, dtype=object).astype({"x": "float64"}), schema)
    chunks = bk.packed(given, schema)
    back = bk.unpacked(chunks, schema)
    as_rows = lambda df: list(df.astype(object).where(df.notna(), None).itertuples(index=False, name=None))
    assert len(chunks) == 3 and as_rows(back) == as_rows(given) and list(back.dtypes[["n", "i"]]) == ["Int64", "Int64"]
    assert len(bk.unpacked([], schema)) == 0


@pytest.mark.parametrize("size", [3, 40])
def test_debounce_gives_the_newest_version_once(spark, stream_of, drain, size):  # noqa: F811
    """Versions of a key within the delay come as one, later ones again."""
    rnd = random.Random(size)
    hour, data, parts = 3_600_000, [], []
    for burst in range(3):
        data += (part := [(f"k{rnd.randrange(size)}", T0 + burst * hour + rnd.randrange(3), rnd.choice(["1", "2", None])) for _ in range(60)])
        parts += [*part, *[("end", T0 + burst * hour + hour // 2, "0")] * 60]  # the timers of a part fire with the next one
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(parts)], "n INT, id STRING, ts_ms BIGINT, split_total_amount STRING")
    stream = stream_of(df, parts=6, order="n").drop("n")
    got = drain(flows.sku_lines(stream, ["ts_ms", "split_total_amount"])).where("id <> 'end'").select("id", "ts_ms", "split_total_amount")
    best = {}
    for k, t, v in data:
        burst = (k, (t - T0) // hour)
        best[burst] = max(best.get(burst, (-1, "")), (t, v or ""))
    assert rows(got) == sorted(((k, t, v or None) for (k, _), (t, v) in best.items()), key=repr)


def test_dedup_latest_in_buckets_equals_brute_force(spark, stream_of, drain):  # noqa: F811
    rnd = random.Random(3)
    data = [(i, rnd.choice(["hot", "a", "b", None]), T0 + rnd.randrange(400)) for i in range(400)]
    stream = stream_of(spark.createDataFrame(data, "n INT, uid STRING, ts_ms BIGINT"), parts=4, order="n")
    got = drain(bk.bucketed(stream, ["uid"], bk.DedupLatest(stream.schema, "uid", ["n"]), stream.schema, buckets=2))
    top, want = {}, []
    for n, k, t in data:
        if t > top.get(k, -1):
            top[k] = t
            want.append((n, k, t))
    assert rows(got) == sorted(want, key=repr)


def test_config_as_a_stream_by_pieces_of_time(spark, stream_of, tmp_path, drain):  # noqa: F811
    """Versions in few pieces, records in all: each finds the newest version before it, however many pieces lie between."""
    rnd, table = random.Random(9), {"table": "t"}
    made = [(t, rnd.choice("cud")) for t in sorted(rnd.sample(range(1000), 60)) if t % 300 < 120]
    cells = lambda t: {"source_table": "t", "sink_table": f"s{t}", "sink_columns": "id", "sink_family": "info", "sink_row_key": "id"}
    kind = "op STRING, before MAP<STRING,STRING>, after MAP<STRING,STRING>, "
    versions = spark.createDataFrame([(op, cells(t) if op == "d" else None, None if op == "d" else cells(t), t) for t, op in made], kind + "ts_ms BIGINT")
    records = spark.createDataFrame([("c", None, {"id": str(t)}, table, t) for t in range(0, 1200, 3)], kind + "source MAP<STRING,STRING>, ts_ms BIGINT")
    streams = []
    for name, df in (("v", versions), ("r", records)):  # the same thirds of time
        for low, high in ((0, 400), (400, 800), (800, 2000)):
            df.where(f"ts_ms >= {low} AND ts_ms < {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        streams.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name)))
    got = drain(flows.as_of_config(streams[1], rt.config_versions(streams[0]), spread=4, piece_ms=50))
    want = []
    for t in range(0, 1200, 3):
        last = max((v for v in made if v[0] <= t), default=(0, "d"))
        if last[1] != "d":
            want.append((t, f"s{last[0]}"))
    assert rows(got.select("ts_ms", "sink_table")) == sorted(want, key=repr)


class _List:
    """A list state that counts how it is written."""

    def __init__(self):
        self.rows, self.puts, self.bytes = [], 0, 0

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows, self.puts = list(rows), self.puts + 1
        self.bytes += sum(len(r[0]) for r in rows)

    def appendList(self, rows):
        self.rows += rows
        self.bytes += sum(len(r[0]) for r in rows)

    def clear(self):
        self.rows = []


class _Handle:
    def __init__(self):
        self.state = _List()

    def getListState(self, name, schema):
        return self.state

    def listTimers(self):
        return iter(())

    def registerTimer(self, ms):
        pass


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _through(rule, batches, grows):
    """What a rule gives out for one bucket, batch by batch, and its state."""
    handle, rule.grows = _Handle(), grows
    rule.init(handle)
    found = []
    for n, batch in enumerate(batches):
        out = [df.astype(object).where(df.notna(), None) for df in rule.handleInputRows((0,), iter([batch]), _Clock(T0 + n * 1000))]
        found.append(sorted(tuple(map(str, r)) for df in out for r in df.itertuples(index=False)))
    return found, handle.state, rule.load()


@pytest.mark.parametrize("kind", ["retract", "first"])
@pytest.mark.parametrize("keep_ms", [None, 20_000, bk.DAY_MS])
def test_state_that_grows_is_added_to(spark, kind, keep_ms):
    """A micro-batch writes the rows it adds, not the whole state again; what comes out and what is held are the same."""
    rnd = random.Random(7)
    names = ["id", "province_id", "split_total_amount", "ts_ms"]
    schema = StructType.fromDDL("id STRING, province_id STRING, split_total_amount STRING, ts_ms BIGINT")

    def batch(n):
        # Mostly new keys, some old ones with older, equal and newer times, null keys and amounts.
        keys = [f"k{n}-{i}" for i in range(100)] + [f"k{rnd.randrange(n + 1)}-{rnd.randrange(100)}" for _ in range(20)] + [None, None]
        return pd.DataFrame([(k, rnd.choice("ab"), rnd.choice(["1", "2.5", None, "x"]), T0 + n * 1000 + rnd.randrange(-2000, 2000))
                             for k in keys], columns=names)

    batches = [batch(n) for n in range(36)]
    make = {"retract": lambda: bk.RetractPrevious(schema, "id", ["ts_ms", "split_total_amount"], "split_total_amount", keep_ms),
            "first": lambda: bk.FirstSeen(schema, ["id"], ["ts_ms"], keep_ms)}[kind]
    want, plain, kept = _through(make(), batches, False)
    got, grown, held = _through(make(), batches, True)
    assert got == want
    order = kept.columns.tolist()
    assert rows_of(held, order) == rows_of(kept, order)
    if keep_ms != 20_000:
        assert plain.puts == 36 and grown.puts <= 4 and grown.bytes < plain.bytes / 5


def rows_of(df, order):
    return sorted(tuple(map(str, r)) for r in df[order].itertuples(index=False))


def test_state_is_compressed(spark):
    schema = StructType.fromDDL("id STRING, ts_ms BIGINT")
    df = pd.DataFrame({"id": [f"line {i // 7}-{i % 7}" for i in range(5000)], "ts_ms": range(T0, T0 + 5000)})
    chunks = bk.packed(df, schema)
    assert sum(len(c[0]) for c in chunks) < 60_000  # 140,000 as plain Arrow
    assert bk.unpacked(chunks, schema).astype({"ts_ms": "int64"}).equals(df)


def test_shuffle_files_of_a_micro_batch_go_with_it(spark, stream_of):  # noqa: F811
    """A drained stream leaves no shuffle files of its micro-batches behind."""
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    files = lambda: {f for d in dirs for f in pathlib.Path(d).rglob("shuffle_*.data")}
    df = spark.createDataFrame(facts(200), FACTS)
    stream = stream_of(df, parts=4)
    before = files()
    drained(spark, bk.bucketed(stream, ["id"], bk.RetractPrevious(stream.schema, "id", ["ts_ms"], "split_total_amount"), stream.schema, buckets=4))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
