"""Queries that run the streaming forms over the whole tables; each must equal its batch form.

The rows of a table are laid down as files, read as a stream and drained. A row far in the future goes
along where event-time windows are open, so that the last of them close.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from marketlens.catalog import joins as jn
from marketlens.catalog.aggregates import HOME, HOME_SQL, KEYWORD_SQL, LATEST, RUNNING_ROWS, RUNNING_SQL, VERSION
from marketlens.catalog.filters import CLEAN, USERS, config_changes
from marketlens.catalog.jobs import CART_UU_SQL, LOG_FIXED, LOG_TOPICS, LOGIN_SQL, PROVINCE_SQL, SKU_SUMS, VISITOR_SQL
from marketlens.catalog.registry import query, window, window_text
from marketlens.catalog.sinks import CELLS, CELLS_SQL, ROUTED, routes
from marketlens.catalog.state import AS_OF_SQL, CONFIG_RECORDS, FIXED, VISITS, config_records, routed_as_of
from marketlens.functions.scalars import first_token
from marketlens.operators import keyed, routing as rt, sinks as sk, windows as win
from marketlens.operators.joins import stream_interval_join
from marketlens.plans.profile import PROFILE_SETS
from marketlens.plans.windows import SKU_SUMS as SKU_COLUMNS
from marketlens.session import scratch, settings
from marketlens.sources import readers as rd, standins as st
from marketlens.sources.schemas import LOG
from marketlens.streaming import buckets as bk, facts as sfacts, flows, processors as pr

FAR_MS = 4102444800000
FAR_DATE = "2100-01-01"
LOG_ORDER = ["ts_ms", "row_id"]


def lay_down(parts: list[DataFrame], path: str) -> int:
    """Write each part as files of its own, one after the other, and return how many files a part has.

    A stream that reads so many files at a time sees one part per micro-batch. Parts are written by as many tasks as the session
    shuffles with; where one has fewer files (few rows), empty ones fill up.
    """
    spark = parts[0].sparkSession
    files, there = int(spark.conf.get("spark.sql.shuffle.partitions")), 0
    count = lambda: len(spark.read.schema(parts[0].schema).parquet(path).inputFiles())
    for part in parts:
        with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            part.repartition(files).write.mode("append").parquet(path, compression="zstd")
        there += files
        for _ in range(there - count()):
            part.where(F.lit(False)).coalesce(1).write.mode("append").parquet(path)
    return files


def ticks(spark: SparkSession, schema: StructType, **values: object) -> DataFrame:
    """Rows of a schema with some fields set and the others null, one for each file of a part."""
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.range(0, files, 1, files).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])


def as_stream(df: DataFrame, by: str | None = "ts_ms", ends: DataFrame | None = None, **last: object) -> DataFrame:
    """The rows as a file stream of three micro-batches in the order of a column, or of one without such a column.

    ``last`` gives the fields of a closing row far in the future, a micro-batch of its own; ``ends`` are several such rows.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, "stream")
    parts = [df]
    if by in df.columns:
        low, high = df.select(F.percentile_approx(by, [0.33, 0.66]).alias("p")).first()["p"] or (None, None)
        if low is not None:
            parts = [df.where((F.col(by) <= low) | F.col(by).isNull()), df.where((F.col(by) > low) & (F.col(by) <= high)),
                     df.where(F.col(by) > high)]
    if ends is not None:
        parts.append(ends)
    if last:
        parts.append(ticks(spark, df.schema, **({"ts_ms": FAR_MS} | last)))
    files = lay_down(parts, path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Result of a stream run over all there is."""
    with flows.state_settings(spark):
        return flows.drain(stream, scratch(spark, "out"), scratch(spark, "checkpoint"))


def run_sink(spark: SparkSession, writer) -> None:
    """Run a batch-wise sink over all there is."""
    with flows.state_settings(spark):
        writer.trigger(availableNow=True).start().awaitTermination()


def _logs(spark, sf):
    return st.record(spark, sf, "page_log").select(
        "row_id", "mid", "uid", "ch", "vc", "ar", "is_new", "page_id", "last_page_id", "item_type", "item",
        "during_time", "ts_ms")


@query("stream_fix_is_new", "SELECT * FROM fixed", ["page_log"], FIXED)
def stream_fix_is_new(spark, sf):
    logs = as_stream(st.record(spark, sf, "page_log").select("row_id", "mid", "ts_ms", "is_new"))
    return drained(spark, bk.bucketed(logs, ["mid"], bk.FixIsNew(logs.schema, LOG_ORDER), logs.schema))


@query("stream_uv_daily_flag", VISITOR_SQL, ["page_log"], VISITS)
def stream_uv_daily_flag(spark, sf):
    logs = as_stream(_logs(spark, sf), mid="none", row_id=-1)
    return drained(spark, flows.visitors(logs, LOG_ORDER)).where(F.col("cur_date") != FAR_DATE)


@query("stream_uv_home_detail", HOME_SQL, ["page_log"], HOME)
def stream_uv_home_detail(spark, sf):
    logs = as_stream(_logs(spark, sf), mid="none", row_id=-1, page_id="home")
    return drained(spark, flows.home_detail(logs, LOG_ORDER)).where(F.col("cur_date") != FAR_DATE)


@query("stream_uu_login_back", LOGIN_SQL, ["page_log"])
def stream_uu_login_back(spark, sf):
    logs = as_stream(_logs(spark, sf), uid="none", row_id=-1, last_page_id="login")
    return drained(spark, flows.logins(logs, LOG_ORDER)).where(F.col("cur_date") != FAR_DATE)


@query("stream_uu_cart", CART_UU_SQL, ["cart_info"])
def stream_uu_cart(spark, sf):
    carts = as_stream(st.record(spark, sf, "cart_info").select("id", "user_id", "ts_ms"), id="none", user_id="none")
    return drained(spark, flows.cart_users(carts, ["ts_ms", "id"])).where(F.col("cur_date") != FAR_DATE)


@query("stream_agg_keyword_count", KEYWORD_SQL, ["page_log"])
def stream_agg_keyword_count(spark, sf):
    logs = as_stream(_logs(spark, sf), last_page_id="search", item_type="keyword", item="none", row_id=-1)
    return drained(spark, flows.search_keywords(logs)).where(F.col("cur_date") != FAR_DATE)


@query("stream_retract_previous", PROVINCE_SQL, ["trade_order_detail", "dim_base_province"])
def stream_retract_previous(spark, sf):
    facts = st.record(spark, sf, "trade_order_detail").select("id", "order_id", "province_id", *VERSION)
    facts = as_stream(facts, id="none", split_total_amount="0")
    # Versions of a line may lie in different thirds.
    rows = drained(spark, flows.province_orders(facts, st.record(spark, sf, "dim_base_province"), VERSION, delay="1 day"))
    return rows.where(F.col("cur_date") != FAR_DATE).withColumn(
        "order_amount", F.col("order_amount").cast("decimal(38,4)").cast("string"))


@query("stream_debounce_last", f"""
    SELECT id, sku_id, ts_ms, split_total_amount FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LATEST}) AS rn FROM trade_order_detail) WHERE rn = 1""",
       ["trade_order_detail"])
def stream_debounce_last(spark, sf):
    facts = as_stream(st.record(spark, sf, "trade_order_detail").select("id", *VERSION), None, id="none")  # one burst of versions
    return drained(spark, flows.sku_lines(facts, VERSION)).where("id <> 'none'").select(
        "id", "sku_id", "ts_ms", "split_total_amount")


@query("stream_job_dws_sku", f"""
    SELECT f.*, {jn.SKU_CHAIN} FROM (SELECT sku_id, {SKU_SUMS} FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY {LATEST}) AS rn FROM trade_order_detail)
      WHERE rn = 1 GROUP BY 1) f {jn.SKU_JOINS}""", ["trade_order_detail", *jn.SKU_DIMS.values()])
def stream_job_dws_sku(spark, sf):
    # The windows are those of the time the stream runs at, so the sums over all of them are compared.
    facts = as_stream(st.record(spark, sf, "trade_order_detail").select("id", *VERSION), None, id="none")  # one burst of versions
    path, names = scratch(spark, "sku"), list(SKU_COLUMNS.values())
    run_sink(spark, flows.sku_sink(flows.sku_lines(facts, VERSION), path, scratch(spark, "checkpoint")))
    rows = flows.read_sku_sums(spark, path, jn.sku_dims(spark, sf)).where("sku_id IS NOT NULL")
    rest = [c for c in rows.columns if c not in ("stt", "edt", "cur_date", *names)]
    return rows.groupBy(*rest).agg(*[F.sum(n).cast("decimal(38,4)").cast("string").alias(n) for n in names])


@query("stream_dedup_latest_ts", """
    SELECT uid, name, ts_ms FROM (
      SELECT *, max(ts_ms) OVER (PARTITION BY uid ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                AS seen FROM users)
    WHERE seen IS NULL OR ts_ms > seen""", ["user_info"], USERS)
def stream_dedup_latest_ts(spark, sf):
    users = as_stream(st.record(spark, sf, "user_info").select(F.col("id").alias("uid"), "name", "ts_ms", "arrival"), "arrival")
    return drained(spark, bk.bucketed(users, ["uid"], bk.DedupLatest(users.schema, "uid", ["arrival"]), users.schema)).drop("arrival")


@query("stream_dedup_full_row", "SELECT DISTINCT id, sku_id, ts_ms FROM trade_order_detail", ["trade_order_detail"])
def stream_dedup_full_row(spark, sf):
    rows = as_stream(st.record(spark, sf, "trade_order_detail").select("id", "sku_id", "ts_ms"))
    timed = flows.with_watermark(rows, "5 seconds")
    return drained(spark, timed.dropDuplicatesWithinWatermark(["id", "sku_id", "ts_ms"]).drop("rt"))


@query("stream_running_profile", RUNNING_SQL, ["page_log"], RUNNING_ROWS)
def stream_running_profile(spark, sf):
    logs = st.record(spark, sf, "page_log").where("coalesce(uid, '-1') <> ''").select(
        F.coalesce("uid", F.lit("-1")).alias("uid"), "ts_ms", "row_id", first_token("os").alias("os"), "ch", "md", "ba",
        F.when(F.col("page_id").isNotNull() & (F.col("item_type") == "keyword"), F.col("item")).alias("search_item"))
    schema = "uid STRING, ts_ms BIGINT, row_id BIGINT, pv BIGINT, " + ", ".join(f"{s} STRING" for s in PROFILE_SETS)
    rule = bk.RunningProfile("uid", logs.schema["row_id"], LOG_ORDER, PROFILE_SETS)
    return drained(spark, bk.bucketed(as_stream(logs), ["uid"], rule, schema))


def _order_streams(spark, sf):
    orders = st.record(spark, sf, "order_info").select(F.col("id").alias("oid"), "user_id", F.col("ts_ms").alias("o_ms"))
    details = st.record(spark, sf, "order_detail").select("id", "order_id", "sku_id", "ts_ms")
    return (as_stream(orders).withColumn("o_rt", F.timestamp_millis("o_ms")),
            as_stream(details).withColumn("rt", F.timestamp_millis("ts_ms")))


def _order_join_sql(ms):
    return f"""SELECT o.id AS oid, o.user_id, d.id, d.sku_id, d.ts_ms FROM order_info o JOIN order_detail d
        ON o.id = d.order_id AND d.ts_ms BETWEEN o.ts_ms - {ms} AND o.ts_ms + {ms}"""


@query("stream_ijoin_order", _order_join_sql(300_000), ["order_info", "order_detail"])
def stream_ijoin_order(spark, sf):
    orders, details = _order_streams(spark, sf)
    rows = stream_interval_join(orders, details, "oid", "order_id", "o_rt", "rt", "5 MINUTES", "5 MINUTES")
    return drained(spark, rows.select("oid", "user_id", "id", "sku_id", "ts_ms"))


@query("state_retention", _order_join_sql(1_805_000), ["order_info", "order_detail"])
def state_retention(spark, sf):
    orders, details = _order_streams(spark, sf)
    rows = stream_interval_join(orders, details, "oid", "order_id", "o_rt", "rt", "1805 SECONDS", "1805 SECONDS",
                                "0 seconds")
    return drained(spark, rows.select("oid", "user_id", "id", "sku_id", "ts_ms"))


SPREAD = "CAST(split_part({id}, '-', 2) AS BIGINT) * 1200000"  # lines of an order come twenty minutes after each other
NOT_EVERY = "CAST({sku} AS BIGINT) % 4 <> 0"  # and some are missing, so that some orders are silent for too long


@query("stream_join_order_detail_idle", f"""
    SELECT a.k AS order_id, a.user_id, a.ts_ms, b.id, b.sku_id, b.ts_ms AS right_ts FROM parts a JOIN parts b
    ON a.k = b.k AND a.part = b.part AND a.side = 1 AND b.side = 0""", ["order_info", "order_detail"], f"""
both_ AS (
  SELECT id AS k, 1 AS side, user_id, NULL AS id, NULL AS sku_id, ts_ms FROM order_info
  UNION ALL SELECT order_id, 0, NULL, id, sku_id, ts_ms + {SPREAD.format(id='id')} FROM order_detail WHERE {NOT_EVERY.format(sku='sku_id')}),
gaps AS (SELECT *, ts_ms - lag(ts_ms) OVER (PARTITION BY k ORDER BY ts_ms) > 1805000 AS silent FROM both_),
parts AS (SELECT *, sum(CASE WHEN silent THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY ts_ms) AS part FROM gaps)""")
def stream_join_order_detail_idle(spark, sf):
    orders = st.record(spark, sf, "order_info").select(F.col("id").alias("order_id"), "user_id", "ts_ms")
    details = st.record(spark, sf, "order_detail").where(NOT_EVERY.format(sku="sku_id")).select(
        "order_id", "id", "sku_id", (F.col("ts_ms") + F.expr(SPREAD.format(id="id"))).alias("ts_ms"))
    return drained(spark, sfacts.idle_join(as_stream(orders), as_stream(details), "order_id", delay="5 days"))  # the thirds of the two tables end at different times


@query("stream_win_processing", "SELECT mid, count(*) AS n FROM page_log GROUP BY mid", ["page_log"])
def stream_win_processing(spark, sf):
    # The windows are those of the clock, so the sums over all of them are compared. A second run, once the last window is
    # over, takes its state from the checkpoint; its rows stay in a window of their own.
    logs = _logs(spark, sf).select("mid", F.lit(1).alias("n"))
    path, out, checkpoint, seconds = scratch(spark, "stream"), scratch(spark, "out"), scratch(spark, "checkpoint"), 10
    files = lay_down([logs.where("xxhash64(mid) % 2 = 0"), logs.where("xxhash64(mid) % 2 <> 0"), logs.where("mid IS NULL")], path)
    stream = spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", files).parquet(path)
    with flows.state_settings(spark), flows.clock_settings(spark):
        rows = flows.drain(flows.processing_windows(stream, ["mid"], ["n"], seconds), out, checkpoint)
        time.sleep(seconds - time.time() % seconds)
        lay_down([ticks(spark, logs.schema, mid="none", n=0)], path)
        rows = flows.drain(flows.processing_windows(stream, ["mid"], ["n"], seconds), out, checkpoint)
    return rows.groupBy("mid").agg(F.sum("n").alias("n")).where("mid IS NULL OR mid <> 'none'")


def _closed(spark, changes, *tables):
    """A change log as a stream that ends with a row of each table far in the future, so that all ranges close."""
    none = F.lit("none")
    ends = spark.createDataFrame([(t,) for t in tables], "t STRING").select(
        F.lit("r").alias("op"), F.lit(None).cast("map<string,string>").alias("before"),
        F.create_map(*[x for c in ("id", "order_id", "order_detail_id") for x in (F.lit(c), none)], F.lit("payment_status"),
                     F.lit("1602"), F.lit("order_status"), F.lit("1001")).alias("after"),
        F.create_map(F.lit("table"), F.col("t")).alias("source"), F.lit(FAR_MS).alias("ts_ms"))
    return as_stream(changes.select(*ends.columns), "ts_ms", ends)


@query("stream_join_order_detail_4way", "SELECT * FROM fact", jn.DETAIL_RECORDS, jn.DETAIL_FACT)
def stream_join_order_detail_4way(spark, sf):
    changes = _closed(spark, st.change_log(spark, sf, *jn.DETAIL_RECORDS), *jn.DETAIL_RECORDS)
    return drained(spark, sfacts.order_detail_fact(changes)).where("id <> 'none'")


def _order_details(spark, sf):
    facts = st.record(spark, sf, "trade_order_detail")
    return as_stream(facts, "ts_ms", None, id="none", order_id="none")


@query("stream_join_cancel", jn.CANCEL_SQL, ["trade_order_detail", "order_info"])
def stream_join_cancel(spark, sf):
    changes = _closed(spark, st.change_log(spark, sf, "order_info"), "order_info")
    return drained(spark, sfacts.cancel_fact(_order_details(spark, sf), changes, "400 DAYS")).where("id <> 'none'")


@query("stream_join_payment", jn.PAYMENT_SQL, ["trade_order_detail", "payment_info"])
def stream_join_payment(spark, sf):
    changes = _closed(spark, st.change_log(spark, sf, "payment_info"), "payment_info")
    return drained(spark, sfacts.payment_fact(_order_details(spark, sf), changes, "400 DAYS")).where("order_detail_id <> 'none'")


@query("stream_sink_upsert", """
    SELECT id, name, gender, ts_ms FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, arrival DESC) AS rn FROM user_info)
    WHERE rn = 1""", ["user_info"])
def stream_sink_upsert(spark, sf):
    path, order = scratch(spark, "keyed"), ["ts_ms", "arrival"]
    users = as_stream(st.record(spark, sf, "user_info").select("id", "name", "gender", *order))
    run_sink(spark, flows.upsert_sink(users, path, scratch(spark, "checkpoint"), ["id"], order))
    return sk.read_upserted(spark, path, ["id"], order).select("id", "name", "gender", "ts_ms")


@query("stream_sink_dim_upsert", CELLS_SQL, ["user_info", "user_info_sup_msg", "cart_info"], CELLS)
def stream_sink_dim_upsert(spark, sf):
    path = scratch(spark, "dims")
    changes = as_stream(st.change_log(spark, sf, *ROUTED))
    run_sink(spark, flows.dim_sink(changes, lambda: routes(spark), path, scratch(spark, "checkpoint")))
    return sk.read_dims(spark, path).select("sink_table", "row_key", F.explode("cells").alias("col", "val"))


@query("stream_split_log_streams", f"""
    SELECT 'err' AS stream, count(*) AS n FROM page_log WHERE {CLEAN} AND event_type = 'error'
    UNION ALL SELECT 'start', count(*) FROM page_log WHERE {CLEAN} AND page_id IS NULL
    UNION ALL SELECT 'display', sum(k % 4)::BIGINT FROM page_log WHERE {CLEAN} AND page_id IS NOT NULL
    UNION ALL SELECT 'action', sum(k % 3)::BIGINT FROM page_log WHERE {CLEAN} AND page_id IS NOT NULL
    UNION ALL SELECT 'page', count(*) FROM page_log WHERE {CLEAN} AND page_id IS NOT NULL""", ["page_log"])
def stream_split_log_streams(spark, sf):
    path = scratch(spark, "log")
    clean, _ = rd.split_dirty(as_stream(st.log_topic(spark, sf)), LOG)
    run_sink(spark, flows.log_sink(clean, path, scratch(spark, "checkpoint")))
    return spark.read.option("basePath", path).parquet(path).groupBy("stream").agg(F.count("*").alias("n"))


@query("wm_none", "SELECT row_id, mid, ts_ms FROM page_log", ["page_log"])
def wm_none(spark, sf):
    return drained(spark, as_stream(_logs(spark, sf).select("row_id", "mid", "ts_ms")))


CUT_MS, TICK_MS = 1705276800000, 1706832000000
LATE_SECONDS = [4, 6, 8, 12]  # by how much the later half of the rows trails the clock, in turns


def _windowed(name, seconds):
    """Counts per two-second window; of the rows that are late, those stay whose window the watermark has not passed."""
    late = f"CASE k % 4 {' '.join(f'WHEN {i} THEN {n}' for i, n in enumerate(LATE_SECONDS))} END"

    @query(name, f"""SELECT {window_text('w', 2)}, n FROM (
        SELECT {window('t', 2)} AS w, count(*) AS n FROM (
          SELECT CASE WHEN ts_ms < {CUT_MS} THEN ts_ms ELSE {TICK_MS} - 1000 * {late} END AS t FROM page_log)
        WHERE t < {TICK_MS} - 100000 OR {window('t', 2)} + 2000 > {TICK_MS} - {seconds * 1000} GROUP BY 1)""", ["page_log"])
    def run(spark, sf):
        # The clock stands at the tick when the late rows come; late rows meet the watermark one micro-batch after it moved.
        logs, path = st.record(spark, sf, "page_log").select("mid", "ts_ms", "k"), scratch(spark, "stream")
        early = logs.where(F.col("ts_ms") < CUT_MS).select("mid", "ts_ms")
        behind = logs.where(F.col("ts_ms") >= CUT_MS).select("mid", (F.lit(TICK_MS) - 1000 * F.expr(late)).alias("ts_ms"))
        tick = lambda ms: ticks(spark, early.schema, mid="none", ts_ms=ms)
        files = lay_down([early.unionByName(tick(TICK_MS)), tick(TICK_MS), behind, tick(FAR_MS)], path)
        stream = spark.readStream.schema(early.schema).option("maxFilesPerTrigger", files).parquet(path)
        rows = win.tumble_stream(stream, 2, [], [F.count("*").alias("n")], delay=f"{seconds} seconds")
        return drained(spark, win.with_window_text(rows, 2)).where(F.col("cur_date") < "2024-02-02")


_windowed("wm_monotonous", 0)
_windowed("wm_bounded_5s", 5)
_windowed("wm_bounded_10s", 10)
_windowed("wm_sql_3s", 3)


@query("late_data", f"""SELECT {window_text('w', 10)}, n FROM (
    SELECT {window('ts_ms', 10)} AS w, count(*) AS n FROM page_log WHERE ts_ms >= {CUT_MS} GROUP BY 1)""", ["page_log"])
def late_data(spark, sf):
    # The later half arrives first, then one newer row, then the earlier half: by then it is behind the
    # watermark (which late rows meet one micro-batch after it moved) and is dropped.
    logs, path = _logs(spark, sf).select("mid", "ts_ms"), scratch(spark, "stream")
    tick = lambda ms: ticks(spark, logs.schema, mid="none", ts_ms=ms)
    files = lay_down([logs.where(F.col("ts_ms") >= CUT_MS), tick(TICK_MS), logs.where(F.col("ts_ms") < CUT_MS), tick(FAR_MS)], path)
    stream = spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", files).parquet(path)
    rows = win.tumble_stream(stream, 10, [], [F.count("*").alias("n")])
    return drained(spark, win.with_window_text(rows, 10)).where(F.col("cur_date") < "2024-02-01")


@query("stream_dyn_config", AS_OF_SQL, ["route_config", "config_record"], CONFIG_RECORDS)
def stream_dyn_config(spark, sf):
    # Both the config and the records come in three micro-batches; a record must not come before the version it needs.
    records, versions = config_records(spark, sf), rt.config_versions(config_changes(spark, sf))
    cut = records.select(F.percentile_approx("ts_ms", [0.33, 0.66]).alias("p")).first()["p"] or [0, 0]
    streams = []
    for rows in (versions, records):
        edges = [F.col("ts_ms") <= cut[0], (F.col("ts_ms") > cut[0]) & (F.col("ts_ms") <= cut[1]), F.col("ts_ms") > cut[1]]
        path = scratch(spark, "stream")
        files = lay_down([rows.where(e) for e in edges], path)
        streams.append(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path))
    return routed_as_of(drained(spark, flows.as_of_config(streams[1], streams[0])))


def _halves(logs):
    """The rows up to the middle of their times, which a table holds, and those after it, which come as a stream."""
    middle = logs.select(F.percentile_approx("ts_ms", 0.5).alias("p")).first()["p"] or 0
    return logs.where(F.col("ts_ms") <= middle), logs.where(F.col("ts_ms") > middle)


@query("stream_fix_is_new_from_table", "SELECT * FROM fixed", ["page_log"], FIXED)
def stream_fix_is_new_from_table(spark, sf):
    before, after = _halves(st.record(spark, sf, "page_log").select("row_id", "mid", "ts_ms", "is_new"))
    stream = as_stream(after)
    rows = bk.bucketed(stream, ["mid"], bk.FixIsNew(stream.schema, LOG_ORDER), stream.schema,
                       initial=keyed.first_dates(before, LOG_ORDER))
    return keyed.fix_is_new(before, LOG_ORDER).unionByName(drained(spark, rows))


@query("stream_uv_daily_flag_from_table", "SELECT row_id, mid, ts_ms, uv_ct FROM visits", ["page_log"], VISITS)
def stream_uv_daily_flag_from_table(spark, sf):
    before, after = _halves(_logs(spark, sf).select("row_id", "mid", "ts_ms"))
    seen = keyed.first_of_day(before, ["mid"], LOG_ORDER).select("mid", "visit_date", "ts_ms")
    rows = flows.first_of_day(as_stream(after), "mid", LOG_ORDER, only=False, initial=seen)
    flags = drained(spark, rows.select("row_id", "mid", "ts_ms", F.col("is_first").alias("uv_ct")))
    firsts = keyed.first_of_day(before, ["mid"], LOG_ORDER).select("row_id")
    return keyed.mark_rows(before, firsts, "row_id", "uv_ct").select(*flags.columns).unionByName(flags)


@query("stream_dedup_bloom", """
    SELECT order_id, ts_ms, id, sku_id FROM (
      SELECT *, row_number() OVER (PARTITION BY order_id, ts_ms ORDER BY id, sku_id) AS rn FROM trade_order_detail)
    WHERE rn = 1""", ["trade_order_detail"])
def stream_dedup_bloom(spark, sf):
    rows = as_stream(st.record(spark, sf, "trade_order_detail").select("order_id", "ts_ms", "id", "sku_id"))
    timed = flows.with_watermark(rows, "5 seconds")
    return drained(spark, bk.bloom_dedup(timed, ["order_id", "ts_ms"], ["id", "sku_id"], buckets=16, keep_ms=0)).drop("tested")


@query("stream_join_refund", jn.REFUND_SQL, ["order_refund_info", "order_info"])
def stream_join_refund(spark, sf):
    tables = ["order_refund_info", "order_info"]
    changes = _closed(spark, st.change_log(spark, sf, *tables), *tables)
    return drained(spark, sfacts.refund_fact(changes, "400 DAYS")).where("id <> 'none'")


@query("stream_join_refund_pay_3way", jn.REFUND_PAY_SQL, jn.REFUND_PAY_RECORDS)
def stream_join_refund_pay_3way(spark, sf):
    changes = _closed(spark, st.change_log(spark, sf, *jn.REFUND_PAY_RECORDS), *jn.REFUND_PAY_RECORDS)
    return drained(spark, sfacts.refund_paid_fact(changes, "400 DAYS")).where("id <> 'none'")


@query("stream_job_dwd_log", LOG_TOPICS, ["page_log"], LOG_FIXED)
def stream_job_dwd_log(spark, sf):
    # The topic in three micro-batches in the order of time; texts that are no record come with the first.
    topic = st.log_topic(spark, sf)
    ts = F.coalesce(F.get_json_object("value", "$.ts").try_cast("bigint"), F.lit(0))
    lines = as_stream(topic.withColumn("at", ts), "at").drop("at")
    path = scratch(spark, "log")
    run_sink(spark, flows.topic_sink(flows.log_job(lines, LOG_ORDER), path, scratch(spark, "checkpoint")))
    mark = F.get_json_object("value", "$.common.is_new").try_cast("bigint")
    rows = spark.read.option("basePath", path).text(path)
    return rows.groupBy("stream").agg(F.count("*").alias("n"), F.sum(mark).alias("new_ct"))
