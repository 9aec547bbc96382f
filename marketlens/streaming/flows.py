"""Streaming jobs: the batch jobs on streams, with watermarks, state and batch-wise sinks."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marketlens.functions.clock import ts_to_date, window_start
from marketlens.functions.scalars import is_empty, keep_keys
from marketlens.operators import filters as fl, sinks as sk, windows as win
from marketlens.operators.logs import tagged_log_lines
from marketlens.operators.routing import ROUTE_FIELDS, route_dim_by_config
from marketlens.plans.windows import SKU_SUMS, searched_words, sku_chain
from marketlens.session import ROCKSDB_PROVIDER, settings
from marketlens.sources.readers import split_dirty
from marketlens.sources.schemas import LOG
from marketlens.streaming import buckets as bk, processors as pr


@contextmanager
def state_settings(spark: SparkSession):
    """Settings the stateful queries need: RocksDB state. The session's shuffle partitions stay, frozen in the checkpoint.

    A micro-batch writes down its changes only, not the whole state; the rows of state are not counted, which would read each before it is
    written; and the two sides of a join share one store of a partition instead of having four. For the disk: state is compressed as zstd,
    the last two micro-batches of it are kept, and a micro-batch's shuffle files go with its end.
    """
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER,
                  spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
                  spark__sql__streaming__stateStore__rocksdb__trackTotalNumberOfRows="false",
                  spark__sql__streaming__join__stateFormatVersion="3",
                  spark__sql__streaming__stateStore__compression__codec="zstd",
                  spark__sql__streaming__stateStore__rocksdb__compression="zstd",
                  spark__sql__streaming__stateStore__maintenanceInterval="10s",
                  spark__sql__streaming__minBatchesToRetain="2",
                  spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        yield spark


@contextmanager
def clock_settings(spark: SparkSession):
    """Settings to run a query with timers of the clock to the end of its input: such a query asks for empty micro-batches for ever."""
    with settings(spark, spark__sql__streaming__noDataMicroBatches__enabled="false"):
        yield spark


def with_watermark(df: DataFrame, delay: str, ts: str = "ts_ms") -> DataFrame:
    """Event time ``rt`` with a watermark."""
    return df.withColumn("rt", F.timestamp_millis(ts)).withWatermark("rt", delay)


def _plus(schema: StructType, *names: str) -> StructType:
    out = StructType(list(schema.fields))
    for n in names:
        out = out.add(n, LongType())
    return out


def first_of_day(df: DataFrame, key: str, order: list[str], only: bool, delay: str = "0 seconds",
                 zone: str = "UTC", initial: DataFrame | None = None) -> DataFrame:
    """Rows with ``is_first`` (or just the first ones); event time goes along as ``rt``.

    A first row is held until a day after its time, when the watermark has passed the end of its day. ``initial``: key, visit_date and
    ts_ms of days that a table before the stream has seen.
    """
    timed = with_watermark(df, delay).withColumn("visit_date", ts_to_date("ts_ms", zone))
    rule = bk.FirstSeen(timed.schema, [key, "visit_date"], order, pr.DAY_MS)
    rows = bk.bucketed(timed, [key], rule, _plus(timed.schema, "is_first"), "rt", initial=initial).drop("visit_date")
    return rows.where("is_first = 1") if only else rows


def visitors(logs: DataFrame, order: list[str], seconds: int = 10, zone: str = "UTC") -> DataFrame:
    """Visitor measures per version, channel, area and newness."""
    rows = first_of_day(logs, "mid", order, only=False, zone=zone)
    zero = F.lit(0).cast("bigint")
    return win.with_window_text(win.tumble_stream(rows, seconds, ["vc", "ch", "ar", "is_new"], [
        F.sum("is_first").alias("uv_ct"), F.sum(is_empty("last_page_id").cast("bigint")).alias("sv_ct"),
        F.count("*").alias("pv_ct"), F.sum(F.coalesce("during_time", zero)).alias("dur_sum")]), seconds, zone)


def home_detail(logs: DataFrame, order: list[str], seconds: int = 10, zone: str = "UTC") -> DataFrame:
    """Visitors of the day of the home page and of product pages."""
    pages = fl.filter_home_detail(logs).withColumn("visit", F.concat_ws("|", "mid", "page_id"))
    rows = first_of_day(pages, "visit", order, only=True, zone=zone)
    home = (F.col("page_id") == "home").cast("bigint")
    return win.with_window_text(win.tumble_stream(rows, seconds, [], [
        F.sum(home).alias("home_uv_ct"), F.sum(1 - home).alias("good_detail_uv_ct")]), seconds, zone)


def logins(logs: DataFrame, order: list[str], seconds: int = 10, back_days: int = 8,
           keep_ms: int = 400 * pr.DAY_MS, zone: str = "UTC") -> DataFrame:
    """Users logging in and users coming back, if within ``keep_ms``."""
    timed = with_watermark(fl.filter_login_page(logs), "0 seconds")
    rows = pr.keyed_rule(timed, "uid", pr.LoginBack(order, back_days, keep_ms, zone), _plus(timed.schema, "uu_ct", "back_ct"), "rt")
    return win.with_window_text(win.tumble_stream(rows, seconds, [], [
        F.sum("back_ct").alias("back_ct"), F.sum("uu_ct").alias("uu_ct")]), seconds, zone)


def cart_users(carts: DataFrame, order: list[str], seconds: int = 2, zone: str = "UTC") -> DataFrame:
    """Users with a first cart row of the day."""
    rows = first_of_day(carts, "user_id", order, only=True, zone=zone)
    return win.with_window_text(
        win.tumble_stream(rows, seconds, [], [F.count("*").alias("cart_add_uu_ct")]), seconds, zone)


def search_keywords(logs: DataFrame, seconds: int = 10, delay: str = "3 seconds",
                    dictionary: dict[str, float] | None = None) -> DataFrame:
    """Searched words; needs no state of ours."""
    words = searched_words(logs, dictionary)
    counts = win.tumble_stream(words, seconds, ["keyword"], [F.count("*").alias("keyword_count")], delay=delay)
    return win.with_window_text(counts, seconds)


def province_orders(facts: DataFrame, provinces: DataFrame, order: list[str], seconds: int = 4,
                    keep_ms: int = 400 * pr.DAY_MS, delay: str = "0 seconds") -> DataFrame:
    """Order amount and distinct orders per province, with versions taken back that are replaced within ``keep_ms``.

    Three stateful steps: the newest version per order line, the first row per window, province and order, the sums. So an order is
    a row of state of its own and no state row holds a set. A version that is replaced more than ``delay`` later stays in its closed
    window. The province table is read per micro-batch.
    """
    timed = with_watermark(facts, delay)
    rows = bk.bucketed(timed, ["id"], bk.RetractPrevious(timed.schema, "id", order, "split_total_amount", keep_ms),
                       timed.schema, "rt").withColumn("window_ms", window_start("ts_ms", seconds))
    keys = ["window_ms", "province_id", "order_id"]
    # Rows of a window, province and order tell apart by their time only, as late ones are dropped.
    order = order[:order.index("ts_ms") + 1] if "ts_ms" in order else order
    rows = rows.select(*dict.fromkeys([*keys, *order, "ts_ms", "split_total_amount", "rt"]))
    rows = bk.bucketed(rows, keys, bk.FirstSeen(rows.schema, keys, order, seconds * 1000), _plus(rows.schema, "is_first"), "rt")
    sums = win.tumble_stream(rows, seconds, ["province_id"], [
        F.sum("is_first").alias("order_count"), *win.decimal_sums({"split_total_amount": "order_amount"})])
    names = provinces.select(F.col("id").alias("province_id"), F.col("name").alias("province_name"))
    named = sums.join(names, "province_id", "left").withColumn(
        "province_name", F.coalesce("province_name", F.lit("")))
    return win.with_window_text(named, seconds)


def processing_windows(df: DataFrame, keys: list[str], sums: list[str], seconds: int = 10) -> DataFrame:
    """Sums per key and window of the time the rows are worked on: keys, sums, ``window_ms``. Each window comes once, after its end."""
    kept = [df.schema[k] for k in keys]
    out = StructType([*kept, *[StructField(n, LongType()) for n in (*sums, "window_ms")]])
    rows = df.select(*keys, *[F.col(s).cast("bigint").alias(s) for s in sums])
    return bk.bucketed(rows, keys, bk.ProcessingWindows(kept, sums, seconds), out, time_mode="ProcessingTime")


def sku_lines(facts: DataFrame, order: list[str]) -> DataFrame:
    """The last version of each order line, held back for five seconds of event time."""
    timed = with_watermark(facts, "0 seconds")
    return bk.bucketed(timed, ["id"], bk.DebounceLast(timed.schema, "id", order), timed.schema, time_mode="EventTime")


def sku_sink(lines: DataFrame, path: str, checkpoint: str, seconds: int = 10):
    """Start the product job: each micro-batch adds its sums to the window of the time it runs at.

    Several micro-batches may fall into one window; :func:`read_sku_sums` adds them up.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        now = batch.withColumn("now_ms", F.unix_millis(F.current_timestamp()))
        sk.write_batch(win.tumble(now, seconds, ["sku_id"], win.decimal_sums(SKU_SUMS), ts="now_ms"), path, batch_id)

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_sku_sums(spark: SparkSession, path: str, dims: dict[str, DataFrame], seconds: int = 10) -> DataFrame:
    """The sums written by :func:`sku_sink` with the dimensions of each product."""
    parts = spark.read.option("basePath", path).parquet(path).drop("batch")
    sums = win.union_sums([parts], ["window_ms", "sku_id"], list(SKU_SUMS.values()))
    return win.with_window_text(sku_chain(sums, dims), seconds)


def first_cart_of_day(carts: DataFrame, delay: str = "1 day", zone: str = "UTC") -> DataFrame:
    """The first cart row to arrive per user and day, by built-in de-duplication only."""
    return with_watermark(carts, delay).withColumn("day", ts_to_date("ts_ms", zone)).dropDuplicatesWithinWatermark(
        ["user_id", "day"])


def dim_sink(changes: DataFrame, routes, path: str, checkpoint: str):
    """Start the dimension job: each micro-batch is routed by the config as it then is, and merged on read.

    ``routes`` is called per micro-batch, so a changed config takes effect with the next one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        sk.dim_upsert(route_dim_by_config(batch, routes()), path, batch_id)

    return changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def as_of_config(records: DataFrame, versions: DataFrame, spread: int = 16, piece_ms: int = 8 * pr.DAY_MS) -> DataFrame:
    """Change records routed by the config in force at their time, while the config itself is a stream.

    ``versions``: rows of :func:`config_versions`. A table is dealt into ``spread`` shares by pieces of time, so that one with most of the
    records is not one state. A version goes to the share of its piece, and to all shares if it is the newest that its piece has so far: a record
    of a later piece can need no other. The payload is cut down as in batches.
    """
    piece = F.floor(F.col("ts_ms") / piece_ms).cast("bigint")
    share = F.pmod(F.xxhash64("piece"), F.lit(spread)).cast("int")
    rows = records.select(
        F.col("source")["table"].alias("source_table"), F.col("op").alias("record_op"), "ts_ms", F.lit(0).alias("is_config"),
        F.to_json(F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))).alias("payload"),
        piece.alias("piece")).withColumn("share", share)
    config = versions.withColumn("piece", piece)
    values = [n for n in config.columns if n not in ("source_table", "piece", "ts_ms")]
    rule = bk.NewestOfPiece(config.schema, ["source_table", "piece"], values)
    config = bk.bucketed(config, ["source_table", "piece"], rule, _plus(config.schema, "everywhere"))
    shares = F.when(F.col("everywhere") == 1, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(share))
    config = config.select("*", F.lit(1).alias("is_config"), F.explode(shares).alias("share")).drop("everywhere")
    both = rows.unionByName(config, allowMissingColumns=True).drop("piece")
    held = StructType([both.schema[n] for n in ("source_table", *ROUTE_FIELDS[1:], "op", "ts_ms")])
    out = StructType([*[both.schema[n] for n in ("source_table", "record_op", "ts_ms", "payload")],
                      *[both.schema[n] for n in ROUTE_FIELDS[1:]]])
    routed = bk.bucketed(both, ["source_table", "share"], bk.AsOfConfig(held, "source_table", ["record_op", "payload"]), out)
    payload = F.from_json("payload", "map<string,string>")
    return routed.where("payload IS NOT NULL").select(
        "source_table", "sink_table", "sink_family", F.element_at(payload, F.col("sink_row_key")).alias("row_key"),
        F.col("record_op").alias("op"), "ts_ms", keep_keys(payload, "sink_columns").alias("data"))


def log_sink(logs: DataFrame, path: str, checkpoint: str):
    """Start the log splitter: one pass per micro-batch writes all five kinds, each under its name."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (tagged_log_lines(batch).write.mode("overwrite").partitionBy("stream")
         .parquet(f"{path}/batch={batch_id}"))

    return logs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def log_job(lines: DataFrame, order: list[str], keep_ms: int | None = None, delay: str = "0 seconds", zone: str = "UTC") -> DataFrame:
    """The client-log job: texts in ``value`` to lines of six kinds, ``stream`` and ``value``.

    Texts that are no record go on as ``dirty``. The mark of new visitors is corrected against the state of the device, with the record
    going along as its text; then each record is split into error, start, display, action and page lines.
    """
    clean, dirty = split_dirty(lines, LOG)
    record = [f.name for f in StructType.fromDDL(LOG).fields]
    marks = clean.select(*[c for c in clean.columns if c not in record], F.col("common.mid").alias("mid"),
                         F.col("common.is_new").alias("is_new"), F.col("ts").alias("ts_ms"), F.to_json(F.struct(*record)).alias("value"))
    if keep_ms is not None:
        marks = with_watermark(marks, delay)
    kept = StructType([f for f in marks.schema.fields if f.name != "rt"])
    rows = bk.bucketed(marks, ["mid"], bk.FixIsNew(kept, order, keep_ms, zone), kept)
    fixed = rows.select("is_new", F.from_json("value", LOG).alias("r")).select("is_new", "r.*")
    fixed = fixed.withColumn("common", F.col("common").withField("is_new", F.col("is_new"))).drop("is_new")
    return tagged_log_lines(fixed).unionByName(dirty.select(F.lit("dirty").alias("stream"), "value"))


def topic_sink(lines: DataFrame, path: str, checkpoint: str):
    """Start a sink for lines of several kinds: one pass per micro-batch, each line under its kind, a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("stream", "value").write.mode("overwrite").partitionBy("stream").text(f"{path}/batch={batch_id}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def upsert_sink(rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]):
    """Start a keyed sink: the last row per key of each micro-batch, merged on read."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sk.upsert(batch, path, batch_id, keys, order)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there now and return what it wrote."""
    spark = stream.sparkSession
    (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(path)
