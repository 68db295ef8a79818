"""The seven streaming jobs, each a Structured Streaming query over layer topics.

===================  ===========================================  ==============================
job                  flow                                         state / time
===================  ===========================================  ==============================
base_log             ods_base_log → K1 → start | page | display    first flag per device
base_db              ods_base_db → ETL → route(rules) → facts+dims  rule versions, dimension versions
unique_visit         dwd_page_log → K2 → dwm_unique_visit          first row per device and day, 1 day
user_jump            dwd_page_log → K3 → dwm_user_jump_detail      last row per device and bucket
order_wide           order ⋈ line (±5 ms) → 6 lookups → wide       watermark 3 s both sides
payment_wide         payment ⋈ wide (−1800 s … 0)                  watermark 3 s both sides
visitor_stats        page ∪ uv ∪ uj → 10 s windows                 per-leg watermarks, append
===================  ===========================================  ==============================

Every job takes a topic ``root`` (folder of file topics) or Kafka options, a
checkpoint folder, a trigger and a bound on what one micro-batch takes in
(``max_files_per_trigger``; Kafka: the ``maxOffsetsPerTrigger`` option); with ``{"availableNow": True}`` it drains what
is there and stops, which is how the tests compare each job with its batch form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import config as C
from strata import schemas as S
from strata.functions.columns import event_time, parse_time_ms
from strata.operators import cdc, logs, orders, traffic
from strata.operators.joins import enrich
from strata.sources.rules import RuleHistory
from strata.streaming import state
from strata.streaming.dimstore import DimStore
from strata.streaming.stats_table import EpochTable
from strata.streaming.topics import CODEC, read_layer, read_topic, topic_path, write_batch, write_rows, write_topic

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A live job commits a micro-batch (offsets + state checkpoint) every 5 s, like the original.
LIVE_TRIGGER = {"processingTime": C.CHECKPOINT_INTERVAL}


def late_rows(query) -> int:
    """Rows the query's stateful operators dropped as later than the watermark."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) or []:
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total


def _use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


# --- base_log: K1 + R1/R2 as one tagged output --------------------------------

def with_flag(out: DataFrame) -> DataFrame:
    """The record's text after K1: where the flag changed it is rewritten, with every
    other field as it came; any other text stays untouched."""
    fields = F.from_json("value", "map<string,variant>")
    common = F.from_json("value", "common map<string,variant>")["common"]
    flag = F.create_map(F.lit("is_new"), F.col("is_new").cast("variant"))
    common = F.map_concat(F.map_filter(common, lambda k, v: k != "is_new"), flag)
    whole = F.map_concat(F.map_filter(fields, lambda k, v: k != "common"),
                         F.create_map(F.lit("common"), F.to_variant_object(common)))
    same = F.get_json_object("value", "$.common.is_new").eqNullSafe(F.col("is_new"))
    return out.select(F.when(same, F.col("value")).otherwise(F.to_json(whole)).alias("value"))


def fan_out_log(log: DataFrame) -> DataFrame:
    """R1 + R2 in one pass over record texts: (topic, value) rows. A record goes
    whole to the start topic (a non-empty ``start`` object) or the page topic; each
    display of a page log goes to the display topic with all its fields and the
    page's ``page_id``."""
    start = F.coalesce(F.get_json_object("value", "$.start"), F.lit("{}")) != "{}"
    whole = F.struct(F.when(start, F.lit(C.TOPIC_START)).otherwise(F.lit(C.TOPIC_PAGE)).alias("topic"), F.col("value"))
    page_id = F.get_json_object("value", "$.page.page_id")
    added = F.when(page_id.isNotNull(), F.create_map(F.lit("page_id"), page_id.cast("variant"))) \
        .otherwise(F.from_json(F.lit("{}"), "map<string,variant>"))
    shown = F.from_json("value", "displays array<map<string,variant>>")["displays"]
    disp = F.transform(F.filter(shown, lambda d: d.isNotNull()),
                       lambda d: F.struct(F.lit(C.TOPIC_DISPLAY).alias("topic"),
                                          F.to_json(F.map_concat(F.map_filter(d, lambda k, v: k != "page_id"), added))
                                          .alias("value")))
    rows = F.when(start | shown.isNull(), F.array(whole)).otherwise(F.concat(F.array(whole), disp))
    return log.select(F.explode(rows).alias("o")).select("o.topic", "o.value")


def base_log(spark: SparkSession, root: str, checkpoint: str, mode: str = "same_day",
             trigger: dict | None = None, fmt: str = "parquet", kafka_options: dict | None = None,
             max_files_per_trigger: int | None = None):
    """K1 + R1 + R2. Text that is no JSON or has no event time goes to the
    ``C.TOPIC_BAD_LOG`` topic (P1); records without a device pass the repair by, as in the batch form.

    A micro-batch, with the first flags of its devices, is staged once as a table; the repair
    is a join on it, which Spark splits where a device is hot."""
    _use_rocksdb(spark)
    raw = read_topic(spark, root, "ods_base_log", fmt, max_files_per_trigger, kafka_options)
    good = F.try_parse_json("value").isNotNull() & F.col("ts").isNotNull()
    rows = state.first_flags(state.keyed(raw).filter(F.col("value").isNotNull())
                             .withColumn("is_new", F.when(good, F.col("is_new"))))
    staged = topic_path(root, "_base_log_stage")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(staged)
        now = batch.sparkSession.read.schema(batch.schema).parquet(staged)
        ok = F.try_parse_json("row.value").isNotNull() & F.col("row.mark.ts").isNotNull()
        bad = now.filter(F.col("row").isNotNull() & ~ok).select(F.lit(C.TOPIC_BAD_LOG).alias("topic"), "row.value")
        fixed = state.repair_flags(now.filter(F.col("row").isNull() | ok), mode)
        write_batch(fan_out_log(with_flag(fixed)).unionByName(bad), root, "fanout", batch_id, fmt, kafka_options)

    return (rows.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


# --- unique_visit / user_jump ---------------------------------------------------

def unique_visit(spark: SparkSession, root: str, checkpoint: str, trigger: dict | None = None,
                 source: Callable[[], DataFrame] | None = None, expiry_days: int = C.VISIT_STATE_TTL_MS // C.MS_PER_DAY,
                 fmt: str = "parquet", kafka_options: dict | None = None, max_files_per_trigger: int | None = None):
    """K2. The state of a device's day expires in event time, a day after that day."""
    _use_rocksdb(spark)
    page = source() if source else read_layer(spark, root, C.TOPIC_PAGE, "fanout", fmt, kafka_options, max_files_per_trigger)
    out = state.unique_visits(state.keyed(page), expiry_days)
    return write_rows(out, root, C.TOPIC_UNIQUE_VISIT, checkpoint, fmt, trigger, kafka_options)


def user_jump(spark: SparkSession, root: str, checkpoint: str, within_ms: int = C.BOUNCE_WITHIN_MS,
              trigger: dict | None = None, source: Callable[[], DataFrame] | None = None,
              fmt: str = "parquet", kafka_options: dict | None = None, max_files_per_trigger: int | None = None):
    """K3 on a monotonous event-time watermark, as the original pattern job."""
    _use_rocksdb(spark)
    page = source() if source else read_layer(spark, root, C.TOPIC_PAGE, "fanout", fmt, kafka_options, max_files_per_trigger)
    out = state.bounces(state.keyed(page), within_ms)
    return write_topic(out, root, C.TOPIC_USER_JUMP, checkpoint, fmt, trigger, kafka_options)


# --- visitor_stats ----------------------------------------------------------------

def visitor_stats(spark: SparkSession, root: str, checkpoint: str, out_path: str | None,
                  window: str = C.STATS_WINDOW, within_ms: int = C.BOUNCE_WITHIN_MS,
                  delay: str = C.WATERMARK_DELAY, trigger: dict | None = None,
                  sources: dict[str, Callable[[], DataFrame]] | None = None, jdbc: dict | None = None,
                  fmt: str = "parquet", kafka_options: dict | None = None, table_path: str | None = None,
                  max_files_per_trigger: int | None = None):
    """U1 + A1 in append mode. Each leg gets its own watermark before the union
    (Q4): the bounce leg arrives ``within`` late by construction, so its delay
    is ``within + delay``; the query watermark is the minimum of the legs.

    S7: rows go to a parquet file sink (exactly once); or with ``table_path`` to an
    ``EpochTable``, which takes each micro-batch once and replaces rows by key; or
    with ``jdbc`` options to an OLAP table. A JDBC append can't be taken back, so there a micro-batch
    that failed in the middle of its write is appended again: let that table replace rows by
    ``STATS_KEY``, as the original's does."""
    src = sources or {}

    def leg(name: str, topic: str, extra_ms: int = 0) -> DataFrame:
        raw = src[name]() if name in src else read_layer(spark, root, topic, "fanout", fmt, kafka_options, max_files_per_trigger) \
            if topic == C.TOPIC_PAGE else read_topic(spark, root, topic, fmt, max_files_per_trigger, kafka_options)
        log = raw.select(F.from_json("value", S.LOG).alias("r")).select("r.*")
        log = log.withColumn("_et", event_time("ts"))
        d = f"{int(_seconds(delay) * 1000) + extra_ms} milliseconds"
        return log.withWatermark("_et", d)

    page = leg("page", C.TOPIC_PAGE)
    uv = leg("uv", C.TOPIC_UNIQUE_VISIT)
    uj = leg("uj", C.TOPIC_USER_JUMP, within_ms)
    stats = traffic.union_stats(traffic.stats_pv_sv(page, keep=("_et",)), traffic.stats_uv(uv, keep=("_et",)),
                                traffic.stats_uj(uj, keep=("_et",)))
    g = (stats.groupBy(F.window("_et", window).alias("_w"), *traffic.STATS_DIMS)
         .agg(*[F.sum(m).cast("bigint").alias(m) for m in traffic.MEASURES], F.min("ts").alias("ts")))
    out = g.select(F.date_format("_w.start", C.TIME_FORMAT).alias("stt"),
                   F.date_format("_w.end", C.TIME_FORMAT).alias("edt"),
                   *traffic.STATS_DIMS, *traffic.MEASURES, "ts")
    w = (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    if table_path is not None:
        table = EpochTable(spark, table_path)
        return w.foreachBatch(lambda b, i: table.upsert(b, i) and None).start()
    if jdbc is not None:
        return w.foreachBatch(lambda b, _i: b.write.format("jdbc").options(**jdbc).mode("append").save()).start()
    return w.format("parquet").start(out_path)


def _seconds(text: str) -> float:
    n, unit = text.split()
    return float(n) * {"second": 1, "seconds": 1, "millisecond": 0.001, "milliseconds": 0.001,
                       "minute": 60, "minutes": 60}[unit]


# --- base_db: routing with rules refreshed per micro-batch ---------------------------

def _unreadable():
    return F.col("value").isNotNull() & F.try_parse_json("value").isNull()


def read_records(batch: DataFrame) -> tuple[DataFrame, Observation]:
    """The change records of (value, pos) rows that are JSON, each parsed once, and the number ``n`` of texts that are none,
    known once the records have been written. It is counted on the way: no filter on a field gets below
    that, where it would parse the text once more."""
    seen = Observation()
    once = batch.select(F.from_json("value", S.CDC_TEXT).alias("r"), "pos", F.col("value").isNotNull().alias("given"),
                        _unreadable().alias("bad")).observe(seen, F.count_if("bad").alias("n"))
    return once.filter("given AND NOT bad").select("r.*", "pos"), seen


def base_db(spark: SparkSession, root: str, checkpoint: str, out_path: str,
            rules: Callable[[], DataFrame], trigger: dict | None = None, fmt: str = "parquet",
            kafka_options: dict | None = None, dims_path: str | None = None, rules_path: str | None = None,
            max_files_per_trigger: int | None = None):
    """R3 + R4 + S3 + S4: in each micro-batch the rules are re-read (added,
    changed and removed rules take effect), records are routed, and the batch
    is written once, tagged, under its batch id (a retried batch overwrites its
    own folder, so the sink is idempotent). The version of the rules that a batch was
    routed by is kept in ``rules_path``, so a retry routes as before. Its facts then go to their detail
    topics (``facts`` folder, or Kafka topics by name), its dimension changes are folded into
    the versioned tables in ``dims_path``. Text that is no JSON goes
    to the ``C.TOPIC_BAD_DB`` topic (P1; ``bad`` folder). The paths lie beside ``out_path``
    unless given; a checkpoint owns its tables."""
    raw = read_topic(spark, root, "ods_base_db", fmt, max_files_per_trigger, kafka_options)
    history = RuleHistory(spark, rules_path or f"{out_path}-rules")
    store = DimStore(spark, dims_path or dims_beside(out_path))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        recs, seen = read_records(batch)
        routed = cdc.route(cdc.parse_cdc(cdc.etl_filter(recs)), history.for_batch(batch_id, rules))
        rows = routed.select("seq", "pos", "table", "type", "route", "sink_type", "sink_table", "sink_pk", "key", "reason",
                             F.to_json("data").alias("data")).withColumn("batch_id", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC) \
            .partitionBy("batch_id", "route").parquet(out_path)
        unread = batch.filter(_unreadable() if seen.get.get("n", 1) else F.lit(False))  # no second pass where all can be read
        write_batch(unread.withColumn("topic", F.lit(C.TOPIC_BAD_DB)), root, "bad", batch_id, fmt, kafka_options)
        mine = batch.sparkSession.read.schema(rows.schema).parquet(out_path).filter(F.col("batch_id") == batch_id)
        write_batch(cdc.fact_text(mine.filter(F.col("route") == cdc.ROUTE_FACT)), root, "facts", batch_id, fmt, kafka_options)
        store.fold(cdc.dim_changes(cdc.parse_cdc(mine.filter(F.col("route") == cdc.ROUTE_DIM)), "pos"), batch_id)

    return (raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def dims_beside(out_path: str) -> str:
    return f"{out_path}-dims"


def routed_table(spark: SparkSession, out_path: str) -> DataFrame:
    """The routed change log written by ``base_db`` (batch read; ``data`` back to a map)."""
    return cdc.parse_cdc(spark.read.parquet(out_path))


def dimension_tables(spark: SparkSession, out_path: str, layout: dict[str, list[str]],
                     apply_deletes: bool = False) -> dict[str, DataFrame]:
    """S4 read side: the dimension tables that ``base_db`` with this ``out_path`` keeps, in their newest version
    (so a per-batch lookup sees the newest upserts). ``layout`` maps a dimension table to its
    columns; rows are keyed by ``id``. No change is read or aggregated again."""
    store = DimStore(spark, dims_beside(out_path))
    return {table: store.table(table, cols, apply_deletes=apply_deletes) for table, cols in layout.items()}


# --- order_wide / payment_wide -----------------------------------------------------

def _typed(raw: DataFrame, ddl: str) -> DataFrame:
    """JSON text → typed row. Fields are read as text first and cast, so a
    quoted number (as a routed change record carries it) types as well as a bare one;
    a text that doesn't fit its type becomes null."""
    names = [f.split()[0] for f in logs._split_top(ddl)]
    types = [" ".join(f.split()[1:]) for f in logs._split_top(ddl)]
    text = ", ".join(f"{n} STRING" for n in names)
    # a generator: no filter on a field gets below it, where it would parse the text once more
    r = raw.select(F.inline(F.array(F.from_json("value", text))))
    return r.select(*[F.col(n).try_cast(t).alias(n) for n, t in zip(names, types)])


def order_lines_stream(info: DataFrame, detail: DataFrame, delay: str = C.WATERMARK_DELAY,
                       lower_ms: int = C.ORDER_LINE_LOWER_MS, upper_ms: int = C.ORDER_LINE_UPPER_MS) -> DataFrame:
    """J1 on two streams: watermark each side, join on id and the event-time range
    (Spark bounds the join state by watermark + range)."""
    o = orders.with_create_ts(info).withColumn("_oet", event_time("create_ts")).withWatermark("_oet", delay)
    d = orders.with_create_ts(detail).withColumn("_det", event_time("create_ts")).withWatermark("_det", delay)
    return orders.join_order_lines(o, d, lower_ms, upper_ms, time_cols=("_oet", "_det"))


def order_wide(spark: SparkSession, root: str, checkpoint: str, out_path: str,
               dims: Callable[[], dict[str, DataFrame]], now_ms: int | Callable[[], int], trigger: dict | None = None,
               sources: dict[str, Callable[[], DataFrame]] | None = None, fmt: str = "parquet",
               kafka_options: dict | None = None, max_files_per_trigger: int | None = None):
    """J1 (stream ⋈ stream) then J3 per micro-batch against freshly read dimensions. The
    wide rows are a table (``out_path``) and the ``dwm_order_wide`` topic (``wide`` folder in files)."""
    src = sources or {}
    info = _typed(src["info"]() if "info" in src else read_layer(spark, root, "dwd_order_info", "facts", fmt, kafka_options, max_files_per_trigger),
                  S.ORDER_INFO)
    det = _typed(src["detail"]() if "detail" in src
                 else read_layer(spark, root, "dwd_order_detail", "facts", fmt, kafka_options, max_files_per_trigger), S.ORDER_DETAIL)
    wide = order_lines_stream(info, det)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        now = now_ms() if callable(now_ms) else now_ms  # a live job passes the clock, read per micro-batch
        out = enrich(batch, orders.order_dim_specs(dims(), now)).withColumn("batch_id", F.lit(batch_id))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC) \
            .partitionBy("batch_id").parquet(out_path)
        # a batch without a match writes no file, so the schema is given
        written = batch.sparkSession.read.schema(out.schema).parquet(out_path) \
            .filter(F.col("batch_id") == batch_id).drop("batch_id")
        write_batch(logs.to_json_text(written).withColumn("topic", F.lit(C.TOPIC_ORDER_WIDE)), root, "wide", batch_id,
                    fmt, kafka_options)

    return (wide.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def payment_wide(spark: SparkSession, root: str, checkpoint: str, out_path: str, delay: str = C.WATERMARK_DELAY,
                 trigger: dict | None = None, sources: dict[str, Callable[[], DataFrame]] | None = None,
                 fmt: str = "parquet", kafka_options: dict | None = None, max_files_per_trigger: int | None = None):
    """J2 + P11 on two streams (payment event time = callback time)."""
    src = sources or {}
    pay = _typed(src["payment"]() if "payment" in src
                 else read_layer(spark, root, "dwd_payment_info", "facts", fmt, kafka_options, max_files_per_trigger), S.PAYMENT_INFO)
    wide = _typed(src["wide"]() if "wide" in src else read_layer(spark, root, C.TOPIC_ORDER_WIDE, "wide", fmt, kafka_options, max_files_per_trigger),
                  S.ORDER_WIDE + ", create_ts BIGINT")
    pay = pay.withColumn("_pet", event_time(parse_time_ms("callback_time"))).withWatermark("_pet", delay)
    wide = wide.withColumn("_wet", event_time(parse_time_ms("create_time"))).withWatermark("_wet", delay)
    out = orders.payment_wide(pay, wide, time_cols=("_pet", "_wet"))
    return (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).format("parquet").start(out_path))
