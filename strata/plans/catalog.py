"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Outputs are flat, every column aliased, so they compare one-to-one with the
DuckDB oracles in ``strata.plans.oracle``. All read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config as C
from strata import schemas as S
from strata.config import use_utc
from strata.functions.columns import day_of_ms, format_ms, gender_label, has_page, parse_time_ms
from strata.operators import cdc, logs, orders, traffic
from strata.operators.joins import AsOfSpec, DimSpec, asof_lookup, enrich
from strata.plans import batch
from strata.sources import fixtures as fx
from strata.sources.rules import RuleHistory, read_rules, rules_camel

Query = Callable[[SparkSession, str], DataFrame]
LONG_WITHIN_MS = 3_600_000


# --- flatteners -------------------------------------------------------------

def flat_log(df: DataFrame, kind: bool = True) -> DataFrame:
    cols = [F.col("event_id"), F.col("common.mid").alias("mid"), F.col("ts"), day_of_ms("ts").alias("day"),
            F.col("common.is_new").alias("is_new"), F.col("common.vc").alias("vc"),
            F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar")]
    if kind:
        cols.append(F.when(logs.is_start_log(), F.lit("start")).otherwise(F.lit("page")).alias("log_kind"))
    return df.select(*cols)


def flat_page(df: DataFrame) -> DataFrame:
    return df.select(F.col("event_id"), F.col("common.mid").alias("mid"), F.col("ts"),
                     day_of_ms("ts").alias("day"), F.col("common.is_new").alias("is_new"),
                     F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"),
                     F.col("common.ar").alias("ar"), F.col("page.page_id").alias("page_id"),
                     F.col("page.last_page_id").alias("last_page_id"),
                     F.col("page.during_time").alias("during_time"))


def flat_start(df: DataFrame) -> DataFrame:
    return df.select(F.col("event_id"), F.col("common.mid").alias("mid"), F.col("ts"),
                     F.col("common.is_new").alias("is_new"), F.col("common.vc").alias("vc"),
                     F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
                     F.col("start.entry").alias("entry"), F.col("start.loading_time").alias("loading_time"))


def flat_route(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*more, "seq", F.col("table").alias("source_table"), F.col("type").alias("op_type"),
                     "sink_type", "sink_table", F.array_join(F.map_keys("data"), ",").alias("kept_keys"))


# --- traffic ----------------------------------------------------------------

def q_visitor_flag_repair(spark, d, mode="same_day"):
    return flat_log(logs.repair_new_flag(fx.ods_log(spark, d), mode=mode))


def q_log_parse(spark, d):
    good, _bad = logs.parse_log(fx.ods_log_json(spark, d))
    return flat_log(good)


def q_log_start(spark, d):
    return flat_start(batch.detail_logs(spark, d)["start"])


def q_log_page(spark, d):
    return flat_page(batch.detail_logs(spark, d)["page"])


def q_log_display(spark, d):
    return batch.detail_logs(spark, d)["display"].select("page_id", "item", "item_type", "order", "pos_id")


def q_unique_visit(spark, d):
    return flat_page(traffic.unique_visit(batch.page_log(spark, d).select(*batch.PAGE_STATS_COLUMNS)))


def q_user_jump(spark, d, within_ms=C.BOUNCE_WITHIN_MS):
    return flat_page(traffic.user_jump(batch.page_log(spark, d).select(*batch.PAGE_STATS_COLUMNS), within_ms))


def q_stats_leg(leg: str):
    def q(spark, d):
        page = batch.page_log(spark, d).select(*batch.PAGE_STATS_COLUMNS)
        if leg == "pv":
            return traffic.stats_pv(page)
        if leg == "uv":
            return traffic.stats_uv(traffic.unique_visit(page))
        if leg == "sv":
            return traffic.stats_sv(page)
        return traffic.stats_uj(traffic.user_jump(page))
    return q


def q_stats_union(spark, d):
    page = batch.page_log(spark, d, materialized=True, columns=batch.PAGE_STATS_COLUMNS)
    return traffic.union_stats(traffic.stats_pv(page), traffic.stats_uv(traffic.unique_visit(page)),
                               traffic.stats_sv(page), traffic.stats_uj(traffic.user_jump(page)))


def q_visitor_stats_10s(spark, d):
    return batch.visitor_stats(spark, d)


def q_visitor_stats_1d(spark, d):
    return batch.visitor_stats(spark, d, window="1 day", within_ms=LONG_WITHIN_MS)


# --- change records ---------------------------------------------------------

def q_etl_filter_cdc(spark, d):
    recs = cdc.parse_cdc(cdc.etl_filter(fx.cdc_records(spark, d)))
    return recs.select("seq", F.col("table").alias("source_table"),
                       F.col("type").alias("raw_type"), cdc.normalize_op("type").alias("op_type"))


def q_route(kind: str):
    def q(spark, d):
        return flat_route(cdc.split_routes(batch.routed_cdc(spark, d))[kind])
    return q


def q_route_values(spark, d):
    r = batch.routed_cdc(spark, d).filter(F.col("route") != cdc.ROUTE_REJECT)
    return r.select("seq", "sink_table", F.explode("data").alias("column", "value"))


def q_fact_payload(spark, d):
    facts = cdc.split_routes(batch.routed_cdc(spark, d))[cdc.ROUTE_FACT]
    p = cdc.parse_cdc(facts.select("seq", "sink_table", F.to_json("data").alias("data")))
    return p.select("seq", F.col("sink_table").alias("topic"),
                    F.col("data")["id"].cast("bigint").alias("id"),
                    F.col("data")["user_id"].cast("bigint").alias("user_id"),
                    F.col("data")["total_amount"].cast(S.MONEY).alias("total_amount"),
                    F.col("data")["order_status"].alias("order_status"))


def q_dim_current(spark, d, apply_deletes=False):
    return batch.dimension_current(spark, d, apply_deletes).select("dim_table", "pk", "column", "value")


def q_dim_user_current(spark, d):
    cur = batch.dimension_current(spark, d)
    return cdc.dim_view(cur, "dim_user_info", ["id", "name", "seg"]).select("pk", "id", "name", "seg")


def q_dim_schemas(spark, d):
    dims = cdc.split_routes(batch.routed_cdc(spark, d))[cdc.ROUTE_DIM]
    return cdc.dim_layout(cdc.dim_changes(dims), fx.routing_rules(spark))


def q_rules_scan(spark, d):
    """The rules read from files, each with the records that it routes."""
    from strata.streaming import replay
    path = f"{replay.scratch(spark, 'rules')}/table_process"
    fx.routing_rules(spark).write.parquet(path)
    rules = cdc.reduce_rules(read_rules(spark, path))
    recs = cdc.etl_filter(fx.cdc_records(spark, d)).select(F.col("table").alias("source_table"), cdc.normalize_op("type").alias("operate_type")) \
        .groupBy("source_table", "operate_type").agg(F.count("*").alias("records"))
    return rules_camel(rules.join(recs, ["source_table", "operate_type"], "left").select(
        "source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk", F.coalesce("records", F.lit(0)).alias("records")))


def q_page_named(spark, d):
    """Events that name a page; some of the log's page names are taken away or emptied."""
    k = F.col("event_id") % 13
    page_id = F.when(k == 1, F.lit("")).when(k != 0, F.col("page.page_id")).alias("page_id")
    return fx.ods_log(spark, d).select("event_id", page_id).filter(has_page("page_id"))


def q_record_account(spark, d):
    """P1 + P5: what became of every record of a topic with broken records in it."""
    return cdc.account(fx.cdc_topic(spark, d), fx.routing_rules(spark)).groupBy("outcome", "table", "type").agg(F.count("*").alias("records"))


def q_dim_lookup_composite(spark, d):
    """S6 + F12: a key of two columns, several rows of a key, nulls that match (``partner``) and that don't (``strict``)."""
    tier = F.when(F.col("c_custkey") % 5 == 4, F.lit(None).cast("bigint")).otherwise(F.col("c_custkey") % 5)
    facts = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey", tier.alias("tier"))
    keys, dim = (["c_nationkey", "tier"], ["s_nationkey", "tier"]), fx.dim_partner(spark, d)
    specs = [DimSpec("partner", dim, keys[0], {"partner_id": F.col("s_suppkey"), "partner_name": F.col("s_name")}, keys[1],
                     first_by=("s_suppkey",), null_safe=True),
             DimSpec("strict", dim, keys[0], {"strict_id": F.col("s_suppkey")}, keys[1], first_by=("s_suppkey",))]
    return enrich(facts, specs)


def q_order_dim_asof(spark, d):
    """J3 replayed: every order with its user as known when it was placed."""
    spec = AsOfSpec("user", fx.user_changes(spark, d), "user_id", "create_ts", ("level", "gender"),
                    {"user_level": F.col("level"), "user_gender": gender_label("gender"), "user_known": F.lit(True)})
    return asof_lookup(fx.order_info(spark, d).select("id", "user_id", "create_ts"), spec)


# --- orders -----------------------------------------------------------------

def q_order_detail_interval(spark, d):
    return orders.join_order_lines(fx.order_info(spark, d), fx.order_detail(spark, d))


def q_order_dim(which: tuple[str, ...]):
    def q(spark, d):
        return batch.order_wide(spark, d, which)
    return q


def q_order_wide(spark, d):
    return batch.order_wide(spark, d)


def q_payment_interval(spark, d):
    p = fx.payment_info(spark, d)
    w = orders.join_order_lines(fx.order_info(spark, d), fx.order_detail(spark, d))
    return orders.payment_wide(p, w).select("payment_id", "order_id", "detail_id", "callback_time",
                                             "order_create_time")


def q_payment_wide(spark, d):
    return batch.payment_wide(spark, d)


def q_order_wide_merge(spark, d):
    det = fx.order_detail(spark, d)
    info = fx.order_info(spark, d)
    wide_t = dict(S.ORDER_WIDE_FIELDS)
    line_src = {"detail_id": "id", "order_id": "order_id", "sku_id": "sku_id", "order_price": "order_price",
                "sku_num": "sku_num", "sku_name": "sku_name", "split_total_amount": "split_total_amount",
                "split_activity_amount": "split_activity_amount", "split_coupon_amount": "split_coupon_amount"}
    head_src = {"order_id": "id", "order_status": "order_status", "create_time": "create_time",
                "create_date": "create_date", "coupon_reduce_amount": "coupon_reduce_amount",
                "activity_reduce_amount": "activity_reduce_amount",
                "original_total_amount": "original_total_amount", "feight_fee": "feight_fee",
                "total_amount": "total_amount", "user_id": "user_id"}

    def shape(df, src):
        return df.select(*[(F.col(src[n]) if n in src else F.lit(None)).cast(t).alias(n) for n, t in wide_t.items()])
    return orders.merge_wide(shape(det, line_src), shape(info, head_src), ["order_id"])


QUERIES: dict[str, Query] = {
    "visitor_flag_repair": q_visitor_flag_repair,
    "visitor_flag_repair_other_day": lambda s, d: q_visitor_flag_repair(s, d, "other_day"),
    "log_parse": q_log_parse,
    "log_start": q_log_start,
    "log_page": q_log_page,
    "log_display": q_log_display,
    "unique_visit": q_unique_visit,
    "user_jump": q_user_jump,
    "user_jump_long": lambda s, d: q_user_jump(s, d, LONG_WITHIN_MS),
    "stats_pv": q_stats_leg("pv"),
    "stats_uv": q_stats_leg("uv"),
    "stats_sv": q_stats_leg("sv"),
    "stats_uj": q_stats_leg("uj"),
    "stats_union": q_stats_union,
    "visitor_stats_10s": q_visitor_stats_10s,
    "visitor_stats_1d": q_visitor_stats_1d,
    "etl_filter_cdc": q_etl_filter_cdc,
    "route_facts": q_route(cdc.ROUTE_FACT),
    "route_dims": q_route(cdc.ROUTE_DIM),
    "route_rejects": q_route(cdc.ROUTE_REJECT),
    "route_values": q_route_values,
    "fact_payload": q_fact_payload,
    "dim_current": q_dim_current,
    "dim_current_deletes": lambda s, d: q_dim_current(s, d, True),
    "dim_user_current": q_dim_user_current,
    "dim_schemas": q_dim_schemas,
    "rules_scan": q_rules_scan,
    "page_named": q_page_named,
    "record_account": q_record_account,
    "dim_lookup_composite": q_dim_lookup_composite,
    "order_dim_asof": q_order_dim_asof,
    "order_detail_interval": q_order_detail_interval,
    "order_dim_user": q_order_dim(("user",)),
    "order_dim_region": q_order_dim(("province",)),
    "order_dim_sku": q_order_dim(("sku", "spu", "category3", "trademark")),
    "order_wide": q_order_wide,
    "payment_interval": q_payment_interval,
    "payment_wide": q_payment_wide,
    "order_wide_merge": q_order_wide_merge,
}


def queries() -> dict[str, Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = getattr(fn, "__name__", "query")
        return run
    return {k: wrap(v) for k, v in QUERIES.items()}


__all__ = ["queries", "QUERIES", "format_ms"]


# --- streaming twins: the same rows through the streaming jobs -----------------

def _parsed_topic(spark, path_df):
    return path_df.select(F.from_json("value", S.LOG).alias("r")).select("r.*")


def q_stream_visitor_flag_repair(spark, d):
    """K1 through ``jobs.base_log`` (state per device), read back from the start and page topics."""
    from strata.streaming import jobs, replay, topics as T
    root = replay.scratch(spark, "base_log")
    replay.replay_logs(spark, {"ods_base_log": replay.spread(fx.ods_log(spark, d))},
                       lambda r: jobs.base_log(spark, r, f"{r}/_ck"), root)
    rows = T.read_fanout(spark, root, C.TOPIC_START, stream=False).unionByName(
        T.read_fanout(spark, root, C.TOPIC_PAGE, stream=False))
    return flat_log(_parsed_topic(spark, rows))


def q_stream_unique_visit(spark, d):
    from strata.streaming import jobs, replay, topics as T
    root = replay.scratch(spark, "unique_visit")
    src = lambda: T.read_topic(spark, root, "page_in")
    replay.replay_logs(spark, {"page_in": batch.page_log(spark, d)},
                       lambda r: jobs.unique_visit(spark, r, f"{r}/_ck", source=src), root)
    return flat_page(_parsed_topic(spark, T.read_topic_batch(spark, root, C.TOPIC_UNIQUE_VISIT)))


def q_stream_user_jump(spark, d, within_ms=C.BOUNCE_WITHIN_MS):
    from strata.streaming import jobs, replay, topics as T
    root = replay.scratch(spark, "user_jump")
    src = lambda: T.read_topic(spark, root, "page_in")
    replay.replay_logs(spark, {"page_in": batch.page_log(spark, d)},
                       lambda r: jobs.user_jump(spark, r, f"{r}/_ck", within_ms, source=src), root, flush=True)
    out = _parsed_topic(spark, T.read_topic_batch(spark, root, C.TOPIC_USER_JUMP))
    return flat_page(out.filter(~F.col("common.mid").eqNullSafe(replay.MARKER)))


def _order_bounds(spark, d, rows=None):
    """Event times that cut the orders and their lines into slices for a join's state."""
    from strata.streaming import replay
    times = fx.order_info(spark, d).select("create_ts").union(fx.order_detail(spark, d).select("create_ts"))
    return replay.time_bounds(times, rows=rows or replay.SLICE_ROWS)


def q_stream_order_wide(spark, d, slice_rows=None):
    """J1 as a stream ⋈ stream interval join, J3 per micro-batch. The topics come in order of time, a slice per restart."""
    from strata.streaming import jobs, replay, topics as T
    root = replay.scratch(spark, "order_wide")
    ts = F.col("create_ts")
    inputs = {"dwd_order_info": [(fx.order_info(spark, d), ts)], "dwd_order_detail": [(fx.order_detail(spark, d), ts)]}
    for _ in replay.publish_slices(inputs, root, _order_bounds(spark, d, slice_rows), keep=False):
        with replay.state_partitions(spark), replay.short_history(spark):
            q = jobs.order_wide(spark, root, f"{root}/_ck", f"{root}/out", lambda: batch.order_dims(spark, d),
                                batch.AGE_NOW_MS, sources={"info": lambda: T.read_topic(spark, root, "dwd_order_info"),
                                                           "detail": lambda: T.read_topic(spark, root, "dwd_order_detail")})
            q.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


#: Routing of the order records: whole records to their fact topics.
FACT_RULES = [(i, t, "insert", C.SINK_TYPE_KAFKA, f"dwd_{t}", None, None, None)
              for i, t in enumerate(("order_info", "order_detail", "payment_info"), 1)]


def q_stream_payment_wide(spark, d, slice_rows=None):
    """The order chain end to end in streaming, from change records without sequence numbers:
    routing → fact topics → order wide → its topic → payment wide. The records come in order of time, a slice per restart."""
    from strata.streaming import jobs, replay
    root = replay.scratch(spark, "payment_wide")
    ts = F.col("data.create_ts")
    frames = [(rows.select(F.lit(name).alias("table"), F.lit("insert").alias("type"), F.struct(*rows.columns).alias("data")), t)
              for name, rows, t in (("order_info", fx.order_info(spark, d), ts), ("order_detail", fx.order_detail(spark, d), ts),
                                    ("payment_info", fx.payment_info(spark, d), parse_time_ms("data.callback_time")))]
    for _ in replay.publish_slices({"ods_base_db": frames}, root, _order_bounds(spark, d, slice_rows), keep=False):
        with replay.state_partitions(spark), replay.short_history(spark):
            jobs.base_db(spark, root, f"{root}/_ck_db", f"{root}/routed",
                         lambda: fx.routing_rules(spark, FACT_RULES)).awaitTermination()
            jobs.order_wide(spark, root, f"{root}/_ck_ow", f"{root}/ow", lambda: batch.order_dims(spark, d),
                            batch.AGE_NOW_MS).awaitTermination()
            jobs.payment_wide(spark, root, f"{root}/_ck_pw", f"{root}/pw").awaitTermination()
    return spark.read.parquet(f"{root}/pw")


def q_stream_visitor_stats_10s(spark, d):
    """The summary layer end to end in streaming: page log → streaming K2 and K3 →
    per-leg watermarks → union → 10 s windows in append mode."""
    from strata.streaming import jobs, replay, topics as T
    page = batch.page_log(spark, d)
    root = replay.scratch(spark, "visitor_stats")
    src = lambda: T.read_topic(spark, root, "page_in")
    replay.replay_logs(spark, {"page_in": page}, lambda r: jobs.unique_visit(spark, r, f"{r}/_ck_uv", source=src), root)
    jobs_root = replay.scratch(spark, "visitor_stats_uj")
    src2 = lambda: T.read_topic(spark, jobs_root, "page_in")
    replay.replay_logs(spark, {"page_in": page},
                       lambda r: jobs.user_jump(spark, r, f"{r}/_ck_uj", source=src2), jobs_root, flush=True)
    uv = _parsed_topic(spark, T.read_topic_batch(spark, root, C.TOPIC_UNIQUE_VISIT))
    uj = _parsed_topic(spark, T.read_topic_batch(spark, jobs_root, C.TOPIC_USER_JUMP)) \
        .filter(~F.col("common.mid").eqNullSafe(replay.MARKER))
    stats_root = replay.scratch(spark, "visitor_stats_out")
    legs = {k: (lambda k=k: T.read_topic(spark, stats_root, f"{k}_in")) for k in ("page", "uv", "uj")}
    replay.replay_logs(spark, {"page_in": page, "uv_in": uv, "uj_in": uj},
                       lambda r: jobs.visitor_stats(spark, r, f"{r}/_ck", f"{r}/out", sources=legs),
                       stats_root, flush=True, field="vc")
    return spark.read.parquet(f"{stats_root}/out").filter(~F.col("vc").eqNullSafe(replay.MARKER))


def _publish_changes(spark, recs, root, topic="ods_base_db"):
    """Records without a sequence number, those of one key in their order in one file."""
    from strata.streaming import topics as T
    rows = recs.select("seq", F.get_json_object("data", "$.id").alias("id"), "table", F.to_json(F.struct("table", "type", "data")).alias("value"))
    T.publish(rows.repartition(F.col("table"), F.col("id")).sortWithinPartitions("seq").select("value"), root, topic, as_json=False)


def q_stream_dim_current(spark, d):
    """S4 by change: three micro-batches of records without sequence numbers folded into versioned tables, a restart before each."""
    from strata.streaming import jobs, replay
    from strata.streaming.dimstore import DimStore
    root = replay.scratch(spark, "dims")
    recs = fx.cdc_records(spark, d)
    lo, hi = recs.agg(F.min("seq"), F.max("seq")).first()
    part = F.least(F.floor((F.col("seq") - lo) * 3 / F.lit(max(hi - lo, 1))), F.lit(2))
    for i in range(3):
        _publish_changes(spark, recs.filter(part == i), root)
        jobs.base_db(spark, root, f"{root}/_ck", f"{root}/routed", lambda: fx.routing_rules(spark)).awaitTermination()
    return DimStore(spark, jobs.dims_beside(f"{root}/routed")).current()


#: Rules before the second micro-batch of ``stream_route_refresh``: one changed, one removed, one added.
CHANGED_RULES = [(5, "sku_info", "update", "hbase", "dim_sku_info", "id,tm_id", None, None) if r[0] == 5 else r
                 for r in fx.ROUTING_RULES if r[0] != 8] + \
                [(9, "user_info", "update", "kafka", "dwd_user_info", "id,seg", None, None)]


def q_stream_route_refresh(spark, d):
    """Rules that change between micro-batches take effect from the next one on; each batch keeps its version."""
    from strata.streaming import jobs, replay, topics as T
    root = replay.scratch(spark, "refresh")
    for i, rules in enumerate((None, CHANGED_RULES, CHANGED_RULES)):
        T.publish(replay.spread(fx.cdc_records(spark, d).filter(F.col("seq") % 3 == i)), root, "ods_base_db")
        jobs.base_db(spark, root, f"{root}/_ck", f"{root}/routed", lambda r=rules: fx.routing_rules(spark, r)).awaitTermination()
    versions = RuleHistory(spark, f"{root}/routed-rules").versions()
    from_batch = F.element_at(F.create_map(*[F.lit(x) for kv in versions.items() for x in kv]), F.col("batch_id"))
    routed = jobs.routed_table(spark, f"{root}/routed")
    return flat_route(routed.withColumn("rules_from", from_batch), "route", "rules_from")


def q_stats_sink_retry(spark, d):
    """Day statistics upserted in three epochs. The first brings outdated rows of one version, the second fails
    between write and commit and is done again, the third brings the outdated rows anew; then the first is tried again."""
    from strata.streaming import replay
    from strata.streaming.stats_table import EpochTable
    stats = batch.materialize(q_visitor_stats_1d(spark, d), "stats-retry")
    table = EpochTable(spark, f"{replay.scratch(spark, 'stats')}/table")
    late = F.pmod(F.xxhash64("stt", "ar", "ch"), F.lit(2)) == 1
    first = stats.filter(~late).withColumn("pv_ct", F.when(F.col("vc") == "v0", F.col("pv_ct") + 1000).otherwise(F.col("pv_ct")))
    table.upsert(first, 0)
    table.stage(stats.filter(late).limit(1), 1)  # the attempt that failed
    table.upsert(stats.filter(late), 1)
    table.upsert(stats.filter(~late & (F.col("vc") == "v0")), 2)
    table.upsert(first, 0)
    return table.read()


def q_stream_late_rows(spark, d):
    """Every row of three micro-batches, with those told apart whose window had closed."""
    from strata.streaming import late, replay, topics as T
    root = replay.scratch(spark, "late")
    for i in range(3):
        T.publish(fx.ods_log(spark, d).filter(F.col("event_id") % 3 == i), root, "ods_base_log")
        ts = F.get_json_object("value", "$.ts").try_cast("bigint")
        late.split_late(T.read_topic(spark, root, "ods_base_log"), root, "log", f"{root}/_ck", ts, 3_000, 10_000).awaitTermination()
    rows = [_parsed_topic(spark, late.read_split(spark, root, "log", p)).select("event_id", "ts", F.lit(p == late.LATE).alias("late"))
            for p in (late.ON_TIME, late.LATE)]
    return rows[0].union(rows[1])


def q_state_audit(spark, d):
    """The state of K2 read from its checkpoint after a stop and a restart: one entry per device and day."""
    from strata.streaming import jobs, replay, topics as T
    root = replay.scratch(spark, "audit")
    page = batch.materialize(batch.page_log(spark, d), "audit-pages")
    cut = page.agg(F.expr("cast(avg(ts) AS bigint)")).first()[0] or 0
    src = lambda: T.read_topic(spark, root, "page_in")
    for rows in (page.filter(F.col("ts") < cut), page.filter(F.col("ts") >= cut)):
        replay.replay_logs(spark, {"page_in": rows},
                           lambda r: jobs.unique_visit(spark, r, f"{r}/_ck", source=src, expiry_days=100_000), root)
    held = spark.read.format("statestore").load(f"{root}/_ck")
    first = held.schema["value"].dataType.fieldNames()[0]
    return held.select("key.mid", F.date_format(F.expr("key.day_end - INTERVAL 1 DAY"), C.DAY_FORMAT).alias("day"),
                       F.col(f"value.{first}.ts").alias("ts"), F.col(f"value.{first}.id.seq").alias("event_id"))


QUERIES.update({
    "stream_dim_current": q_stream_dim_current,
    "stream_route_refresh": q_stream_route_refresh,
    "stats_sink_retry": q_stats_sink_retry,
    "stream_late_rows": q_stream_late_rows,
    "state_audit": q_state_audit,
    "stream_visitor_stats_10s": q_stream_visitor_stats_10s,
    "stream_visitor_flag_repair": q_stream_visitor_flag_repair,
    "stream_unique_visit": q_stream_unique_visit,
    "stream_user_jump": q_stream_user_jump,
    "stream_user_jump_long": lambda s, d: q_stream_user_jump(s, d, LONG_WITHIN_MS),
    "stream_order_wide": q_stream_order_wide,
    "stream_payment_wide": q_stream_payment_wide,
})
