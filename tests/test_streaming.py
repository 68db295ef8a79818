"""Batch = stream on closed input, restarts from checkpoints, arrival order."""

import json
import random

from pyspark.sql import functions as F

from strata import config as C
from strata import schemas as S
from strata.operators import cdc, orders, traffic
from strata.plans import batch, catalog
from strata.sources import fixtures as fx
from strata.streaming import jobs, replay, topics
from tests.conftest import SF
from tests.helpers import log_df, log_row


def _rows(df, cols=None):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()))


def _parsed(df):
    return df.select(F.from_json("value", S.LOG).alias("r")).select("r.*")


def test_base_log_split_equals_batch(spark):
    root = replay.scratch(spark, "t-base-log")
    replay.replay_logs(spark, {"ods_base_log": fx.ods_log(spark, SF)},
                       lambda r: jobs.base_log(spark, r, f"{r}/_ck"), root)
    page = _parsed(topics.read_fanout(spark, root, C.TOPIC_PAGE, stream=False))
    assert _rows(catalog.flat_page(page)) == _rows(catalog.flat_page(batch.page_log(spark, SF)))
    disp = topics.read_fanout(spark, root, C.TOPIC_DISPLAY, stream=False) \
        .select(F.from_json("value", "item string, page_id string").alias("d")).select("d.*")
    assert _rows(disp) == _rows(batch.detail_logs(spark, SF)["display"], ["item", "page_id"])


def test_bounce_stream_equals_batch_and_survives_restart(spark):
    rnd = random.Random(11)
    rows = [log_row(i, rnd.randrange(0, 60_000), mid=f"m{i % 4}", last_page_id=rnd.choice([None, "", "x"]))
            for i in range(300)]
    df = log_df(spark, rows)
    root = replay.scratch(spark, "t-bounce")
    src = lambda: topics.read_topic(spark, root, "page_in")
    # three runs on one checkpoint: data, then two flush rounds (restarts)
    replay.replay_logs(spark, {"page_in": df}, lambda r: jobs.user_jump(spark, r, f"{r}/_ck", 5_000, source=src),
                       root, flush=True)
    out = _parsed(topics.read_topic_batch(spark, root, C.TOPIC_USER_JUMP)).filter(F.col("common.mid") != replay.MARKER)
    assert _rows(out, ["event_id"]) == _rows(traffic.user_jump(df, 5_000), ["event_id"])


def test_unique_visit_stream_equals_batch(spark):
    page = batch.page_log(spark, SF)
    root = replay.scratch(spark, "t-uv")
    src = lambda: topics.read_topic(spark, root, "page_in")
    replay.replay_logs(spark, {"page_in": page}, lambda r: jobs.unique_visit(spark, r, f"{r}/_ck", source=src), root)
    out = _parsed(topics.read_topic_batch(spark, root, C.TOPIC_UNIQUE_VISIT))
    assert _rows(out, ["event_id"]) == _rows(traffic.unique_visit(page), ["event_id"])


def test_visitor_stats_stream_equals_batch(spark):
    page = batch.page_log(spark, SF)
    uv, uj = traffic.unique_visit(page), traffic.user_jump(page)
    root = replay.scratch(spark, "t-vs")
    src = {k: (lambda k=k: topics.read_topic(spark, root, f"{k}_in")) for k in ("page", "uv", "uj")}
    replay.replay_logs(spark, {"page_in": page, "uv_in": uv, "uj_in": uj},
                       lambda r: jobs.visitor_stats(spark, r, f"{r}/_ck", f"{r}/out", sources=src),
                       root, flush=True, field="vc")
    out = spark.read.parquet(f"{root}/out").filter(F.col("vc") != replay.MARKER)
    want = traffic.visitor_stats(page, uv, uj)
    assert _rows(out, want.columns) == _rows(want)


def test_order_and_payment_streams_equal_batch(spark):
    root = replay.scratch(spark, "t-orders")
    topics.publish(fx.order_info(spark, SF), root, "dwd_order_info")
    topics.publish(fx.order_detail(spark, SF), root, "dwd_order_detail")
    src = {k: (lambda t=t: topics.read_topic(spark, root, t)) for k, t in
           (("info", "dwd_order_info"), ("detail", "dwd_order_detail"), ("payment", "dwd_payment_info"))}
    jobs.order_wide(spark, root, f"{root}/_ck1", f"{root}/ow", lambda: batch.order_dims(spark, SF),
                    batch.AGE_NOW_MS, sources=src).awaitTermination()
    wide = batch.order_wide(spark, SF)
    got = spark.read.parquet(f"{root}/ow").drop("batch_id")
    assert _rows(got, wide.columns) == _rows(wide)
    topics.publish(fx.payment_info(spark, SF), root, "dwd_payment_info")
    jobs.payment_wide(spark, root, f"{root}/_ck2", f"{root}/pw", sources=src).awaitTermination()
    want = orders.payment_wide(fx.payment_info(spark, SF), wide)
    assert _rows(spark.read.parquet(f"{root}/pw"), want.columns) == _rows(want)


def test_routing_stream_rereads_rules(spark):
    root = replay.scratch(spark, "t-db")
    topics.publish(fx.cdc_records(spark, SF), root, "ods_base_db")
    jobs.base_db(spark, root, f"{root}/_ck", f"{root}/out", lambda: fx.routing_rules(spark)).awaitTermination()
    got = jobs.routed_table(spark, f"{root}/out")
    want = batch.routed_cdc(spark, SF)
    key = ["seq", "route", "sink_table"]
    assert _rows(got, key) == _rows(want, key)
    # a rule removed between micro-batches stops routing its records
    rules2 = lambda: fx.routing_rules(spark).filter(F.col("source_table") != "order_info")
    topics.publish(fx.cdc_records(spark, SF).filter(F.col("table") == "order_info"), root, "ods_base_db")
    jobs.base_db(spark, root, f"{root}/_ck", f"{root}/out", rules2).awaitTermination()
    again = jobs.routed_table(spark, f"{root}/out").filter("batch_id = 1")
    assert again.count() > 0 and again.filter(F.col("route") != "reject").count() == 0
    # the first batch's facts are in their topic, ready for the order job
    ids = topics.read_fanout(spark, root, "dwd_order_info", folder="facts", stream=False) \
        .select(F.get_json_object("value", "$.id").cast("bigint").alias("id"))
    assert _rows(ids) == _rows(want.filter("route = 'fact'").select(F.col("data")["id"].cast("bigint").alias("id")))


def test_unreadable_change_records_are_set_apart(spark):
    good = '{"table":"order_info","type":"insert","data":{"id":7,"user_id":8}}'
    bad = ["not json", '{"table":"order_info","data":']
    root = replay.scratch(spark, "t-db-bad")
    topics.publish(spark.createDataFrame([(v,) for v in [good, None, *bad]], "value string"), root, "ods_base_db", as_json=False)
    jobs.base_db(spark, root, f"{root}/_ck", f"{root}/out", lambda: fx.routing_rules(spark)).awaitTermination()
    got = topics.read_fanout(spark, root, C.TOPIC_BAD_DB, folder="bad", stream=False)
    assert sorted(r.value for r in got.collect()) == sorted(bad)
    assert jobs.routed_table(spark, f"{root}/out").filter("route = 'fact'").count() == 1


def test_late_rows_are_dropped_and_counted(spark):
    """Once every leg's watermark has passed, a late row is dropped and counted.
    (A leg that never saw data holds the query watermark back: min policy.)"""
    root = replay.scratch(spark, "t-late")
    src = {k: (lambda k=k: topics.read_topic(spark, root, f"{k}_in")) for k in ("page", "uv", "uj")}

    def step(row):
        for k in ("page", "uv", "uj"):
            topics.publish(log_df(spark, [row]), root, f"{k}_in")
        q = jobs.visitor_stats(spark, root, f"{root}/_ck", f"{root}/out", within_ms=1_000, sources=src)
        q.awaitTermination()
        return q
    step(log_row(1, 100_000))
    step(log_row(2, 200_000))
    q = step(log_row(3, 150_000, vc="late"))  # behind every leg's watermark now
    assert jobs.late_rows(q) >= 1
    assert spark.read.parquet(f"{root}/out").filter(F.col("vc") == "late").count() == 0


def test_records_without_sequence_and_with_other_fields(spark):
    """Order comes from the topic; unknown fields survive; bad text is set apart; no device passes."""
    day = 1_600_000_000_000
    recs = [
        {"common": {"mid": "a", "is_new": "1", "md": {"os": 7}}, "page": {"page_id": "p", "extra": [1, 2]}, "ts": day,
         "displays": [{"item": "i", "deep": {"k": 1}, "page_id": "own"}, {"item": "j"}], "err": {"code": 5}},
        {"common": {"mid": "a", "is_new": "1", "md": {"os": 8}}, "page": {"page_id": "q", "last_page_id": "p"}, "ts": day,
         "more": 1.5},
        {"common": {"is_new": "1"}, "page": {"page_id": "r"}, "ts": day + 1},
        {"common": {"is_new": "1"}, "start": {"only": True}, "ts": day + 2},
        {"common": {"mid": "b", "is_new": "0"}, "page": {"page_id": "r"}, "start": {}, "ts": day + 3},
    ]
    bad = ["not json", '{"common":{"mid":"a"},"ts":"x"}', '{"ts":']
    root = replay.scratch(spark, "t-raw")
    values = spark.createDataFrame([(json.dumps(r),) for r in recs] + [(b,) for b in bad], "value string").coalesce(1)
    topics.publish(values, root, "ods_base_log", as_json=False)
    jobs.base_log(spark, root, f"{root}/_ck").awaitTermination()

    def out(topic):
        return [json.loads(r.value) for r in topics.read_fanout(spark, root, topic, stream=False).collect()]
    pages = {r["page"]["page_id"] + r["common"].get("mid", ""): r for r in out(C.TOPIC_PAGE)}
    want = json.loads(json.dumps({"pa": recs[0], "qa": recs[1], "r": recs[2], "rb": recs[4]}))
    want["qa"]["common"]["is_new"] = "0"
    assert pages == want
    assert out(C.TOPIC_START) == [recs[3]]
    shown = sorted(out(C.TOPIC_DISPLAY), key=lambda d: d["item"])
    assert shown == [{"item": "i", "deep": {"k": 1}, "page_id": "p"}, {"item": "j", "page_id": "p"}]
    got = [r.value for r in topics.read_fanout(spark, root, C.TOPIC_BAD_LOG, stream=False).collect()]
    assert sorted(got) == sorted(bad)
    # the next jobs run on those records as they are: one visit of each device, a bounce once time has passed
    jobs.unique_visit(spark, root, f"{root}/_ck2").awaitTermination()
    uv = [json.loads(r.value)["page"]["page_id"] for r in topics.read_topic_batch(spark, root, C.TOPIC_UNIQUE_VISIT).collect()]
    assert sorted(uv) == ["p", "r", "r"]
    jobs.user_jump(spark, root, f"{root}/_ck3").awaitTermination()


def test_unique_visit_days_may_interleave(spark):
    root = replay.scratch(spark, "t-uv-days")
    src = lambda: topics.read_topic(spark, root, "page_in")
    day = 86_400_000
    for i, ts in enumerate((day, 2 * day, day + 5, 2 * day + 5)):
        topics.publish(log_df(spark, [log_row(i, ts)]), root, "page_in")
        jobs.unique_visit(spark, root, f"{root}/_ck", source=src).awaitTermination()
    out = _parsed(topics.read_topic_batch(spark, root, C.TOPIC_UNIQUE_VISIT))
    assert _rows(out, ["event_id"]) == [(0,), (1,)]


def test_order_batch_without_a_match_writes_nothing(spark):
    root = replay.scratch(spark, "t-nomatch")
    topics.publish(fx.order_info(spark, SF).limit(3), root, "info_in")
    topics.publish(fx.order_detail(spark, SF).limit(3).withColumn("order_id", F.lit(-1)), root, "detail_in")
    src = {k: (lambda k=k: topics.read_topic(spark, root, f"{k}_in")) for k in ("info", "detail")}
    jobs.order_wide(spark, root, f"{root}/_ck", f"{root}/ow", lambda: batch.order_dims(spark, SF),
                    batch.AGE_NOW_MS, sources=src).awaitTermination()
    assert spark.read.schema("order_id long").parquet(f"{root}/ow").count() == 0


def test_order_topics_in_slices_of_time(spark):
    """The order topics in slices of time give the rows of one slice; a row comes in its time's slice, none twice."""
    d = SF
    assert len(catalog._order_bounds(spark, d, rows=1000)) == 1
    for q in (catalog.q_stream_order_wide, catalog.q_stream_payment_wide):
        whole, cut = q(spark, d), q(spark, d, slice_rows=1000)
        assert cut.count() == whole.count() > 0
        assert cut.exceptAll(whole).isEmpty()
    t = spark.createDataFrame([(None,), (5_500,), (6_000,), (9_999,)], "ts long")
    bounds = replay.time_bounds(t.filter("ts IS NOT NULL"), partitions=1, rows=2)
    assert bounds == [6_000]
    root = replay.scratch(spark, "slices")
    seen = []
    for i in replay.publish_slices({"t": [(t, F.col("ts"))]}, root, [6_000, 9_000]):
        seen.append(spark.read.parquet(f"{root}/t").count())
    assert seen == [2, 3, 4]  # a row without a time comes first


def test_topics_are_spread_over_the_cores(spark, monkeypatch):
    """The files that a streaming query publishes from a table of one row group are even, one for each core."""
    published, publish = [], topics.publish

    def seen(df, root, topic, as_json=True):
        publish(df, root, topic, as_json)
        published.append([r[1] for r in spark.read.parquet(f"{root}/{topic}").groupBy(F.input_file_name()).count().collect()])

    monkeypatch.setattr(topics, "publish", seen)
    cores = spark.sparkContext.defaultParallelism
    assert catalog.q_stream_visitor_flag_repair(spark, SF).count() > 0
    assert len(published[0]) == cores and max(published[0]) - min(published[0]) <= cores
    published.clear()
    assert catalog.q_stream_route_refresh(spark, SF).count() > 0
    assert [len(p) for p in published] == [cores, 2 * cores, 3 * cores]


def test_slices_are_moved_to_their_topic_and_go(spark):
    """A slice's files lie in one place; once its step is over they are gone."""
    t = spark.createDataFrame([(None,), (5_500,), (6_000,), (9_999,)], "ts long").repartition(3)
    root = replay.scratch(spark, "slices-gone")

    def rows(path):
        return spark.read.schema("value string").option("recursiveFileLookup", "true").parquet(f"{root}/{path}").count()

    seen = []
    for _ in replay.publish_slices({"t": [(t, F.col("ts"))]}, root, [6_000, 9_000], keep=False):
        seen.append((rows("t"), rows("_feed_t")))
    assert seen == [(2, 2), (1, 1), (1, 0)]
    assert rows("t") == 0


def test_short_history_is_set_for_its_queries_only(spark):
    key = "spark.sql.streaming.minBatchesToRetain"
    before = spark.conf.get(key, None)
    with replay.short_history(spark):
        assert spark.conf.get(key) == "2"
    assert spark.conf.get(key, None) == before


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_change_records_are_parsed_once(spark):
    pos = F.struct(F.lit(1).cast("bigint").alias("at"), F.lit("a").alias("source"), F.lit(1).cast("bigint").alias("row"))
    values = ['{"table":"t","type":"insert","data":{"id":7,"x":null}}', '{"table":', None, "[1]", '{"type":"insert","data":{"id":1}}']
    batch_ = spark.createDataFrame([(v,) for v in values], "value string").repartition(2).select("value", pos.alias("pos"))
    recs, seen = jobs.read_records(batch_)
    kept = cdc.etl_filter(recs)
    assert _plan(kept).count("from_json(") == 1 and _plan(kept).count("parseJson(") == 1
    assert [tuple(r)[1:4] for r in kept.collect()] == [("t", "insert", '{"id":7,"x":null}')]
    assert seen.get["n"] == 1
    # and so are the records of a join's side, whose keys get filters
    side = jobs._typed(batch_, S.ORDER_INFO)
    assert _plan(side.filter(F.col("id").isNotNull() & F.col("create_ts").isNotNull())).count("from_json(") == 1


def test_fact_texts_equal_payloads_of_parsed_maps(spark):
    maps = ["{}", None, '{"id":"1","x":null}', '{"id":"1","x":":null"}', '{"a\\"b":"c\\\\d\\n","é":"ü/\\u0001"}', '{"a":"1","a":"2"}', '{"a":"{\\"k\\":null}"}']
    written = spark.createDataFrame([("t", m) for m in maps], "sink_table string, data string").repartition(1)
    written = cdc.parse_cdc(written).withColumn("data", F.to_json("data"))
    assert cdc.fact_text(written).collect() == cdc.fact_payload(cdc.parse_cdc(written)).collect()
