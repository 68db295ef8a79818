"""Versioned tables, lookups by several columns and as of a time, and what streams keep and leave out."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strata import config as C
from strata import schemas as S
from strata.operators import cdc, logs
from strata.operators.joins import AsOfSpec, DimSpec, asof_lookup, lookup
from strata.sources import fixtures as fx
from strata.sources.rules import RuleHistory
from strata.streaming import jobs, late, replay, state, topics
from strata.streaming.dimstore import DimStore
from strata.streaming.stats_table import EpochTable
from tests.helpers import log_df, log_row

DAY = 86_400_000


def changes(spark, rows):
    """(table, pk, op, data, order) rows as a micro-batch of changes."""
    df = spark.createDataFrame(rows, "dim_table string, pk string, op string, data map<string,string>, at bigint")
    return df.withColumn("place", F.struct(F.lit(None).cast("bigint").alias("seq"), "at", F.lit("f").alias("source"), F.lit(0).cast("bigint").alias("row")))


def content(store, version=None, **kw):
    return {(r.dim_table, r.pk, r.column): r.value for r in store.current(version, **kw).collect()}


def test_dimension_versions_equal_one_pass_over_all_changes(spark):
    rng = random.Random(3)
    store = DimStore(spark, f"{replay.scratch(spark, 't-store')}/s", buckets=4)
    want, at = {}, 0
    for b in range(4):
        rows = []
        for _ in range(60):
            at += 1
            pk = "hot" if rng.random() < 0.5 else f"k{rng.randrange(8)}"
            data = {c: rng.choice([None, "x", "y", str(at)]) for c in ("a", "b", "c") if rng.random() < 0.5}
            rows.append((rng.choice(["D1", "D2"]), pk, "update", data, at))
            want.update({(rows[-1][0], pk, c): v for c, v in data.items()})
        rows.append(("D1", None, "insert", {"a": "lost"}, at))
        rng.shuffle(rows)
        assert store.fold(changes(spark, rows), b)
        assert not store.fold(changes(spark, [("D1", "hot", "update", {"a": "again"}, 10**9)]), b)  # a replay changes nothing
        assert content(store) == want
    wide = {r.id: (r.a, r.c) for r in store.table("d1", ["id", "a", "c"]).collect()}
    assert wide["hot"] == (want.get(("D1", "hot", "a")), want.get(("D1", "hot", "c")))


def test_a_fold_reads_its_batch_and_the_buckets_it_touches_only(spark):
    store = DimStore(spark, f"{replay.scratch(spark, 't-store')}/s", buckets=64)
    store.fold(changes(spark, [("D", f"k{i}", "insert", {"a": "1"}, i) for i in range(300)]), 0)
    before = store.versions.get(0)["parts"]
    store.fold(changes(spark, [("D", "k7", "update", {"a": "2"}, 1000)]), 1)
    after = store.versions.get(1)["parts"]
    moved = [k for k in before if before[k] != after[k]]
    assert len(moved) == 1 and set(before) == set(after)
    plan = store.merged(f"{store.path}/deltas/batch=1", [before[k] for k in moved])
    folders = {f.split("/s/", 1)[1].rpartition("/")[0] for f in plan.inputFiles()}
    assert not any("batch=0" in f for f in folders) and len(folders) == 2
    # a version stays as it was; an unpublished one is not seen
    assert content(store, 0)["D", "k7", "a"] == "1" and content(store)["D", "k7", "a"] == "2"
    published = store.versions.publish
    store.versions.publish = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        store.fold(changes(spark, [("D", "k8", "delete", {"a": "3"}, 1001)]), 2)
    assert content(store)["D", "k8", "a"] == "1"
    store.versions.publish = published
    assert store.fold(changes(spark, [("D", "k8", "delete", {"a": "3"}, 1001)]), 2)
    assert content(store)["D", "k8", "a"] == "3" and ("D", "k8", "a") not in content(store, apply_deletes=True)
    assert store.vacuum(1) == [0, 1] and content(store)["D", "k7", "a"] == "2" and len(content(store)) == 300


def test_an_empty_batch_publishes_what_was_there(spark):
    store = DimStore(spark, f"{replay.scratch(spark, 't-store')}/s")
    assert store.read().count() == 0
    store.fold(changes(spark, []), 0)
    store.fold(changes(spark, [("D", "k", "insert", {"a": None}, 1)]), 1)
    store.fold(changes(spark, []), 2)
    assert content(store) == {("D", "k", "a"): None}


@pytest.mark.parametrize("bucket_ms", [7, 100, 10**6])
def test_asof_lookup_against_a_scan_of_all_changes(spark, bucket_ms):
    rng = random.Random(bucket_ms)
    key = lambda: rng.choice(["hot"] * 4 + ["a", "b", None])
    log = [(key(), rng.choice([None, rng.randrange(-50, 400)]) if rng.random() < 0.1 else rng.randrange(-50, 400), i,
            {c: rng.choice([None, f"v{i}"]) for c in ("x", "y") if rng.random() < 0.6}) for i in range(150)]
    facts = [(i, key(), None if rng.random() < 0.05 else rng.randrange(-80, 450), "own") for i in range(200)]
    spec = AsOfSpec("d", spark.createDataFrame(log, "pk string, ts bigint, seq bigint, data map<string,string>"), "k", "t", ("x", "y"),
                    {"x_then": F.col("x"), "kept": F.upper("y")}, bucket_ms=bucket_ms)
    got = {r.id: (r.x_then, r.kept) for r in asof_lookup(
        spark.createDataFrame(facts, "id bigint, k string, t bigint, kept string").repartition(3), spec).collect()}
    assert len(got) == 200
    for i, k, t, own in facts:
        seen = sorted((c for c in log if None not in (k, t, c[1]) and c[0] == k and c[1] <= t), key=lambda c: (c[1], c[2]))
        held = {}
        for c in seen:
            held.update(c[3])
        want = (held.get("x"), (held.get("y") or "").upper() or None) if seen else (None, own)
        assert got[i] == want


def test_lookup_by_several_columns_takes_the_first_row(spark):
    dim = spark.createDataFrame([("a", 1, 3, "late"), ("a", 1, 2, "first"), ("a", 1, 2, "same place"), ("a", None, 1, "null"), (None, 1, 0, "n1"),
                                 ("b", 2, None, "no place"), ("b", 2, 5, "z")], "p string, q int, rank int, v string")
    facts = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, None, 1), (4, "b", 2), (5, "c", 1), (6, None, None), (1, "a", 1)], "id int, x string, y int")
    spec = dict(name="d", dim=dim, fact_key=["x", "y"], columns={"v": F.col("v")}, dim_key=["p", "q"], first_by=("rank",))
    got = sorted((r.id, r.v) for r in lookup(facts, DimSpec(**spec)).collect())
    assert got == [(1, "first"), (1, "first"), (2, None), (3, None), (4, "no place"), (5, None), (6, None)]
    got = {r.id: r.v for r in lookup(facts, DimSpec(**spec, null_safe=True)).collect()}
    assert got == {1: "first", 2: "null", 3: "n1", 4: "no place", 5: None, 6: None}


def test_epochs_count_once(spark):
    rows = lambda *r: spark.createDataFrame(r, "stt string, ar string, ch string, vc string, is_new string, pv_ct bigint")
    table = EpochTable(spark, f"{replay.scratch(spark, 't-epochs')}/t")
    with pytest.raises(ValueError):
        table.read()
    table.upsert(rows(("1", "a", "c", "v", "0", 1), ("2", "a", "c", "v", "0", 2)), 0)
    record = table.stage(rows(("2", "a", "c", "v", "0", 50)), 1)  # lost before its commit
    assert {r.pv_ct for r in table.read().collect()} == {1, 2}
    table.commit(1, table.stage(rows(("2", "a", "c", "v", "0", 5)), 1) | record)
    assert not table.upsert(rows(("1", "a", "c", "v", "0", 99)), 0)
    assert sorted(r.pv_ct for r in table.read().collect()) == [1, 5]


def test_stats_job_writes_an_epoch_table(spark):
    root = replay.scratch(spark, "t-stats-table")
    src = {k: (lambda k=k: topics.read_topic(spark, root, f"{k}_in")) for k in ("page", "uv", "uj")}
    for ts in (100_000, 300_000, 500_000):
        for k in ("page", "uv", "uj"):
            topics.publish(log_df(spark, [log_row(ts, ts)]), root, f"{k}_in")
        jobs.visitor_stats(spark, root, f"{root}/_ck", None, sources=src, table_path=f"{root}/t").awaitTermination()
    got = EpochTable(spark, f"{root}/t").read().collect()
    assert sorted((r.pv_ct, r.uv_ct, r.uj_ct, r.ts) for r in got)[:1] == [(1, 1, 1, 100_000)]


def test_a_replayed_batch_is_routed_by_its_own_rules(spark):
    history = RuleHistory(spark, f"{replay.scratch(spark, 't-rules')}/r")
    old, new = (lambda: fx.routing_rules(spark)), (lambda: fx.routing_rules(spark, fx.ROUTING_RULES[:2]))
    assert history.for_batch(0, old).count() == 8 and history.for_batch(1, old).count() == 8
    assert history.for_batch(2, new).count() == 2
    assert history.for_batch(1, new).count() == 8 and history.for_batch(2, old).count() == 2
    assert history.versions() == {0: 0, 1: 0, 2: 2}


def test_first_place_shared_by_many_rows(spark):
    """K1: one of 100,000 rows tied for a device's first place keeps its flag, delivered again or not."""
    row = log_df(spark, [log_row(None, 5, mid="hot", is_new="1", page_id="p")])
    many = row.crossJoin(spark.range(100_000)).withColumn("page", F.col("page").withField("during_time", F.col("id") % 50_000)).select(*row.columns)
    others = log_df(spark, [log_row(7, 9, mid="hot", is_new="1"), log_row(1, 3, mid="b", is_new="1"), log_row(1, 3, mid="b", is_new="1"),
                            log_row(2, 4, mid=None, is_new="1"), log_row(3, 4, mid="c", is_new="0")])
    out = logs.repair_new_flag(many.union(others))
    got = {(r.mid, r.is_new): r.n for r in out.groupBy("common.mid", "common.is_new").agg(F.count("*").alias("n")).collect()}
    assert got == {("hot", "1"): 1, ("hot", "0"): 100_000, ("b", "1"): 1, ("b", "0"): 1, (None, "1"): 1, ("c", "0"): 1}
    assert out.filter("common.mid = 'hot'").select("page.during_time").distinct().count() >= 50_000


def test_whole_start_and_display_objects_in_batch(spark):
    raw = spark.createDataFrame([(json.dumps(r),) for r in (
        {"ts": 1, "common": {"mid": "a"}, "start": {"only": True}, "displays": [{"x": 1}]},
        {"ts": 2, "common": {"mid": "a"}, "start": {}, "page": {"page_id": "p"}, "displays": [{"item": "i", "deep": {"k": 1}, "page_id": "own"}, {}]},
        {"ts": 3, "common": {"mid": "a"}, "start": None, "page": {"page_id": "q"}})], "value string")
    good, bad = logs.parse_log(raw, schema=S.LOG_WHOLE)
    parts = logs.split_log(good)
    assert bad.count() == 0 and [r.ts for r in parts["start"].collect()] == [1]
    assert sorted(r.ts for r in parts["page"].collect()) == [2, 3]
    shown = sorted((json.loads(r.value) for r in parts["display"].collect()), key=len)
    assert shown == [{"page_id": "p"}, {"item": "i", "deep": {"k": 1}, "page_id": "p"}]


def test_streaming_state_needs_no_python(spark):
    k = state.keyed(spark.range(1).select(F.lit('{"ts":1}').alias("value")))
    for df in (state.first_flags(k), state.repair_flags(state.first_flags(k)), state.unique_visits(k), state.bounces(k)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Window" not in plan.replace("window", "")


def test_hot_device_over_many_micro_batches(spark):
    """A device with nearly all rows: each job keeps one state row for what it has seen of a device (day, bucket)."""
    root = replay.scratch(spark, "t-hot")
    rows = [log_row(i, 10 * DAY + i * 40, mid="hot" if i % 10 else f"m{i}", is_new="1", last_page_id="x" if i % 3 else None) for i in range(3000)]
    for part in range(3):
        topics.publish(log_df(spark, rows[part * 1000:(part + 1) * 1000]), root, "ods_base_log")
    with replay.state_partitions(spark, 4):
        q = jobs.base_log(spark, root, f"{root}/_ck", max_files_per_trigger=2)
        q.awaitTermination()
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 301
    pages = topics.read_fanout(spark, root, C.TOPIC_PAGE, stream=False).select(F.get_json_object("value", "$.common.is_new").alias("n"))
    assert pages.count() == 3000
    with replay.state_partitions(spark, 4):
        jobs.unique_visit(spark, root, f"{root}/_ck_uv").awaitTermination()
    assert topics.read_topic_batch(spark, root, C.TOPIC_UNIQUE_VISIT).count() == \
        len({r[1][0] for r in rows if not r[3][1]})


def test_visit_state_expires_in_event_time(spark):
    root = replay.scratch(spark, "t-expire")
    src = lambda: topics.read_topic(spark, root, "page_in")
    held = []
    with replay.state_partitions(spark, 2):
        for d in (10, 11, 12, 13, 20, 21):
            topics.publish(log_df(spark, [log_row(d * 10 + i, d * DAY + i, mid=f"m{i}") for i in range(5)]), root, "page_in")
            q = jobs.unique_visit(spark, root, f"{root}/_ck", source=src)
            q.awaitTermination()
            held.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 15 and held[-1] <= 10  # 30 device days seen
    assert topics.read_topic_batch(spark, root, C.TOPIC_UNIQUE_VISIT).count() == 30


def test_late_rows_are_kept_and_as_many_as_spark_drops(spark):
    root = replay.scratch(spark, "t-late-split")
    src = {k: (lambda k=k: topics.read_topic(spark, root, f"{k}_in")) for k in ("page", "uv", "uj")}
    ts = F.get_json_object("value", "$.ts").try_cast("bigint")
    dropped = 0
    steps = [[100_000, 101_000], [200_000], [150_000, 199_999, 190_000], [189_999, 90_000, 200_500]]
    for n, step in enumerate(steps):
        for k in ("page", "uv", "uj"):
            topics.publish(log_df(spark, [log_row(n * 10 + i, t, vc=f"v{n}{i}") for i, t in enumerate(step)]), root, f"{k}_in")
        late.split_late(topics.read_topic(spark, root, "page_in"), root, "page", f"{root}/_ck_split", ts, 3_000, 10_000).awaitTermination()
        q = jobs.visitor_stats(spark, root, f"{root}/_ck", f"{root}/out", within_ms=1, sources=src)
        q.awaitTermination()
        dropped += jobs.late_rows(q)
    part = {p: sorted(int(json.loads(r.value)["ts"]) for r in late.read_split(spark, root, "page", p).collect()) for p in ("on_time", "late")}
    assert sorted(part["on_time"] + part["late"]) == sorted(t for s in steps for t in s)
    assert part["late"] == [90_000, 150_000, 189_999] and dropped >= len(part["late"])


def test_every_record_is_accounted_for(spark):
    texts = [None, "", "not json", '{"table":', "[1]", "7", '{"table":"t","data":3}', '{"data":{"id":"1"}}', '{"table":"t","type":"insert"}',
             '{"table":"t","data":null}', '{"table":"t","data":{}}', '{"table":"t","type":"insert","data":{"id":"1"}}',
             '{"table":"user_info","type":"insert","data":{"id":"1"}}', '{"table":"user_info","type":"insert","data":{"name":"x"}}',
             '{"table":"order_info","type":"bootstrap-insert","data":{"id":1}}', '{"table":"order_info","type":"update","data":{"id":1}}']
    got = {r.value: r.outcome for r in cdc.account(spark.createDataFrame([(t,) for t in texts], "value string"), fx.routing_rules(spark)).collect()}
    want = ["no text", "malformed", "malformed", "malformed", "wrong type", "wrong type", "wrong type", "no table", "no data", "no data", "no data",
            "no rule", "dim", "no key", "fact", "unknown sink type"]
    assert got == dict(zip(texts, want))


def test_positions_have_no_bounds(spark):
    rows = spark.createDataFrame([(2**40, 5000, "b"), (2**40, 4096, "a"), (2**40 + 1, 0, "c"), (7, 2**31 - 1, "d")], "offset bigint, partition int, v string")
    got = rows.select("v", topics.kafka_position().alias("pos")).orderBy("pos").collect()
    assert [r.v for r in got] == ["d", "a", "b", "c"]
