import random

from pyspark.sql import functions as F

from strata.operators import logs, traffic
from tests.helpers import log_df, log_row

DAY = 86_400_000


def ids(df, col="event_id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_bounce_exact_limit(spark):
    near = log_df(spark, [log_row(1, 0), log_row(2, 9_999, last_page_id="home")])
    at = log_df(spark, [log_row(1, 0), log_row(2, 10_000, last_page_id="home")])
    assert ids(traffic.user_jump(near)) == []
    assert ids(traffic.user_jump(at)) == [1]


def test_bounce_two_entries(spark):
    df = log_df(spark, [log_row(1, 0), log_row(2, 5_000)])
    assert ids(traffic.user_jump(df)) == [2]


def test_bounce_next_without_page_id(spark):
    df = log_df(spark, [log_row(1, 0), log_row(2, 3_000, page_id="")])
    # the first is followed within the limit; the second is an entry with nothing after it
    assert ids(traffic.user_jump(df)) == [2]
    df2 = log_df(spark, [log_row(1, 0), log_row(2, 3_000, page_id="", last_page_id="x")])
    assert ids(traffic.user_jump(df2)) == []


def test_bounce_devices_independent(spark):
    df = log_df(spark, [log_row(1, 0, mid="a"), log_row(2, 1_000, mid="b", last_page_id="x")])
    assert ids(traffic.user_jump(df)) == [1]


def _brute_jumps(rows, within):
    by = {}
    for r in rows:
        by.setdefault(r[1][0], []).append(r)
    out = []
    for evs in by.values():
        evs.sort(key=lambda r: (r[5], r[0]))
        for i, e in enumerate(evs):
            if (e[3][1] or "") != "":
                continue
            nxt = evs[i + 1][5] if i + 1 < len(evs) else None
            if nxt is None or nxt - e[5] >= within:
                out.append(e[0])
    return sorted(out)


def test_bounce_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        mid = f"m{rnd.randrange(5)}"  # few devices: hot keys
        ts = rnd.randrange(0, 200_000) // 7 * 7  # ties on ts happen
        rows.append(log_row(i, ts, mid=mid, last_page_id=rnd.choice([None, "", "home"])))
    df = log_df(spark, rows)
    for within in (1_000, 10_000, 33_333):
        assert ids(traffic.user_jump(df, within)) == _brute_jumps(rows, within)


def test_bounce_independent_of_arrival_order(spark):
    rnd = random.Random(3)
    rows = [log_row(i, rnd.randrange(0, 100_000), mid=f"m{i % 3}", last_page_id=rnd.choice([None, "x"]))
            for i in range(200)]
    a = ids(traffic.user_jump(log_df(spark, rows)))
    rnd.shuffle(rows)
    assert ids(traffic.user_jump(log_df(spark, rows).repartition(7))) == a


def test_unique_visit(spark):
    df = log_df(spark, [
        log_row(1, 1_000), log_row(2, 2_000), log_row(3, DAY + 5),
        log_row(4, 500, last_page_id="home"),  # not an entry page
    ])
    assert ids(traffic.unique_visit(df)) == [1, 3]


def test_unique_visit_tie_on_ts(spark):
    df = log_df(spark, [log_row(9, 1_000), log_row(4, 1_000)])
    assert ids(traffic.unique_visit(df)) == [4]


def test_flag_repair_modes(spark):
    rows = [log_row(1, 1_000, is_new="1"), log_row(2, 2_000, is_new="1"), log_row(3, DAY + 1, is_new="1"),
            log_row(4, 3_000, is_new="0")]
    df = log_df(spark, rows)

    def flags(mode):
        out = logs.repair_new_flag(df, mode=mode).select("event_id", "common.is_new").collect()
        return [r[1] for r in sorted(out)]
    assert flags("same_day") == ["1", "0", "1", "0"]
    assert flags("other_day") == ["1", "1", "0", "0"]


def test_split_and_displays(spark):
    disp = [("i1", "sku_id", 1, 0), ("i2", "sku_id", 2, 1)]
    rows = [log_row(1, 0, start=("icon", 5), displays=disp),
            log_row(2, 1, page_id="p2", displays=disp),
            log_row(3, 2, page_id="p3", displays=[])]
    out = logs.split_log(log_df(spark, rows))
    assert out["start"].count() == 1
    assert out["page"].count() == 2
    d = out["display"].collect()
    assert sorted((r["item"], r["page_id"]) for r in d) == [("i1", "p2"), ("i2", "p2")]
    assert set(out["display"].columns) == {"item", "item_type", "order", "pos_id", "page_id"}


def test_empty_start_object_is_page(spark):
    rows = [log_row(1, 0, start=(None, None))]
    out = logs.split_log(log_df(spark, rows))
    assert out["start"].count() == 0 and out["page"].count() == 1


def test_parse_log_quarantine(spark):
    good = '{"event_id":1,"common":{"mid":"m"},"page":{"page_id":"p"},"ts":5}'
    df = spark.createDataFrame([(good,), ("{not json",), (None,)], "value string")
    ok, bad = logs.parse_log(df)
    assert ok.count() == 1 and bad.count() == 2


def test_stats_one_group(spark):
    row = log_row(1, 12_345)
    df = log_df(spark, [row])
    legs = traffic.union_stats(traffic.stats_pv(df), traffic.stats_uv(df), traffic.stats_sv(df),
                               traffic.stats_uj(df))
    out = traffic.aggregate_stats(legs).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.uv_ct, r.pv_ct, r.sv_ct, r.uj_ct, r.dur_sum) == (1, 1, 1, 1, 100)
    assert (r.stt, r.edt) == ("1970-01-01 00:00:10", "1970-01-01 00:00:20")
    edge = log_df(spark, [log_row(2, 20_000)])
    e = traffic.aggregate_stats(traffic.stats_pv(edge)).collect()[0]
    assert e.stt == "1970-01-01 00:00:20"  # the end bound is exclusive


def test_null_dwell_time_counts_zero(spark):
    df = log_df(spark, [log_row(1, 0, during_time=None), log_row(2, 1, during_time=7)])
    r = traffic.aggregate_stats(traffic.stats_pv(df)).collect()[0]
    assert r.dur_sum == 7 and r.pv_ct == 2


def test_batch_plans_have_no_python(spark):
    from tests.conftest import SF
    from tests.test_plans import plan
    import __spark_entry__ as E
    for name, q in E.queries().items():
        if name.startswith("stream_"):
            continue  # each runs a job; their state is checked in test_state_tables
        p = plan(q(spark, SF))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p, name
    assert F is not None
