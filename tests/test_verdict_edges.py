"""Edges: rows without a device, redelivered rows, malformed records, pruned keys."""

import pytest
from pyspark.sql import functions as F

from strata.operators import cdc, logs
from tests.helpers import log_df, log_row

DAY = 86_400_000


@pytest.mark.parametrize("mode,want", [("same_day", ["0", "1", "1", "1"]), ("other_day", ["0", "1", "1", "1"])])
def test_rows_without_a_device_pass(spark, mode, want):
    rows = [log_row(1, 10, mid=None, is_new="1"), log_row(2, 20, mid=None, is_new="1"), log_row(3, 30, mid=None, is_new="0"),
            log_row(4, 40, mid="m", is_new="1")]
    got = logs.repair_new_flag(log_df(spark, rows), mode)
    assert sorted(r.common.is_new for r in got.collect()) == want


def test_redelivered_first_row_keeps_one_flag(spark):
    rows = [log_row(1, 10, is_new="1")] * 3 + [log_row(2, 20, is_new="1"), log_row(3, 10 + DAY, is_new="1")]
    got = sorted((r.event_id, r.common.is_new) for r in logs.repair_new_flag(log_df(spark, rows)).collect())
    assert got == [(1, "0"), (1, "0"), (1, "1"), (2, "0"), (3, "1")]


def test_null_tiebreaks_tie(spark):
    rows = [log_row(None, 10, is_new="1", vc="a"), log_row(None, 10, is_new="1", vc="b")]
    got = [r.common.is_new for r in logs.repair_new_flag(log_df(spark, rows)).collect()]
    assert sorted(got) == ["0", "1"]


def test_partial_and_broken_records_are_quarantined(spark):
    raw = spark.createDataFrame([(x,) for x in ("not json", '{"event_id":2,"ts":"x"}', '{"event_id":3,', None,
                                                '{"event_id":4,"ts":5}', "{}")], "value string")
    good, bad = logs.parse_log(raw)
    assert sorted((r.event_id or 0) for r in good.collect()) == [0, 4]
    assert bad.count() == 4


def test_key_is_read_before_pruning(spark):
    rules = spark.createDataFrame([(1, "t", "insert", "hbase", "dim_t", "name", "id", None),
                                   (2, "u", "insert", "kafka", "u_topic", None, None, None)],
                                  "rule_seq int, source_table string, operate_type string, sink_type string, "
                                  "sink_table string, sink_columns string, sink_pk string, sink_extend string")
    recs = spark.createDataFrame([(1, "t", "insert", {"id": "7", "name": "n"}), (2, "t", "insert", {"name": "x"}),
                                  (3, "u", "insert", {"a": None, "b": "2"}), (4, "v", "insert", {"a": "1"})],
                                 "seq int, table string, type string, data map<string,string>")
    routed = cdc.route(recs, rules).cache()
    assert {r.seq: (r.route, r.reason) for r in routed.collect()} == {
        1: ("dim", None), 2: ("reject", "no key"), 3: ("fact", None), 4: ("reject", "no rule")}
    parts = cdc.split_routes(routed)
    change = cdc.dim_changes(parts["dim"]).first()
    assert change.pk == "7" and change.data == {"name": "n"}
    assert cdc.fact_payload(parts["fact"]).first().value == '{"b":"2"}'
    assert cdc.dim_current(cdc.dim_changes(parts["dim"])).filter(F.col("pk") == "7").count() == 1


def test_rules_without_an_order_are_refused(spark):
    ddl = "rule_seq int, source_table string, operate_type string, sink_type string, sink_table string"
    same = spark.createDataFrame([(0, "t", "insert", "kafka", "a")] * 2 + [(0, "u", "insert", "kafka", "b")], ddl)
    assert cdc.reduce_rules(same).count() == 2  # a rule listed twice is one rule
    later = spark.createDataFrame([(0, "t", "insert", "kafka", "a"), (1, "t", "insert", "kafka", "b")], ddl)
    assert cdc.reduce_rules(later).first().sink_table == "b"
    clash = spark.createDataFrame([(0, "t", "insert", "kafka", "a"), (0, "t", "insert", "kafka", "b")], ddl)
    with pytest.raises(Exception, match="without an order for t:insert"):
        cdc.reduce_rules(clash).collect()
