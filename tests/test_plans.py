"""Plan shapes that matter at scale."""

import contextlib
import io

import __spark_entry__ as E
from strata.operators import cdc, traffic
from strata.plans import batch
from strata.sources import fixtures as fx
from tests.conftest import SF


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_keyed_operators_are_partial_aggregations_not_windows(spark):
    page = batch.page_log(spark, SF)
    for df in (traffic.unique_visit(page), traffic.user_jump(page), batch.detail_logs(spark, SF)["page"]):
        p = plan(df)
        assert "Window" not in p
        assert "partial_" in p  # map-side pre-aggregation before the shuffle


def test_rules_are_the_broadcast_side(spark):
    recs = cdc.parse_cdc(cdc.etl_filter(fx.cdc_records(spark, SF)))
    p = plan(cdc.route(recs, fx.routing_rules(spark)))
    assert "BroadcastHashJoin" in p and "BuildRight" in p


def test_scans_are_pruned(spark):
    p = plan(E.queries()["unique_visit"](spark, SF))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line or "Scan parquet" in line]
    assert scan and all("props" not in line for line in scan)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct",
                          "dur_sum", "ts"]


def test_interval_joins_shuffle_on_the_order_id_when_nothing_is_small(spark):
    """The 100 TB shape: with broadcasts off, J1 and J2 are sort-merge joins keyed
    by the order id with the time range as a residual — never a nested loop."""
    from strata.operators import orders
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        wide = orders.join_order_lines(fx.order_info(spark, SF), fx.order_detail(spark, SF))
        p = plan(orders.payment_wide(fx.payment_info(spark, SF), wide))
        assert "NestedLoop" not in p and "Cartesian" not in p
        smj = [line for line in p.splitlines() if "SortMergeJoin" in line]
        assert any("[o_id" in line and "[d_order_id" in line for line in smj)
        assert any("[p_order_id" in line and "[w_order_id" in line for line in smj)
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
