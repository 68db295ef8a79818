"""Whole batch DAGs: raw tables → detail → middle → summary, one Catalyst plan each.

These are what a scheduled batch run (or a backfill) executes; the
streaming jobs in ``strata.streaming`` produce the same rows incrementally.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata import config as C
from strata.config import checkpoint_dir, gone_on_exit
from strata.operators import cdc, logs, orders, traffic
from strata.sources import fixtures as fx

# Fixed "now" for repeatable ages (F3); a live job passes the wall clock.
AGE_NOW_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def detail_logs(spark: SparkSession, sf_dir: str, mode: str = "same_day") -> dict[str, DataFrame]:
    """ods log → K1 flag repair → start / page / display."""
    return logs.split_log(logs.repair_new_flag(fx.ods_log(spark, sf_dir), mode=mode))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a layer table into the session's shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of
    recomputing the upstream shuffles) and lets each consumer prune columns.
    The table goes when the session ends.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/strata-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    gone_on_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PAGE_STATS_COLUMNS = ("event_id", "common", "page", "ts")


def page_log(spark: SparkSession, sf_dir: str, materialized: bool = False,
             columns: tuple[str, ...] | None = None) -> DataFrame:
    page = detail_logs(spark, sf_dir)[logs.LOG_KIND_PAGE]
    if columns:
        page = page.select(*columns)
    return materialize(page, "dwd_page_log") if materialized else page


def visitor_stats(spark: SparkSession, sf_dir: str, window: str = C.STATS_WINDOW,
                  within_ms: int = C.BOUNCE_WITHIN_MS) -> DataFrame:
    """The flagship DAG: raw log to windowed visitor statistics.

    The page log feeds three legs, so it is computed once and materialized;
    the legs read only the columns the statistics need.
    """
    page = page_log(spark, sf_dir, materialized=True, columns=PAGE_STATS_COLUMNS)
    return traffic.visitor_stats(page, traffic.unique_visit(page), traffic.user_jump(page, within_ms), window)


def routed_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ods change records → ETL filter → routing (tagged fact | dim | reject)."""
    recs = cdc.parse_cdc(cdc.etl_filter(fx.cdc_records(spark, sf_dir)))
    return cdc.route(recs, fx.routing_rules(spark))


def dimension_current(spark: SparkSession, sf_dir: str, apply_deletes: bool = False) -> DataFrame:
    routed = routed_cdc(spark, sf_dir)
    return cdc.dim_current(cdc.dim_changes(cdc.split_routes(routed)[cdc.ROUTE_DIM]), apply_deletes)


def order_dims(spark: SparkSession, sf_dir: str, which: tuple[str, ...] = (
        "user", "province", "sku", "spu", "category3", "trademark")) -> dict[str, DataFrame]:
    build = {"user": fx.dim_user, "province": fx.dim_province, "sku": fx.dim_sku, "spu": fx.dim_spu,
             "category3": fx.dim_category3, "trademark": fx.dim_trademark}
    return {k: build[k](spark, sf_dir) for k in which}


def order_wide(spark: SparkSession, sf_dir: str, which: tuple[str, ...] | None = None) -> DataFrame:
    dims = order_dims(spark, sf_dir) if which is None else order_dims(spark, sf_dir, which)
    return orders.order_wide(fx.order_info(spark, sf_dir), fx.order_detail(spark, sf_dir), dims, AGE_NOW_MS)


def payment_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orders.join_order_lines(fx.order_info(spark, sf_dir), fx.order_detail(spark, sf_dir))
    return orders.payment_wide(fx.payment_info(spark, sf_dir), lines,
                               specs=orders.order_dim_specs(order_dims(spark, sf_dir), AGE_NOW_MS))
