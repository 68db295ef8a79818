"""Traffic middle/summary layer: unique visitors, bounces, visitor statistics.

Both keyed operators are written as partial aggregations instead of windows
over the device id, so a device holding a third of the rows never lands in a
single task:

* unique visit (K2) — ``groupBy(mid, day)`` keeping the earliest entry row;
* bounce (K3) — an entry event bounces iff no later event of its device falls
  within ``within_ms``. Cut time into buckets of ``within_ms``: an event that
  is not the last of its (device, bucket) has its successor in the same bucket,
  hence closer than ``within_ms``; the last one's successor is the first event
  of the next bucket, if that bucket has any. So one ``groupBy(mid, bucket)``
  (last row, first ts) and a second one, to which each bucket also reports its
  first ts under the bucket before it, decide it; the input is evaluated once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.columns import day_of_ms, event_time, format_ms, is_entry_page

STATS_DIMS = ("vc", "ch", "ar", "is_new")
MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def _order(tiebreak: str) -> Column:
    return F.struct(F.col("ts"), F.col(tiebreak))


def unique_visit(page_log: DataFrame, tiebreak: str = "event_id") -> DataFrame:
    """K2: the first entry page (P8) of each device and day.

    Same columns as the page log. The original keeps the first row to arrive;
    here the earliest by (ts, tiebreak), equal whenever input is in time order.
    """
    cols = page_log.columns
    entries = page_log.filter(is_entry_page())
    g = (entries.groupBy(F.col("common.mid").alias("_mid"), day_of_ms("ts").alias("_day"))
         .agg(F.min_by(F.struct(*cols), _order(tiebreak)).alias("_r")))
    return g.select("_r.*")


def user_jump(page_log: DataFrame, within_ms: int = C.BOUNCE_WITHIN_MS, tiebreak: str = "event_id") -> DataFrame:
    """K3 (C1 + C2): entry pages not followed by any event of the same device
    within ``within_ms`` (a successor exactly ``within_ms`` later still counts
    as a timeout). Same columns as the page log.
    """
    if within_ms <= 0:
        raise ValueError("within_ms must be positive")
    cols = page_log.columns
    b = F.floor(F.col("ts") / F.lit(within_ms)).cast("bigint")
    # only entry pages can come out, so the other rows carry no payload
    slim = page_log.select(F.col("common.mid").alias("_mid"), b.alias("_b"), "ts", F.col(tiebreak).alias("_tb"),
                           F.when(is_entry_page(), F.struct(*cols)).alias("_row"))
    per_bucket = slim.groupBy("_mid", "_b").agg(F.max_by("_row", F.struct("ts", "_tb")).alias("_last"),
                                                F.min("ts").alias("_first_ts"))
    own = F.struct("_b", "_last", F.lit(None).cast("bigint").alias("_next_ts"))
    told = F.struct((F.col("_b") - 1).alias("_b"), F.when(F.lit(False), F.col("_last")).alias("_last"),
                    F.col("_first_ts").alias("_next_ts"))
    both = per_bucket.select("_mid", F.explode(F.when(F.col("_b").isNull(), F.array(own)).otherwise(F.array(own, told))).alias("_x"))
    g = both.select("_mid", "_x.*").groupBy("_mid", "_b").agg(
        F.first("_last", ignorenulls=True).alias("_last"), F.min("_next_ts").alias("_next_ts"))
    bounce = F.col("_next_ts").isNull() | (F.col("_next_ts") - F.col("_last.ts") >= F.lit(within_ms))
    return g.filter(F.col("_last").isNotNull() & bounce).select("_last.*")


def to_stats(log: DataFrame, uv: int = 0, pv: int = 0, sv: int | Column = 0, uj: int = 0,
             dur: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One stats row per log row — the four dimensions, constant measures, ts
    (plus ``keep`` columns, e.g. a watermarked event time)."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return log.select(
        *[F.col(f"common.{d}").alias(d) for d in STATS_DIMS],
        lit(uv).cast("bigint").alias("uv_ct"), lit(pv).cast("bigint").alias("pv_ct"),
        lit(sv).cast("bigint").alias("sv_ct"), lit(uj).cast("bigint").alias("uj_ct"),
        (dur if dur is not None else F.lit(0)).cast("bigint").alias("dur_sum"),
        F.col("ts"), *[F.col(k) for k in keep])


def stats_pv(page_log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Page views with dwell time (Q11: a null during_time counts as 0)."""
    return to_stats(page_log, pv=1, dur=F.coalesce(F.col("page.during_time"), F.lit(0)), keep=keep)


def stats_uv(unique_rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return to_stats(unique_rows, uv=1, keep=keep)


def stats_sv(page_log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sessions: one per entry page."""
    return to_stats(page_log.filter(is_entry_page()), sv=1, keep=keep)


def stats_uj(jump_rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return to_stats(jump_rows, uj=1, keep=keep)


def stats_pv_sv(page_log: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The pv and sv legs read the same page log: one pass yields both measures."""
    entry = F.when(is_entry_page(), F.lit(1)).otherwise(F.lit(0))
    return to_stats(page_log, pv=1, sv=entry, dur=F.coalesce(F.col("page.during_time"), F.lit(0)), keep=keep)


def union_stats(*legs: DataFrame) -> DataFrame:
    """Bag union of same-shaped stats legs."""
    out = legs[0]
    for leg in legs[1:]:
        out = out.unionByName(leg)
    return out


def aggregate_stats(stats: DataFrame, window: str = C.STATS_WINDOW) -> DataFrame:
    """A1 + A2: per tumbling event-time window and (vc, ch, ar, is_new), sum the
    five measures; ``stt``/``edt`` are the window bounds as text (end exclusive),
    ``ts`` the earliest event time in the group. Partial aggregation map-side."""
    g = (stats.groupBy(F.window(event_time("ts"), window).alias("_w"), *STATS_DIMS)
         .agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES], F.min("ts").alias("ts")))
    return g.select(F.date_format("_w.start", C.TIME_FORMAT).alias("stt"),
                    F.date_format("_w.end", C.TIME_FORMAT).alias("edt"),
                    *STATS_DIMS, *MEASURES, "ts")


def visitor_stats(page_log: DataFrame, unique_rows: DataFrame, jump_rows: DataFrame,
                  window: str = C.STATS_WINDOW) -> DataFrame:
    """dws visitor stats from the page log and its two filtered streams."""
    return aggregate_stats(union_stats(stats_pv_sv(page_log), stats_uv(unique_rows), stats_uj(jump_rows)),
                           window)


__all__ = ["unique_visit", "user_jump", "to_stats", "stats_pv", "stats_uv", "stats_sv", "stats_uj",
           "stats_pv_sv", "union_stats", "aggregate_stats", "visitor_stats", "format_ms"]
