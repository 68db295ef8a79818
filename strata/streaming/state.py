"""Streaming forms of K1, K2 and K3 as Spark aggregations over keyed state.

No row is handled in Python and no device's rows come together: rows are reduced
before the shuffle, and the state store holds one value for each device (K1), device and
day (K2) or device and bucket (K3). What a device sends, in one micro-batch or
ever, is bounded by nothing and needs no bound.

K1 and K2 need the first row of a key *to arrive*; of those in the same micro-batch, the
earliest by (ts, id, place). The state keeps the minimum of (time of the
micro-batch, ts, id, place), and in update mode a key comes out whenever it gets rows: it is
new exactly when the minimum is of this micro-batch.

Columns of the keyed frame: ``value, mid, ts, id, is_new, day, entry``; ``id`` is
a struct that orders rows of the same time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.columns import day_of_ms, event_time, is_entry_page

_NO_ID = (1 << 63) - 1


def keyed(raw: DataFrame) -> DataFrame:
    """The keys the operators need; the JSON text itself stays as is. Rows of the same
    time are ordered by the record's sequence number (those without come last), then by their position in the topic."""
    j = lambda p: F.get_json_object("value", p)
    ts = j("$.ts").try_cast("bigint")
    seq = F.coalesce(j("$.event_id").try_cast("bigint"), F.lit(_NO_ID)).alias("seq")
    place = [F.col(f"pos.{c}") for c in ("at", "source", "row")] if "pos" in raw.columns else []
    return raw.select("value", j("$.common.mid").alias("mid"), ts.alias("ts"), F.struct(seq, *place).alias("id"),
                      j("$.common.is_new").alias("is_new"), day_of_ms(ts).alias("day"),
                      is_entry_page(j("$.page.last_page_id")).alias("entry"))


def _now() -> Column:
    """The micro-batch's own time: one value per batch, the same when it is retried."""
    return F.current_timestamp()


def first_flags(k: DataFrame) -> DataFrame:
    """K1, update mode: the rows of the micro-batch as they come (``row``), and for
    every device with a new-flagged row in it the first one ever (``first``)."""
    k = k.withColumn("born", _now())
    mark = F.struct("born", "ts", "id", "day")
    flagged = k.filter((F.col("is_new") == "1") & F.col("mid").isNotNull())
    first = flagged.groupBy("mid").agg(F.min(mark).alias("first"))
    row = F.struct(mark.alias("mark"), F.col("is_new"), F.col("value"))
    return k.select("mid", row.alias("row"), F.lit(None).cast(first.schema["first"].dataType).alias("first")) \
        .union(first.select("mid", F.lit(None).cast(k.select(row.alias("r")).schema["r"].dataType), "first"))


def repair_flags(rows: DataFrame, mode: str = "same_day") -> DataFrame:
    """K1 on one micro-batch of ``first_flags``, as a table: (value, is_new) with later new-flagged rows on the
    device's first day (``same_day``) or on other days (``other_day``) reset to ``'0'``."""
    if mode not in ("same_day", "other_day"):
        raise ValueError("mode must be 'same_day' or 'other_day'")
    first = rows.filter("first IS NOT NULL").select(F.col("mid").alias("_mid"), F.col("first").alias("_first"))
    new = F.col("row.is_new") == "1"
    flagged = rows.filter(F.col("row").isNotNull() & new & F.col("mid").isNotNull())
    others = rows.filter(F.col("row").isNotNull() & F.coalesce(~new | F.col("mid").isNull(), F.lit(True)))
    j = flagged.join(first, F.col("mid") == F.col("_mid"))
    same = F.col("row.mark.day").eqNullSafe(F.col("_first.day"))
    reset = ~F.col("row.mark").eqNullSafe(F.col("_first")) & (same if mode == "same_day" else ~same)
    return j.select("row.value", F.when(reset, F.lit("0")).otherwise(F.col("row.is_new")).alias("is_new")) \
        .unionByName(others.select("row.value", "row.is_new"))


def unique_visits(k: DataFrame, expiry_days: int = 1) -> DataFrame:
    """K2, update mode: ``value, mid`` of the first entry row of each device and day.

    State of a day goes ``expiry_days`` of event time after the day has ended (W5); rows of days that are
    gone are late and dropped, so a visit is never counted twice."""
    end = F.date_trunc("day", event_time("ts")) + F.expr("INTERVAL 1 DAY")
    e = k.filter(F.col("entry") & F.col("ts").isNotNull()).withColumn("born", _now()).withColumn("day_end", end) \
        .withWatermark("day_end", f"{expiry_days + 1} days")
    g = e.groupBy("mid", "day_end").agg(F.min(F.struct("born", "ts", "id", "value")).alias("first"))
    return g.filter(F.col("first.born") == _now()).select("first.value", "mid")


def bounces(k: DataFrame, within_ms: int = C.BOUNCE_WITHIN_MS) -> DataFrame:
    """K3, append mode: ``value, mid`` of the entry rows no row of the device follows within ``within_ms``.

    Time is cut into buckets of ``within_ms``: only the last row of a bucket can bounce, and its
    successor is the first row of the next one. So a row counts in its bucket, and its time is told to the bucket
    before. Both come under the next bucket's window, which closes when the watermark, the newest time, has passed it."""
    last = F.struct("ts", "id", "entry", F.when(F.col("entry"), F.col("value")).alias("value"))
    both = F.array(F.struct(event_time(F.col("ts") + within_ms).alias("et"), last.alias("last"), F.lit(None).cast("bigint").alias("next")),
                   F.struct(event_time("ts").alias("et"), F.when(F.lit(False), last).alias("last"), F.col("ts").alias("next")))
    told = k.filter("ts IS NOT NULL").select("mid", F.explode(both).alias("x")).select("mid", "x.*") \
        .withWatermark("et", f"{within_ms + 1} milliseconds")
    g = told.groupBy("mid", F.window("et", f"{within_ms} milliseconds")).agg(F.max("last").alias("last"), F.min("next").alias("next"))
    alone = F.col("next").isNull() | (F.col("next") - F.col("last.ts") >= within_ms)
    return g.filter(F.col("last.entry") & alone).select("last.value", "mid")
