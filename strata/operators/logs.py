"""Raw app log → detail layer: parse, new-visitor flag repair, three-way split.

The repair (K1) is expressed as a partial-aggregated ``groupBy(mid)`` plus an
equi-join rather than a window over ``mid``: a device holding a third of all
rows is pre-reduced map-side to one row, and the join's skewed side is split
by AQE instead of sorting one giant group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from strata import schemas as S
from strata.functions.columns import day_of_ms, non_empty_struct

LOG_KIND_START = "start"
LOG_KIND_PAGE = "page"


def parse_log(raw: DataFrame, value_col: str = "value", schema: str = S.LOG) -> tuple[DataFrame, DataFrame]:
    """JSON text → typed log rows; rows that fail to parse go to a quarantine frame.

    Returns ``(good, bad)``; ``bad`` keeps the original text.
    """
    parsed = raw.select(
        F.col(value_col).alias("_raw"),
        F.from_json(F.col(value_col), f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE",
                                                                    "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    # malformed text and values of the wrong type both fill ``_corrupt``; an object that lacks fields is no error
    bad_cond = F.col("_raw").isNull() | F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    good = parsed.filter(~bad_cond).select("r.*").drop("_corrupt")
    bad = parsed.filter(bad_cond).select(F.col("_raw").alias(value_col))
    return good, bad


def _split_top(ddl: str) -> list[str]:
    out, depth, cur = [], 0, ""
    for ch in ddl:
        if ch in "<(":
            depth += 1
        elif ch in ">)":
            depth -= 1
        if ch == "," and depth == 0:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
    if cur.strip():
        out.append(cur.strip())
    return out


def to_json_text(df: DataFrame, alias: str = "value") -> DataFrame:
    """Rows → JSON text (null fields are omitted, as the producer does)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(alias))


def is_start_log(start: str | Column = "start") -> Column:
    """The log carries a non-empty ``start`` object."""
    return non_empty_struct(start, S.START_FIELDS)


def repair_new_flag(log: DataFrame, mode: str = "same_day", tiebreak: str = "event_id") -> DataFrame:
    """K1: per device, only rows flagged new (``is_new='1'``) are looked at.

    The earliest such row (by ``ts``, then ``tiebreak``) fixes the device's
    first-visit day and keeps its flag. Any later new-flagged row is reset to
    ``'0'`` when its day equals that first day (``mode='same_day'``, as the
    original job behaves) or differs from it (``mode='other_day'``, as its
    comment describes). Of rows tied for the first place, one is first and the
    others are later ones. Rows not flagged new, and rows without a device,
    pass unchanged.
    """
    if mode not in ("same_day", "other_day"):
        raise ValueError("mode must be 'same_day' or 'other_day'")
    flagged = F.col("common.is_new") == F.lit("1")
    new_rows = log.filter(flagged)
    slim = new_rows.filter(F.col("common.mid").isNotNull()) \
        .select(F.col("common.mid").alias("_mid"), F.col("ts").alias("f_ts"), F.col(tiebreak).alias("f_tb"))
    per = slim.groupBy("_mid", "f_ts", "f_tb").agg(F.count("*").alias("f_n"))
    first = per.groupBy("_mid").agg(F.min(F.struct("f_ts", "f_tb", "f_n")).alias("_f"))
    j = new_rows.join(first, F.col("common.mid") == F.col("_mid"), "left")
    is_first = F.col("ts").eqNullSafe(F.col("_f.f_ts")) & F.col(tiebreak).eqNullSafe(F.col("_f.f_tb"))
    same = day_of_ms("ts") == day_of_ms("_f.f_ts")
    reset = F.col("_mid").isNotNull() & ~is_first & (same if mode == "same_day" else ~same)

    def with_flag(df: DataFrame, off: Column) -> DataFrame:
        return df.withColumn("common", F.col("common").withField(
            "is_new", F.when(off, F.lit("0")).otherwise(F.col("common.is_new")))).select(*log.columns)

    rest = log.filter(~flagged | F.col("common.is_new").isNull())
    if mode == "other_day":  # rows tied for the first place share its day
        return with_flag(j, reset).unionByName(rest)
    tied = F.coalesce(is_first & (F.col("_f.f_n") > 1), F.lit(False))
    return with_flag(j.filter(~tied), reset).unionByName(with_flag(_one_of_each(new_rows, first, tiebreak), F.col("_later"))) \
        .unionByName(rest)


def _one_of_each(new_rows: DataFrame, first: DataFrame, tiebreak: str) -> DataFrame:
    """Rows tied for their device's first place (a record delivered again), ``_later`` on all but one of a device.

    Equal rows are counted and the one with the least hash is first, so however many rows a device ties,
    they are reduced before the shuffle and never come together."""
    cols = new_rows.columns
    few = first.filter("_f.f_n > 1").select(F.col("_mid").alias("_t_mid"), "_f.f_ts", "_f.f_tb")
    t = new_rows.join(few, (F.col("common.mid") == F.col("_t_mid")) & F.col("ts").eqNullSafe(F.col("f_ts"))
                      & F.col(tiebreak).eqNullSafe(F.col("f_tb")))
    same = t.groupBy("_t_mid", F.sha2(F.to_json(F.struct(*cols)), 256).alias("_h")) \
        .agg(F.count("*").alias("_n"), F.first(F.struct(*cols)).alias("_row"))
    least = same.groupBy("_t_mid").agg(F.min("_h").alias("_least")).withColumnRenamed("_t_mid", "_l_mid")
    each = same.join(least, F.col("_t_mid") == F.col("_l_mid")) \
        .select("_row", "_h", "_least", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_at"))
    return each.select("_row.*", ((F.col("_h") != F.col("_least")) | (F.col("_at") > 1)).alias("_later"))


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """R1 + R2: start rows, page rows, and one display row per element of a page's ``displays``.

    Start logs go only to ``start`` (their displays are dropped); every other
    log goes to ``page``. A display row holds the element's own fields plus the
    page's ``page_id`` (a ``page_id`` field inside the element is overwritten).

    Where ``start`` and ``displays`` are ``VARIANT`` (``S.LOG_WHOLE``) any non-empty ``start``
    object makes a start log, and displays keep all their fields, as in the streaming form.
    """
    start = is_start_object() if isinstance(log.schema["start"].dataType, VariantType) else is_start_log()
    page = log.filter(~start)
    return {LOG_KIND_START: log.filter(start), LOG_KIND_PAGE: page, "display": explode_displays(page)}


def is_start_object(start: str = "start") -> Column:
    """The log carries a ``start`` object with any field at all."""
    return F.coalesce(F.to_json(start), F.lit("null")).isin("null", "{}") == F.lit(False)


def explode_displays(page: DataFrame) -> DataFrame:
    """R2 on page rows. ``VARIANT`` displays come out as ``value`` (JSON text of all fields) and ``page_id``."""
    if isinstance(page.schema["displays"].dataType, VariantType):
        shown = page.select(F.explode(F.try_variant_get("displays", "$", "array<variant>")).alias("_d"), F.col("page.page_id").alias("page_id"))
        fields = F.try_variant_get("_d", "$", "map<string,variant>")
        added = F.when(F.col("page_id").isNotNull(), F.create_map(F.lit("page_id"), F.col("page_id").cast("variant"))) \
            .otherwise(F.from_json(F.lit("{}"), "map<string,variant>"))
        return shown.filter(fields.isNotNull()).select(
            F.to_json(F.map_concat(F.map_filter(fields, lambda k, v: k != "page_id"), added)).alias("value"), "page_id")
    d = page.select(F.explode("displays").alias("_d"), F.col("page.page_id").alias("_page_id"))
    fields = [f.name for f in d.schema["_d"].dataType.fields]
    return d.select(*[F.col("_d").getField(f).alias(f) for f in fields if f != "page_id"],
                    F.col("_page_id").alias("page_id"))
