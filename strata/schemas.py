"""Typed shapes of every layer (Spark DDL strings, parsed on use)."""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

DISPLAY = "item STRING, item_type STRING, `order` INT, pos_id INT"
COMMON = "mid STRING, is_new STRING, vc STRING, ch STRING, ar STRING"
START = "entry STRING, loading_time BIGINT"
PAGE = "page_id STRING, last_page_id STRING, during_time BIGINT"

# Raw app log (ods_base_log). ``event_id`` is the arrival sequence, used as tiebreak.
LOG = (f"event_id BIGINT, common STRUCT<{COMMON}>, start STRUCT<{START}>, "
       f"page STRUCT<{PAGE}>, displays ARRAY<STRUCT<{DISPLAY}>>, ts BIGINT")
# The same with whole objects where the source may add fields.
LOG_WHOLE = (f"event_id BIGINT, common STRUCT<{COMMON}>, start VARIANT, "
             f"page STRUCT<{PAGE}>, displays VARIANT, ts BIGINT")
START_FIELDS = ("entry", "loading_time")

# Change record (ods_base_db_maxwell) once parsed; ``data`` stays an untyped object.
CDC = "seq BIGINT, `table` STRING, type STRING, data MAP<STRING, STRING>"
CDC_TEXT = "seq BIGINT, `table` STRING, type STRING, data STRING"

# Routing table (table_process).
TABLE_PROCESS = ("source_table STRING, operate_type STRING, sink_type STRING, sink_table STRING, "
                 "sink_columns STRING, sink_pk STRING, sink_extend STRING")

MONEY = "DECIMAL(16,2)"

ORDER_INFO = (f"id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, "
              f"total_amount {MONEY}, activity_reduce_amount {MONEY}, coupon_reduce_amount {MONEY}, "
              f"original_total_amount {MONEY}, feight_fee {MONEY}, expire_time STRING, create_time STRING, "
              f"operate_time STRING, create_date STRING, create_hour STRING, create_ts BIGINT")

ORDER_DETAIL = (f"id BIGINT, order_id BIGINT, sku_id BIGINT, order_price {MONEY}, sku_num BIGINT, "
                f"sku_name STRING, create_time STRING, split_total_amount {MONEY}, "
                f"split_activity_amount {MONEY}, split_coupon_amount {MONEY}, create_ts BIGINT")

PAYMENT_INFO = (f"id BIGINT, order_id BIGINT, user_id BIGINT, total_amount {MONEY}, subject STRING, "
                f"payment_type STRING, create_time STRING, callback_time STRING")

ORDER_WIDE_FIELDS = [
    ("detail_id", "BIGINT"), ("order_id", "BIGINT"), ("sku_id", "BIGINT"), ("order_price", MONEY),
    ("sku_num", "BIGINT"), ("sku_name", "STRING"), ("province_id", "BIGINT"), ("order_status", "STRING"),
    ("user_id", "BIGINT"), ("total_amount", MONEY), ("activity_reduce_amount", MONEY),
    ("coupon_reduce_amount", MONEY), ("original_total_amount", MONEY), ("feight_fee", MONEY),
    ("split_feight_fee", MONEY), ("split_activity_amount", MONEY), ("split_coupon_amount", MONEY),
    ("split_total_amount", MONEY), ("expire_time", "STRING"), ("create_time", "STRING"),
    ("operate_time", "STRING"), ("create_date", "STRING"), ("create_hour", "STRING"),
    ("province_name", "STRING"), ("province_area_code", "STRING"), ("province_iso_code", "STRING"),
    ("province_3166_2_code", "STRING"), ("user_age", "INT"), ("user_gender", "STRING"),
    ("spu_id", "BIGINT"), ("tm_id", "BIGINT"), ("category3_id", "BIGINT"), ("spu_name", "STRING"),
    ("tm_name", "STRING"), ("category3_name", "STRING"),
]
ORDER_WIDE = ", ".join(f"{n} {t}" for n, t in ORDER_WIDE_FIELDS)

_PAY_HEAD = [("payment_id", "BIGINT"), ("subject", "STRING"), ("payment_type", "STRING"),
             ("payment_create_time", "STRING"), ("callback_time", "STRING")]
_WIDE_NAMES = [n for n, _ in ORDER_WIDE_FIELDS]
_MID = ORDER_WIDE_FIELDS[_WIDE_NAMES.index("detail_id"):_WIDE_NAMES.index("split_total_amount") + 1]
_TAIL = ORDER_WIDE_FIELDS[_WIDE_NAMES.index("province_name"):]
PAYMENT_WIDE_FIELDS = _PAY_HEAD + _MID + [("order_create_time", "STRING")] + _TAIL
PAYMENT_WIDE = ", ".join(f"{n} {t}" for n, t in PAYMENT_WIDE_FIELDS)

VISITOR_STATS = ("stt STRING, edt STRING, vc STRING, ch STRING, ar STRING, is_new STRING, "
                 "uv_ct BIGINT, pv_ct BIGINT, sv_ct BIGINT, uj_ct BIGINT, dur_sum BIGINT, ts BIGINT")


def struct(ddl: str) -> StructType:
    t = _parse_datatype_string(ddl)
    assert isinstance(t, StructType)
    return t
