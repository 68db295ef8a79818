"""DuckDB oracle SQL for every registered query.

Written the direct way (window functions, ``lead``, ``row_number``) over the
same driver tables, independently of the Spark plans it checks. Times are UTC;
epoch millis use ``epoch_us(x)//1000`` (floor, as Spark) — never ``epoch_ms``
on a timestamp, which rounds.
"""

from __future__ import annotations

from strata import schemas as S
from strata.plans.batch import AGE_NOW_MS
from strata.plans.catalog import CHANGED_RULES, LONG_WITHIN_MS
from strata.sources.fixtures import ROUTING_RULES

_TF = "'%Y-%m-%d %H:%M:%S'"


def _fmt(ms: str, f: str = _TF) -> str:
    return f"strftime(epoch_ms({ms}), {f})"


# --- fixture views ------------------------------------------------------------

FX_LOG = """fx_log AS (
  SELECT event_id, 'm' || CAST(user_id AS VARCHAR) AS mid, (epoch_us(ts) // 1000) AS ts,
    strftime(ts, '%Y%m%d') AS day,
    CASE WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS log_kind,
    CASE WHEN event_type <> 'signup' THEN event_type END AS page_id,
    CASE WHEN event_type <> 'signup' THEN
      CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN '' ELSE 'home' END END AS last_page_id,
    CASE WHEN event_id % 2 = 0 THEN '1' ELSE '0' END AS is_new,
    'v' || CAST(user_id % 3 AS VARCHAR) AS vc, 'ch' || CAST(user_id % 4 AS VARCHAR) AS ch,
    'ar' || CAST(user_id % 7 AS VARCHAR) AS ar,
    CASE WHEN event_id % 11 = 10 THEN NULL ELSE CAST(floor(value * 1000) AS BIGINT) END AS during_time,
    CASE WHEN event_id % 8 = 0 THEN 0 ELSE event_id % 4 END AS n_displays,
    CASE WHEN event_type = 'signup' THEN ['icon', 'notice', 'install'][CAST(user_id % 3 AS INTEGER) + 1] END AS entry
  FROM events)"""


def fx_log_k1(mode: str = "same_day") -> str:
    cmp = "=" if mode == "same_day" else "<>"
    return f"""fx_log_k1 AS (
  SELECT * EXCLUDE (rn, f_day) REPLACE (CASE WHEN is_new = '1' AND mid IS NOT NULL AND rn > 1 AND day {cmp} f_day
                                        THEN '0' ELSE is_new END AS is_new)
  FROM (SELECT *, row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, event_id) AS rn,
               first_value(day) OVER (PARTITION BY mid, is_new ORDER BY ts, event_id) AS f_day FROM fx_log)),
page_log AS (SELECT * FROM fx_log_k1 WHERE log_kind = 'page')"""


PAGE_COLS = "event_id, mid, ts, day, is_new, vc, ch, ar, page_id, last_page_id, during_time"


def _uv() -> str:
    return f"""uv_rows AS (SELECT {PAGE_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, day ORDER BY ts, event_id) AS rn
  FROM page_log WHERE coalesce(last_page_id, '') = '') WHERE rn = 1)"""


def _uj(within_ms: int) -> str:
    return f"""uj_rows AS (SELECT {PAGE_COLS} FROM (
  SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS next_ts FROM page_log)
  WHERE coalesce(last_page_id, '') = '' AND (next_ts IS NULL OR next_ts - ts >= {within_ms}))"""


_LEG = ("SELECT vc, ch, ar, is_new, CAST({uv} AS BIGINT) AS uv_ct, CAST({pv} AS BIGINT) AS pv_ct, "
        "CAST({sv} AS BIGINT) AS sv_ct, CAST({uj} AS BIGINT) AS uj_ct, CAST({dur} AS BIGINT) AS dur_sum, ts FROM {src}")
LEG_PV = _LEG.format(uv=0, pv=1, sv=0, uj=0, dur="coalesce(during_time, 0)", src="page_log")
LEG_UV = _LEG.format(uv=1, pv=0, sv=0, uj=0, dur=0, src="uv_rows")
LEG_SV = _LEG.format(uv=0, pv=0, sv=1, uj=0, dur=0, src="page_log WHERE coalesce(last_page_id, '') = ''")
LEG_UJ = _LEG.format(uv=0, pv=0, sv=0, uj=1, dur=0, src="uj_rows")


def _traffic_prefix(within_ms: int = 10_000, mode: str = "same_day") -> str:
    return f"WITH {FX_LOG},\n{fx_log_k1(mode)},\n{_uv()},\n{_uj(within_ms)}\n"


def visitor_stats_sql(window_ms: int, within_ms: int) -> str:
    w = window_ms
    return _traffic_prefix(within_ms) + f""", legs AS ({LEG_PV} UNION ALL {LEG_UV} UNION ALL {LEG_SV} UNION ALL {LEG_UJ}),
g AS (SELECT ts - (ts % {w}) AS stt_ms, vc, ch, ar, is_new, sum(uv_ct) AS uv_ct, sum(pv_ct) AS pv_ct,
        sum(sv_ct) AS sv_ct, sum(uj_ct) AS uj_ct, sum(dur_sum) AS dur_sum, min(ts) AS ts
      FROM legs GROUP BY ALL)
SELECT {_fmt('stt_ms')} AS stt, {_fmt(f'stt_ms + {w}')} AS edt, vc, ch, ar, is_new,
  CAST(uv_ct AS BIGINT) AS uv_ct, CAST(pv_ct AS BIGINT) AS pv_ct, CAST(sv_ct AS BIGINT) AS sv_ct,
  CAST(uj_ct AS BIGINT) AS uj_ct, CAST(dur_sum AS BIGINT) AS dur_sum, ts FROM g"""


# --- change records ---------------------------------------------------------

def _sqlv(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def _rule_rows(rules: list[tuple]) -> str:
    return ",\n    ".join("(" + ", ".join(_sqlv(v) for v in r) + ")" for r in rules)


_RULE_ROWS = _rule_rows(ROUTING_RULES)

FX_CDC = """fx_cdc AS (
  SELECT c_custkey * 3 AS seq, 'user_info' AS "table",
    CASE c_custkey % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'bootstrap-insert' WHEN 2 THEN 'update' ELSE 'delete' END AS type,
    CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN '{}'
      ELSE '{"id":"' || CAST(c_custkey % 300 AS VARCHAR) || '","name":"' || c_name || '","seg":"' || c_mktsegment || '"}' END AS data
  FROM customer
  UNION ALL
  SELECT p_partkey * 3 + 1, 'sku_info',
    CASE p_partkey % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END,
    CASE WHEN p_partkey % 3 = 1 THEN '{"id":"' || CAST(p_partkey % 500 AS VARCHAR) || '","sku_name":"' || p_name || '"}'
      ELSE '{"id":"' || CAST(p_partkey % 500 AS VARCHAR) || '","sku_name":"' || p_name || '","tm_id":"' || substr(p_brand, 7, 16) || '"}' END
  FROM part
  UNION ALL
  SELECT o_orderkey * 3 + 2, 'order_info', CASE WHEN o_orderkey % 5 = 0 THEN 'update' ELSE 'insert' END,
    '{"id":' || CAST(o_orderkey AS VARCHAR) || ',"user_id":' || CAST(o_custkey AS VARCHAR) || ',"order_status":"' ||
    o_orderstatus || '","total_amount":"' || CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) || '"}'
  FROM orders)"""

ROUTED = f"""{FX_CDC},
rules AS (SELECT * FROM (VALUES
    {_RULE_ROWS}) t(rule_seq, source_table, operate_type, sink_type, sink_table, sink_columns, sink_pk, sink_extend)),
rules1 AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY source_table, operate_type ORDER BY rule_seq DESC) AS rn FROM rules) WHERE rn = 1),
etl AS (SELECT seq, "table", type AS raw_type, CASE WHEN type = 'bootstrap-insert' THEN 'insert' ELSE type END AS type, data
  FROM fx_cdc WHERE "table" IS NOT NULL AND data IS NOT NULL AND length(data) >= 3),
routed AS (
  SELECT e.seq, e."table", e.type, e.data, r.source_table AS rt, r.sink_type, r.sink_table, r.sink_columns, r.sink_pk,
    CASE WHEN r.source_table IS NOT NULL AND r.sink_type = 'kafka' THEN 'fact'
         WHEN r.source_table IS NOT NULL AND r.sink_type = 'hbase' THEN 'dim' ELSE 'reject' END AS route,
    list_filter(json_keys(e.data), lambda k: r.source_table IS NULL OR coalesce(r.sink_columns, '') = ''
                OR list_contains(string_split(r.sink_columns, ','), k)) AS keys
  FROM etl e LEFT JOIN rules1 r ON e."table" = r.source_table AND e.type = r.operate_type),
kv AS (SELECT seq, route, sink_table, sink_pk, type, k AS "column",
         json_extract_string(data, '$."' || k || '"') AS value
       FROM (SELECT *, unnest(keys) AS k FROM routed)),
dimc AS (SELECT r.seq, upper(r.sink_table) AS dim_table, r.type AS op,
           (SELECT value FROM kv WHERE kv.seq = r.seq AND kv."column" = coalesce(r.sink_pk, 'id')) AS pk
         FROM routed r WHERE route = 'dim' AND len(keys) > 0),
dim_cur AS (SELECT dim_table, pk, "column", value FROM (
  SELECT d.dim_table, d.pk, kv."column", kv.value,
    row_number() OVER (PARTITION BY d.dim_table, d.pk, kv."column" ORDER BY d.seq DESC) AS rn
  FROM dimc d JOIN kv ON kv.seq = d.seq WHERE d.pk IS NOT NULL) WHERE rn = 1)"""


def route_sql(kind: str) -> str:
    return f"""WITH {ROUTED}
SELECT seq, "table" AS source_table, type AS op_type, sink_type, sink_table,
  array_to_string(keys, ',') AS kept_keys FROM routed WHERE route = '{kind}'"""


DIM_DELETES = """, dim_last AS (SELECT dim_table, pk FROM (
  SELECT dim_table, pk, op, row_number() OVER (PARTITION BY dim_table, pk ORDER BY seq DESC) AS rn
  FROM dimc WHERE pk IS NOT NULL) WHERE rn = 1 AND op = 'delete')"""


# --- orders -----------------------------------------------------------------

FX_ORDERS = f"""fx_oi0 AS (SELECT o_orderkey AS id, o_custkey % 26 AS province_id, o_orderstatus AS order_status,
    o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
    (epoch_us(o_orderdate) // 1000) + (o_orderkey % 86400) * 1000 AS create_ts FROM orders),
fx_order_info AS (SELECT id, province_id, order_status, user_id, total_amount,
    CAST(NULL AS DECIMAL(16,2)) AS activity_reduce_amount, CAST(NULL AS DECIMAL(16,2)) AS coupon_reduce_amount,
    total_amount AS original_total_amount, CAST(NULL AS DECIMAL(16,2)) AS feight_fee,
    {_fmt('create_ts')} AS create_time, {_fmt('create_ts', "'%Y-%m-%d'")} AS create_date, create_ts FROM fx_oi0),
fx_order_detail AS (SELECT l_orderkey * 100 + l_linenumber AS id, l_orderkey AS order_id,
    CASE WHEN l_partkey % 50 = 0 THEN -l_partkey ELSE l_partkey END AS sku_id,
    CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
    'line sku ' || CAST(l_partkey AS VARCHAR) AS sku_name, CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount,
    CAST(NULL AS DECIMAL(16,2)) AS split_activity_amount, CAST(NULL AS DECIMAL(16,2)) AS split_coupon_amount,
    (epoch_us(o_orderdate) // 1000) + (o_orderkey % 86400) * 1000 + (l_linenumber - 4) * 5 AS create_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
fx_payment AS (SELECT id, id AS order_id, user_id, total_amount, 'pay ' || CAST(id AS VARCHAR) AS subject,
    ['alipay', 'wechat', 'card'][CAST(id % 3 AS INTEGER) + 1] AS payment_type,
    {_fmt('cb - 30000')} AS create_time, {_fmt('cb')} AS callback_time, cb AS callback_ts
  FROM (SELECT *, create_ts + ((id * 60) % 3600 - 600) * 1000 AS cb FROM fx_oi0 WHERE order_status = 'F')),
fx_dim_user AS (SELECT CAST(c_custkey AS VARCHAR) AS id,
    strftime(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%d') AS birthday,
    CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender FROM customer),
fx_dim_province AS (SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS area_code,
    'ISO-' || CAST(n_nationkey AS VARCHAR) AS iso_code, 'CN-' || CAST(n_nationkey AS VARCHAR) AS iso_3166_2
  FROM nation),
fx_dim_sku AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, CAST(p_partkey % 66 AS VARCHAR) AS spu_id,
    CASE WHEN CAST(substr(p_brand, 7, 16) AS INTEGER) % 7 = 3 THEN '9' ELSE '' END || substr(p_brand, 7, 16) AS tm_id,
    CAST(CASE WHEN p_size % 9 = 0 THEN p_size + 1000 ELSE p_size END AS VARCHAR) AS category3_id FROM part),
fx_dim_spu AS (SELECT CAST(k AS VARCHAR) AS id, 'SPU-' || CAST(k AS VARCHAR) AS spu_name
  FROM (SELECT DISTINCT p_partkey % 64 AS k FROM part)),
fx_dim_category3 AS (SELECT CAST(p_size AS VARCHAR) AS id, 'CAT-' || CAST(p_size AS VARCHAR) || '-' || min(p_type) AS name
  FROM part GROUP BY p_size),
fx_dim_trademark AS (SELECT substr(p_brand, 7, 16) AS id, upper(p_brand) AS tm_name
  FROM (SELECT DISTINCT p_brand FROM part))"""

_DUCK_T = {"STRING": "VARCHAR"}


def _t(t: str) -> str:
    return _DUCK_T.get(t, t)


J1_SRC = {"detail_id": "d.id", "order_id": "o.id", "sku_id": "d.sku_id", "order_price": "d.order_price",
          "sku_num": "d.sku_num", "sku_name": "d.sku_name", "province_id": "o.province_id",
          "order_status": "o.order_status", "user_id": "o.user_id", "total_amount": "o.total_amount",
          "activity_reduce_amount": "o.activity_reduce_amount", "coupon_reduce_amount": "o.coupon_reduce_amount",
          "original_total_amount": "o.original_total_amount", "feight_fee": "o.feight_fee",
          "split_activity_amount": "d.split_activity_amount", "split_coupon_amount": "d.split_coupon_amount",
          "split_total_amount": "d.split_total_amount", "create_time": "o.create_time",
          "create_date": "o.create_date"}


def _j1() -> str:
    cols = ",\n    ".join(f"CAST({J1_SRC.get(n, 'NULL')} AS {_t(t)}) AS {n}" for n, t in S.ORDER_WIDE_FIELDS)
    return f"""j1 AS (SELECT {cols},
    o.create_ts AS create_ts
  FROM fx_order_info o JOIN fx_order_detail d
    ON o.id = d.order_id AND d.create_ts BETWEEN o.create_ts - 5 AND o.create_ts + 5)"""


def _dims_sql(which: tuple[str, ...]) -> str:
    """Wide rows after the chosen lookups (in the original order)."""
    rep, joins = [], []
    if "user" in which:
        joins.append("LEFT JOIN fx_dim_user u ON CAST(w.user_id AS VARCHAR) = u.id")
        rep.append(f"CASE WHEN u.id IS NOT NULL THEN CAST(({AGE_NOW_MS} - epoch_us(strptime(u.birthday, '%Y-%m-%d')) // 1000)"
                   f" // 31536000000 AS INTEGER) ELSE w.user_age END AS user_age")
        rep.append("CASE WHEN u.id IS NOT NULL THEN (CASE WHEN u.gender = 'M' THEN '男' WHEN u.gender IS NOT NULL "
                   "THEN '女' END) ELSE w.user_gender END AS user_gender")
    if "province" in which:
        joins.append("LEFT JOIN fx_dim_province p ON CAST(w.province_id AS VARCHAR) = p.id")
        for out, c in (("province_name", "name"), ("province_area_code", "area_code"),
                       ("province_iso_code", "iso_code"), ("province_3166_2_code", "iso_3166_2")):
            rep.append(f"CASE WHEN p.id IS NOT NULL THEN p.{c} ELSE w.{out} END AS {out}")
    step = "SELECT w.* REPLACE ({}) FROM {} w {}"
    parts = []
    src = "j1"
    if rep:
        parts.append(f"s1 AS ({step.format(', '.join(rep), src, ' '.join(joins))})")
        src = "s1"
    if "sku" in which:
        rep2 = ["CASE WHEN s.id IS NOT NULL THEN s.sku_name ELSE w.sku_name END AS sku_name",
                "CASE WHEN s.id IS NOT NULL THEN CAST(s.spu_id AS BIGINT) ELSE w.spu_id END AS spu_id",
                "CASE WHEN s.id IS NOT NULL THEN CAST(s.category3_id AS BIGINT) ELSE w.category3_id END AS category3_id",
                "CASE WHEN s.id IS NOT NULL THEN CAST(s.tm_id AS BIGINT) ELSE w.tm_id END AS tm_id"]
        parts.append(f"s2 AS ({step.format(', '.join(rep2), src, 'LEFT JOIN fx_dim_sku s ON CAST(w.sku_id AS VARCHAR) = s.id')})")
        src = "s2"
        rep3 = ["CASE WHEN sp.id IS NOT NULL THEN sp.spu_name ELSE w.spu_name END AS spu_name",
                "CASE WHEN c3.id IS NOT NULL THEN c3.name ELSE w.category3_name END AS category3_name",
                "CASE WHEN tm.id IS NOT NULL THEN tm.tm_name ELSE w.tm_name END AS tm_name"]
        j3 = ("LEFT JOIN fx_dim_spu sp ON CAST(w.spu_id AS VARCHAR) = sp.id "
              "LEFT JOIN fx_dim_category3 c3 ON CAST(w.category3_id AS VARCHAR) = c3.id "
              "LEFT JOIN fx_dim_trademark tm ON CAST(w.tm_id AS VARCHAR) = tm.id")
        parts.append(f"s3 AS ({step.format(', '.join(rep3), src, j3)})")
        src = "s3"
    parts.append(f"ow AS (SELECT * FROM {src})")
    return ",\n".join(parts)


def order_sql(which: tuple[str, ...]) -> str:
    return f"WITH {FX_ORDERS},\n{_j1()},\n{_dims_sql(which)}\nSELECT * FROM ow"


PAY_SRC = {"payment_id": "p.id", "subject": "p.subject", "payment_type": "p.payment_type",
           "payment_create_time": "p.create_time", "callback_time": "p.callback_time", "order_id": "p.order_id",
           "user_id": "p.user_id", "total_amount": "p.total_amount", "order_create_time": "w.create_time"}


def payment_sql(which: tuple[str, ...], cols: list[str] | None = None) -> str:
    sel = ",\n  ".join(f"CAST({PAY_SRC.get(n, 'w.' + n)} AS {_t(t)}) AS {n}" for n, t in S.PAYMENT_WIDE_FIELDS
                       if cols is None or n in cols)
    return f"""WITH {FX_ORDERS},
{_j1()},
{_dims_sql(which)}
SELECT {sel}
FROM fx_payment p JOIN ow w ON p.order_id = w.order_id
  AND w.create_ts BETWEEN p.callback_ts - 1800000 AND p.callback_ts"""


MERGE_FIELDS = ["order_status", "create_time", "create_date", "coupon_reduce_amount", "activity_reduce_amount",
                "original_total_amount", "feight_fee", "total_amount", "user_id", "sku_id", "sku_name",
                "order_price", "sku_num"]
LINE_SRC = {"detail_id": "d.id", "order_id": "d.order_id", "sku_id": "d.sku_id", "order_price": "d.order_price",
            "sku_num": "d.sku_num", "sku_name": "d.sku_name", "split_total_amount": "d.split_total_amount",
            "split_activity_amount": "d.split_activity_amount", "split_coupon_amount": "d.split_coupon_amount"}
HEAD_SRC = {"order_status": "o.order_status", "create_time": "o.create_time", "create_date": "o.create_date",
            "coupon_reduce_amount": "o.coupon_reduce_amount", "activity_reduce_amount": "o.activity_reduce_amount",
            "original_total_amount": "o.original_total_amount", "feight_fee": "o.feight_fee",
            "total_amount": "o.total_amount", "user_id": "o.user_id"}


def merge_sql() -> str:
    cols = []
    for n, t in S.ORDER_WIDE_FIELDS:
        own = LINE_SRC.get(n, "NULL")
        if n in MERGE_FIELDS:
            cols.append(f"CAST(coalesce({own}, {HEAD_SRC.get(n, 'NULL')}) AS {_t(t)}) AS {n}")
        else:
            cols.append(f"CAST({own} AS {_t(t)}) AS {n}")
    return f"""WITH {FX_ORDERS}
SELECT {', '.join(cols)}
FROM fx_order_detail d LEFT JOIN fx_order_info o ON d.order_id = o.id"""


def oracle_sql() -> dict[str, str]:
    tp = _traffic_prefix
    q: dict[str, str] = {}
    flag = ("SELECT event_id, mid, ts, day, is_new, vc, ch, ar, log_kind FROM fx_log_k1")
    q["visitor_flag_repair"] = f"WITH {FX_LOG},\n{fx_log_k1('same_day')}\n{flag}"
    q["visitor_flag_repair_other_day"] = f"WITH {FX_LOG},\n{fx_log_k1('other_day')}\n{flag}"
    q["log_parse"] = f"WITH {FX_LOG}\nSELECT event_id, mid, ts, day, is_new, vc, ch, ar, log_kind FROM fx_log"
    q["log_start"] = (f"WITH {FX_LOG},\n{fx_log_k1()}\nSELECT event_id, mid, ts, is_new, vc, ch, ar, entry, "
                      f"during_time AS loading_time FROM fx_log_k1 WHERE log_kind = 'start'")
    q["log_page"] = f"WITH {FX_LOG},\n{fx_log_k1()}\nSELECT {PAGE_COLS} FROM page_log"
    q["log_display"] = (f"WITH {FX_LOG},\n{fx_log_k1()}\n"
                        "SELECT page_id, CAST(event_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS item, "
                        "'sku_id' AS item_type, CAST(i + 1 AS INTEGER) AS \"order\", "
                        "CAST((event_id + i) % 5 AS INTEGER) AS pos_id "
                        "FROM (SELECT *, unnest(range(n_displays)) AS i FROM page_log WHERE n_displays > 0)")
    q["unique_visit"] = tp() + "SELECT * FROM uv_rows"
    q["user_jump"] = tp(10_000) + "SELECT * FROM uj_rows"
    q["user_jump_long"] = tp(LONG_WITHIN_MS) + "SELECT * FROM uj_rows"
    q["stats_pv"] = tp() + LEG_PV
    q["stats_uv"] = tp() + LEG_UV
    q["stats_sv"] = tp() + LEG_SV
    q["stats_uj"] = tp() + LEG_UJ
    q["stats_union"] = tp() + f"{LEG_PV} UNION ALL {LEG_UV} UNION ALL {LEG_SV} UNION ALL {LEG_UJ}"
    q["visitor_stats_10s"] = visitor_stats_sql(10_000, 10_000)
    q["visitor_stats_1d"] = visitor_stats_sql(86_400_000, LONG_WITHIN_MS)
    q["etl_filter_cdc"] = (f"WITH {ROUTED}\nSELECT seq, \"table\" AS source_table, raw_type, type AS op_type FROM etl")
    q["route_facts"] = route_sql("fact")
    q["route_dims"] = route_sql("dim")
    q["route_rejects"] = route_sql("reject")
    q["route_values"] = f"WITH {ROUTED}\nSELECT seq, sink_table, \"column\", value FROM kv WHERE route <> 'reject'"
    q["fact_payload"] = (f"WITH {ROUTED}\nSELECT seq, sink_table AS topic, "
                         "CAST(json_extract_string(data, '$.id') AS BIGINT) AS id, "
                         "CAST(json_extract_string(data, '$.user_id') AS BIGINT) AS user_id, "
                         "CAST(json_extract_string(data, '$.total_amount') AS DECIMAL(16,2)) AS total_amount, "
                         "json_extract_string(data, '$.order_status') AS order_status FROM routed WHERE route = 'fact'")
    q["dim_current"] = f"WITH {ROUTED}\nSELECT * FROM dim_cur"
    q["dim_current_deletes"] = (f"WITH {ROUTED}{DIM_DELETES}\nSELECT * FROM dim_cur c WHERE NOT EXISTS "
                                "(SELECT 1 FROM dim_last l WHERE l.dim_table = c.dim_table AND l.pk = c.pk)")
    q["dim_user_current"] = (f"WITH {ROUTED}\nSELECT pk, max(CASE WHEN \"column\" = 'id' THEN value END) AS id, "
                             "max(CASE WHEN \"column\" = 'name' THEN value END) AS name, "
                             "max(CASE WHEN \"column\" = 'seg' THEN value END) AS seg "
                             "FROM dim_cur WHERE dim_table = 'DIM_USER_INFO' GROUP BY pk")
    q["dim_schemas"] = f"""WITH {ROUTED},
cols AS (SELECT upper(sink_table) AS dim_table, coalesce(sink_pk, 'id') AS pk, coalesce(sink_extend, '') AS extend,
           unnest(string_split(sink_columns, ',')) AS "column",
           generate_subscripts(string_split(sink_columns, ','), 1) - 1 AS position
         FROM rules1 WHERE sink_type = 'hbase' AND operate_type = 'insert' AND coalesce(sink_columns, '') <> ''),
g AS (SELECT dim_table, "column", CAST(min(position) AS INTEGER) AS position, first(pk) AS pk, first(extend) AS extend
      FROM cols GROUP BY dim_table, "column")
SELECT h.dim_table, h."column", g.position, coalesce(h."column" = g.pk, false) AS is_pk, g.extend
FROM (SELECT DISTINCT dim_table, "column" FROM dim_cur) h LEFT JOIN g ON g.dim_table = h.dim_table AND g."column" = h."column\""""
    q["rules_scan"] = f"""WITH {ROUTED}
SELECT r.source_table AS "sourceTable", r.operate_type AS "operateType", r.sink_type AS "sinkType", r.sink_table AS "sinkTable",
  r.sink_columns AS "sinkColumns", r.sink_pk AS "sinkPk",
  (SELECT count(*) FROM etl e WHERE e."table" = r.source_table AND e.type = r.operate_type) AS records FROM rules1 r"""
    q["page_named"] = f"""WITH {FX_LOG} SELECT * FROM (SELECT event_id, CASE event_id % 13 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE page_id END AS page_id
FROM fx_log) WHERE coalesce(page_id, '') <> ''"""
    q["record_account"] = f"""WITH {ROUTED},
a AS (SELECT CASE WHEN c.seq % 97 IN (1, 6) THEN 'malformed' WHEN c.seq % 97 IN (2, 4) THEN 'wrong type' WHEN c.seq % 97 = 3 THEN 'no text'
        WHEN c.seq % 97 = 5 THEN 'no table' WHEN c.seq % 97 = 7 OR coalesce(c.data, '{{}}') = '{{}}' THEN 'no data' END AS broken,
        r.rt, r.sink_type, c."table", CASE WHEN c.type = 'bootstrap-insert' THEN 'insert' ELSE c.type END AS type
      FROM fx_cdc c LEFT JOIN routed r ON r.seq = c.seq)
SELECT coalesce(broken, CASE WHEN rt IS NULL THEN 'no rule' WHEN sink_type = 'kafka' THEN 'fact' WHEN sink_type = 'hbase' THEN 'dim'
         ELSE 'unknown sink type' END) AS outcome,
  CASE WHEN broken IS NULL THEN "table" END AS "table", CASE WHEN broken IS NULL THEN type END AS type, count(*) AS records
FROM a GROUP BY ALL"""
    q["dim_lookup_composite"] = """WITH f AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 5 < 4 THEN c_custkey % 5 END AS tier FROM customer),
s AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey, tier ORDER BY s_suppkey) AS rn
      FROM (SELECT s_nationkey, s_suppkey, s_name, CASE WHEN s_suppkey % 4 < 3 THEN s_suppkey % 4 END AS tier FROM supplier))
SELECT f.*, p.s_suppkey AS partner_id, p.s_name AS partner_name, CASE WHEN f.tier IS NOT NULL THEN p.s_suppkey END AS strict_id
FROM f LEFT JOIN (SELECT * FROM s WHERE rn = 1) p ON p.s_nationkey = f.c_nationkey AND p.tier IS NOT DISTINCT FROM f.tier"""
    q["order_dim_asof"] = """WITH o AS (SELECT o_orderkey AS id, o_custkey AS user_id,
    (epoch_us(o_orderdate) // 1000) + (o_orderkey % 86400) * 1000 AS create_ts, o_orderpriority FROM orders),
ch AS (SELECT user_id, create_ts + (id % 7 - 3) * 3600000 AS ts, id AS seq, id % 5 > 0 AS has_level, id % 5 IN (0, 3, 4) AS has_gender,
    o_orderpriority AS level, CASE WHEN id % 10 = 9 THEN NULL WHEN id % 2 = 0 THEN '男' ELSE '女' END AS gender FROM o WHERE id % 3 > 0),
l AS (SELECT * FROM ch WHERE has_level QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY seq DESC) = 1),
g AS (SELECT * FROM ch WHERE has_gender QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY seq DESC) = 1)
SELECT o.id, o.user_id, o.create_ts, l.level AS user_level, g.gender AS user_gender,
  CASE WHEN l.ts IS NOT NULL OR g.ts IS NOT NULL THEN true END AS user_known
FROM o ASOF LEFT JOIN l ON o.user_id = l.user_id AND o.create_ts >= l.ts
ASOF LEFT JOIN g ON o.user_id = g.user_id AND o.create_ts >= g.ts"""
    steps = [ROUTED.replace(_RULE_ROWS, _rule_rows(r)) for r in (ROUTING_RULES, CHANGED_RULES, CHANGED_RULES)]
    q["stream_route_refresh"] = " UNION ALL ".join(f"""SELECT * FROM (WITH {w}
SELECT seq, "table" AS source_table, type AS op_type, sink_type, sink_table, array_to_string(keys, ',') AS kept_keys, route,
  {min(i, 1)} AS rules_from FROM routed WHERE seq % 3 = {i})""" for i, w in enumerate(steps))
    q["stats_sink_retry"] = q["visitor_stats_1d"]
    q["stream_late_rows"] = f"""WITH {FX_LOG}, n AS (SELECT event_id % 3 AS i, max(ts) AS m FROM fx_log GROUP BY 1)
SELECT event_id, ts, coalesce(ts - ts % 10000 + 10000 <= (SELECT max(m) FROM n WHERE n.i < event_id % 3) - 3000, false) AS late FROM fx_log"""
    q["state_audit"] = tp() + "SELECT mid, day, ts, event_id FROM uv_rows"
    q["order_detail_interval"] = f"WITH {FX_ORDERS},\n{_j1()}\nSELECT * FROM j1"
    q["order_dim_user"] = order_sql(("user",))
    q["order_dim_region"] = order_sql(("province",))
    q["order_dim_sku"] = order_sql(("sku", "spu", "category3", "trademark"))
    q["order_wide"] = order_sql(("user", "province", "sku", "spu", "category3", "trademark"))
    q["payment_interval"] = payment_sql((), ["payment_id", "order_id", "detail_id", "callback_time",
                                             "order_create_time"])
    q["payment_wide"] = payment_sql(("user", "province", "sku", "spu", "category3", "trademark"))
    q["order_wide_merge"] = merge_sql()
    # streaming twins produce the rows of their batch forms
    for name in ("visitor_flag_repair", "unique_visit", "user_jump", "user_jump_long", "order_wide", "payment_wide",
                 "visitor_stats_10s", "dim_current"):
        q[f"stream_{name}"] = q[name]
    return q
