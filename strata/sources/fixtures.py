"""Derived inputs: the driver's tables mapped to the shapes of each layer.

Every builder reads the driver parquet tables (column pruned, filters pushed to
the scan) and derives the layer's rows with row-wise projections or
partial-aggregated groupBys; no window function, so no fixture puts one key
into one task. The DuckDB twins of these views live in ``strata.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import config as C
from strata.functions.columns import format_ms, ntz_to_ms, parse_time_ms

C_MONEY = "decimal(16,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, listed anew on every call so files added meanwhile are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- traffic: raw app log (ods_base_log) -----------------------------------

_DISPLAYS = ("CASE WHEN event_id % 8 = 0 THEN NULL ELSE "
             "transform(filter(sequence(0, 3), i -> i < event_id % 4), i -> named_struct("
             "'item', concat(CAST(event_id AS STRING), '-', CAST(i AS STRING)), 'item_type', 'sku_id', "
             "'order', i + 1, 'pos_id', CAST((event_id + i) % 5 AS INT))) END")


def ods_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested raw log rows, one per event: ``signup`` events are start logs."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    during = F.when(F.col("event_id") % 11 == 10, F.lit(None).cast("bigint")).otherwise(
        F.floor(F.col("value") * 1000).cast("bigint"))
    last_page = (F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("string"))
                 .when(F.col("event_id") % 5 == 1, F.lit(""))
                 .otherwise(F.lit("home")))
    is_start = F.col("event_type") == "signup"
    common = F.struct(
        F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("mid"),
        F.when(F.col("event_id") % 2 == 0, F.lit("1")).otherwise(F.lit("0")).alias("is_new"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("vc"),
        F.concat(F.lit("ch"), (F.col("user_id") % 4).cast("string")).alias("ch"),
        F.concat(F.lit("ar"), (F.col("user_id") % 7).cast("string")).alias("ar"),
    )
    start = F.when(is_start, F.struct(
        F.element_at(F.array(F.lit("icon"), F.lit("notice"), F.lit("install")),
                     (F.col("user_id") % 3 + 1).cast("int")).alias("entry"),
        during.alias("loading_time")))
    page = F.when(~is_start, F.struct(
        F.col("event_type").alias("page_id"), last_page.alias("last_page_id"), during.alias("during_time")))
    return ev.select(
        "event_id", common.alias("common"), start.alias("start"), page.alias("page"),
        F.expr(_DISPLAYS).alias("displays"), ntz_to_ms("ts").alias("ts"))


def ods_log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as the JSON text a topic carries (``value`` column)."""
    return ods_log(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))


# --- change records (ods_base_db_maxwell) ----------------------------------

def _cycle(key: str, names: list[str]) -> F.Column:
    c = F.col(key) % len(names)
    out = F.lit(names[-1])
    for i in range(len(names) - 2, -1, -1):
        out = F.when(c == i, F.lit(names[i])).otherwise(out)
    return out


def _q(c) -> F.Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records as text: users (dimension), skus (dimension), orders (fact)."""
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    users = cu.select(
        (F.col("c_custkey") * 3).alias("seq"), F.lit("user_info").alias("table"),
        _cycle("c_custkey", ["insert", "bootstrap-insert", "update", "delete"]).alias("type"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string"))
        .when(F.col("c_custkey") % 50 == 1, F.lit("{}"))
        .otherwise(F.concat(F.lit('{"id":'), _q((F.col("c_custkey") % 300).cast("string")),
                            F.lit(',"name":'), _q(F.col("c_name")),
                            F.lit(',"seg":'), _q(F.col("c_mktsegment")), F.lit("}"))).alias("data"))
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    sku_id = _q((F.col("p_partkey") % 500).cast("string"))
    skus = pa.select(
        (F.col("p_partkey") * 3 + 1).alias("seq"), F.lit("sku_info").alias("table"),
        _cycle("p_partkey", ["insert", "update", "delete"]).alias("type"),
        F.when(F.col("p_partkey") % 3 == 1,
               F.concat(F.lit('{"id":'), sku_id, F.lit(',"sku_name":'), _q(F.col("p_name")), F.lit("}")))
        .otherwise(F.concat(F.lit('{"id":'), sku_id, F.lit(',"sku_name":'), _q(F.col("p_name")),
                            F.lit(',"tm_id":'), _q(F.substring("p_brand", 7, 16)), F.lit("}"))).alias("data"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    orders = od.select(
        (F.col("o_orderkey") * 3 + 2).alias("seq"), F.lit("order_info").alias("table"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("update")).otherwise(F.lit("insert")).alias("type"),
        F.concat(F.lit('{"id":'), F.col("o_orderkey").cast("string"),
                 F.lit(',"user_id":'), F.col("o_custkey").cast("string"),
                 F.lit(',"order_status":'), _q(F.col("o_orderstatus")),
                 F.lit(',"total_amount":'), _q(F.col("o_totalprice").cast(C_MONEY).cast("string")),
                 F.lit("}")).alias("data"))
    return users.unionByName(skus).unionByName(orders)




# Fixed routing configuration (the table_process rows the jobs are given).
# rule_seq orders the rows; for a repeated (source_table, operate_type) the last wins.
ROUTING_RULES = [
    (1, "user_info", "insert", "hbase", "dim_user_info", "id,name,seg", "id", None),
    (2, "user_info", "update", "hbase", "dim_user_info", "id,name", "id", None),
    (3, "user_info", "delete", "hbase", "dim_user_info", "id, name", "id", None),
    (4, "sku_info", "insert", "hbase", "dim_sku_info", "id,sku_name,tm_id", "id", " SALT_BUCKETS = 3"),
    (5, "sku_info", "update", "hbase", "dim_sku_info", None, None, None),
    (6, "order_info", "insert", "kafka", "dwd_order_info", "id,user_id", None, None),
    (7, "order_info", "insert", "kafka", "dwd_order_info", "id,user_id,total_amount,order_status", None, None),
    (8, "order_info", "update", "clickhouse", "ads_order_info", "id", None, None),
]
RULE_COLUMNS = ["rule_seq", "source_table", "operate_type", "sink_type", "sink_table",
                "sink_columns", "sink_pk", "sink_extend"]


def _sql_literal(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def routing_rules(spark: SparkSession, rules: list[tuple] | None = None) -> DataFrame:
    """The rule rows (``ROUTING_RULES`` unless others are given) as an inline VALUES relation: no Python in the executed plan,
    and the planner knows its exact size."""
    rows = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rules or ROUTING_RULES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(RULE_COLUMNS)})")


def cdc_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change records as a topic carries them (``value`` JSON text beside ``seq``), some of them broken:
    cut off, no object, ``data`` of another type or absent, no table."""
    r = cdc_records(spark, sf_dir)
    text = F.concat(F.lit('{"table":'), _q("table"), F.lit(',"type":'), _q("type"), F.lit(',"data":'), F.coalesce("data", F.lit("null")), F.lit("}"))
    s = F.col("seq")
    return r.select("seq", F.when(s % 97 == 1, F.substring(text, 1, 25)).when(s % 97 == 2, F.lit("[1]")).when(s % 97 == 3, F.lit(None).cast("string"))
                    .when(s % 97 == 4, F.concat(F.lit('{"table":'), _q("table"), F.lit(',"type":"insert","data":5}')))
                    .when(s % 97 == 5, F.lit('{"type":"insert","data":{"id":"1"}}')).when(s % 97 == 6, F.lit("not json"))
                    .when(s % 97 == 7, F.concat(F.lit('{"table":'), _q("table"), F.lit(',"type":"insert"}'))).otherwise(text).alias("value"))


# --- orders, lines, payments -----------------------------------------------

def _order_ms() -> F.Column:
    return ntz_to_ms("o_orderdate") + (F.col("o_orderkey") % 86400) * 1000


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dwd_order_info rows; ``create_ts`` is parsed back from ``create_time``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                             "o_totalprice", "o_orderdate")
    ms = _order_ms()
    money = F.col("o_totalprice").cast(C_MONEY)
    none = F.lit(None)
    out = o.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 26).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
        money.alias("total_amount"), none.cast(C_MONEY).alias("activity_reduce_amount"),
        none.cast(C_MONEY).alias("coupon_reduce_amount"), money.alias("original_total_amount"),
        none.cast(C_MONEY).alias("feight_fee"), none.cast("string").alias("expire_time"),
        format_ms(ms).alias("create_time"), none.cast("string").alias("operate_time"),
        format_ms(ms, C.DATE_FORMAT).alias("create_date"), format_ms(ms, "HH").alias("create_hour"),
        parse_time_ms(format_ms(ms)).alias("create_ts"))
    return out


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dwd_order_detail rows; each line is stamped 5 ms apart around its order's time."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    ts = _order_ms() + (F.col("l_linenumber") - 4) * 5
    price = F.col("l_extendedprice").cast(C_MONEY)
    sku = F.when(F.col("l_partkey") % 50 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))  # ids no sku has
    none = F.lit(None).cast(C_MONEY)
    return j.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"), sku.alias("sku_id"),
        price.alias("order_price"), F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("line sku "), F.col("l_partkey").cast("string")).alias("sku_name"),
        format_ms(ts).alias("create_time"), price.alias("split_total_amount"),
        none.alias("split_activity_amount"), none.alias("split_coupon_amount"),
        ts.alias("create_ts"))


_PAY_TYPES = ["alipay", "wechat", "card"]


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dwd_payment_info: one payment per finished order, paid −600 s … +2 999 s after it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                             "o_totalprice", "o_orderdate").filter(F.col("o_orderstatus") == "F")
    cb = _order_ms() + ((F.col("o_orderkey") * 60) % 3600 - 600) * 1000
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"), F.col("o_totalprice").cast(C_MONEY).alias("total_amount"),
        F.concat(F.lit("pay "), F.col("o_orderkey").cast("string")).alias("subject"),
        _cycle("o_orderkey", _PAY_TYPES).alias("payment_type"),
        format_ms(cb - 30_000).alias("create_time"), format_ms(cb).alias("callback_time"))


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of a user dimension with times (pk, ts, seq, data): two of three orders change their customer a while
    before or after they are placed; changes set one column or both, some to null."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority").filter("o_orderkey % 3 > 0")
    k = F.col("o_orderkey")
    gender = F.when(k % 10 == 9, F.lit(None).cast("string")).when(k % 2 == 0, "M").otherwise("F")
    both = F.map_from_arrays(F.array(F.lit("level"), F.lit("gender")), F.array(F.col("o_orderpriority"), gender))
    data = F.when(k % 5 == 0, F.map_filter(both, lambda c, _: c == "gender")) \
        .when(k % 5 < 3, F.map_filter(both, lambda c, _: c == "level")).otherwise(both)
    return o.select(F.col("o_custkey").cast("string").alias("pk"), (_order_ms() + (k % 7 - 3) * 3_600_000).alias("ts"),
                    k.alias("seq"), data.alias("data"))


def dim_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with several rows per (nation, tier) and null tiers: the suppliers."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    tier = F.when(F.col("s_suppkey") % 4 == 3, F.lit(None).cast("bigint")).otherwise(F.col("s_suppkey") % 4)
    return s.select("s_nationkey", tier.alias("tier"), "s_suppkey", "s_name")


# --- dimensions (all-text rows keyed by ``id``): whole tables; misses come from keys that no row has ---

def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    return cu.select(
        k.cast("string").alias("id"),
        F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (k % 20000).cast("int")),
                      C.DATE_FORMAT).alias("birthday"),
        F.when(k % 10 == 9, F.lit(None).cast("string")).when(k % 2 == 0, F.lit("M"))
        .otherwise(F.lit("F")).alias("gender"))


def dim_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("string")
    return n.select(k.alias("id"), F.col("n_name").alias("name"),
                    F.col("n_regionkey").cast("string").alias("area_code"),
                    F.concat(F.lit("ISO-"), k).alias("iso_code"),
                    F.concat(F.lit("CN-"), k).alias("iso_3166_2"))


def dim_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    tm = F.substring("p_brand", 7, 16)
    c3 = F.when(F.col("p_size") % 9 == 0, F.col("p_size") + 1000).otherwise(F.col("p_size"))
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("sku_name"),
                    (F.col("p_partkey") % 66).cast("string").alias("spu_id"),
                    F.when(tm.cast("int") % 7 == 3, F.concat(F.lit("9"), tm)).otherwise(tm).alias("tm_id"),
                    c3.cast("string").alias("category3_id"))


def dim_spu(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = (F.col("p_partkey") % 64)
    p = table(spark, sf_dir, "part").select(k.alias("k")).distinct()
    return p.select(F.col("k").cast("string").alias("id"),
                    F.concat(F.lit("SPU-"), F.col("k").cast("string")).alias("spu_name"))


def dim_category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_size", "p_type")
    g = p.groupBy("p_size").agg(F.min("p_type").alias("t"))
    return g.select(F.col("p_size").cast("string").alias("id"),
                    F.concat(F.lit("CAT-"), F.col("p_size").cast("string"), F.lit("-"), F.col("t")).alias("name"))


def dim_trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand").distinct()
    return p.select(F.substring("p_brand", 7, 16).alias("id"), F.upper("p_brand").alias("tm_name"))
