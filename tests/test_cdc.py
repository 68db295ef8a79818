from strata.operators import cdc
from strata.sources.fixtures import RULE_COLUMNS

RULES = [
    (1, "user_info", "insert", "hbase", "dim_user_info", "id,name", "id", None),
    (2, "user_info", "update", "hbase", "dim_user_info", "id, name", "id", None),
    (3, "order_info", "insert", "kafka", "dwd_order_info", None, None, None),
    (4, "order_info", "update", "clickhouse", "ck_order", "id", None, None),
    (5, "sku_info", "insert", "kafka", "first_rule", "id", None, None),
    (6, "sku_info", "insert", "kafka", "last_rule", "id", None, None),
]


def rules(spark):
    return spark.createDataFrame(RULES, ", ".join(f"{c} {'int' if c == 'rule_seq' else 'string'}"
                                                 for c in RULE_COLUMNS))


def recs(spark, rows):
    return cdc.parse_cdc(spark.createDataFrame(rows, "seq bigint, `table` string, type string, data string"))


def test_etl_filter(spark):
    df = recs(spark, [(1, "t", "insert", None), (2, "t", "insert", "{}"), (3, "t", "insert", '{"a":1}'),
                      (4, None, "insert", '{"a":1}')])
    assert [r.seq for r in cdc.etl_filter(df).collect()] == [3]


def test_route_edges(spark):
    df = recs(spark, [
        (1, "user_info", "bootstrap-insert", '{"id":"1","name":"a","x":"y"}'),
        (2, "unknown", "insert", '{"id":"2"}'),
        (3, "order_info", "update", '{"id":"3"}'),
        (4, "user_info", "update", '{"id":"4","name":"b"}'),
        (5, "order_info", "insert", '{"id":"5","z":"q"}'),
        (6, "sku_info", "insert", '{"id":"6"}'),
    ])
    out = {r.seq: r for r in cdc.route(df, rules(spark)).collect()}
    assert out[1].route == "dim" and out[1].type == "insert" and sorted(out[1].data) == ["id", "name"]
    assert out[2].route == "reject"
    assert out[3].route == "reject"  # clickhouse is neither fact nor dimension
    assert sorted(out[4].data) == ["id"]  # " name" never matches: the blank is significant
    assert out[5].route == "fact" and sorted(out[5].data) == ["id", "z"]  # no column list keeps all
    assert out[6].sink_table == "last_rule"  # the last rule for a key wins


def test_dimension_upsert(spark):
    df = recs(spark, [
        (1, "user_info", "insert", '{"id":"1","name":"a","seg":"s"}'),
        (2, "user_info", "update", '{"id":"1","name":"b"}'),
        (3, "user_info", "update", '{"id":"1","seg":null}'),
    ])
    r = spark.createDataFrame([(1, "user_info", "insert", "hbase", "dim_u", None, None, None),
                               (2, "user_info", "update", "hbase", "dim_u", None, None, None)],
                              ", ".join(f"{c} {'int' if c == 'rule_seq' else 'string'}" for c in RULE_COLUMNS))
    routed = cdc.route(df, r)
    cur = cdc.dim_current(cdc.dim_changes(cdc.split_routes(routed)["dim"]))
    got = {(x.column): x.value for x in cur.collect()}
    assert got == {"id": "1", "name": "b", "seg": None}
    assert {x.dim_table for x in cur.collect()} == {"DIM_U"}
    wide = cdc.dim_view(cur, "dim_u", ["id", "name", "seg"]).collect()
    assert [(w.id, w.name, w.seg) for w in wide] == [("1", "b", None)]


def test_deletes_are_upserts_unless_applied(spark):
    df = recs(spark, [(1, "user_info", "insert", '{"id":"1","name":"a"}'),
                      (2, "user_info", "delete", '{"id":"1","name":"a"}')])
    r = spark.createDataFrame([(1, "user_info", "insert", "hbase", "dim_u", None, None, None),
                               (2, "user_info", "delete", "hbase", "dim_u", None, None, None)],
                              ", ".join(f"{c} {'int' if c == 'rule_seq' else 'string'}" for c in RULE_COLUMNS))
    ch = cdc.dim_changes(cdc.split_routes(cdc.route(df, r))["dim"])
    assert cdc.dim_current(ch).count() == 2
    assert cdc.dim_current(ch, apply_deletes=True).count() == 0


def test_dim_schema_from_config(spark):
    s = cdc.dim_schemas(rules(spark)).collect()
    assert sorted((x.dim_table, x.column, x.position, x.is_pk) for x in s) == [
        ("DIM_USER_INFO", "id", 0, True), ("DIM_USER_INFO", "name", 1, False)]
    assert [f.name for f in cdc.dim_struct("id,name").fields] == ["id", "name"]


def test_fact_payload_reparses_typed(spark):
    df = recs(spark, [(1, "order_info", "insert", '{"id":7,"total_amount":"1.50","order_status":"F"}')])
    facts = cdc.split_routes(cdc.route(df, rules(spark)))["fact"]
    p = cdc.fact_payload(facts).collect()[0]
    assert p.topic == "dwd_order_info"
    back = spark.createDataFrame([(p.value,)], "v string").selectExpr(
        "from_json(v, 'id string, total_amount string') as r").selectExpr(
        "cast(r.id as bigint) id", "cast(r.total_amount as decimal(16,2)) amt").collect()[0]
    assert back.id == 7 and str(back.amt) == "1.50"


def test_rules_reader_and_camel(spark, tmp_path):
    from strata.sources.rules import read_rules, rules_camel
    p = str(tmp_path / "rules.csv")
    with open(p, "w") as f:
        f.write("SOURCE_TABLE,operate_type,sink_type,sink_table,sink_columns,sink_pk,sink_extend\n")
        f.write("user_info,insert,hbase,dim_user_info,\"id,name\",id,\n")
    r = read_rules(spark, p, fmt="csv")
    assert r.columns[0] == "rule_seq" and r.count() == 1
    assert "sinkColumns" in rules_camel(r).columns


def test_dimension_tables_from_routed_log(spark):
    from strata.plans import batch
    from strata.streaming import jobs, replay, topics
    from strata.sources import fixtures as fx
    from tests.conftest import SF
    root = replay.scratch(spark, "t-dims")
    topics.publish(fx.cdc_records(spark, SF), root, "ods_base_db")
    jobs.base_db(spark, root, f"{root}/_ck", f"{root}/out", lambda: fx.routing_rules(spark)).awaitTermination()
    d = jobs.dimension_tables(spark, f"{root}/out", {"dim_user_info": ["id", "name", "seg"]})["dim_user_info"]
    want = cdc.dim_view(batch.dimension_current(spark, SF), "dim_user_info", ["id", "name", "seg"])
    assert sorted((r.id, r.name, r.seg) for r in d.collect()) == \
        sorted((r.pk, r.name, r.seg) for r in want.collect())
