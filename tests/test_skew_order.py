"""A device or order holding a third of all rows; results independent of arrival order."""

import random
from decimal import Decimal

from strata import schemas as S
from strata.operators import logs, orders, traffic
from tests.helpers import log_df, log_row

DAY = 86_400_000


def _events(n=900, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        mid = "hot" if i % 3 == 0 else f"m{rnd.randrange(40)}"
        rows.append(log_row(i, rnd.randrange(0, 3 * DAY) // 1000 * 1000, mid=mid,
                            is_new=rnd.choice(["0", "1"]), last_page_id=rnd.choice([None, "", "x"])))
    return rows


def _brute_uv(rows):
    best = {}
    for r in rows:
        if (r[3][1] or "") != "":
            continue
        k = (r[1][0], r[5] // DAY)
        if k not in best or (r[5], r[0]) < (best[k][5], best[k][0]):
            best[k] = r
    return sorted(r[0] for r in best.values())


def _brute_flags(rows):
    first = {}
    for r in sorted(rows, key=lambda r: (r[5], r[0])):
        if r[1][1] == "1" and r[1][0] not in first:
            first[r[1][0]] = r
    out = {}
    for r in rows:
        f = first.get(r[1][0])
        reset = r[1][1] == "1" and f is not None and f[0] != r[0] and f[5] // DAY == r[5] // DAY
        out[r[0]] = "0" if reset else r[1][1]
    return out


def test_hot_device_unique_visit_and_flags(spark):
    rows = _events()
    df = log_df(spark, rows)
    assert sorted(r.event_id for r in traffic.unique_visit(df).collect()) == _brute_uv(rows)
    got = {r.event_id: r.is_new for r in logs.repair_new_flag(df).select("event_id", "common.is_new").collect()}
    assert got == _brute_flags(rows)


def test_results_do_not_depend_on_arrival_order(spark):
    rows = _events(seed=9)
    a = log_df(spark, rows)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    b = log_df(spark, shuffled).repartition(5)
    for f in (traffic.unique_visit, traffic.user_jump):
        assert sorted(r.event_id for r in f(a).collect()) == sorted(r.event_id for r in f(b).collect())
    fa = sorted(map(tuple, logs.repair_new_flag(a).select("event_id", "common.is_new").collect()))
    fb = sorted(map(tuple, logs.repair_new_flag(b).select("event_id", "common.is_new").collect()))
    assert fa == fb


def test_hot_order_interval_join(spark):
    info = spark.createDataFrame(
        [(o, 1, "F", 1, Decimal("1.00"), None, None, None, None, None, "t", None, None, None, 1000 * o)
         for o in range(30)], S.ORDER_INFO)
    lines = [(i, 0 if i % 3 == 0 else i % 30, 1, Decimal("1.00"), 1, "x", None, None, None, None,
              (0 if i % 3 == 0 else 1000 * (i % 30)) + (i % 13) - 6) for i in range(900)]
    det = spark.createDataFrame(lines, S.ORDER_DETAIL)
    got = sorted(r.detail_id for r in orders.join_order_lines(info, det).collect())
    want = sorted(line[0] for line in lines if abs(line[10] - 1000 * line[1]) <= 5)
    assert got == want
