"""Small builders for inline log / order rows."""

from __future__ import annotations

from strata import schemas as S


def log_row(event_id, ts, mid="m1", is_new="0", page_id="home", last_page_id=None, start=None,
            displays=None, during_time=100, vc="v1", ch="c1", ar="a1"):
    page = None if start is not None else (page_id, last_page_id, during_time)
    return (event_id, (mid, is_new, vc, ch, ar), start, page, displays, ts)


def log_df(spark, rows):
    return spark.createDataFrame(rows, S.LOG)
