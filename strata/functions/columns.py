"""Column-level functions shared by batch and streaming plans.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing is a Python UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import config as C


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- predicates -------------------------------------------------------------

def is_blank(c: str | Column) -> Column:
    """Null or empty text (P8/P9 building block)."""
    return F.coalesce(col(c), F.lit("")) == F.lit("")


def is_entry_page(last_page_id: str | Column = "page.last_page_id") -> Column:
    """A visit starts here — no previous page (null or empty)."""
    return is_blank(last_page_id)


def has_page(page_id: str | Column = "page.page_id") -> Column:
    """The event names a page (not null, not empty)."""
    return ~is_blank(page_id)


def non_empty_struct(c: str | Column, fields: Iterable[str]) -> Column:
    """F7 for a parsed object: present and at least one field set."""
    base = col(c)
    present = [base.getField(f).isNotNull() for f in fields]
    anyset = present[0]
    for p in present[1:]:
        anyset = anyset | p
    return base.isNotNull() & anyset


# --- time -------------------------------------------------------------------

def ntz_to_ms(c: str | Column) -> Column:
    """Epoch millis of a TIMESTAMP_NTZ, independent of the session zone (floor)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col(c))
    return F.floor(micros / F.lit(1000)).cast("bigint")


def parse_time_ms(text: str | Column, fmt: str = C.TIME_FORMAT) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text → epoch millis in the session zone."""
    return F.unix_millis(F.to_timestamp(col(text), fmt))


def format_ms(ms: str | Column, fmt: str = C.TIME_FORMAT) -> Column:
    """epoch millis → text in the session zone."""
    return F.date_format(F.timestamp_millis(col(ms)), fmt)


def day_of_ms(ms: str | Column) -> Column:
    """Day key ``yyyyMMdd`` of an epoch-millis column (session zone)."""
    return format_ms(ms, C.DAY_FORMAT)


def event_time(ms: str | Column) -> Column:
    """Event-time TIMESTAMP column for windows and watermarks."""
    return F.timestamp_millis(col(ms))


# --- dimensions -------------------------------------------------------------

def age_years(birthday: str | Column, now_ms: int) -> Column:
    """whole 365-day years between a ``yyyy-MM-dd`` birthday and ``now``."""
    born = F.unix_millis(F.to_timestamp(col(birthday), C.DATE_FORMAT))
    span = F.lit(now_ms).cast("bigint") - born
    year = F.lit(C.MS_PER_DAY * C.DAYS_PER_YEAR).cast("bigint")
    return ((span - span % year) / year).cast("int")  # towards zero, so a birthday to come gives 0


def gender_label(code: str | Column, male: str = C.GENDER_MALE_LABEL,
                 female: str = C.GENDER_FEMALE_LABEL) -> Column:
    """``M`` → male label, any other non-null code → female label, null → null."""
    c = col(code)
    return F.when(c == F.lit(C.GENDER_MALE_CODE), F.lit(male)).when(c.isNotNull(), F.lit(female))


# --- change records ---------------------------------------------------------

def normalize_op(op: str | Column) -> Column:
    """``bootstrap-insert`` is an ``insert``."""
    c = col(op)
    return F.when(c == F.lit(C.OP_BOOTSTRAP_INSERT), F.lit(C.OP_INSERT)).otherwise(c)


def prune_map(data: str | Column, columns: str | Column, keep: str | Column | None = None) -> Column:
    """Keep the keys named in a comma list (exact, no trimming).

    A null or empty list keeps every key. ``keep`` may name a column already
    holding ``split(columns, ',')`` so the split runs once per row rather than
    once per map entry.
    """
    keep_arr = col(keep) if keep is not None else F.split(col(columns), ",")
    pruned = F.map_filter(col(data), lambda k, v: F.array_contains(keep_arr, k))
    return F.when(is_blank(columns), col(data)).otherwise(pruned)


def map_size(data: str | Column) -> Column:
    """F7 for a map: number of keys, 0 when null."""
    return F.when(col(data).isNull(), F.lit(0)).otherwise(F.size(col(data)))


def dim_table_name(sink_table: str | Column) -> Column:
    """Dimension tables are addressed upper-cased."""
    return F.upper(col(sink_table))


def route_key(table: str | Column, op: str | Column) -> Column:
    """``table:type`` rule key."""
    return F.concat_ws(":", col(table), col(op))


# --- names ------------------------------------------------------------------

_SNAKE = re.compile(r"_([a-z0-9])")


def snake_to_camel(name: str) -> str:
    """``sink_table`` → ``sinkTable``."""
    return _SNAKE.sub(lambda m: m.group(1).upper(), name)


def camel_columns(df: DataFrame) -> DataFrame:
    """Rename every snake_case column to camelCase."""
    return df.withColumnsRenamed({c: snake_to_camel(c) for c in df.columns})


def first_non_null(*cols: str | Column) -> Column:
    """F10."""
    return F.coalesce(*[col(c) for c in cols])
