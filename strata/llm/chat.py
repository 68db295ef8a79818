"""Chat formatting with turn spans found by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string; it
is only ever called, never inspected. Rendering the first 1, 2, ... n turns and
comparing consecutive outputs locates the span that each turn adds. If an output
doesn't start with the one before it, the template rewrites history: the span
then starts at the first difference, and the conversation is marked
``rewrites`` with the turn that showed it. Inside an assistant turn's span the
loss mask covers the text as rendered, without the marks around it: its place is
where a character that the conversation doesn't hold comes out when it stands
for the text.

The built-in template writes ``### Role: text</turn>`` and a newline per turn,
and puts a backslash before each backslash, ``###`` and ``</turn>`` inside roles
and texts, so no text can forge a mark and reading back is exact.

Defined cases: a null text or role counts as empty; rows of a conversation are
ordered by turn (null first), then role and text, so repeated rows each give a
turn; a null conversation id is a conversation of its own; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Buffer, rows_of

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
OPEN, CLOSE, LOSS_ROLE = "###", "</turn>", "assistant"
_ESCAPE = re.compile(r"\\|###|</turn>")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>)")


def escape(s: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m.group(), s)


def unescape(s: str) -> str:
    return _UNESCAPE.sub(lambda m: m.group(1), s)


def render(turns: list[Turn]) -> str:
    """The built-in template."""
    return "".join([f"{OPEN} {_role(r)}: {escape(t)}{CLOSE}\n" for r, t in turns])


def _role(role: str) -> str:
    # the colon ends the role, so one inside it is written as a percent code, as is the percent sign
    return escape(role.replace("%", "%25").replace(":", "%3A"))


def read_back(formatted: str) -> list[Turn]:
    """The turns of a string made by ``render``."""
    out, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN + " ", at):
            raise ValueError(f"no turn at {at}")
        colon = formatted.index(": ", at)
        role = unescape(formatted[at + len(OPEN) + 1:colon]).replace("%3A", ":").replace("%25", "%")
        end = _close(formatted, colon + 2)
        out.append((role, unescape(formatted[colon + 2:end])))
        at = end + len(CLOSE) + 1
    return out


def _close(s: str, at: int) -> int:
    """Position of the first close mark from ``at`` that no backslash escapes."""
    while True:
        end = s.index(CLOSE, at)
        slashes = end - len(s[:end].rstrip("\\")) if s[end - 1:end] == "\\" else 0
        if slashes % 2 == 0:
            return end
        at = end + 1


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def spans(turns: list[Turn], template: Template = render) -> tuple[str, list[tuple[int, int]], list[tuple[int, int]], int]:
    """(formatted, span of each turn, loss span of each turn, first rewriting turn or -1).

    A turn without loss, or whose text can't be told apart, has an empty loss span.
    """
    before, turn_spans, loss_spans, rewrites = template([]), [], [], -1
    seen = {c for r, t in turns for c in r + t}
    mark = next(chr(c) for c in range(0xE000, 0x110000) if chr(c) not in seen)
    for k in range(len(turns)):
        now = template(turns[:k + 1])
        start = _common(before, now)
        if start < len(before) and rewrites < 0:
            rewrites = k
        turn_spans.append((start, len(now)))
        loss = (len(now), len(now))
        role, text = turns[k]
        if role == LOSS_ROLE and text:
            probe = template([*turns[:k], (role, mark)])
            lo, after = probe.find(mark), len(probe) - probe.find(mark) - 1
            if lo >= 0 and now[:lo] == probe[:lo] and now[len(now) - after:] == probe[lo + 1:]:
                loss = (lo, len(now) - after)
        loss_spans.append(loss)
        before = now
    return before, turn_spans, loss_spans, rewrites


SCHEMA = ("conv_id long, n_turns long, formatted string, turn_starts array<long>, turn_ends array<long>, "
          "loss_starts array<long>, loss_ends array<long>, rewrites int")


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<turn, role, text>>) with the turns in order."""
    t = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(t)).alias("turns"))


def format_chats(rows: DataFrame, template: Template = render) -> DataFrame:
    """One row per conversation: the formatted string, the span of each turn and of each loss part."""
    arrays = [pa.list_(pa.int64())] * 4
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                        *zip(("turn_starts", "turn_ends", "loss_starts", "loss_ends"), arrays), ("rewrites", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema, 256)
        for conv_id, turns in rows_of(batches, ["conv_id", "turns"]):
            pairs = [(t["role"], t["text"]) for t in turns]
            text, ts, ls, rw = spans(pairs, template)
            out.add(conv_id, len(pairs), text, *[[s[i] for s in x] for x in (ts, ls) for i in (0, 1)], rw)
            if out.full():
                yield out.flush()
        yield out.flush()

    return conversations(rows).mapInArrow(run, SCHEMA)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(formatted: DataFrame) -> DataFrame:
    """Reads the formatted strings back: turns and loss text as hashes and lengths."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema)
        for conv_id, text, starts, ends in rows_of(batches, ["conv_id", "formatted", "loss_starts", "loss_ends"]):
            turns = read_back(text)
            all_turns = "".join([f"{r}\n{t}\n" for r, t in turns]).encode("utf-8", "surrogatepass")
            loss = "".join([unescape(text[a:b]) for a, b in zip(starts, ends)])
            out.add(conv_id, len(turns), hashlib.sha256(all_turns).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(), len(text))
            if out.full():
                yield out.flush()
        yield out.flush()

    return formatted.mapInArrow(run, DIGEST)
