"""Periodic runs of words, caught online by dyadic square catchers.

A run is a longest stretch whose words equal the words q further on, with q its
smallest period, at least ``POWER`` periods and ``LEAST`` words long.

``SquareCatcher`` is given a text's words bit by bit. Each completed block of
L = 2^k words (from the largest power of two that a shortest run must hold whole, 8
at the defaults) has a catcher that waits for a suffix of the text equal to the block and
L+1 to 2L words behind it (the smallest blocks: 1 to 2L). At any word exactly one
block of each length is at that distance, so an appended word advances one suffix comparison a
length. Suffixes are compared by names of their 2^k words, each made from the
names of its halves; equal names are followed by comparing words. A caught
repetition is extended both ways to all words with that period; it grows with
further words while it touches the end, and from two periods on it is a square,
merged with all others of the run. A run of period q with three periods holds a
whole block of the catchers for q, and the block's copy q words on, so none is
missed. A repetition inside a known run of a shorter period that divides its own
is that run again.

Names are kept for the last 3L words of each length only; memory is a small multiple of
the longest text, work is n log n.

Defined cases: null, empty and blank texts have no words and no runs; repeated
rows are scanned each; a null doc_id is kept; an empty table gives an empty
result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Buffer, rows_of, words

LEAST, POWER = 24, 3
#: Words appended at a time.
CHUNK = 4096

_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
Run = tuple[int, int, int]  # start, end, period


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Names of two halves put together."""
    z = x * _K1 + y * _K2
    z = (z ^ (z >> np.uint64(32))) * _K3
    return z ^ (z >> np.uint64(29))


class SquareCatcher:
    def __init__(self, least: int = LEAST, power: int = POWER):
        if power < 3:
            raise ValueError("runs of at least three periods are caught")
        self.least, self.power = least, power
        self.smallest = 1 << max(0, (max(least, power) + 1) // 3).bit_length() - 1
        self.t, self.n = np.zeros(1024, np.int64), 0
        self.names: list[np.ndarray] = []  # of the 2^k words from first[k] on, for each k
        self.first: list[int] = []
        self.open: list[Run] = []  # repetitions that reach the last word
        self.squares: list[Run] = []  # those that have ended, two periods or longer

    def append(self, ids: np.ndarray) -> None:
        """Further words, as numbers; equal words have equal numbers."""
        if not len(ids):
            return
        old, self.n = self.n, self.n + len(ids)
        if self.n > len(self.t):
            self.t = np.r_[self.t[:old], np.zeros(max(self.n, 2 * old), np.int64)]
        self.t[old:self.n] = ids
        live = [(a, self._end(b - q, q), q) for a, b, q in self.open]
        k = 0
        while 1 << k <= self.n:
            fresh = self._name(k, old)
            if 1 << k >= self.smallest:
                self._catch(k, fresh, live)
            k += 1
        for k, x in enumerate(self.names):
            drop = self.n - (3 << k) - self.first[k]
            if drop > 0:
                self.names[k], self.first[k] = x[drop:].copy(), self.first[k] + drop
        self.open = [r for r in live if r[1] == self.n]
        self.squares += [r for r in live if r[1] < self.n and r[1] - r[0] >= 2 * r[2]]

    def runs(self) -> list[Run]:
        """(start, end, smallest period) of the runs among the words so far, by start and period."""
        best: dict[tuple[int, int], int] = {}
        for a, b, q in self.squares + self.open:
            if b - a >= max(self.least, self.power * q):
                best[a, b] = min(q, best.get((a, b), q))
        return sorted((a, b, q) for (a, b), q in best.items())

    def _name(self, k: int, old: int) -> int:
        """Names the stretches of 2^k words that the new words complete; returns the first one's place."""
        size, start = 1 << k, max(0, old - (1 << k) + 1)
        if k == 0:
            new = _pair(self.t[old:self.n].astype(np.uint64), np.uint64(0))
        else:
            x, at, half = self.names[k - 1], start - self.first[k - 1], size >> 1
            m = self.n - size + 1 - start
            new = _pair(x[at:at + m], x[at + half:at + half + m])
        if k == len(self.names):
            self.names.append(new)
            self.first.append(start)
        else:
            self.names[k] = np.r_[self.names[k], new]
        return start

    def _catch(self, k: int, fresh: int, live: list[Run]) -> None:
        """Compares each new suffix of 2^k words with the block whose catcher is at its distance."""
        size, x, first = 1 << k, self.names[k], self.first[k]
        last = self.n - size  # where the last suffix of this length begins
        blocks, suffixes = [], []
        for near in ([0, size] if size == self.smallest else [size]):
            w = np.arange(max(fresh, near + 1), last + 1)
            s = (w - near - 1) // size * size
            hit = x[w - first] == x[s - first]
            if hit.any():
                suffixes.append(w[hit])
                blocks.append(s[hit])
        if not blocks:
            return
        s, w = np.concatenate(blocks), np.concatenate(suffixes)
        q, end = w - s, w + size
        keep = np.ones(len(s), bool)
        for r in live:
            self._inside(r, s, q, end, size, keep)
        order = np.lexsort((s, q))
        s, q, end, keep = s[order], q[order], end[order], keep[order]
        i = 0
        while True:
            rest = np.flatnonzero(keep[i:])
            if not len(rest):
                return
            i += int(rest[0])
            period = int(q[i])
            r = self._start(int(s[i]), period), self._end(int(s[i]), period), period
            keep[i] = False
            self._inside(r, s, q, end, size, keep)
            if r[1] == self.n or r[1] - r[0] >= 2 * period:
                live.append(r)

    @staticmethod
    def _inside(r: Run, s: np.ndarray, q: np.ndarray, end: np.ndarray, size: int, keep: np.ndarray) -> None:
        """Clears the repetitions that the run r explains."""
        a, b, p = r
        same = (q == p) | (q % p == 0) & (p <= size)
        keep &= ~(same & (s >= a) & (end <= b))

    def _end(self, i: int, q: int) -> int:
        """End of the words from i on with period q."""
        t, step = self.t, 32
        while i + q < self.n:
            m = min(step, self.n - q - i)
            differ = np.flatnonzero(t[i:i + m] != t[i + q:i + q + m])
            if len(differ):
                return i + int(differ[0]) + q
            i, step = i + m, step * 2
        return self.n

    def _start(self, i: int, q: int) -> int:
        """Start of the words with period q that reach i."""
        t, step = self.t, 32
        while i > 0:
            m = min(step, i)
            differ = np.flatnonzero(t[i - m:i] != t[i - m + q:i + q])
            if len(differ):
                return i - m + int(differ[-1]) + 1
            i, step = i - m, step * 2
        return 0


def find(ws: list[bytes], least: int = LEAST, power: int = POWER, chunk: int = CHUNK) -> list[Run]:
    """Runs (start, end, period) of one text's words."""
    if len(ws) < least:
        return []
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    catcher = SquareCatcher(least, power)
    for at in range(0, len(ws), chunk):
        catcher.append(np.fromiter(map(number.__getitem__, ws[at:at + chunk]), np.int64))
    return catcher.runs()


def collapse(ws: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(ws)
    keep = np.ones(len(ws), bool)
    for a, b, q in runs:
        keep[a + q:b] = False
    return b" ".join([ws[i] for i in np.flatnonzero(keep).tolist()])


def scan(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period) and the collapsed text of every row."""
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run_type)), ("collapsed", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema, 256)
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            ws = text.split() if text else []
            found = find(ws, least, power)
            out.add(doc_id, len(ws), [{"start": a, "length": b - a, "period": q} for a, b, q in found], collapse(ws, found))
            if out.full():
                yield out.flush()
        yield out.flush()

    ddl = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return slim.mapInArrow(run, ddl).withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: str | Column) -> Column:
    """The run with the greatest exact length / period, the first of equal ones; null without runs."""
    c = F.col(runs) if isinstance(runs, str) else runs
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(c, F.get(c, F.lit(0)), lambda best, r: F.when(more(best, r), r).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), strongest("runs").alias("best"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")) \
        .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, by crc32 of the id, with words a, a+1, .. repeating with period p from word a on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    ws = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words("text")).alias("ws")) \
        .select("doc_id", "text", "ws", "g", F.size("ws").alias("n"))
    ws = ws.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n AS int)")))
    ws = ws.withColumn("p", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) AS int)"))
    again = F.expr("concat(slice(ws, 1, a), slice(flatten(array_repeat(slice(ws, a + 1, p), cast(ceil((n - a) / p) AS int))), 1, n - a))")
    return ws.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
