"""Runs against every period tried on every text, and the digests against the contract's words."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from strata.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def smallest_period(ws):
    fail, k = [0] * len(ws), 0
    for i in range(1, len(ws)):
        while k and ws[i] != ws[k]:
            k = fail[k - 1]
        k += ws[i] == ws[k]
        fail[i] = k
    return len(ws) - fail[-1]


def brute(ws, least=24, power=3):
    t = np.unique(np.array(ws, object), return_inverse=True)[1] if ws else np.zeros(0, int)
    out = []
    for q in range(1, len(ws) // power + 1):
        same = np.r_[False, t[:-q] == t[q:], False]
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b + q - a >= max(least, power * q) and smallest_period(t[a:b + q].tolist()) == q:
                out.append((a, b + q, q))
    return sorted(out)


def texts(rng):
    for _ in range(250):
        base = [rng.choice([b"a", b"b", b"c"][:rng.randint(1, 3)]) for _ in range(rng.randint(0, 150))]
        yield base
        block = [rng.choice([b"x", b"y", b"a"]) for _ in range(rng.randint(1, 40))]
        for _ in range(rng.randint(0, 2)):
            block = block * rng.randint(1, 5) + [rng.choice([b"x", b"z"]) for _ in range(rng.randint(0, 3))]
        yield (base + block[:400] * rng.randint(1, 4) + base)[:1500]
    x, y = [b"a"], [b"a", b"b"]
    while len(y) < 1200:
        x, y = y, y + x
    yield y  # Fibonacci word
    yield [b"w"] * 5000
    yield ([b"p"] * 7 + [b"q"]) * 300


@pytest.mark.parametrize("chunk", [1, 7, 64, 4096])
def test_all_runs_whatever_the_chunk(chunk):
    for ws in texts(random.Random(chunk)):
        if chunk == 1 and len(ws) > 400:
            ws = ws[:400]
        assert periodic.find(ws, chunk=chunk) == brute(ws)


@pytest.mark.parametrize("least,power", [(3, 3), (10, 4), (50, 3)])
def test_other_bounds(least, power):
    for ws in texts(random.Random(least)):
        ws = ws[:300]
        assert periodic.find(ws, least, power, 16) == brute(ws, least, power)


def test_runs_are_known_before_the_text_ends():
    c = periodic.SquareCatcher()
    c.append(np.array([9, 8] + [1, 2, 3] * 9))
    assert c.runs() == [(2, 29, 3)]
    c.append(np.array([1, 2, 7]))
    assert c.runs() == [(2, 31, 3)]


def test_names_are_kept_for_a_bounded_stretch():
    c, rng = periodic.SquareCatcher(), np.random.default_rng(1)
    for _ in range(40):
        c.append(rng.integers(0, 50, 1000))
    assert sum(map(len, c.names)) < 10 * c.n


def expected(doc_id, text):
    ws = (text or "").encode().split()
    h, n = None if doc_id is None else zlib.crc32(str(doc_id).encode()), len(ws)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs, gone = brute(ws), set()
    for a, b, q in runs:
        gone |= set(range(a + q, b))
    best = [None] * 4
    if runs:
        from fractions import Fraction
        a, b, q = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
        best = [a, b - a, q, 1000 * (b - a) // q]
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_on_every_short_document(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in queries.op13_runs(spark, SF).collect()}
    assert got.keys() == docs.keys()
    few = [i for i, t in docs.items() if len((t or "").split()) < 2500]
    assert len(few) > 150 and sum(got[i][1] > 0 for i in few) > 10
    for i in few:
        assert got[i] == expected(i, docs[i])


def test_odd_rows(spark):
    odd = [(None, "a b " * 30), (1, None), (2, ""), (3, " \t\n\x0b"), (4, "é x " * 24), (4, "é x " * 24), (30, "w " * 100_000),
           (5, "x" * 300_000), (6, "one")] + [(i, "k l m n o " * 11 + "p") for i in range(100, 140)]
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in odd], "doc_id long, text string, runs string, n_words int")
    got = sorted(map(repr, map(tuple, periodic.digest(periodic.scan(periodic.planted(df))).collect())))
    short = [(i, t) for i, t in odd if len(t or "") != 200_000]
    assert len(got) == len(odd)
    for i, t in short:
        assert repr(expected(i, t)) in got
    assert periodic.digest(periodic.scan(periodic.planted(df.limit(0)))).count() == 0
