"""Collocations against counting by plain loops, and the automata against dictionaries."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import phrases

DDL = "doc_id long, text string, lang string, phrase string, f int"


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for p in re.split(r"[.,;:!?\x0a-\x0d]", low):
        yield [w for w in re.split(r"[ \t]+", p) if w]


def brute(docs, most=5, least=100, top=2000, percent=100):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            for i in range(len(ws)):
                for k in range(1, min(most, len(ws) - i) + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, ws), a in cand.items():
        for i in range(len(ws)):
            for k in range(2, len(ws) - i + 1):
                if k < len(ws) and 100 * a >= percent * f[lang, ws[i:i + k]]:
                    gone.add((lang, ws[i:i + k]))
    out = {}
    for (lang, ws), a in cand.items():
        if (lang, ws) in gone:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), a, f[lang, ws[:k]], f[lang, ws[k:]], n[lang], score))
    return {(lang, r + 1): (p.decode(), *rest) for lang, rows in out.items() for r, (_, _, p, *rest) in enumerate(sorted(rows)[:top])}


def found(spark, docs, **kw):
    df = spark.createDataFrame(docs, DDL).repartition(3)
    return {(r.lang, r["rank"]): tuple(r)[2:] for r in phrases.collocations(df, **kw).collect()}


def corpus(seed=5, n=300):
    rng = random.Random(seed)
    vocab = ["a", "B", "é", "cc", "\x01x", "\x00", "d-d", "zz", " ", "e"]
    docs = []
    for i in range(n):
        ws = [rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 60))]
        docs.append((i, "".join(ws), rng.choice(["en", "en", "en", None, "und", "de"]), "x", 1))
    docs += [(1, "New York city. " * 40, "en", None, None), (None, None, "en", None, None), (2, "", None, None, None),
             (3, " .,\t", "de", None, None), (4, "one two three four five six " * 2000, "fr", None, None)]
    return docs


@pytest.mark.parametrize("percent", [100, 80])
def test_against_plain_counting(spark, monkeypatch, percent):
    monkeypatch.setattr(phrases, "RANGE_CHARS", 2000)
    docs = corpus()
    assert found(spark, docs, least=8, top=50, percent=percent) == brute(docs, least=8, top=50, percent=percent)


def test_hot_phrase_repeated_rows_and_empty(spark):
    docs = [(1, "the same words come here again", "en", None, None)] * 400 + corpus(6, 40)
    assert found(spark, docs, least=20) == brute(docs, least=20)
    assert found(spark, []) == {}
    assert found(spark, [(1, None, None, None, None)]) == {}


def shard(texts, langs):
    s = phrases.Shard()
    s.add(pa.array(texts, pa.string()), langs)
    return s


def test_union_over_shards_and_ranges_sums_prefixes():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcd") for _ in range(200)) for _ in range(6)]
    marks = [(b"en", b"a", b"c"), (b"en", b"b"), (b"en", b"b", b"b", b"zz"), (b"en", b"d", b"d", b"d", b"d", b"d")]
    ranges = {}
    for t in texts:
        names, rows, counts = shard([t], ["en"]).ngrams(5)
        at = [0, *phrases._cuts(names, rows, marks), len(rows)]
        for k, (lo, hi) in enumerate(zip(at, at[1:])):
            if lo < hi:
                ranges.setdefault(k, []).append(phrases.Automaton.load(phrases.Automaton.build(names, rows[lo:hi], counts[lo:hi]).dump()))
    got, border = Counter(), set()
    for k, automata in ranges.items():
        for p, f, part in phrases.union(automata, 5, marks[k - 1] if k else None, marks[k] if k < len(marks) else None):
            assert part or p not in got
            got[p] += f
            border |= {p} if part else set()
    want = Counter()
    for t in texts:
        ws = [b"en"] + [w.encode() for w in t.split()]
        want[b"en",] += len(ws) - 1
        for i in range(1, len(ws)):
            for k in range(1, 6):
                if i + k <= len(ws):
                    want[(b"en", *ws[i:i + k])] += 1
    assert {p: f for p, f in got.items() if f >= 5} == {p: f for p, f in want.items() if f >= 5}
    assert border


def test_compose_finds_counts_and_misses():
    paths = sorted({tuple(random.Random(i).choices([b"a", b"b", b"c"], k=1 + i % 4)) for i in range(60)})
    counts = phrases._automaton(paths[::2], list(range(1, len(paths[::2]) + 1)), 5)
    got = phrases.compose(counts, phrases._automaton(paths, [1] * len(paths), 5))
    assert got.tolist() == [i // 2 + 1 if i % 2 == 0 else 0 for i in range(len(paths))]


def test_equal_tails_are_one_state():
    names, rows, counts = shard(["x1 q r s t. x2 q r s t. x3 q r s t"], ["en"]).ngrams(5)
    a = phrases.Automaton.build(names, rows, counts)
    assert len(a.layers[3][0]) < len({tuple(r[:3]) for r in rows.tolist()})
    assert int(a.layers[0][2].sum()) == 15


@pytest.mark.parametrize("largest", [7, 1 << 20, 1 << 30])
def test_rows_packed_in_numbers_are_the_rows(largest):
    """All columns in one number, the last ones numbered first, and too wide for either."""
    rng = random.Random(largest)
    rows = [(rng.choice([3, 7]), *(rng.choice([0, 1, 6, largest]) for _ in range(5))) for _ in range(3000)]
    got, counts = phrases._counts([np.array(c, np.int32) for c in zip(*rows)], largest)
    want = Counter(rows)
    assert [tuple(r) for r in got.tolist()] == sorted(want)
    assert counts.tolist() == [want[r] for r in sorted(want)]


def test_union_reads_only_layers_below_kept_states():
    """Automata are kept as narrow as they are stored, and layers that no kept state reaches are not read."""
    names, rows, counts = shard(["a b c d e f"], ["en"]).ngrams(5)
    automata = [phrases.Automaton.load(phrases.Automaton.build(names, rows, counts).dump()) for _ in range(3)]
    assert {x.itemsize for a in automata for layer in a.layers for x in layer} == {1}
    want = [(p, f) for p, f, _ in phrases.union(automata, 4)]
    for a in automata:
        a.layers[3:] = [None] * len(a.layers[3:])
    assert [(p, f) for p, f, _ in phrases.union(automata, 4)] == want == [((b"en",), 18)]


def test_score_is_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, l, r, n = 9 * 10**15, 9 * 10**15 + 1, 10**16, 9 * 10**16
    df = spark.createDataFrame([(a, l, r, n)], "a long, l long, r long, n long").select(phrases._score(F.col("n")).alias("s"))
    assert df.first().s == 1000 * a * n // (l * r)
