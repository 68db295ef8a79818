"""The quality rules' promise: all rules together lose few good documents of a stratum."""

import random

import pytest
from pyspark.sql import functions as F

from strata.llm import rules

COUNTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, "
          "n_marks long, n_upper long, n_stutter long")


def made(rng, n, quality, hits):
    """Documents with each of six rules' metrics high with chance ``hits``, whatever their quality."""
    for _ in range(n):
        m = [rng.randint(30, 90) if rng.random() < hits else rng.randint(0, 5) for _ in range(6)]
        yield (quality, 100, 400, 4 * m[0], m[1], m[2], 100, m[3], 4 * m[4], m[5])


def lost(spark, rng, per_good, per_bad, n):
    rows = [(s, *r) for s in ("a", None) for q, h in ((1, per_good), (0, per_bad)) for r in made(rng, n // (5 if q == 0 else 1), q, h)]
    d = spark.createDataFrame(rows, "stratum string, quality int, " + COUNTS)
    cuts = rules.cutoffs(d.withColumn("half", (F.rand(rng.randrange(10**6)) < 0.5).cast("int"))).collect()
    fresh = spark.createDataFrame([("a", *r) for r in made(rng, 20_000, 1, per_good)], "stratum string, quality int, " + COUNTS)
    cut = {r.rule: r.cutoff for r in cuts if r.stratum == "a" and r.cutoff is not None}
    hit = F.lit(False)
    for r, c in cut.items():
        hit = hit | (rules._metric(r) > c)
    return fresh.filter(hit).count() / 20_000, cut, {r.stratum for r in cuts if r.cutoff is not None}


@pytest.mark.parametrize("share", [0.002, 0.007, 0.02])
def test_rules_together_stay_below_the_limit(spark, share):
    """Each rule alone may lose less than the limit; their union must not lose more."""
    gone, cut, _ = lost(spark, random.Random(int(share * 1e4)), share, 0.4, 8000)
    assert gone <= rules.LIMIT
    assert len(cut) < 6


def test_clean_rules_all_stand(spark):
    gone, cut, strata = lost(spark, random.Random(5), 0.0, 0.4, 4000)
    assert gone == 0 and len(cut) == 6 and strata == {"a", None}


def test_too_few_labels_reject_nothing(spark):
    assert lost(spark, random.Random(6), 0.0, 0.4, 300)[1] == {}


def test_bound_far_from_zero(spark):
    """The sum that starts below the mean against the normal quantiles, near which the exact bound lies for large n."""
    d = spark.createDataFrame([(n, dl) for n in (10_000, 1_000_000, 50_000_000) for dl in (0.05, 1e-4)], "n long, delta double")
    got = {(r.n, r.delta): r.k for r in d.withColumn("k", rules.allowed(F.col("n"), 0.01, F.col("delta"))).collect()}
    for n in (10_000, 1_000_000, 50_000_000):
        sd = (n * 0.01 * 0.99) ** 0.5
        assert abs((n * 0.01 - got[n, 0.05]) / sd - 1.645) < 0.05 + 1 / sd
        assert abs((n * 0.01 - got[n, 1e-4]) / sd - 3.719) < 0.15 + 1 / sd


def test_kept_equals_a_plain_walk(spark):
    """``kept`` of the query against the same walk written as loops."""
    from strata.llm import queries
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in queries.op9_rules(spark, sf).collect()}
    m = rules.counts(docs.select("doc_id", F.col("lang").alias("stratum"), "text"))
    metric = {r.doc_id: r for r in m.select("doc_id", "stratum", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"),
                                            *[rules._metric(x).alias(x) for x in rules.RULES]).collect()}
    quality = {r.doc_id: r.quality for r in rules.labels_of(labels).collect()}
    strata = {}
    for i, r in metric.items():
        if i in quality and not got[i].base_failed:
            strata.setdefault(r.stratum, []).append((r, quality[i]))
    chosen = {}
    held = {s for s, rows in strata.items() if any(r.half == 1 and q == 1 for r, q in rows)}
    for s, rows in strata.items():
        path = []
        n = sum(q == 1 for r, q in rows if r.half == 0)
        for rule in rules.RULES:
            best, js = 0.0, []
            for j, c in enumerate(rules._ladder(rule)):
                k = sum(q == 1 and r[rule] > c for r, q in rows if r.half == 0)
                gain = sum(q == 0 and r[rule] > c for r, q in rows if r.half == 0) - rules.LOSS_WEIGHT * k
                if 2 * k <= rules.LIMIT * n and gain > best:
                    best, js = gain, [j]
                elif js and gain == best and js[-1] == j - 1:
                    js.append(j)
            if js:
                path.append((-best, rule, (js[0] + js[-1]) // 2))
        good = [r for r, q in rows if r.half == 1 and q == 1]
        allowed = spark.range(1).select(rules.allowed(F.lit(len(good)).cast("long"), rules.LIMIT, F.lit(rules.DELTA / len(held))).alias("k")).first().k
        for m in range(len(path)):
            cuts = [(rule, rules._ladder(rule)[j]) for _, rule, j in sorted(path)[:m + 1]]
            if sum(any(r[x] > c for x, c in cuts) for r in good) <= allowed:
                chosen[s] = cuts
    for i, r in metric.items():
        assert got[i].kept == (not got[i].base_failed and not any(r[x] > c for x, c in chosen.get(r.stratum, [])))
