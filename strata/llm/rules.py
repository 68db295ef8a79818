"""Quality rules with risk-controlled thresholds.

Every document gets counts over its whole text. A rule rejects a document whose
metric lies above a cutoff. Cutoffs are chosen on labelled documents so that, in
every stratum, the share of good documents that the rules reject *together* is below
``limit``, with confidence 1 - ``delta`` for all strata at once.

The labelled documents are split in two halves by a hash. On the first half each rule
proposes the cutoff with the best balance of bad documents caught to good
ones lost, among those that lose at most half of ``limit`` there, of equal neighbours the middle one; the
proposals are put in order of that balance. The second half is a holdout that
the proposals have not seen: it is walked along that order, adding one rule at a time. The rules so far
stand while the exact binomial tail ``P(Bin(n, limit) <= k)`` of the k good documents
that any of them rejects among n is at most ``delta`` divided by the number of strata. The
order is fixed before the holdout is looked at and the walk ends at the first failure, so
the steps need no further correction; the division corrects for the strata.

DataFrame operations only. The tail needs no table: its largest allowed k comes from one
running sum per stratum, over a stretch that grows with the root of n * limit.

Defined cases: null and blank texts have no words and fail the base rule; a
null stratum is a stratum of its own; a stratum with too few good labels in the holdout gets no
cutoff and rejects nothing; rows of one id are in the same half; documents with contradicting labels teach nothing;
repeated rows are judged each; empty tables give empty results. Windows are
compared by a 64-bit hash of their eight words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window as W

from strata.llm.common import SPACE, WORD, cut, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: rule -> (numerator, denominator); metrics are shares, so one ladder serves all.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "word_chars"),
    "marks": ("n_marks", "n_words"),
    "stutter": ("n_stutter", "n_words"),
    "long_words": ("word_chars", "n_words"),
}
#: Cutoffs from loose to strict, as shares; for ``long_words`` as mean word length.
LADDER = tuple(round(0.95 - 0.01 * i, 2) for i in range(95))
LENGTH_LADDER = tuple(round(24 - 0.25 * i, 2) for i in range(72))
LIMIT, DELTA, LOSS_WEIGHT = 0.01, 0.05, 5.0




def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the counts of each whole text (all long).

    Cut the result before filtering on a count: a filter pushed below would
    work the arrays out again inside its own lambdas.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    d = docs.withColumns({"_w": words(t), "_lines": lines})
    starts = F.when(F.size("_w") >= WINDOW, F.sequence(F.lit(0), F.size("_w") - WINDOW)).otherwise(F.array().cast("array<int>"))
    d = d.withColumn("_wh", F.transform("_w", lambda x: F.xxhash64(x))).withColumn("_starts", starts)
    at = lambda i, k: F.get(F.col("_wh"), i + k)
    d = d.withColumn("_g", F.transform("_starts", lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])))
    d = d.withColumn("_some", F.size(F.array_distinct("_g")) < F.size("_g"))
    sorted_ = F.array_sort(F.transform("_g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.col("_some"), sorted_))
    hit = lambda x, i: ((i > 0) & (F.get(F.col("_s"), i - 1)["h"] == x["h"])) | (
        F.coalesce(F.get(F.col("_s"), i + 1)["h"] == x["h"], F.lit(False)))
    d = d.withColumn("_p", F.array_sort(F.transform(F.filter("_s", hit), lambda x: x["i"])))
    # union of [p, p + 8): each start adds the gap to the next one, at most the window
    gaps = F.transform("_p", lambda p, i: F.coalesce(F.least(F.lit(WINDOW), F.get(F.col("_p"), i + 1) - p), F.lit(WINDOW)))
    n_rep = F.when(F.col("_some"), F.aggregate(gaps, F.lit(0), lambda a, x: a + x)).otherwise(0)
    word_chars = F.length(F.regexp_replace(t, SPACE, ""))
    out = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": word_chars.cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": n_rep.cast("long"),
        "n_stutter": F.size(F.filter("_wh", lambda x, i: (i > 0) & (F.get(F.col("_wh"), i - 1) == x))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_marks": (F.length(t) - F.length(F.translate(t, "!?", ""))).cast("long"),
        "n_upper": (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long"),
    })
    return out.drop("_w", "_lines", "_wh", "_starts", "_g", "_some", "_s", "_p")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _metric(rule: str) -> Column:
    num, den = RULES[rule]
    return F.coalesce(F.col(num) / F.when(F.col(den) > 0, F.col(den)), F.lit(0.0))


def _ladder(rule: str) -> tuple:
    return LENGTH_LADDER if rule == "long_words" else LADDER


def _passed(rule: str) -> Column:
    metric = _metric(rule)
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in _ladder(rule)]), lambda c: c >= metric))


def _log_factorial(x: Column) -> Column:
    """Stirling's series, exact to rounding from 20 on."""
    return x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)


def allowed(n: Column, limit: float, delta: Column) -> Column:
    """Largest k with P(Bin(n, limit) <= k) <= delta, or -1: a running sum in logarithms.

    It starts 40 standard deviations below the mean, where the tail is below 1e-300, or at 0, and
    ends at the mean, above which the tail exceeds a half.
    """
    odds = math.log(limit / (1 - limit))
    mean = n * limit
    low = F.greatest(F.lit(0), F.floor(mean - 40 * F.sqrt(mean))).cast("long")
    low = F.when(low < 20, F.lit(0).cast("long")).otherwise(low)
    x, top = low.cast("double"), n.cast("double")
    ways = F.when(low == 0, F.lit(0.0)).otherwise(_log_factorial(top) - _log_factorial(x) - _log_factorial(top - x))
    begin = ways + x * math.log(limit) + (top - x) * math.log1p(-limit)
    first = F.struct(begin.alias("term"), F.lit(0.0).alias("tail"), (low - 1).alias("k"), F.lit(True).alias("on"))

    def step(a, i):
        tail = a["tail"] + F.exp(a["term"])
        on = a["on"] & (tail <= delta)
        term = a["term"] + F.log((n - i).cast("double") / (i + 1)) + odds
        return F.struct(F.when(n > i, term).otherwise(F.lit(float("-inf"))).alias("term"), tail.alias("tail"),
                        F.when(on, i).otherwise(a["k"]).alias("k"), on.alias("on"))

    return F.aggregate(F.sequence(low, F.greatest(low, F.ceil(mean)).cast("long")), first, step, lambda a: a["k"])


def _proposed(d: DataFrame, limit: float, loss_weight: float) -> DataFrame:
    """(stratum, rule, cutoff, j, gain) from labelled documents (stratum, quality, rung): null cutoffs where none gains."""
    # rung j rejects metrics above ladder[j]: a document's first rejecting rung is the number of cutoffs it passes
    per = (d.select("stratum", "quality", F.explode("rung").alias("rule", "rung")).groupBy("stratum", "rule", "rung")
           .agg(F.count(F.when(F.col("quality") == 1, 1)).alias("good"),
                F.count(F.when(F.col("quality") == 0, 1)).alias("bad")))
    # a row per (stratum, rule) with the counts of its rungs: at most a ladder long
    tab = per.groupBy("stratum", "rule").agg(
        F.map_from_entries(F.collect_list(F.struct("rung", F.struct("good", "bad")))).alias("m"),
        F.sum("good").alias("n_good"))
    ladders = F.create_map(*[x for r in RULES for x in
                             (F.lit(r), F.array(*[F.lit(float(c)) for c in _ladder(r)]))])
    tab = tab.withColumn("ladder", F.element_at(ladders, F.col("rule")))
    zero = F.struct(F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad"))
    best0 = F.struct(F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("caught"),
                     F.lit(0.0).alias("gain"), F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"))

    def step(a, j):
        # cutoff j rejects every document whose number of rungs at or above its metric is <= j
        here = F.coalesce(F.try_element_at(F.col("m"), j), zero)
        k, caught = a["k"] + here["good"], a["caught"] + here["bad"]
        gain = caught - loss_weight * k
        better = (2 * k <= limit * F.col("n_good")) & (gain > a["gain"])
        same = (gain == a["gain"]) & (a["hi"] == j - 1)
        return F.struct(k.alias("k"), caught.alias("caught"), F.when(better, gain).otherwise(a["gain"]).alias("gain"),
                        F.when(better, j).otherwise(a["lo"]).alias("lo"),
                        F.when(better | same, j).otherwise(a["hi"]).alias("hi"))

    pick = F.aggregate(F.sequence(F.lit(0), F.size("ladder") - 1), best0, step)
    return tab.withColumn("p", pick).withColumn("j", F.expr("cast((p.lo + p.hi) div 2 AS int)")) \
        .select("stratum", "rule", F.get("ladder", F.col("j")).alias("cutoff"), "j", "p.gain")


def cutoffs(labelled: DataFrame, limit: float = LIMIT, delta: float = DELTA,
            loss_weight: float = LOSS_WEIGHT) -> DataFrame:
    """(stratum, rule, cutoff, n_good, k, allowed): the cutoff per stratum and rule, null where the rule does not stand;
    k of the n_good good documents in the holdout are rejected by the rule or one before it.

    ``labelled``: stratum, quality and the counts of documents that pass the base rule, and ``half`` (0 or 1) if the
    caller splits them (else a hash of the row does).
    """
    half = F.col("half") if "half" in labelled.columns else F.pmod(F.xxhash64(*labelled.columns), F.lit(2))
    rung = F.create_map(*[x for r in RULES for x in (F.lit(r), _passed(r))])
    d = labelled.select("stratum", "quality", rung.alias("rung"), half.alias("half"))
    proposed = cut(_proposed(d.filter("half = 0"), limit, loss_weight), "rule-proposals")
    # at most as many entries as there are rules
    paths = proposed.filter("cutoff IS NOT NULL").groupBy("stratum") \
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("gain")).alias("order"), "rule", "j"))).alias("path"))
    held = d.filter("half = 1 AND quality = 1").join(paths.withColumnRenamed("stratum", "p_stratum"),
                                                     F.col("stratum").eqNullSafe(F.col("p_stratum")), "left")
    first = F.array_min(F.transform("path", lambda p, i: F.when(F.element_at(F.col("rung"), p["rule"]) <= p["j"], i)))
    seen = held.select("stratum", F.coalesce(first, F.lit(-1)).alias("at")).groupBy("stratum", "at").agg(F.count("*").alias("n")) \
        .groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("m"), F.sum("n").alias("n_good"))
    strata = F.count("*").over(W.partitionBy())
    seen = seen.withColumn("allowed", allowed(F.col("n_good"), limit, F.lit(delta) / strata)).withColumnRenamed("stratum", "s_stratum")
    steps = paths.select("stratum", F.posexplode("path").alias("at", "p")).select("stratum", "at", "p.rule") \
        .join(seen, F.col("stratum").eqNullSafe(F.col("s_stratum")))
    k = F.aggregate(F.sequence(F.lit(0), F.col("at")), F.lit(0).cast("long"),
                    lambda a, i: a + F.coalesce(F.try_element_at(F.col("m"), i), F.lit(0).cast("long")))
    steps = steps.select("s_stratum", F.col("rule").alias("s_rule"), "n_good", k.alias("k"), "allowed")
    # k only grows along the path, so a rule that stands follows on rules that do
    j = proposed.join(steps, F.col("stratum").eqNullSafe(F.col("s_stratum")) & (F.col("rule") == F.col("s_rule")), "left")
    return j.select("stratum", "rule", F.when(F.col("k") <= F.col("allowed"), F.col("cutoff")).alias("cutoff"),
                    "n_good", "k", "allowed")


def labels_of(labels: DataFrame, column: str = "quality") -> DataFrame:
    """One label per id; ids with null or contradicting labels are left out."""
    g = labels.filter(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return g.filter("lo = hi").select("doc_id", F.col("lo").alias(column))


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = LIMIT,
                delta: float = DELTA) -> DataFrame:
    """doc_id, the counts, base_failed, rejected_by (array of rules), kept."""
    slim = counts(docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"), "text")).drop("text")
    slim = cut(slim.withColumn("base_failed", base_failed()), "rule-counts")
    lab = labels_of(labels)
    good = slim.filter(~F.col("base_failed")).join(lab, "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)))
    cuts = cutoffs(good, limit, delta)
    wide = cut(cuts.groupBy(F.col("stratum").alias("c_stratum"))
               .agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"c_{r}") for r in RULES]), "rule-cutoffs")
    d = slim.join(wide, F.col("stratum").eqNullSafe(F.col("c_stratum")), "left")
    hits = F.filter(F.array(*[F.when(_metric(r) > F.col(f"c_{r}"), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    d = d.withColumn("rejected_by", hits)
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", kept.alias("kept"), F.col("stratum"), "rejected_by")
