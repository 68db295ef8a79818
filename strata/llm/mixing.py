"""Mixing sources to target word counts by entropy balancing.

Every document starts with rate 1. Per source the rates are tilted as little as
possible (in relative entropy) so that the words taken meet the source's target:
the solution is ``rate = min(cap, exp(lambda * size / scale))``, where lambda
solves a convex one-dimensional dual. All sources are solved together by Newton
steps kept inside a bracket; a step is one aggregation over the (source, size)
histogram, which is all the dual needs since equal sizes get equal rates.

Rates become whole copies in two steps: systematic rounding along the sizes (so
the error of a source stays below its largest document), then a few repair
rounds that move single copies of ever smaller documents until no document
brings the source closer. Inside a (source, size) cell the extra copies go to
the documents with the smallest hash, ranked in blocks of about 128 rows.

DataFrame operations only; the driver sees one scalar per round.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; documents of size 0 keep one copy and take nothing; an empty
table gives an empty result; repeated rows are documents of their own, equal
rows may get different copies; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strata.llm.common import SPACE, cut

WEIGHTS = (3, 1, 2)
BLOCK = 128
#: Newton stops at this relative error of every source's words, or after MAX_STEPS.
TOLERANCE, MAX_STEPS, REPAIRS = 1e-6, 60, 12


def word_count(text: str) -> Column:
    """Number of words without building a filtered array: blanks can only stand at the ends."""
    c = F.coalesce(F.col(text), F.lit(""))
    parts = F.split(c, SPACE)
    edge = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    return F.greatest(F.size(parts) - edge, F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt out by weight.

    ``weights`` repeat along the sources by code point, null last. A source stops
    at ``cap`` times its words; what it can't take is dealt out again by weight.
    Filling by the ratio of limit to weight gives the end of that dealing at once.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w).withColumn("limit", F.col("source_size") * cap)
    by_ratio = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    s = s.withColumn("budget", F.sum("source_size").over(W.partitionBy()) * share)
    s = s.withColumn("level", (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
                     / F.sum("weight").over(after))
    # the first source whose limit isn't reached sets the common level for itself and all after it
    ratio = F.col("limit") / F.col("weight")
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    s = s.withColumn("first", F.min(F.when(fits, ratio)).over(W.partitionBy()))
    s = s.withColumn("theta", F.max(F.when(fits & (ratio == F.col("first")), F.col("level"))).over(W.partitionBy()))
    t = F.when(F.col("theta").isNull(), F.col("limit")) \
        .otherwise(F.least(F.col("limit"), F.col("theta") * F.col("weight")))
    return s.select("source", "source_size", "n_docs", t.cast("double").alias("target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    import math
    return F.exp(F.least(lam * x, F.lit(math.log(cap))))


def solve(hist: DataFrame, goals: DataFrame, cap: float = 2.0) -> DataFrame:
    """Newton on the duals of all sources: (source, ..., lam); lam null where every copy is taken.

    Bracketed: a step that leaves [lo, hi] is replaced by bisection, so clipped
    (non-smooth) parts of the dual can't throw it off.
    """
    goals = goals.withColumn("scale", F.greatest(F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1)), F.lit(1.0)))
    goals = goals.withColumn("full", F.col("target") >= F.col("source_size") * cap * (1 - 1e-12))
    state = goals.select("*", F.lit(0.0).alias("lam"), F.lit(-64.0).alias("lo"), F.lit(64.0 * 1024).alias("hi"))
    state = cut(state, "mix-dual")
    for _ in range(MAX_STEPS):
        x = F.col("size") / F.col("scale")
        r = _rate(F.col("lam"), x, cap)
        got = (hist.join(state.filter(~F.col("full")), hist.source.eqNullSafe(state.source), "inner")
               .groupBy(state.source)
               .agg(F.sum(F.col("n") * F.col("size") * r).alias("got"),
                    F.sum(F.when(r < cap, F.col("n") * F.col("size") * x * r).otherwise(0.0)).alias("slope")))
        g = got.select(F.col("source").alias("g_source"), "got", "slope")
        j = state.join(g, F.col("source").eqNullSafe(F.col("g_source")), "left")
        off = F.col("got") - F.col("target")
        lo = F.when(off <= 0, F.greatest("lo", "lam")).otherwise(F.col("lo"))
        hi = F.when(off > 0, F.least("hi", "lam")).otherwise(F.col("hi"))
        j = j.withColumn("error", F.coalesce(F.abs(off) / F.greatest("target", F.lit(1.0)), F.lit(0.0)))
        j = j.withColumn("lo2", F.coalesce(lo, F.col("lo"))).withColumn("hi2", F.coalesce(hi, F.col("hi")))
        step = F.col("lam") - off / F.when(F.col("slope") > 0, F.col("slope"))
        inside = step.isNotNull() & (step > F.col("lo2")) & (step < F.col("hi2"))
        new = F.when(F.col("error") <= TOLERANCE, F.col("lam")).when(inside, step) \
            .otherwise((F.col("lo2") + F.col("hi2")) / 2)
        state = cut(j.select("source", "source_size", "n_docs", "target", "scale", "full",
                             F.when(F.col("got").isNull(), F.col("lam")).otherwise(new).alias("lam"),
                             F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), "error"), "mix-dual")
        worst = state.agg(F.max("error")).first()[0]
        state = state.drop("error")
        if worst is None or worst <= TOLERANCE:
            break
    return state


def _cells(hist: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """Whole copies per (source, size) cell by systematic rounding along the sizes."""
    j = hist.join(state.withColumnRenamed("source", "s_source"), F.col("source").eqNullSafe(F.col("s_source")))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("full"), F.lit(cap)) \
        .otherwise(F.round(_rate(F.col("lam"), F.col("size") / F.col("scale"), cap), 9))
    j = j.withColumn("rate", F.when(F.col("target") <= 0, F.when(F.col("size") == 0, 1.0).otherwise(0.0)).otherwise(rate))
    w = W.partitionBy("source").orderBy(F.col("size").desc())
    total = F.sum(F.col("n") * F.col("rate")).over(w.rowsBetween(W.unboundedPreceding, 0))
    prior = F.coalesce(F.sum(F.col("n") * F.col("rate")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    m = F.floor(total + 0.5 - 1e-7) - F.floor(prior + 0.5 - 1e-7)
    m = F.when(F.col("size") == 0, F.col("n")).otherwise(F.least(m, F.col("n") * int(cap)))
    return j.select("source", "size", "n", "target", m.cast("long").alias("m"))


def _repair(cells: DataFrame, cap: float) -> DataFrame:
    """Rounds of single-copy moves: each takes, per source, the largest size that still fits the gap."""
    for _ in range(REPAIRS):
        gap = cells.groupBy("source").agg((F.first("target") - F.sum(F.col("m") * F.col("size"))).alias("gap"))
        gap = gap.withColumnRenamed("source", "g_source")
        j = cells.join(gap, F.col("source").eqNullSafe(F.col("g_source")))
        room = F.when(F.col("gap") > 0, F.col("n") * int(cap) - F.col("m")).otherwise(F.col("m"))
        # a move of one copy helps when the document is less than twice the gap
        fits = (F.col("size") > 0) & (F.col("size") < 2 * F.abs("gap")) & (room > 0)
        count = F.greatest(F.least(room, F.floor(F.abs("gap") / F.col("size"))), F.lit(1))
        left = F.abs(F.abs("gap") - count * F.col("size"))
        pick = (j.filter(fits).groupBy(F.col("source").alias("p_source"))
                .agg(F.min(F.struct(left.alias("left"), F.col("size"), (F.signum("gap") * count).cast("long").alias("by")))
                     .alias("p")))
        pick = cut(pick, "mix-repair")
        if pick.isEmpty():
            break
        cells = cells.join(pick, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p.size")), "left")
        cells = cut(cells.select("source", "size", "n", "target",
                                 (F.col("m") + F.coalesce(F.col("p.by"), F.lit(0))).alias("m")), "mix-cells")
    return cells


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate cell copies, taken."""
    slim = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count("text").alias("size"))
    slim = cut(slim, "mix-sizes")
    hist = cut(slim.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-hist")
    goals = cut(targets(hist.select("source", (F.col("size") * F.col("n")).alias("size"), "n"), share, cap, weights)
                .drop("n_docs")
                .join(hist.groupBy(F.col("source").alias("h_source")).agg(F.sum("n").alias("n_docs")),
                      F.col("source").eqNullSafe(F.col("h_source"))).drop("h_source"), "mix-goals")
    state = solve(hist, goals, cap)
    cells = _repair(cut(_cells(hist, state, cap), "mix-cells"), cap)
    return _deal(slim, cells, goals)


def _deal(slim: DataFrame, cells: DataFrame, goals: DataFrame) -> DataFrame:
    """Give each cell's copies to its documents: everyone the same, the smallest hashes one more.

    Rows of one id are counted first and dealt with as one entry, so a repeated id is no group of rows."""
    c = cells.select(F.col("source").alias("c_source"), F.col("size").alias("c_size"), "n",
                     F.floor(F.col("m") / F.col("n")).alias("each"),
                     (F.col("m") % F.col("n")).alias("extra"))
    h = F.xxhash64(F.lit(17), F.col("doc_id").cast("string"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1))
    ids = slim.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    d = ids.join(c, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size")))
    d = d.withColumn("h", h).withColumn("block", F.when(F.col("extra") > 0, F.pmod(F.col("h"), blocks)).otherwise(0))
    whole = d.filter(F.col("extra") == 0).select("doc_id", "source", "size", "rows", "each", F.lit(0).cast("long").alias("more"))
    part = d.filter(F.col("extra") > 0)
    counts = part.groupBy("source", "size", "block").agg(F.sum("rows").alias("in_block"))
    prior = F.coalesce(F.sum("in_block").over(W.partitionBy("source", "size").orderBy("block")
                                              .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("source").alias("b_source"), F.col("size").alias("b_size"),
                           F.col("block").alias("b_block"), prior.alias("prior"))
    earlier = W.partitionBy("source", "size", "block").orderBy("h", F.col("doc_id").cast("string")).rowsBetween(W.unboundedPreceding, -1)
    part = part.withColumn("earlier", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).join(
        counts, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size"))
        & (F.col("block") == F.col("b_block")))
    # of the cell's rows in this order the first ``extra`` get one more
    more = F.greatest(F.lit(0), F.least(F.col("rows"), F.col("extra") - F.col("prior") - F.col("earlier"))).cast("long")
    part = part.select("doc_id", "source", "size", "rows", "each", more.alias("more"))
    g = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    out = whole.unionByName(part).join(g, F.col("source").eqNullSafe(F.col("g_source")))
    out = out.withColumn("at", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    out = out.withColumn("copies", F.col("each") + F.when(F.col("at") <= F.col("more"), 1).otherwise(0))
    return out.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                      F.col("copies").cast("long").alias("copies"),
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def take(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as the mix takes it; columns as given."""
    mixed = cut(mix(docs, share, cap, weights), "mix")
    # rows alike in id, source and size have copies that differ by one at most: some of them get one more
    per = mixed.groupBy(F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("size").alias("m_size")) \
        .agg(F.count("*").alias("rows"), F.sum("copies").alias("copies"))
    per = per.select("m_id", "m_source", "m_size", F.expr("copies div rows").alias("each"), F.expr("copies % rows").alias("more"))
    # the given columns travel in one struct, so whatever they are called meets no name used here
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                    F.col("source").cast("string").alias("source"), word_count("text").alias("size"))
    j = d.join(per, F.col("id").eqNullSafe(F.col("m_id")) & F.col("source").eqNullSafe(F.col("m_source")) & (F.col("size") == F.col("m_size")))
    some = per.filter("more > 0")
    n = F.col("each")
    if not some.isEmpty():
        rank = F.row_number().over(W.partitionBy("id", "source", "size").orderBy("row.text"))
        j = j.filter("more = 0").withColumn("rank", F.lit(1)).unionByName(j.filter("more > 0").withColumn("rank", rank))
        n = n + F.when(F.col("rank") <= F.col("more"), 1).otherwise(0)
    j = j.withColumn("n", n.cast("long")).filter("n > 0")
    return j.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select("row.*")
