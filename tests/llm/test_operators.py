"""Each operator against brute force, an exact round trip or held-out accuracy."""

import gc
import glob
import math
import random
import time
import weakref
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.config import checkpoint_dir
from strata.llm import chat, common, embed, hmm, jaccard, langid, mixing, packing, quality, queries, rules, template

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))


# --- 1: mixing --------------------------------------------------------------

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, free = share * sum(sizes.values()), dict.fromkeys(order, 0.0), set(order)
    while free:
        left = budget - sum(target[s] for s in order if s not in free)
        total = sum(w[s] for s in free)
        over = {s for s in free if left * w[s] / total > cap * sizes[s]}
        if not over:
            for s in free:
                target[s] = left * w[s] / total
            break
        for s in over:
            target[s] = cap * sizes[s]
        free -= over
    return target


def test_mixing(spark, docs):
    got = rows(queries.op1_mixing(spark, SF))
    size = {i: len((r.text or "").encode().split()) for i, r in docs.items()}
    sources = Counter()
    for i, r in docs.items():
        sources[r.source] += size[i]
    want, taken = brute_targets(sources), Counter()
    for i, r in got.items():
        s = docs[i].source
        assert r["size"] == size[i] and r["source_size"] == sources[s]
        assert r["target"] == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s in sources:
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 20
    again = rows(queries.op1_mixing(spark, SF))
    assert {i: r["taken"] for i, r in got.items()} == {i: r["taken"] for i, r in again.items()}


def test_mixing_odd_rows(spark):
    d = spark.createDataFrame([(1, "a b", None, 0), (2, None, None, 0), (3, " ", "s", 0), (3, "x y z", "s", 1),
                               (3, "x y z", "s", 1), (None, "q", "t", 1)], "doc_id long, text string, source string, size int")
    got = mixing.mix(d).collect()
    assert len(got) == 6 and sum(r["size"] for r in got) == 2 + 6 + 1
    assert mixing.take(d).columns == d.columns
    assert mixing.take(d).agg(F.count("*")).first()[0] == sum(r["copies"] for r in got)
    assert mixing.mix(d.limit(0)).count() == 0


def test_mixing_with_clashing_names_and_a_hot_id(spark):
    rows = [(i % 40, f"w{i % 7} " * (i % 5), f"s{i % 3}", 1, 2, 3, 4, 5, 6, 7, 8) for i in range(200)]
    rows += [(999, "same text here", "s1", 1, 2, 3, 4, 5, 6, 7, 8)] * 100 + [(999, None, None, 1, 2, 3, 4, 5, 6, 7, 8)] * 3
    names = "doc_id long, text string, source string, t_id int, t_source int, size int, m_id int, copies int, rank int, row int, rows int"
    d = spark.createDataFrame(rows, names)
    mixed = mixing.mix(d)
    assert mixed.count() == 303
    out = mixing.take(d)
    assert out.columns == d.columns
    taken = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in out.collect())
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id, r.source, r["size"]] += r.copies
    assert taken == +want
    hot = [r.copies for r in mixed.filter("doc_id = 999 AND source = 's1'").collect()]
    assert len(hot) == 100 and max(hot) - min(hot) <= 1


# --- 2: quality -------------------------------------------------------------

def test_quality_held_out(spark):
    lab = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = rows(queries.op2_quality(spark, "/root/testdata/sf0.01"))
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(got[i]["predicted"], q) for i, q in lab.items() if got[i]["held_out"]]
    assert sum(p == q for p, q in held) >= 0.97 * len(held)


def test_quality_odd_rows(spark):
    d = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "\n \n", 9), (3, "a", 9), (4, "x" * 300_000, 9)],
                              "doc_id long, text string, score int")
    lab = spark.createDataFrame([(1, None), (2, 1), (2, 0)], "doc_id long, quality int")
    got = quality.classify(d, lab).collect()
    assert len(got) == 5 and all(r["score"] == pytest.approx(0.7) and r["predicted"] == 1 for r in got)
    assert quality.keep_good(d, lab).columns == d.columns and quality.keep_good(d, lab).count() == 5
    assert quality.classify(d.limit(0), lab.limit(0)).count() == 0


def test_pairwise_fit_separates():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 1, (200, len(quality.NAMES)))
    bad = good[:50] + np.eye(len(quality.NAMES))[0] * 8
    m = quality.fit(good, bad, n_pairs=5000)
    assert (m.score(good) >= 0.7).mean() > 0.97 and (m.score(bad) < 0.7).mean() > 0.97


# --- 3: language model ------------------------------------------------------

def test_forward_is_exact():
    rng = np.random.default_rng(1)
    m = hmm.Model.initial(rng.integers(0, 50, hmm.N_CLASSES))
    m.move = rng.dirichlet(np.ones(hmm.STATES), hmm.STATES)
    seqs = [rng.integers(0, hmm.N_CLASSES, n) for n in (1, 7, 3, 7)]
    for s, got in zip(seqs, hmm.forward(m, seqs)):
        a = m.start * m.emit[s[0]]
        for c in s[1:]:
            a = (a @ m.move) * m.emit[c]
        assert got == pytest.approx(math.log(a.sum()), rel=1e-9)


def test_expected_counts_match_brute_force():
    rng = np.random.default_rng(2)
    m = hmm.Model.initial(rng.integers(0, 50, hmm.N_CLASSES))
    seqs = [rng.integers(0, 30, n).astype(np.uint16) for n in (5, 2, 9)]
    emit, move, start, occ, ll = hmm.expected(m, seqs)
    assert occ.sum() == pytest.approx(16, rel=1e-4) and start.sum() == pytest.approx(3, rel=1e-4)
    assert move.sum() == pytest.approx(13, rel=1e-4) and ll == pytest.approx(hmm.forward(m, seqs).sum(), rel=1e-4)
    s, e0 = seqs[1], m.emit
    joint = (m.start * e0[s[0]])[:, None] * m.move * e0[s[1]]
    one = hmm.expected(m, [s])[1]
    assert np.allclose(one, joint / joint.sum(), rtol=1e-3, atol=1e-6)


def test_steps_over_segment_borders_are_counted():
    rng = np.random.default_rng(3)
    m = hmm.Model.initial(rng.integers(0, 50, hmm.N_CLASSES))
    seq = rng.integers(0, 30, 5 * hmm.SEGMENT + 7).astype(np.uint16)
    emit, move, start, occ, _ = hmm.expected(m, [seq])
    assert move.sum() == pytest.approx(len(seq) - 1, rel=1e-4) and start.sum() == pytest.approx(1, rel=1e-4)
    assert occ.sum() == pytest.approx(len(seq), rel=1e-4)
    assert np.allclose(emit.sum(1), np.bincount(seq, minlength=hmm.N_CLASSES), rtol=1e-3, atol=1e-3)
    # a chunk that begins inside a text brings the token before it along
    cut = 2 * hmm.SEGMENT + 3
    _, move, start, occ, _ = hmm.expected(m, [seq[:cut], seq[cut - 1:]], [True, False])
    assert move.sum() == pytest.approx(len(seq) - 1, rel=1e-4) and start.sum() == pytest.approx(1, rel=1e-4)
    assert occ.sum() == pytest.approx(len(seq), rel=1e-4)


def test_frequent_words_are_the_top_ones(spark, monkeypatch):
    monkeypatch.setattr(hmm, "TOP", 5)
    c = {f"w{i:02d}": n for i, n in enumerate([900, 700, 700, 64, 63, 63, 63, 8, 1, 1])}
    d = spark.createDataFrame([(w.encode(), n) for w, n in c.items()] + [(b"", 10**6)], "word binary, c long")
    assert [bytes(r.word).decode() for r in hmm.frequent(d).collect()] == ["w00", "w01", "w02", "w03", "w04"]
    assert hmm.frequent(d.limit(0)).count() == 0


def test_language_model(spark, docs):
    got = rows(queries.op3_hmm(spark, SF))
    n = Counter()
    for i, r in docs.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            n.update(hmm.tokens(r.text))
    total, types = sum(n.values()), len(n)
    for i, r in got.items():
        t = hmm.tokens(docs[i].text)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(n[w] > 0 for w in t), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((n[w] + 1) / (total + types + 1)) for w in t))
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_odd_rows(spark):
    d = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "A a É", "x"), (7, "b " * 50_000, "x"), (7, "b", "x")],
                              "doc_id long, text string, block string")
    got = hmm.score(d, rounds=2).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 2, 4, 50_001]
    assert all(math.isfinite(r["score"]) for r in got)
    assert hmm.score(d.limit(0), rounds=1).count() == 0
    none = hmm.score(d.filter("doc_id IS NULL"), rounds=1).first()
    assert none["held_out"] and none["train_tokens"] == 0 and none["n_known"] == 0


# --- 4: embeddings ----------------------------------------------------------

def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 16))
    near = base[:60] + rng.normal(size=(60, 16)) * 0.2
    x = np.concatenate([base, near, base[:5], np.zeros((1, 16)), base[7:8] * 1e200])
    data = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    data += [(900, None, 0), (901, [float("nan")] * 16, 0), (902, [None] * 16, 0), (903, [1.0, 0.0], 0), (904, [2.0, 0.0], 0),
             (905, [], 0)]
    got = {r.vec_id: r for r in embed.near_duplicates(
        spark.createDataFrame(data, "vec_id long, embedding array<double>, k1 int")).collect()}
    u = embed.unit([v.tobytes() for v in np.delete(x, 365, 0)])
    ids = [i for i in range(len(x)) if i != 365]
    link = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    assert sum(got[i].n_links for i in ids) == link.sum() > 100
    comp = {i: i for i in ids}
    for _ in ids:
        new = {i: min([comp[i]] + [comp[ids[j]] for j in np.flatnonzero(link[k])]) for k, i in enumerate(ids)}
        if new == comp:
            break
        comp = new
    assert all(got[i].component_id == comp[i] and got[i].kept == (comp[i] == i) for i in ids)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (365, 900, 901, 902, 905))
    assert got[903].n_links == got[904].n_links == 1 and got[904].component_id == 903
    assert embed.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_split_cells_count_each_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1, 8)) + rng.normal(size=(90, 8)) * 0.02
    monkeypatch.setattr(embed, "BLOCK", 16)
    got = embed.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                                      "vec_id long, embedding array<double>")).collect()
    assert all(r.n_links == 89 and r.component_id == 0 for r in got)


def test_calibration_grows_slowly():
    small, large = embed.calibrate(10_000), embed.calibrate(10_000_000)
    assert large.lines > small.lines and large.tables < 12 * small.tables


# --- 5: Jaccard -------------------------------------------------------------

def brute_components(texts, n, percent):
    sets = {i: set(jaccard.shingles(t, n).tolist()) for i, t in texts.items()}
    up = {i: i for i in texts}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    i, j = find(a), find(b)
                    up[max(i, j)] = min(i, j)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def near_texts(seed=3):
    rng, out = random.Random(seed), {}
    for g in range(12):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([5, 40, 150]))]
        for _ in range(rng.choice([1, 3, 9])):
            w = list(words)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
            out[len(out)] = " ".join(w)
    return out


@pytest.mark.parametrize("percent,n,shard", [(90, 3, 1024), (80, 5, 4)])
def test_jaccard_against_brute_force(spark, percent, n, shard):
    texts = near_texts() | {900: None, 901: "", 902: " \n", 903: "a b", 904: "A  b\n", 905: "a b c", 906: "É b"}
    d = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, rep int")
    comp, size = brute_components(texts, n, percent)
    got = rows(jaccard.link(d, n, percent, shard))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (size[i], comp[i]) for i in texts}
    kept = jaccard.keep_one(d.union(d.filter("doc_id = 900")), n, percent)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comp.values()))
    assert jaccard.link(d.limit(0)).count() == 0


def test_texts_of_one_id_go_or_stay_by_themselves(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    data = [(3, a, 0), (7, a + " end", 0), (7, b, 1), (7, b, 1), (7, c, 2), (7, None, 3), (8, c, 4), (9, "", 5),
            (3, a + " fin", 6), (None, "q", 7), (None, a, 8)]
    d = spark.createDataFrame(data, "doc_id long, text string, k1 int")
    got = jaccard.keep_one(d)
    assert got.columns == d.columns
    got = sorted((r.doc_id or 0, r.text or "", r.k1) for r in got.collect())
    assert [x for x in got if x[0] not in (0, 3)] == [(7, "", 3), (7, b, 1), (7, c, 2), (9, "", 5)]
    assert len([x for x in got if x[0] == 3]) == 1 and len([x for x in got if x[0] == 0]) == 2


def test_jaccard_tasks_hold_two_blocks(spark, monkeypatch):
    # a chain of keys through sets of which none link, and one key that all of them share
    sizes, search = spark.sparkContext.accumulator(0), jaccard._search

    def counted(percent):
        run = search(percent)

        def group(t):
            sizes.add(int(t.num_rows > 2 * 16 + 24))
            return run(t)
        return group

    monkeypatch.setattr(jaccard, "_search", counted)
    rng = random.Random(9)
    common = [f"c{k}" for k in range(80)]
    texts = {i: " ".join(common + [f"u{rng.randrange(10**9)}" for _ in range(24)]) for i in range(150)}
    texts |= {200 + i: texts[i] + " end" for i in range(0, 150, 10)}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    comp, _ = brute_components(texts, 3, 90)
    assert {r.doc_id: r.component_id for r in jaccard.link(d, 3, 90, 16).collect()} == comp
    assert len(set(comp.values())) == 150 and sizes.value == 0


def test_jaccard_splits_shards_by_bytes(spark):
    left = spark.createDataFrame([(1, i, 100_000, i) for i in range(40)], "key long, node long, size long, known long")
    m = [x for r in jaccard._tasks(left, 1024).collect() for x in r.m]
    assert len({x.block for x in m}) > 1 and max(Counter(x.block for x in m).values()) < 30


def test_jaccard_shuffles_the_texts_wanted(spark):
    docs = spark.range(40_000).selectExpr("id AS rep", "cast(id AS string) AS text").union(
        spark.createDataFrame([(None, "none"), (7, "again")], "rep long, text string"))
    got = jaccard._wanted(docs, spark.createDataFrame([(7,), (7,), (31_000,), (50_000,)], "rep long"))
    assert got.columns == docs.columns
    texts = [r.text for r in got.collect()]
    assert {"7", "again", "31000"} <= set(texts) and len(texts) == len(set(texts)) < 50
    assert jaccard._wanted(docs, spark.createDataFrame([], "rep long")).count() == 0


def test_jaccard_rounds_share_the_work(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", 3)
    texts = near_texts(5)
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    comp, _ = brute_components(texts, 5, 80)
    assert {r.doc_id: r.component_id for r in jaccard.link(d, 5, 80, 2).collect()} == comp


def test_used_up_files_go(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def there():
        now = files.getAllFiles()
        names = [now.apply(i).getName() for i in range(now.size())]
        return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}

    def tables():
        root = checkpoint_dir(spark).removeprefix("file://")
        return {x for t in ("sets", "keys", "met", "postings") for x in glob.glob(f"{root}/strata-llm/jaccard-{t}-*")}

    before, was = there(), tables()
    common.cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "freed")
    for _ in range(40):
        if not (left := there() - before):
            break
        time.sleep(0.25)
    d = spark.createDataFrame(list(near_texts(6).items()), "doc_id long, text string")
    assert jaccard.keep_one(d).count() and not left and tables() == was


def test_divide_skip_merges_long_and_short_lists():
    rng = random.Random(8)
    base = [rng.randrange(2**60) for _ in range(400)]
    sets = [np.unique(np.array([x for x in base if rng.random() > drop] + [rng.randrange(2**60) for _ in range(extra)], np.uint64))
            for drop, extra in [(0.02, 3)] * 30 + [(0.3, 100)] * 40]
    sets.sort(key=len)
    uf = jaccard.divide_skip(sets, 90)
    plain = jaccard.Union(len(sets))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
                plain.link(i, j)
    assert [uf.find(i) for i in range(len(sets))] == [plain.find(i) for i in range(len(sets))]


# --- 6: pages ---------------------------------------------------------------

PAGE = ("<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x='</p>';</script></head><body><nav><ul><li>m{0}<li>n"
        "</ul></nav><div class='cookie-notice'>We use</div><main><article class=post><header><h1>Head {0} &amp; more</h1>"
        "</header><p>One&nbsp; two\n three<br>four<p>{1} <b>bold</b>, <i>it</i><div class=\"ad\">buy</div><ul><li>x</li><li>y"
        "</ul><form><input><button>go</button></form><section id=comments><p>first!</p></section></article></main>"
        "<aside>side</aside><footer>&copy; f</footer></body></html>")


def test_page_text():
    want = "Head 1 & more\nOne two three four\nbody bold, it\nx\ny"
    assert template.main_text(PAGE.format(1, "body"), None) == want
    plain = "<body><div id=menu>a b c</div><div class=box><p>long text here <p>and more &lt;words&gt;</div><div class=footer>z</div>"
    assert template.main_text(plain, None) == "long text here\nand more <words>"
    assert template.main_text(None, None) == template.main_text("", "x") == ""
    assert template.main_text("a < b & c &am", None) == "a < b & c &am"


def test_templates_and_extraction(spark):
    data = [(i, f"http://h.example/{i}", PAGE.format(i, "w " * i)) for i in range(1, 6)]
    data += [(9, None, None), (10, "http://one.example/", "<p>alone"), (1, "http://h.example/1", PAGE.format(1, "w "))]
    d = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("host", F.lit("x"))
    got = template.extract(d).collect()
    assert len(got) == len(data)
    by = {r.page_id: r.text for r in got}
    assert by[3] == "Head 3 & more\nOne two three four\nw w w bold, it\nx\ny" and by[9] == "" and by[10] == "alone"
    assert all(r.n_chars == len(r.text) for r in got)
    t = template.templates(d).filter("main").collect()
    assert [(r.host, r.path) for r in t] == [("h.example", "html/body/main/article.post")]
    assert template.extract(d.limit(0)).count() == 0


def test_slots_come_from_classes_not_from_names(spark):
    page = ("<html><body><div class=xa><a>Home</a></div><div class=xb><h1>Head {0}</h1><div class=xs>{1}</div>"
            "<div class=xc>Written by our staff</div><p>text {1} of {0}</p>{2}</div><div class=xd>All rights</div></body></html>")
    more = "".join("<div class=q><i>Q:</i><p>said {0} %d</p></div>" % k for k in range(3))
    data = [(i, f"http://h.example/{i}", page.format(i, f"word{i} " * 9, more.format(i) if i % 2 else "<p>end</p>"))
            for i in range(6)]
    data += [(10 + i, f"http://c.example/?u={i}", page.format(1, "same", "")) for i in range(3)]
    d = spark.createDataFrame(data, "page_id long, url string, html string")
    by = {r.page_id: r.text for r in template.extract(d).collect()}
    w = ("word4 " * 9).strip()
    assert by[4] == f"Head 4\n{w}\ntext {w} of 4\nend"
    # a label that comes with every item of a list belongs to the template
    assert by[5].split("\n")[3:] == ["said 5 0", "said 5 1", "said 5 2"]
    # copies of one page are no template
    assert by[10] == by[12] and "text same of 1" in by[10]
    t = {(r.path.rpartition("/")[2], r.fixed): r for r in template.templates(d).filter("host = 'h.example'").collect()}
    assert t["div.xc", True].class_id == t["html", False].class_id and t["div.xb", False].main
    assert t["div.q", False].parent_class == t["html", False].class_id == t["i", True].parent_class
    assert t["i", True].class_id == t["div.q", False].class_id


def test_furniture_inside_the_article_slot(spark):
    """Adverts, forms, notices and comments that differ from page to page are no template text, but furniture."""
    page = ("<html><body class=comment-page><nav><a>Home {0}</a></nav><{2} class='post widget-{0}'><h1>Head {0}</h1><p>first {1}</p>"
            "<aside class=box>Buy product {0} now</aside><div class='xx ad-slot'><p>Offer {0}</p></div><p>second {1} <span class=promo>deal {0}</span></p>"
            "<form><label>Sign up {0}</label><input></form><div role=dialog>Cookies {0}</div><nav><ul><li>Page {0}</ul></nav>"
            "<section id=comments-{0}><ul><li><p>user{0} says nice</p><li>reply {0}</ul></section><header>by author {0}</header>"
            "</{2}><div class=foot>All rights {0}</div></body></html>")
    for tag in ("article", "div"):
        data = [(i, f"http://h.example/{i}", page.format(i, f"word{i} " * 60, tag)) for i in range(6)]
        data.append((10, "http://alone.example/1", page.replace("widget-", "n").format(7, "lone words here " * 20, "article")))
        d = spark.createDataFrame(data, "page_id long, url string, html string")
        by = {r.page_id: r.text for r in template.extract(d).collect()}
        w = ("word4 " * 60).strip()
        assert by[4] == f"Head 4\nfirst {w}\nsecond {w}\nby author 4"
        slot = template.templates(d).filter("main").collect()
        assert [r.path.rpartition("/")[2] for r in slot] == [f"{tag}.post.widget-#"]
        assert "product" not in by[10] and "first lone" in by[10]


# --- 7: chats ---------------------------------------------------------------

def test_chat_round_trip():
    rng = random.Random(4)
    parts = ["\\", "###", "</turn>", "\n", " ", "a", "### Assistant: ", "</tu", "turn>", "#", ":", "%3A", "\\\\", "é", ": "]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "sys:tem", "", "as###"]), "".join(rng.choices(parts, k=rng.randint(0, 6))))
                 for _ in range(rng.randint(0, 5))]
        text, spans, loss, rewrites = chat.spans(turns)
        assert chat.read_back(text) == turns and rewrites == -1
        assert [text[a:b] for a, b in spans] == [chat.render([t]) for t in turns]
        assert "".join(chat.unescape(text[a:b]) for a, b in loss) == "".join(t for r, t in turns if r == "assistant")


def test_templates_that_rewrite_history_are_found():
    numbered = lambda turns: f"<{len(turns)} turns>" + "".join(f"[{t}]" for _, t in turns)
    assert chat.spans([("user", "a"), ("assistant", "b")], numbered)[3] == 0
    last_only = lambda turns: "".join(f"[{t if i == len(turns) - 1 else '...'}]" for i, (_, t) in enumerate(turns))
    assert chat.spans([("user", "a"), ("assistant", "b")], last_only)[3] == 1


def test_chat_rows(spark):
    d = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, None, "q"), (1, 1, "assistant", "b"),
                               (2, None, "user", "x" * 200_000)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.format_chats(d.withColumn("turns", F.lit(1))).collect()}
    assert got[1].formatted == "### user: </turn>\n### assistant: b</turn>\n### assistant: b</turn>\n"
    assert got[None].formatted == "### : q</turn>\n" and got[2].n_turns == 1
    q = {r.conv_id: r for r in queries.op7_chat(spark, SF).collect()}
    assert q[-7].n_turns == 2 and q[-7].loss_chars == len(r"\### Assistant: </turn> ok")
    assert chat.digest(chat.format_chats(d.limit(0))).count() == 0


# --- 8: packing -------------------------------------------------------------

def test_ids_equal_the_tokenizer(docs):
    ids = packing.Ids(packing.default_tokenizer())
    texts = [r.text for r in docs.values()][:60] + [
        "I've İstanbul ΣΑΣ naïve 日本語 ½ x² y é ́a <|endoftext|>x \x00 \x1c a b it'S ẞ", "", None]
    for t in texts:
        want = ids.tok.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(ids.of(t), "<u4").tolist() == [*want, 1]


def test_words_are_split_as_the_pattern_does():
    """Plain words, and words before a comma or a full stop, don't go through the pattern; ids are the tokenizer's."""
    ids = packing.Ids(packing.default_tokenizer())
    asked, find = [], ids.find
    ids.find = lambda t: asked.append(t) or find(t)
    text = "Plain, w\u00f6rter. Stra\u00dfe \u00aa. don't l'ami. x1. 1. ,. a., \u0130a. \u01c5. a\u00ad. , ."
    got = np.frombuffer(ids.of(text), "<u4").tolist()
    assert got == [*ids.tok.encode(text, add_special_tokens=False).ids, packing.SEPARATOR]
    assert not {"plain,", "w\u00f6rter.", "stra\u00dfe", "\u00aa."} & set(asked) and "don't" in asked


def test_known_words_are_bounded(monkeypatch):
    """One pair of generations holds words and chunks, none of a long one; ids stay the tokenizer's."""
    monkeypatch.setattr(packing, "CACHE", 50)
    ids = packing.Ids(packing.default_tokenizer())
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    for text in (" ".join(words), " ".join(w + "," for w in words), " ".join(words[::-1]), "\u65e5\u672c" * 40, "ab." * 40):
        want = ids.tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.of(text), "<u4").tolist() == [*want, packing.SEPARATOR]
        held = [k for d in vars(ids).values() if isinstance(d, dict) for k in d]
        assert len(held) <= 2 * 50 and all(len(k) <= 64 for k in held)


def test_a_worker_keeps_what_one_operator_needs():
    """Known words go when another operator's rows come, and stay while packing reads its own."""
    path = packing.default_tokenizer()
    ids = weakref.ref(packing.loaded(path))
    assert packing.loaded(path) is ids()
    list(common.rows_of(iter([]), []))
    gc.collect()
    assert ids() is None


def test_packing(spark, docs):
    got = queries.op8_packing(spark, SF).collect()
    ids = packing.Ids(packing.default_tokenizer())
    seq, back = {}, {}
    for r in got:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        back.setdefault(r.doc_id, []).append(r)
    for parts in seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    for i, d in docs.items():
        raw = ids.of(d.text)
        parts = sorted(back[i], key=lambda r: r.piece)
        assert [r.start for r in parts] == list(range(0, len(raw) // 4, 4096))
        assert [r.ids_crc32 for r in parts] == [zlib.crc32(raw[k:k + 4 * 4096]) for k in range(0, len(raw), 4 * 4096)]
    total = sum(r.length for r in got)
    assert len(seq) <= -(-total // 4096) * 1.03 + 2


def test_packed_sequences_and_odd_rows(spark):
    d = spark.createDataFrame([(1, None, 0), (2, "a b c", 0), (3, "d " * 9000, 0)], "doc_id long, text string, ids int")
    placed = packing.pack(d, capacity=64)
    assert placed.filter("doc_id = 1").first().length == 1
    s = packing.sequences(d, placed, capacity=64).collect()
    assert sum(len(r.ids) for r in s) == placed.agg(F.sum("length")).first()[0]
    assert all(len(r.ids) <= 64 for r in s)
    assert packing.pack(d.limit(0)).count() == 0
    twice = packing.pack(d.union(d), capacity=64)
    assert twice.count() == 2 * placed.count()


def test_placement_is_the_sum_of_squares_choice():
    """Every placement against trying all open bins and summing the squares anew."""
    rng = random.Random(8)
    for capacity in (7, 20):
        for _ in range(40):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
            gaps, want = [], {}
            for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
                s, best = lengths[i], None
                for g in sorted({g for g in gaps if g >= s and g > 0}):
                    after = Counter(gaps) - Counter([g]) + Counter([g - s])
                    cost = sum(n * n for gap, n in after.items() if gap > 0)
                    if best is None or cost < best[0]:
                        best = cost, g
                want[i] = capacity - (best[1] if best and s < capacity else capacity)
                if best and s < capacity:
                    gaps.remove(best[1])
                    gaps.append(best[1] - s)
                else:
                    gaps.append(capacity - s)
            bins, offsets = packing.place(np.array(lengths, np.int64), capacity)
            assert offsets.tolist() == [want[i] for i in range(len(lengths))]
            left = Counter(capacity - int(sum(lengths[i] for i in np.flatnonzero(bins == b))) for b in set(bins.tolist()))
            assert +left == +Counter(gaps)


@pytest.mark.parametrize("most", [30, 10**6])
def test_packing_levels_with_loose_bins(spark, monkeypatch, most):
    """Pieces that leave wide gaps go through all levels; no task gets them all, none is lost."""
    monkeypatch.setattr(packing, "TASK_PIECES", most)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rng = random.Random(9)
    rows = [(i, 0, 0, rng.choice([5, 30, 51, 52, 60]), i) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(16)
    got = packing.assign(d, 100).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(i, n) for i, _, _, n, _ in rows]
    seq = {}
    for r in got:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 100
    big = sum(r.length > 50 for r in got)
    assert big <= len(seq) <= big + (2 if most > 400 else 60)


# --- 9: rules ---------------------------------------------------------------

def brute_counts(text):
    t = text or ""
    w = t.encode().split()
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines, dup = set(), 0
    for x in t.split("\n"):
        if x.encode().split():
            dup += x in lines
            lines.add(x)
    return (len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit))


def test_rule_counts(spark, docs):
    extra = {-1: None, -2: "", -3: "\n\n a \n a\n", -4: "a b c d e f g h " * 3, -5: "x y " * 40, -6: " \x0b\x1c q", -7: "l " * 30_000}
    texts = {i: r.text for i, r in docs.items()} | extra
    d = spark.createDataFrame([(i, t, "en", 1) for i, t in texts.items()], "doc_id long, text string, lang string, n_words int")
    got = rows(rules.apply_rules(d, spark.read.parquet(f"{SF}/labels.parquet")))
    for i, t in texts.items():
        r = got[i]
        want = brute_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert rules.apply_rules(d.limit(0), spark.read.parquet(f"{SF}/labels.parquet")).count() == 0


def test_binomial_bound(spark):
    cases = [(0, 0.01), (50, 0.002), (700, 0.01), (1000, 0.01), (20_000, 0.002), (300_000, 0.002)]
    d = spark.createDataFrame(cases, "n long, delta double")
    got = {(r.n, r.delta): r.k for r in d.withColumn("k", rules.allowed(F.col("n"), 0.01, F.col("delta"))).collect()}
    for n, delta in cases:
        k, tail, term = -1, 0.0, n * math.log(0.99)
        for i in range(n + 1):
            tail += math.exp(term)
            if tail > delta:
                break
            k = i
            term += math.log((n - i) / (i + 1)) + math.log(0.01 / 0.99) if n > i else -math.inf
        assert got[n, delta] == min(k, math.ceil(n * 0.01))


def test_cutoffs_hold_the_limit(spark):
    rng = random.Random(2)
    data = [("en", int(rng.random() > 0.2)) for _ in range(6000)] + [("xx", 1)] * 30
    made = []
    for lang, q in data:
        sym = rng.uniform(0, 0.05) if q else rng.uniform(0.2, 0.6)
        made.append((lang, q, 100, 500, int(500 * sym), 0, 0, 5, 0, 5, 0))
    d = spark.createDataFrame(made, "stratum string, quality int, n_words long, word_chars long, n_symbols long, "
                                    "n_dup_lines long, n_repeat_words long, n_lines long, n_marks long, n_upper long, n_stutter long")
    cuts = {(r.stratum, r.rule): r for r in rules.cutoffs(d).collect()}
    c = cuts["en", "symbols"]
    assert 0.05 <= c.cutoff < 0.2 and c.k <= c.allowed
    assert cuts["xx", "symbols"].cutoff is None and cuts["en", "repeats"].cutoff is None


# --- 10: language ID --------------------------------------------------------

def test_language_held_out(spark):
    d = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    got = rows(queries.op10_langid(spark, d))
    held = [i for i, r in got.items() if r["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum(got[i]["lang_pred"] == lang[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_odd_rows(spark):
    d = spark.createDataFrame([(1, None, "en", 0), (2, "12 !?", "en", 0), (3, "the cat " * 9, "en", 0),
                               (4, "der Hund " * 9, "de", 0), (4, "der Hund " * 9, None, 0)],
                              "doc_id long, text string, lang string, h int")
    got = langid.identify(d).collect()
    assert [r.lang_pred for r in got if r.doc_id in (1, 2)] == ["und", "und"]
    assert langid.keep_identified(d).columns == d.columns
    assert langid.identify(d.limit(0)).count() == 0
    none = langid.identify(d.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
