"""URL rules against a plain loop over all rules."""

import random

from strata.llm import queries, urlrules

SF = "/root/testdata/sf0.001"


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = []
    for v, h, p in rules:
        if None in (v, h, p):
            continue
        h = h.lower()
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith(p):
            fit.append((len(h) + len(p), len(h), h + p, v))
    return (host, path, max(fit)[2], max(fit)[3]) if fit else (host, path, None, default)


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], "page_id long, url string, rule string, n int")
    got = urlrules.judge(pages, urlrules.rules_frame(spark, rules)).collect()
    return [tuple(r)[1:] for r in sorted(got, key=lambda r: r.page_id)]


def test_random_rules_and_urls(spark):
    rng = random.Random(11)
    labels = ["a", "b", "com", "org", "ab", ""]
    paths = ["", "/", "/e", "/e/", "/e/1", "/e/12", "/f/", "/é"]

    def some_host(most):
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, most)))

    rules = [(rng.choice(["allow", "block"]), some_host(3), rng.choice(paths)) for _ in range(40)]
    rules += [("block", "", "/e/12"), ("block", None, "/"), ("allow", "com", None), ("block", "com", "/e"), ("allow", "com", "/e"), ("block", "COM", "/f/")]
    urls = [f"http{rng.choice(['', 's'])}://{some_host(4)}{rng.choice(paths)}{rng.choice(paths)}{rng.choice(['', '?q=/e/', '#x', '?a://b.com/e'])}"
            for _ in range(400)]
    urls += [None, "", "no scheme/e", "://", "x://COM/e/1", "http://com?/e", "http://é.com/e", "http://" + "a." * 300 + "com/e/" + "y" * 50_000]
    urls += ["http://a.com/e/1"] * 200
    assert judged(spark, urls, rules) == [brute(u, rules) for u in urls]


def test_empty_sides(spark):
    assert judged(spark, ["http://a.org/x"], []) == [("a.org", "/x", None, "allow")]
    assert judged(spark, [], urlrules.RULES) == []


def test_null_and_repeated_ids_stay(spark):
    pages = spark.createDataFrame([(None, "http://a.org/"), (None, "http://a.org/"), (3, "x://com/de/")], "page_id long, url string")
    got = urlrules.judge(pages, urlrules.rules_frame(spark)).collect()
    assert sorted((r.page_id or 0, r.rule, r.verdict) for r in got) == [(0, "org/", "allow")] * 2 + [(3, "com/de/", "block")]


def test_stack_over_many_blocks(spark):
    """Nested prefixes stay open over block borders."""
    from pyspark.sql import functions as F
    pts = spark.range(3000).select(F.concat(F.lit("a" * 5), F.col("id").cast("string")).cast("binary").alias("key"), F.struct("id").alias("p"))
    pre = spark.createDataFrame([(bytes(b),) for b in (b"a", b"aaa", b"aaaaa", b"aaaaa1", b"aaaaa29", b"b")], "prefix binary")
    got = {r.p.id: bytes(r.prefix) for r in urlrules.sweep(pts, pre, salt="p.id").collect()}
    for i in range(3000):
        assert got[i] == (b"aaaaa1" if str(i)[0] == "1" else b"aaaaa29" if str(i).startswith("29") else b"aaaaa")
    whole = urlrules.sweep(pts, pre, whole_stack=True, salt="p.id").groupBy("p").count().collect()
    assert all(r["count"] == (4 if str(r.p.id)[0] == "1" or str(r.p.id).startswith("29") else 3) for r in whole)


def test_query_judges_every_page(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op11_urls(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert tuple(r)[1:] == brute(pages[r.page_id], urlrules.RULES)
