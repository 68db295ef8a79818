"""Jaccard self-join on word n-grams: T-occurrence search with DivideSkip.

A document is the set of its distinct lower-case word n-grams (64-bit hashes).
Equal sets are collapsed first, by a 128-bit digest, so a group of copies is one
node however large it is.

The inverted index is sharded by keys: sets that reach the threshold must share
one. Each set draws keys, each of a few minima of its hashes. Two sets at the
threshold share no key with probability ``MISS`` or less (0.9: 24 keys of 5
minima), and only then could a link be missed. Keys are written and shuffled once, for
distinct sets only. Sets whose sizes are too far apart can't link: sizes are cut into
bands in which linked sets are equal or next, and a set with no other one of its key in
its band or the next is done. First the sets of a key and band are compared
with the smallest id there (a line per set, not per pair). Sets still in another component
than one of their key in a near band are the shards, each group of sets
once. Chains over several keys are never gathered.

Inside a shard the search is exact. For a query set of size n at least
``T = ceil(t * n)`` of its lists must name a partner, as the common part is at
least t of the union. The longest lists (their
number set by the DivideSkip rule) are put aside; the short ones are merged (by
a heap, or one sort once they are long) and ids that occur often enough are
looked up in the long lists by binary search. Partners already connected need
no look-up, since the result is the components.

A shard of more than ``SHARD`` sets or ``SHARD_BYTES`` is split in blocks by hash, and
each pair of blocks is a task: a task holds two blocks, however common a key is. The
tasks run in ``ROUNDS`` rounds, and files go when nothing reads them any more, to spare disk.

Defined cases: null and blank texts have no n-grams and stay alone; texts
shorter than n words are one n-gram; a null doc_id gets a null component; rows
with the same doc_id and different texts are linked each by its own text; an empty table gives an
empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.common import Buffer, cut, forget, rows_of, slices
from strata.llm.components import components

N, PERCENT = 3, 90
#: Chance that a pair at the threshold shares no key; minima drawn for it at most.
MISS, MINIMA = 1e-9, 160
#: Sets of a block, and bytes of them with what a set costs besides its hashes.
SHARD, SHARD_BYTES, SET_BYTES = 1024, 8 << 20, 256
#: Rounds of the search, each with a part of the pairs of blocks; the shuffle files of one go before the next.
ROUNDS = 4
#: Bits of the map of wanted doc_ids, 4 KB for each 32768; with more ids than bits it lets more texts through.
MAP_BITS = 1 << 24
#: DivideSkip's weight of a heap step against a look-up.
MU = 0.0085
WORD_CACHE = 50_000

_K1, _K2, _K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K3
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text."""
    ws = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not ws:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > WORD_CACHE:
        _WORDS.clear()
    get = _WORDS.get
    ids = []
    for w in ws:
        h = get(w)
        if h is None:
            h = _WORDS[w] = xxhash.xxh64_intdigest(w)
        ids.append(h)
    h = np.array(ids, np.uint64)
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = _mix(out * _K1 + h[i:len(h) - k + 1 + i] * _K2)
    return np.unique(out)


@lru_cache
def _layout(percent: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """(keys, minima a key, two numbers per minimum): the longest keys that ``MINIMA`` allows."""
    t, best = percent / 100, (1, 1)
    for rows in range(1, MINIMA):
        bands = math.ceil(math.log(MISS) / math.log1p(-min(t ** rows, 1 - 1e-12)))
        if bands * rows <= MINIMA or rows == 1:
            best = bands, rows
    rng = np.random.default_rng(20240607)
    n = best[0] * best[1]
    return *best, rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) | np.uint64(1)


def band_keys(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys by which sets that may link meet; sets too small to link with a different one have none."""
    # different sets link only if at least percent/(100-percent) n-grams are common
    if len(s) * (100 - percent) < percent:
        return np.zeros(0, np.int64)
    bands, rows, xor, mul = _layout(percent)
    low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        low = np.minimum(low, ((s[at:at + 4096, None] ^ xor) * mul).min(0))
    key = np.arange(bands, dtype=np.uint64)
    for col in low.reshape(bands, rows).T:
        key = _mix(key * _K1 + col)
    return key.view(np.int64)


def signatures(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands): size, digest and shard keys of every row's set; ``_linked`` numbers the rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                        ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema)
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            s = shingles(text, n)
            out.add(doc_id, len(s), *(_digest(s) if len(s) else (None, None)), band_keys(s, percent))
            if out.full():
                yield out.flush()
        yield out.flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


class Union:
    def __init__(self, n: int):
        self.up, self.parts = list(range(n)), n

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.parts -= 1


def divide_skip(sets: list[np.ndarray], percent: int = PERCENT, ask: list[bool] | None = None,
                group: list[int] | None = None) -> Union:
    """Connects the sets of one shard that link; exact.

    ``sets`` ordered by size. ``ask``: which sets are queries (all by default); a
    query meets every larger set, and the smaller ones that aren't queries.
    ``group``: components known before, which need no search inside.
    """
    n = len(sets)
    uf = Union(n)
    if group is not None:
        first: dict[int, int] = {}
        for i, g in enumerate(group):
            uf.link(first.setdefault(g, i), i)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")  # lists keep ascending owners
    flat, owner = flat[order], owner[order]
    new = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, np.int64)
    length = np.diff(np.r_[new, len(flat)])
    of_entry = np.repeat(np.arange(len(new)), length)
    by_owner = np.argsort(owner, kind="stable")
    at = np.r_[0, np.cumsum(sizes)]
    for x in range(n):
        if uf.parts == 1:
            break
        if ask is not None and not ask[x]:
            continue
        lists = of_entry[by_owner[at[x]:at[x + 1]]]
        lists = lists[length[lists] > 1]
        need = -(-percent * int(sizes[x]) // 100)
        if len(lists) < need or not need:
            continue
        lists = lists[np.argsort(length[lists], kind="stable")]
        longest = int(length[lists[-1]])
        aside = min(need - 1, int(need / (MU * math.log2(longest) + 1)))
        short, long_ = lists[:len(lists) - aside], lists[len(lists) - aside:]
        runs = [owner[new[q]:new[q] + length[q]] for q in short]
        if sum(map(len, runs)) <= 4096:
            found: dict[int, int] = {}
            for y in heapq.merge(*[r.tolist() for r in runs]):
                found[y] = found.get(y, 0) + 1
            cand = [(y, c) for y, c in found.items() if c >= need - aside]
        else:
            ys, cs = np.unique(np.concatenate(runs), return_counts=True)
            ok = cs >= need - aside
            cand = list(zip(ys[ok].tolist(), cs[ok].tolist()))
        here = uf.find(x)
        cand = [(y, c) for y, c in cand if (y > x or (ask is not None and y != x and not ask[y])) and uf.find(y) != here
                and percent * max(sizes[x], sizes[y]) <= 100 * min(sizes[x], sizes[y])]
        if not cand:
            continue
        ys = np.array([y for y, _ in cand])
        both = np.array([c for _, c in cand])
        for q in long_:
            run = owner[new[q]:new[q] + length[q]]
            p = np.searchsorted(run, ys)
            both += run[np.minimum(p, len(run) - 1)] == ys
        link = 100 * both >= percent * (sizes[x] + sizes[ys] - both)
        for y in ys[link].tolist():
            uf.link(x, y)
    return uf


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _search(percent: int):
    """Group function: a block or a pair of blocks of a shard to edges (member, smallest connected member)."""

    def run(t: pa.Table) -> pa.Table:
        ids, block = t.column("node").to_pylist(), t.column("block").to_pylist()
        two = t.column("i")[0].as_py() != t.column("j")[0].as_py()
        if len(ids) < 2 or two and len(set(block)) < 2:
            return _EDGE.empty_table()
        sets = [np.frombuffer(b, np.uint64) for b in t.column("s").to_pylist()]
        known, first = t.column("known").to_pylist(), min(block)
        order = sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i]))
        uf = divide_skip([sets[i] for i in order], percent, [block[i] == first for i in order] if two else None,
                         [known[i] for i in order])
        members: dict[int, list[int]] = {}
        for k, i in enumerate(order):
            members.setdefault(uf.find(k), []).append(i)
        new = [m for m in members.values() if len({known[i] for i in m}) > 1]
        a = [known[i] for m in new for i in m]
        b = [low for m in new for low in [min(known[i] for i in m)] * len(m)]
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE)

    return run


def _digest(s: np.ndarray) -> tuple[int, int]:
    k = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
    return int(k[0]), int(k[1])


def _wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``rep`` is among ``ids`` and a few others, by a bit map of hashes, without a shuffle of ``docs``."""
    at = F.pmod(F.xxhash64("rep"), F.lit(MAP_BITS)) + 1
    maps = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    found = docs.withColumn("at", at).withColumn("bucket", F.bitmap_bucket_number("at")).join(F.broadcast(maps), "bucket")
    byte = F.expr("cast(conv(hex(substring(bits, cast(bitmap_bit_position(at) div 8 + 1 as int), 1)), 16, 10) as int)")
    return found.filter(F.getbit(byte, F.expr("cast(bitmap_bit_position(at) % 8 as int)")) == 1).select(*docs.columns)


def _sets(docs: DataFrame, need: DataFrame, n: int) -> DataFrame:
    """(node, s): the sets of ``need`` (node, rep, k1, k2, many) only; ``many``: rep is the id of several rows."""
    schema = pa.schema([("node", pa.int64()), ("many", pa.bool_()), ("s", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema, 512)
        for node, many, k1, k2, text in rows_of(batches, ["node", "many", "k1", "k2", "text"]):
            s = shingles(text, n)
            if _digest(s) == (k1, k2):  # else another text with this id
                out.add(node, many, s.tobytes())
            if out.full():
                yield out.flush()
        yield out.flush()

    d = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    sets = cut(_wanted(d, need).join(need, "rep").select("node", "many", "k1", "k2", "text")
               .mapInArrow(run, "node long, many boolean, s binary"), "jaccard-postings")
    several = sets.filter("many").groupBy("node").agg(F.first("s").alias("s"))
    return sets.filter("NOT many").select("node", "s").union(several)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(_EDGE)
        for a, b, x, y in rows_of(batches, ["a", "b", "x", "y"]):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if percent * max(len(x), len(y)) > 100 * min(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                out.add(a, b)
                if out.full():
                    yield out.flush()
        yield out.flush()

    x = sets.select(F.col("node").alias("a"), F.col("s").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _nodes(sig: DataFrame) -> DataFrame:
    """(k1, k2, node, rep): distinct sets; node is the number of one of its rows, rep its smallest doc_id."""
    return sig.filter("k1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("k1", "k2") \
        .agg(F.min("row").alias("node"), F.min("doc_id").alias("rep"))


def _keys(sig: DataFrame) -> DataFrame:
    """(key, node, size): the keys of every distinct set, dealt out by key."""
    one = sig.filter("k1 IS NOT NULL AND doc_id IS NOT NULL").groupBy("k1", "k2") \
        .agg(F.min("row").alias("node"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    return one.select(F.explode("bands").alias("key"), "node", "size").repartition("key")


def _near(rows: DataFrame, what: str) -> DataFrame:
    """(key, band, lo, hi, around): least and greatest ``what`` of a key's sets in a band and the two next to it, and their number."""
    per = rows.groupBy("key", "band").agg(F.min(what).alias("lo"), F.max(what).alias("hi"), F.count("*").alias("n"))
    return per.select("key", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "lo", "hi", "n") \
        .groupBy("key", "band").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("around"))


def link(docs: DataFrame, n: int = N, percent: int = PERCENT, shard: int = SHARD) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    return _linked(docs, n, percent, shard).select("doc_id", "n_shingles", "component_id")


def _linked(docs: DataFrame, n: int, percent: int, shard: int = SHARD) -> DataFrame:
    """``link`` with the digest (k1, k2) of the row's set and a component of its own text (component_id: its smallest doc_id)."""
    sig = signatures(docs, n, percent).withColumn("row", F.monotonically_increasing_id())
    sig = cut(sig, "jaccard-sets")
    nodes = cut(_nodes(sig), "jaccard-nodes")
    keys = _keys(sig)
    # sizes are looked at here as well so that both uses of the keys read the same columns, and so one exchange
    shared = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.max("size").alias("size")) \
        .filter("a <> z AND size > 0").select("key")
    # a linked set is at most 100/percent times as large, so its band is the same or the next
    width = math.log(100 / percent) * 1.000001 if percent < 100 else 1.0
    by_key = cut(keys.join(shared, "key").withColumn("band", F.floor(F.log("size") / width)), "jaccard-keys")
    rows = cut(sig.drop("bands", "row"), "jaccard-rows")
    forget(sig)
    met = by_key.join(_near(by_key, "node").filter("lo <> hi"), ["key", "band"])
    low = met.groupBy("key", "band").agg(F.min("node").alias("a"), F.count("*").alias("n"))
    met = cut(met.drop("lo", "hi").join(low, ["key", "band"]), "jaccard-met")
    forget(by_key)
    many = rows.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("rep"), F.lit(True).alias("many"))
    need = nodes.join(met.select("node").distinct(), "node").join(many, "rep", "left") \
        .withColumn("many", F.coalesce("many", F.lit(False)))
    need = cut(need, "jaccard-need")
    sets = _sets(docs, need, n)
    pairs = met.filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    edges = cut(_verify(pairs, sets, percent), "jaccard-edges")
    comp = components(edges)
    # two sets alone in a band have been compared; of more, those near one of another component are left
    left = met.filter("around > 2 OR n < around").join(comp.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left") \
        .select("key", "band", "node", "size", F.coalesce("component", "node").alias("known"))
    left = cut(left, "jaccard-left")
    apart = _near(left, "known").filter("lo <> hi").select("key", "band")
    left = cut(left.join(apart, ["key", "band"], "left_semi"), "jaccard-left")
    far = _rest(left, sets, percent, shard)
    forget(met, sets)
    if not far.isEmpty():
        comp = components(far.union(comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    both = nodes.join(comp.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left") \
        .select("k1", "k2", "rep", F.coalesce("component", "node").alias("component"))
    smallest = both.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = both.join(smallest, "component").select("k1", "k2", "component", "component_id")
    return rows.join(found, ["k1", "k2"], "left") \
        .select("doc_id", "n_shingles", "k1", "k2", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def _tasks(left: DataFrame, shard: int) -> DataFrame:
    """(node, known, m): where the sets of keys in several components go; m is an array of (key, block, pairs of blocks)."""
    h = F.xxhash64("node")
    group = left.groupBy("key").agg(F.count("*").alias("n"), F.min("known").alias("c1"), F.max("known").alias("c2"),
                                    F.sum(8 * F.col("size") + SET_BYTES).alias("bytes"),
                                    F.sum(h.cast("decimal(20,0)")).alias("sum"), F.bit_xor(h).alias("xor")).filter("c1 <> c2")
    # keys of the same sets are one shard
    group = group.groupBy("n", "bytes", "sum", "xor").agg(F.min("key").alias("key"))
    group = group.select("key", F.greatest(F.ceil(F.col("n") / shard), F.ceil(F.col("bytes") / SHARD_BYTES)).alias("blocks"))
    at = left.join(group, "key").withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                        lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")))
    return at.groupBy("node", "known").agg(F.collect_list(F.struct("key", "block", pairs.alias("pairs"))).alias("m"))


def _rest(left: DataFrame, sets: DataFrame, percent: int, shard: int) -> DataFrame:
    """Edges between the components of keys that hold several, by an exact search in pairs of blocks, ``ROUNDS`` of them."""
    d = _tasks(left, shard).select("node", "known", F.explode("m").alias("m")) \
        .select("node", "known", "m.key", "m.block", F.explode("m.pairs").alias("p"))
    d = cut(d.select("node", "known", "key", "block", "p.i", "p.j"), "jaccard-tasks")
    found = None
    for k in range(ROUNDS):
        part = d.filter(F.pmod(F.xxhash64("key", "i", "j"), F.lit(ROUNDS)) == k).join(sets, "node")
        part = cut(part.select("node", "known", "s", "key", "block", "i", "j").groupBy("key", "i", "j")
                   .applyInArrow(_search(percent), "a long, b long").distinct(), "jaccard-edges")
        found = part if found is None else found.union(part)
    return found


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component; columns as given.

    A row with the smallest doc_id stays. Rows of one id go or stay each by its own text.
    """
    found = cut(_linked(docs, n, percent), "jaccard-found")
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    often = found.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    gone, often = cut(gone, "jaccard-gone"), cut(often, "jaccard-often")
    if often.isEmpty():
        forget(found)
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    once = docs.join(gone.union(often), "doc_id", "left_anti")
    stay = found.filter("doc_id = component_id").join(often, "doc_id", "left_semi") \
        .groupBy("doc_id", "component").agg(F.min(F.struct("k1", "k2")).alias("k"))
    stay = cut(stay.select(F.col("doc_id").alias("id"), "k.k1", "k.k2"), "jaccard-stay")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingles(t, n) for t in b.column(2).to_pylist()]
            k = [_digest(x) if len(x) else (None, None) for x in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in zip(*k))],
                                             names=["row", "id", "k1", "k2"])

    rows = docs.join(often, "doc_id", "left_semi")
    rows = rows.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    whole = StructType([rows.schema["row"], rows.schema["id"], StructField("k1", LongType()), StructField("k2", LongType())])
    rows = rows.mapInArrow(digests, whole).dropDuplicates(["id", "k1", "k2"])
    same = (rows.id == stay.id) & rows.k1.eqNullSafe(stay.k1) & rows.k2.eqNullSafe(stay.k2)
    return once.unionByName(rows.join(stay, same, "left_semi").select("row.*")).select(*docs.columns)
