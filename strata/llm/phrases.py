"""Phrase collocations by weighted acyclic automata.

Every word starts one n-gram: itself and up to four words after it in its piece.
The counts of all shorter phrases are sums over n-grams with that prefix, so one
entry a word is enough for every length.

1. Count transducers. A task sorts the n-grams of up to ``SHARD_WORDS`` words and
   builds, from the sorted list, an acyclic automaton over (language, words): an
   arc's weight is the number of n-grams below it. States are closed as
   the list leaves their prefix; tails with equal arcs are one state. The list is
   cut at the borders of prefix ranges, one automaton a shard and range, so only
   automata are shuffled.
2. Union. The automata of a range are walked together, layer by layer: arcs with
   the same path are one, their weights are summed, and a path below the least
   count ends there (all that lies below it counts less). Borders are n-grams
   sampled from the texts; the few prefixes that a border splits have their sums added up
   over the ranges afterwards. A hot word or passage is one path of a shard's
   automaton, however often it comes; its n-grams are cut at borders like any.
3. Part look-ups. A frequent phrase's parts are frequent too. The parts of all
   cuts form a second automaton per range, whose arc weights number its paths; it is
   composed with the range's automaton of frequent phrases, which yields every
   part's count. A range asked too often is split by a hash, with its
   automaton given to each part.

Defined cases: null text is empty; a null language is ``und``; texts are folded
A-Z only; pieces shorter than a phrase have none; repeated rows count each; an
empty table gives an empty result; columns other than text and lang are ignored.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window as W

from strata.llm.common import cut, n_partitions, slices

MOST, LEAST, TOP, PERCENT = 5, 100, 2000, 100
UNKNOWN = "und"
#: Words sorted in one go; characters of text whose n-grams make a prefix range; sampled n-grams
#: a range; part look-ups answered by one task.
SHARD_WORDS, RANGE_CHARS, SAMPLE, QUERY_ROWS = 1 << 20, 16 << 20, 64, 1 << 18

_BREAK, _BLANK = rb".,;:!?" + bytes(range(0x0A, 0x0E)), b" \t"
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(_BREAK + _BLANK)] = False
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(_BREAK)] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32

Border = tuple[bytes, ...]  # (language, words)


# --- words ------------------------------------------------------------------

def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, whether each is the first of its piece, number of words of each text) of all texts of a string array."""
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    word, first = _IS_WORD[data], np.zeros(len(data), bool)
    first[at[:-1][at[:-1] < len(data)]] = True
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1] | first[1:]
    end[:-1] &= ~word[1:] | first[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(_FOLD[data[word]])])
    piece = np.cumsum(_IS_BREAK[data] | first, dtype=np.int32 if len(data) < 1 << 31 else np.int64)[starts]
    return words, np.r_[True, piece[1:] != piece[:-1]][:len(piece)], np.diff(np.searchsorted(starts, at))


class Shard:
    """Words of texts, ready to be sorted into n-grams."""

    def __init__(self):
        self.langs: dict[bytes, int] = {}
        self.parts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, texts: pa.Array, langs: list[str | None]) -> None:
        words, first, per_text = tokens(texts)
        if not len(words):
            return
        lang = np.array([self.langs.setdefault((UNKNOWN if l is None else l).encode(), len(self.langs)) for l in langs], np.int32)
        self.parts.append((words, first, np.repeat(lang, per_text)))
        self.size += len(words)

    def ngrams(self, most: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(labels in byte order from number 1, sorted distinct rows of (language, words, 0 past the end), counts)."""
        words, first, lang = zip(*self.parts)
        self.parts = []  # a shard is read once
        coded = pa.concat_arrays([*words, pa.array(list(self.langs), pa.large_binary())]).dictionary_encode()
        first, lang, words = np.concatenate(first), np.concatenate(lang), None
        by = pc.array_sort_indices(coded.dictionary)
        names = coded.dictionary.take(by)
        rank = np.empty(len(names), np.int32)
        rank[by.to_numpy()] = np.arange(1, len(names) + 1, dtype=np.int32)
        ids = rank[coded.indices.to_numpy()]
        ids, langs = ids[:len(first)], ids[len(first):]
        ends = np.r_[np.flatnonzero(first)[1:], len(ids)]
        left = np.repeat(ends.astype(np.int32), np.diff(np.r_[0, ends]))  # words to the end of the piece
        left -= np.arange(len(ids), dtype=np.int32)
        cols = [langs[lang], ids]
        for k in range(1, most):
            c = np.zeros(len(ids), np.int32)
            c[:-k] = ids[k:]
            c[left <= k] = 0
            cols.append(c)
        return names, *_counts(cols, len(names))


def _counts(cols: list[np.ndarray], largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct rows of the columns, whose numbers are at most ``largest``, and how often each comes.

    The last columns that fit are packed in a number and numbered in their order; where that number and the other columns
    fit in one, it is sorted as it is and the rows are read back from it."""
    bits = max(1, int(largest).bit_length())
    cut = max(1, len(cols) - 63 // bits)
    tails, tail = _numbered(_packed(cols[cut:], bits))
    used = np.zeros(int(largest) + 1, bool)
    used[cols[0]] = True
    heads, head = np.flatnonzero(used), (np.cumsum(used) - 1)[cols[0]]  # few languages
    sizes = [len(heads).bit_length(), *[bits] * (cut - 1), len(tails).bit_length()]
    if sum(sizes) > 63:
        rows = np.stack(cols, 1)[_order(cols, largest)]
        at = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(1)])
        return np.asfortranarray(rows[at]), np.diff(np.r_[at, len(rows)])
    key = head.astype(np.int64)
    for c, size in zip([*cols[1:cut], tail], sizes[1:]):
        key <<= size
        key |= c
    key.sort()
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    counts, key = np.diff(np.r_[at, len(key)]), key[at]
    rows = np.empty((len(key), len(cols)), np.int32, "F")
    rest = tails[key & ((1 << sizes[-1]) - 1)]
    for j in reversed(range(cut, len(cols))):
        rows[:, j] = rest & ((1 << bits) - 1)
        rest >>= bits
    key >>= sizes[-1]
    for j in reversed(range(1, cut)):
        rows[:, j] = key & ((1 << bits) - 1)
        key >>= bits
    rows[:, 0] = heads[key]
    return rows, counts


def _packed(cols: list[np.ndarray], bits: int) -> np.ndarray:
    key = cols[0].astype(np.int64)
    for c in cols[1:]:
        key <<= bits
        key |= c
    return key


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct numbers in order, each one's place among them)."""
    by = np.argsort(key)
    there = key[by]
    new = np.r_[True, there[1:] != there[:-1]][:len(key)]
    place = np.empty(len(key), np.int64)
    place[by] = np.cumsum(new) - 1
    return there[new], place


def _order(cols: list[np.ndarray], largest: int) -> np.ndarray:
    """Sorting order by the columns, first to last; as many as fit are packed in a number."""
    bits = max(1, int(largest).bit_length())
    per, keys = 63 // bits, []
    for i in range(0, len(cols), per):
        key = np.zeros(len(cols[0]), np.int64)
        for c in cols[i:i + per]:
            key = (key << bits) | c
        keys.append(key)
    return np.lexsort(keys[::-1])


# --- automata ---------------------------------------------------------------

class Automaton:
    """Layers of states; a state's arcs have a label, a weight (of all paths below) and a state of the next layer.

    ``names[i]`` is the text of label i + 1; label 0 ends a path early.
    """

    def __init__(self, names: pa.Array, layers: list[tuple[np.ndarray, ...]]):
        self.names, self.layers = names, layers  # a layer: arcs of each state, label, weight, target

    @classmethod
    def build(cls, names: pa.Array, rows: np.ndarray, counts: np.ndarray) -> Automaton:
        """From sorted distinct rows of labels with counts; only names in use are kept."""
        m, depth = rows.shape
        if rows.size * 8 < len(names):  # few of many names: nothing here takes time for the others
            use, place = np.unique(rows, return_inverse=True)
            rows = (place + (use[0] > 0)).reshape(m, depth)
            use = use[use > 0]
        else:
            used = np.zeros(len(names) + 1, bool)
            used[rows] = True
            used[0] = False
            rows, use = np.cumsum(used, dtype=np.int32)[rows] * (rows > 0), np.flatnonzero(used)
        lead = np.zeros(m, np.int64)  # a row's first label that differs from the row before
        for j in reversed(range(depth)):
            lead[1:][rows[1:, j] != rows[:-1, j]] = j
        layers, state = [], None  # state: number of the closed state below each arc
        for j in reversed(range(depth)):
            arc = np.flatnonzero(lead <= j)
            label, weight = rows[arc, j], np.add.reduceat(counts, arc)
            target = np.zeros(len(arc), np.int64) if state is None else state
            first = np.flatnonzero(lead[arc] < j) if j else np.zeros(1, np.int64)
            layer, state = _close(first, label, weight, target)
            layers.append(layer)
        return cls(names.take(pa.array(use - 1)), layers[::-1])

    def dump(self) -> bytes:
        names = self.names
        ends = np.frombuffer(names.buffers()[1], np.int64)[names.offset:names.offset + len(names) + 1]
        text = np.frombuffer(names.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        arrays = [np.diff(ends), text] + [a for layer in self.layers for a in layer]
        out = []
        for a in arrays:
            a = np.ascontiguousarray(a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)))
            out.append(struct.pack("<BQ", a.itemsize, len(a)) + a.tobytes())
        raw = b"".join(out)
        return struct.pack("<Q", len(raw)) + pa.compress(raw, "zstd", asbytes=True)

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        raw = pa.decompress(data[8:], struct.unpack_from("<Q", data)[0], "zstd", asbytes=True)
        at, arrays = 0, []
        while at < len(raw):
            size, n = struct.unpack_from("<BQ", raw, at)
            arrays.append(np.frombuffer(raw, f"u{size}", n, at + 9))
            at += 9 + size * n
        ends = np.zeros(len(arrays[0]) + 1, np.int64)
        np.cumsum(arrays[0], out=ends[1:])
        names = pa.Array.from_buffers(pa.large_binary(), len(arrays[0]), [None, pa.py_buffer(ends), pa.py_buffer(arrays[1])])
        return cls(names, [tuple(arrays[i:i + 4]) for i in range(2, len(arrays), 4)])


def _close(first: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray):
    """A layer's states, those with equal single arcs merged, and the number of each state given."""
    size = np.diff(np.r_[first, len(label)])
    one = np.flatnonzero(size == 1)
    several = np.flatnonzero(size > 1)
    arc, number = first[one], np.empty(len(size), np.int64)
    number[several] = np.arange(len(several))
    bits = [int(x.max()).bit_length() if len(x) else 0 for x in (label, weight, target)]
    if sum(bits) <= 63:
        key = (label[arc].astype(np.int64) << bits[1] | weight[arc]) << bits[2] | target[arc]
        keys, which = _numbered(key)
        pick = np.empty(len(keys), np.int64)
        pick[which] = np.arange(len(one))
    else:
        pick = which = np.arange(len(one))
    number[one] = len(several) + which
    keep = np.r_[_span(first[several], size[several]), arc[pick]]
    return (np.r_[size[several], np.ones(len(pick), np.int64)], label[keep], weight[keep], target[keep]), number


def _span(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + size[i] - 1 of all i, one after the other."""
    total = int(size.sum())
    start = np.cumsum(size) - size
    return np.arange(total) - np.repeat(start, size) + np.repeat(first, size)


def _together(automata: list[Automaton]) -> tuple[pa.Array, Iterator[tuple[np.ndarray, ...]]]:
    """Layers of all automata in one, on common labels: (names, (first arc, arcs, label, weight, target) of each layer, made
    as it is asked for)."""
    names = pa.concat_arrays([pa.array([], pa.large_binary()), *[a.names for a in automata]]).dictionary_encode()
    of = names.indices.to_numpy().astype(np.int64) + 1
    at = np.cumsum([0, *[len(a.names) for a in automata]])
    number = [np.r_[0, of[i:j]] for i, j in zip(at, at[1:])]

    def layers() -> Iterator[tuple[np.ndarray, ...]]:
        for j in range(max((len(a.layers) for a in automata), default=0)):
            parts = [a.layers[j] for a in automata]
            size = np.concatenate([p[0] for p in parts], dtype=np.int64)
            label = np.concatenate([n[p[1]] for n, p in zip(number, parts)])
            weight = np.concatenate([p[2] for p in parts], dtype=np.int64)
            target = np.concatenate([p[3] for p in parts], dtype=np.int64)
            below = [len(a.layers[j + 1][0]) if j + 1 < len(a.layers) else 0 for a in automata]
            target += np.repeat(np.cumsum([0, *below])[:-1], [len(p[3]) for p in parts])
            yield np.cumsum(size) - size, size, label, weight, target

    return names.dictionary, layers()


def union(automata: list[Automaton], least: int, low: Border | None = None,
          high: Border | None = None) -> Iterator[tuple[Border, int, bool]]:
    """(path, summed weight, at a border) of the paths that reach ``least``, lie on a border or are a language."""
    names, layers = _together(automata)
    number = {w: pc.index(names, w).as_py() + 1 for w in {*(low or ()), *(high or ())}}
    state, group = np.arange(len(automata)), np.zeros(len(automata), np.int64)
    paths: list[Border] = [()]
    on = [[0], [0]]  # group that is a prefix of the low, of the high border
    for j, (first, size, label, weight, target) in enumerate(layers):
        arc = _span(first[state], size[state])
        group = np.repeat(group, size[state])
        arc, group = arc[label[arc] > 0], group[label[arc] > 0]
        key = group * (len(names) + 1) + label[arc]
        keys, which = _numbered(key)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, which, weight[arc])
        edge = np.zeros(len(keys), bool)
        for side, border in enumerate((low, high)):
            on[side] = [int(i) for g in on[side] if border and j < len(border) and number[border[j]]
                        for i in np.flatnonzero(keys == g * (len(names) + 1) + number[border[j]])]
            edge[on[side]] = True
        keep = edge | (total >= least) | (j == 0)
        place = np.cumsum(keep) - 1
        on = [[int(place[i]) for i in side] for side in on]
        ends = names.take(pa.array(keys[keep] % (len(names) + 1) - 1)).to_pylist()
        paths = [paths[k] + (w,) for k, w in zip((keys[keep] // (len(names) + 1)).tolist(), ends)]
        yield from zip(paths, total[keep].tolist(), edge[keep].tolist())
        stay = keep[which]
        state, group = target[arc[stay]], place[which[stay]]
        if not len(state):
            return


def compose(counts: Automaton, asked: Automaton) -> np.ndarray:
    """For each path of ``asked`` (weights 1, so arc weights number the paths) its weight in ``counts``; 0 where it has none."""
    names, layers = _together([counts, asked])
    out = np.zeros(int(asked.layers[0][2].sum()), np.int64)
    a, b, index = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.int64)
    weight = None
    for first, size, label, w, target in layers:
        row = np.repeat(np.arange(len(b)), size[b])
        arc = _span(first[b], size[b])
        # paths before an arc: those of its row's earlier arcs, which lie side by side
        before = np.cumsum(w[arc]) - w[arc]
        start = np.cumsum(size[b]) - size[b]
        index = index[row] + before - before[start][row] if len(arc) else index[:0]
        mine = np.repeat(np.arange(len(a)), size[a])
        arc_a = _span(first[a], size[a])
        key = mine * (len(names) + 1) + label[arc_a]
        order = np.argsort(key)
        want = row * (len(names) + 1) + label[arc]
        at = np.minimum(np.searchsorted(key[order], want), max(len(key) - 1, 0))
        hit = key[order][at] == want if len(key) else np.zeros(len(want), bool)
        found = arc_a[order[at[hit]]]
        a, b, index, weight = target[found], target[arc[hit]], index[hit], w[found]
    out[index] = weight
    return out


# --- Spark ------------------------------------------------------------------

def borders(docs: DataFrame, most: int = MOST) -> list[Border]:
    """First n-grams of the prefix ranges, in order: one range for about ``RANGE_CHARS`` characters."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(n_partitions(docs.sparkSession), -(-chars // RANGE_CHARS))
    if not chars:
        return []
    every = max(1.0, chars / (SAMPLE * ranges))
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    points = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text", F.length("text").alias("size"), share.alias("u")) \
        .withColumn("points", F.floor(F.col("size") / every + F.col("u"))).filter("points > 0") \
        .select("lang", "text", "size", "points", "u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("points") - 1)).alias("i"))
    start = F.floor((F.col("i") + F.col("u")) / F.col("points") * F.col("size")) + 1
    near = F.translate(F.substr("text", start.cast("int"), F.lit(200)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    piece = F.regexp_extract(near, r"^[^\x20\x09]*[\x20\x09]+([^.,;:!?\x0A-\x0D]*)", 1)
    words = F.slice(F.filter(F.split(piece, r"[\x20\x09]+"), lambda w: w != ""), 1, most)
    keys = points.select("lang", words.alias("words")).filter(F.size("words") > 0).repartitionByRange(ranges, "lang", "words")
    low = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("lang", "words")).alias("k")).collect()
    return sorted({(r.k.lang.encode(), *(w.encode() for w in r.k.words)) for r in low})[1:]


def _cuts(names: pa.Array, rows: np.ndarray, marks: list[Border]) -> list[int]:
    """Where in the sorted rows each border begins."""
    words = sorted({w for mark in marks for w in mark})
    known = names.to_pylist()
    place = [bisect_left(known, w) for w in words]
    label = {w: (i + 1, i < len(known) and known[i] == w) for w, i in zip(words, place)}
    out = []
    for mark in marks:
        lo, hi = 0, len(rows)
        for j, w in enumerate(mark):
            i, here = label[w]
            part = rows[lo:hi, j]
            left, right = part.searchsorted(np.array([i, i + here], part.dtype)).tolist()
            lo, hi = lo + left, lo + right
            if lo == hi:
                break
        out.append(lo)
    return out


def _counted(docs: DataFrame, marks: list[Border], most: int) -> DataFrame:
    """(range, automaton): one automaton for each shard and prefix range that it has n-grams in."""
    schema = pa.schema([("range", pa.int64()), ("automaton", pa.binary())])

    def flush(shard: Shard) -> Iterator[pa.RecordBatch]:
        if not shard.size:
            return
        names, rows, counts = shard.ngrams(most)
        at = [0, *_cuts(names, rows, marks), len(rows)]
        for k, (lo, hi) in enumerate(zip(at, at[1:])):
            if lo < hi:
                data = Automaton.build(names, rows[lo:hi], counts[lo:hi]).dump()
                yield pa.record_batch([pa.array([k], pa.int64()), pa.array([data], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for b in slices(batches):
            shard.add(b.column(0), b.column(1).to_pylist())
            if shard.size >= SHARD_WORDS:
                yield from flush(shard)
                shard = Shard()
        yield from flush(shard)

    return docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(run, "range long, automaton binary")


_PHRASE = pa.schema([("lang", pa.binary()), ("phrase", pa.binary()), ("size", pa.int64()), ("f", pa.int64()), ("part", pa.bool_())])


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * len(schema), schema)], schema=schema)


def frequent(docs: DataFrame, marks: list[Border], most: int = MOST, least: int = LEAST) -> DataFrame:
    """(lang, phrase, size, f): phrases of up to ``most`` words that come ``least`` times; size 0: all words of a language."""

    def merge(t: pa.Table) -> pa.Table:
        k = t.column("range")[0].as_py()
        low, high = marks[k - 1] if k else None, marks[k] if k < len(marks) else None
        found = union([Automaton.load(x.as_py()) for x in t.column("automaton")], least, low, high)
        return _table(_PHRASE, [(p[0], b" ".join(p[1:]), len(p) - 1, f, part) for p, f, part in found])

    out = _counted(docs, marks, most).groupBy("range") \
        .applyInArrow(merge, "lang binary, phrase binary, size long, f long, part boolean") \
        .select(F.col("lang").cast("string"), F.col("phrase").cast("string"), "size", "f", F.expr("part OR size = 0").alias("part"))
    out = cut(out, "phrases-ranges")
    split = out.filter("part").groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))
    return out.filter("NOT part").select("lang", "phrase", "size", "f").union(split).filter(F.expr(f"f >= {least} OR size = 0"))


def _padded(names: list[bytes], paths: list[Border], depth: int) -> np.ndarray:
    rank = {w: i + 1 for i, w in enumerate(names)}
    rows = np.zeros((len(paths), depth), np.int64)
    for i, p in enumerate(paths):
        rows[i, :len(p)] = [rank[w] for w in p]
    return rows


def _automaton(paths: list[Border], counts: list[int], depth: int) -> Automaton:
    """Of sorted distinct paths, each closed by label 0."""
    names = sorted({w for p in paths for w in p})
    return Automaton.build(pa.array(names, pa.large_binary()), _padded(names, paths, depth), np.array(counts, np.int64))


def parts(phrases: DataFrame, marks: list[Border], most: int = MOST) -> DataFrame:
    """(lang, phrase, a, k, l, r): each cut of each phrase of two words or more with its parts' counts."""
    depth = most + 2  # language, words, end
    asked_schema = pa.schema([("range", pa.int64()), ("lang", pa.binary()), ("part", pa.binary()), ("phrase", pa.binary()),
                              ("a", pa.int64()), ("k", pa.int64()), ("right", pa.bool_())])

    def where(batches: Iterator[pa.RecordBatch], cuts: bool) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for lang, phrase, a in zip(*[c.to_pylist() for c in b.columns]):
                ws = phrase.split(b" ")
                for k in range(1, len(ws)) if cuts else (0,):
                    for right, p in ((False, ws[:k]), (True, ws[k:])) if cuts else ((False, ws),):
                        rows.append((bisect_right(marks, (lang, *p)), lang, b" ".join(p), phrase, a, k, right))
            yield from _table(asked_schema, rows).combine_chunks().to_batches()

    ddl = "range long, lang binary, part binary, phrase binary, a long, k long, right boolean"
    slim = phrases.filter("size > 0").select(F.col("lang").cast("binary"), F.col("phrase").cast("binary"), F.col("f").alias("a"), "size")
    known = slim.drop("size").mapInArrow(lambda batches: where(batches, False), ddl)
    asked = cut(slim.filter("size > 1").drop("size").mapInArrow(lambda batches: where(batches, True), ddl), "phrases-parts")

    def build(t: pa.Table) -> pa.Table:
        rows = sorted(((l, *p.split(b" ")), a) for l, p, a in zip(*[t.column(c).to_pylist() for c in ("lang", "part", "a")]))
        data = _automaton([p for p, _ in rows], [a for _, a in rows], depth).dump()
        return pa.table({"range": t.column("range").slice(0, 1), "automaton": pa.array([data], pa.binary())})

    transducers = known.groupBy("range").applyInArrow(build, "range long, automaton binary")
    often = asked.groupBy("range").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("salts"))
    rows = asked.join(often, "range").withColumn("salt", F.pmod(F.xxhash64("phrase", "k", "right"), "salts")).drop("salts")
    given = transducers.join(often, "range") \
        .select("range", "automaton", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    both = rows.unionByName(given, allowMissingColumns=True)
    answer_schema = pa.schema([("lang", pa.binary()), ("phrase", pa.binary()), ("a", pa.int64()), ("k", pa.int64()),
                               ("right", pa.bool_()), ("f", pa.int64())])

    def answer(t: pa.Table) -> pa.Table:
        given = [x for x in t.column("automaton").to_pylist() if x is not None]
        t = t.filter(pc.is_valid(t.column("part")))
        if not given or not t.num_rows:
            return answer_schema.empty_table()
        paths = [(l, *p.split(b" ")) for l, p in zip(t.column("lang").to_pylist(), t.column("part").to_pylist())]
        distinct = sorted(set(paths))
        f = compose(Automaton.load(given[0]), _automaton(distinct, [1] * len(distinct), depth)).tolist()
        count = dict(zip(distinct, f))
        return pa.table([t.column(c) for c in ("lang", "phrase", "a", "k", "right")] + [pa.array([count[p] for p in paths], pa.int64())],
                        schema=answer_schema)

    found = both.groupBy("range", "salt").applyInArrow(answer, "lang binary, phrase binary, a long, k long, right boolean, f long")
    return found.groupBy(F.col("lang").cast("string"), F.col("phrase").cast("string"), "a", "k") \
        .agg(F.max(F.expr("IF(right, NULL, f)")).alias("l"), F.max(F.expr("IF(right, f, NULL)")).alias("r"))


def _score(n: Column) -> Column:
    """floor(1000 * a * n / (l * r)) in exact decimals."""
    top = (F.col("a") * 1000).cast("decimal(20,0)") * n.cast("decimal(17,0)")
    return F.call_function("div", top, F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)"))


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST, top: int = TOP, percent: int = PERCENT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by their weakest cut.

    A phrase inside a longer one that comes ``percent`` of its times goes."""
    docs = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    marks = borders(docs, most)
    known = cut(frequent(docs, marks, most, least), "phrases-frequent")
    cuts = cut(parts(known, marks, most), "phrases-cuts")
    total = known.filter("size = 0").select("lang", F.col("f").alias("n"))
    scored = cuts.join(total, "lang").withColumn("score", _score(F.col("n")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")
    # a longer phrase with one word more is among the longer ones if any is: it comes at least as often
    words = F.split("phrase", " ", -1)
    shorter = cuts.filter((F.col("k") == 1) & (F.col("a") * 100 >= F.col("r") * percent)) \
        .select("lang", F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " ").alias("phrase")) \
        .union(cuts.filter((F.col("k") == F.size(words) - 1) & (F.col("a") * 100 >= F.col("l") * percent))
               .select("lang", F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "))).distinct()
    left = best.join(shorter, ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, then of what these leave
    some = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(n_partitions(docs.sparkSession)))) \
        .withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: DuckDB: phrases by leading words, every longer phrase against every shorter one.
ORACLE = f"""
WITH pieces AS (SELECT row_number() OVER () AS p, lang,
        list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
          FROM documents)),
words AS (SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM pieces),
runs AS (SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
         FROM words WINDOW o AS (PARTITION BY p ORDER BY i)),
grams AS (SELECT lang, w AS phrase, 1 AS size FROM runs
  UNION ALL SELECT lang, w || ' ' || w2, 2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3, 3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM runs WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, 5 FROM runs WHERE w5 IS NOT NULL),
f AS (SELECT lang, phrase, any_value(size) AS size, count(*) AS a FROM grams GROUP BY lang, phrase HAVING count(*) >= {LEAST}),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
cand AS (SELECT * FROM f WHERE size > 1),
cuts AS (SELECT lang, phrase, size, a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS lp,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rp
         FROM (SELECT *, unnest(range(1, size)) AS k FROM cand)),
scored AS (SELECT c.lang, c.phrase, c.size, c.a, x.a AS l, y.a AS r, t.n,
           (1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a) AS score, c.k
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp
           JOIN total t ON t.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scored),
kept AS (SELECT * FROM best b WHERE o = 1 AND NOT EXISTS (SELECT 1 FROM cand c WHERE c.lang = b.lang AND c.size > b.size
           AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND {PERCENT} * b.a <= 100 * c.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {TOP}
"""
