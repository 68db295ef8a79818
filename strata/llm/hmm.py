"""Hidden Markov language model: Baum-Welch across partitions, exact forward scoring.

Latent states emit word classes, classes emit words. The ``TOP`` most frequent
training words are classes of their own, all other words share ``TAILS`` classes
by the hash of their ending and length; a state's class probabilities and the
transitions are trained, a word's share of its class is its smoothed count. So
the trained tables are of a fixed size, while the counts cover every training
word, however many there are: they stay a distributed table.

1. Word counts over all training texts; the most frequent words and the totals
   of each class (a fixed number) go to the driver.
2. Each task turns its texts into class numbers and into numbers of a word list
   of its own block; a block's distinct words are far fewer than its tokens.
3. Baum-Welch: every task adds up expected counts over its training tokens,
   Spark adds them up over the tasks, the driver normalises. Long texts are
   trained in segments of ``SEGMENT`` tokens; segments that don't begin a text
   start from the stationary state frequencies.
4. Block word lists meet the counts, then their blocks; the scaled forward
   recursion runs over each whole text.

An unseen word has the probability of one unseen type in its class, so the model
is a proper distribution over the training words and one unknown type a class.

Defined cases: a null text is empty and has the end token alone; without any
training text every score is that of the untrained model; a null doc_id is held
out; repeated rows count and score each; an empty table gives an empty result;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Buffer, cut, held_out, rows_of

STATES, TOP, TAILS = 8, 8192, 2048
ROUNDS, SEGMENT, BLOCK_TOKENS = 6, 128, 4_000_000
#: Tokens that the E step takes at once; its arrays then stay in the processor's cache.
CHUNK = SEGMENT * 768
END = b""  # no word is empty
PRIOR = 50.0
N_CLASSES = 1 + TOP + TAILS


def tokens(text: str | None) -> list[bytes]:
    return [*(text.encode("utf-8", "surrogatepass").lower().split() if text else ()), END]


def class_of(word: bytes, top: dict[bytes, int]) -> int:
    c = top.get(word)
    if c is None:
        c = 1 + TOP + zlib.crc32(word[-3:] + bytes([min(len(word), 24)])) % TAILS
    return c


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, c) over the rows given."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.table([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], schema=schema)
            n.clear()
            yield from t.to_batches(max_chunksize=65536)

        for b in batches:
            for text in b.column(0).to_pylist():
                n.update(tokens(text))
                if len(n) > 1_000_000:
                    yield from flush()
        if n:
            yield from flush()

    part = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, c long")
    return part.groupBy("word").agg(F.sum("c").alias("c"))


def class_totals(counts: DataFrame, top: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and types of each class."""
    schema = pa.schema([("cls", pa.int32()), ("n", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, v = np.zeros(N_CLASSES, np.int64), np.zeros(N_CLASSES, np.int64)
        for b in batches:
            cls = np.array([class_of(w, top) for w in b.column(0).to_pylist()], np.int64)
            n += np.bincount(cls, weights=b.column(1).to_numpy(), minlength=N_CLASSES).astype(np.int64)
            v += np.bincount(cls, minlength=N_CLASSES)
        k = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(n[k]), pa.array(v[k])], schema=schema)

    n, v = np.zeros(N_CLASSES, np.int64), np.zeros(N_CLASSES, np.int64)
    for r in counts.select("word", "c").mapInArrow(run, "cls int, n long, v long") \
            .groupBy("cls").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        n[r.cls], v[r.cls] = r.n, r.v
    return n, v


def encode(docs: DataFrame, top: dict[bytes, int]) -> DataFrame:
    """Document rows (block, doc_id, held_out, ids, cls) and word rows (block, lid, word, wcls) in one table."""
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("ids", pa.binary()),
                        ("cls", pa.binary()), ("lid", pa.int32()), ("word", pa.binary()), ("wcls", pa.int32())])
    none = {f.name: f.type for f in schema}

    def words_of(block: int, ids: dict[bytes, int], cls: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(ids)
        cols = {"block": pa.array(np.full(n, block)), "lid": pa.array(np.arange(n, dtype=np.int32)),
                "word": pa.array(list(ids), pa.binary()), "wcls": pa.array(cls.astype(np.int32))}
        t = pa.table([cols.get(k, pa.nulls(n, ty)) for k, ty in none.items()], schema=schema)
        yield from t.to_batches(max_chunksize=65536)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 24, 0
        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        held: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            cls = np.fromiter((class_of(w, top) for w in ids), np.uint16, len(ids))
            out = Buffer(schema, 512)
            for doc_id, held_out_, a in held:
                out.add(block, doc_id, held_out_, a.tobytes(), cls[a].tobytes(), None, None, None)
                if out.full():
                    yield out.flush()
            yield out.flush()
            yield from words_of(block, ids, cls)

        for doc_id, held_out_, text in rows_of(batches, ["doc_id", "held_out", "text"]):
            held.append((doc_id, held_out_, np.array([ids[w] for w in tokens(text)], np.uint32)))
            size += len(held[-1][2])
            if size >= BLOCK_TOKENS:
                yield from flush()
                block, size, held = block + 1, 0, []
                ids.clear()
        if held:
            yield from flush()

    return docs.mapInArrow(run, "block long, doc_id long, held_out boolean, ids binary, cls binary, lid int, word binary, "
                                "wcls int")


@dataclass
class Model:
    """start (K), later (K, stationary), move (K x K), emit (classes x K)."""
    start: np.ndarray
    later: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    @staticmethod
    def initial(n_class: np.ndarray, seed: int = 11) -> "Model":
        rng = np.random.default_rng(seed)
        p = (n_class + 1) / (n_class + 1).sum()
        e = p[:, None] * np.exp(rng.standard_normal((N_CLASSES, STATES)))
        move = np.full((STATES, STATES), 0.1 / (STATES - 1))
        np.fill_diagonal(move, 0.9)
        flat = np.full(STATES, 1 / STATES)
        return Model(flat, flat.copy(), move, e / e.sum(0))


def segments(texts: list[np.ndarray], starts: list[bool] | None = None) -> tuple[list[np.ndarray], list[bool]]:
    """Parts of at most ``SEGMENT`` tokens; a part that begins no text begins with the token before it, so that
    the step over the border is seen. ``starts``: which of the sequences begin a text (all by default)."""
    parts, first = [], []
    for t, head in zip(texts, starts or [True] * len(texts)):
        at = 0 if head else 1
        for k in range(at, len(t), SEGMENT):
            parts.append(t[max(k - 1, 0):k + SEGMENT])
            first.append(head and k == 0)
    return parts, first


def expected(model: Model, texts: list[np.ndarray], starts: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts (emit, move, start, occupancy) and the log likelihood of segments of texts.

    Arrays run states x segments, so each step works along contiguous rows.
    """
    parts, first = segments(texts, starts)
    order = np.argsort([-len(p) for p in parts], kind="stable")
    lens = np.array([len(parts[i]) for i in order])
    head = np.array(first)[order]
    steps, n = int(lens[0]), len(lens)
    obs = np.zeros((steps, n), np.int64)
    for c, i in enumerate(order):
        obs[:len(parts[i]), c] = parts[i]
    live = np.searchsorted(-lens, -np.arange(steps), side="left")  # segments longer than t
    step, back = model.move.T.astype(np.float32), model.move.astype(np.float32)
    emit_p = np.ascontiguousarray(model.emit.T, np.float32)
    em = np.empty((steps, STATES, n), np.float32)
    alpha, scale = np.zeros((steps, STATES, n), np.float32), np.ones((steps, n), np.float32)
    a = np.where(head, model.start[:, None], model.later[:, None]).astype(np.float32)
    for t in range(steps):
        k = live[t]
        em[t, :, :k] = emit_p.take(obs[t, :k], axis=1)
        if t:
            a = step @ alpha[t - 1, :, :k]
        a *= em[t, :, :k]
        s = a.sum(0)
        np.divide(a, s, out=alpha[t, :, :k])
        scale[t, :k] = s
    move = np.zeros((STATES, STATES))
    beta = np.ones((STATES, n), np.float32)
    gamma = alpha  # turned into posteriors in place, from the end
    for t in range(steps - 1, -1, -1):
        k = live[t]
        if t + 1 < steps:
            j = live[t + 1]
            w = em[t + 1, :, :j] * beta[:, :j]
            w /= scale[t + 1, :j]
            move += alpha[t, :, :j] @ w.T * back
            beta[:, :j] = back @ w
        gamma[t, :, :k] *= beta[:, :k]
    seen = np.arange(steps)[:, None] < lens[None, :]
    seen[0] &= head  # a border's token is counted where it belongs
    flat = obs[seen]
    emit = np.empty((N_CLASSES, STATES))
    for k in range(STATES):
        emit[:, k] = np.bincount(flat, weights=gamma[:, k][seen], minlength=N_CLASSES)
    start = gamma[0][:, head].sum(1, dtype=np.float64)
    return emit, move, start, emit.sum(0), float(np.log(scale[seen], dtype=np.float64).sum())


def _e_step(enc: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """One pass over the training rows; rows of the sums travel by their number."""
    names = [f"s{k}" for k in range(STATES)]
    schema = pa.schema([("row", pa.int32()), *[(x, pa.float64()) for x in names]])
    base = {"emit": 0, "move": N_CLASSES, "start": N_CLASSES + STATES, "occupancy": N_CLASSES + STATES + 1,
            "loglik": N_CLASSES + STATES + 2}
    total = N_CLASSES + STATES + 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc, held, starts, size = np.zeros((total, STATES)), [], [], 0

        def add() -> None:
            emit, move, start, occ, ll = expected(model, held, starts)
            acc[:N_CLASSES] += emit
            acc[base["move"]:base["start"]] += move
            acc[base["start"]] += start
            acc[base["occupancy"]] += occ
            acc[base["loglik"], 0] += ll

        for b in batches:
            for raw in b.column(0).to_pylist():
                seq = np.frombuffer(raw, np.uint16)
                for at in range(0, len(seq), CHUNK):
                    held.append(seq[max(at - 1, 0):at + CHUNK])
                    starts.append(at == 0)
                    size += len(held[-1])
                    if size >= CHUNK:
                        add()
                        held, starts, size = [], [], 0
        if held:
            add()
        k = np.flatnonzero(acc.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), *[pa.array(acc[k, s]) for s in range(STATES)]],
                                         schema=schema)

    got = np.zeros((total, STATES))
    rows = enc.filter("NOT held_out").select("cls").mapInArrow(run, "row int, " + ", ".join(f"{x} double" for x in names)) \
        .groupBy("row").agg(*[F.sum(x).alias(x) for x in names]).collect()
    for r in rows:
        got[r.row] = [r[x] for x in names]
    return (got[:N_CLASSES], got[base["move"]:base["start"]], got[base["start"]], got[base["occupancy"]],
            float(got[base["loglik"], 0]))


def baum_welch(enc: DataFrame, n_class: np.ndarray, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """The trained model and the log likelihood before each round."""
    model, log = Model.initial(n_class), []
    p = (n_class + 1) / (n_class + 1).sum()
    for _ in range(rounds):
        emit, move, start, occ, ll = _e_step(enc, model)
        log.append(ll)
        if not occ.sum():
            break
        emit = emit + PRIOR * p[:, None]
        model = Model((start + 1) / (start + 1).sum(), (occ + 1) / (occ + 1).sum(),
                      (move + 1) / (move + 1).sum(1, keepdims=True), emit / emit.sum(0))
    return model, log


def forward(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Exact natural-log likelihood of each whole class sequence (none may be empty)."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    lens = np.array([len(texts[i]) for i in order])
    flat = np.concatenate([texts[i] for i in order]).astype(np.int64)
    at = np.r_[0, np.cumsum(lens)[:-1]]
    out = np.zeros(len(texts))
    emit, step = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
    a, live = None, len(lens)
    for t in range(int(lens[0])):
        while lens[live - 1] <= t:
            live -= 1
        em = emit.take(flat[at[:live] + t], axis=1)
        a = model.start[:, None] * em if t == 0 else (step @ a[:, :live]) * em
        s = a.sum(0)
        a /= s
        out[order[:live]] += np.log(s)
    return out


def frequent(counts: DataFrame) -> DataFrame:
    """The ``TOP`` most frequent words. A histogram of the counts' magnitudes (64 rows at most) says from which
    count on, so that about as many rows are sent and sorted, whatever the number of partitions."""
    words = counts.filter(F.length("word") > 0)
    size = F.floor(F.log2("c")).cast("int")
    least, found = 0, 0
    for r in sorted(words.groupBy(size.alias("b")).count().collect(), key=lambda r: -r.b):
        least, found = r.b, found + r["count"]
        if found >= TOP:
            break
    return words.filter(F.col("c") >= F.lit(1 << least)).orderBy(F.col("c").desc(), "word").limit(TOP)


def score(docs: DataFrame, modulus: int = 7, remainder: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    held_out("doc_id", modulus, remainder).alias("held_out"))
    counts = cut(word_counts(d.filter("NOT held_out")), "hmm-counts")
    n_train, n_types = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).first())
    rows = frequent(counts).collect()
    top = {END: 0} | {bytes(r.word): i + 1 for i, r in enumerate(rows)}
    n_class, v_class = class_totals(counts, top)
    enc = cut(encode(d, top), "hmm-encoded")
    texts = enc.filter("ids IS NOT NULL")
    model, _ = baum_welch(texts, n_class, rounds)
    words = enc.filter("ids IS NULL").select("block", "lid", "word", "wcls") \
        .join(counts, "word", "left").select(F.col("block").alias("at"), "lid", "wcls", F.coalesce("c", F.lit(0)).alias("c"))
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lid, n = right.column("lid").to_numpy(), right.num_rows
        c, cls = np.zeros(n, np.int64), np.zeros(n, np.int64)
        c[lid], cls[lid] = right.column("c").to_numpy(), right.column("wcls").to_numpy()
        base = np.log10((c + 1) / (n_train + n_types + 1))
        inside = np.where(cls <= TOP, 0.0, np.log10((c + 1) / (n_class[cls] + v_class[cls] + 1)))
        ids = [np.frombuffer(b, np.uint32) for b in left.column("ids").to_pylist()]
        ll = forward(model, [cls[i] for i in ids]) / np.log(10) if ids else np.zeros(0)
        cols = [left.column("doc_id"), left.column("held_out"), pa.array([len(i) for i in ids], pa.int64()),
                pa.array([int((c[i] > 0).sum()) for i in ids], pa.int64()),
                pa.array([n_train] * len(ids), pa.int64()),
                pa.array([float(base[i].sum()) for i in ids], pa.float64()),
                pa.array([float(inside[i].sum() + x) for i, x in zip(ids, ll)], pa.float64())]
        return pa.table(cols, schema=schema)

    return texts.select("block", "doc_id", "held_out", "ids").groupBy("block").cogroup(words.groupBy("at")) \
        .applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                           "base_score double, score double")
