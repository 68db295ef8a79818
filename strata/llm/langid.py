"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is reduced to lower-case letters with single blanks between its words;
each 1-, 2- and 3-gram of code points hashes to one of ``BUCKETS`` rows of an
embedding table. The mean of the rows of all n-grams of the whole text, times a
weight matrix, gives the class scores. Both tables are trained together by
stochastic gradient descent in numpy on a bounded, per-language balanced sample
of labelled documents (``max_train``; each sampled text counts whole, as n-gram
counts worked out on the executors). A fifth of the sample calibrates: a
temperature that minimises its log loss, and a rejection level below which lie
at most ``REJECT_SHARE`` of its rightly classified documents.

Defined cases: a null text, or one without a letter, gets ``und`` with score 0
and counts as rejected; a null language isn't learned; without any labelled
document all are ``und``; repeated rows are judged each and alike; empty tables
give empty results; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Buffer, cut, held_out, rows_of, slices

UND = "und"
BUCKETS, DIM = 1 << 14, 16
MAX_TRAIN = 8_000
#: EMB_RATE multiplies the step of the embeddings, whose gradients are spread over a text's n-grams.
EPOCHS, BATCH, RATE, EMB_RATE = 12, 32, 2.0, 20.0
REJECT_SHARE = 0.005

_ALPHA: list[np.ndarray] = []


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _ALPHA[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the n-grams of one whole text; empty without a letter."""
    none = np.zeros(0, np.uint16), np.zeros(0, np.float32)
    if not text:
        return none
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _alpha()[cp]
    if not letter.any():
        return none
    cp = np.where(letter, cp, 32)
    blank = ~letter
    cp = cp[~(blank & np.r_[True, blank[:-1]])]
    cp = np.r_[np.uint32(32), cp, np.uint32(32)].astype(np.uint32)
    a = cp * np.uint32(0x9E3779B1)
    b = (a[:-1] ^ (a[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77) + cp[1:] * np.uint32(0xC2B2AE3D)
    c = (b[:-1] ^ (b[:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + cp[2:] * np.uint32(0x165667B1)
    total = sum(np.bincount((x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D) >> np.uint32(18), minlength=BUCKETS)
                for x in (a[1:-1], b, c))
    idx = np.flatnonzero(total)
    return idx.astype(np.uint16), total[idx].astype(np.float32)


@dataclass
class LangModel:
    langs: list[str]
    emb: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject: float = 0.0

    def logits(self, idx: np.ndarray, cnt: np.ndarray) -> np.ndarray:
        v = (cnt @ self.emb[idx]) / cnt.sum()
        return v @ self.out + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)."""
        idx, cnt = ngrams(text)
        if not len(idx) or not self.langs:
            return UND, 0.0, True
        z = self.logits(idx, cnt) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        i = int(p.argmax())
        return self.langs[i], float(p[i]), bool(p[i] < self.reject)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def fit(samples: list[tuple[np.ndarray, np.ndarray, str]], seed: int = 3) -> LangModel:
    """SGD over the sampled documents; the order and the start are seeded."""
    samples = [s for s in samples if len(s[0])]
    langs = sorted({s[2] for s in samples})
    rng = np.random.default_rng(seed)
    m = LangModel(langs, rng.normal(0, 1.0, (BUCKETS, DIM)).astype(np.float32),
                  np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32))
    if len(langs) < 2:
        return m
    y = np.array([langs.index(s[2]) for s in samples])
    order = rng.permutation(len(samples))
    n_val = len(samples) // 5
    val, learn = order[:n_val], order[n_val:]
    steps, done = EPOCHS * max(1, -(-len(learn) // BATCH)), 0
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            part = learn[at:at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            w = [samples[i][1] / samples[i][1].sum() for i in part]
            v = np.stack([x @ m.emb[samples[i][0]] for x, i in zip(w, part)])
            p = _softmax(v @ m.out + m.bias)
            p[np.arange(len(part)), y[part]] -= 1
            p /= len(part)
            back = p @ m.out.T
            m.out -= rate * (v.T @ p)
            m.bias -= 0.1 * rate * p.sum(0)
            for x, i, g in zip(w, part, back):
                # rows of one document are distinct, so plain indexed subtraction is exact
                m.emb[samples[i][0]] -= EMB_RATE * rate * x[:, None] * g
    if n_val:
        z = np.stack([m.logits(*samples[i][:2]) for i in val])
        grid = np.exp(np.linspace(np.log(0.1), np.log(20), 60))
        loss = [-np.log(_softmax(z / t)[np.arange(n_val), y[val]] + 1e-12).mean() for t in grid]
        m.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(z / m.temperature)
        right = p.max(1)[p.argmax(1) == y[val]]
        if len(right):
            m.reject = float(min(0.5, np.quantile(right, REJECT_SHARE)))
    return m


def train(docs: DataFrame, learn=None, max_train: int = MAX_TRAIN) -> LangModel:
    """Fit on at most ``max_train`` labelled rows, languages as balanced as their counts allow."""
    lab = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if learn is not None:
        lab = lab.filter(learn)
    lab = lab.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    n = cut(lab.groupBy("lang").agg(F.count("*").alias("n")), "lang-counts")
    n_langs = max(1, n.count())
    share = n.select("lang", F.least(F.lit(1.0), F.lit(max_train / n_langs) / F.col("n")).alias("share"))
    h = F.xxhash64("doc_id", "text")
    pick = (lab.withColumn("h", h).join(share, "lang")
            .filter(F.pmod("h", F.lit(1_000_003)) < F.col("share") * 1_000_003))
    schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("idx", pa.binary()), ("cnt", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema, 256)
        for h, lang, text in rows_of(batches, ["h", "lang", "text"]):
            idx, cnt = ngrams(text)
            out.add(h, lang, idx.tobytes(), cnt.tobytes())
            if out.full():
                yield out.flush()
        yield out.flush()

    rows = (pick.select("h", "lang", "text").mapInArrow(run, "h long, lang string, idx binary, cnt binary")
            .orderBy("h", "lang").limit(max_train).collect())
    return fit([(np.frombuffer(r.idx, np.uint16), np.frombuffer(r.cnt, np.float32), r.lang) for r in rows])


def identify(docs: DataFrame, modulus: int = 5, remainder: int = 0, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs``."""
    model = train(docs, ~held_out("doc_id", modulus, remainder), max_train)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                        ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema)
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            out.add(doc_id, *model.predict(text))
            if out.full():
                yield out.flush()
        yield out.flush()

    p = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
    return p.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` without the rows that the identifier rejects; columns as given."""
    model = train(docs, None, max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            yield b.filter(pa.array([not model.predict(t)[2] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
