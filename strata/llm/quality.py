"""Quality scores learned from preference pairs (Bradley-Terry).

A document is described by about two dozen counts of its whole text that don't
depend on the language (shares of capitals, marks, symbols and digits,
repetition of words, triples and lines, lengths, entropy). A pair of a document
labelled 1 and one labelled 0 says that the first is better; the weights ``w``
maximise ``sum log sigmoid(w . (f_good - f_bad))`` over such pairs. A document's
raw score is ``w . f``. The cutoff is the quantile of the labelled raw scores
that separates the labels with the fewest errors, and scores are mapped to
(0, 1) so that the cutoff lands on ``ACCEPT``.

One pass over the texts writes the features; labels join those slim rows, and
the fit sees a bounded sample of them: at most ``max_per_class`` documents of
each label, those with the smallest hash of their id.

Defined cases: a null text counts as empty; ids without a label, with a null or
with contradicting labels teach nothing; without both labels every document
scores ``ACCEPT`` (nothing is rejected unheard); repeated rows score alike;
empty tables give empty results; columns other than doc_id and text are ignored
(the pipeline form keeps those it was given).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Buffer, cut, held_out, rows_of, slices
from strata.llm.rules import labels_of

ACCEPT = 0.7
MAX_PER_CLASS = 10_000
N_PAIRS = 200_000
SYMBOLS = b"#*$%&|<>~^=+_{}[]@\\"
NAMES = ("log_words", "word_len", "word_len_sd", "long_words", "upper", "marks", "digits", "bang", "bar", "symbols",
         "distinct", "stutter", "top_word", "repeat3", "dup_lines", "line_words", "stops", "commas", "titled",
         "entropy", "all_caps", "word_end_marks")

_KINDS: dict[str, np.ndarray] = {}


def _kinds() -> dict[str, np.ndarray]:
    """Code point tables of the basic plane: upper-case, letter, digit."""
    if not _KINDS:
        chars = [chr(i) for i in range(0x10000)]
        _KINDS["upper"] = np.array([c.isupper() for c in chars])
        _KINDS["alpha"] = np.array([c.isalpha() for c in chars])
        _KINDS["digit"] = np.array([c.isdigit() for c in chars])
    return _KINDS


def features(text: str | None) -> np.ndarray:
    """The feature vector of one whole text (zeros for an empty one)."""
    out = np.zeros(len(NAMES), np.float32)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    ws = raw.split()
    n = len(ws)
    if not n:
        return out
    k = _kinds()
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    cp = np.minimum(cp, 0xFFFF)
    n_alpha, n_upper, n_digit = (int(k[x][cp].sum()) for x in ("alpha", "upper", "digit"))
    freq = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n_space = int(freq[[9, 10, 11, 12, 13, 32]].sum())
    n_ink = max(1, len(cp) - n_space)
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in ws), np.int64, n)
    lens = np.fromiter(map(len, ws), np.int64, n)
    p = freq[freq > 0] / len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = (seq[:-2] * 1_000_003 + seq[1:-1]) * 1_000_003 + seq[2:] if n > 2 else seq[:0]
    caps = sum(1 for w in ids if len(w) > 1 and w.isupper())
    ends = sum(1 for w in ids if w[-1:] in b"!*$%&#|")
    out[:] = (np.log1p(n), lens.mean(), lens.std(), (lens > 20).mean(), n_upper / max(1, n_alpha),
              (n_ink - n_alpha - n_digit) / n_ink, n_digit / n_ink, freq[33] / n, freq[124] / n,
              sum(int(freq[c]) for c in SYMBOLS) / n_ink, np.log1p(len(ids)) / np.log1p(n),
              (seq[1:] == seq[:-1]).mean() if n > 1 else 0.0, np.bincount(seq).max() / n,
              1 - len(np.unique(triples)) / len(triples) if len(triples) else 0.0,
              1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), freq[46] / n, freq[44] / n,
              sum(1 for w in ids if w[:1].isupper()) / len(ids), -(p * np.log(p)).sum(), caps / len(ids),
              ends / len(ids))
    return out


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, f array<float>) of every row, written once."""
    schema = pa.schema([("doc_id", pa.int64()), ("f", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema)
        for doc_id, text in rows_of(batches, ["doc_id", "text"]):
            out.add(doc_id, features(text))
            if out.full():
                yield out.flush()
        yield out.flush()

    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .mapInArrow(run, "doc_id long, f array<float>"), "quality-features")


@dataclass
class Ranker:
    """Weights over standardised features, the cutoff and the slope of the (0, 1) scale."""
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    cutoff: float
    slope: float

    def raw(self, f: np.ndarray) -> np.ndarray:
        return np.clip((f - self.mean) / self.scale, -6, 6) @ self.w

    def score(self, f: np.ndarray) -> np.ndarray:
        z = np.log(ACCEPT / (1 - ACCEPT)) + self.slope * (self.raw(f) - self.cutoff)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(good: np.ndarray, bad: np.ndarray, n_pairs: int = N_PAIRS, l2: float = 1e-3, seed: int = 7) -> Ranker:
    """Newton on the pairwise logistic loss; pairs are drawn with a fixed seed."""
    d = len(NAMES)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 1.0)
    both = np.concatenate([good, bad]).astype(np.float64)
    m = Ranker(both.mean(0), both.std(0) + 1e-6, np.zeros(d), 0.0, 1.0)
    g, b = (np.clip((x - m.mean) / m.scale, -6, 6) for x in (good, bad))
    rng = np.random.default_rng(seed)
    diff = g[rng.integers(0, len(g), n_pairs)] - b[rng.integers(0, len(b), n_pairs)]
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(diff @ m.w, -30, 30)))
        grad = diff.T @ p / n_pairs - l2 * m.w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / n_pairs + l2 * np.eye(d)
        step = np.linalg.solve(hess, grad)
        m.w = m.w + step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    s = np.concatenate([g @ m.w, b @ m.w])
    y = np.r_[np.ones(len(g)), np.zeros(len(b))]
    order = np.argsort(s, kind="stable")
    s, y = s[order], y[order]
    # cutting before position i rejects the i lowest: errors are the good ones below and the bad ones above
    errors = np.r_[0, np.cumsum(y)] + np.r_[np.cumsum((1 - y)[::-1])[::-1], 0]
    edge = np.r_[s[0] - 1, (s[1:] + s[:-1]) / 2, s[-1] + 1]
    best = np.flatnonzero(errors == errors.min())
    gap = np.r_[0, s[1:] - s[:-1], 0][best]
    m.cutoff = float(edge[best[int(np.argmax(gap))]])
    # slope: one-dimensional logistic fit around the cutoff
    z, a = s - m.cutoff, 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z, -30, 30)))
        h = (z * z * p * (1 - p)).sum() + 1e-6
        a = float(np.clip(a + (z * (y - p)).sum() / h, 0.05, 5.0))
    m.slope = a
    return m


def train(table: DataFrame, labels: DataFrame, learn=None, max_per_class: int = MAX_PER_CLASS) -> Ranker:
    """Fit on labelled rows of a feature table; ``learn`` is a condition on doc_id."""
    lab = labels_of(labels)
    if learn is not None:
        lab = lab.filter(learn)
    x = table.join(lab, "doc_id")
    sides, size = [], {r.quality: r["count"] for r in x.groupBy("quality").count().collect()}
    for q in (1, 0):
        # only hashes low enough for the sample are sent, however many rows and partitions there are
        share = min(1.0, (max_per_class + 6 * max_per_class ** 0.5) / max(size.get(q, 0), 1))
        low = F.xxhash64("doc_id") <= F.lit(min(int(share * 2**64) - 2**63, 2**63 - 1))
        rows = (x.filter((F.col("quality") == q) & low).orderBy(F.xxhash64("doc_id"), "doc_id")
                .limit(max_per_class).select("f").collect())
        sides.append(np.array([r[0] for r in rows], np.float64).reshape(len(rows), len(NAMES)))
    return fit(*sides)


def score_table(table: DataFrame, model: Ranker) -> DataFrame:
    """(doc_id, score) for every row of a feature table."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(f), pa.float64())], schema=schema)

    return table.select("doc_id", "f").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2,
             max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    table = feature_table(docs)
    model = train(table, labels, ~held_out("doc_id", modulus, remainder), max_per_class)
    s = score_table(table, model)
    return s.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score",
                    F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; columns as given."""
    model = train(feature_table(docs), labels, None, max_per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            f = np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(NAMES))
            keep = model.score(f) >= ACCEPT
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
