"""Near-duplicate vectors by collision-counting projections.

Every vector is projected on random lines. A table bundles a few lines: all but
the last are cut into cells (width ``WIDTH``, random offset), the last one is
kept as a number. Rows of a table are brought together by cell and sorted by
that number, and each vector collides with the vectors of its window, centred on
it. A pair's collisions are counted over all tables; pairs with at least
``need`` collisions are verified by their cosine in double precision.

``calibrate`` sets lines per table, tables and ``need`` from the number of
vectors, so that a pair exactly at the threshold passes with probability
``RECALL`` and a vector meets about ``MATES`` unrelated ones per table, however
many vectors there are.

No pair leaves its task: a task that meets a pair works out in which tables the
pair collides (from the two vectors) and handles it only in the first of them.
It returns, per vector, the number of links and the smallest vector connected to
it there. Equal vectors are one node with a multiplicity. A cell of more than
``BLOCK`` vectors is split in blocks, and each pair of blocks is a task.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different lengths never link; a null
vec_id is dropped from links but stays in the result with a null component;
rows with the same vec_id are linked as vectors of their own but share the
component; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from strata.llm.common import Buffer, cut
from strata.llm.components import components
from strata.llm.jaccard import Union

COSINE, RECALL = 0.95, 0.999
WIDTH, MATES, BLOCK, NEED = 2.0, 256, 2048, 2


@dataclass(frozen=True)
class Plan:
    lines: int      # cell lines of a table
    tables: int
    need: int       # collisions that a candidate pair must have
    window: float   # half width of the query-centred window
    width: float
    cosine: float


def calibrate(n: int, cosine: float = COSINE, recall: float = RECALL) -> Plan:
    """Lines, tables and window for ``n`` vectors; see the module's text."""
    sigma = math.sqrt(max(2 - 2 * cosine, 1e-6))  # a projected difference at the threshold is N(0, sigma)
    same_cell = 1 - sigma * math.sqrt(2 / math.pi) / WIDTH
    other_cell = 0.45  # two unrelated unit vectors: chance of the same cell on one line
    lines = max(1, round(math.log(max(n, MATES) / MATES) / -math.log(other_cell)))
    p = same_cell ** lines * math.erf(3 / math.sqrt(2))
    tables = NEED
    while sum(math.comb(tables, k) * p**k * (1 - p) ** (tables - k) for k in range(NEED)) > 1 - recall:
        tables += 1
    return Plan(lines, tables, NEED, 3 * sigma, WIDTH, cosine)


@lru_cache(maxsize=4)
def _lines(dim: int, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(dim)
    a = rng.standard_normal((dim, plan.tables * (plan.lines + 1)))
    offset = rng.uniform(0, plan.width, (plan.tables, plan.lines))
    salt = rng.integers(1, 2**62, plan.lines) | 1
    return a, offset, salt


def project(x: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows to (cell per table, window number per table)."""
    a, offset, salt = _lines(x.shape[1], plan)
    y = (x @ a).reshape(len(x), plan.tables, plan.lines + 1)
    cells = np.floor((y[:, :, :-1] + offset) / plan.width).astype(np.int64)
    code = np.zeros(cells.shape[:2], np.uint64)
    for k in range(plan.lines):
        code = (code ^ (cells[:, :, k].view(np.uint64) * np.uint64(salt[k]))) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(31)
    return code.view(np.int64), y[:, :, -1]


def unit(raw: list[bytes], dtype: str = "f8") -> np.ndarray:
    x = np.stack([np.frombuffer(b, dtype) for b in raw]).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the norm of large components
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _usable(v) -> np.ndarray | None:
    if v is None or not len(v) or any(c is None for c in v):
        return None
    x = np.asarray(v, np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def _stored(rows: DataFrame, column: str) -> str:
    """How components are stored: single floats stay single, which loses nothing and halves what is shuffled."""
    return "f4" if rows.schema[column].dataType == ArrayType(FloatType(), rows.schema[column].dataType.containsNull) else "f8"


def vectors(rows: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, dim, k1, k2, v): the digest and the components of usable vectors, nulls for the others."""
    kind = _stored(rows, column)
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()),
                        ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema)
        for b in batches:
            for vec_id, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = _usable(v)
                if x is None:
                    out.add(vec_id, None, None, None, None)
                else:
                    x = x + 0.0  # one zero
                    k = np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64)
                    out.add(vec_id, len(x), int(k[0]), int(k[1]), x.astype(kind).tobytes())
                if out.full():
                    yield out.flush()
        yield out.flush()

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")) \
        .mapInArrow(run, "vec_id long, dim int, k1 long, k2 long, v binary")


def _keyed(reps: DataFrame, plan: Plan, kind: str) -> DataFrame:
    """(rep, dim, cells array<long>) of every node."""
    schema = pa.schema([("rep", pa.int64()), ("dim", pa.int32()), ("cells", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Buffer(schema, 4096)
        for b in batches:
            by_dim: dict[int, list[int]] = {}
            dims = b.column(1).to_pylist()
            for i, d in enumerate(dims):
                by_dim.setdefault(d, []).append(i)
            ids, raw = b.column(0).to_pylist(), b.column(2).to_pylist()
            for d, pos in by_dim.items():
                for at in range(0, len(pos), 4096):
                    part = pos[at:at + 4096]
                    code, _ = project(unit([raw[i] for i in part], kind), plan)
                    for i, c in zip(part, code):
                        out.add(ids[i], d, c)
                    yield out.flush()

    return reps.select("rep", "dim", "v").mapInArrow(run, "rep long, dim int, cells array<long>")


_OUT = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("low", pa.int64())])


def _search(plan: Plan, kind: str):
    """Group function: rows of one cell (or of a pair of its blocks) to links per vector.

    Collisions come first: of a vector's window mates those are candidates that share a cell in ``need`` tables
    or more; their collisions are then counted with the windows of all tables, and only pairs with
    ``need`` of them that this table is the first to meet are verified by their cosine."""

    def run(t: pa.Table) -> pa.Table:
        ids = t.column("rep").to_numpy()
        if len(ids) < 2:
            return _OUT.empty_table()
        table = t.column("tab")[0].as_py()
        mult, block = t.column("mult").to_numpy(), t.column("block").to_numpy()
        x = unit(t.column("v").to_pylist(), kind)
        code, num = project(x, plan)
        short = np.ascontiguousarray(code.T.astype(np.uint16))  # equal codes have equal ends
        order = np.argsort(num[:, table], kind="stable")
        ids, mult, block, x, code, num = (z[order] for z in (ids, mult, block, x, code, num))
        short = np.ascontiguousarray(short[:, order])
        line = num[:, table]
        end = np.searchsorted(line, line + plan.window, side="right")
        two = block.min() != block.max()
        links = np.zeros(len(ids), np.int64)
        uf = Union(len(ids))
        for at in range(0, len(ids), 256):
            hi = min(at + 256, len(ids))
            stop = int(end[at:hi].max())
            shared = np.zeros((hi - at, stop - at), np.uint8)
            for cells in short:
                shared += cells[at:hi, None] == cells[None, at:stop]
            i, j = np.nonzero(shared >= plan.need)
            i, j = i + at, j + at
            ok = (j > i) & (j < end[i])
            if two:  # pairs inside a block belong to that block's own task
                ok &= block[i] != block[j]
            i, j = i[ok], j[ok]
            for k in range(0, len(i), 1 << 16):
                p, q = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                hit = (code[p] == code[q]) & (np.abs(num[p] - num[q]) <= plan.window)
                own = (hit.sum(1) >= plan.need) & (hit.argmax(1) == table)
                p, q = p[own], q[own]
                true = np.einsum("ij,ij->i", x[p], x[q]) >= plan.cosine
                p, q = p[true], q[true]
                links += np.bincount(p, weights=mult[q], minlength=len(ids)).astype(np.int64)
                links += np.bincount(q, weights=mult[p], minlength=len(ids)).astype(np.int64)
                if uf.parts > 1:
                    for a, b in zip(p.tolist(), q.tolist()):
                        uf.link(a, b)
        has = np.flatnonzero(links)
        root = [uf.find(int(k)) for k in has]
        low: dict[int, int] = {}
        for k, r in zip(has, root):
            low[r] = min(low.get(r, int(ids[k])), int(ids[k]))
        return pa.table([pa.array(ids[has]), pa.array(links[has]), pa.array([low[r] for r in root], pa.int64())],
                        schema=_OUT)

    return run


def near_duplicates(rows: DataFrame, column: str = "embedding", cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    vec, kind = cut(vectors(rows, column), "vectors"), _stored(rows, column)
    reps = cut(vec.filter("v IS NOT NULL AND vec_id IS NOT NULL").groupBy("k1", "k2")
               .agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"), F.first("dim").alias("dim"),
                    F.first("v").alias("v")), "vector-nodes")
    plan = calibrate(reps.count(), cosine, recall)
    keyed = cut(_keyed(reps, plan, kind).select("rep", "dim", F.posexplode("cells").alias("tab", "cell")), "vector-cells")
    size = keyed.groupBy("dim", "tab", "cell").agg(F.count("*").alias("n")).filter("n > 1") \
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n")
    met = keyed.join(size, ["dim", "tab", "cell"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    # each pair of blocks (i <= j) of a split cell is a task; a row goes to the pairs that name its block
    tasks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                        lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")))
    places = met.groupBy("rep").agg(F.collect_list(F.struct("dim", "tab", "cell", "block", tasks.alias("tasks"))).alias("m"))
    payload = places.join(reps.select("rep", "mult", "v"), "rep").select("rep", "mult", "v", F.explode("m").alias("m"))
    payload = payload.select("rep", "mult", "v", "m.dim", "m.tab", "m.cell", "m.block", F.explode("m.tasks").alias("t"))
    found = payload.select("rep", "mult", "v", "dim", "tab", "cell", "block", "t.i", "t.j") \
        .groupBy("dim", "tab", "cell", "i", "j").applyInArrow(_search(plan, kind), "rep long, links long, low long")
    found = cut(found, "vector-links")
    comp = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    node = reps.select("k1", "k2", "rep", "mult").join(links, "rep", "left") \
        .join(comp, F.col("rep") == F.col("node"), "left") \
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n"),
                F.coalesce("component", "rep").alias("c"))
    out = vec.select("vec_id", "k1", "k2").join(node, ["k1", "k2"], "left") \
        .select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
