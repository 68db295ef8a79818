"""Packing documents into sequences of a fixed number of tokens (sum of squares).

Each document's ids end with one separator. Only a document longer than a
sequence is cut, into full pieces and a rest. Full pieces are sequences by
themselves. The other pieces are placed, long ones first, into the open bin
(residual gap g) for which the sum over all gaps of the squared number of open
bins becomes smallest; ties take the smallest gap; a new bin opens when no open
one has room. Ids only meet their own document: placement needs lengths alone.

Every task packs the pieces of its own partition, so no piece is shuffled and
memory is bounded by a partition's slim rows. Bins that a task leaves with a
larger gap are taken apart and packed again by fewer tasks, 16 partitions to
one, until one is left or a task would get more than ``TASK_PIECES`` pieces: so
many pack as well as all would, and where most bins can't be closed (texts of more than half a sequence
each) more levels would not close them. Each level is written before the next reads it.

Tokenising splits at ASCII white space, which the vocabulary drops anyway, and
keeps the ids of words already seen.

Defined cases: a null or empty text is the separator alone; repeated rows are
documents of their own; an empty table gives an empty result; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Buffer, cut, kept, slices

CAPACITY, SEPARATOR = 4096, 1
#: Words and chunks a Python worker remembers in each of two generations, about 150 bytes each, and the bytes of the
#: longest it remembers: texts without spaces are long chunks that hardly come again.
CACHE, CHUNK_BYTES = 250_000, 64
FAN_IN = 16
#: Pieces that a task packs again at most, about 50 bytes each.
TASK_PIECES = 1 << 20
#: A bin whose gap is at most this share of a sequence is final.
TIGHT = 1 / 64


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: The tokenizer file's own splitting pattern (fixed value); only files that state it are split here.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Ids:
    """Token ids of whole texts as little-endian 32-bit bytes.

    A vocabulary that drops white space is asked once per distinct word: chunks
    of plain Latin text are lower-cased and split here by the file's own
    pattern, and the model encodes each new word; any other chunk goes through
    the whole tokenizer. Any other kind of file encodes each text as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre = json.dumps(spec.get("pre_tokenizer") or {})
        self.by_word = (json.dumps(SPLIT)[1:-1] in pre and '"behavior": "Removed"' in pre and '"invert": true' in pre
                        and spec["model"]["type"] == "BPE")
        # a full generation becomes the old one; what is asked for again moves on, so rare words fall out;
        # a word has the ids of a chunk that is just this word, so both are kept together
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.find = regex.compile(SPLIT).findall
        self.model = self.tok.model

    def _keep(self, c: bytes, ids: bytes) -> bytes:
        if len(c) <= CHUNK_BYTES:
            if len(self.known) >= CACHE:
                self.known, self.old = {}, self.known
            self.known[c] = ids
        return ids

    def _word(self, w: str) -> bytes:
        c = w.encode("utf-8")
        got = self.known.get(c)
        if got is None:
            got = self.old.get(c)
            if got is None:
                shown = w if w.isascii() and w.isprintable() else "".join([_SHOWN[b] for b in c])
                ids = [t.id for t in self.model.tokenize(shown)]
                got = struct.pack(f"<{len(ids)}I", *ids)
            self._keep(c, got)
        return got

    def _chunk(self, c: bytes) -> bytes:
        got = self.old.get(c)
        if got is not None:
            return self._keep(c, got)
        text = c.decode("utf-8", "surrogatepass")
        if max(text) < "\u0250" and "\u0130" not in text and "<|" not in text:
            text = text.lower()
            if text.isalpha():
                got = self._word(text)
            elif text[-1] in ",." and text[:-1].isalpha():  # as the pattern splits it, without asking it
                got = self._word(text[:-1]) + self._word(text[-1])
            else:
                got = b"".join([self._word(w) for w in self.find(text)])
        else:
            got = np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self._keep(c, got)

    def of(self, text: str | None) -> bytes:
        """Ids of a text, separator included."""
        if not text:
            return _END
        if not self.by_word:
            return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + _END
        chunks = text.encode("utf-8", "surrogatepass").split()
        parts = list(map(self.known.get, chunks))
        if None in parts:
            for i, got in enumerate(parts):
                if got is None:
                    parts[i] = self._chunk(chunks[i])
        parts.append(_END)
        return b"".join(parts)


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: printable ones as themselves, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


_SHOWN = _byte_letters()
_END = np.asarray([SEPARATOR], "<u4").tobytes()


def loaded(path: str) -> Ids:
    """The tokenizer of this Python worker, its known words kept from task to task."""
    return kept(("ids", path), lambda: Ids(path))


PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int64()))])
PLACED = pa.schema([*list(PIECE)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])
_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, its ids."""
    path = tokenizer or default_tokenizer()
    schema = PIECE if keep_ids else pa.schema(list(PIECE)[:5])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids, out = loaded(path), Buffer(schema, 4096)
        for b in slices(batches, ("ids", path)):
            doc, text = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text"))
            for doc_id, body in zip(doc, text):
                raw, step = ids.of(body), 4 * capacity
                for k, at in enumerate(range(0, len(raw), step)):
                    part = raw[at:at + step]
                    row = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))
                    out.add(*row, *([np.frombuffer(part, "<u4")] if keep_ids else []))
                if out.full():
                    yield out.flush()
        yield out.flush()

    ddl = _DDL + (", ids array<long>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, ddl)


def place(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sum-of-squares packing: (bin, offset) per piece, pieces of at most ``capacity``."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)  # open bins per gap
    stacks: dict[int, list[int]] = {}
    n = 0
    big = np.iinfo(np.int64).max
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        g = -1
        if s < capacity:
            here = count[s:capacity]
            cost = np.where(here > 0, count[0:capacity - s] - here, big)
            j = int(cost.argmin())
            if cost[j] != big:
                g = s + j
        if g < 0:
            b, gap = n, capacity
            n += 1
        else:
            b, gap = stacks[g].pop(), g
            count[g] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            count[gap - s] += 1
            stacks.setdefault(gap - s, []).append(b)
    return bins, offsets


def _level(rows: DataFrame, level: int, last: bool, capacity: int) -> DataFrame:
    """Pack each partition; rows of loose bins come out ``open`` unless this is the last level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.Table.from_batches(tables)
        length = t.column("length").to_numpy()
        bins, offset = place(length, capacity)
        fill = np.bincount(bins, weights=length).astype(np.int64)
        loose = (capacity - fill > capacity * TIGHT)[bins] & (not last)
        base = (level << 56) + (TaskContext.get().partitionId() << 32)
        out = t.select(["doc_id", "piece", "start", "length", "ids_crc32"]).combine_chunks()
        cols = [*out.columns, pa.array(base + bins), pa.array(offset), pa.array(loose)]
        yield from pa.Table.from_arrays(cols, schema=PLACED).to_batches(max_chunksize=8192)

    return rows.mapInArrow(run, _DDL + ", sequence_id long, offset long, open boolean")


def assign(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence and an offset."""
    parts = max(1, rows.rdd.getNumPartitions())
    done, level, last = None, 0, parts == 1
    while True:
        got = cut(_level(rows, level, last, capacity), f"packed-{level}")
        closed = got.filter(~F.col("open")).drop("open")
        done = closed if done is None else done.unionByName(closed)
        if last:
            return done
        rows = got.filter("open").select("doc_id", "piece", "start", "length", "ids_crc32")
        fewer = max(-(-parts // FAN_IN), -(-rows.count() // TASK_PIECES))
        parts, last = min(fewer, parts), fewer == 1 or fewer >= parts
        rows = rows.repartition(parts) if last and parts > 1 else rows.coalesce(parts)
        level += 1


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return assign(cut(pieces(docs, tokenizer, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array<long>), pieces (where each came from).

    ``doc_id`` must be unique in ``docs``, since the ids are joined on (doc_id, piece).
    """
    ids = pieces(docs, tokenizer, capacity, keep_ids=True).select("doc_id", "piece", "ids")
    j = placed.join(ids, ["doc_id", "piece"])
    part = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    g = j.groupBy("sequence_id").agg(part.alias("p"))
    return g.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"),
                    F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("pieces"))
