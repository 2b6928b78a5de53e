"""Substring dedup: repeated passages found by winnowed anchors and removed from later documents.

A window is ``window`` consecutive words of one document; a word goes if a
window over it also starts in a document with a smaller id. What is left of
touching windows are the maximal repeats of at least ``window`` words.

* Seed. Every window has an anchor: the smallest hash among its 5-word grams
  (winnowing), so equal windows have equal anchors. Documents are joined on
  anchors: an anchor that only one document has cannot belong to a repeat.
* Compare, in place of an extension word by word. Around a shared anchor, all
  windows that it anchors, to its left and to its right, are compared: the
  smallest id that has the same window decides.
* Keep. Words covered by no repeated window are kept.

Scale. Documents are dealt into cells of a few MB by a hash of the row; a cell
is one Python call. A cell sends an anchor once, however many of its documents
hold it, and gets one bit back; the same for windows, with the smallest id in
the cell. So a passage that a third of all documents share costs one entry a
cell, and no pairs are ever made. Anchors and windows meet in buckets whose
number grows with the input, and so do the partitions that cells and buckets
are dealt into: a task holds some cells whatever the session's number of
shuffle partitions. Texts are shuffled once; the three calls on a cell read
the same exchange. Windows compare by 64 bits of hash beside the
bits of the anchor's bucket; anchors by 32 bits beside their bucket, which can
only send some windows to be compared in vain.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from .common import shuffle_partitions

GRAM = 5                        # words of a gram
CELL_BYTES = 4_000_000          # text of one cell
BUCKET_BYTES = 8_000_000        # text whose anchors or windows meet in one bucket
PART_BYTES = 64_000_000         # text whose cells or buckets share a partition, at most on average
NO_ID = np.iinfo(np.int64).max  # a null id counts as the largest


def dedup_substrings(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
                     cell_bytes: int = CELL_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row per row of ``docs``.

    Words are runs without ASCII white space, unchanged; ``kept`` joins the
    words kept by one space. Windows are judged on the input. Rows of one
    doc_id never remove words of each other; a null doc_id counts as larger
    than any id (rows without ids do not remove from each other). A null or
    empty text has no words and an empty ``kept``; a text shorter than a window
    is kept whole; a very long text makes its cell as much larger. No rows give
    no rows. Other columns are not read.
    """
    if window < GRAM:
        raise ValueError(f"window: at least {GRAM} words")
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    cells, buckets = size // cell_bytes + 1, size // bucket_bytes + 1
    # the partition in the hash spreads rows that are repeated as a whole
    cell = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.spark_partition_id()), F.lit(cells)).cast("int").alias("cell")
    dealt = docs.select(cell, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    some = shuffle_partitions(docs.sparkSession)
    of_cells, of_buckets = (max(min(groups, some), size // PART_BYTES + 1) for groups in (cells, buckets))

    # by number, not by hash: every partition gets the same number of cells, give or take one
    def by_cell(df: DataFrame) -> GroupedData:
        return df.repartitionById(of_cells, F.col("cell")).groupBy("cell")

    def by_bucket(df: DataFrame) -> GroupedData:
        return df.repartitionById(of_buckets, F.col("bucket")).groupBy("bucket")

    answer = "cell int, bucket int, seed boolean, bits binary"
    seeds = by_bucket(by_cell(dealt).applyInArrow(_sender(window, buckets), "bucket int, cell int, data binary")).applyInArrow(_shared, answer)
    asked = by_cell(dealt).cogroup(by_cell(seeds)).applyInArrow(_extender(window, buckets), "bucket int, cell int, data binary, ids binary")
    repeats = by_bucket(asked).applyInArrow(_earlier, answer)
    return (by_cell(dealt).cogroup(by_cell(seeds.union(repeats)))
            .applyInArrow(_remover(window, buckets), "doc_id long, n_words long, n_removed long, kept string"))


# --- one cell ---------------------------------------------------------------------------------

class _Cell:
    """Words, windows and anchors of a cell's documents, laid end to end."""

    def __init__(self, docs: pa.Table, window: int, buckets: int):
        self.ids = docs.column("doc_id").fill_null(int(NO_ID)).to_numpy()
        self.words = [(t or b"").split() for t in docs.column("text").cast(pa.binary()).to_pylist()]
        self.window, self.buckets = window, buckets
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(lengths)
        flat = [w for ws in self.words for w in ws]
        codes = {w: xxhash.xxh64_intdigest(w) for w in set(flat)}
        code = np.fromiter(map(codes.__getitem__, flat), np.uint64, len(flat))
        n = max(0, len(flat) - window + 1)          # windows by start, the ones over a document's end invalid
        doc = np.repeat(np.arange(len(lengths)), lengths)
        self.at = np.flatnonzero(doc[:n] == doc[window - 1:]) if n else np.zeros(0, np.int64)
        self.doc = self.ids[doc[self.at]] if n else np.zeros(0, np.int64)
        if not n:
            self.anchor = self.value = np.zeros(0, np.uint64)
            return
        grams = _mixed(_rolled(code, GRAM, 0x9E3779B97F4A7C15))
        self.anchor = _sliding_min(grams, window - GRAM + 1)[self.at]
        self.value = _mixed(_rolled(code, window, 0xD6E8FEB86659FD93))[self.at]

    def bucket(self, anchor: np.ndarray) -> np.ndarray:
        return ((anchor >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchors, shared, inverse): distinct ones by bucket; shared: two ids of this cell have it."""
        order = np.lexsort((self.anchor, self.bucket(self.anchor)))
        sent, first, group = _runs(self.anchor[order])
        inverse = np.empty(len(order), np.int64)
        inverse[order] = group
        ids = self.doc[order]
        low, high = np.minimum.reduceat(ids, first) if len(first) else ids, np.maximum.reduceat(ids, first) if len(first) else ids
        return sent, low != high, inverse


def _rolled(code: np.ndarray, width: int, factor: int) -> np.ndarray:
    """Polynomial hashes of ``width`` consecutive codes, by doubling."""
    total, power, out, done = code, np.uint64(factor), None, 0
    span = 1
    while True:
        if width & span:
            if out is None:
                out = total
            else:       # the codes summed so far, then ``span`` more
                out = out[:len(code) - done - span + 1] * power + total[done:done + len(code) - done - span + 1]
            done += span
            if done == width:
                return out
        total = total[:len(total) - span] * power + total[span:]
        span *= 2
        power = np.uint64(pow(factor, span, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """The bits of a hash spread evenly: multiply and shift, twice."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, span = x, 1
    while span * 2 <= width:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, start, run of each item) of the runs of equal items."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return x[first], first, np.cumsum(new) - 1


def _slices(bucket: np.ndarray):
    """(bucket, from, to) of the runs of a sorted array."""
    value, first, _ = _runs(bucket)
    return zip(value.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)])


def _table(columns: dict[str, list], **kinds: pa.DataType) -> pa.Table:
    return pa.table({k: pa.array(columns[k], t) for k, t in kinds.items()})


# --- seed ---------------------------------------------------------------------------------------

def _sender(window: int, buckets: int):
    def send(key: tuple, docs: pa.Table) -> pa.Table:
        cell = _Cell(docs, window, buckets)
        sent, _, _ = cell.anchors()
        out: dict[str, list] = {"bucket": [], "cell": [], "data": []}
        for b, lo, hi in _slices(cell.bucket(sent)):
            out["bucket"].append(b)
            out["cell"].append(key[0].as_py())
            out["data"].append(sent[lo:hi].astype(np.uint32).tobytes())
        return _table(out, bucket=pa.int32(), cell=pa.int32(), data=pa.binary())
    return send


def _shared(key: tuple, sent: pa.Table) -> pa.Table:
    """For each cell of a bucket: which of its anchors another cell has too."""
    parts = [np.frombuffer(x, np.uint32) for x in sent.column("data").to_pylist()]
    every = np.concatenate(parts)
    order = np.argsort(every, kind="stable")
    _, first, run = _runs(every[order])
    flags = np.empty(len(every), bool)
    flags[order] = np.diff([*first, len(every)])[run] > 1
    return _answers(key, sent, parts, flags, True)


def _answers(key: tuple, asked: pa.Table, parts: list[np.ndarray], flags: np.ndarray, seed: bool) -> pa.Table:
    """The flags of each cell that asked, as bits; none where no flag is set."""
    out: dict[str, list] = {"cell": [], "bucket": [], "seed": [], "bits": []}
    at = 0
    for cell, part in zip(asked.column("cell").to_pylist(), parts):
        mine = flags[at:at + len(part)]
        at += len(part)
        if mine.any():
            out["cell"].append(cell)
            out["bucket"].append(key[0].as_py())
            out["seed"].append(seed)
            out["bits"].append(np.packbits(mine).tobytes())
    return _table(out, cell=pa.int32(), bucket=pa.int32(), seed=pa.bool_(), bits=pa.binary())


def _told(answers: pa.Table, seed: bool, bucket: np.ndarray) -> np.ndarray:
    """The flags that the answers set for items sorted by ``bucket``."""
    said = {b: bits for b, s, bits in zip(*(answers.column(c).to_pylist() for c in ("bucket", "seed", "bits"))) if s == seed}
    flags = np.zeros(len(bucket), bool)
    for b, lo, hi in _slices(bucket):
        if b in said:
            flags[lo:hi] = np.unpackbits(np.frombuffer(said[b], np.uint8), count=hi - lo)
    return flags


# --- extend -------------------------------------------------------------------------------------

def _extender(window: int, buckets: int):
    def extend(key: tuple, docs: pa.Table, seeds: pa.Table) -> pa.Table:
        cell = _Cell(docs, window, buckets)
        w = _Windows(cell, seeds)
        out: dict[str, list] = {"bucket": [], "cell": [], "data": [], "ids": []}
        for b, lo, hi in _slices(w.bucket):
            out["bucket"].append(b)
            out["cell"].append(key[0].as_py())
            out["data"].append(w.value[lo:hi].tobytes())
            out["ids"].append(w.first_id[lo:hi].tobytes())
        return _table(out, bucket=pa.int32(), cell=pa.int32(), data=pa.binary(), ids=pa.binary())
    return extend


class _Windows:
    """The distinct windows of a cell around its shared anchors: bucket, value, smallest id in the cell."""

    def __init__(self, cell: _Cell, seeds: pa.Table):
        sent, shared, inverse = cell.anchors()
        shared = shared | _told(seeds, True, cell.bucket(sent))
        pick = np.flatnonzero(shared[inverse])
        value, ids = cell.value[pick], cell.doc[pick]
        # both count: at the edge of a common passage one anchor has as many windows as documents
        bucket = cell.bucket((cell.anchor[pick] >> np.uint64(1)) + (value >> np.uint64(1)))
        order = np.lexsort((ids, value, bucket))
        self.at, bucket, value, ids = cell.at[pick][order], bucket[order], value[order], ids[order]
        new = np.ones(len(order), bool)
        new[1:] = (value[1:] != value[:-1]) | (bucket[1:] != bucket[:-1])
        self.bucket, self.value, self.first_id = bucket[new], value[new], ids[new]
        self.group = np.cumsum(new) - 1                         # of each window of the cell, in its order
        self.later = ids != self.first_id[self.group]           # the cell has it under a smaller id


def _earlier(key: tuple, asked: pa.Table) -> pa.Table:
    """For each cell of a bucket: which of its windows another cell has under a smaller id."""
    parts = [np.frombuffer(x, np.uint64) for x in asked.column("data").to_pylist()]
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in asked.column("ids").to_pylist()])
    every = np.concatenate(parts)
    order = np.argsort(every, kind="stable")
    _, first, run = _runs(every[order])
    flags = np.empty(len(every), bool)
    flags[order] = np.minimum.reduceat(ids[order], first)[run] < ids[order]
    return _answers(key, asked, parts, flags, False)


# --- keep ---------------------------------------------------------------------------------------

def _remover(window: int, buckets: int):
    def remove(_: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        cell = _Cell(docs, window, buckets)
        w = _Windows(cell, answers)
        hit = w.at[w.later | _told(answers, False, w.bucket)[w.group]]
        edge = np.zeros(int(cell.ends[-1]) + 1 if len(cell.ends) else 1, np.int64)
        edge[hit] += 1          # starts are distinct
        edge[hit + window] -= 1
        keep = np.cumsum(edge)[:-1] == 0
        out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
        lo = 0
        for doc_id, words, hi in zip(docs.column("doc_id").to_pylist(), cell.words, cell.ends.tolist()):
            mine = keep[lo:hi]
            left = words if mine.all() else list(compress(words, mine.tolist()))
            lo = hi
            out["doc_id"].append(doc_id)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(left))
            out["kept"].append(b" ".join(left).decode())
        return _table(out, doc_id=pa.int64(), n_words=pa.int64(), n_removed=pa.int64(), kept=pa.string())
    return remove
