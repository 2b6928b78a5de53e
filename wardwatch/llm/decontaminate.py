"""Benchmark decontamination: rare seeds join documents to test items, Smith-Waterman alignment decides.

* Pairs. An alignment (match 2, other word -1, gap -1) of m matches has m - 1
  steps from a match to the next one. If a of them hold no other word or gap and
  b hold exactly one, its score is at most 2m - b - 2(m - 1 - a - b), so a score
  of s needs 2a + b >= s - 2. Such a step is a pair of words, next to each other
  or one word apart, in the item and in the text alike. The text between the
  first and the last match has at most 3n - s words for an item of n words.
* Seeds. The steps from an item's word weigh at most 2: 1 if the pair of neighbours
  is a seed where the text has it as neighbours too, 0 if its other pairs are seeds
  as well. As long as what may be reached with t - 1 seeds is s - 2 or more, the
  item takes the next rarest seed, by the counts of its pairs in all documents.
  So every alignment that reaches the threshold holds t seeds, whatever the size of
  the corpus, and common pairs are seeds only of items that have no others. t is 1
  for short items and grows to 4 with s. Items of so low an s that it asks for no
  pair have each word as a seed.
* Candidates. Documents are joined with the items on the seeds. Around t seeds in
  3n - s words all pairs of that item are counted, with 2 for a pair next to each
  other on both sides and 1 for others; where s - 2 is reached, it is aligned.
* Alignment. The item is aligned locally with the document around the candidates,
  so replaced, inserted and dropped words cost a little each. The score is a
  share of the item's perfect score.

Scale: items are taken in blocks of bounded text, broadcast to the scans; for
each block there are two scans of the documents, one that counts pairs (one row a
pair and partition is shuffled) and one that joins. Nothing of the documents but
the counts of the block's pairs reaches the driver. A worker holds about
TEXT_AT_ONCE characters of texts, or one text, and PAIRS places.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

THRESHOLD = 0.5                 # share of an item's perfect score
ITEMS_AT_ONCE = 20_000          # items of a block
BLOCK_TEXT = 8_000_000          # characters of a block's items
TEXT_AT_ONCE = 4_000_000        # characters of texts looked at together, unless one text has more
CELLS = 4_000_000               # cells of one batch of alignments
PAIRS = 1_000_000               # seeds, or words around them, looked at together
MATCH, OTHER, GAP = 2, -1, -1

_words = re.compile(r"\w+").findall
FOUND = "doc_id long, item_id long, score double, start_word long, end_word long"


class _Keys:
    """Sorted distinct keys; a table of hash slots tells most others apart without a search."""

    def __init__(self, key: np.ndarray):
        self.key = key
        self.bits = np.uint64(64 - min(24, max(10, len(key).bit_length() + 4)))
        self.maybe = np.zeros(1 << (64 - int(self.bits)), bool)
        self.maybe[self._slot(key)] = True

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.bits

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``key`` that are here, their places among the keys)."""
        at = np.flatnonzero(self.maybe[self._slot(key)])
        if not len(self.key):
            return at[:0], at[:0]
        place = np.minimum(np.searchsorted(self.key, key[at]), len(self.key) - 1)
        same = self.key[place] == key[at]
        return at[same], place[same]


class Block:
    """Items of a block, as numbers of words in its vocabulary (from 1), and their word pairs, left word * base + right word."""

    def __init__(self, rows: list[tuple], threshold: float = THRESHOLD):
        """rows: (item_id, words), each with words."""
        self.item_ids = [i for i, _ in rows]
        self.vocabulary: dict[str, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.items = [np.array([number(w) for w in words], np.int64) for _, words in rows]
        self.base = len(self.vocabulary) + 1
        size = np.array([len(x) for x in self.items], np.int64)
        self.least = np.where(size < 3, 1.0, threshold) * MATCH * size      # score to reach; items of one or two words: whole
        self.need = self.least - 2 - 1e-6                                   # weight of pairs that it takes
        self.span = np.maximum(1, np.ceil(3 * size - self.least)).astype(np.int64)      # most words of text of such an alignment
        self.times = 1 + np.clip(self.need // 8, 0, 3).astype(np.int64)     # seeds in such an alignment
        near = [x[:-1] * self.base + x[1:] for x in self.items]
        far = [x[:-2] * self.base + x[2:] for x in self.items]
        key = np.concatenate(near + far)
        self.pairs, place = np.unique(key, return_inverse=True)
        cuts = np.cumsum([len(x) for x in near + far])[:-1]
        parts = np.split(place, cuts)
        self.near, self.far = parts[:len(near)], parts[len(near):]          # by item and word: the pair that starts there
        item = np.repeat(np.tile(np.arange(len(self.items)), 2), [len(x) for x in near + far])
        weight = np.repeat([2, 1], [sum(map(len, near)), sum(map(len, far))])
        # which item has which pair, the heavier of equal ones
        held = place * len(self.items) + item
        order = np.lexsort((-weight, held))
        new = np.concatenate(([True], np.diff(held[order]) != 0)) if len(held) else np.zeros(0, bool)
        self.held, self.weight = held[order][new], weight[order][new]
        self.keys = _Keys(self.pairs)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of all texts end to end, 0 for others; end of each text)."""
        get, out, ends = self.vocabulary.get, [], []
        for t in texts:
            out.extend([get(w, 0) for w in _words(t.lower())])
            ends.append(len(out))
        return np.array(out, np.int64), np.array(ends, np.int64)

    def steps(self, numbers: np.ndarray, text: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, keys) of the pairs of words of the vocabulary in one text, ``apart`` words from each other."""
        left, right = numbers[:-apart], numbers[apart:]
        at = np.flatnonzero((left > 0) & (right > 0) & (text[:-apart] == text[apart:]))
        return at, left[at] * self.base + right[at]

    def count(self, texts: list[str], total: np.ndarray) -> None:
        """Add how often the texts have each pair as neighbours (row 0) and one word apart (row 1)."""
        numbers, ends = self.numbers(texts)
        text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        for apart in (1, 2):
            place = self.keys.find(self.steps(numbers, text, apart)[1])[1]
            total[apart - 1] += np.bincount(place, minlength=len(self.pairs))

    def choose_seeds(self, total: np.ndarray) -> _Seeds:
        """The rarest seeds that no alignment with enough weight can do without."""
        words: list[tuple] = []
        close: list[tuple] = []         # (pairs, item): neighbours in the text
        apart: list[tuple] = []
        for k, (x, near, far) in enumerate(zip(self.items, self.near, self.far)):
            if self.need[k] <= 0:
                words.append((x, k))
                continue
            first = total[0][near].astype(float)                 # the pair of neighbours, as neighbours: 2 falls to 1
            second = total[1][near].astype(float)                # all other pairs from that word: 1 falls to 0
            second[:len(far)] += total[0][far] + total[1][far]
            both = (first + second) / 2
            price = np.concatenate((np.where(second < first, both, first), np.where(second < first, both, second)))
            place, level = np.tile(np.arange(len(near)), 2), np.repeat([0, 1], len(near))
            least = int(np.floor(2 * (len(near) + self.times[k] - 1) - self.need[k])) + 1
            order = np.lexsort((level, place, price))[:least]
            one, two = place[order][level[order] == 0], place[order][level[order] == 1]
            beyond = far[two[two < len(far)]]
            close += [(self.pairs[near[one]], k), (self.pairs[beyond], k)]
            apart += [(self.pairs[near[two]], k), (self.pairs[beyond], k)]
        return _Seeds(words, close, apart)


class _Seeds:
    """The seeds by how many words they are apart in the text (0: single words), with the items that took them."""

    def __init__(self, *kinds: list[tuple]):
        self.kinds = []
        for apart, rows in enumerate(kinds):
            key = np.concatenate([k for k, _ in rows] or [np.zeros(0, np.int64)])
            item = np.repeat([i for _, i in rows], [len(k) for k, _ in rows]).astype(np.int64)
            if len(key):
                order = np.lexsort((item, key))
                key, item = key[order], item[order]
                new = np.concatenate(([True], (np.diff(key) != 0) | (np.diff(item) != 0)))
                key, item = key[new], item[new]
                distinct, first = np.unique(key, return_index=True)
                self.kinds.append((apart, _Keys(distinct), np.append(first, len(key)), item))

    def find(self, block: Block, numbers: np.ndarray, text: np.ndarray) -> list[tuple]:
        """(places in the text, first and end of their items, items) of each kind."""
        out = []
        for apart, keys, first, item in self.kinds:
            if apart:
                at, key = block.steps(numbers, text, apart)
            else:
                at = np.flatnonzero(numbers)
                key = numbers[at]
            some, place = keys.find(key)
            out.append((at[some], first[place], first[place + 1], item))
        return out


def _blocks(docs: DataFrame, benchmark: DataFrame, threshold: float, items_at_once: int, text_col: str) -> Iterator:
    """The blocks of the benchmark and their seeds, as broadcasts."""
    sc = docs.sparkSession.sparkContext
    # written, so that the numbers of the rows stay: equal rows are dealt to different blocks
    items = cut(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")))
    items = items.withColumn("row", F.monotonically_increasing_id())
    n, size = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    rounds = max(-(-n // items_at_once), -(-(size or 0) // BLOCK_TEXT))
    for r in range(rounds):
        mine = items.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == r)
        rows = sorted(mine.collect(), key=lambda x: (x.item_id is None, x.item_id or 0, x.text or ""))
        rows = [(x.item_id, words) for x in rows if (words := _words((x.text or "").lower()))]
        if rows:
            shared = sc.broadcast(Block(rows, threshold))
            yield shared, sc.broadcast(shared.value.choose_seeds(_counted(docs, shared, text_col)))


def _counted(docs: DataFrame, shared, text_col: str) -> np.ndarray:
    """How often all documents have each pair of a block, as neighbours and one word apart."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(shared.value.pairs)), np.int64)
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                shared.value.count(texts, total)
        met = np.flatnonzero(total.any(axis=0))
        yield pa.record_batch([pa.array(met), pa.array(total[0][met]), pa.array(total[1][met])], names=["pair", "close", "apart"])

    rows = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "pair long, close long, apart long")
            .groupBy("pair").agg(F.sum("close").alias("close"), F.sum("apart").alias("apart")).toArrow())
    total = np.zeros((2, len(shared.value.pairs)), np.int64)
    total[:, rows.column("pair").to_numpy()] = rows.column("close").to_numpy(), rows.column("apart").to_numpy()
    return total


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of texts with at most TEXT_AT_ONCE characters, or of one text; a null one is empty."""
    some, size, begin = [], 0, 0
    for at, t in enumerate(texts):
        t = t.as_py() or ""
        if some and size + len(t) > TEXT_AT_ONCE:
            yield begin, some
            some, size, begin = [], 0, at
        some.append(t)
        size += len(t)
    if some:
        yield begin, some


def contaminations(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text", items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): items that a document holds, copied or edited.

    One row per row of ``docs`` and row of ``benchmark`` (item_id, text) whose
    best local alignment scores ``threshold`` or more of the item's perfect
    score; the best place, the first of equals; ``end_word`` exclusive. Words are
    letters and digits, case ignored. Null and empty texts match nothing; a very
    long text is searched whole, by itself; null and repeated ids on either side
    keep their rows. Items of fewer than three words match when they stand in the
    text whole. Without documents or items there are no rows. Other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for shared, seeds in _blocks(docs, benchmark, threshold, items_at_once, text_col):

        def report(batches: Iterator[pa.RecordBatch], shared=shared, seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = _found(shared.value, seeds.value, batch.column(1))
                columns = list(zip(*((ids[d], shared.value.item_ids[k], s, a, b) for d, k, s, a, b in found))) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)],
                                      names=["doc_id", "item_id", "score", "start_word", "end_word"])

        some = rows.mapInArrow(report, FOUND)
        out = some if out is None else out.union(some)
    return docs.sparkSession.createDataFrame([], FOUND) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
                  items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns kept. See :func:`contaminations`."""
    out = docs
    for shared, seeds in _blocks(docs, benchmark, threshold, items_at_once, text_col):

        def keep(batches: Iterator[pa.RecordBatch], shared=shared, seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.string())
                clean = np.ones(batch.num_rows, bool)
                clean[[d for d, *_ in _found(shared.value, seeds.value, texts)]] = False
                yield batch.filter(pa.array(clean))

        out = out.mapInArrow(keep, docs.schema)
    return out


def _found(block: Block, seeds: _Seeds, texts: pa.Array) -> list[tuple]:
    """(row, item, score, start, end) of the alignments of a batch that reach the threshold."""
    out = []
    for at, some in _slices(texts):
        out += [(at + d, *rest) for d, *rest in _aligned(block, seeds, *block.numbers(some))]
    return out


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, end to end."""
    return np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)


def _windows(block: Block, seeds: _Seeds, numbers: np.ndarray, ends: np.ndarray, text: np.ndarray) -> Iterator[tuple]:
    """(item, start, end) of the places around enough seeds, in runs of about PAIRS seeds; those of one run and item are apart."""
    found = seeds.find(block, numbers, text)
    reach = int(block.span.max())
    wide = len(numbers) + reach         # places of different items are never near
    total = np.zeros(len(numbers) + 1, np.int64)        # seeds before each word
    for at, first, end, _ in found:
        total[1:] += np.cumsum(np.bincount(at, end - first, len(numbers)).astype(np.int64))
    lows, begin = np.concatenate(([0], ends[:-1])), 0
    while begin < len(numbers):
        stop = max(begin + 1, int(np.searchsorted(total, total[begin] + PAIRS, "right")) - 1)
        items, places = [], []
        for at, first, end, item in found:
            a, b = np.searchsorted(at, (begin, stop + reach))      # the first of enough seeds stands before ``stop``
            n = end[a:b] - first[a:b]
            items.append(item[_ranges(first[a:b], n)])
            places.append(np.repeat(at[a:b], n))
        begin = stop
        seed = np.unique(np.concatenate(items) * wide + np.concatenate(places))
        item, place = np.divmod(seed, wide)
        own, span, last = text[place], block.span[item], np.arange(len(seed)) + block.times[item] - 1
        inside = last < len(seed)
        last[~inside] = 0
        inside &= (place < stop) & (seed[last] - seed < span) & (text[place[last]] == own)
        if inside.any():
            item, place, own, span = item[inside], place[inside], own[inside], span[inside]
            yield _merged(item, own, np.maximum(lows[own], place - span + 1), np.minimum(ends[own], place + span))


def _merged(item: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of one item and text that touch are one; sorted by item and place."""
    new = np.concatenate(([True], (np.diff(item) != 0) | (np.diff(own) != 0) | (lo[1:] > hi[:-1])))
    start = np.flatnonzero(new)
    return item[start], lo[start], hi[np.append(start[1:], len(item)) - 1]


def _dense(block: Block, numbers: np.ndarray, ends: np.ndarray, text: np.ndarray, windows: tuple) -> Iterator[tuple]:
    """(text, item, start, end) of what must be aligned: the pairs of the item there weigh enough."""
    total = np.cumsum(windows[2] - windows[1])
    begin = 0
    while begin < len(total):
        done = int(total[begin - 1]) if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, done + PAIRS, "right")))
        item, lo, hi = (x[begin:stop] for x in windows)
        begin = stop
        place, item, hi = _ranges(lo, hi - lo), np.repeat(item, hi - lo), np.repeat(hi, hi - lo)
        weight = np.zeros(len(place), np.int64)         # a word starts one pair of an alignment
        for apart in (1, 2):
            at = np.flatnonzero((place + apart < ends[text[place]]) & (numbers[place] > 0))
            at = at[numbers[place[at] + apart] > 0]
            some, pair = block.keys.find(numbers[place[at]] * block.base + numbers[place[at] + apart])
            at = at[some]
            held = pair * len(block.items) + item[at]
            row = np.minimum(np.searchsorted(block.held, held), len(block.held) - 1)
            same = block.held[row] == held if len(held) else np.zeros(0, bool)
            weight[at[same]] = np.maximum(weight[at[same]], block.weight[row[same]] if apart == 1 else 1)
        sums = np.concatenate(([0], np.cumsum(weight)))
        last = np.arange(len(place)) + np.minimum(block.span[item], hi - place)
        full = sums[last] - sums[:-1] >= block.need[item]
        item, place = item[full], place[full]
        if len(item):
            own = text[place]
            item, lo, hi = _merged(item, own, place, np.minimum(ends[own], place + block.span[item]))
            yield from zip(text[lo].tolist(), item.tolist(), lo.tolist(), hi.tolist())


def _aligned(block: Block, seeds: _Seeds, numbers: np.ndarray, ends: np.ndarray) -> list[tuple]:
    lows = np.concatenate(([0], ends[:-1]))
    text = np.repeat(np.arange(len(ends)), ends - lows)
    best: dict[tuple[int, int], tuple] = {}
    for windows in _windows(block, seeds, numbers, ends, text):
        jobs = sorted(_dense(block, numbers, ends, text, windows), key=lambda j: (j[3] - j[2], j))
        _align(block, numbers, lows, jobs, best)
    return [(text, item, float(s), int(a), int(b)) for (text, item), (s, a, b) in best.items()]


def _align(block: Block, numbers: np.ndarray, lows: np.ndarray, jobs: list[tuple], best: dict) -> None:
    """Put the alignments that reach their score into ``best``, the first of the best of each text and item."""
    for some in _batches(jobs):
        pairs = [(block.items[item], numbers[lo:hi]) for _, item, lo, hi in some]
        score, stop = _smith_waterman(pairs)
        good = [i for i in range(len(pairs)) if score[i] >= block.least[some[i][1]]]
        # the start: the same alignment read backwards from its end
        back = _smith_waterman([(pairs[i][0][::-1], pairs[i][1][:stop[i]][::-1]) for i in good])[1] if good else []
        for i, length in zip(good, back):
            text, item, lo, _ = some[i]
            found = (score[i] / (MATCH * len(pairs[i][0])), lo + stop[i] - length - lows[text], lo + stop[i] - lows[text])
            old = best.get((text, item))
            if old is None or (found[0], -found[1]) > (old[0], -old[1]):
                best[text, item] = found


def _batches(jobs: list[tuple]) -> Iterator[list[tuple]]:
    """Jobs in runs whose padded alignments have at most CELLS cells a row of the item."""
    some, widest = [], 0
    for job in jobs:
        widest = max(widest, job[3] - job[2])
        if some and (len(some) + 1) * widest > CELLS // 8:
            yield some
            some, widest = [], job[3] - job[2]
        some.append(job)
    if some:
        yield some


def _smith_waterman(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(best score, end in the text) of the local alignment of each (item, text); all pairs at once, an item word a step."""
    tall, wide = max(len(x) for x, _ in pairs), max(len(y) for _, y in pairs)
    item, text = np.full((len(pairs), tall), -1, np.int32), np.full((len(pairs), wide), -2, np.int32)
    for i, (x, y) in enumerate(pairs):
        item[i, :len(x)], text[i, :len(y)] = x, y
    slope = (-GAP * np.arange(wide + 1)).astype(np.int32)
    row = np.zeros((len(pairs), wide + 1), np.int32)
    best, stop = np.zeros(len(pairs), np.int32), np.zeros(len(pairs), np.int64)
    for i in range(tall):
        new = np.maximum(row + GAP, 0)
        step = row[:, :-1] + np.where(text == item[:, i:i + 1], MATCH, OTHER).astype(np.int32)
        np.maximum(new[:, 1:], step, out=new[:, 1:])
        # gaps in the item: the best earlier cell less the gaps up to here
        row = np.maximum.accumulate(new + slope, axis=1) - slope
        at = row.argmax(axis=1)
        top = row[np.arange(len(pairs)), at]
        better = (top > best) | ((top == best) & (at < stop) & (top > 0))
        best, stop = np.where(better, top, best), np.where(better, at, stop)
    return best, stop
