"""Token ids in Re-Pair compressed shards, with random access.

Texts become ids, each document ends with an end id, and the ids of the whole
table stand in ascending order of doc_id. A shard holds the ids of consecutive
documents as a grammar: rounds of Re-Pair replace frequent pairs of symbols by
new symbols, until no pair occurs ``LEAST_COUNT`` times. In one round all pairs
whose left symbols are no right symbols of another chosen pair are replaced
together, most frequent first (their occurrences cannot overlap). The counts
are kept from round to round and changed only beside what was replaced.

File format: Parquet, one row a shard.

=========  ==============================================================
part       number of the key range, ascending in doc_id
shard      number within the range, ascending in doc_id
n_ids      ids in the shard
doc_ids    array of the documents' ids
ends       array: position after each document's end id, within the shard
base       symbols below it are ids; symbol base + k is rule k
rules      little-endian uint32 pairs: left and right symbol of each rule
sizes      little-endian uint32: ids that each rule expands to
symbols    little-endian uint32: the sequence
=========  ==============================================================

:func:`read_ids` finds a span of ids by summing expansion sizes, and expands
only the symbols that it meets.

Scale: one shuffle of texts by range of doc_id (equal or null ids split by
input position). A task holds one shard and one batch of texts. A document's
place among all ids comes from sums by range (a row for each partition) and by
shard, never from one task over all documents.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 2
SHARD_IDS = 1 << 20
LEAST_COUNT = 8         # occurrences that a pair needs
CHARS_AT_ONCE = 4_000_000
CACHE_WORDS, LONGEST_KEPT = 600_000, 48

FILE = ("part int, shard int, n_ids long, doc_ids array<long>, ends array<long>, base long, "
        "rules binary, sizes binary, symbols binary")


# --- ids --------------------------------------------------------------------------------------

# fixed values: letters and numbers among the characters below U+0250, on which all Unicode versions
# agree, and the pattern by which byte-level tokenizers of this kind cut a text into words
LETTERS, NUMBERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
WORDS = rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"


class _Words(dict):
    """Ids of words, made when first asked for."""

    def __init__(self, model, id_bytes: list[bytes]):
        self.model, self.id_bytes = model, id_bytes
        # byte-level alphabet: visible bytes stand for themselves, the others follow from U+0100
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in seen)}

    def __missing__(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self.letters)
        found = b"".join([self.id_bytes[t.id] for t in self.model.tokenize(shown)])
        if len(word) <= LONGEST_KEPT:
            self[word] = found
        return found


class Encoder:
    """Ids of texts as little-endian uint32, by the tokenizers library's byte-level BPE.

    Texts of characters below U+0250 are cut into words by the tokenizer's
    pattern; the library's BPE model gives the ids of each word, which are kept
    for reuse (that saves the cost of an ``Encoding`` for each text): so many, of
    so many characters at most, hence bounded in bytes. No word
    spans a space that is followed by a visible character, so of other texts,
    and those that hold a special token, only the pieces between such spaces that
    need it go to ``encode_batch``.
    """

    _words = re.compile(WORDS).findall
    _odd = re.compile("[\x1c-\x1f\u0250-\U0010ffff]").search       # the first four: white space to Python only
    _cut = re.compile(r"(?= \S)").split

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Words(self.tokenizer.model, [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        return [self._whole(t) if self._is_odd(t) else self._plain(t) for t in texts]

    def _is_odd(self, text: str) -> bool:
        return Encoder._odd(text) is not None or any(s in text for s in self.special)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, Encoder._words(text)))

    def _whole(self, text: str) -> bytes:
        pieces = Encoder._cut(text)
        odd = {p for p in pieces if self._is_odd(p)}
        ids = dict(zip(odd, (np.array(e.ids, "<u4").tobytes()
                             for e in self.tokenizer.encode_batch_fast(list(odd), add_special_tokens=False))))
        return b"".join([ids[p] if p in odd else self._plain(p) for p in pieces])


def encoder_of(tokenizer_path: str) -> Encoder:
    """This worker process's encoder: it serves many tasks, and keeps the words that they met."""
    home = sys.modules.setdefault("_wardwatch_encoders", types.ModuleType("_wardwatch_encoders"))
    if tokenizer_path not in home.__dict__:
        home.__dict__[tokenizer_path] = Encoder(tokenizer_path)
    return home.__dict__[tokenizer_path]


# --- Re-Pair ------------------------------------------------------------------------------------

def compress(ids: np.ndarray, base: int, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, sizes): the grammar of ``ids``, all below ``base``; no pair occurs ``least`` times in ``symbols``.

    The pairs of two symbols are counted when the newer of the two is made, and can only
    get fewer after that: a round adds the pairs of its new symbols, and takes away those
    beside what it replaced. A pair that is rare when it is counted is forgotten.
    """
    seq, rules, size = ids.astype(np.uint32), [], np.ones(base, np.uint32)
    keys, counts = _counted(_pairs_at(seq, slice(None, -1)), least)
    first = base
    while len(keys):
        pairs = _chosen(keys, counts)
        at, rule = _occurrences(seq, pairs, first)
        fewer = np.zeros(len(seq) + 1, bool)         # places before and behind a replaced pair, where the pairs of old neighbours begin
        fewer[at - 1] = fewer[at + 1] = True
        beside = np.flatnonzero(fewer[:len(seq) - 1])
        _, place = _found(keys, _pairs_at(seq, beside))
        counts = counts - np.bincount(place, minlength=len(keys))
        counts[np.searchsorted(keys, _key(pairs))] = 0
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq[at] = first + rule
        seq = seq[keep]
        now = at - np.arange(len(at))
        fresh = np.zeros(len(seq) + 1, bool)
        fresh[now - 1] = fresh[now] = True
        new_keys, new_counts = _counted(_pairs_at(seq, np.flatnonzero(fresh[:max(len(seq) - 1, 0)])), least)
        still = counts >= least
        keys, counts = np.concatenate((keys[still], new_keys)), np.concatenate((counts[still], new_counts))
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        size = np.concatenate((size, size[pairs].sum(axis=1, dtype=np.uint32)))
        rules.append(pairs)
        first += len(pairs)
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), size[base:]


def _key(pairs: np.ndarray) -> np.ndarray:
    return (pairs[:, 0].astype(np.uint64) << np.uint64(32)) | pairs[:, 1]


def _pairs_at(seq: np.ndarray, at) -> np.ndarray:
    """The pairs that begin at places ``at`` (none of them the last place), as numbers."""
    left, right = (seq[:-1], seq[1:]) if isinstance(at, slice) else (seq[at], seq[at + 1])
    pairs = left.astype(np.uint64)
    pairs <<= np.uint64(32)
    pairs |= right
    return pairs


def _hashed(pairs: np.ndarray, bits: int) -> np.ndarray:
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).view(np.int64)


def _found(keys: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, place): the ``pairs`` that are among ``keys`` (ascending), and where; most others are told by their hash."""
    there = np.zeros(1 << 18, bool)
    there[_hashed(keys, 18)] = True
    which = np.flatnonzero(there[_hashed(pairs, 18)])
    place = np.minimum(np.searchsorted(keys, pairs[which]), len(keys) - 1)
    same = keys[place] == pairs[which]
    return which[same], place[same]


def _counted(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, counts) of those that occur ``least`` times, in ascending order."""
    if len(pairs) < least:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # only what shares its hash value with enough others is sorted
    bits = max(10, min(20, len(pairs).bit_length()))
    place = _hashed(pairs, bits)
    enough = np.bincount(place, minlength=1 << bits) >= least
    keys, counts = np.unique(pairs[enough[place]], return_counts=True)
    often = counts >= least
    return keys[often], counts[often]


def _chosen(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Frequent pairs, most frequent first, such that no two occurrences of different ones overlap."""
    order = np.lexsort((keys, -counts))
    lefts, rights, out = set(), set(), []
    for k in keys[order].tolist():
        a, b = k >> 32, k & 0xFFFFFFFF
        if a not in rights and b not in lefts and (a != b or (a not in lefts and a not in rights)):
            lefts.add(a)
            rights.add(b)
            out.append((a, b))
    return np.array(out, np.uint32).reshape(-1, 2)


def _occurrences(seq: np.ndarray, pairs: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, number of the pair) of every occurrence of ``pairs`` that is replaced; all symbols are below ``first``."""
    is_left, is_right = np.zeros(first, bool), np.zeros(first, bool)
    is_left[pairs[:, 0]] = is_right[pairs[:, 1]] = True
    at = np.flatnonzero(is_left[seq[:-1]] & is_right[seq[1:]])
    keys = _key(pairs)
    order = np.argsort(keys)
    hit, found = _found(keys[order], _pairs_at(seq, at))
    at, rule = at[hit], order[found]
    # in a run of one symbol every other pair is replaced
    twin = pairs[rule, 0] == pairs[rule, 1]
    if twin.any():
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (rule[1:] != rule[:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        odd = twin & ((np.arange(len(at)) - start) % 2 == 1)
        at, rule = at[~odd], rule[~odd]
    return at, rule


def expand(symbols: np.ndarray, base: int, rules: np.ndarray) -> np.ndarray:
    """The ids of ``symbols``: the rules are written out once, and their ids copied into place."""
    nested = np.flatnonzero(symbols >= base)
    if not len(nested):
        return symbols
    flat, size = _written_out(base, rules)
    start = np.cumsum(size) - size
    used = symbols[nested] - base
    width = np.ones(len(symbols), np.int64)
    width[nested] = size[used]
    out = np.repeat(symbols, width)
    place = (np.cumsum(width) - width)[nested]
    length = size[used]
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(place, length) + within] = flat[np.repeat(start[used], length) + within]
    return out


def _written_out(base: int, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rules end to end, ids of each rule); a level of rules is opened at a time."""
    ids = rules.astype(np.uint32).reshape(-1)
    rule = np.repeat(np.arange(len(rules)), 2)
    while (nested := ids >= base).any():
        width = np.where(nested, 2, 1)
        out = np.repeat(ids, width)
        at = (np.cumsum(width) - width)[nested]
        pair = rules[ids[nested] - base]
        out[at], out[at + 1] = pair[:, 0], pair[:, 1]
        ids, rule = out, np.repeat(rule, width)
    return ids, np.bincount(rule, minlength=len(rules))


def read_ids(shard, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` of a shard (a row of the file), expanding only the symbols that they meet."""
    symbols, rules = np.frombuffer(shard["symbols"], "<u4"), np.frombuffer(shard["rules"], "<u4").reshape(-1, 2)
    base, sizes = shard["base"], np.frombuffer(shard["sizes"], "<u4").astype(np.int64)
    width = np.ones(len(symbols), np.int64)
    nested = symbols >= base
    width[nested] = sizes[symbols[nested] - base]
    ends = np.cumsum(width)
    lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    skip = start - (ends[lo - 1] if lo else 0)
    return expand(symbols[lo:hi], base, rules)[skip:skip + stop - start] if stop > start else symbols[:0]


# --- write and read -------------------------------------------------------------------------------

def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of ``docs`` to new files under ``path``, ascending in doc_id.

    A null text is empty: its only id is the end id. Null ids come first; rows
    of one id keep the order of the input. A document longer than a shard is a
    shard of its own. Other columns are not read. An empty table writes no row.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard = encoder_of(tokenizer_path), TaskContext.get().partitionId(), 0
        base = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        end = np.array([end_id], "<u4").tobytes()
        names, texts, size = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, stop in _spans(batch.column(1)):
                some = [t or "" for t in batch.column(1).slice(at, stop - at).to_pylist()]
                for doc_id, found in zip(ids[at:stop], encoder.encode(some)):
                    if texts and size + len(found) // 4 + 1 > shard_ids:
                        yield _shard(part, shard, names, texts, base)
                        names, texts, size, shard = [], [], 0, shard + 1
                    names.append(doc_id)
                    texts.append(found + end)
                    size += len(found) // 4 + 1
        if texts:
            yield _shard(part, shard, names, texts, base)

    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                 F.monotonically_increasing_id().alias("at"))
     .repartitionByRange("doc_id", "at").sortWithinPartitions("doc_id", "at").select("doc_id", "text")
     .mapInArrow(write, FILE).write.parquet(path))


def _spans(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of a batch's rows that hold about ``CHARS_AT_ONCE`` bytes of text each, or one row."""
    held = np.cumsum(np.array(pa.compute.binary_length(texts).fill_null(0), np.int64))
    at = 0
    while at < len(held):
        stop = max(at + 1, int(np.searchsorted(held, (held[at - 1] if at else 0) + CHARS_AT_ONCE, "right")))
        yield at, stop
        at = stop


def _shard(part: int, shard: int, names: list, texts: list[bytes], base: int) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(texts), "<u4")
    symbols, rules, sizes = compress(ids, base)
    ends = np.cumsum([len(t) // 4 for t in texts])
    raw = lambda x: pa.array([x.astype("<u4").tobytes()], pa.binary())
    longs = lambda x: pa.array([list(x)], pa.list_(pa.int64()))
    return pa.record_batch([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
                            longs(names), longs(ends.tolist()), pa.array([base], pa.int64()), raw(rules), raw(sizes),
                            raw(symbols)], names=["part", "shard", "n_ids", "doc_ids", "ends", "base", "rules", "sizes", "symbols"])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards under ``path``, a row each."""
    return spark.read.schema(FILE).parquet(path)


def document_index(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in ``shards``, from the decoded ids.

    ``start``: the ids of all documents before it; ``ids_crc32``: unsigned CRC-32
    of its ids as little-endian uint32, the end id included.
    """
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = expand(np.frombuffer(row["symbols"], "<u4"), row["base"],
                             np.frombuffer(row["rules"], "<u4").reshape(-1, 2)).astype("<u4")
                ends = row["ends"]
                starts = [0, *ends[:-1]]
                n = len(ends)
                yield pa.record_batch(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()),
                     pa.array([b - a for a, b in zip(starts, ends)], pa.int64()),
                     pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64())],
                    names=["part", "shard", "doc_id", "place", "n_tokens", "ids_crc32"])

    # where a part begins (a row for each partition), and where a shard begins within its part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda w: F.coalesce(F.sum("n_ids").over(w), F.lit(0))
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", so_far(before).alias("part_at"))
    begins = (shards.select("part", "shard", so_far(within).alias("shard_at")).join(parts, "part")
              .select("part", "shard", (F.col("part_at") + F.col("shard_at")).alias("begin")))
    docs = (shards.select("part", "shard", "doc_ids", "ends", "base", "rules", "symbols")
            .mapInArrow(decode, "part int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long"))
    return docs.join(begins, ["part", "shard"]).select("doc_id", (F.col("begin") + F.col("place")).alias("start"),
                                                       "n_tokens", "ids_crc32")
