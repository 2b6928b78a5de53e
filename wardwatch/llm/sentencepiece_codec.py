"""SentencePiece encoding and decoding by the best path over a piece vocabulary.

An Aho-Corasick automaton over all pieces reads a text once. At each position
its output links name every piece that ends there, and each of them relaxes
the best score of the position (Viterbi): best[end] = max over pieces of
best[end - length] + score. A character that is no piece of its own costs the
unknown score (10 below the lowest score) and is written as its bytes. Of
equal scores the longest last piece wins.

Text form: spaces become U+2581, one more in front; nothing else is changed.
Pieces never reach over the start of a run of U+2581 nor over a line feed, so
a text's best path is that of its words. The distinct words of many texts are
told at once, and their paths are kept for reuse. A vocabulary that has such a
piece is used on whole texts.

Scale: a narrow map over the documents; a task holds some texts of bounded
size together, or one longer text, and the known words' paths, also of bounded
size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_BYTES = 32_000_000    # known words and their paths
LONGEST_KNOWN = 64          # bytes of a word that is kept
WORDS_AT_ONCE = 20_000      # searched in one pass
BYTES_AT_ONCE = 4_000_000   # of texts, or one text
LISTS_AT_ONCE = 1_000


class Codec:
    """Encoder and decoder of one vocabulary: a list of (piece, score, kind), the index being the id.

    Kinds: ``normal``; ``byte`` (named ``<0x41>``); ``unknown``; ``control`` (decoded to nothing).
    """

    def __init__(self, pieces: list[tuple[str, float, str]]):
        import ahocorasick

        normal = [(p, s, i) for i, (p, s, kind) in enumerate(pieces) if kind == "normal"]
        self.automaton = ahocorasick.Automaton()
        for p, s, i in normal:
            self.automaton.add_word(p, (len(p), s, i))
        self.automaton.make_automaton()
        self.unknown_score = min((s for _, s, _ in normal), default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p, _, _ in normal if len(p) == 1} - {"\0"}
        unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == "unknown"), 0)
        named = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        self.of_byte = [named.get(b, unknown) for b in range(256)]
        self.bytes_of = [b"" if kind == "control" else bytes([int(p[3:5], 16)]) if kind == "byte" else
                         " ⁇ ".encode() if kind == "unknown" else p.encode() for p, _, kind in pieces]
        self.by_word = not any("\n" in p or SPACE in p.lstrip(SPACE) for p, _, _ in normal)
        self.words, self.paths = pa.array([], pa.large_string()), pa.array([], pa.large_list(pa.int32()))  # known

    @classmethod
    def from_file(cls, path: str) -> Codec:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: ("byte" if m.is_byte(i) else "unknown" if m.is_unknown(i) else
                          "control" if m.is_control(i) or m.is_unused(i) else "normal")
        return cls([(m.id_to_piece(i), m.get_score(i), kind(i)) for i in range(m.get_piece_size())])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian int32."""
        ends, ids = self.encode_all(texts)
        return [ids[start:end].astype("<i4").tobytes() for start, end in zip(ends, ends[1:])]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ends, ids): text ``i`` has the ids from ``ends[i]`` to ``ends[i + 1]``."""
        forms = [(SPACE + t.replace(" ", SPACE)).encode() if t else b"" for t in texts]
        at = np.cumsum([0, *map(len, forms)])
        data = np.frombuffer(b"".join(forms), np.uint8)
        starts = self._word_starts(data, at)
        words = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))
        words = words.dictionary_encode()
        found = self._paths_of(words.dictionary).take(words.indices)
        return found.offsets.to_numpy()[np.searchsorted(starts, at)], found.values.to_numpy()

    def _word_starts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where words start in the UTF-8 bytes ``data`` of texts that start at ``at``, and the end.

        A word: U+2581s and what follows them up to the next one or a line feed; a line feed.
        """
        first = np.zeros(len(data) + 1, bool)
        first[at] = True
        if self.by_word:
            feed = data == ord("\n")
            first[:-1] |= feed
            first[1:] |= feed
            a, b, c = SPACE.encode()
            space = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))
            first[space[np.diff(space, prepend=-3) != 3]] = True
        return np.flatnonzero(first)

    def _paths_of(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words, from the known ones or searched."""
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(place.is_null())
        if not len(new):
            return self.paths.take(place)
        texts = new.to_pylist()
        plain = [w for w in texts if self.single.issuperset(w)]
        searched = {}
        for start in range(0, len(plain), WORDS_AT_ONCE):
            some = plain[start:start + WORDS_AT_ONCE]
            searched.update(zip(some, self._paths(some)))
        ids = [searched[w] if w in searched else self._path(w) for w in texts]
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
        fresh = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat))
        places = place.fill_null(0).to_numpy().copy()
        places[place.is_null().to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
        found = pa.concat_arrays([self.paths, fresh]).take(pa.array(places))
        self._keep(words, found, new, fresh)
        return found

    def _keep(self, words: pa.Array, paths: pa.Array, new: pa.Array, fresh: pa.Array) -> None:
        """Know the ``new`` words too; if that is too much, ``words`` only, and if those are, none."""
        def short(*columns: pa.Array) -> list[pa.Array]:
            kept = pc.less_equal(pc.binary_length(columns[0]), LONGEST_KNOWN)
            return [c.filter(kept) for c in columns]

        new, fresh = short(new, fresh)
        self.words, self.paths = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.paths, fresh])
        if self.words.nbytes + self.paths.nbytes > CACHE_BYTES:
            self.words, self.paths = short(words, paths)
        if self.words.nbytes + self.paths.nbytes > CACHE_BYTES:
            self.words, self.paths = pa.array([], new.type), pa.array([], fresh.type)

    def _paths(self, words: list[str]) -> list[list[int]]:
        """Best paths of words made of known characters, in one pass over all of them.

        Each word stands after a NUL, which no such word holds and no piece crosses; its
        best path starts there, and a place is that of the last character of a piece.
        """
        text = "\0" + "\0".join(words)
        best = [float("-inf")] * len(text)
        last: list = [None] * len(text)
        at, starts = 0, []
        for w in words:
            best[at] = 0.0
            starts.append(at)
            at += len(w) + 1
        for end, piece in self.automaton.iter(text):
            score = best[end - piece[0]] + piece[1]
            if score > best[end]:
                best[end] = score
                last[end] = piece
        out = []
        for start, w in zip(starts, words):
            ids, end = [], start + len(w)
            while end > start:
                length, _, i = last[end]
                ids.append(i)
                end -= length
            ids.reverse()
            out.append(ids)
        return out

    def _path(self, word: str) -> list[int]:
        """Best path of any text, unknown characters included."""
        ends: list[list] = [[] for _ in range(len(word) + 1)]
        for end, piece in self.automaton.iter(word):
            ends[end + 1].append(piece)
        best, last = [0.0], [None]
        for end in range(1, len(word) + 1):
            score, chosen = float("-inf"), None
            for piece in ends[end]:
                s = best[end - piece[0]] + piece[1]
                if s > score:
                    score, chosen = s, piece
            if word[end - 1] not in self.single and best[end - 1] + self.unknown_score > score:
                score, chosen = best[end - 1] + self.unknown_score, None
            best.append(score)
            last.append(chosen)
        ids, end = [], len(word)
        while end:
            if last[end] is None:
                ids += [self.of_byte[b] for b in reversed(word[end - 1].encode())]
                end -= 1
            else:
                length, _, i = last[end]
                ids.append(i)
                end -= length
        return ids[::-1]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become U+FFFD."""
        return self._text(b"".join(map(self.bytes_of.__getitem__, ids)))

    def decode_all(self, ends: np.ndarray, ids: np.ndarray) -> list[str]:
        """The texts of ids as :meth:`encode_all` gives them."""
        parts = pa.array(self.bytes_of, pa.large_binary()).take(pa.array(ids))
        _, places, data = parts.buffers()
        at = np.frombuffer(places, np.int64)[ends].tolist()
        whole = memoryview(data or b"")
        return [self._text(bytes(whole[start:end])) for start, end in zip(at, at[1:])]

    @staticmethod
    def _text(raw: bytes) -> str:
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


def _some(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of consecutive rows with ``BYTES_AT_ONCE`` of texts at most, or one longer text."""
    before = np.cumsum([0, *pc.binary_length(batch.column(1)).fill_null(0).to_pylist()])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(before, before[start] + BYTES_AT_ONCE, "right")) - 1)
        rows = batch.slice(start, end - start)
        yield rows.column(0).cast(pa.int64()), [t or "" for t in rows.column(1).to_pylist()]
        start = end


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids), one row per row of ``docs``.

    A null or empty text has no ids. Null and repeated ids keep their rows.
    Other columns are not read. ``model_path`` must be readable on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_file(model_path)
        for keys, texts in chain.from_iterable(map(_some, batches)):
            yield pa.record_batch([keys, _lists(*codec.encode_all(texts))], names=["doc_id", "ids"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text), one row per row of ``encoded``; null ids give an empty text.

    Gives back the text that was encoded, but for U+2581, which comes back as a space.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_file(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, LISTS_AT_ONCE):
                some = batch.slice(at, LISTS_AT_ONCE)
                texts = pa.array([codec.decode(x or []) for x in some.column(1).to_pylist()], pa.string())
                yield pa.record_batch([some.column(0).cast(pa.int64()), texts], names=["doc_id", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def encode_and_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): :func:`encode_documents`, and what its ids decode to, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.from_file(model_path)
        for keys, texts in chain.from_iterable(map(_some, batches)):
            ends, ids = codec.encode_all(texts)
            yield pa.record_batch([keys, _lists(ends, ids), pa.array(codec.decode_all(ends, ids), pa.string())],
                                  names=["doc_id", "ids", "decoded"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _lists(ends: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
