"""Periodic runs of words: Lyndon arrays by the grouping phase of a suffix sorter, roots extended into runs.

A run is a maximal stretch of words with smallest period ``q``: words ``q`` apart
are identical, no neighbouring word prolongs it. The first phase of Baier's suffix
sorter puts the positions of a text into groups by their Lyndon prefix (the
longest Lyndon word that starts there), highest group first: a position that
leaves hands its prefix to the nearest position before it that is still there,
which moves to a group of its own above its old one. The length of the prefix
is the Lyndon array, with no second phase and no suffix array. Done under an
order of the words and under its reverse, every run holds two adjacent equal
prefixes of one of the two (its roots); the words next to the roots are compared
until they differ, which gives the run. Two positions share a group exactly if their
prefixes are equal, so that roots are found by comparing group numbers.

One text is one unit of work: the job is a map over the rows, without a shuffle,
so that copies, ties and hot sources cost what any other rows cost. Working
memory is about 500 bytes a word of the longest text of a task.

Results: NULL and empty texts and texts without words have no run and an empty
``kept``; repeated rows and repeated or NULL ids are rows of their own; very long
texts are read whole; an empty table gives an empty table. Other columns of the
input, whatever their names, are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed value: a word is a stretch without space, tab, line feed, vertical tab, form feed and carriage return
WORD = "[^\x20\x09-\x0D]+"
MIN_LENGTH, MIN_PERIODS = 24, 3
# texts that a task holds at once: so many, or so many characters
ROWS_AT_ONCE, CHARS_AT_ONCE = 512, 4_000_000


def places_of(words: list[int]) -> list[list[int]]:
    """The places of each word; words are numbers from 0 without gaps."""
    places: list = [[] for _ in range(max(words) + 1)]
    for place, word in enumerate(words):
        places[word].append(place)
    return places


def lyndon_groups(words: list[int], places: list[list[int]], descending: bool = False) -> tuple[list[int], list[int]]:
    """(length, group) of the longest Lyndon word at each position, from the words and :func:`places_of` them.

    The order is that of the numbers, or its reverse; the end of the text is smaller than any word.
    """
    n, n_words = len(words), len(places)
    # places still to be grouped, as a ring that is closed by place n
    before, after = list(range(-1, n)), list(range(1, n + 2))
    before[0], after[n] = n, 0
    length, group = [1] * n, words[:]
    members = places[:]
    size = [len(m) for m in members]
    # groups from the highest to the lowest; -1 ends the list
    if descending:
        below, above = list(range(1, n_words + 1)), list(range(-1, n_words - 1))
        below[-1], current = -1, 0
    else:
        below, above = list(range(-1, n_words - 1)), list(range(1, n_words + 1))
        current = n_words - 1

    def raise_to_new(places: list[int], old: int) -> None:
        new = len(members)
        members.append(places)
        size.append(len(places))
        size[old] -= len(places)
        for p in places:
            group[p] = new
        over = above[old]
        above.append(over)
        below.append(old)
        above[old] = new
        below[over] = new

    while current >= 0:
        here = members[current]
        if size[current] == 1:
            for place in here:
                if group[place] == current:
                    break
            p, q = before[place], after[place]
            after[p], before[q] = q, p
            if p != n:
                length[p] += length[place]
                old = group[p]
                if size[old] > 1:
                    raise_to_new([p], old)
        elif size[current]:
            # of a position that is followed by k members: k of their prefixes are added to its own
            moved: dict = {}
            last, k, step = n, 0, 0
            for place in here:
                if group[place] != current:
                    continue
                p, q = before[place], after[place]
                after[p], before[q] = q, p
                if p == last:
                    k += 1
                    continue
                if last != n:
                    length[last] += k * step
                    key = (group[last], k)
                    if key in moved:
                        moved[key].append(last)
                    else:
                        moved[key] = [last]
                step = length[place]
                last, k = p, 1
            if last != n:
                length[last] += k * step
                moved.setdefault((group[last], k), []).append(last)
            if len(moved) > 1:
                for (old, k), places in sorted(moved.items(), key=lambda m: -m[0][1]):
                    raise_to_new(places, old)
            else:
                for (old, k), places in moved.items():
                    if size[old] > len(places):
                        raise_to_new(places, old)
        current = below[current]
    return length, group


def runs_of(words: list, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``min_length`` words and ``min_periods`` (2 or more) periods, in order."""
    if len(words) < max(min_length, 2):
        return []
    numbers: dict = {}
    w = [numbers.setdefault(x, len(numbers)) for x in words]
    n, places = len(w), places_of(w)
    found = set()
    for descending in (False, True):
        lengths, groups = lyndon_groups(w, places, descending)
        length, group = np.array(lengths), np.array(groups)
        follows = np.arange(n) + length
        roots = np.flatnonzero(follows < n)
        if min_periods > 2:                                               # such a run holds two whole roots side by side
            roots = roots[group[follows[roots]] == group[roots]]
        for i in roots.tolist():
            p = lengths[i]
            if i >= p and groups[i - p] == groups[i]:
                continue                                                  # not the first root of its run
            stop = i + p
            while stop < n and groups[stop] == groups[i]:
                stop += p
            if stop - i + 2 * (p - 1) < max(min_length, min_periods * p):
                continue
            start = i
            while start > 0 and w[start - 1] == w[start - 1 + p]:
                start -= 1
            while stop < n and w[stop] == w[stop - p]:
                stop += 1
            if stop - start >= max(min_length, min_periods * p):
                found.add((start, stop - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return " ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return " ".join(np.array(words, object)[keep])


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    at, rows, chars = 0, 0, 0
    for k, size in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
        if rows and (rows == ROWS_AT_ONCE or chars + (size or 0) > CHARS_AT_ONCE):
            yield batch.slice(at, rows)
            at, rows, chars = k, 0, 0
        rows, chars = rows + 1, chars + (size or 0)
    if rows:
        yield batch.slice(at, rows)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, kept) of every row: its runs by start and period, and the text with every run cut to one period."""
    split = re.compile(WORD).findall

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                counts, runs, kept = [], [], []
                for text in part.column("text").to_pylist():
                    words = split(text or "")
                    found = runs_of(words, min_length, min_periods)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": size, "period": q} for s, size, q in found])
                    kept.append(collapse(words, found))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(runs, RUNS),
                                                  pa.array(kept, pa.string())], ["doc_id", "n_words", "runs", "kept"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")


def greatest_run(runs: Column) -> Column:
    """The run of the greatest length over period, exactly; ties: the smallest start, then the smallest period."""
    def compare(a: Column, b: Column) -> Column:
        more = b["length"] * a["period"] - a["length"] * b["period"]
        return (F.when(more != 0, F.signum(more.cast("double")).cast("int"))
                .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)))
    return F.get(F.array_sort(runs, compare), F.lit(0))
