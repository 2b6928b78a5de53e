"""Runs against a search of every period at every place."""

import hashlib
import random
import re
import zlib

from hypothesis import given, settings, strategies as st

from wardwatch.llm import queries
from wardwatch.llm.periodic_runs import collapse, lyndon_groups, periodic_runs, places_of, runs_of

SF = "/root/testdata/sf0.001"


def brute_runs(words, min_length=24, min_periods=3):
    """Every maximal stretch of every period, if no smaller period fits it."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(min_length, min_periods * q) and not any(
                    all(words[t] == words[t + d] for t in range(i, i + size - d)) for d in range(1, q)):
                found.append((i, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 9), st.integers(0, 12), st.sampled_from([(2, 2), (6, 3), (24, 3), (10, 4)]))
def test_runs_are_those_of_brute_force(words, period, times, limits):
    words = words[:15] + (words[:period] * times) + words[15:]
    assert runs_of(words, *limits) == brute_runs(words, *limits)


def test_groups_are_equal_longest_lyndon_words():
    rng = random.Random(5)
    for _ in range(200):
        raw = [rng.randrange(3) for _ in range(rng.randint(1, 30))]
        numbers = {}
        w = [numbers.setdefault(x, len(numbers)) for x in raw]
        for descending in (False, True):
            key = [-x for x in w] if descending else w
            lyndon = lambda s: all(s < s[k:] for k in range(1, len(s)))
            want = [max(k for k in range(1, len(w) - i + 1) if lyndon(key[i:i + k])) for i in range(len(w))]
            lengths, groups = lyndon_groups(w, places_of(w), descending)
            assert lengths == want
            prefixes = [tuple(w[i:i + k]) for i, k in enumerate(want)]
            assert all((groups[i] == groups[j]) == (prefixes[i] == prefixes[j]) for i in range(len(w)) for j in range(len(w)))


def digest(doc_id, text):
    """The row that the query gives for a text, from the words by brute force."""
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words) if n < 3000 else runs_of(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, runs and 1000 * best[1] // best[2] or None, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_on_all_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = queries.op12_periodic_runs(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(digest(r["doc_id"], r["text"]) for r in rows)
    assert sum(r["n_runs"] > 0 for r in got) > 10


def test_odd_rows(spark):
    long = " ".join(f"w{i % 7}" for i in range(200_000)) + " end"
    rows = [(1, None, "x"), (1, "", "x"), (None, "a " * 30, "x"), (2, " \t\n", "y"), (2, "b c " * 13, "y"), (2, "b c " * 13, "y"), (3, long, None),
            (4, "word " * 23, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")      # a column with a clashing name
    got = sorted(map(tuple, periodic_runs(docs).collect()), key=repr)
    run = lambda s, n, p: [(s, n, p)]
    want = [(1, 0, [], ""), (1, 0, [], ""), (2, 0, [], ""), (2, 26, run(0, 26, 2), "b c"), (2, 26, run(0, 26, 2), "b c"),
            (3, 200_001, run(0, 200_000, 7), "w0 w1 w2 w3 w4 w5 w6 end"), (4, 23, [], " ".join(["word"] * 23)), (None, 30, run(0, 30, 1), "a")]
    assert [(i, n, [tuple(r) for r in runs], k) for i, n, runs, k in got] == sorted(want, key=repr)
    assert periodic_runs(docs.limit(0)).collect() == []


def test_planted_tails_of_odd_rows(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rows = [(i, t) for i in ids for t in (None, "", "one", "one two", " ".join(f"v{k}" for k in range(61)))] + [(None, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = f"{queries.new_work_dir(spark, 'tails')}"
    docs.write.parquet(f"{path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, path).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((digest(*r) for r in rows), key=repr)


def test_words_of_two_runs_are_dropped_once():
    words = ["a"] * 30 + ["b"] + ["a"] * 30 + ["b"] + ["a"] * 30
    found = runs_of(words)
    assert found == brute_runs(words) and len(found) > 1
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    assert collapse(words, found) == " ".join(w for i, w in enumerate(words) if i not in dropped)
