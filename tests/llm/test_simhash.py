"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from wardwatch.llm import simhash


def brute_fingerprint(text):
    import re
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    ids = list(range(len(fps)))

    def find(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                ids[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_brute_force():
    texts = [None, "", " \t\n", "One", "one TWO", "a b c d", "a b c d e f g a b c d", "É x\x0by\x0cz q w e r", "xx " * 900]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def noisy(rng, n, groups, bits):
    out = []
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(n):
            x = base
            for b in rng.sample(range(64), rng.randint(0, bits)):
                x ^= 1 << b
            out.append(x)
    return out


def test_trie_walk_in_one_call():
    rng = random.Random(5)
    fps = sorted(set(noisy(rng, 12, 20, 6) + [rng.getrandbits(64) for _ in range(200)] + [0, 1, (1 << 64) - 1]))
    key = np.array(fps, np.uint64)
    a, b = simhash.link_tries(key, len(key), 0, 64, 4, 4)
    root = dict(zip(a.tolist(), b.tolist()))
    want = brute_components(fps, 4)
    assert [root.get(f, f) for f in fps] == [fps[w] for w in want]


def test_components_with_small_tasks(spark):
    rng = random.Random(6)
    fps = sorted(set(noisy(rng, 15, 12, 5) + [rng.getrandbits(64) for _ in range(150)]))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for most in (8, 10_000):
        found = simhash.connected_components(simhash.hamming_links(df, 4, most)).collect()
        comp = {r.node: r.component for r in found}
        groups, brute = {}, {}
        for i, (s, w) in enumerate(zip(signed, brute_components(fps, 4))):
            groups.setdefault(comp.get(s, s), set()).add(i)
            brute.setdefault(w, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_rows_nulls_copies_and_extra_columns(spark):
    rows = [(5, "a b c d e", 1), (2, "a b c d e", 2), (5, "a b c d e", 1), (None, "A B C D E", 3), (7, None, 4),
            (9, "", 5), (None, "zz yy xx ww vv", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("fingerprint", F.lit("x"))
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id if r.component_id is not None else -1)
                 for r in simhash.near_duplicates(df).collect())
    f, z = f"{brute_fingerprint('a b c d e'):016x}", f"{brute_fingerprint('zz yy xx ww vv'):016x}"
    assert got == sorted([(5, f, 2), (2, f, 2), (5, f, 2), (-1, f, 2), (7, "0" * 16, 7), (9, "0" * 16, 7), (-1, z, -1)])
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    rows = [(5, "a b c d e", 1), (2, "a b c d e", 2), (2, "a b c d e", 2), (None, "A B C D E", 3), (7, None, 4), (9, "", 5),
            (None, "zz yy xx ww vv", 6), (None, "zz yy xx ww vv", 6), (2, "other words stand here now", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("key", F.lit("x"))
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or -1, r.fp) for r in out.collect()) == [(-1, 6), (2, 2), (2, 7), (7, 4)]
    assert simhash.keep_one(df.limit(0)).count() == 0
