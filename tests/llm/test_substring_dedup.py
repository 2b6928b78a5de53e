"""Substring dedup against brute force over all windows."""

import random

import numpy as np
from pyspark.sql import functions as F

from wardwatch.llm import substring_dedup as S
from wardwatch.llm.queries import op9_substring_dedup


def brute(rows, window=13):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, kept)."""
    top = float("inf")
    first, split = {}, []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        doc = top if doc_id is None else doc_id
        split.append((doc_id, doc, words))
        for i in range(len(words) - window + 1):
            gram = tuple(words[i:i + window])
            first[gram] = min(first.get(gram, top), doc)
    out = []
    for doc_id, doc, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < doc:
                gone[i:i + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((doc_id if doc_id is not None else -1, len(words), sum(gone), b" ".join(kept).decode()))
    return sorted(out)


def found(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_rolling_hash_and_minimum():
    x = np.random.default_rng(1).integers(0, 1 << 63, 60, dtype=np.uint64)
    for width in (1, 5, 8, 13):
        got = S._rolled(x, width, 0x9E3779B97F4A7C15)
        want = [sum(int(v) * pow(0x9E3779B97F4A7C15, width - 1 - k, 1 << 64) for k, v in enumerate(x[i:i + width])) % (1 << 64)
                for i in range(60 - width + 1)]
        assert got.tolist() == want
    assert S._sliding_min(x, 9).tolist() == [min(x[i:i + 9].tolist()) for i in range(52)]


def passages(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["É", "x y"]
    shared = [" ".join(rng.choices(vocab, k=rng.randint(8, 40))) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choices(vocab, k=rng.randint(0, 30))), rng.choice(shared), " ".join(rng.choices(vocab, k=rng.randint(0, 9)))]
        rows.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n", "\t "]).join(parts)))
    whole = "a b c d e f g h i j k l m n"
    return rows + [(500, whole), (400, whole), (400, whole + " " + whole), (None, whole), (901, ""), (902, None), (903, "one"),
                   (3, "r " * 300), (2, "r " * 13), (904, "r " * 12)]


def test_matches_brute_force(spark):
    for seed, cell, bucket in ((1, 700, 900), (2, 4_000_000, 8_000_000)):
        rows = passages(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cell", F.lit("x")).repartition(3)
        assert found(S.dedup_substrings(df, cell_bytes=cell, bucket_bytes=bucket)) == brute(rows)


def test_empty(spark):
    assert S.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_on_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    import hashlib
    want = sorted((d, n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in brute([tuple(r) for r in docs.collect()]))
    assert sorted(map(tuple, op9_substring_dedup(spark, "/root/testdata/sf0.001").collect())) == want
