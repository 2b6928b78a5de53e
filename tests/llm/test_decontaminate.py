"""Decontamination: alignment scores against a plain table, planted copies and edits."""

import random

import numpy as np
from pyspark.sql import functions as F

from wardwatch.llm import decontaminate as D
from wardwatch.llm.queries import op3_decontaminate


def plain_score(x, y):
    h, best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)], 0
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x[i - 1] == y[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_scores():
    rng = random.Random(4)
    pairs = [([rng.randint(1, 6) for _ in range(rng.randint(1, 12))], [rng.randint(0, 6) for _ in range(rng.randint(1, 25))]) for _ in range(80)]
    best, stop = D._smith_waterman([(np.array(x), np.array(y)) for x, y in pairs])
    assert best.tolist() == [plain_score(x, y) for x, y in pairs]
    for (x, y), s, b in zip(pairs, stop, best):
        assert plain_score(x, y[:s]) == b and (s == 0 or plain_score(x, y[:s - 1]) < b)


def corpus():
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(3000)] + ["the", "of", "a"] * 400
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, text(rng.randint(20, 40))) for i in range(12)]
    docs, want = [], set()
    for i in range(150):
        body, kind = text(rng.randint(0, 200)), i % 6
        k = rng.randrange(12)
        words = items[k][1].split()
        if kind == 1:       # exact
            body += " " + " ".join(words) + " " + text(20)
            want.add((i, k))
        elif kind == 2:     # each seventh word replaced, case and punctuation changed
            words[::7] = ["zz"] * len(words[::7])
            body += " " + ", ".join(words).upper() + "."
            want.add((i, k))
        elif kind == 3:     # words dropped and put in
            words = [w for j, w in enumerate(words) if j % 9] + ["end"]
            words.insert(10, "in between")
            body = " ".join(words) + " " + body
            want.add((i, k))
        elif kind == 4:     # a quarter only
            body += " " + " ".join(words[:len(words) // 4])
        docs.append((i, body, "x"))
    return docs, items, want


def test_planted_copies(spark):
    docs, items, want = corpus()
    for at_once in (20_000, 5):
        d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
        b = spark.createDataFrame(items, "item_id long, text string").withColumn("extra", F.lit(1))
        rows = D.contaminations(d, b, items_at_once=at_once).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
        for r in rows:
            x, y = D._words(items[r.item_id][1].lower()), D._words(docs[r.doc_id][1].lower())
            assert r.score == plain_score(x, y) / (2 * len(x)) == plain_score(x, y[r.start_word:r.end_word]) / (2 * len(x))
        left = D.decontaminate(d, b, items_at_once=at_once)
        assert left.columns == d.columns
        assert {r.doc_id for r in left.collect()} == {i for i, *_ in docs} - {i for i, _ in want}


def test_a_passage_in_most_documents_is_still_found(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(i, f"x{i} y{i} {passage} z{i}") for i in range(300)] + [(i, f"x{i} clean") for i in range(300, 330)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert D.contaminations(d, b).select("doc_id").distinct().count() == 300


def test_nulls_short_items_long_texts_and_empty_tables(spark):
    d = spark.createDataFrame([(None, "one two three four five six"), (1, None), (2, ""), (3, "q " * 50_000 + "one two three four five six"),
                               (3, "one two three four five six"), (4, "solo")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "one two three four five six"), (5, None), (6, ""), (7, "solo")], "item_id long, text string")
    key = lambda t: tuple(-1 if x is None else x for x in t)
    got = sorted(((r.doc_id, r.item_id) for r in D.contaminations(d, b).collect()), key=key)
    assert got == sorted([(None, None), (3, None), (3, None), (4, 7)], key=key)
    assert [r.doc_id for r in D.decontaminate(d, b).orderBy("doc_id").collect()] == [1, 2]
    assert D.contaminations(d.limit(0), b).count() == 0 and D.contaminations(d, b.limit(0)).count() == 0
    assert D.decontaminate(d, b.limit(0)).count() == 6


def test_query_finds_exact_copies_and_agrees_with_all_alignments(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in op3_decontaminate(spark, sf).collect()}
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= got
    block = D.Block([(i, D._words(x.lower())) for i, x in items.items()])
    want = set()
    for d, t in docs.items():
        numbers = block.numbers([t])[0]
        if len(numbers):
            best, _ = D._smith_waterman([(x, numbers) for x in block.items])
            want |= {(d, block.item_ids[k]) for k, s in enumerate(best) if s >= D.THRESHOLD * 2 * len(block.items[k])}
    assert got == want


def all_alignments(block, texts, threshold):
    """(text, item, score) by aligning every item with every whole text."""
    out = set()
    for d, t in enumerate(texts):
        numbers = block.numbers([t])[0]
        if len(numbers):
            for k, x in enumerate(block.items):
                s = plain_score(x.tolist(), numbers.tolist()) / (2 * len(x))
                if s >= (threshold if len(x) > 2 else 1.0):
                    out.add((d, k, s))
    return out


def test_no_edit_at_the_threshold_is_missed_in_common_words(monkeypatch):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(25)]
    items = [rng.choices(vocab, k=n) for n in (1, 2, 3, 4, 5, 7, 12, 18, 24, 30)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(0, 60))) for _ in range(40)]
    for x in items[4:]:
        third = ["zz" if j % 3 == 2 else w for j, w in enumerate(x)]
        dropped = [w for j, w in enumerate(x) if j % 3 != 2]
        loose = [y for w in x for y in (w, "zz")]
        texts += [" ".join(["zz"] * 9 + y + ["zz"] * 9) for y in (third, dropped, loose, x[:len(x) // 2 + 1], x[::2])]
    for threshold in (0.5, 0.3, 0.8):
        block = D.Block(list(enumerate(items)), threshold)
        want = all_alignments(block, texts, threshold)
        counted = np.zeros((2, len(block.pairs)), np.int64)
        block.count(texts, counted)
        for total in (counted, -counted, np.random.default_rng(1).integers(0, 99, counted.shape)):     # complete for any order of seeds
            for pairs in (1_000_000, 50):
                monkeypatch.setattr(D, "PAIRS", pairs)
                got = [(d, k, s) for d, k, s, _, _ in D._aligned(block, block.choose_seeds(total), *block.numbers(texts))]
                assert set(got) == want and len(got) == len(want)


def test_edited_copies_are_found_whatever_the_rest_of_the_corpus(spark):
    rng = random.Random(6)
    item = [f"w{i}" for i in range(30)]
    third = " ".join("zz" if j % 3 == 2 else w for j, w in enumerate(item))
    loose = " ".join(f"{w} zz" for w in item)
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for rest in (0, 400):       # the item's words, common
        docs = [(-1, third), (-2, loose)] + [(i, " ".join(rng.choices(item, k=200))) for i in range(rest)]
        d = spark.createDataFrame(docs, "doc_id long, text string")
        assert {r.doc_id for r in D.contaminations(d, b).collect()} >= {-1, -2}
        assert D.decontaminate(d, b).where("doc_id < 0").count() == 0


def test_counts_of_pairs_are_of_all_documents(spark):
    block = D.Block([(1, "a b c".split()), (2, "b b".split())])
    docs = spark.createDataFrame([(i, "a b c x a b b") for i in range(50)] + [(50, None), (51, "")], "doc_id long, text string")
    total = D._counted(docs.repartition(7), spark.sparkContext.broadcast(block), "text")
    name = {v: k for k, v in block.vocabulary.items()}
    got = {(name[p // block.base], name[p % block.base]): t for p, t in zip(block.pairs.tolist(), total.T.tolist())}
    assert got == {("a", "b"): [100, 50], ("b", "c"): [50, 0], ("a", "c"): [0, 50], ("b", "b"): [50, 0]}


def test_common_pairs_are_no_seeds_where_rare_ones_suffice():
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{k}" for k in np.minimum(rng.zipf(1.3, n), 50_000)]
    texts = [" ".join(word(1000)) for _ in range(20)]
    hits = []
    for n in (200, 2000):
        block = D.Block([(k, word(50)) for k in range(n)])
        total = np.zeros((2, len(block.pairs)), np.int64)
        block.count(texts, total)
        numbers, ends = block.numbers(texts)
        own = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        found = lambda t: sum(int((e - f).sum()) for _, f, e, _ in block.choose_seeds(t).find(block, numbers, own))
        hits.append((found(total), found(-total)))
    assert all(rare * 10 < common for rare, common in hits)
