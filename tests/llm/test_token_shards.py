"""Token shards: ids against the tokenizers library, and exact round trips of the grammar."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardwatch.llm import token_shards as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n b\n", "x\n \ny", "x \ty  z", "it's we'll 'S", "é È ß ñ", "日本 語", "a<|endoftext|> b",
       " <|endoftext|>", "\x00\x1c a \x1f b", "a b   c", " a  b", "12 34,5 !!! ab1", "word. word, (word)", "\x85 x\x85y",
       "ǅ ʔ", "ab" * 3000, "🙂 a🙂", " ­ x", "¼ ² a²"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(PATH)


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_ids_equal_the_library(encoder, tokenizer):
    for _ in range(2):      # the second time from the cache
        for t, got in zip(ODD, encoder.encode(ODD)):
            assert ids_of(got) == tokenizer.encode(t, add_special_tokens=False).ids, t


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sab1,.é <| "), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_equal_the_library_on_any_text(encoder, tokenizer, text):
    assert ids_of(encoder.encode([text])[0]) == tokenizer.encode(text, add_special_tokens=False).ids


def test_grammar_round_trip():
    rng = random.Random(3)
    for ids in ([], [5], [5] * 9, [5] * 1000, [1, 2] * 500 + [1], [rng.choice([1, 2, 3]) for _ in range(5000)], list(range(3000)),
                ([7] * 5 + [8, 9, 7, 7]) * 200):
        x = np.array(ids, np.uint32)
        symbols, rules, sizes = T.compress(x, 10_000)
        assert T.expand(symbols, 10_000, rules).tolist() == ids
        assert sizes.tolist() == [len(T.expand(np.array([10_000 + k], np.uint32), 10_000, rules)) for k in range(len(rules))]
    assert len(T.compress(np.array([1, 2] * 5000, np.uint32), 10)[0]) < 1000


def test_no_pair_is_left(encoder):
    """The grammar is whole: no two symbols stand side by side ``LEAST_COUNT`` times, and it is as small as it should be."""
    import pyarrow.parquet as pq
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    ids = np.frombuffer(b"".join(encoder.encode([t or "" for t in texts])), "<u4")
    symbols, rules, sizes = T.compress(ids, 50_300)
    left = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
    pairs, n = np.unique(left, return_counts=True)
    # of a run of one symbol only every other pair counts
    assert all(c < T.LEAST_COUNT or p >> 32 == p & 0xFFFFFFFF and c < 2 * T.LEAST_COUNT for p, c in zip(pairs.tolist(), n.tolist()))
    assert (len(symbols) + 2 * len(rules)) / len(ids) < 0.55
    assert (T.expand(symbols, 50_300, rules) == ids).all() and int(sizes.max()) > 20


def test_counts_kept_from_round_to_round_are_right():
    rng = random.Random(9)
    for _ in range(60):
        words = [[rng.randrange(12) for _ in range(rng.randint(1, 6))] for _ in range(8)]
        x = np.array([i for _ in range(rng.randint(1, 300)) for i in rng.choice(words)], np.uint32)
        symbols, rules, _ = T.compress(x, 50, least=3)
        assert (T.expand(symbols, 50, rules) == x).all()
        pairs, n = np.unique(symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:], return_counts=True)
        assert all(c < 3 or p >> 32 == p & 0xFFFFFFFF for p, c in zip(pairs.tolist(), n.tolist()))


def test_very_long_texts_and_words(encoder, tokenizer):
    long = "lorem ipsum dolor " * 20_000 + "x" * 5_000 + " " + "日本" * 3_000
    assert ids_of(encoder.encode([long])[0]) == tokenizer.encode(long, add_special_tokens=False).ids
    assert max(map(len, encoder.words)) <= T.LONGEST_KEPT


def shards_of(spark, docs, workdir, **how):
    T.write_shards(docs, workdir, PATH, **how)
    return T.read_shards(spark, workdir)


def test_files_hold_all_documents_in_order(spark, workdir, tokenizer):
    texts = {i: ODD[i % len(ODD)] * (1 + i % 3) for i in range(90)}
    rows = [(i, t, 1) for i, t in texts.items()] + [(None, "null id", 2), (None, None, 2), (7, "again", 2), (7, "again", 2)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").withColumn("at", F.lit(0)).repartition(5)
    shards = shards_of(spark, docs, workdir, shard_ids=300)
    assert shards.count() > 5
    got = T.document_index(shards).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: -1 if x is None else x)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t, _ in rows}
    crc = lambda t: (len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes()))
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((i or -1, *crc(t)) for i, t, _ in rows)
    # random access
    for shard in shards.collect():
        whole = T.read_ids(shard, 0, shard.n_ids).tolist()
        for a, b in ((0, 1), (3, 17), (0, shard.n_ids), (shard.n_ids - 1, shard.n_ids), (2, 2)):
            assert T.read_ids(shard, a, b).tolist() == whole[a:b]


def test_empty_table(spark, workdir):
    assert T.document_index(shards_of(spark, spark.createDataFrame([], "doc_id long, text string"), workdir)).count() == 0
