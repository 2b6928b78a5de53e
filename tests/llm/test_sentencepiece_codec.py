"""Best paths against brute force and the sentencepiece library; round trips."""

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardwatch.llm import sentencepiece_codec as C

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "Hello world.", " two  spaces ", "a\nb\n\nc", "日本語 ñandú É", "🙂x\x00y\x7f", "▁ x", "x" * 500, "   ", "\n", "tab\there"]


@pytest.fixture(scope="module")
def codec():
    return C.Codec.from_file(PATH)


def ids_of(raw):
    import numpy as np
    return np.frombuffer(raw, "<i4").tolist()


def brute(pieces, text):
    """Ids of the best path over the whole text, longest last piece first among equals."""
    form = C.SPACE + text.replace(" ", C.SPACE) if text else ""
    score = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind == "normal"}
    unknown = min(s for s, _ in score.values()) - 10
    longest = max(map(len, score))
    byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
    best = [(0.0, [])]
    for end in range(1, len(form) + 1):
        top = None
        for start in range(max(0, end - longest), end):
            p = form[start:end]
            if p in score:
                way = (best[start][0] + score[p][0], best[start][1] + [score[p][1]])
            elif end - start == 1:
                way = (best[start][0] + unknown, best[start][1] + [byte[b] for b in p.encode()])
            else:
                continue
            if top is None or way[0] > top[0]:
                top = way
        best.append(top)
    return best[-1][1]


@pytest.fixture(scope="module")
def pieces():
    m = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return [(m.id_to_piece(i), m.get_score(i), "byte" if m.is_byte(i) else "unknown" if m.is_unknown(i) else
             "control" if m.is_control(i) else "normal") for i in range(m.get_piece_size())]


def test_best_path_and_round_trip(codec, pieces):
    for text, raw in zip(TEXTS, codec.encode(TEXTS)):
        assert ids_of(raw) == brute(pieces, text), text
        assert codec.decode(ids_of(raw)) == text.replace(C.SPACE, " ")


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" the\nion.é"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_best_path_of_any_text(codec, pieces, text):
    raw = codec.encode([text])[0]
    assert ids_of(raw) == brute(pieces, text)
    assert codec.decode(ids_of(raw)) == text.replace(C.SPACE, " ")


def test_equals_the_library_on_the_same_pieces(codec, spark):
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1       # best path by score
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    words = sorted({w for t in texts for w in t.split()})[:4000]
    assert [ids_of(x) for x in codec.encode(words)] == library.encode(words)


def test_pieces_over_word_starts_are_not_cut():
    pieces = [("<unk>", 0.0, "unknown"), (C.SPACE, -3.0, "normal"), ("a", -1.0, "normal"), ("b", -1.0, "normal"),
              (f"a{C.SPACE}b", -1.5, "normal")]
    assert [ids_of(x) for x in C.Codec(pieces).encode(["a b", "b a"])] == [[1, 4], [1, 3, 1, 2]]


def test_documents(spark):
    rows = [(1, t, "x") for t in TEXTS] + [(None, None, "y"), (None, "same", "y"), (None, "same", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(1))
    encoded = C.encode_documents(df, PATH)
    assert encoded.count() == len(rows) and encoded.where("ids is null").count() == 0
    want = sorted((t or "").replace(C.SPACE, " ") for _, t, _ in rows)
    assert sorted(r.text for r in C.decode_documents(encoded, PATH).collect()) == want
    assert sorted(r.decoded for r in C.encode_and_decode(df, PATH).collect()) == want
    assert C.encode_and_decode(df.limit(0), PATH).count() == 0


def test_query_on_whole_small_table(spark, codec):
    import hashlib

    from wardwatch.llm.queries import op1_sentencepiece
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op1_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest() and r.n_ids == len(r.ids)
        assert r.ids == ids_of(codec.encode([docs[r.doc_id]])[0])


def test_words_are_searched_once(codec, pieces, monkeypatch):
    searched = []
    monkeypatch.setattr(C.Codec, "_paths", lambda self, words, paths=C.Codec._paths: searched.extend(words) or paths(self, words))
    monkeypatch.setattr(C, "BYTES_AT_ONCE", 30)
    mine = C.Codec(pieces)
    for _ in range(2):
        batch = pa.record_batch({"doc_id": [1, 2, 3, None], "text": ["one two one", None, "two three " * 9, "one"]})
        for _, texts in C._some(batch):
            ends, ids = mine.encode_all(texts)
            assert mine.decode_all(ends, ids) == texts
    assert sorted(searched) == sorted(C.SPACE + w for w in ["", "one", "two", "three"])


def test_batches_hold_bounded_bytes_and_all_rows(monkeypatch):
    monkeypatch.setattr(C, "BYTES_AT_ONCE", 10)
    texts = ["a" * 4, None, "b" * 6, "c" * 25, "", "é" * 5, "d"]
    got = list(C._some(pa.record_batch({"doc_id": pa.array(range(7), pa.int32()), "text": texts})))
    assert [t for _, some in got for t in some] == [t or "" for t in texts]
    assert [k for keys, _ in got for k in keys.to_pylist()] == list(range(7))
    assert all(len(some) == 1 or sum(len(t.encode()) for t in some) <= 10 for _, some in got) and len(got) == 4
    assert list(C._some(pa.record_batch({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}))) == []


@pytest.mark.parametrize("most, longest", [(0, 64), (60, 64), (300, 8), (10 ** 6, 0)])
def test_known_words_are_bounded_and_change_no_ids(codec, pieces, monkeypatch, most, longest):
    monkeypatch.setattr(C, "CACHE_BYTES", most)
    monkeypatch.setattr(C, "LONGEST_KNOWN", longest)
    mine = C.Codec(pieces)
    for start in range(0, len(TEXTS), 2):
        for texts in (TEXTS[start:start + 2], TEXTS[start:start + 3]):
            assert mine.encode(texts) == codec.encode(texts)
            assert mine.words.nbytes + mine.paths.nbytes <= most
            assert all(len(w.encode()) <= longest for w in mine.words.to_pylist())
