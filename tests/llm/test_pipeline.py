"""The pipeline's rows against brute force, stage by stage, on the smallest tables."""

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from wardwatch.llm import decontaminate as D
from wardwatch.llm import quality as Q

from . import test_secret_scan, test_sentencepiece_codec, test_simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables, and two documents of their own words with secrets."""
    out = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain = docs.where("lang = 'en' and n_chars between 500 and 1200 and text not like '%!!%'").orderBy("doc_id").limit(2).collect()
    more = [(1_000_000 + i, " ".join(reversed(r.text.split())) + f" password={'a1' * 9} AKIA{'Z9' * 8} end", r.lang, r.source, r.n_chars)
            for i, r in enumerate(plain)]
    docs.union(spark.createDataFrame(more, docs.schema)).write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    return out


def brute(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tables = [spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels")]
    scores = {r.doc_id: r.score for r in Q.score_documents(*tables).collect()}
    ids = sorted(d for d in docs if scores[d] >= 0.3)
    groups = test_simhash.brute_components([test_simhash.brute_fingerprint(docs[d]) for d in ids], 4)
    ids = [d for i, d in enumerate(ids) if groups[i] == i]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    block = D.Block([(None, D._words(text.lower())) for text in items])
    out = {}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    pieces = [(model.id_to_piece(i), model.get_score(i), "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i) else
               "control" if model.is_control(i) else "normal") for i in range(model.get_piece_size())]
    for d in ids:
        numbers = block.numbers([docs[d]])[0]
        best = D._smith_waterman([(x, numbers) for x in block.items])[0] if len(numbers) else []
        if any(s >= D.THRESHOLD * 2 * len(x) for s, x in zip(best, block.items)):
            continue
        text, masked, at = docs[d], "", 0
        for a, _, b, _ in test_secret_scan.brute(text):
            if a >= at:
                masked += text[at:a] + "[SECRET]"
            at = max(at, b)
        text = masked + text[at:]
        out[d] = (text, test_sentencepiece_codec.brute(pieces, text) if len(text) < 1500 else None)
    return docs, out


def test_rows(spark, folder):
    docs, want = brute(spark, folder)
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(want) and len(want) < len(docs)
    for r in rows:
        text, ids = want[r.doc_id]
        assert r.text == text and r.n_ids == len(r.ids) and ids in (None, r.ids)
    assert {d for d, (t, _) in want.items() if t != docs[d]} >= {1_000_000, 1_000_001}


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_odd_rows_in_every_stage(spark, k):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "token=abcdefgh " * 3, None, "s", 45),
            (3, "some words " * 40_000, "en", None, 440_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, docs, SF)
    if k < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns
    assert out.count() <= len(rows) and stage(spark, docs.limit(0), SF).count() == 0
