"""Quality: held-out accuracy, the prior's estimate, and odd rows."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardwatch.llm import quality as Q
from wardwatch.llm.queries import op5_quality

SF = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n1, n0 = label.sum(), (1 - label).sum()
    return (rank[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)


def test_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op5_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    out = [r for r in rows if r.held_out and r.doc_id in labels]
    y, s = np.array([labels[r.doc_id] for r in out]), np.array([r.score for r in out])
    assert auc(s, y) > 0.98
    assert ((s >= 0.3) == y).mean() > 0.95 and (s[y == 1] >= 0.3).mean() > 0.99


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, Q.score_documents(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_prior_without_bad_labels():
    rng = np.random.default_rng(0)
    good = lambda n: rng.normal(0, 1, (n, 3))
    bad = lambda n: rng.normal(4, 1, (n, 3))
    model = Q.Model(good(4000), np.concatenate((good(2800), bad(1200))))
    assert abs(model.prior - 0.7) < 0.05
    assert (model.scores(good(500)) > 0.5).mean() > 0.95 and (model.scores(bad(500)) < 0.5).mean() > 0.95


def plain_weights(x, y, sizes, prior, steps):
    """The non-negative risk minimised as written down: one 0/1 column a bin, slopes by differences of the loss."""
    def columns(bins):
        out = []
        for row in bins:
            line = []
            for value, size in zip(row, sizes):
                line += [1.0 if k == value else 0.0 for k in range(size)]
            out.append([*line, 1.0])
        return np.array(out)

    pos, unl = columns(x), columns(y)
    loss = lambda f: np.log1p(np.exp(-f))
    first = lambda w: prior * loss(pos @ w).mean()
    second = lambda w: loss(-(unl @ w)).mean() - prior * loss(-(pos @ w)).mean()

    def slope(g, w, h=1e-5):
        return np.array([(g(w + h * e) - g(w - h * e)) / (2 * h) for e in np.eye(len(w))])

    w, m, v, turned = np.zeros(pos.shape[1]), 0, 0, 0
    for t in range(1, steps + 1):
        if second(w) >= 0:
            g = slope(first, w) + slope(second, w)
        else:
            g, turned = -slope(second, w), turned + 1
        g = g + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w, turned


def test_weights_are_those_of_the_risk_restated(monkeypatch):
    rng = np.random.default_rng(7)
    monkeypatch.setattr(Q, "STEPS", 60)
    monkeypatch.setattr(Q, "BINS", 4)
    for share, prior in ((0.6, 0.6), (0.1, 0.9)):       # in the second the risk's part of the bad texts falls below zero
        good = lambda n: rng.normal(0, 1, (n, 2))
        p, u = good(40), np.concatenate((good(int(50 * share)), rng.normal(3, 1, (50 - int(50 * share), 2))))
        model = Q.Model(p, u, prior)
        sizes = [len(e) + 1 for e in model.edges]
        bins = [[[sum(v >= e for e in edges) for v, edges in zip(row, model.edges)] for row in rows] for rows in (p, u)]
        want, turned = plain_weights(*bins, sizes, prior, 60)
        assert np.allclose(model.weights, want, atol=1e-4) and (turned or prior < 0.9)


def test_a_single_text_of_a_kind_has_no_estimate_of_the_prior():
    x = np.arange(12.0).reshape(6, 2)
    for p, u in ((x[:1], x), (x, x[:1]), (x[:1], x[:1])):
        model = Q.Model(p, u)
        assert model.prior == 0.5 and np.isfinite(model.scores(x)).all()


def test_prior_is_the_least_ratio_restated():
    rng = np.random.default_rng(8)
    for _ in range(5):
        p, u = rng.normal(1, 1, 300).round(1), rng.normal(0, 1, 400).round(1)
        slack, best = sum(math.sqrt(math.log(40) / 2 / len(x)) for x in (p, u)), None
        for at in sorted(set(np.quantile(p, k / 100) for k in range(96))):
            a, b = (sum(v >= at for v in x) / len(x) for x in (p, u))
            if best is None or (b + slack) / a < best[0]:
                best = (b + slack) / a, b / a
        assert abs(Q._prior(p, u) - min(1, best[1])) < 1e-9


def test_unknown_texts_are_documents_without_a_label_too(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(Q, "Model", lambda p, u: seen.update(p=p, u=u))
    rows = [(i, "w " * (i % 50)) for i in range(400)] + [(i, "again") for i in range(400)] * 3 + [(None, "none")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40), "x") for i in range(0, 80)] + [(3, 1, "x")], "doc_id long, quality int, text string")
    learnt = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    Q.fit(docs, labels)
    assert len(seen["u"]) == len(learnt) and len(seen["p"]) == sum(i < 40 for i in learnt)
    Q.fit(docs.union(docs), labels, sample=100)         # 3200 rows of 400 ids: one row an id
    assert 0 < len(seen["u"]) < 70 and len(seen["p"]) == sum(i < 40 for i in learnt)


def test_odd_rows(spark):
    rows = [(i, "plain words of some text here " * (1 + i % 4), "x") for i in range(60)] + [(None, None, "x"), (3, "", "x"), (3, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("quality", F.lit("clash"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (5, 1, 0), (5, 1, 0), (999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = Q.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id is None or r.doc_id == 3}) <= 2
    assert Q.keep_good(docs, labels).columns == docs.columns
    none = Q.score_documents(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert Q.score_documents(docs.limit(0), labels).count() == 0 == Q.keep_good(docs.limit(0), labels).count()


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "a", "é" * 100_000, "x " * 100_000])
def test_features_are_finite(text):
    assert np.isfinite(Q.features(text)).all()
