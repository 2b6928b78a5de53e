"""Embedding near-duplicates against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardwatch.llm import embedding_dedup as E
from wardwatch.llm.queries import op8_embedding_dedup


def brute(rows, threshold=0.98):
    """rows: (vec_id, vector, label) -> (links, component ids) by row."""
    ok = [v is not None and lab is not None and None not in v and all(map(math.isfinite, v)) and any(v) for _, v, lab in rows]
    # scaled first, so that no norm leaves the range of a double
    scaled = [np.array(v, float) / np.abs(np.array(v, float)).max() if o else None for (_, v, _), o in zip(rows, ok)]
    unit = [v if v is None else v / np.linalg.norm(v) for v in scaled]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = 0
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                pairs += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            ids[find(i)] = min(ids.get(find(i), vec_id), vec_id)
    return links, [ids.get(find(i)) for i in range(len(rows))]


def cases():
    rng = np.random.default_rng(2)
    rows = []
    for g in range(40):
        base = rng.normal(size=16)
        for k in range(rng.integers(1, 12)):
            v = base + rng.normal(size=16) * 0.1 * rng.random()
            rows.append((len(rows), [float(a) for a in v], int(g % 3)))
    copy = rows[5][1]
    rows += [(900, copy, rows[5][2]), (901, copy, rows[5][2]), (901, copy, rows[5][2]), (902, copy, None), (903, copy, 77),
             (904, None, 1), (905, [0.0] * 16, 1), (906, [1.0] * 15 + [None], 1), (907, [float("nan")] * 16, 1),
             (908, [float("inf")] * 16, 1), (None, copy, rows[5][2]), (None, [5.0] + [0.0] * 15, 9), (909, [], 1),
             (910, [1.0, 2.0], 1), (911, [2.0, 4.0], 1), (912, [1e-170] * 16, 5), (913, [2e-170] * 16, 5)]
    return rows


@pytest.mark.parametrize("block", [8, 2048])
def test_matches_all_pairs(spark, block):
    rows = cases()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("row", F.lit("x"))
    got = E.near_duplicates(df, block=block).collect()
    links, comps = brute(rows)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = sorted(((r[0], n, c, r[0] == c) for r, n, c in zip(rows, links, comps)), key=key)
    assert sorted(map(tuple, got), key=key) == want


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_duplicates(none).count() == 0


def test_recall_on_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links, comps = brute(rows)
    got = {r.vec_id: r for r in op8_embedding_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert all(got[r[0]].n_links <= n for r, n in zip(rows, links))
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(links)
    assert sum(got[r[0]].component_id == c for r, c in zip(rows, comps)) >= 0.99 * len(rows)


@pytest.mark.parametrize("dim,effective", [(768, 8), (256, 16)])
def test_nothing_is_lost_in_vectors_of_few_effective_dimensions(spark, dim, effective):
    rng = np.random.default_rng(11)
    axes = np.linalg.qr(rng.normal(size=(dim, effective)))[0]
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(rng.normal(size=(1500, effective)))
    away = rng.normal(size=a.shape)
    away = unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    b = 0.982 * a + np.sqrt(1 - 0.982 ** 2) * away
    x = np.concatenate((a, b)) @ axes.T
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    near = unit(x) @ unit(x).T >= 0.98
    got = {r.vec_id: r.n_links for r in E.near_duplicates(df).collect()}
    assert near.sum() > 4500 and [got[i] for i in range(len(x))] == (near.sum(axis=1) - 1).tolist()


def test_very_large_and_small_entries_link(spark):
    """Vectors whose norm is beyond a double's range are finite and not zero: they link as any other."""
    rows = [(0, 1, [1e200, 1e200]), (1, 1, [1e200, 1e200]), (2, 1, [1e-200, 1e-200]), (3, 1, [1e-200, -1e-200]), (4, 1, [0.0, 0.0]),
            (5, 1, [1.0, None]), (6, 1, [])]
    got = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {
        0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6)}
