"""Embedding near-duplicates with an inverted-list product-quantisation index.

Vectors of one label link when the cosine of the two is at least a threshold.

* Index. A coarse quantiser (k-means centroids) gives every vector a list; its
  residual is cut into subspaces, each coded by its nearest codeword. Centroids
  and codewords are fitted on a sample of at most about ``SAMPLE`` vectors;
  every vector is indexed. With each code goes the length of its coding error.
* Search. Two neighbours in different cells lie on either side of the bisecting
  plane, and their distances from it add up to at most their own; so one of the
  two lies within half the threshold's length of it. Every vector queries the
  lists whose planes with its own cell are that near: each pair of neighbours is
  met in at least one list, whatever the directions of the differences. If both
  would ask, the smaller entry does. Within a list, distances are sums of table
  entries (asymmetric: the query is not coded). By the triangle inequality a
  neighbour lies no further from the query's point than the threshold's length
  plus its coding error; all such are reranked by exact cosine in double
  precision. Nothing else is cut off.
* Result. Each task returns link counts and a star forest of its links, never
  pairs. Components come from ``connected_components``.

Scale. Equal vectors of a label are one entry with a count. A list with many
entries, and the queries of a list, are split into blocks of bounded size; a
task is one block against one block, whatever the label or list. The driver
holds the sample and the model (at most ``MAX_LISTS`` centroids).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, cut, drawn
from .components import connected_components

SAMPLE = 16_384
MAX_LISTS = 1_024
SUBSPACES = 8
CODEWORDS = 64
SLACK = 1e-6                # of a distance, for rounding
BLOCK = 512                 # entries or queries of a block


class Index:
    """Coarse centroids and codewords; distances between unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float):
        rng = np.random.default_rng(7)
        self.radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        self.margin = self.radius / 2 + SLACK
        self.centroids = _kmeans(sample, lists, rng)
        rest = sample - self.centroids[_nearest(sample, self.centroids)]
        parts = min(SUBSPACES, sample.shape[1])
        self.edges = np.linspace(0, sample.shape[1], parts + 1).astype(int)
        self.words = [_kmeans(rest[:, a:b], CODEWORDS, rng) for a, b in zip(self.edges, self.edges[1:])]
        gap = np.sqrt(_squares(self.centroids, self.centroids))
        self.gap = np.where(gap > 0, gap, np.inf)

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of the coding error) of unit vectors."""
        home = _nearest(x, self.centroids)
        rest = x - self.centroids[home]
        codes = np.stack([_nearest(rest[:, a:b], w) for (a, b), w in zip(self._spans(), self.words)], axis=1).astype(np.uint8)
        shown = np.concatenate([w[codes[:, m]] for m, w in enumerate(self.words)], axis=1)
        return home, codes, np.sqrt(((rest - shown) ** 2).sum(axis=1))

    def probes(self, x: np.ndarray, home: np.ndarray) -> list[list[int]]:
        """Lists whose bisecting plane with its own cell lies within the margin of each vector, its own among them."""
        d, rows = _squares(x, self.centroids), np.arange(len(x))
        near = (d - d[rows, home][:, None]) / (2 * self.gap[home]) <= self.margin
        near[rows, home] = True
        return [np.flatnonzero(row).tolist() for row in near]

    def tables(self, x: np.ndarray, at: int) -> list[np.ndarray]:
        """Squared distance of each query's residual to list ``at`` from each codeword, a table a subspace."""
        rest = x - self.centroids[at]
        return [_squares(rest[:, a:b], w) for (a, b), w in zip(self._spans(), self.words)]

    def _spans(self):
        return zip(self.edges, self.edges[1:])


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * x @ y.T)


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[i:i + 8192], centers).argmin(axis=1) for i in range(0, len(x), 8192)] or [np.zeros(0, int)])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        home = _nearest(x, centers)
        count = np.bincount(home, minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, home, x)
        centers = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centers)
    return centers


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Only rows of equal, non-null labels (and equal dimension) are compared. A
    null or zero vector, or one with a null, NaN or infinite component, links
    with nothing. ``n_links``: other rows linked directly; rows repeated as a
    whole are rows of their own. ``component_id``: smallest vec_id reachable, the
    own included; ``kept``: vec_id = component_id. A null vec_id keeps its row and
    links but names no component; its ``kept`` is false unless the row has no
    other id to fall back on (then component_id is null and kept is true).
    No rows give no rows. Other columns are not read.
    """
    x = F.col("vec")
    dtype = "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    rows = cut(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                              F.col(vec_col).cast("array<double>").alias("vec"))
               .withColumn("row", F.monotonically_increasing_id())
               # by the entries, not by a norm, which very large or small ones would take out of the range of a double
               .withColumn("fit", F.coalesce(F.col("label").isNotNull() & F.exists(x, lambda v: v != 0) & F.forall(
                   x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))))
    # one entry for each distinct vector of a label
    same = F.struct("label", "vec")
    entries = cut(rows.where("fit").groupBy("label", "vec").agg(
        F.min("row").alias("entry"), F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
        .withColumn("dim", F.size("vec")))
    counts = stars = None
    for dim, n in sorted(tuple(r) for r in entries.groupBy("dim").count().collect()):
        found = cut(_links(entries.where(F.col("dim") == dim), dim, n, threshold, block, dtype))
        some = found.where("star < 0").groupBy("entry").agg(F.sum("n").alias("n"))
        more = found.where("star >= 0").select("entry", "star")
        counts, stars = (some, more) if counts is None else (counts.union(some), stars.union(more))
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    linked = connected_components(stars, "entry", "star").withColumnRenamed("node", "entry")
    # ids only: the vectors meet the result once
    placed = cut(entries.select("entry", "first_id", "copies").join(counts, "entry", "left").join(linked, "entry", "left")
                 .select("entry", "first_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("component").alias("root")))
    tied = placed.where("root is not null")
    roots = tied.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = (beside(tied, roots, ["root"], "entry").select("entry", "n_links", "component_id")
            .union(placed.where("root is null").select("entry", "n_links", "first_id")))
    named = entries.select("entry", same.alias("same")).join(told, "entry").drop("entry")
    out = rows.withColumn("same", F.when(F.col("fit"), same)).join(named, "same", "left")
    mine = F.when(F.col("fit"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), mine.alias("component_id"),
                      F.col("vec_id").eqNullSafe(mine).alias("kept"))


def _links(entries: DataFrame, dim: int, n: int, threshold: float, block: int, dtype: str) -> DataFrame:
    """(entry, star, n): link counts (star -1), and links as stars (n 0), of one dimension's entries.

    Vectors travel as they came, as ``dtype``; all arithmetic is in double precision.
    """
    share = min(1.0, SAMPLE / n)
    sample = _unit(np.array([r[0] for r in entries.where(drawn("entry", share)).select("vec").collect()] or [np.ones(dim)], float).reshape(-1, dim))
    index = Index(sample, int(np.clip(np.sqrt(n) / 4, 1, MAX_LISTS)), threshold)

    def place(batches):
        for batch in batches:
            raw = _matrix(batch.column("vec"), dim)
            x = _unit(raw)
            home, codes, error = index.code(x)
            yield pa.record_batch(
                [batch.column("label"), batch.column("entry"), batch.column("copies"), pa.array(home.astype(np.int32)),
                 pa.array(index.probes(x, home), pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(error), pa.array([v.tobytes() for v in raw.astype(dtype)], pa.binary())],
                names=["label", "entry", "copies", "home", "probes", "code", "error", "raw"])

    kind = entries.schema["label"].dataType.simpleString()
    placed = cut(entries.select("label", "entry", "copies", "vec").mapInArrow(
        place, f"label {kind}, entry long, copies long, home int, probes array<int>, code binary, error double, raw binary"))

    # blocks of a list, and of the queries that probe it
    def split(total):
        return F.ceil(F.col(total) / F.lit(block)).cast("int")

    queries = placed.select("label", "entry", "copies", "raw", "home", F.explode("probes").alias("list"))
    members = placed.groupBy("label", F.col("home").alias("list")).agg(F.count("*").alias("members"))
    asking = queries.groupBy("label", "list").agg(F.count("*").alias("askers"))
    shape = members.join(asking, ["label", "list"]).select("label", "list", split("members").alias("blocks"), split("askers").alias("rounds"))
    part = lambda n: F.pmod(F.xxhash64("entry"), F.col(n)).cast("int")
    left = (placed.withColumnRenamed("home", "list").join(shape, ["label", "list"])
            .select("label", "list", part("blocks").alias("b"), F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("q"),
                    "entry", "copies", "raw", "code", "error", "probes"))
    right = (queries.join(shape, ["label", "list"])
             .select("label", "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), part("rounds").alias("q"),
                     "entry", "copies", "raw", "home"))
    right = right.toDF(*right.columns)      # columns of its own: both sides come from one table

    def search(key: tuple, items: pa.Table, asked: pa.Table) -> pa.Table:
        x, y = _units(items, dim, dtype), _units(asked, dim, dtype)
        found = _search(index, key[1].as_py(), y, _longs(asked, "entry"), _longs(asked, "home"), x, _longs(items, "entry"),
                        _marked(items.column("probes"), len(index.centroids)),
                        np.frombuffer(b"".join(items.column("code").to_pylist()), np.uint8).reshape(len(x), -1) if len(x) else None,
                        items.column("error").to_numpy(), threshold) if len(x) and len(y) else (np.zeros(0, int),) * 2
        return _summed(*found, _longs(asked, "entry"), _longs(asked, "copies"), _longs(items, "entry"), _longs(items, "copies"))

    keys = ["label", "list", "b", "q"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "entry long, star long, n long")


def _search(index: Index, at: int, y: np.ndarray, y_entry: np.ndarray, y_home: np.ndarray, x: np.ndarray, x_entry: np.ndarray,
            x_probes: np.ndarray, codes: np.ndarray, error: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked (query, item) positions; of two entries that probe each other's lists the smaller one asks."""
    reach = (index.radius + error + 1e-9) ** 2
    asks, hits = [], []
    for lo in range(0, len(y), 128):
        tables = index.tables(y[lo:lo + 128], at)
        d = sum(t[:, codes[:, m]] for m, t in enumerate(tables))
        mine = (y_entry[lo:lo + 128, None] < x_entry) | ~x_probes[:, y_home[lo:lo + 128]].T
        q, i = np.nonzero((d <= reach) & mine)
        for a in range(0, len(q), 65_536):
            qa, ia = q[a:a + 65_536] + lo, i[a:a + 65_536]
            close = np.einsum("ij,ij->i", y[qa], x[ia]) >= threshold
            asks.append(qa[close])
            hits.append(ia[close])
    return (np.concatenate(asks), np.concatenate(hits)) if asks else (np.zeros(0, int), np.zeros(0, int))


def _summed(q: np.ndarray, i: np.ndarray, y_entry, y_copies, x_entry, x_copies) -> pa.Table:
    """Counts of both sides of the links, and the links as a star forest."""
    out = {"entry": [], "star": [], "n": []}
    for at, other, entry, copies in ((q, i, y_entry, x_copies), (i, q, x_entry, y_copies)):
        n = np.bincount(at, weights=copies[other], minlength=len(entry)).astype(np.int64) if len(at) else np.zeros(len(entry), np.int64)
        some = np.flatnonzero(n)
        out["entry"].append(entry[some])
        out["star"].append(np.full(len(some), -1))
        out["n"].append(n[some])
    ids, ends = np.unique(np.concatenate((y_entry[q], x_entry[i])), return_inverse=True)
    root, a, b = np.arange(len(ids)), ends[:len(q)], ends[len(q):]
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(before, root):
            break
    tied = np.flatnonzero(root != np.arange(len(ids)))
    out["entry"].append(ids[tied])
    out["star"].append(ids[root[tied]])
    out["n"].append(np.zeros(len(tied), np.int64))
    return pa.table({k: pa.array(np.concatenate(v).astype(np.int64)) for k, v in out.items()})


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0.0)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, dim)


def _units(rows: pa.Table, dim: int, dtype: str) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(rows.column("raw").to_pylist()), dtype).astype(float).reshape(-1, dim))


def _marked(lists: pa.ChunkedArray, n: int) -> np.ndarray:
    """By row and list, whether the row has the list."""
    out = np.zeros((len(lists), n), bool)
    for row, some in zip(out, lists.to_pylist()):
        row[some] = True
    return out


def _longs(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()
