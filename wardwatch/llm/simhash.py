"""SimHash near-duplicates: fingerprints joined by walking a binary trie against itself.

A fingerprint holds 64 majority bits of the XXH64 hashes of a text's word
shingles. Two fingerprints link when they differ in at most ``max_bits`` bits.

The join. The distinct fingerprints form a binary trie; pairs of its nodes are
walked from the root, each pair carrying the bits in which its two prefixes
differ, and a pair is dropped as soon as that exceeds the error budget. Of
``max_bits`` errors, one of three thirds of the bits holds at most a third, so
three tries are walked, each with another third in front and the small budget
there; that keeps the number of pairs near the top of the trie small. The
upper levels are DataFrame joins of pairs of nodes, a few bits a step. Once the
two nodes of a pair hold few fingerprints together, the pair is a task: its
fingerprints meet in one Python call, which walks the rest of the trie with
numpy (a node is an interval of the sorted fingerprints). A node that holds
very many fingerprints is split on until its pairs are small, so no task grows
with the input or with a hot prefix.

A call returns links as a star forest (each linked fingerprint to the smallest
one of its component within the call), never all pairs; the components of all
stars are found by ``connected_components``. Documents with one fingerprint
are one node from the start, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, cut
from .components import connected_components

BITS = 64
STEP = 4                 # bits of one level of the walk on Spark
TASK_FINGERPRINTS = 32_768
SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of the text's ``shingle``-word shingles.

    A-Z are lower-cased; words are runs without ASCII white space; fewer words
    than a shingle: the whole sequence is one; no word or null: 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())]
    n, counts = len(hashes), np.zeros(BITS, np.int64)
    raw = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(n, 8)
    for at in range(0, n, 65_536):          # very long texts: bits of a bounded piece at a time
        counts += np.unpackbits(raw[at:at + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long; one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))],
                                  names=["doc_id", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, fp long"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", task_fingerprints: int = TASK_FINGERPRINTS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    ``fingerprint`` has 16 lowercase hex digits; ``component_id`` is the
    smallest doc_id reachable over links, the own one included. A null or
    empty text has the fingerprint zero and links like any other. A null
    doc_id keeps its row and links, but is never a component_id (null if the
    component has no other). Repeated rows stay. A very long text is hashed a
    bounded piece at a time. No rows give no rows. Other columns are not read.
    """
    fps = cut(fingerprints(docs, shingle, id_col, text_col))
    placed = cut(_rooted(fps, max_bits, task_fingerprints, F.min("doc_id").alias("first_id")))
    tied = placed.where("linked")
    roots = tied.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = (beside(tied, roots, ["root"], "fp").select("fp", "component_id")
             .union(placed.where("not linked").select("fp", "first_id")))
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text",
             task_fingerprints: int = TASK_FINGERPRINTS) -> DataFrame:
    """One row of each component of :func:`near_duplicates`, with all columns: the one of the smallest doc_id.

    A row without an id stays only if its component has no row with one. Of
    rows that share the smallest id, the one whose id and text have the
    smallest MD5 digest stays, once.
    """
    key = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                            F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("binary"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.array(found, np.uint64).view(np.int64))],
                                  names=["key", "doc_id", "fp"])

    fps = cut(keyed.select("key", F.col("row")[id_col].cast("long").alias("doc_id"), F.col("row")[text_col].cast("string").alias("text"))
              .mapInArrow(run, "key string, doc_id long, fp long"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")
    placed = _rooted(fps, max_bits, task_fingerprints, first)
    kept = placed.groupBy("root").agg(F.min("first").alias("first")).select("first.key").distinct()
    return keyed.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def _rooted(fps: DataFrame, max_bits: int, task_fingerprints: int, first: Column) -> DataFrame:
    """The distinct fingerprints with the root of their component, whether they have links, and ``first`` aggregated for each."""
    nodes = fps.groupBy("fp").agg(first)
    linked = connected_components(hamming_links(nodes.select("fp"), max_bits, task_fingerprints))
    return nodes.join(linked, nodes.fp == linked.node, "left").select(
        "fp", nodes.columns[-1], F.coalesce("component", "fp").alias("root"), F.col("component").isNotNull().alias("linked"))


# --- the trie -----------------------------------------------------------------------------

def _thirds() -> list[tuple[int, int]]:
    """(rotation to the left, bits of the leading part) of the three tries."""
    a, b = BITS // 3, BITS // 3
    return [(0, a), (a, b), (a + b, BITS - a - b)]


def _rotated(fp: Column, left: int) -> Column:
    return fp if left == 0 else F.shiftleft(fp, left).bitwiseOR(F.shiftrightunsigned(fp, BITS - left))


def _prefix(depth: int) -> Column:
    """The first ``depth`` bits of column ``key``, as a number."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned("key", BITS - depth)


def hamming_links(fps: DataFrame, max_bits: int, task_fingerprints: int = TASK_FINGERPRINTS) -> DataFrame:
    """(a, b): links between distinct fingerprints at most ``max_bits`` bits apart.

    ``fps`` holds distinct longs in column ``fp``. Not every pair is listed, but
    the listed ones connect whatever the pairs connect.
    """
    thirds = _thirds()
    keys = cut(fps.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("trie"), F.lit(lead).alias("lead"), _rotated(F.col("fp"), left).alias("key"))
        for t, (left, lead) in enumerate(thirds)])).alias("x")).select("x.*"))

    # pairs of nodes at one depth; a <= b
    front = (keys.groupBy("trie", "lead").agg(F.count("*").alias("n_a"))
             .select("trie", "lead", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                     "n_a", F.col("n_a").alias("n_b")))
    tasks = None
    for depth in range(0, BITS + 1, STEP):
        small = F.when(F.col("a") == F.col("b"), F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b")) <= task_fingerprints
        if depth == BITS:
            small = F.lit(True)
        ready = front.where(small).withColumn("task", F.concat_ws(":", F.lit(depth), "trie", "a", "b"))
        sides = (ready.select("trie", "task", F.lit(0).alias("side"), F.col("a").alias("prefix"))
                 .union(ready.where("a <> b").select("trie", "task", F.lit(1).alias("side"), F.col("b").alias("prefix"))))
        dealt = (keys.withColumn("prefix", _prefix(depth)).join(sides, ["trie", "prefix"])
                 .select("task", "trie", F.lit(depth).alias("depth"), "lead", "side", "key"))
        tasks = dealt if tasks is None else tasks.union(dealt)
        front = front.where(~small)
        if depth == BITS or front.isEmpty():
            break
        child = (keys.groupBy("trie", _prefix(depth + STEP).alias("child")).agg(F.count("*").alias("n"))
                 .withColumn("parent", F.shiftrightunsigned("child", STEP)))
        left = child.select("trie", F.col("parent").alias("a"), F.col("child").alias("child_a"), F.col("n").alias("n_a"))
        right = child.select("trie", F.col("parent").alias("b"), F.col("child").alias("child_b"), F.col("n").alias("n_b"))
        apart = F.col("child_a").bitwiseXOR(F.col("child_b"))
        in_lead = F.expr(f"bit_count(shiftrightunsigned(child_a ^ child_b, greatest(0, {depth + STEP} - lead)))")
        front = cut(front.drop("n_a", "n_b").join(left, ["trie", "a"]).join(right, ["trie", "b"])
                    .where((F.col("a") < F.col("b")) | (F.col("child_a") <= F.col("child_b")))
                    .where((F.bit_count(apart) <= max_bits) & (in_lead <= max_bits // len(thirds)))
                    .select("trie", "lead", F.col("child_a").alias("a"), F.col("child_b").alias("b"), "n_a", "n_b"))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        left, lead = thirds[int(pdf["trie"].iloc[0])]
        key, side = pdf["key"].to_numpy().view(np.uint64), pdf["side"].to_numpy()
        order = np.lexsort((key, side))
        key, n = key[order], int((side == 0).sum())
        stars = link_tries(key, n, int(pdf["depth"].iloc[0]), lead, max_bits, max_bits // len(thirds))
        turned = [x if left == 0 else (x >> np.uint64(left)) | (x << np.uint64(BITS - left)) for x in stars]
        return pd.DataFrame({"a": turned[0].view(np.int64), "b": turned[1].view(np.int64)})

    return tasks.groupBy("task").applyInPandas(walk, "a long, b long")


def link_tries(key: np.ndarray, n: int, depth: int, lead: int, max_bits: int, lead_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links among ``key``: of ``key[:n]`` with itself, or with ``key[n:]`` if there are any.

    Both parts are sorted, distinct uint64 and share their first ``depth`` bits
    within a part. A node of the trie is an interval of ``key``.
    """
    total = len(key)
    root = np.arange(total)
    alone = n == total
    if total == 0 or (alone and n < 2):
        return key[:0], key[:0]
    first = np.array([[0, n, 0 if alone else n, total]], np.int64)
    stack = [(depth, first)]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > 200_000:          # bounded memory: the second half waits
            stack.append((depth, pairs[len(pairs) // 2:]))
            pairs = pairs[:len(pairs) // 2]
        single = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        ends = pairs[single]
        ends = ends[np.bitwise_count(key[ends[:, 0]] ^ key[ends[:, 2]]) <= max_bits]
        _unite(root, ends[:, 0], ends[:, 2])
        pairs = _apart(root, pairs[~single])
        if not len(pairs) or depth == BITS:
            continue
        one = np.uint64(1) << np.uint64(BITS - 1 - depth)
        high = ~(one | (one - np.uint64(1)))
        cuts = []
        for lo, hi in ((pairs[:, 0], pairs[:, 1]), (pairs[:, 2], pairs[:, 3])):
            bound = (key[lo] & high) | one
            at = np.where(lo < n, np.searchsorted(key[:n], bound), n + np.searchsorted(key[n:], bound))
            cuts.append((lo, np.clip(at, lo, hi), hi))
        (a0, am, a1), (b0, bm, b1) = cuts
        same = (a0 == b0) & (a1 == b1)
        down = [np.stack(x, axis=1) for x in ((a0, am, b0, bm), (am, a1, bm, b1), (a0, am, bm, b1))]
        down.append(np.stack((am, a1, b0, bm), axis=1)[~same])
        down = np.concatenate(down)
        down = down[(down[:, 0] < down[:, 1]) & (down[:, 2] < down[:, 3])]
        down = down[~((down[:, 0] == down[:, 2]) & (down[:, 1] - down[:, 0] == 1))]     # a leaf with itself
        differ = (key[down[:, 0]] ^ key[down[:, 2]]) >> np.uint64(BITS - 1 - depth)
        keep = np.bitwise_count(differ) <= max_bits
        keep &= np.bitwise_count(differ >> np.uint64(max(0, depth + 1 - lead))) <= lead_bits
        stack.append((depth + 1, down[keep]))
    tied = np.flatnonzero(root != np.arange(total))
    return key[tied], key[root[tied]]


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of a[i] and b[i]; root[i] is the smallest member of i's component."""
    while len(a):
        x, y = root[a], root[b]
        split = x != y
        if not split.any():
            return
        a, b, x, y = a[split], b[split], x[split], y[split]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _apart(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Without the pairs of nodes that lie within one component already."""
    if not len(pairs):
        return pairs
    turn = np.concatenate(([0], np.cumsum(root[1:] != root[:-1])))     # equal turns: one component throughout
    whole = (turn[pairs[:, 0]] == turn[pairs[:, 1] - 1]) & (turn[pairs[:, 2]] == turn[pairs[:, 3] - 1])
    return pairs[~(whole & (root[pairs[:, 0]] == root[pairs[:, 2]]))]
