"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

* Own licence. Every line and every paragraph of a whole text is compared with
  every template by the cosine of sparse TF-IDF vectors. A term's weight comes
  from the number of lines that hold it, counted over all texts for all terms.
  The best template at or above the threshold is the file's own licence.
* Declaration. A directory's licence is the one that most of its declaring files
  have (ties: first in name order). A file declares by its name (LICENSE,
  COPYING, NOTICE, ...); if asked, every file with a licence of its own does.
* Inheritance. A file without a licence of its own takes that of the nearest
  directory above it that has one: distinct directories are joined with the
  declared ones on each of their ancestors, the deepest match wins, and the
  files are joined with their directory.

Scale: two narrow passes over the texts; the first sends sums of terms, added up
in each batch, of which the driver sees the templates' terms (a bounded
vocabulary); the second sends one row a file without its text, with those lines
and paragraphs that reach the threshold if other terms weigh the least that a
term can. Distinct ones of these are joined with the sums of their terms. The
joins move paths only; directories are made distinct before their ancestors are
listed, so a directory with a third of all files costs one row there.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

THRESHOLD = 0.6
NAMES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([.-].*)?$"

# fixed values: notices of common licences
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license: redistribution and use in source and binary forms."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
]

# a line or paragraph with terms that no template has: products with the templates, squared weight of their terms, the others
_UNIT = "struct<dots: array<double>, known: double, others: array<struct<term: string, times: int>>>"
_UNITS = pa.list_(pa.struct([("dots", pa.list_(pa.float64())), ("known", pa.float64()),
                             ("others", pa.list_(pa.struct([("term", pa.string()), ("times", pa.int32())])))]))

_terms = re.compile(r"[a-z0-9]+").findall
_paragraph = re.compile(r"\n[ \t\r]*\n").split
_lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _folded(text: str | None) -> str:
    return (text or "").encode().translate(_lower).decode()


class _Matcher:
    """Weighted templates; what a text's lines and paragraphs have in common with them."""

    def __init__(self, templates: list[tuple[str, str]], vocabulary: dict[str, int], lines_with: np.ndarray, lines: int):
        self.names, self.vocabulary = [n for n, _ in templates], vocabulary
        self.idf = np.log((1 + lines) / (1 + lines_with)) + 1
        rows = np.zeros((len(templates), len(vocabulary)))
        for k, (_, text) in enumerate(templates):
            for t in _terms(_folded(text)):
                rows[k, vocabulary[t]] += 1
        rows *= self.idf
        self.rows = rows / np.maximum(np.sqrt((rows ** 2).sum(axis=1, keepdims=True)), 1e-300)

    def judge(self, unit: str, threshold: float) -> tuple[float, int, tuple | None]:
        """(cosine, template, None) of the best template, the first of equals; (0, -1, None) below the threshold.

        With terms that no template has, and a chance to reach the threshold: (0, -1, what their weights decide).
        """
        tf: dict[int, int] = {}
        other: dict[str, int] = {}
        get = self.vocabulary.get
        for t in _terms(unit):
            k = get(t)
            if k is None:
                other[t] = other.get(t, 0) + 1
            else:
                tf[k] = tf.get(k, 0) + 1
        if not tf:
            return 0.0, -1, None
        at = np.fromiter(tf, np.int64, len(tf))
        weight = np.fromiter(tf.values(), float, len(tf)) * self.idf[at]
        known = float(weight @ weight)
        most = known + sum(n * n for n in other.values())      # a term weighs 1 at least, when all lines hold it
        if known < 0.999 * threshold * threshold * most:       # no template can reach the threshold
            return 0.0, -1, None
        dots = self.rows[:, at] @ weight
        cosine = np.round(dots / np.sqrt(most), 9)
        k = int(cosine.argmax())
        if cosine[k] < threshold:
            return 0.0, -1, None
        if not other:
            return float(cosine[k]), k, None
        return 0.0, -1, (tuple(dots.tolist()), known, tuple(sorted(other.items())))

    def scan(self, text: str | None, threshold: float) -> tuple[float, int, list[tuple]]:
        """(cosine, template) of the best line or paragraph without other terms, of equals the first template; those with other terms."""
        folded = _folded(text)
        lines = folded.split("\n")
        units = lines + _paragraph(folded) if len(lines) > 1 else lines
        judged = [self.judge(u, threshold) for u in units]
        score, k = max((x[:2] for x in judged), key=lambda x: (x[0], -x[1]))
        return score, k, sorted({x[2] for x in judged if x[2] is not None})


def own_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, path, license, score), one row per row of ``files`` (doc_id, path, text)."""
    vocabulary: dict[str, int] = {}
    for _, text in templates:
        for t in _terms(_folded(text)):
            vocabulary.setdefault(t, len(vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter = Counter()
            for text in batch.column(0):
                lines = _folded(text.as_py()).split("\n")
                n[""] += len(lines)
                for line in lines:
                    n.update(set(_terms(line)))
            yield pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    text = F.col("text").cast("string").alias("text")
    lines_with = cut(files.select(text).mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")))
    counts, lines = np.zeros(len(vocabulary), np.int64), 0
    for term, n in lines_with.where(F.col("term").isin("", *vocabulary)).collect():
        if term:
            counts[vocabulary[term]] = n
        else:
            lines = n
    matcher = _Matcher(templates, vocabulary, counts, lines)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [matcher.scan(t.as_py(), threshold) for t in batch.column(2)]
            scores, ks, units = zip(*found) if found else ((),) * 3
            units = [[{"dots": d, "known": n, "others": [{"term": t, "times": m} for t, m in o]} for d, n, o in some] for some in units]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ks, pa.int32()), pa.array(scores, pa.float64()),
                                   pa.array(units, _UNITS)], names=["doc_id", "path", "k", "score", "units"])

    scanned = cut(files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"), text)
                  .mapInArrow(scan, f"doc_id long, path string, k int, score double, units array<{_UNIT}>")
                  .withColumn("row", F.monotonically_increasing_id()))
    unit = F.explode("units").alias("unit")
    idf = F.log((1 + F.lit(lines)) / (1 + F.col("n"))) + 1
    weighed = (scanned.select(unit).distinct().select("unit", F.explode("unit.others").alias("other"))
               .select("unit", F.col("other.term").alias("term"), F.col("other.times").alias("times")).join(lines_with, "term")
               .groupBy("unit").agg(F.sum(F.pow(F.col("times") * idf, F.lit(2.0))).alias("others")))
    cosines = F.transform("unit.dots", lambda d: F.round(d / F.sqrt(F.col("unit.known") + F.col("others")), 9))
    judged = (weighed.select("unit", cosines.alias("cosines")).select("unit", "cosines", F.array_max("cosines").alias("score"))
              .where(F.col("score") >= threshold)
              .select("unit", F.struct("score", (1 - F.array_position("cosines", F.col("score"))).cast("int").alias("k")).alias("best")))
    best = scanned.select("row", unit).join(judged, "unit").groupBy("row").agg(F.max("best").alias("best"))
    own = F.struct("score", (-F.col("k")).alias("k"))
    names = F.array(*(F.lit(n) for n in matcher.names))
    return (scanned.join(best, "row", "left").withColumn("own", F.greatest(own, "best"))
            .select("doc_id", "path", F.when(F.col("own.score") > 0, F.get(names, -F.col("own.k"))).alias("license"), "own.score"))


def _directory(path: Column) -> Column:
    """The path without its last part; '' at the top."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                  all_declare: bool = False) -> DataFrame:
    """(doc_id, path, license, score, declared_in), one row per row of ``files`` (doc_id, path, text).

    ``declared_in``: null for a file's own licence, else the directory that it
    is inherited from; ``score`` is 0 for inherited and unknown licences.
    ``license`` is null if neither the file nor a directory above it has one. A
    null or empty text has no licence of its own; a file without a path inherits
    none and declares none. Of equal cosines the first template counts. Null and
    repeated ids, paths and rows keep their rows; other columns are not read.
    """
    # one row a file without its text, kept: three joins read it
    own = cut(own_licenses(files, templates, threshold).withColumn("dir", _directory(F.col("path"))))
    declares = F.rlike(F.regexp_extract("path", r"([^/]*)$", 1), F.lit(NAMES))
    if all_declare:
        declares = F.col("path").isNotNull()
    votes = own.where(F.col("license").isNotNull() & declares).groupBy("dir", "license").agg(F.count("*").alias("n"))
    first = Window.partitionBy("dir").orderBy(F.desc("n"), "license")
    declared = (votes.withColumn("place", F.row_number().over(first)).where("place = 1")
                .select(F.col("dir").alias("declared_in"), F.col("license").alias("inherited")))

    # each directory with all directories above it and itself
    parts = F.split("dir", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    dirs = own.where("license is null and dir is not null").select("dir").distinct()
    chain = dirs.select("dir", F.explode(F.array_distinct(above)).alias("declared_in"))
    nearest = (chain.join(declared, "declared_in")
               .groupBy("dir").agg(F.max_by(F.struct("declared_in", "inherited"), F.length("declared_in")).alias("found")))
    out = own.join(nearest, "dir", "left")
    inherits = F.col("license").isNull()
    return out.select("doc_id", "path", F.coalesce("license", "found.inherited").alias("license"), "score",
                      F.when(inherits, F.col("found.declared_in")).alias("declared_in"))
