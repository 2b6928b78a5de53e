"""Licence scans against a plain restatement."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from wardwatch.llm import license_scan as L
from wardwatch.llm.queries import op4_license_scan


def terms(text):
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def brute(files, templates=L.TEMPLATES, threshold=L.THRESHOLD, all_declare=False):
    """files: (doc_id, path, text) -> sorted (doc_id, path, licence, score, declared_in)."""
    lines = [line for _, _, t in files for line in (t or "").split("\n")]
    having = Counter(t for line in lines for t in set(terms(line)))
    idf = lambda t: math.log((1 + len(lines)) / (1 + having[t])) + 1

    def vector(text):
        v = {t: n * idf(t) for t, n in Counter(terms(text)).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()} if size else {}

    shapes = [(name, vector(x)) for name, x in templates]

    def best(unit):
        v, out = vector(unit), (0.0, 0, None)
        for k, (name, s) in enumerate(shapes):
            c = round(sum(x * s[t] for t, x in v.items() if t in s), 9)
            if c >= threshold and c > out[0]:
                out = (c, -k, name)
        return out

    own, votes = [], {}
    for doc_id, path, text in files:
        text = text or ""
        units = text.split("\n") + re.split(r"\n[ \t\r]*\n", text)
        score, _, name = max((best(u) for u in units), key=lambda x: x[:2])
        folder = None if path is None else path.rpartition("/")[0]
        own.append((doc_id, path, name, score, folder))
        named = path is not None and re.match(L.NAMES.replace("(?i)", ""), path.rpartition("/")[2], re.I)
        if name and path is not None and (named or all_declare):
            votes.setdefault(folder, Counter())[name] += 1
    rule = {d: min(c, key=lambda n: (-c[n], n)) for d, c in votes.items()}
    out = []
    for doc_id, path, name, score, folder in own:
        source = None
        if name is None and folder is not None:
            source = folder
            while source not in rule and source:
                source = source.rpartition("/")[0]
            name = rule.get(source)
            source = source if name else None
        out.append((doc_id, path, name, score, source))
    return sorted(out, key=repr)


APACHE, MIT = L.TEMPLATES[0][1], L.TEMPLATES[1][1]
FILES = [
    (1, "a/LICENSE", "Some words.\n" + APACHE), (2, "a/b/c/x.py", "print"), (3, "a/b/COPYING.txt", MIT.upper()), (4, "a/b/y.py", "code"),
    (5, "a/z.py", None), (6, "q/w.py", ""), (7, "q/own.py", "x y z\n# Licensed under the\n# Apache License, Version 2.0\n\nmore text"),
    (8, "LICENSE", "Dedicated to the public domain under CC0 1.0."), (9, None, "no path"), (None, "a/b/y.py", "code"), (4, "a/b/y.py", "code"),
    (10, "top.py", "licensed under of the"), (11, "r/LICENSE-1", MIT), (12, "r/LICENSE-2", APACHE), (13, "r/s/t", "w " * 50_000),
    (14, "r/u", "w " * 30_000 + "\n" + L.TEMPLATES[2][1] + "\n" + "v " * 9), (15, "é/LICENSE", "É " + MIT), (16, "é/f", "É"), (17, None, MIT),
    (18, "h/first.py", MIT + "\nbody"), (19, "h/other.py", "body"), (20, "//LICENSE", APACHE), (21, "//k", "k"),
]


def test_matches_plain_restatement(spark):
    df = spark.createDataFrame(FILES, "doc_id long, path string, text string").withColumn("dir", F.lit("x")).withColumn("license", F.lit(1))
    for every in (False, True):
        got = sorted(map(tuple, L.scan_licenses(df, all_declare=every).collect()), key=repr)
        assert got == brute(FILES, all_declare=every)


def test_each_notice_is_its_own_best(spark):
    files = [(k, f"d{k}/f", f"some text\n{x}\nmore") for k, (_, x) in enumerate(L.TEMPLATES)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    assert {r.doc_id: r.license for r in L.scan_licenses(df).collect()} == {k: n for k, (n, _) in enumerate(L.TEMPLATES)}


def test_empty(spark):
    assert L.scan_licenses(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def test_query_on_whole_small_table(spark):
    sf = "/root/testdata/sf0.01"
    files = [(r.doc_id, "/".join([r.source, *str(r.doc_id)]), r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, op4_license_scan(spark, sf).collect()), key=repr)
    assert got == brute(files, all_declare=True)
    assert any(r[4] for r in got) and any(r[2] and not r[4] for r in got)


def test_common_words_beside_a_notice_weigh_what_they_weigh(spark):
    common = [f"filler{k}" for k in range(12)]
    files = [(1, "a/f", " ".join(common) + " " + MIT), (2, "b/f", " ".join(f"unseen{k}" for k in range(12)) + " " + MIT)]
    files += [(i, f"c{i}/f", " ".join(common)) for i in range(10, 3010)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    got = {r.doc_id: r for r in L.own_licenses(df).where("doc_id < 10").collect()}
    idf = lambda n: math.log((1 + len(files)) / (1 + n)) + 1
    known = len(terms(MIT)) * idf(2) ** 2
    assert got[1].license == "MIT" and abs(got[1].score - math.sqrt(known / (known + 12 * idf(3001) ** 2))) < 1e-8
    assert [(i, "MIT" if i == 1 else None) for i in (1, 2)] == [r[:1] + r[2:3] for r in brute(files) if r[0] in (1, 2)]
    assert got[2].license is None and got[2].score == 0 and math.sqrt(known / (known + 12 * idf(1) ** 2)) < L.THRESHOLD
