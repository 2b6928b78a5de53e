"""Shards of made rows: nothing lost, the law of the key, gapless slots, real shuffles."""

import zlib
from collections import defaultdict

from wardwatch.llm import queries
from wardwatch.llm.shuffle_shards import read_shards, write_shards
from wardwatch.session import new_work_dir

SF = "/root/testdata/sf0.001"


def shards(spark, docs, **kw):
    path = new_work_dir(spark, "shards-test")
    write_shards(docs, path, **kw)
    return read_shards(spark, path, docs).collect()


def check_law(rows, n, key=lambda r: r["doc"]["doc_id"]):
    slots, homes = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        homes[key(r)].add((r["shard"], r["grown_shard"]))
        assert 0 <= r["shard"] < n and r["grown_shard"] in (r["shard"], n)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())


def test_query_on_all_documents(spark):
    want = sorted((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
                  for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    found = queries.op13_sharding(spark, SF)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = found.collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"key"} and len({r["shard"] for r in got}) == 16
    assert 0 < sum(r["grown_shard"] == 16 for r in got) < len(got) / 5
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id % 50) AS text")
    few = {r["doc"]["doc_id"]: r for r in shards(spark, docs, shards=5)}
    more = {r["doc"]["doc_id"]: r for r in shards(spark, docs, shards=6)}
    assert all(few[i]["grown_shard"] == more[i]["shard"] for i in few)
    assert 350 < sum(r["shard"] == 5 for r in more.values()) < 650
    check_law(few.values(), 5)


def test_small_buckets_hot_id_and_records_come_back_whole(spark):
    """A third of all rows has one id: its shard has many buckets, none of them much above the bound."""
    docs = spark.range(6000).selectExpr("IF(id % 3 = 0, NULL, id) AS doc_id", "repeat('x', 99) AS text", "id AS shard", "map('k', id) AS slot")
    path = new_work_dir(spark, "shards-test")
    write_shards(docs, path, shards=4, bucket_bytes=10_000)
    rows = read_shards(spark, path, docs).collect()
    check_law(rows, 4)
    assert sorted(r["doc"]["shard"] for r in rows) == list(range(6000)) and all(r["doc"]["slot"] == {"k": r["doc"]["shard"]} for r in rows)
    sizes = [r["bytes"] for r in spark.read.parquet(f"{path}/index").collect()]
    assert len(sizes) >= 60 and max(sizes) < 16_000
    # shuffled: neighbours in a shard are not neighbours in the input
    order = [r["doc"]["shard"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(abs(a - b) < 20 for a, b in zip(order, order[1:])) < 300


def test_same_seed_same_shuffle_other_seed_other(spark):
    path = new_work_dir(spark, "shards-in")
    spark.range(500).selectExpr("id AS doc_id", "string(id) AS text").write.parquet(path)
    docs = spark.read.parquet(path)
    order = lambda seed: [r["doc"]["doc_id"] for r in sorted(shards(spark, docs, shards=2, seed=seed), key=lambda r: (r["shard"], r["slot"]))]
    assert order(1) == order(1) != order(2)


def test_odd_rows(spark):
    rows = [(None, None), (None, ""), (1, "é" * 300_000), (1, "a"), (1, "a"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = shards(spark, docs, bucket_bytes=1000)
    check_law(got, 16)
    assert sorted(((r["doc"]["doc_id"], r["doc"]["text"]) for r in got), key=repr) == sorted(rows, key=repr)
    assert {(r["size"], r["text_crc32"]) for r in got if not r["doc"]["text"]} == {(1, 0)}
    assert max(r["size"] for r in got) == 600_001
    assert shards(spark, docs.limit(0)) == []


def test_plan_has_no_python(spark):
    plan = queries.op13_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
