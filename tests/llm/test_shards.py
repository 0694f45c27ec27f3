"""Sharding: sizes, numbering, the stored map and its edits."""

import random
import zlib
from collections import defaultdict

from bidtrail.llm import shards


def some_docs(spark, n=3000):
    rng = random.Random(2)
    rows = [(i, "é" * rng.choice([0, 1, 5, 200, 900])) for i in range(n)]
    rows += [(5000, None), (5001, "copy"), (5001, "copy")] + [(None, f"no id {i % 3}") for i in range(9)] + [(6000 + i, "hot") for i in range(1500)]
    return rows, spark.createDataFrame([(*r, 3) for r in rows], "doc_id bigint, text string, shard int").repartition(4)


def test_documents(spark, tmp_path):
    rows, docs = some_docs(spark)
    path = str(tmp_path / "map")
    got = shards.shard(docs, map_path=path).collect()
    want = sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "bytes")) for i, t in rows)
    assert sorted(str(tuple(r)[:4]) for r in got) == want
    loads, slots = defaultdict(int), defaultdict(list)
    for r in got:
        assert r["grown_shard"] is None
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(loads) == list(range(16)) and max(loads.values()) - min(loads.values()) <= 2
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    first, last = (shards.read_map(spark, path, v) for v in (1, None))
    assert (first.version, last.version) == (1, 2) and first.size == last.size and last.loads() == [loads[s] for s in range(16)]
    assert {r["virtual_slot"]: r["shard"] for r in got}.items() <= dict(enumerate(last.shard)).items()


def test_edits_move_little_and_grow(spark):
    rng = random.Random(3)
    even = shards.even_map([rng.randint(900, 1100) for _ in range(512)], [1] * 512, 8)
    better = shards.rebalanced(even)
    assert max(better.loads()) - min(better.loads()) < max(even.loads()) - min(even.loads())
    assert sum(a != b for a, b in zip(even.shard, better.shard)) < 60
    grown = shards.rebalanced(better, 9)
    assert max(grown.loads()) - min(grown.loads()) < 300 and grown.version == 3
    assert sum(a != b for a, b in zip(better.shard, grown.shard)) < 200


def test_one_huge_and_no_documents(spark):
    schema = "doc_id bigint, text string"
    got = shards.shard(spark.createDataFrame([(1, "x" * 100_000), (2, "a"), (3, "b")], schema)).collect()
    assert len({r["shard"] for r in got}) == 3
    assert shards.shard(spark.createDataFrame([], schema)).collect() == []


def test_repeated_ids_and_rows_without_id_are_split(spark, tmp_path):
    rows = [(i, "some words") for i in range(4000)] + [(7, "equal rows")] * 3000 + [(None, "no id")] * 3000 + [(9, f"one id {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    path = str(tmp_path / "map")
    got = shards.shard(docs, map_path=path).collect()
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == sorted(str((i, len(t) + 1, zlib.crc32(t.encode()))) for i, t in rows)
    loads, slots, per_slot = defaultdict(int), defaultdict(list), defaultdict(int)
    for r in got:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        per_slot[r["virtual_slot"]] += 1
    assert max(loads.values()) - min(loads.values()) <= 12 and len(loads) == 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(per_slot.values()) < 40
    last = shards.read_map(spark, path)
    assert len(last.split) == 3 and last.loads() == [loads[s] for s in range(16)]


def test_no_python_in_the_plan(spark):
    plan = shards.shard(some_docs(spark, 10)[1].select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
