import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bidtrail.llm import exact

DDL = "doc_id bigint, text string, row string, first int"
WORDS = ["", "a", "b  c", "\t", "x y", "long " * 5000]


def plain(rows):
    """The same by plain loops: (doc_id, keep_id, group_size, kept, text_sha256)."""
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        digest = hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()
        groups[digest].append((doc_id is None, doc_id, i))
    out = []
    for digest, members in groups.items():
        first = min(members, key=lambda m: (m[0], m[1] if m[1] is not None else 0, m[2]))
        out += [(m[1], first[1], len(members), m[2] == first[2], digest) for m in members]
    return sorted(out, key=str)


def corpus():
    rows = [(i, WORDS[0] if i % 3 == 0 else f"text {i // 2}", "clash", 1) for i in range(400)]
    rows += [(1000 + i, WORDS[i % len(WORDS)], None, 2) for i in range(60)]
    rows += [(None, "a", None, 3), (None, None, None, 3), (None, "only without id", None, 3), (None, "only without id", None, 3)]
    rows += [(5, "the same row", "r", 4)] * 3 + [(2000, " a ", None, 4), (2001, "\n\ta\r\n", None, 4), (-7, "a", None, 4)]
    return rows


@pytest.mark.parametrize(("counters", "heavy"), [(exact.COUNTERS, exact.HEAVY), (8, 0.1), (100, 0.9)])
def test_equals_plain_loops(spark, counters, heavy):
    rows = corpus()
    got = exact.mark_copies(spark.createDataFrame(rows, DDL).repartition(7), counters, heavy)
    assert got.columns == exact.RESULT
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == plain(rows)


def test_remove_copies_keeps_all_columns(spark):
    rows = corpus()
    left = exact.remove_copies(spark.createDataFrame(rows, DDL).repartition(5))
    assert left.columns == ["doc_id", "text", "row", "first"]
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(r[0]) for r in plain(rows) if r[3])


def test_empty_table(spark):
    empty = spark.createDataFrame([], DDL)
    assert exact.mark_copies(empty).collect() == [] and exact.remove_copies(empty).collect() == []


def test_all_rows_equal(spark):
    rows = [(i % 50, "one", None, None) for i in range(3000)]
    assert sorted(map(tuple, exact.mark_copies(spark.createDataFrame(rows, DDL)).collect()), key=str) == plain(rows)


def test_sketch_names_what_is_heavy(spark):
    """Every value over 1 in 1000 of the rows is named, among 60,000 that are not."""
    ids = spark.range(200_000, numPartitions=16).select(F.expr("if(id % 3 = 0, id % 300 div 3, id) AS v"), F.spark_partition_id().alias("lane"))
    named = {r["item"] for r in exact.frequent(ids, "v", F.pmod("lane", F.lit(4))).collect()}
    assert set(range(100)) <= named and len(named) <= exact.COUNTERS


def test_winners_are_settled_without_shuffle(spark):
    """The heavy group meets its winner in a broadcast join; no Python runs."""
    rows = spark.createDataFrame([(i, "copy" if i % 3 == 0 else f"t{i}", None, None) for i in range(3000)], DDL)
    assert [r["group_size"] for r in exact.winners(exact._rows(rows)).collect()] == [1000]
    plan = exact.mark_copies(rows)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
