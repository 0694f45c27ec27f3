"""Fingerprints: edited texts, anchors against a plain loop, likeness against plain recursion."""

import hashlib
import random
from functools import lru_cache

import numpy as np
import pytest
import xxhash

from bidtrail.llm import syncmers


def test_anchors_are_closed_syncmers():
    rng = random.Random(2)
    for text in ["", "short", "ab" * 300, "".join(rng.choice("abc é") for _ in range(2000))]:
        data = text.encode()
        inner = {p: int(syncmers.gram_hashes(np.frombuffer(data[p : p + 16], np.uint8), 16)[0]) for p in range(len(data) - 15)}
        want = []
        for p in range(len(data) - 47):
            hashes = [inner[q] for q in range(p, p + 33)]
            if min(hashes) in (hashes[0], hashes[-1]):
                want.append(p)
        alone = syncmers.anchors([data])[0]
        assert len(alone) == (len(want) or (1 if data else 0))
        together = syncmers.anchors([b"x" * 100, data, b"", data])
        assert np.array_equal(together[1], alone) and np.array_equal(together[3], alone)
        # Each k-mer's hash depends on it alone.
        if want:
            assert syncmers.anchors([data[want[0] : want[0] + 48]])[0][0] == alone[0]


def test_likeness():
    rng = random.Random(4)
    for _ in range(60):
        a = [rng.randint(0, 9) for _ in range(rng.randint(1, 9))]
        b = [rng.randint(0, 9) for _ in range(rng.randint(1, 9))]
        mark = lambda x: [(v, x[:i].count(v)) for i, v in enumerate(x)]
        p, q = mark(a), mark(b)

        @lru_cache(None)
        def common(i, j):
            if i == len(p) or j == len(q):
                return 0
            return max(common(i + 1, j), common(i, j + 1), 1 + common(i + 1, j + 1) if p[i] == q[j] else 0)

        got = syncmers.likeness(np.array(a, np.uint32), np.array(b, np.uint32))
        assert got == 2 * common(0, 0) / (len(a) + len(b))
    empty = np.zeros(0, np.uint32)
    assert syncmers.likeness(empty, empty) == 1.0 and syncmers.likeness(empty, np.array([1], np.uint32)) == 0.0


def in_order(rows):
    """Descending id, none last; of one id the largest signed hash of the text first."""
    signed = lambda t: (h := xxhash.xxh64(t.encode(), seed=42).intdigest()) - (h >> 63 << 64)
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -signed(r[1]), r[1].encode()))


def expected(rows):
    order, want = in_order(rows), []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, other, follow = syncmers.anchors([x.encode() for x in (text, changed, after)])
        want.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), syncmers.as_text(own), syncmers.as_text(other), syncmers.likeness(own, other), syncmers.likeness(own, follow)))
    return want


def test_documents(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgé漢") for _ in range(rng.randint(1, 8)))
    rows = [(i * 7 % 211, " ".join(word() for _ in range(rng.choice([0, 1, 30, 300])))) for i in range(120)]
    rows += [(1000, None), (1001, ""), (1002, rows[0][1]), (1003, "z" * 30_000), (1004, "tie b"), (1004, "tie a"), (None, "no id at all")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, part int").repartition(5)
    got = syncmers.fingerprints(docs).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected(rows)))


@pytest.mark.parametrize("hot", [None, 50, 10_000])
def test_one_id_fills_several_ranges(spark, hot):
    rng = random.Random(9)
    rows = [(hot, "".join(rng.choice("abc ") for _ in range(rng.randint(0, 200)))) for _ in range(300)]
    rows += [(i, "x" * rng.randint(0, 90)) for i in range(200)] + [(300, "long " * 9000), (hot, "equal"), (hot, "equal")]
    got = syncmers.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    largest = max(len(part) for part in got.select("doc_id").rdd.glom().collect())
    assert largest < 300
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected(rows)))


def test_small_tables(spark):
    schema = "doc_id bigint, text string"
    assert syncmers.fingerprints(spark.createDataFrame([], schema)).collect() == []
    alone = syncmers.fingerprints(spark.createDataFrame([(5, "abcd")], schema)).collect()
    assert [(r["doc_id"], r["edited_sha256"]) for r in alone] == [(5, hashlib.sha256(b"abab").hexdigest())]
