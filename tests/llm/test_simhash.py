"""Fingerprints and components against plain loops."""

import random

import pytest
import xxhash

from bidtrail.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def signed(n):
    return n - (1 << 64) if n >> 63 else n


@pytest.mark.parametrize("pairs_up_to", [0, 3, 16])
def test_links_connect_what_is_near(spark, pairs_up_to):
    rng = random.Random(pairs_up_to)
    seeds = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    nodes = set(seeds)
    for _ in range(90):
        n = rng.choice(sorted(nodes))
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4, 5])):
            n ^= 1 << b
        nodes.add(n)
    nodes = {signed(n) for n in nodes}
    bits = spark.createDataFrame([(n,) for n in nodes], "bits bigint")
    edges = simhash.links(bits, pairs_up_to)
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert {n: roots.get(n, n) for n in nodes} == plain_components(nodes)


def test_documents(spark):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)] + ["Ärger", "ÄRGER", "A", "a"]
    rows = []
    for i in range(40):
        text = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 50, 400]))]
        rows.append((i, rng.choice([" ", "\t", "\n\v "]).join(text)))
        if len(text) > 300:
            rows.append((100 + i, rows[-1][1].upper().replace("Ä", "ä")))
            rows.append((200 + i, rows[-1][1] + " tail"))
    rows += [(300, None), (301, ""), (302, " \n"), (303, rows[0][1]), (303, rows[0][1]), (None, "alone in the world"), (304, "  x y  ")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, bits string")
    got = simhash.near_duplicates(docs).collect()
    prints = {i: plain_fingerprint(t) for i, t in rows}
    assert sorted((str(r["doc_id"]), r["fingerprint"]) for r in got) == sorted((str(i), f"{plain_fingerprint(t):016x}") for i, t in rows)
    root = plain_components(set(prints.values()))
    least = {}
    for i, f in prints.items():
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    for r in got:
        assert r["component_id"] == least.get(root[prints[r["doc_id"]]])


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
