"""Mixing: targets by repeated resharing, taken words near them, reruns, cuts."""

import random
from collections import defaultdict

import pytest

from bidtrail import session
from bidtrail.llm import mixing


def plain_targets(sizes):
    """Share all words by weight; what is above three times a source's size goes to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def some_docs(seed, n=400):
    rng = random.Random(seed)
    sources = ["b", "a", "é", None, "hot", "hot", "hot", "tiny"]
    rows = []
    for i in range(n):
        s = rng.choice(sources)
        if s == "tiny" and rng.random() < 0.9:
            s = "hot"
        rows.append((i, " ".join("w%d" % rng.randint(0, 99) for _ in range(rng.choice([0, 1, 5, 300, 900]))), s))
    return rows + [(900, None, "a"), (901, "", "nothing"), (None, "no id here", "b"), (902, "x y", "b"), (902, "x y", "b"), (903, "w " * 30_000, "long")]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken(spark, seed):
    rows = some_docs(seed)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, size int").repartition(3)
    got = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want, taken = plain_targets(sizes), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(0.03 * target, 4 * mixing.BLOCK_WORDS)
    again = mixing.mix(docs.repartition(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_schedule_keeps_shares_in_every_stretch(spark):
    rows = [(0, 60_000, 90_000.0), (1, 60_000, 30_000.0), (2, 60_000, 60_000.0)]
    sources = spark.createDataFrame(rows, "place int, source_size bigint, target double")
    slots = sorted((r["slot"], r["place"], r["block"], r["copy"]) for r in mixing.schedule(sources).collect())
    assert len({s[0] for s in slots}) == len(slots)
    for at in range(0, len(slots) - 240, 240):
        part = [p for _, p, _, _ in slots[at : at + 240]]
        for place, share in ((0, 1 / 2), (1, 1 / 6), (2, 1 / 3)):
            assert abs(part.count(place) - 240 * share) <= 6
    blocks = 60_000 // mixing.BLOCK_WORDS + 1
    turns = defaultdict(list)
    for _, place, block, copy in slots:
        turns[place].append(copy * blocks + block)
    assert all(t == list(range(len(t))) for t in turns.values())


def test_as_many_sources_as_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELLS", 4)
    rng = random.Random(8)
    sizes = {f"s{i:04}": rng.choice([0, 1, 70, 200, 3000]) for i in range(300)}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = {r["source"]: r for r in mixing.mix(docs).collect()}
    want = plain_targets(sizes)
    assert {s: r["target"] for s, r in got.items()} == pytest.approx(want)
    assert sum(r["taken"] for r in got.values()) == pytest.approx(sum(sizes.values()), rel=0.02)
    for s, r in got.items():
        assert r["taken"] <= 3 * sizes[s] and abs(r["taken"] - want[s]) <= 0.03 * want[s] + 4 * mixing.BLOCK_WORDS


def test_running_sums(spark):
    rng = random.Random(9)
    rows = [(rng.choice([None, "é", "z", "a", "A", ""]), i, rng.randint(0, 9)) for i in range(300)]
    got = mixing.running_sums(spark.createDataFrame(rows, "s string, i int, n int"), [mixing.F.col("s").asc_nulls_last(), mixing.F.col("i")], ["n"]).collect()
    total, want = 0, {}
    for s, i, n in sorted(rows, key=lambda r: (r[0] is None, (r[0] or "").encode(), r[1])):
        total += n
        want[i] = total
    assert {r["i"]: r["upto_n"] for r in got} == want


def test_take_repeats_and_cuts(spark):
    text = " one  two\nthree "
    rows = [(1, text, 17, 3, 7), (2, text, 17, 3, 2), (3, text, 17, 3, 0), (4, text, 17, 3, 3)]
    mixed = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, size bigint, taken bigint")
    got = sorted(map(tuple, mixing.take(mixed, ["doc_id", "text", "n_chars"]).collect()))
    full = len(text)
    assert got == [(1, " one", 4), (1, text, full), (1, text, full), (2, " one  two", 9), (4, text, full)]


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], "doc_id bigint, text string, source string")).collect() == []


def test_a_carried_text_is_stored_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path))
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, None, None), (3, "d", "y")], "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r["text"] for r in mixing.mix(docs, carry=["text"]).collect()}
    assert got == {1: "a b c", 2: None, 3: "d"}
    schemas = [spark.read.parquet(str(p)).schema.simpleString() for p in (tmp_path / "bidtrail").iterdir()]
    assert max(s.count("text:") for s in schemas) == 1
