"""Near copies of the pipeline's stage against plain loops over all pairs."""

import random

import pytest

import corpus_pipeline as pipeline
from bidtrail import session
from bidtrail.llm import components, copies

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 10 * len(a & b) >= 8 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(set(least.values()))


def near_copies():
    """Families in which the first text is the likest to all: copies with a few words changed, up to a likeness below 0.8."""
    rng = random.Random(3)
    words = ["w%d" % i for i in range(2000)]
    rows = []
    for family, size in enumerate([1, 2, 3, 8, 40]):
        base = [rng.choice(words) for _ in range(rng.choice([80, 200, 400]))]
        for i in range(size):
            copy = list(base)
            for _ in range(rng.choice([1, len(base) // 60, len(base) // 45, len(base) // 30]) if i else 0):
                copy[rng.randrange(len(copy))] = "new%d" % rng.randrange(10**6)
            rows.append((1000 * family + rng.randrange(1000), " ".join(copy)))
    shared = [rng.choice(words) for _ in range(150)]
    rows += [(9000 + i, " ".join(shared + [rng.choice(words) for _ in range(100)])) for i in range(30)]
    rows += [(20000, None), (20001, ""), (20002, " \n"), (20003, "two words"), (20004, "Two  Words"), (20005, "other words"), (20006, rows[0][1]), (20006, rows[0][1])]
    return rows


@pytest.mark.parametrize("pairs_up_to", [0, 3, 16])
def test_classes(spark, pairs_up_to):
    rows = near_copies()
    got = copies.first_of_classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), pairs_up_to)
    assert sorted(r[0] for r in got.collect()) == plain_kept(rows)


def test_stage_drops_copies_that_differ_in_a_few_words(spark):
    rng = random.Random(4)
    base = ["w%d" % rng.randrange(5000) for _ in range(300)]
    rows = [(1, " ".join(base))]
    for doc, step in ((2, 100), (3, 30)):
        rows.append((doc, " ".join("x%d" % doc if i % step == 7 else w for i, w in enumerate(base))))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    assert plain_kept(rows) == [1, 3]  # 3 words changed: 0.90; ten: 0.71
    assert sorted(r["doc_id"] for r in dict(pipeline.STAGES)["SimHash near-dedup"](spark, docs, "").collect()) == [1, 3]


def test_null_ids_and_empty_table(spark):
    rows = [(None, "only text without an id"), (None, "a b c d e f"), (7, "a b c d e f")]
    got = copies.first_of_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(str(r[0]) for r in got.collect()) == ["7", "None"]
    assert copies.first_of_classes(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_texts_around_one_passage_are_not_paired(spark, monkeypatch):
    """A likeness of 0.6 throughout: many share keys, none are alike, so pairs must not grow with the square."""
    rng = random.Random(6)
    shared = " ".join("s%d" % i for i in range(104))
    rows = [(i, shared + " " + " ".join("w%d" % rng.randrange(10**9) for _ in range(30))) for i in range(120)]
    rows += [(200, rows[7][1] + " one more"), (201, "up front " + rows[7][1])]
    counts = []

    def counted(df, stored=copies.stored):
        df = stored(df)
        counts.extend([df.count()] if df.columns == ["a", "b"] else [])
        return df

    monkeypatch.setattr(copies, "stored", counted)
    got = copies.first_of_classes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r[0] for r in got.collect()) == plain_kept(rows) == list(range(120))
    assert 0 < sum(counts) < 12 * len(rows)


@pytest.mark.parametrize("rows_per_file", [7, 200_000])
def test_components(spark, monkeypatch, rows_per_file):
    monkeypatch.setattr(components, "ROWS_PER_FILE", rows_per_file)
    rng = random.Random(7)
    links = [(n, n + 3) for n in range(-40, 20)] + [(50, n) for n in range(51, 80)] + [tuple(rng.sample(range(100, 190), 2)) for _ in range(45)] + [(5, 5)]
    plain = {n: n for link in links for n in link}
    for _ in plain:
        for a, b in links:
            plain[a] = plain[b] = min(plain[a], plain[b])
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(3)).collect()
    assert sorted((r["node"], r["root"]) for r in got) == sorted((n, r) for n, r in plain.items() if n != r)


def test_only_the_result_stays_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path))
    texts = [" ".join(f"w{(i // 3) * 50 + k}" for k in range(40)) + (" end" if i % 3 else "") for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = copies.first_of_classes(docs, pairs_up_to=1)
    (left,) = (tmp_path / "bidtrail").iterdir()
    assert spark.read.parquet(str(left)).columns == ["kept_id"]
    assert sorted(r[0] for r in kept.collect()) == plain_kept(list(enumerate(texts))) == [0, 3, 6, 9]
