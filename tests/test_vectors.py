import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bidtrail.functions import packed
from bidtrail.operators import vectors
from bidtrail.operators.text import ENGLISH_STOP_WORDS
from bidtrail.plans import scoring

TITLES = [
    "Senior Java developer, the Java team", "java developer", "Java Developer (remote)", "nurse", "the and of", "", None,
    "night nurse and day nurse", "Ärztin für Notfälle", "developer " * 40, "a b c d e f g h i j k l",
]


def plain(titles, window, slots, dimensions):
    """word -> (contexts, vector), by plain loops."""
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    counts = Counter()
    for title in titles:
        cleaned = "".join(c if c.isalnum() else " " for c in (title or "").lower())
        words = [w for w in cleaned.split() if w not in ENGLISH_STOP_WORDS]
        for i, word in enumerate(words):
            for j in range(max(0, i - window), min(len(words), i + window + 1)):
                if j != i:
                    counts[word, int(digest(words[j])[:8], 16) % slots] += 1
    by_word, by_slot = Counter(), Counter()
    for (word, slot), n in counts.items():
        by_word[word] += n
        by_slot[slot] += n
    out = {word: [0] * dimensions for word in by_word}
    for (word, slot), n in counts.items():
        likely = n * sum(counts.values()) / (by_word[word] * by_slot[slot])
        weight = math.floor(1000 * math.log(likely) + 0.5) if likely > 1 else 0
        for d in range(dimensions):
            out[word][d] += weight if digest(f"{slot}:{d}")[0] >= "8" else -weight
    return {word: (by_word[word], vector) for word, vector in out.items()}


@pytest.mark.parametrize(("window", "slots", "dimensions"), [(vectors.WINDOW, vectors.SLOTS, vectors.DIMENSIONS), (1, 7, 3)])
def test_vectors_equal_a_plain_recount(spark, window, slots, dimensions):
    df = spark.createDataFrame([(t,) for t in TITLES], "title string").repartition(3)
    got = {r["word"]: (r["n"], r["vector"]) for r in vectors.word_vectors(df, "title", window, slots, dimensions).collect()}
    assert got == plain(TITLES, window, slots, dimensions)


def test_title_without_known_words_has_zeros(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TITLES)], "id int, title string")
    rows = {r["id"]: r["features"] for r in vectors.title_vectors(df, vectors.word_vectors(df)).collect()}
    assert len(rows) == len(TITLES)
    for i in (4, 5, 6):
        assert rows[i] == [0.0] * vectors.DIMENSIONS
    assert sum(x * x for x in rows[9]) == pytest.approx(1)


def test_similar_words_classify_unseen_titles(spark):
    """Words of the test titles never stand in a training title with a label, only beside words that do."""
    rng = random.Random(2)
    trades = {0: ["java", "python", "compiler", "server", "backend", "kernel"], 1: ["nurse", "ward", "clinic", "patient", "surgery", "dose"]}
    texts = [(label, " ".join(rng.choices(words, k=5))) for label, words in trades.items() for _ in range(200)]
    df = spark.createDataFrame(texts, "label int, title string")
    vecs = vectors.word_vectors(df).cache()
    half = F.array_contains(vectors.title_words(F.col("title")), "server") | F.array_contains(vectors.title_words(F.col("title")), "dose")
    unseen = spark.createDataFrame([(0, "server"), (1, "dose"), (0, "server server"), (1, "dose")], "label int, title string")
    model = vectors.train_title_classifier(vectors.title_vectors(df.where(~half), vecs))
    got = vectors.classify_title_vectors(model, vectors.title_vectors(unseen, vecs))
    assert all(r["label"] == r["predicted"] for r in got.collect())
    counts = scoring.title_pipeline().fit(df.where(~half))
    by_counts = scoring.classify_titles(counts, unseen).where("label = predicted").count()
    assert by_counts < 4


def test_words_held_in_turn_lose_no_text():
    """Texts cut into turns anywhere: as many rows and words, none longer than asked unless one text is."""
    texts = [["a"] * (i % 7) for i in range(50)] + [["b"] * 40, [], ["c"]]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, min(i + 9, len(texts)))), pa.array(texts[i : i + 9], pa.list_(pa.string()))], names=["id", "words"]) for i in range(0, len(texts), 9)]
    for most in (1, 10, 25, 1000):
        turns = list(vectors._in_turn(iter([b.slice(0, 0) for b in batches[:1]] + batches), most))
        assert [i for (ids,), _, _ in turns for i in ids.to_pylist()] == list(range(len(texts)))
        assert [n for _, lengths, _ in turns for n in lengths.tolist()] == [len(t) for t in texts]
        assert [w for _, _, flat in turns for w in flat.to_pylist()] == [w for t in texts for w in t]
        assert all(len(lengths) == 1 or len(lengths) + len(flat) <= most for _, lengths, flat in turns)


def test_few_file_parts_do_not_bound_the_tasks(spark):
    """A file of one part was counted by one task, whatever its number of words."""
    df = spark.createDataFrame([(t,) for t in TITLES], "title string").coalesce(1)
    plan = vectors.context_counts(df)._jdf.queryExecution().executedPlan().toString()
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    assert f"RoundRobinPartitioning({tasks})" in plan and plan.rindex("MapInArrow") < plan.index("RoundRobinPartitioning")


def test_title_vectors_are_means_in_any_blocks(spark):
    """No row per word and text, each of the width of a vector: words meet their vectors once per block."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TITLES)], "id int, title string")
    vecs = vectors.word_vectors(df).cache()
    unit = {}
    for r in vecs.collect():
        length = math.sqrt(sum(x * x for x in r["vector"]))
        if length:
            unit[r["word"]] = [x / length for x in r["vector"]]
    words = {r["id"]: r["words"] for r in df.select("id", vectors.title_words(F.col("title")).alias("words")).collect()}
    for most in (3, vectors.BLOCK_WORDS):
        featured = vectors.title_vectors(df, vecs, block_words=most)
        assert "CoGroup" in featured._jdf.queryExecution().executedPlan().toString()
        for r in featured.collect():
            known = [unit[w] for w in words[r["id"]] if w in unit]
            assert r["features"] == pytest.approx([sum(x) / len(known) for x in zip(*known)] if known else [0.0] * vectors.DIMENSIONS)


def test_counts_of_a_word_in_several_batches_are_one_row_a_slot():
    rows = [("a", [1, 2], [1, 1]), ("a", [2], [3]), ("a", [5], [1]), ("b", [1], [1]), ("c", [1], [2]), ("c", [1], [2])]
    for size in (1, 2, 4, 6):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names=["word", "slots", "ns"]) for i in range(0, 6, size)]
        got = [tuple(r.values()) for b in vectors._added_up(7)(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == [("a", 1, 1), ("a", 2, 4), ("a", 5, 1), ("b", 1, 1), ("c", 1, 4)]


def test_rows_of_numbers_in_few_bits_come_back():
    rng = random.Random(5)
    for columns in (1, 3, 64):
        rows = [[rng.randint(-(2**bits), 2**bits - 1) for _ in range(columns)] for bits in (0, 1, 2, 7, 8, 16, 17, 31) for _ in range(4)]
        rows += [[0] * columns, [-1] * columns, [-(2**20)] * columns, [2**20] * columns]
        for some in (rows, [*rows, [2**50] * columns, [-(2**50)] * columns]):
            some_packed = packed.narrow_rows(np.array(some, np.int64))
            assert packed.from_narrow(some_packed, columns).tolist() == some
    assert max(map(len, packed.narrow_rows(np.full((1, 64), 30_000)))) == 1 + 64 * 16 // 8
    assert packed.from_narrow([], 64).shape == (0, 64)


def test_words_come_back():
    words = pa.array(["a", "", "Ärztin", "a"])
    for some in (words, words.slice(1, 2), words.slice(0, 0)):
        assert packed.words_of(*packed.packed_words(some), len(some)).to_pylist() == some.to_pylist()


def test_counts_and_vectors_travel_in_few_bytes(spark):
    """A list per word and task, and a vector of doubles per block and word, were more than twenty times the texts."""
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(400)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.split() for t in texts])], names=["words"])
    parts = [r for b in vectors._neighbours(5, 4096, 8)(iter([batch])) for r in b.to_pylist()]
    assert len(parts) == 8 and sum(r["cells"] for r in parts) > 100_000
    assert sum(len(v) for r in parts for v in r.values() if isinstance(v, bytes)) < 3 * sum(r["cells"] for r in parts)
    df = spark.createDataFrame([(t,) for t in texts], "title string")
    known = vectors.word_vectors(df)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    rows = known.collect()
    assert sum(map(len, packed.narrow_rows(np.array([r["vector"] for r in rows])))) < 64 * 3 * len(rows)
