"""Classifier: held-out accuracy, labels never read where they may not be, features, gradient."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from bidtrail.llm import quality
from bidtrail.llm.queries import op2_quality

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scored = op2_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    right = [r["quality"] == r["predicted"] for r in rows]
    bad = [r["predicted"] == 0 for r in rows if r["quality"] == 0]
    assert np.mean(right) > 0.97 and np.mean(bad) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows) and len({r["score"] for r in rows}) > len(rows) / 2
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(docs, x, most=60) for x in (labels, turned))
    assert all(np.array_equal(a.weights[k], b.weights[k]) for k in a.weights)


def test_edge_rows_and_models_without_both_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (3, "w " * 40_000, None), (None, "some text", "c"), (3, "w " * 40_000, None), (4, "\n\t ", "d")],
        "doc_id bigint, text string, score string",
    )
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality.score(docs, quality.fit(docs, none), carry=[]).collect()
    assert len(got) == 6 and {r["score"] for r in got} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 0), (3, 7)], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, ones)).collect()} == {1.0}
    assert quality.score(docs.where("false"), quality.fit(docs.where("false"), none)).collect() == []


def test_passages_do_not_depend_on_what_stands_beside():
    texts = ["", "one", "a b " * 100, " lead\n\nand trail \n", "é" * 500, "x | y " * 33]
    encoded = [t.encode() for t in texts]
    x, bags = quality.passages(np.frombuffer(b"".join(encoded), np.uint8), np.array([len(e) for e in encoded]))
    assert bags.tolist() == [1, 1, 4, 1, 1, 2]
    starts = np.cumsum(bags) - bags
    for e, start, n in zip(encoded, starts, bags):
        alone, one = quality.passages(np.frombuffer(e, np.uint8), np.array([len(e)]))
        assert one.tolist() == [n] and np.allclose(alone, x[start : start + n])


def test_training_lowers_the_loss_on_bags():
    rng = np.random.default_rng(0)
    bags = rng.integers(1, 6, 200)
    x = rng.normal(size=(bags.sum(), quality.FEATURES))
    starts = np.cumsum(bags) - bags
    # A bag is good when its largest first feature is positive: a matter of attention, not of the mean.
    label = (np.maximum.reduceat(x[:, 0], starts) > 0.5).astype(float)
    model = quality.train(x, bags, label, np.ones(len(bags)))
    assert np.mean((model.score(x, bags) >= 0.5) == label) > 0.95


def test_the_fit_reads_whole_texts():
    texts = ["good words here " * 3_000, "", None]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3], pa.int64()), "quality": pa.array([1, 0, 0], pa.int32()), "text": pa.array(texts, pa.string())})
    found = {r["doc_id"]: np.frombuffer(r["x"], np.float32).reshape(-1, quality.FEATURES) for b in quality._passage_batches(iter([batch])) for r in b.to_pylist()}
    whole, bags = quality.passages(np.frombuffer(texts[0].encode(), np.uint8), np.array([len(texts[0])]))
    assert [len(found[i]) for i in (1, 2, 3)] == [bags[0], 1, 1] and bags[0] > 100
    assert np.array_equal(found[1], whole)


def test_scores_equal_plain_loops():
    rng = np.random.default_rng(4)
    bags = np.array([1, 4, 2])
    x = rng.normal(size=(bags.sum(), quality.FEATURES))
    model = quality.train(x, bags, np.array([1.0, 0.0, 1.0]), np.ones(3))
    w = model.weights
    at = 0
    for n, score in zip(bags, model.score(x, bags)):
        encoded, pulls = [], []
        for row in x[at : at + n]:
            e = np.tanh(((row - model.mean) / model.scale) @ w["encode"] + w["bias"])
            encoded.append(e)
            pulls.append(float(np.sum(np.tanh(e @ w["tanh"]) / (1 + np.exp(-(e @ w["gate"]))) * w["attend"])))
        weights = [np.exp(p) / sum(np.exp(q) for q in pulls) for p in pulls]
        z = sum(a * e for a, e in zip(weights, encoded))
        assert abs(score - 1 / (1 + np.exp(-(z @ w["out"] + w["level"][0])))) < 1e-6
        at += n
