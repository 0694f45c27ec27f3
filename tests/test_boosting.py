"""Softmax boosting against a plain loop over rows, nodes, features and bins."""

import numpy as np
import pytest

from bidtrail.operators import boosting

DDL = "label int, features array<double>"


def data(n=120, classes=3, wide=4, seed=1):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, classes, n)
    x = np.round(rng.normal(0, 1, (n, wide)) + np.eye(classes, wide)[label] * 2, 1)
    return [(int(k), [float(v) for v in row]) for k, row in zip(label, x)]


def plain_round(bins, label, margins, classes, depth, unit):
    """Trees of one round by plain loops: (class, node) -> (feature, bin), and leaf values per class."""
    e = np.exp(margins - margins.max(1, keepdims=True))
    p = e / e.sum(1, keepdims=True)
    worth = lambda g, h: (g / unit) ** 2 / (h / unit + boosting.SHRINK)
    splits, leaves = {}, {}
    for k in range(classes):
        g = [round(float(p[i, k] - (label[i] == k)) * unit) for i in range(len(label))]
        h = [round(float(p[i, k] * (1 - p[i, k])) * unit) for i in range(len(label))]
        groups = {0: list(range(len(label)))}
        for level in range(depth):
            below = {}
            for node, rows in groups.items():
                best = None
                gs, hs = sum(g[i] for i in rows), sum(h[i] for i in rows)
                for f in range(bins.shape[1]):
                    for b in sorted({bins[i, f] for i in rows}):
                        left = [i for i in rows if bins[i, f] <= b]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        if min(hl, hs - hl) < int(boosting.LEAST * unit):
                            continue
                        gain = worth(gl, hl) + worth(gs - gl, hs - hl) - worth(gs, hs)
                        if gain > 1e-9 and (best is None or gain > best[0]):
                            best = (gain, f, int(b))
                if best is None:
                    below[2 * node] = rows
                else:
                    splits[k, 2**level - 1 + node] = best[1:]
                    below[2 * node] = [i for i in rows if bins[i, best[1]] <= best[2]]
                    below[2 * node + 1] = [i for i in rows if bins[i, best[1]] > best[2]]
            groups = below
        for node, rows in groups.items():
            leaves[k, node] = -boosting.RATE * sum(g[i] for i in rows) / unit / (sum(h[i] for i in rows) / unit + boosting.SHRINK)
    return splits, leaves


def test_trees_equal_plain_loops(spark):
    rows = data()
    model = boosting.train(spark.createDataFrame(rows, DDL).repartition(3), rounds=2, depth=2, bins=8)
    label = [r[0] for r in rows]
    bins = np.array([[int((cuts < v).sum()) for cuts, v in zip(model.cuts, x)] for _, x in rows])
    margins = np.zeros((len(rows), 3))
    for number in range(2):
        splits, leaves = plain_round(bins, label, margins, 3, 2, boosting.UNIT)
        got = {(k, n): (int(f), int(model.bins[number][k, n])) for k in range(3) for n, f in enumerate(model.features[number][k]) if f >= 0}
        assert got == splits
        for (k, leaf), value in leaves.items():
            assert model.values[number][k, leaf] == pytest.approx(value, abs=1e-12)
        for i in range(len(rows)):
            for k in range(3):
                node = 0
                for level in range(2):
                    f, b = splits.get((k, 2**level - 1 + node), (0, 10_000))
                    node = 2 * node + int(bins[i, f] > b)
                margins[i, k] += leaves[k, node]
    e = np.exp(margins)
    loss = -np.log((e / e.sum(1, keepdims=True))[np.arange(len(rows)), label]).mean()
    assert model.losses[0] == pytest.approx(np.log(3), abs=1e-5) and model.losses[-1] == pytest.approx(loss, abs=1e-5)
    assert model.losses[0] > model.losses[1] > model.losses[2]


def test_the_spread_of_rows_does_not_matter(spark):
    df = spark.createDataFrame(data(200), DDL)
    one, many = boosting.train(df.coalesce(1), rounds=2), boosting.train(df.repartition(7), rounds=2)
    assert one.losses == many.losses
    for a, b in zip(one.features + one.bins + one.values, many.features + many.bins + many.values):
        assert np.array_equal(a, b)


def test_odd_rows(spark):
    odd = [(None, [1.0]), (0, None), (1, [float("nan"), None]), (1, [2.0, 1.0, 5.0]), (0, []), (0, [0.0, 1.0])]
    df = spark.createDataFrame(odd, DDL)
    model = boosting.train(df, rounds=1, depth=1)
    scored = boosting.predict(model, df).collect()
    assert len(scored) == 6 and all(abs(sum(r["probabilities"]) - 1) < 1e-9 and len(r["probabilities"]) == 2 for r in scored)
    assert boosting.predict(model, df.where("false")).collect() == []
    empty = boosting.train(df.where("false"))
    assert {tuple(r["probabilities"]) for r in boosting.predict(empty, df).collect()} == {(1.0,)}
    with pytest.raises(ValueError):
        boosting.train(spark.createDataFrame([(boosting.MOST_CLASSES, [1.0])], DDL))


def test_held_out_rows(spark):
    df = spark.createDataFrame([(i % 2, k, x) for i, (k, x) in enumerate(data(600, seed=3))], "part int, label int, features array<double>")
    scored = boosting.predict(boosting.train(df.where("part = 0")), df.where("part = 1"))
    assert scored.where("prediction = label").count() > 0.8 * scored.count()
