import random

import pytest

from bidtrail.operators import ranking


def plain(rows):
    """auc over all pairs, and the best threshold by trying each."""
    rows = [(y, s) for y, s in rows if y is not None and s is not None and s == s]
    positives, negatives = [s for y, s in rows if y == 1], [s for y, s in rows if y != 1]
    pairs = sum((p > n) + (p == n) / 2 for p in positives for n in negatives)
    auc = pairs / (len(positives) * len(negatives)) if positives and negatives else None
    tried = [(2 * sum(p >= t for p in positives) / (sum(p >= t for p in positives) + sum(n >= t for n in negatives) + len(positives)), t) for t in {s for _, s in rows}] if positives else []
    return len(positives), len(negatives), auc, *(reversed(max(tried)) if tried else (None, None))


@pytest.mark.parametrize("case", ["ties", "distinct", "one class", "no positives", "empty", "gaps"])
def test_report_equals_all_pairs(spark, case):
    rng = random.Random(4)
    rows = {
        "ties": [(rng.randint(0, 1), rng.randint(0, 9) / 10) for _ in range(400)],
        "distinct": [(int(rng.random() < s), s) for s in (rng.random() for _ in range(400))],
        "one class": [(1, 0.5), (1, 0.7)],
        "no positives": [(0, 0.5), (0, 0.1)],
        "empty": [],
        "gaps": [(1, 0.9), (None, 0.8), (0, None), (1, float("nan")), (0, 0.9), (1, 0.2), (0, -1.0)],
    }[case]
    curve = ranking.threshold_curve(spark.createDataFrame(rows, "label int, score double").repartition(3))
    assert curve.count() == len({s for y, s in rows if y is not None and s is not None and s == s})
    got = ranking.ranking_report(curve).collect()
    assert len(got) == 1
    want = plain(rows)
    assert got[0][:2] == want[:2]
    assert (got[0]["auc"], got[0]["threshold"], got[0]["f1"]) == pytest.approx(want[2:])


def test_wrong_rows(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, "b"), (4, None, None)], "id int, actual string, predicted string")
    assert sorted(map(tuple, ranking.wrong_rows(df, "actual", "predicted", ["id"]).collect())) == [(2, "a X b"), (3, "null X b")]
