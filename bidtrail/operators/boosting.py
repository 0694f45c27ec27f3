"""Boosted trees for several classes at once: softmax loss, one tree per class and round, histograms summed by Spark.

Numbers become bins of approximate quantiles.  For each level of a round every task adds up the slopes of its rows per
class, node, feature and bin, Spark sums those tables, and the best split of each node is chosen by windows over the
bins.  What the driver holds is the model; what a task sends is bounded by classes x nodes x features x bins, whatever the
rows.  Slopes are rounded to whole numbers before they are summed, so the same bins give the same trees however the rows
are spread.  A task keeps nothing from one pass to the next: margins follow from the trees so far.

Rows without a label (a class number from 0) are not learned from.  Missing numbers, NaN and the tail of a short array fall into
the first bin; numbers beyond the width of the training rows are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

ROUNDS, DEPTH, BINS = 5, 3, 32
RATE, SHRINK, LEAST = 0.5, 1.0, 1e-3
MOST_CLASSES = 256
UNIT = 1 << 20
SCORED = "prediction int, probabilities array<double>"


@dataclass
class SoftmaxTrees:
    """cuts: upper ends of the bins of each feature.  Per round and class a full tree: feature (-1: all rows go left) and bin
    of its inner nodes, level by level, and the value of its leaves.  losses: mean log loss before each round and at the end."""

    cuts: list[np.ndarray]
    classes: int
    depth: int
    features: list[np.ndarray] = field(default_factory=list)
    bins: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def binned(self, vectors: pd.Series) -> np.ndarray:
        """Bins of the features of each row."""
        out = np.zeros((len(vectors), len(self.cuts)), np.uint8)
        if not len(self.cuts):
            return out
        numbers = np.full(out.shape, -np.inf)
        for i, vector in enumerate(vectors):
            if vector is not None:
                known = np.asarray(vector, np.float64)[: len(self.cuts)]
                numbers[i, : len(known)] = np.where(np.isnan(known), -np.inf, known)
        for j, cuts in enumerate(self.cuts):
            out[:, j] = np.searchsorted(cuts, numbers[:, j], side="left")
        return out

    def margins(self, bins: np.ndarray) -> np.ndarray:
        total = np.zeros((len(bins), self.classes))
        for feature, cut, value in zip(self.features, self.bins, self.values):
            for k in range(self.classes):
                total[:, k] += value[k][descend(bins, feature[k], cut[k], self.depth)]
        return total


def descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Place of each row among the nodes of a level, from the root down."""
    place = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for level in range(levels):
        node = 2**level - 1 + place
        right = (feature[node] >= 0) & (bins[rows, feature[node]] > cut[node])
        place = 2 * place + right
    return place


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def bin_cuts(rows: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """Distinct approximate quantiles of each feature, all in one pass; as wide as the longest array."""
    width = rows.agg(F.max(F.size(features))).first()[0] or 0
    shares = [i / bins for i in range(1, bins)]
    number = lambda i: F.get(features, F.lit(i)).cast("double")
    quantiles = [F.percentile_approx(F.when(~F.isnan(number(i)), number(i)), shares, 10_000).alias(f"q{i}") for i in range(max(width, 0))]
    return [np.unique(np.array(q or [], np.float64)) for q in rows.agg(*quantiles).first()] if quantiles else []


def slopes(model: SoftmaxTrees, feature: np.ndarray, cut: np.ndarray, level: int, bins: int):
    """Task function: whole-number sums of first and second slopes per cell (class, node, feature, bin); cell -1 holds the
    loss and the number of rows."""
    wide, nodes = len(model.cuts), 2**level

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, model.classes * nodes * wide * bins), np.int64)
        loss = rows = 0
        for frame in frames:
            if not len(frame):
                continue
            x = np.frombuffer(b"".join(frame["bins"]), np.uint8).reshape(-1, wide)
            label = frame["label"].to_numpy()
            p = softmax(model.margins(x))
            loss += int(np.rint(-np.log(np.maximum(p[np.arange(len(x)), label], 1e-300)) * UNIT).sum())
            rows += len(x)
            for k in range(model.classes):
                place = descend(x, feature[k], cut[k], level)
                cell = (((k * nodes + place)[:, None] * wide + np.arange(wide)) * bins + x).ravel()
                for part, slope in enumerate((p[:, k] - (label == k), p[:, k] * (1 - p[:, k]))):
                    whole = np.repeat(np.rint(slope * UNIT), wide)
                    sums[part] += np.bincount(cell, whole, sums.shape[1]).astype(np.int64)
        cells = np.flatnonzero(sums.any(0))
        yield pd.DataFrame({"cell": np.append(cells, -1), "g": np.append(sums[0][cells], loss), "h": np.append(sums[1][cells], rows)})

    return run


def best_splits(cells: DataFrame, nodes: int, wide: int, bins: int) -> DataFrame:
    """One row per class and node with rows: sums g and h, and the split that gains most (null if none gains); of equal ones the
    first feature and bin."""
    at = F.col("cell")
    tables = cells.select(
        F.floor(at / (nodes * wide * bins)).alias("class"), F.floor(at / (wide * bins) % nodes).alias("node"), F.floor(at / bins % wide).alias("feature"),
        (at % bins).alias("bin"), "g", "h",
    )
    feature = Window.partitionBy("class", "node", "feature")
    upto = feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    unit = float(UNIT)
    both = tables.select(
        "class", "node", "feature", "bin", "g", "h",
        F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"), F.sum("g").over(feature).alias("gs"), F.sum("h").over(feature).alias("hs"),
    )

    def worth(g: Column, h: Column) -> Column:
        return (g / unit) * (g / unit) / (h / unit + SHRINK)

    gl, hl, gs, hs = (F.col(c) for c in ("gl", "hl", "gs", "hs"))
    gain = worth(gl, hl) + worth(gs - gl, hs - hl) - worth(gs, hs)
    least = int(LEAST * UNIT)
    fits = (hl >= least) & (hs - hl >= least) & (gain > 1e-9)
    split = F.when(fits, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl"))
    first = F.col("feature") == 0
    return both.groupBy("class", "node").agg(F.max(split).alias("split"), F.sum(F.when(first, F.col("g"))).alias("g"), F.sum(F.when(first, F.col("h"))).alias("h"))


def train(rows: DataFrame, features: str = "features", label: str = "label", rounds: int = ROUNDS, depth: int = DEPTH, bins: int = BINS) -> SoftmaxTrees:
    """Fit on all rows with a label; features is an array of numbers.  Without such rows every class is as likely."""
    if not 2 <= bins <= 256:
        raise ValueError("bins must be from 2 to 256")
    known = rows.where(F.col(label) >= 0).select(F.col(label).cast("int").alias("label"), F.col(features).alias("features"))
    top = known.agg(F.max("label")).first()[0]
    classes = 1 if top is None else top + 1
    if classes > MOST_CLASSES:
        raise ValueError(f"{classes} classes; at most {MOST_CLASSES} are taken")
    model = SoftmaxTrees(bin_cuts(known, "features", bins), classes, depth)
    wide = len(model.cuts)
    if not wide:
        return model

    def to_bins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"label": frame["label"], "bins": [row.tobytes() for row in model.binned(frame["features"])]})

    table = stored(known.mapInPandas(to_bins, "label int, bins binary"))

    def summed(feature: np.ndarray, cut: np.ndarray, level: int) -> DataFrame:
        parts = table.mapInPandas(slopes(model, feature, cut, level, bins), "cell bigint, g bigint, h bigint")
        return parts.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))

    for _ in range(rounds):
        feature = np.full((classes, 2**depth - 1), -1, np.int64)
        cut = np.zeros((classes, 2**depth - 1), np.int64)
        sums = np.zeros((2, classes, 2**depth))
        for level in range(depth):
            cells = stored(summed(feature, cut, level)) if level == 0 else summed(feature, cut, level)
            if level == 0:
                model.losses.append(_loss(cells))
            below = np.zeros((2, classes, 2 ** (level + 1)))
            # A row per class and node.
            for r in best_splits(cells.where("cell >= 0"), 2**level, wide, bins).collect():
                k, node = r["class"], r["node"]
                whole, s = np.array([r["g"], r["h"]], np.float64), r["split"]
                below[:, k, 2 * node] = whole
                if s is not None:
                    feature[k, 2**level - 1 + node], cut[k, 2**level - 1 + node] = -s["f"], -s["b"]
                    left = np.array([s["gl"], s["hl"]], np.float64)
                    below[:, k, 2 * node], below[:, k, 2 * node + 1] = left, whole - left
            sums = below
        model.features.append(feature)
        model.bins.append(cut)
        model.values.append(-RATE * (sums[0] / UNIT) / (sums[1] / UNIT + SHRINK))
    none = np.full((classes, 2**depth - 1), -1, np.int64)
    model.losses.append(_loss(summed(none, none, 0)))
    return model


def _loss(cells: DataFrame) -> float:
    found = cells.where("cell = -1").first()
    return found["g"] / UNIT / found["h"] if found and found["h"] else 0.0


def predict(model: SoftmaxTrees, rows: DataFrame, features: str = "features") -> DataFrame:
    """All rows with prediction (of equally likely classes the first) and the probabilities of the classes."""

    @F.pandas_udf(SCORED)
    def scored(vectors: pd.Series) -> pd.DataFrame:
        p = softmax(model.margins(model.binned(vectors)))
        return pd.DataFrame({"prediction": p.argmax(1).astype("int32"), "probabilities": list(p)})

    kept = rows.columns
    return rows.withColumn("_scored", scored(F.col(features))).select(*kept, "_scored.prediction", "_scored.probabilities")
