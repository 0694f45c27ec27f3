"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (PASSAGE_WORDS words each, whole text).  Every passage is encoded, gated attention
learned from document labels alone weighs the passages, and the weighted mean of the encodings is scored.  The model is
a few thousand numbers, fitted on the driver from a bounded sample of labelled documents, and applied in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import slices, tuned, utf8, word_starts
from .repeats import MIX, mixed
from .repetition import range_hashes

PASSAGE_WORDS = 64
# Bound of the fit, and of the fit only: labelled documents per label.  Each is read whole.
FIT_DOCUMENTS = 2_000
ENCODING, GATE = 24, 12
STEPS, RATE, DECAY = 300, 0.02, 1e-4
SEED = 20
CHUNK_BYTES = 1 << 19
WORD_BUCKETS = 16
U = np.uint64

# Bytes counted one by one, and ranges counted together.
SINGLE = b"#$%&*!|<>.,;:?\"'()-_/=\n"
RANGES = [(65, 90), (97, 122), (48, 57), (128, 255)]
CLASS_OF = np.full(256, len(SINGLE) + len(RANGES), np.int64)
for _number, _byte in enumerate(SINGLE):
    CLASS_OF[_byte] = _number
for _number, (_low, _high) in enumerate(RANGES):
    CLASS_OF[_low : _high + 1] = len(SINGLE) + _number
CLASSES = len(SINGLE) + len(RANGES) + 1
FEATURES = CLASSES + 7 + WORD_BUCKETS


def passages(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of texts laid end to end, and the number of passages of each text (at least one)."""
    docs = len(lengths)
    stops = np.cumsum(lengths)
    firsts = stops - lengths
    starts, n_words = word_starts(data, lengths)
    bags = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first_bag = np.cumsum(bags) - bags
    total = int(bags.sum())
    out = np.zeros((total, FEATURES), np.float32)
    if not len(starts):
        return out, bags
    doc = np.repeat(np.arange(docs), n_words)
    base = np.cumsum(n_words) - n_words
    inside = np.arange(len(starts)) - base[doc]
    bag = first_bag[doc] + inside // PASSAGE_WORDS

    # A passage's bytes run from its first word to the next passage or the end of the text.
    begin = starts[inside % PASSAGE_WORDS == 0]
    held = bag[inside % PASSAGE_WORDS == 0]
    end = np.minimum(np.append(begin[1:], len(data)), stops[doc[inside % PASSAGE_WORDS == 0]])
    size = end - begin
    marks = np.zeros(len(data) + 1, np.int64)
    np.add.at(marks, begin, 1 + np.arange(len(begin)))
    np.add.at(marks, end, -1 - np.arange(len(begin)))
    owner = np.cumsum(marks)[:-1] - 1
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    counted = (owner >= 0) & (~blank | (data == 10))
    cells = np.bincount(owner[counted] * CLASSES + CLASS_OF[data[counted]], minlength=len(begin) * CLASSES).reshape(-1, CLASSES)
    out[held, :CLASSES] = cells / size[:, None]

    blanks = np.flatnonzero(blank)
    word_ends = np.minimum(np.append(blanks, len(data))[np.searchsorted(blanks, starts)], stops[doc])
    length = word_ends - starts
    words = range_hashes(data, starts, word_ends)
    per_bag = np.bincount(bag, minlength=total).astype(np.float64)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(bag, weights=values, minlength=total) / np.maximum(per_bag, 1)

    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    in_bag = mixed(words + bag.astype(U) * MIX[1])
    once = np.zeros(len(words))
    once[np.unique(in_bag, return_index=True)[1]] = 1
    thrice = np.zeros(len(words))
    whole = np.flatnonzero(inside + 2 < n_words[doc])
    three = mixed(words[whole] * MIX[0] + words[whole + 1] * MIX[1] + words[whole + 2] + doc[whole].astype(U) * MIX[2])
    number, counts = np.unique(three, return_inverse=True, return_counts=True)[1:]
    thrice[whole] = counts[number] > 1
    columns = [
        mean(length) / 10,
        np.sqrt(np.maximum(mean(length.astype(np.float64) ** 2) - mean(length) ** 2, 0)) / 10,
        mean(length == 1),
        mean(again),
        mean(once),
        mean(thrice),
        np.minimum(per_bag, PASSAGE_WORDS) / PASSAGE_WORDS,
    ]
    for i, column in enumerate(columns):
        out[:, CLASSES + i] = column
    bucket = (words >> U(60)).astype(np.int64)
    cells = np.bincount(bag * WORD_BUCKETS + bucket, minlength=total * WORD_BUCKETS).reshape(-1, WORD_BUCKETS)
    out[:, CLASSES + 7 :] = cells / np.maximum(per_bag, 1)[:, None]
    return out, bags


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    """Parameters; without a `weights` entry the score is `share` for every document."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    share: float

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        w, starts = self.weights, np.cumsum(bags) - bags
        of = np.repeat(np.arange(len(bags)), bags)
        e = np.tanh(x @ w["encode"] + w["bias"])
        t, s = np.tanh(e @ w["tanh"]), sigmoid(e @ w["gate"])
        pull = (t * s) @ w["attend"]
        pull = np.exp(pull - np.maximum.reduceat(pull, starts)[of])
        a = pull / np.add.reduceat(pull, starts)[of]
        z = np.add.reduceat(a[:, None] * e, starts)
        return {"of": of, "starts": starts, "e": e, "t": t, "s": s, "a": a, "z": z, "p": sigmoid(z @ w["out"] + w["level"])}

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(bags), self.share)
        return self.forward((x - self.mean) / self.scale, bags)["p"].astype(np.float64)


def train(x: np.ndarray, bags: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Model:
    """Gradient descent with moments on the weighted logistic loss of the documents."""
    share = float((label * weight).sum() / weight.sum()) if len(label) else 0.5
    if len(np.unique(label)) < 2:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, share)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(SEED)
    shapes = {"encode": (FEATURES, ENCODING), "tanh": (ENCODING, GATE), "gate": (ENCODING, GATE), "attend": (GATE,), "out": (ENCODING,)}
    w = {k: rng.normal(0, 1 / np.sqrt(v[0]), v) for k, v in shapes.items()} | {"bias": np.zeros(ENCODING), "level": np.zeros(1)}
    model = Model(mean, scale, w, share)
    weight = weight / weight.sum()
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        f = model.forward(x, bags)
        of, e, t, s, a = f["of"], f["e"], f["t"], f["s"], f["a"]
        d_logit = weight * (f["p"] - label)
        d_z = (d_logit[:, None] * w["out"])[of]
        d_a = (e * d_z).sum(1)
        d_pull = a * (d_a - np.add.reduceat(a * d_a, f["starts"])[of])
        d_gated = d_pull[:, None] * w["attend"]
        d_t, d_s = d_gated * s * (1 - t * t), d_gated * t * s * (1 - s)
        d_e = (a[:, None] * d_z + d_t @ w["tanh"].T + d_s @ w["gate"].T) * (1 - e * e)
        slopes = {
            "encode": x.T @ d_e, "bias": d_e.sum(0), "tanh": e.T @ d_t, "gate": e.T @ d_s,
            "attend": (t * s).T @ d_pull, "out": f["z"].T @ d_logit, "level": d_logit.sum(keepdims=True),
        }
        for k, slope in slopes.items():
            slope = slope + DECAY * w[k]
            first[k] += 0.1 * (slope - first[k])
            second[k] += 0.01 * (slope * slope - second[k])
            w[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _passage_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", CHUNK_BYTES):
        x, bags = passages(*utf8(batch.column("text")))
        stops = np.cumsum(bags)
        kept = [x[stop - n : stop].tobytes() for stop, n in zip(stops, bags)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(kept, pa.binary())], names=["doc_id", "quality", "x"])


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS) -> Model:
    """Fit on at most `most` documents of each label that are not held out, chosen by a hash of their id.

    labels: doc_id, quality (0 or 1; other rows are ignored).  The two labels are weighted by how often they occur.
    With one label only, or none, the model scores every document with the share of label 1 (0.5 without labels).
    """
    tuned(docs.sparkSession)
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = {r[0]: r[1] for r in usable.groupBy("quality").count().collect()}
    order = [F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")]
    chosen = [usable.where(F.col("quality") == q).orderBy(*order).limit(most) for q in (0, 1)]
    sample = stored(chosen[0].unionByName(chosen[1]))
    # At most 2 * most rows of two numbers are sent to every task.
    found = texts.join(F.broadcast(sample), "doc_id").mapInArrow(_passage_batches, "doc_id bigint, quality int, x binary")
    rows = sorted(found.toLocalIterator(), key=lambda r: (r["doc_id"], r["quality"], r["x"]))
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    label = np.array([r["quality"] for r in rows], np.float64)
    taken = {q: max(1, int((label == q).sum())) for q in (0, 1)}
    weight = np.array([counts[r["quality"]] / taken[r["quality"]] for r in rows])
    return train(np.concatenate(x) if x else np.zeros((0, FEATURES)), np.array([len(v) for v in x]), label, weight)


def score(docs: DataFrame, model: Model, carry: list[str] = ()) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted, and the columns in `carry`.

    The whole text is scored; null and empty texts are one passage without words.  Rows are scored one by one, repeated
    ones alike; a null id is not held out.  An empty table gives an empty one; other columns are ignored.
    """
    tuned(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"), F.struct(F.lit(0).alias("_"), *carry).alias("rest")
    )
    schema = T.StructType([f for f in rows.schema if f.name != "text"]).add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            p = model.score(*passages(*utf8(batch.column("text"))))
            columns = [batch.column(c) for c in ("doc_id", "held_out", "rest")] + [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "rest", "score", "predicted"])

    scored = rows.mapInArrow(run, schema)
    return scored.select("doc_id", "held_out", "score", "predicted", *[F.col("rest")[c].alias(c) for c in carry])
