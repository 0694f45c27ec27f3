"""Word vectors from co-occurrence counts, without a vocabulary on the driver.

For every word the words around it are counted in SLOTS hashed slots.  A count becomes its positive pointwise mutual
information (in thousandths, as a whole number), and the slots are projected to DIMENSIONS by signs that follow from
the numbers of slot and dimension.  All sums are of whole numbers, so a vector does not depend on the order of the rows.
Counting is one shuffle after a combine in each task, of a compressed row per task and bucket of words; it leaves a row
per word, and the rest needs no shuffle: tables with a row per slot are bounded.  Neighbours are counted, and vectors
added up, with Arrow and numpy inside the tasks, a bounded number of words at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.packed import from_narrow, from_planes, narrow_rows, packed_words, planes, ranges, words_of
from ..session import stored
from .text import ENGLISH_STOP_WORDS

WINDOW = 5
SLOTS = 4096
DIMENSIONS = 64
SCALE = 1000
# Words that a task holds at once: while it counts neighbours, and in a block of texts that meets its words' vectors.
COUNTED_WORDS = 500_000
BLOCK_WORDS = 4_000_000
# Words whose counts or vectors are in one batch, and buckets of words per task.
BATCH_WORDS = 2_000
BUCKETS_PER_TASK = 4
Batches = Iterator[pa.RecordBatch]


def title_words(title: Column) -> Column:
    """Lower-case words of a text, stop words left out; none for null."""
    words = F.regexp_extract_all(F.lower(F.coalesce(title, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)
    return F.filter(words, lambda w: ~w.isin(ENGLISH_STOP_WORDS))


def hashed_slots(words: pa.Array, slots: int = SLOTS) -> np.ndarray:
    """Slot of each word: the first eight hexadecimal digits of its MD5."""
    return np.array([int(hashlib.md5(w).hexdigest()[:8], 16) % slots for w in words.cast(pa.binary()).to_pylist()], np.int64)


def projection(df: DataFrame, dimensions: int = DIMENSIONS, slots: int = SLOTS) -> DataFrame:
    """slot, signs: +1 or -1 per dimension, by the first hexadecimal digit of the MD5 of 'slot:dimension'."""
    sign = lambda d: F.when(F.substring(F.md5(F.concat_ws(":", F.col("slot").cast("string"), d.cast("string"))), 1, 1) < "8", -1).otherwise(1)
    numbered = df.sparkSession.range(slots).select(F.col("id").cast("int").alias("slot"))
    return numbered.select("slot", F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), sign).alias("signs"))


def _in_turn(batches: Batches, most: int) -> Iterator[tuple[list[pa.Array], np.ndarray, pa.Array]]:
    """Rows whose last column is a list of words, some batches at a time, cut where they reach `most` words (a row counts as
    one more); a longer row stands alone.  The other columns, the number of words of each row, and all words end to end."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple[list[pa.Array], np.ndarray, pa.Array]:
        *others, words = (pa.concat_arrays([b.column(i) for b in held]) for i in range(held[0].num_columns))
        return others, words.value_lengths().to_numpy(), words.flatten()

    n = 0
    for batch in batches:
        ends = np.cumsum(batch.column(batch.num_columns - 1).value_lengths().to_numpy().astype(np.int64) + 1)
        start = base = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, base + most - n, "right"))
            if stop > start or not held:
                stop = max(start + 1, stop)
                held.append(batch.slice(start, stop - start))
                n += int(ends[stop - 1]) - base
                start, base = stop, int(ends[stop - 1])
            if start < batch.num_rows:
                yield joined()
                held, n = [], 0
    if held:
        yield joined()


def _record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)], names=[name for name, _ in fields])


PARTS = "bucket int, n int, cells int, words binary, sizes binary, counts binary, slots binary, ns binary"


def _neighbours(window: int, slots: int, buckets: int) -> Callable[[Batches], Batches]:
    """A row per turn of texts and bucket of words: its words, how many slots each has, the slots and their counts."""

    def run(batches: Batches) -> Batches:
        for _, lengths, flat in _in_turn(batches, COUNTED_WORDS):
            text = np.repeat(np.arange(len(lengths)), lengths)
            coded = flat.dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            slot = hashed_slots(coded.dictionary, slots)[code]
            cells = [np.zeros(0, np.int64)]
            for away in range(1, min(window, len(code) - 1) + 1):
                same = np.flatnonzero(text[away:] == text[:-away])
                cells += [code[same] * slots + slot[same + away], code[same + away] * slots + slot[same]]
            cell, n = np.unique(np.concatenate(cells), return_counts=True)
            starts = np.flatnonzero(np.diff(cell // slots, prepend=-1))
            counts = np.diff(np.append(starts, len(cell)))
            words = coded.dictionary.take(pa.array(cell[starts] // slots))
            bucket = np.array([zlib.crc32(w) % buckets for w in words.cast(pa.binary()).to_pylist()], np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)):
                some = order[edges[b] : edges[b + 1]]
                at = ranges(starts[some], counts[some])
                packed = (planes(counts[some].astype(np.uint32)), planes((cell[at] % slots).astype(np.uint32)), planes(n[at]))
                rows.append((b, len(some), len(at), *packed_words(words.take(pa.array(some))), *packed))
            if rows:
                yield _record(rows, PARTS)

    return run


def _merged(slots: int) -> Callable[[Batches], Batches]:
    """A row (word, slots, ns) per word from the rows of _neighbours() in order of buckets."""

    def sums(rows: list[dict]) -> Batches:
        words = pa.concat_arrays([words_of(r["words"], r["sizes"], r["n"]) for r in rows])
        counts = np.concatenate([from_planes(r["counts"], r["n"], np.uint32) for r in rows])
        slot = np.concatenate([from_planes(r["slots"], r["cells"], np.uint32) for r in rows])
        ns = np.concatenate([from_planes(r["ns"], r["cells"], np.int64) for r in rows])
        coded = words.dictionary_encode()
        cell, place = np.unique(np.repeat(coded.indices.to_numpy().astype(np.int64), counts) * slots + slot, return_inverse=True)
        n = np.zeros(len(cell), np.int64)
        np.add.at(n, place, ns)
        starts = np.flatnonzero(np.diff(cell // slots, prepend=-1))
        words = coded.dictionary.take(pa.array(cell[starts] // slots)).cast(pa.string())
        ends = pa.array(np.append(starts, len(cell)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(a)) for a in ((cell % slots).astype(np.int32), n)]
        whole = pa.RecordBatch.from_arrays([words, *lists], names=["word", "slots", "ns"])
        for at in range(0, whole.num_rows, BATCH_WORDS):
            yield whole.slice(at, BATCH_WORDS)

    def run(batches: Batches) -> Batches:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield from sums(held)
                    held = []
                held.append(row)
        if held:
            yield from sums(held)

    return run


def _added_up(slots: int) -> Callable[[Batches], Batches]:
    """word, slot, n from rows (word, slots, ns) in order of words; the last word of a batch waits for the next one."""

    def sums(rows: pa.Table) -> pa.RecordBatch:
        word, listed, ns = (rows.column(c).combine_chunks() for c in ("word", "slots", "ns"))
        coded = word.dictionary_encode()
        code = np.repeat(coded.indices.to_numpy().astype(np.int64), listed.value_lengths().to_numpy())
        cell, place = np.unique(code * slots + listed.flatten().to_numpy(), return_inverse=True)
        n = np.zeros(len(cell), np.int64)
        np.add.at(n, place, ns.flatten().to_numpy())
        columns = [coded.dictionary.take(pa.array(cell // slots)).cast(pa.string()), pa.array((cell % slots).astype(np.int32)), pa.array(n)]
        return pa.RecordBatch.from_arrays(columns, names=["word", "slot", "n"])

    def run(batches: Batches) -> Batches:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column("word")
            others = np.flatnonzero(~pc.equal(word, word[-1]).to_numpy(zero_copy_only=False))
            last = int(others[-1]) + 1 if len(others) else 0
            if waiting and (last or waiting[0].column("word")[0] != word[-1]):
                yield sums(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
                waiting = []
            elif last:
                yield sums(pa.Table.from_batches([batch.slice(0, last)]))
            waiting.append(batch.slice(last))
        if waiting:
            yield sums(pa.Table.from_batches(waiting))

    return run


def _counts_by_word(titles: DataFrame, column: str, window: int, slots: int) -> DataFrame:
    """word, slots, ns: a row per word with all slots that stand beside it."""
    # A few bytes become many pairs here, so texts are dealt out by number, not by the size of their files.
    tasks = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = titles.select(F.col(column).alias("text")).repartition(tasks).select(title_words(F.col("text")).alias("words"))
    parts = texts.mapInArrow(_neighbours(window, slots, BUCKETS_PER_TASK * tasks), PARTS)
    return parts.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_merged(slots), "word string, slots array<int>, ns array<bigint>")


def context_counts(titles: DataFrame, column: str = "title", window: int = WINDOW, slots: int = SLOTS) -> DataFrame:
    """word, slot, n: how often a word of a slot stands up to `window` words away from the word, in the same text."""
    return _counts_by_word(titles, column, window, slots).mapInArrow(_added_up(slots), "word string, slot int, n bigint")


def _by_slot(slots: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        sums = np.zeros(slots, np.int64)
        for batch in batches:
            np.add.at(sums, batch.column("slots").flatten().to_numpy(), batch.column("ns").flatten().to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(slots, dtype=np.int32)), pa.array(sums)], names=["slot", "n"])

    return run


def _projected(signs: np.ndarray, n_slot: np.ndarray) -> Callable[[Batches], Batches]:
    """word, n, vector from (word, slots, ns): the sums of weight times signs."""
    by_dimension = np.ascontiguousarray(signs.T)

    def run(batches: Batches) -> Batches:
        n_all = float(n_slot.sum())
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_WORDS):
                some = batch.slice(at, BATCH_WORDS)
                slot, n = (some.column(c).flatten().to_numpy() for c in ("slots", "ns"))
                counts = some.column("slots").value_lengths().to_numpy()
                starts = np.cumsum(counts) - counts
                n_word = np.add.reduceat(n, starts)
                likely = n * n_all / (np.repeat(n_word, counts).astype(np.float64) * n_slot[slot])
                weight = np.where(likely > 1, np.floor(np.log(np.maximum(likely, 1)) * SCALE + 0.5), 0).astype(np.int64)
                sums = np.stack([np.add.reduceat(s[slot] * weight, starts) for s in by_dimension], axis=1)
                ends = pa.array(np.arange(some.num_rows + 1, dtype=np.int32) * len(by_dimension))
                yield pa.RecordBatch.from_arrays([some.column("word"), pa.array(n_word), pa.ListArray.from_arrays(ends, pa.array(sums.ravel()))], names=["word", "n", "vector"])

    return run


def word_vectors(
    titles: DataFrame, column: str = "title", window: int = WINDOW, slots: int = SLOTS, dimensions: int = DIMENSIONS
) -> DataFrame:
    """word, n (contexts), vector (whole numbers) of every word that has a word beside it."""
    counts = stored(_counts_by_word(titles, column, window, slots))
    # A row per slot; it does not grow with the data.
    by_slot = counts.select("slots", "ns").mapInArrow(_by_slot(slots), "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    n_slot = np.zeros(slots, np.int64)
    for r in by_slot.collect():
        n_slot[r["slot"]] = r["n"]
    signs = np.array([r["signs"] for r in projection(titles, dimensions, slots).orderBy("slot").collect()], np.int64)
    return counts.mapInArrow(_projected(signs, n_slot), "word string, n bigint, vector array<bigint>")


PLACED = "block bigint, n int, rows binary, lengths binary, n_known int, known binary, sizes binary, n_words int, codes binary"


def _blocks(most: int) -> Callable[[Batches], Batches]:
    """Texts (number, words) in a row per block: their numbers and lengths, the block's distinct words, and which each word is."""

    def run(batches: Batches) -> Batches:
        task = TaskContext.get().partitionId() << 33
        for number, ((rows,), lengths, flat) in enumerate(_in_turn(batches, most)):
            coded = flat.dictionary_encode()
            numbers = (len(rows), planes(rows.to_numpy()), planes(lengths.astype(np.uint32)))
            words = (len(coded.dictionary), *packed_words(coded.dictionary), len(flat), planes(coded.indices.to_numpy().astype(np.uint32)))
            yield _record([(task + number, *numbers, *words)], PLACED)

    return run


def _needed(batches: Batches) -> Batches:
    """block, code, word: the distinct words of each block."""
    for batch in batches:
        for row in batch.to_pylist():
            words = words_of(row["known"], row["sizes"], row["n_known"]).cast(pa.string())
            for at in range(0, len(words), 10 * BATCH_WORDS):
                some = words.slice(at, 10 * BATCH_WORDS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), row["block"])), pa.array(np.arange(at, at + len(some), dtype=np.int32)), some], names=["in_block", "code", "word"])


def _narrowed(batches: Batches) -> Batches:
    """word, length, packed: vectors in few bytes."""
    for batch in batches:
        if batch.num_rows:
            vectors = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("length"), pa.array(narrow_rows(vectors), pa.binary())], names=["word", "length", "packed"])


def _means(dimensions: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Means of the vectors (code, length, packed), each of length one, of the words of each text of a block."""

    def run(blocks: pa.Table, known: pa.Table) -> pa.Table:
        vectors = from_narrow(known.column("packed").to_pylist(), dimensions)
        length = known.column("length").to_numpy()
        rows, means = [], []
        for block in blocks.to_pylist():
            place = np.full(block["n_known"], -1, np.int32)
            place[known.column("code").to_numpy()[::-1]] = np.arange(known.num_rows)[::-1]
            code = place[from_planes(block["codes"], block["n_words"], np.uint32)]
            ends = np.cumsum(from_planes(block["lengths"], block["n"], np.uint32), dtype=np.int64)
            for row, start, end in zip(from_planes(block["rows"], block["n"], np.int64), np.append(0, ends[:-1]), ends):
                here = code[start:end]
                here = here[here >= 0]
                if len(here):
                    rows.append(row)
                    means.append((vectors[here] / length[here, None]).mean(0))
        flat = np.concatenate([np.zeros(0), *means])
        listed = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * dimensions, pa.int32()), pa.array(flat))
        return pa.table({"_row": pa.array(rows, pa.int64()), "features": listed})

    return run


def title_vectors(titles: DataFrame, vectors: DataFrame, column: str = "title", dimensions: int = DIMENSIONS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of titles with `features`: the mean of the vectors of their words, each of length one.

    Words without a vector count for nothing; a text without any other has zeros.  Vectors are sent once to each block
    of texts that has the word, as whole numbers in few bits, and added up there.
    """
    tasks = int(titles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = stored(titles.withColumn("_row", F.monotonically_increasing_id()))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    packed = vectors.select("word", "vector", length.alias("length")).where("length > 0").mapInArrow(_narrowed, "word string, length double, packed binary")
    texts = numbered.select("_row", F.col(column).alias("text")).repartition(tasks).select("_row", title_words(F.col("text")).alias("words"))
    placed = stored(texts.mapInArrow(_blocks(block_words), PLACED))
    needed = placed.select("block", "n_known", "known", "sizes").mapInArrow(_needed, "in_block bigint, code int, word string")
    # Spark takes what Python makes to be as small as its source, so neither side may be broadcast.
    known = needed.hint("merge").join(packed, "word").select("in_block", "code", "length", "packed")
    means = placed.groupBy("block").cogroup(known.groupBy("in_block")).applyInArrow(_means(dimensions), "_row bigint, features array<double>")
    zeros = F.array_repeat(F.lit(0.0), dimensions)
    return numbered.join(means, "_row", "left").withColumn("features", F.coalesce("features", zeros)).drop("_row")


def train_title_classifier(featured: DataFrame, label: str = "label") -> LogisticRegressionModel:
    """A classifier of title vectors; training passes over its rows several times, so they are stored first."""
    rows = stored(featured.select(F.col(label).cast("double").alias("label"), array_to_vector("features").alias("vector")))
    return LogisticRegression(featuresCol="vector", maxIter=50).fit(rows)


def classify_title_vectors(model: LogisticRegressionModel, featured: DataFrame) -> DataFrame:
    """The rows with their class and class probabilities instead of the features."""
    scored = model.transform(featured.withColumn("vector", array_to_vector("features")))
    kept = [c for c in featured.columns if c != "features"]
    return scored.select(*kept, F.col("prediction").cast("int").alias("predicted"), vector_to_array("probability").alias("probabilities"))
