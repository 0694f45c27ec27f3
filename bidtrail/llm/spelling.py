"""Spelling variants by a bit-sliced position index.

For a list of words the index holds one bitset per (position, letter): the words with that letter there.  A word is run
against the whole list at once: after each of its letters one bitset tells which words agree so far (no error), others
which agree but for one replaced letter, one letter more or one letter less; a step is a few bitwise operations on
whole bitsets, those of the last two with the index shifted by a position.

Words one error apart and of m letters, or of m and m + 1, share their first or last m // 2 letters.  So the vocabulary
is dealt into blocks by (m, side, these letters), and a block of more than TILE words into tiles of an index part and a
part to look up; none of them grows with the vocabulary.  In blocks by last letters, words that share the first ones
too are left out: their pair is found by those.  Words are numbered by falling count, so the most frequent neighbour is
the lowest bit, and every word leaves a tile with one row: its number of neighbours and the best one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import buckets_of, slices, texts, tuned

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5
DAMAGE = 199
TILE = 16384
CHUNK_BYTES = 4 << 20
RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
KEY = ["short", "side", "affix", "i", "j"]
BOTH, INDEX, QUERY = 0, 1, 2


def damaged(run: str, seed: int) -> str:
    """The run, without one letter if the CRC-32 that goes on from seed is a multiple of DAMAGE."""
    h = zlib.crc32(run.encode(), seed)
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", CHUNK_BYTES):
        total: Counter[str] = Counter()
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text"))):
            seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in Counter(RUN.findall(text.lower().decode())).items():
                total[damaged(run, seed)] += n
        words = [w for w in total if len(w) >= LEAST_LETTERS]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([total[w] for w in words], pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: runs of A-Z, a-z and U+00C0-U+00FF, A-Z in lower case, damaged by the rule of `damaged`, of at least
    LEAST_LETTERS letters and LEAST_COUNT occurrences.  Counted in each task before the shuffle."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _tiles(words: DataFrame, tile: int) -> DataFrame:
    """A row per word, tile and role, dealt out and sorted so that a tile's rows follow one another by falling count."""
    length = F.length("word")
    places = []
    for short in (length, length - 1):
        half = F.floor(short / 2).cast("int")
        places += [F.struct(short.alias("short"), F.lit(side).alias("side"), cut("word", half).alias("affix")) for side, cut in ((0, F.left), (1, F.right))]
    placed = words.select("word", "n", F.explode(F.array(*places)).alias("at")).select("word", "n", "at.*").where(F.col("short") >= LEAST_LETTERS)
    block = KEY[:3]
    large = placed.groupBy(*block).count().where(F.col("count") > tile).select(*block, F.ceil(F.col("count") / tile).cast("int").alias("parts"))
    placed = placed.join(large, block, "left").withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    zero = F.lit(0)
    whole = F.array(F.struct(zero.alias("i"), zero.alias("j"), F.lit(BOTH).alias("role")))
    others = F.sequence(zero, F.col("parts") - 1)
    as_index = F.transform(others, lambda x: F.struct(F.col("own").alias("i"), x.alias("j"), F.lit(INDEX).alias("role")))
    as_query = F.transform(others, lambda x: F.struct(x.alias("i"), F.col("own").alias("j"), F.lit(QUERY).alias("role")))
    dealt = placed.withColumn("tile", F.explode(F.when(F.col("parts").isNull(), whole).otherwise(F.concat(as_index, as_query)))).select(*block, "tile.*", "word", "n")
    return dealt.repartition(buckets_of(words.sparkSession), *KEY).sortWithinPartitions(*KEY, F.col("n").desc(), "word")


class PositionIndex:
    """Bitsets (whole numbers) of the words of a tile; word number w is bit 1 << w."""

    def __init__(self, words: list[str], short: int):
        self.every = (1 << len(words)) - 1
        self.sets: dict[tuple[int, str], int] = {}
        self.long = 0
        for number, word in enumerate(words):
            bit = 1 << number
            if len(word) > short:
                self.long |= bit
            for at in enumerate(word):
                self.sets[at] = self.sets.get(at, 0) | bit

    def near(self, word: str, short: int, agreed: int, apart: int) -> int:
        """The words one error from `word`: of `short` letters, and for a word of `short` letters those with one more.

        The first `agreed` letters are known to be shared; words that share the first `apart` letters are left out (0: none).
        """
        sets, exact, replaced, more, less, known = self.sets, self.every, 0, 0, 0, 0
        longer = len(word) > short
        for i in range(agreed, len(word)):
            here = sets.get((i, word[i]), 0)
            if longer:
                less = less & sets.get((i - 1, word[i]), 0) | exact
            else:
                replaced = replaced & here | exact & ~here
                more = (more | exact) & sets.get((i + 1, word[i]), 0)
            exact &= here
            if i + 1 == apart:
                known = exact
            if not (exact or replaced or more or less):
                return 0
        found = less & ~self.long if longer else replaced & ~self.long | (more | exact) & self.long
        return found & ~known


def _looked_up(key: tuple, rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    short, side, affix = key[:3]
    listed = [(word, n) for word, n, role in rows if role != QUERY]
    asked = [word for word, _, role in rows if role != INDEX]
    if not listed or len(rows) < 2:
        return
    index = PositionIndex([word for word, _ in listed], short)
    half = len(affix)
    for word in asked:
        found = index.near(word, short, half if side == 0 else 0, half if side == 1 else 0)
        if found:
            best = listed[(found & -found).bit_length() - 1]
            yield word, found.bit_count(), best[1], best[0]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles in order, to one row per word and tile; holds the rows of one tile at a time."""
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    key, rows = None, []

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        found = []
        for *at, word, n, role in zip(*(batch.column(c).to_pylist() for c in (*KEY, "word", "n", "role"))):
            if at != key:
                found += _looked_up(key, rows) if key else ()
                key, rows = at, []
            rows.append((word, n, role))
        if found:
            yield table(found)
    if key and (found := list(_looked_up(key, rows))):
        yield table(found)


def neighbours(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n_near, best_n, best of every word (word, n; distinct) that has a word one error away; ties go to the smallest."""
    found = _tiles(words, tile).mapInArrow(_neighbours, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("order"), "best", "best_n"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", "b.best_n", "b.best")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms that follow one another.

    A form is TIMES as frequent as its word, so chains have at most 27 steps, and each round doubles the steps taken.
    """
    state = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = stored(state.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if state.where("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def spelling_variants(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """A row per word of the vocabulary: word, form, root, n, n_near, form_n.

    form is the most frequent word one error away (ties: the smallest) if it is TIMES as frequent as the word, else
    null with form_n; root is the last form reached from the word, the word itself without a form; n_near counts the
    words one error away.  Null texts have no words, a null doc_id counts as an empty one, repeated rows count each,
    other columns are ignored; an empty table gives an empty one.
    """
    tuned(docs.sparkSession)
    words = stored(vocabulary(docs))
    found = stored(neighbours(words, tile))
    likely = F.col("best_n") >= TIMES * F.col("n")
    formed = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(likely, F.col("best")).alias("form"), F.when(likely, F.col("best_n")).alias("form_n")
    )
    formed = stored(formed)
    rooted = formed.join(_roots(formed.where("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
