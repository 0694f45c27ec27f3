"""Quality rules on repetition inside a document, by suffix arrays of its words.

The words of a piece of a batch are ranked by prefix doubling (1, 2, 4, ... words, never past the end of a document),
which gives their suffix array; the ranks of all levels give the longest common prefixes of neighbours.  A suffix's
longest match is the value of the deepest common-prefix interval it lies in; the repeat is maximal where the suffix one
word before does not match one word more.  The spans of the maximal repeats are united.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, tuned, utf8, word_starts
from .repeats import MIX, mixed, powers

U = np.uint64
BASE, BASE_INVERSE = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64)
CHUNK_BYTES = 1 << 19
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Limits of the verdict: repeats count from MIN_REPEAT words on; they may cover MAX_COVERED of the words, and the
# longest one MAX_LONGEST of them, unless it is shorter than LONG_REPEAT words.
MIN_REPEAT = 6
MAX_COVERED = 0.3
MAX_LONGEST = 0.2
LONG_REPEAT = 16
SYMBOLS = b"#*$%&|<>"


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each range, the same wherever it stands."""
    n = len(data)
    table = mixed(np.arange(1, 257, dtype=U) * MIX[0])
    sums = np.zeros(n + 1, U)
    np.cumsum(table[data] * powers(BASE, n), out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(BASE_INVERSE, n + 1)[starts]
    return mixed(value + (ends - starts).astype(U) * MIX[1])


def suffix_levels(symbols: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... symbols, until all differ.

    ends: where the document of each position ends; a suffix that ends early differs from all others.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    value = symbols[order]
    new = np.ones(n, bool)
    new[1:] = value[1:] != value[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels = [rank]
    alone = new & np.append(new[1:], True)
    active = order[~alone]
    step = 1
    while len(active):
        following = active + step
        inside = following < ends[active]
        second = np.where(inside, rank[np.minimum(following, n - 1)] + 1, 0)
        composite = rank[active] * (n + 1) + second
        order = np.argsort(composite, kind="stable")
        active, composite = active[order], composite[order]
        first = rank[active]
        new = np.ones(len(active), bool)
        new[1:] = composite[1:] != composite[:-1]
        group = np.ones(len(active), bool)
        group[1:] = first[1:] != first[:-1]
        at = np.arange(len(active))
        offset = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[active] = first + offset
        levels.append(rank)
        active = active[~(new & np.append(new[1:], True))]
        step *= 2
    return levels


def longest_matches(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the longest match of its suffix with another suffix: the larger common prefix of its two
    neighbours in suffix order."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    levels = suffix_levels(symbols, ends)
    order = np.argsort(levels[-1], kind="stable")
    common = np.zeros(n + 1, np.int64)  # common[k]: of the suffixes k - 1 and k in order
    pairs = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b = order[:-1][pairs], order[1:][pairs]
    end_a, end_b = ends[a], ends[b]
    length = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a + (1 << k) <= end_a) & (b + (1 << k) <= end_b)
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        step = same.astype(np.int64) << k
        a, b, length = a + step, b + step, length + step
    common[pairs + 1] = length
    longest = np.empty(n, np.int64)
    longest[order] = np.maximum(common[:-1], common[1:])
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in the spans."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + lengths, -1)
    return np.cumsum(marks)[:n] > 0


ROWS = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, covered_fraction double, longest_repeat bigint"
)


def measures(data: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of ROWS but doc_id, for texts laid end to end."""
    docs = len(lengths)
    firsts = np.cumsum(lengths) - lengths
    starts, n_words = word_starts(data, lengths)
    doc = np.repeat(np.arange(docs), n_words)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[firsts + lengths] - sums[firsts]

    blank = (data == 32) | ((data >= 9) & (data <= 13))
    stops = np.flatnonzero(blank)
    next_stop = np.append(stops, len(data))[np.searchsorted(stops, starts)] if len(starts) else starts
    word_ends = np.minimum(next_stop, (firsts + lengths)[doc])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    words = mixed(range_hashes(data, starts, word_ends) + doc.astype(U) * MIX[2])
    base = np.cumsum(n_words) - n_words
    ends = (base + n_words)[doc]
    longest = longest_matches(words, ends)
    n = len(words)

    def words_in(spans: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(covered(spans, longest[spans], n))])
        return sums[base + n_words] - sums[base]

    repeat_words = words_in(np.flatnonzero(longest >= REPEAT_WINDOW))
    before = np.zeros(n, np.int64)
    before[1:] = longest[:-1]
    if n:
        before[base[n_words > 0]] = 0
    maximal = np.flatnonzero((longest >= MIN_REPEAT) & (before != longest + 1))
    covered_words = words_in(maximal)
    longest_repeat = np.zeros(docs, np.int64)
    np.maximum.at(longest_repeat, doc, longest)

    # Lines that hold a word, against earlier ones of the same text.
    breaks = data == 10
    line_starts = np.unique(np.concatenate([firsts[lengths > 0], np.flatnonzero(breaks) + 1])).astype(np.int64)
    line_doc = np.searchsorted(firsts + lengths, line_starts, "right")
    line_starts, line_doc = line_starts[line_doc < docs], line_doc[line_doc < docs]
    stops = np.append(np.flatnonzero(breaks), len(data))
    line_ends = np.minimum(stops[np.searchsorted(stops, line_starts)], (firsts + lengths)[line_doc])
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_doc = line_starts[with_word], line_ends[with_word], line_doc[with_word]
    lines = mixed(range_hashes(data, line_starts, line_ends) + line_doc.astype(U) * MIX[2])
    once = np.unique(lines, return_index=True)[1]
    dup_lines = np.bincount(line_doc, minlength=docs) - np.bincount(line_doc[once], minlength=docs)

    base_failed = (n_words < MIN_WORDS) | (100 * repeat_words > MAX_REPEAT_PERCENT * n_words)
    fraction = covered_words / np.maximum(n_words, 1)
    bad = (fraction > MAX_COVERED) | ((longest_repeat >= LONG_REPEAT) & (longest_repeat > MAX_LONGEST * n_words))
    return {
        "n_words": n_words,
        "word_chars": per_doc(~blank & ((data & 0xC0) != 0x80)),
        "n_symbols": per_doc(symbol[data]),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat_words,
        "base_failed": base_failed,
        "kept": ~base_failed & ~bad,
        "covered_fraction": fraction,
        "longest_repeat": longest_repeat,
    }


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdict of each row of docs (columns of ROWS); kept is false if the base rules or the repeats say so.

    covered_fraction: share of words in maximal repeats of MIN_REPEAT words or more, first occurrence included;
    longest_repeat: words of the longest one.  Null and empty texts have counts 0 and fail the base rules.  Repeated
    rows and null ids are judged like others; an empty table gives an empty one; other columns are ignored.
    """
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CHUNK_BYTES):
            found = measures(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, found.values())], names=["doc_id", *found])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ROWS)
