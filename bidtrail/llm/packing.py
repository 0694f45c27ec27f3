"""Packing of documents into training windows by the sum-of-squares rule, online and without a shuffle.

Every task packs the rows it reads.  What of a document fills whole windows is cut off; the rest goes, in order of
arrival, to the fill level that makes the sum of squared counts of partly filled windows smallest (N(h) windows are
filled to level h; the counts are one array).  At most OPEN_WINDOWS are open.  Where the rule would open one more, a
piece may also be cut so that it closes a window; the level is again the one that leaves the smallest sum, and what is
cut off is placed by the rule in its turn.  At the end of a task the bound falls to one, window by window: the pieces of
the emptiest are placed again by the same rule.  The ids of the very last window are cut into pieces whose lengths are
powers of two, so nothing is padded.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, tuned

WINDOW = 2048
END_ID = 1
OPEN_WINDOWS = 512
CHUNK_BYTES = 1 << 20
NEVER = np.iinfo(np.int64).max
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
NAMES = [c.split()[0] for c in PIECES.split(", ")]


class Vocabulary:
    """Ids of texts.  The rank file gives the ids of the tokenizer file in less time; what it refuses goes to the latter."""

    def __init__(self, json_path: str, ranks_path: str | None):
        self.json_path, self._slow, self._fast = json_path, None, None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            special = {"<|endoftext|>": len(ranks)}
            self._fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if self._fast is not None:
            try:
                return self._fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32)
            except ValueError:  # a text its pattern matcher gives up on
                pass
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.json_path)
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


class Packer:
    """Windows of one task.  A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, first_sequence: int, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.open_windows = window, open_windows
        self.next = first_sequence
        self.counts = np.zeros(window + 1, np.int64)
        self.held: list[list[list]] = [[] for _ in range(window + 1)]
        self.open = 0
        self.rows: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def level_for(self, size: int) -> int:
        """The level (0: a new window) at which a piece raises the sum of squared counts least; ties to the fullest."""
        change = self._changes(size)
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def _changes(self, size: int) -> np.ndarray:
        """By how much the sum of squared counts rises if a whole piece goes to each level from 0 to window - size."""
        n, w = self.counts, self.window
        change = 2 * n[size : w + 1] + 1 - 2 * n[: w + 1 - size] + 1
        change[-1] -= 2 * n[w] + 1  # a full window is not counted
        change[0] += 2 * n[0] - 1  # nor is an empty one
        change[1:][n[1 : w + 1 - size] == 0] = NEVER
        return change

    def level_at_bound(self, size: int) -> int:
        """As level_for, without a new window; above window - size the piece is cut and closes a window.

        Ties go to a level that takes the piece whole, then to the fullest.
        """
        whole = self._changes(size)
        whole[0] = NEVER
        held = self.counts[self.window + 1 - size : self.window]
        cut = np.where(held > 0, 1 - 2 * held, NEVER)
        best = int(len(whole) - 1 - np.argmin(whole[::-1]))
        if len(cut) and cut.min() < whole[best]:
            return int(self.window - 1 - np.argmin(cut[::-1]))
        return best

    def _put(self, level: int, piece: tuple) -> None:
        window = self._take(level) if level else []
        window.append(piece)
        level += len(piece[2])
        if level == self.window:
            self._close(window)
        else:
            self.held[level].append(window)
            self.counts[level] += 1
            self.open += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.window:
            self._close([(doc_id, at, ids[at : at + self.window], total)])
            at += self.window
        self._place((doc_id, at, ids[at:], total), self.open_windows)

    def _place(self, piece: tuple, most: int) -> None:
        """Put a piece by the rule, cut where it must be, with at most `most` windows open."""
        doc_id, start, ids, total = piece
        while len(ids):
            level = self.level_for(len(ids))
            if level == 0 and self.open >= most:
                level = self.level_at_bound(len(ids))
            part, ids = ids[: self.window - level], ids[self.window - level :]
            self._put(level, (doc_id, start, part, total))
            start += len(part)

    def finish(self) -> None:
        """Place the pieces of the emptiest window again until one is open, and cut that into powers of two."""
        while self.open > 1:
            level = int(np.flatnonzero(self.counts)[0])
            window = self._take(level)
            most = self.open
            for piece in sorted(window, key=lambda p: -len(p[2])):
                self._place(piece, most)
        for level in np.flatnonzero(self.counts):
            self._cut(self._take(int(level)), int(level))

    def _take(self, level: int) -> list:
        """An open window of a level, which is open no more."""
        self.counts[level] -= 1
        self.open -= 1
        return self.held[level].pop()

    def _cut(self, pieces: list, left: int) -> None:
        """Close windows that hold these pieces in order, of lengths that are powers of two, the largest first."""
        window, room = [], 1 << left.bit_length() - 1
        for doc_id, start, ids, total in pieces:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                window.append((doc_id, start, part, total))
                start += len(part)
                room -= len(part)
                left -= len(part)
                if room == 0:
                    self._close(window)
                    window, room = [], 1 << max(0, left.bit_length() - 1)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[]] * len(NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)


def pack(docs: DataFrame, json_path: str, ranks_path: str | None = None, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece, no padding at all.

    A document is its ids and END_ID; null and empty texts are END_ID alone, so every row of docs gives a piece.  A
    null doc_id stays null.  Repeated rows are packed one by one.  Sequence numbers hold the task's number, so they are
    unique, and the same when a lost task runs again.  An empty table gives an empty one; other columns are ignored.
    """
    if window & (window - 1) or open_windows < 1:
        raise ValueError("window must be a power of two, and one window at least open")
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(json_path, ranks_path)
        packer = Packer(TaskContext.get().partitionId() << 32, window, open_windows)
        for batch in slices(batches, "text", CHUNK_BYTES):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                packer.add(doc_id, np.append(vocabulary.ids(text), np.uint32(END_ID)))
            yield packer.batch()
        packer.finish()
        yield packer.batch()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, PIECES)
