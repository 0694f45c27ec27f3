"""Document fingerprints of closed syncmers.

A GRAM-byte string is chosen when its smallest inner INNER-byte hash is its first or its last one.  That depends on
the string alone, so an edit changes only the choices that overlap it, and the anchors keep their order.  The
fingerprint is the anchors' hashes in order of position; two fingerprints are compared by the longest run of common
anchors in the same order.

The edited text of a document needs the next document's.  Documents are dealt out by ranges of doc_id of about equal
bytes, each range also gets the first document of the next one, and every task walks its sorted rows once.  Rows of one
id that fill several ranges (those without an id, say) are spread over them by a hash of their text.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_of, tuned
from .repeats import MIX, gram_hashes, mixed, sliding_minimum

GRAM = 48
INNER = 16
SPAN = GRAM - INNER + 1
CHUNK_BYTES = 1 << 20
NO_ID = np.iinfo(np.int64).min
UNIT_BYTES = 4096  # ranges are even in units of so many bytes, one at least a document


def anchors(texts: list[bytes]) -> list[np.ndarray]:
    """The anchors of each text, in order of position; of a text without any, the hash of the whole; of none, nothing."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(lengths)
    places = hashes = np.zeros(0, np.int64)
    n = len(data) - GRAM + 1
    if n > 0:
        inner = gram_hashes(data, INNER)
        least = sliding_minimum(inner, SPAN)
        places = np.flatnonzero((inner[:n] == least) | (inner[SPAN - 1 : SPAN - 1 + n] == least))
        places = places[places + GRAM <= ends[np.searchsorted(ends, places, "right")]]
        hashes = mixed(inner[places] * MIX[0] + inner[places + INNER] * MIX[1] + inner[places + 2 * INNER]) >> np.uint64(32)
    cut = np.searchsorted(places, np.append(0, ends))
    out = []
    for text, x, y in zip(texts, cut, cut[1:]):
        whole = np.array([zlib.crc32(text)] if text else [], np.uint32)
        out.append(hashes[x:y].astype(np.uint32) if y > x else whole)
    return out


def as_text(hashes: np.ndarray) -> str:
    """Eight hex digits an anchor."""
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Twice the longest common run of anchors in order, over the number of both; 1 for two empty ones.

    The r-th occurrence of an anchor in one can only match its r-th occurrence in the other.
    """
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    common = np.intersect1d(a, b)
    if not len(common):
        return 0.0
    place: dict[tuple[int, int], int] = {}
    seen: dict[int, int] = {}
    for i in np.flatnonzero(np.isin(b, common)).tolist():
        h = int(b[i])
        seen[h] = seen.get(h, 0) + 1
        place[h, seen[h]] = i
    seen, tails = {}, []
    for h in a[np.isin(a, common)].tolist():
        seen[h] = seen.get(h, 0) + 1
        i = place.get((h, seen[h]))
        if i is not None:
            at = bisect_left(tails, i)
            tails[at : at + 1] = [i]
    return 2 * len(tails) / (len(a) + len(b))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


ROWS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0

    def flush(last: int) -> pa.RecordBatch:
        """Rows of held[:last]; each needs the row after it."""
        changed = [edited(held[i][2], held[i + 1][2]) if not held[i][3] else "" for i in range(last)]
        encoded = [t.encode() for t in changed]
        own = anchors([held[i][2].encode() for i in range(last + 1)])
        other = anchors(encoded)
        rows = [
            (held[i][1], len(held[i][2]), hashlib.sha256(encoded[i]).hexdigest(), as_text(own[i]), as_text(other[i]), likeness(own[i], other[i]), likeness(own[i], own[i + 1]))
            for i in range(last)
            if not held[i][3]
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in ROWS.split(", ")])

    for batch in batches:
        columns = [batch.column(c) for c in ("part", "doc_id", "text", "copied")]
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in columns)
            held.append(row)
            size += 4 * len(row[2])
            if size >= 4 * CHUNK_BYTES and len(held) > 1:
                yield flush(len(held) - 1)
                held, size = held[-1:], 4 * len(held[-1][2])
    if len(held) > 1:
        yield flush(len(held) - 1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of docs.

    The next document is the one with the next smaller doc_id, after the smallest the largest; a document alone is its
    own next.  Null text counts as empty and has an empty fingerprint.  Null ids come after all others; rows of one id
    are ordered by a hash of the text, the largest first.  An empty table gives an empty one; other columns are ignored.
    """
    spark = tuned(docs.sparkSession)
    ranges = buckets_of(spark)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), key.alias("key"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    shares = [i / ranges for i in range(1, ranges)]
    found = []
    if shares:
        units = F.sequence(F.lit(0), F.expr(f"octet_length(text) div {UNIT_BYTES}"))
        weighed = rows.select("key", F.explode(units))
        found = weighed.agg(F.percentile_approx("key", shares, max(10_000, 20 * ranges)).alias("s")).first()["s"] or []
    splits = np.array(found, np.int64)

    def parts_of(keys: pd.Series, hashes: pd.Series) -> np.ndarray:
        """The range of each row; a key that is several splits has as many ranges, equal parts of the hash's values."""
        keys = keys.to_numpy()
        first = np.searchsorted(splits, keys, "left")
        times = np.searchsorted(splits, keys, "right") - first
        upper = (hashes.to_numpy().view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
        return (first + (upper * times.astype(np.uint64) >> np.uint64(32)).astype(np.int64)).astype(np.int32)

    part_of = F.pandas_udf(lambda keys, hashes: pd.Series(parts_of(keys, hashes)), "int")
    top = F.max(F.struct("key", "hash")).alias("top")
    tops = {r["part"]: tuple(r["top"]) for r in rows.groupBy(part_of("key", "hash").alias("part")).agg(top).collect()}  # a row per range
    order = sorted(tops, reverse=True)
    wanted: dict[tuple[int, int], list[int]] = {}
    for part, after in zip(order, order[1:] + order[:1]):
        wanted.setdefault(tops[after], []).append(part)

    def places(keys: pd.Series, hashes: pd.Series) -> pd.Series:
        parts = parts_of(keys, hashes)
        return pd.Series([[p, *wanted.get(row, ())] for p, row in zip(parts.tolist(), zip(keys.tolist(), hashes.tolist()))])

    dealt = rows.select("doc_id", "text", "key", "hash", F.posexplode(F.pandas_udf(places, "array<int>")("key", "hash")).alias("copied", "part"))
    dealt = dealt.withColumn("copied", F.col("copied") > 0)
    walked = dealt.repartitionById(ranges, "part").sortWithinPartitions("part", "copied", F.desc("key"), F.desc("hash"), "text")
    return walked.select("part", "doc_id", "text", "copied").mapInArrow(_walk, ROWS)
