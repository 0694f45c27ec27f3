"""Removal of repeated passages by longest previous factors in suffix order.

A byte goes when a WINDOW-byte string that covers it also starts in a document with a smaller id.  One suffix array of
the whole corpus would not fit a machine, so its suffixes are dealt out by content: the smallest hash of the GRAM-byte
strings inside a window is the same for equal windows, hence equal windows meet in one bucket.  Neighbouring windows
mostly share that smallest hash and travel together as one segment.

1. Documents are packed into blocks and stored once.  CHUNK_BLOCKS of them send, and are answered, together: what one
   sends to one of very many buckets would be a row of a few bytes.
2. Each block sends two hashes of its segments, of the smallest gram and of the content, equal ones once with their
   smallest document id.  A bucket answers which blocks hold a segment that an earlier document has whole, and which
   segments share their smallest gram with another segment of another document.  All else never moves again.
3. The first holder of such a segment sends its bytes.  A bucket sorts the suffixes of its segments by prefix doubling
   and finds each one's longest previous factor: the longer of its common prefixes with the previous and the next suffix
   of a smaller document in that order.  Windows with a factor of WINDOW bytes go.
4. Each block marks its bytes with the answers.

A hash with very many different segments would make a large bucket in step 3: their windows are dealt out one by one
by their own whole content instead.  In step 2 a block sends one entry for a segment however many documents hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.packed import from_planes, planes, ranges, squeezed
from ..session import passing, stored
from .common import buckets_of, tuned, utf8

WINDOW = 50
GRAM = 20
SPAN = WINDOW - GRAM + 1
BLOCK_BYTES = 1 << 20
CHUNK_BLOCKS = 16  # a power of two, so that the numbers of a task's blocks begin with a whole chunk; at most 256
LEVEL = 4  # of zstd, for texts: an eighth less than level 1 where they are stored and shuffled
LOOK_BYTES = 32 << 20  # text that a chunk holds at once while it sends segments
LONGEST_RUN = 256
HOT_CONTENTS = 2_000
BUCKETS_PER_PARTITION = 4  # so that a group is a fraction of what a shuffle partition is sized for
BUCKET_BYTES = 64 << 20  # most text, on average, that a bucket answers for, whatever the number of partitions
LAST_ID = np.iinfo(np.int64).max
U = np.uint64
MIX = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93))
BASE = 0x2545F4914F6CDD1D
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> U(32))
    values *= MIX[2]
    return values ^ (values >> U(29))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def grams8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number in byte order."""
    a = data.astype(U)
    a = (a[:-1] << U(8)) | a[1:]
    a = (a[:-2] << U(16)) | a[2:]
    return (a[:-4] << U(32)) | a[4:]


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes (16 to 24) from each position on."""
    eight = grams8(data)
    n = len(data) - size + 1
    pair = (eight[:n] * MIX[0]) ^ ((eight[8 : 8 + n] + MIX[2]) * MIX[1])
    return mixed(pair if size == 16 else pair + eight[size - 8 : size - 8 + n] * MIX[2])


def sliding_minimum(values: np.ndarray, span: int) -> np.ndarray:
    """Smallest of the `span` values from each position on."""
    width, least = 1, values
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    n = len(values) - span + 1
    return np.minimum(least[:n], least[span - width : span - width + n])


class Segments:
    """Runs of windows of one block that share their smallest gram hash: key, first and last window, document."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self.data, self.ends = data, np.cumsum(lengths)
        n = len(data) - WINDOW + 1
        if n <= 0:
            self.hashes, self.keys = np.zeros(0, U), np.zeros(0, U)
            self.first = self.last = self.doc = np.zeros(0, np.int64)
            return
        self.hashes = gram_hashes(data, GRAM)
        least = sliding_minimum(self.hashes, SPAN)
        crossing = np.zeros(len(data) + 1, np.int32)
        np.add.at(crossing, np.maximum(0, self.ends - WINDOW + 1), 1)
        np.add.at(crossing, self.ends, -1)
        inside = np.cumsum(crossing)[:n] == 0
        change = np.ones(n, bool)
        change[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
        first = np.flatnonzero(change & inside)
        stop = np.ones(n, bool)
        stop[:-1] = change[1:] | ~inside[1:]
        last = np.flatnonzero(stop & inside)
        pieces = (last - first) // LONGEST_RUN + 1
        if pieces.max(initial=1) > 1:
            part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, last = np.repeat(first, pieces) + part * LONGEST_RUN, np.repeat(last, pieces)
            last = np.minimum(last, first + LONGEST_RUN - 1)
        # The smallest of many hashes is small, so it is mixed again to deal buckets out evenly.
        self.first, self.last, self.keys = first, last, mixed(least[first] * MIX[0])
        self.doc = np.searchsorted(self.ends, first, "right")

    def contents(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the bytes of segments, the same wherever they stand."""
        n = len(self.hashes)
        sums = np.zeros(n + 1, U)
        np.cumsum(self.hashes * powers(BASE, n), out=sums[1:])
        value = (sums[last + SPAN] - sums[first]) * powers(BASE_INVERSE, n + 1)[first]
        return mixed(value + (last - first).astype(U) * MIX[0])


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range begins in sorted keys."""
    return np.searchsorted((keys >> U(32)) * U(buckets) >> U(32), np.arange(buckets + 1).astype(U))


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags_of(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


# Blocks ---------------------------------------------------------------------------------------------------------


def pack_blocks(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Documents packed into blocks of about BLOCK_BYTES and stored: chunk, block, size in bytes, ids, lengths, data, rest."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(F.lit(0).alias("_"), *carry).alias("rest")
    )
    rest = rows.schema["rest"].dataType
    schema = T.StructType(
        [
            T.StructField("size", T.LongType()),
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("lengths", T.BinaryType()),
            T.StructField("data", T.BinaryType()),
            T.StructField("rest", T.ArrayType(rest)),
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            data, lengths = utf8(rows.column("text"))
            lists = [pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(c).combine_chunks()) for c in ("doc_id", "rest")]
            blob = squeezed(data.tobytes(), LEVEL) if len(data) else b""
            arrays = [pa.array([len(data)], pa.int64()), lists[0], pa.array([lengths.astype(np.int64).tobytes()], pa.binary()), pa.array([blob], pa.binary()), lists[1]]
            return pa.RecordBatch.from_arrays(arrays, names=["size", "ids", "lengths", "data", "rest"])

        for batch in batches:
            ends = np.cumsum(utf8(batch.column("text"))[1])
            start = 0
            while start < batch.num_rows:
                base = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_BYTES - size, "right")))
                held.append(batch.slice(start, stop - start))
                size += int(ends[stop - 1]) - base
                start = stop
                if size >= BLOCK_BYTES or start < batch.num_rows:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    packed = rows.mapInArrow(pack, schema)
    numbered = packed.withColumn("block", F.monotonically_increasing_id())
    return stored(numbered.withColumn("chunk", F.expr(f"block div {CHUNK_BLOCKS}")))


def opened(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, lengths and ids of a block's documents; a null id comes after all others."""
    lengths = np.frombuffer(block["lengths"], np.int64)
    size = int(lengths.sum())
    data = np.frombuffer(pa.decompress(block["data"], size, "zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    return data, lengths, np.array([LAST_ID if i is None else i for i in block["ids"]], np.int64)


# Step 2: the first document of every segment, and which segments need a closer look ------------------------------

KEYS = "chunk bigint, bucket int, n int, places binary, counts binary, keys binary, contents binary, n_docs int, docs binary, which binary"
ANSWERS = "chunk bigint, kind int, bucket int, n int, places binary, counts binary, flags binary, more binary"
EARLIER, CLOSER, HOT = 0, 1, 2


class Entries:
    """Distinct segments of a block in order of key and content, each with its smallest document id.

    number: entry of each segment; start, length: where its bytes stand.
    """

    def __init__(self, segments: Segments, ids: np.ndarray):
        content = segments.contents(segments.first, segments.last)
        order = np.lexsort((content, segments.keys))
        key, content = segments.keys[order], content[order]
        new = changes(key, content)
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        self.key, self.content = key[at], content[at]
        self.doc = np.minimum.reduceat(ids[segments.doc[order]], at) if len(at) else np.zeros(0, np.int64)
        self.start = segments.first[order[at]]
        self.length = segments.last[order[at]] - self.start + WINDOW


def changes(*columns: np.ndarray) -> np.ndarray:
    """True at the first of each run of equal rows."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def arrow_table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.Table.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Blocks of one chunk that come one after the other."""
    held: list[dict] = []
    for batch in batches:
        for block in batch.to_pylist():
            if held and held[0]["chunk"] != block["chunk"]:
                yield held
                held = []
            held.append(block)
    if held:
        yield held


def place_of(block: dict) -> int:
    """Which of its chunk a block is."""
    return block["block"] % CHUNK_BLOCKS


class Dealt:
    """What blocks of a chunk send, bucket by bucket and there block by block.

    order: numbers of what they have, counted over the blocks one after the other, in the order in which it is sent.
    """

    def __init__(self, blocks: list[dict], edges: list[np.ndarray]):
        edges = np.stack(edges)
        self.places = np.array([place_of(block) for block in blocks], np.uint8)
        self.counts = np.diff(edges, axis=1)
        base = np.cumsum(edges[:, -1]) - edges[:, -1]
        self.order = ranges((base[:, None] + edges[:, :-1]).T.ravel(), self.counts.T.ravel())
        self.ends = np.append(0, np.cumsum(self.counts.sum(axis=0)))

    def __iter__(self) -> Iterator[tuple[int, int, int, bytes, bytes]]:
        """(bucket, begin, end, places, counts) of the buckets that are not empty: the blocks that send, and how much each."""
        for b in np.flatnonzero(np.diff(self.ends)):
            some = np.flatnonzero(self.counts[:, b])
            yield int(b), int(self.ends[b]), int(self.ends[b + 1]), self.places[some].tobytes(), self.counts[some, b].astype(np.uint32).tobytes()


def send_keys(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in chunks(batches):
            edges, columns = [], []
            for block in blocks:
                data, lengths, ids = opened(block)
                entries = Entries(Segments(data, lengths), ids)
                edges.append(bucket_edges(entries.key, buckets))
                columns.append((entries.key.astype(np.uint32), entries.content, entries.doc))
            dealt = Dealt(blocks, edges)
            key, content, doc = (np.concatenate(c)[dealt.order] for c in zip(*columns))
            rows = []
            for b, x, y, places, counts in dealt:
                docs, which = np.unique(doc[x:y], return_inverse=True)
                # Steps from id to id, that wrap around like the sums that undo them.
                steps = np.diff(docs.view(U), prepend=U(0))
                packed = (len(docs), planes(steps), planes(which.astype(np.uint32)))
                rows.append((blocks[0]["chunk"], b, y - x, places, counts, key[x:y].tobytes(), content[x:y].tobytes(), *packed))
            yield from arrow_table(rows, KEYS).to_batches()

    return send


def find_repeated(hot_contents: int):
    def find(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        docs = []
        for r in rows:
            ids = np.cumsum(from_planes(r["docs"], r["n_docs"], U)).view(np.int64)
            docs.append(ids[from_planes(r["which"], r["n"], np.uint32)])
        key = np.concatenate([np.frombuffer(r["keys"], np.uint32) for r in rows])
        content = np.concatenate([np.frombuffer(r["contents"], U) for r in rows])
        doc = np.concatenate(docs)
        order = np.lexsort((doc, content, key))
        key, content, doc = key[order], content[order], doc[order]
        new = changes(key, content)
        at = np.flatnonzero(new)
        first = doc[at]
        group = np.flatnonzero(changes(key[at]))
        sizes = np.diff(np.append(group, len(at)))
        alike = np.minimum.reduceat(first, group) == np.maximum.reduceat(first, group)
        # Only the first document that holds a content looks closer, and only where its key has other contents of other documents.
        closer = np.repeat(~alike, sizes)
        hot = closer & np.repeat(sizes >= hot_contents, sizes)
        number = np.cumsum(new) - 1
        flags = np.zeros((3, len(key)), bool)
        flags[EARLIER, order] = first[number] < doc
        holds = first[number] == doc
        flags[CLOSER, order] = holds & closer[number]
        flags[HOT, order] = holds & hot[number]
        out, stop = [], 0
        for r in rows:
            own = flags[:, stop : stop + r["n"]]
            stop += r["n"]
            if own.any():
                out.append((r["chunk"], 1, r["bucket"], r["n"], r["places"], r["counts"], bits(own), None))
        return arrow_table(out, ANSWERS)

    return find


class Pieces:
    """Runs of what one block of a chunk sent to one bucket, as answers list them: place, bucket, length, and start over all."""

    def __init__(self, answers: list[dict]):
        places, counts = ([np.frombuffer(a[c], kind) for a in answers] for c, kind in (("places", np.uint8), ("counts", np.uint32)))
        self.bucket = np.repeat([a["bucket"] for a in answers], [len(p) for p in places]).astype(np.int64)
        self.place, self.length = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (places, counts))
        self.start = np.cumsum(self.length) - self.length


class Answers:
    """What came back to a chunk.  flags: of the entries of all pieces; found: (piece, number in it, first, last window)."""

    def __init__(self, answers: pa.Table):
        rows = answers.to_pylist()
        whole, looked = ([a for a in rows if a["kind"] == kind] for kind in (1, 2))
        self.whole, self.looked = Pieces(whole), Pieces(looked)
        self.flags = np.concatenate([np.zeros((3, 0), bool), *(flags_of(a["flags"], 3 * a["n"]).reshape(3, -1) for a in whole)], axis=1)
        before = np.cumsum([0] + [a["n"] for a in looked])
        found = [np.frombuffer(a["more"], np.int32).reshape(-1, 3) + [n, 0, 0] for a, n in zip(looked, before)]
        number, first, last = np.concatenate([np.zeros((0, 3), np.int64), *found]).T
        piece = np.searchsorted(self.looked.start, number, "right") - 1
        self.found = piece, number - self.looked.start[piece], first, last

    def flags_of_entries(self, entries: Entries, place: int, buckets: int) -> np.ndarray:
        flags = np.zeros((3, len(entries.key)), bool)
        own = np.flatnonzero(self.whole.place == place)
        start, length = bucket_edges(entries.key, buckets)[self.whole.bucket[own]], self.whole.length[own]
        flags[:, ranges(start, length)] = self.flags[:, ranges(self.whole.start[own], length)]
        return flags

    def windows(self, looks: Looks, place: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(look, first, last window) that go of a block's looks."""
        piece, number, first, last = self.found
        own = self.looked.place[piece] == place
        return looks.edges[self.looked.bucket[piece[own]]] + number[own], first[own], last[own]


# Step 3: windows that an earlier document has ----------------------------------------------------------------------

ENTRIES = "chunk bigint, bucket int, n int, places binary, counts binary, docs binary, lengths binary, data binary"


class Looks:
    """What a block sends for a closer look, in order of bucket: segments, and windows of hot segments one by one.

    entry, offset: the entry each stands for and the first window in it.
    """

    def __init__(self, segments: Segments, entries: Entries, flags: np.ndarray, buckets: int):
        plain, hot = np.flatnonzero(flags[CLOSER] & ~flags[HOT]), np.flatnonzero(flags[HOT])
        windows = entries.length[hot] - WINDOW + 1
        at = ranges(entries.start[hot], windows)
        self.entry = np.concatenate([plain, np.repeat(hot, windows)])
        self.offset = np.concatenate([np.zeros(len(plain), np.int64), at - np.repeat(entries.start[hot], windows)])
        self.start = np.concatenate([entries.start[plain], at])
        self.length = np.concatenate([entries.length[plain], np.full(len(at), WINDOW)])
        key = np.concatenate([entries.key[plain], mixed(segments.contents(at, at) + MIX[1])])
        order = np.lexsort((self.start, key))
        self.entry, self.offset, self.start, self.length = (x[order] for x in (self.entry, self.offset, self.start, self.length))
        self.edges = bucket_edges(key[order], buckets)


def send_looks(buckets: int):
    def rows_of(blocks: list[dict], edges: list[np.ndarray], columns: list[tuple]) -> list[tuple]:
        dealt = Dealt(blocks, edges)
        docs, sizes, text = map(np.concatenate, zip(*columns))
        begins = (np.cumsum(sizes) - sizes)[dealt.order]
        docs, sizes = docs[dealt.order], sizes[dealt.order]
        rows = []
        for b, x, y, places, counts in dealt:
            part = text[ranges(begins[x:y], sizes[x:y])].tobytes()
            rows.append((blocks[0]["chunk"], b, y - x, places, counts, planes(docs[x:y]), sizes[x:y].astype(np.uint16).tobytes(), squeezed(part, LEVEL)))
        return rows

    def send(key: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows, held, edges, columns, size = [], [], [], [], 0
        answered = Answers(answers)
        for block in sorted(blocks.to_pylist(), key=place_of) if answers.num_rows else []:
            data, lengths, ids = opened(block)
            segments = Segments(data, lengths)
            entries = Entries(segments, ids)
            looks = Looks(segments, entries, answered.flags_of_entries(entries, place_of(block), buckets), buckets)
            held.append(block)
            edges.append(looks.edges)
            columns.append((entries.doc[looks.entry], looks.length, data[ranges(looks.start, looks.length)]))
            size += len(columns[-1][2])
            if size >= LOOK_BYTES:
                rows += rows_of(held, edges, columns)
                held, edges, columns, size = [], [], [], 0
        if held:
            rows += rows_of(held, edges, columns)
        return arrow_table(rows, ENTRIES)

    return send


def suffix_order(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes starting at `at` in order of their first WINDOW bytes, by prefix doubling, and common prefixes.

    The second array holds, for each place in that order, how many bytes (WINDOW at most) the suffix shares with the one
    before it; 0 at the first place.  The ranks of the doubling tell, and inside the last eight bytes the bytes do.
    """
    data = np.append(data, np.zeros(WINDOW, np.uint8))
    eight = grams8(data)
    ranks = {8: np.unique(eight, return_inverse=True)[1].astype(np.uint32)}
    for step in (8, 16):
        ranks[2 * step] = np.unique(paired(ranks[step][:-step], ranks[step][step:]), return_inverse=True)[1].astype(np.uint32)
    order = np.argsort(paired(ranks[32][at], ranks[32][at + WINDOW - 32]), kind="stable")
    left, right = at[order[:-1]], at[order[1:]]
    shared = np.zeros(len(left), np.int64)
    for step in (32, 16, 8):
        shared += step * (ranks[step][left + shared] == ranks[step][right + shared])
    inside = np.flatnonzero(shared < WINDOW - 1)
    differing = eight[left[inside] + shared[inside]] ^ eight[right[inside] + shared[inside]]
    for bits_left in range(8, 64, 8):
        shared[inside] += (differing >> U(64 - bits_left)) == 0
    common = np.zeros(len(order), np.uint8)
    common[1:] = np.minimum(shared, WINDOW)
    return order, common


def paired(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high.astype(U) << U(32)) | low


def previous_smaller(values: np.ndarray, common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the last place before it with a smaller value, and the common prefix of the two.

    common[i]: common prefix of places i-1 and i.  Where the common prefix with such a place would be below `least`, the
    place is -1 and the prefix 0.  All places search at once: minima over 1, 2, 4, ... places are built up to the longest
    stretch that shares `least` bytes, and each place steps back over the largest of them that hold nothing smaller.
    """
    n = len(values)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    apart = np.flatnonzero(np.append(True, common[1:] < least))
    longest = int(np.diff(np.append(apart, n)).max())
    low, shared = [values], [common]  # low[k][i]: least of values[i-2^k+1 : i+1], as far as they reach
    while 1 << len(low) <= longest:
        width = 1 << len(low) - 1
        for levels in (low, shared):
            longer = levels[-1].copy()
            np.minimum(longer[width:], levels[-1][:-width], out=longer[width:])
            levels.append(longer)
    here = np.arange(n)
    length = np.full(n, WINDOW, np.uint8)
    for k in range(len(low) - 1, -1, -1):
        before = here - 1
        steps = np.flatnonzero((before >= (1 << k) - 1) & (low[k][before] >= values))
        length[steps] = np.minimum(length[steps], shared[k][here[steps]])
        here[steps] -= 1 << k
    length = np.minimum(length, common[here])
    place = here - 1
    place[length < least] = -1
    length[length < least] = 0
    return place, length


def previous_factors(order: np.ndarray, common: np.ndarray, doc: np.ndarray, least: int = GRAM) -> np.ndarray:
    """The longest previous factor of each suffix: how many of its first bytes also start in a smaller document.

    In suffix order the longest match with a smaller document is with the previous or the next suffix of a smaller
    one.  Lengths are cut at WINDOW, and below `least` count as 0.
    """
    place = np.unique(doc[order], return_inverse=True)[1].astype(np.int32)
    factor = previous_smaller(place, common, least)[1]
    after = np.append(np.uint8(0), common[:0:-1])  # the same seen from the other end
    factor = np.maximum(factor, previous_smaller(place[::-1], after, least)[1][::-1])
    out = np.zeros(len(order), np.uint8)
    out[order] = factor
    return out


def find_earlier(table: pa.Table) -> pa.Table:
    """Of one bucket: the windows of each segment that a smaller document has, as (number, first, last window)."""
    rows = table.to_pylist()
    length = np.concatenate([np.frombuffer(r["lengths"], np.uint16) for r in rows]).astype(np.int64)
    doc = np.concatenate([from_planes(r["docs"], r["n"], np.int64) for r in rows])
    sizes = np.add.reduceat(length, np.cumsum([0] + [r["n"] for r in rows[:-1]]))
    text = np.frombuffer(b"".join(pa.decompress(r["data"], int(n), "zstd", asbytes=True) for r, n in zip(rows, sizes)), np.uint8)
    windows = length - WINDOW + 1
    owner = np.repeat(np.arange(len(length)), windows)
    offset = ranges(np.zeros(len(length), np.int64), windows)
    place = (np.cumsum(length) - length)[owner] + offset
    covered = previous_factors(*suffix_order(text, place), doc[owner]) >= WINDOW
    edge = changes(owner)
    begins = np.flatnonzero(covered & (edge | ~np.append(False, covered[:-1])))
    stops = np.flatnonzero(covered & (np.append(edge[1:], True) | ~np.append(covered[1:], False)))
    found = np.stack([owner[begins], offset[begins], offset[stops]], axis=1)
    ends = np.cumsum([r["n"] for r in rows])
    cut = np.searchsorted(found[:, 0], np.append(0, ends))
    out = []
    for r, end, x, y in zip(rows, ends, cut, cut[1:]):
        if y > x:
            out.append((r["chunk"], 2, r["bucket"], r["n"], r["places"], r["counts"], None, (found[x:y] - [end - r["n"], 0, 0]).astype(np.int32).tobytes()))
    return arrow_table(out, ANSWERS)


# Step 4: mark ----------------------------------------------------------------------------------------------------


def covered_bytes(block: dict, answers: Answers, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and lengths of a block's documents and which bytes go."""
    data, lengths, ids = opened(block)
    marks = np.zeros(len(data) + 1, np.int32)
    segments = Segments(data, lengths)
    if len(segments.keys):
        entries = Entries(segments, ids)
        flags = answers.flags_of_entries(entries, place_of(block), buckets)
        number, doc = entries.number, ids[segments.doc]
        whole = flags[EARLIER][number] | (doc > entries.doc[number])
        np.add.at(marks, segments.first[whole], 1)
        np.add.at(marks, segments.last[whole] + WINDOW, -1)
        if len(answers.looked.place):
            which, first, last = answers.windows(looks := Looks(segments, entries, flags, buckets), place_of(block))
            entry, first, last = looks.entry[which], first + looks.offset[which], last + looks.offset[which]
            order = np.argsort(entry, kind="stable")
            entry, first, last = entry[order], first[order], last[order]
            held = np.flatnonzero(~whole)
            low, high = (np.searchsorted(entry, number[held], side) for side in ("left", "right"))
            which = ranges(low, high - low)
            base = np.repeat(segments.first[held], high - low)
            np.add.at(marks, base + first[which], 1)
            np.add.at(marks, base + last[which] + WINDOW, -1)
    return data, lengths, np.cumsum(marks)[:-1] > 0


def finish(buckets: int, with_text: bool, schema: pa.Schema):
    def mark(key: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        tables = []
        answered = Answers(answers)
        for i, block in enumerate(blocks.drop_columns(["rest"]).to_pylist()):
            data, lengths, gone = covered_bytes(block, answered, buckets)
            starts = np.cumsum(lengths) - lengths
            rows = []
            for start, n in zip(starts, lengths):
                own, text = gone[start : start + n], data[start : start + n]
                kept = text[~own].tobytes()
                spans = int(np.count_nonzero(own[1:] & ~own[:-1]) + (own[0] if n else 0))
                rows.append((int(n), int(np.count_nonzero(own)), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None))
            columns = list(zip(*rows))
            rest = blocks.column("rest").combine_chunks()[i].values
            arrays = [pa.array(block["ids"], pa.int64()), *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2)), rest]
            tables.append(pa.Table.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "rest"]))
        return pa.concat_tables(tables) if tables else schema.empty_table()

    return mark


def remove_repeats(docs: DataFrame, carry: list[str] = (), with_text: bool = True, hot_contents: int = HOT_CONTENTS) -> DataFrame:
    """Documents (doc_id, text) without the passages that an earlier document has.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text and the columns in `carry`.  kept_text leaves
    out the bytes of characters that were cut apart (null where with_text is false); kept_sha256 is of all kept bytes.
    Null text counts as empty; a null id comes after all others; rows of the same id never cover each other; texts
    under WINDOW bytes stay whole; an empty table gives an empty one.  Other columns are ignored.
    """
    spark = tuned(docs.sparkSession)
    blocks = pack_blocks(docs, list(carry))
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(BUCKETS_PER_PARTITION * buckets_of(spark), -(-total // BUCKET_BYTES))
    blocks = blocks.drop("size")
    bare = blocks.select("chunk", "block", "ids", "lengths", "data")
    sent = bare.mapInArrow(send_keys(buckets), KEYS)
    with passing(spark):
        first = stored(sent.groupBy("bucket").applyInArrow(find_repeated(hot_contents), ANSWERS))
        looks = bare.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(send_looks(buckets), ENTRIES)
        answers = stored(first.unionByName(looks.groupBy("bucket").applyInArrow(find_earlier, ANSWERS)))
    rest = blocks.schema["rest"].dataType.elementType
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType()), T.StructField("rest", rest)]
    )
    empty = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")] + [("kept_sha256", pa.string()), ("kept_text", pa.string())])
    marked = blocks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish(buckets, with_text, empty), schema)
    return marked.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", *[F.col("rest")[c].alias(c) for c in carry])
