"""Numbers and texts as a few compressed bytes, for rows that are shuffled; numpy helpers that go with them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start .. start+length-1 of each pair, one after the other."""
    length = length.astype(np.int64)
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(length.sum())


def squeezed(data: bytes, level: int = 1) -> bytes:
    return pa.Codec("zstd", level).compress(data, asbytes=True)


def planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all their lowest bytes first, compressed."""
    return squeezed(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def from_planes(packed: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(packed, size * n, "zstd", asbytes=True), np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def packed_words(words: pa.Array) -> tuple[bytes, bytes]:
    """The words end to end and their lengths in bytes, both compressed."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if len(words) else b""
    return squeezed(data, 3), planes(np.diff(offsets).astype(np.uint32))


def words_of(data: bytes, lengths: bytes, n: int) -> pa.Array:
    ends = np.append(0, np.cumsum(from_planes(lengths, n, np.uint32), dtype=np.int64))
    data = pa.decompress(data, int(ends[-1]), "zstd") if n else pa.py_buffer(b"")
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.tobytes()), data)


def narrow_rows(values: np.ndarray) -> list[bytes]:
    """Each row of whole numbers in as few bits a number as its largest needs; the first byte says how many."""
    # A number of k bits lies from -2^(k-1) to 2^(k-1) - 1.
    most = np.maximum(values.max(axis=1, initial=0), -1 - values.min(axis=1, initial=0))
    width = np.searchsorted(2 ** np.arange(62, dtype=np.int64), most, "right") + 1
    out = np.empty(len(values), object)
    for k in np.unique(width):
        rows = np.flatnonzero(width == k)
        shifted = (values[rows] + (1 << int(k) - 1)).astype(">u8")
        some = np.unpackbits(shifted.view(np.uint8).reshape(*shifted.shape, 8), axis=-1)[..., 64 - k :]
        out[rows] = [bytes([k]) + row.tobytes() for row in np.packbits(some.reshape(len(rows), -1), axis=1)]
    return out.tolist()


def from_narrow(packed: list[bytes], columns: int) -> np.ndarray:
    """The rows that narrow_rows() packed, as 32-bit numbers where they fit."""
    width = np.array([p[0] for p in packed], np.int64)
    out = np.zeros((len(packed), columns), np.int32 if width.max(initial=0) <= 32 else np.int64)
    for k in np.unique(width):
        rows = np.flatnonzero(width == k)
        size = -(-columns * int(k) // 8)
        for some in np.array_split(rows, 1 + len(rows) // 20_000):
            data = np.frombuffer(b"".join([packed[i][1:] for i in some]), np.uint8).reshape(len(some), size)
            flags = np.zeros((len(some), columns, 64), np.uint8)
            flags[..., 64 - k :] = np.unpackbits(data, axis=1, count=columns * int(k)).reshape(len(some), columns, k)
            out[some] = np.packbits(flags, axis=-1).view(">u8")[..., 0].astype(np.int64) - (1 << int(k) - 1)
    return out
