"""Passage removal against a plain double loop."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bidtrail.llm import repeats


def brute(rows):
    """doc_id -> (bytes, removed, spans, sha) by comparing every window with all earlier documents."""
    out = []
    for i, text in rows:
        data = (text or "").encode()
        earlier = set()
        for j, other in rows:
            if i is not None and j is not None and j < i or i is None and j is not None:
                other = (other or "").encode()
                earlier.update(other[p : p + 50] for p in range(len(other) - 49))
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if data[p : p + 50] in earlier:
                gone[p : p + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def some_rows(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts += [text[cut:], " ".join(rng.choice(words) for _ in range(rng.randint(0, 15)))]
        rows.append((i * 3 % n if i % 7 else i * 3 % n + n, "".join(parts)))
    rows += [(500, rows[0][1]), (501, rows[1][1]), (501, rows[1][1]), (502, None), (503, ""), (504, "a" * 3000), (505, "b" + "a" * 2000)]
    rows += [(506, "ab" * 400), (507, "x" * 49), (508, "x" * 50), (None, rows[2][1] + "tail"), (None, None)]
    return rows


@pytest.mark.parametrize("hot, block", [(2_000, 1 << 20), (2, 600), (2_000, 300)])
def test_against_every_window(spark, monkeypatch, hot, block):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    rows = some_rows(hot + block)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = repeats.remove_repeats(docs, hot_contents=hot).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def plain_factors(text, at, doc, least):
    out = []
    for p, d in zip(at, doc):
        best = 0
        for q, e in zip(at, doc):
            if e < d:
                n = 0
                while n < 50 and text[p + n] == text[q + n]:
                    n += 1
                best = max(best, n)
        out.append(best if best >= least else 0)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_suffix_order_and_factors_against_plain_loops(seed):
    rng = random.Random(seed)
    segments = []
    for _ in range(rng.randint(1, 8)):
        data = bytearray(rng.choice(b"ab") for _ in range(rng.randint(50, 80)))
        segments.append((rng.randint(0, 5), bytes(data)))
        if rng.random() < 0.7:
            data[rng.randrange(len(data))] ^= rng.randint(0, 1)
            segments.append((rng.randint(0, 5), bytes(data)))
    text, at, doc = b"", [], []
    for d, data in segments:
        at += range(len(text), len(text) + len(data) - 49)
        doc += [d] * (len(data) - 49)
        text += data
    order, common = repeats.suffix_order(np.frombuffer(text, np.uint8), np.array(at))
    suffixes = [text[at[i] : at[i] + 50] for i in order]
    assert suffixes == sorted(suffixes) and sorted(order) == list(range(len(at)))
    for before, after, n in zip(suffixes, suffixes[1:], common[1:].tolist()):
        assert before[:n] == after[:n] and (n == 50 or before[n] != after[n])
    for least in (1, 20, 50):
        assert repeats.previous_factors(order, common, np.array(doc), least).tolist() == plain_factors(text, at, doc, least)


def test_previous_smaller_positions():
    rng = random.Random(7)
    for n in (0, 1, 2, 17, 200):
        values, common = [rng.randint(0, 9) for _ in range(n)], [rng.choice([0, 10, 30, 50, 50, 50]) for _ in range(n)]
        place, length = repeats.previous_smaller(np.array(values, np.int32), np.array(common, np.uint8), 20)
        for i in range(n):
            want = next((j for j in range(i - 1, -1, -1) if values[j] < values[i]), -1)
            shared = min(common[want + 1 : i + 1]) if want >= 0 else 0
            assert (place[i], length[i]) == ((want, shared) if shared >= 20 else (-1, 0))


def test_buckets_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 50)
    rows = some_rows(11)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def packed(texts, number, chunk):
    data = [t.encode() for t in texts]
    lengths = np.array([len(d) for d in data], np.int64)
    return {"chunk": chunk, "block": number, "ids": list(range(10 * number, 10 * number + len(data))), "lengths": lengths.tobytes(), "data": repeats.squeezed(b"".join(data))}


def test_blocks_of_a_chunk_send_a_row_per_bucket():
    """A row for each block and bucket grew with both, to a few bytes a row, so that the shuffle outgrew the input."""
    rng = random.Random(3)
    blocks = [packed(["".join(rng.choice("abcdef ") for _ in range(400)) for _ in range(4)], 16 * (i // 12) + i % 12, i // 12) for i in range(24)]
    rows = pa.Table.from_batches(repeats.send_keys(8)(iter(pa.Table.from_pylist(blocks).to_batches(max_chunksize=5)))).to_pylist()
    assert len(rows) <= 2 * 8
    sent = {(r["chunk"], int(p)): 0 for r in rows for p in r["places"]}
    assert sent.keys() == {(i // 12, i % 12) for i in range(24)}
    for r in rows:
        counts = np.frombuffer(r["counts"], np.uint32)
        assert len(counts) == len(r["places"]) and counts.sum() == r["n"] == len(r["keys"]) // 4 == len(r["contents"]) // 8
        ids = np.cumsum(repeats.from_planes(r["docs"], r["n_docs"], np.uint64)).view(np.int64)
        owner = np.repeat(16 * r["chunk"] + np.frombuffer(r["places"], np.uint8).astype(int), counts)
        assert (ids[repeats.from_planes(r["which"], r["n"], np.uint32)] // 10 == owner).all()


def test_chunks_that_send_their_segments_in_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 300)
    monkeypatch.setattr(repeats, "LOOK_BYTES", 500)
    rows = some_rows(12)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = repeats.remove_repeats(docs, hot_contents=5).drop("kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_carries_columns_and_text(spark):
    docs = spark.createDataFrame([(1, "é" * 60, "x"), (2, "é" * 60 + "rest", None)], "doc_id bigint, text string, n_bytes string")
    got = {r[0]: r for r in repeats.remove_repeats(docs.withColumn("block", F.lit(9)), carry=["block"]).collect()}
    assert got[1]["kept_text"] == "é" * 60 and got[2]["kept_text"] == "rest" and got[2]["block"] == 9


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert repeats.remove_repeats(docs).collect() == []
