"""Packing: an exact round trip through the tokenizer, no padding, and the level rule."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from bidtrail.llm import packing

JSON, RANKS = str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_round_trip(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("abdeé漢#1") for _ in range(rng.randint(1, 9))) for _ in range(rng.choice([1, 3, 200, 900, 3000])))) for i in range(40)]
    rows += [(90, None), (91, ""), (92, "a<|endoftext|>b \r\n\t x"), (None, "no id"), (93, "same"), (93, "same"), (94, "x" * 50_000), (95, "don't  I'll\n\n" * 4000)]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, offset int").repartition(3)
    got = packing.pack(docs, JSON, RANKS).collect()
    tokenizer = Tokenizer.from_file(JSON)
    ids = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], np.uint32)) for i, t in rows]
    want = defaultdict(int)
    for i, x in ids:
        want[i, len(x)] += len(x)
    have = defaultdict(int)
    for r in got:
        have[r["doc_id"], r["doc_tokens"]] += r["length"]
        assert any(zlib.crc32(x[r["start"] : r["start"] + r["length"]].astype("<u4").tobytes()) == r["ids_crc32"] for i, x in ids if i == r["doc_id"] and len(x) == r["doc_tokens"])
    assert have == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0


def test_same_ids_with_and_without_rank_file():
    both = [packing.Vocabulary(JSON, r) for r in (RANKS, None)]
    for text in ["", " ", "Hello,  world\n\n", "é漢字\x00 ’s don't 12345", "<|endoftext|>", "a" * 3000, "\t" * 500 + "x"]:
        assert both[0].ids(text).tolist() == both[1].ids(text).tolist()


def test_level_minimises_the_sum_of_squares():
    rng = random.Random(1)
    packer = packing.Packer(0, window=16, open_windows=10_000)
    for n in range(300):
        size = rng.randint(1, 15)
        counts = packer.counts.copy()

        def after(level):
            c = counts.copy()
            if level:
                c[level] -= 1
            if level + size < 16:
                c[level + size] += 1
            return int((c[1:16] ** 2).sum())

        levels = [0] + [h for h in range(1, 17 - size) if counts[h]]
        assert after(packer.level_for(size)) == min(map(after, levels))
        packer.add(n, np.zeros(size, np.uint32))
        assert packer.counts[16] == 0 and packer.counts[1:16].sum() == packer.open


def test_level_at_the_bound_minimises_the_sum_of_squares():
    rng = random.Random(2)
    packer = packing.Packer(0, window=16, open_windows=20)
    for n in range(400):
        size = rng.randint(1, 15)
        counts = packer.counts.copy()
        if counts.sum():

            def after(level):
                c = counts.copy()
                c[level] -= 1
                if level + size < 16:
                    c[level + size] += 1
                return int((c[1:16] ** 2).sum())

            held = [h for h in range(1, 16) if counts[h]]
            level = packer.level_at_bound(size)
            assert counts[level] and after(level) == min(map(after, held))
            assert level + size <= 16 or all(after(h) > after(level) for h in held if h + size <= 16)
        packer.add(n, np.zeros(size, np.uint32))


def test_tail_is_placed_by_the_rule():
    """What is open at the end is placed again: all ids once and in order, all windows but the last few are full."""
    rng = random.Random(4)
    for sizes in ([], [1], [15], [16], [9] * 40, [rng.randint(1, 60) for _ in range(500)]):
        packer = packing.Packer(0, window=16, open_windows=30)
        for n, size in enumerate(sizes):
            packer.add(n, np.arange(size, dtype=np.uint32))
        packer.finish()
        assert not packer.open and not packer.counts.any()
        pieces, filled = defaultdict(list), defaultdict(int)
        for doc, start, length, crc, total, sequence, offset in packer.rows:
            assert crc == zlib.crc32(np.arange(start, start + length, dtype="<u4").tobytes()) and total == sizes[doc]
            assert offset == filled[sequence]
            pieces[doc].append((start, length))
            filled[sequence] += length
        for doc, size in enumerate(sizes):
            at = 0
            for start, length in sorted(pieces[doc]):
                assert start == at
                at += length
            assert at == size
        rest = sum(sizes) % 16
        assert sorted(n for n in filled.values() if n < 16) == [1 << b for b in range(4) if rest >> b & 1]


def test_tail_cuts_no_more_than_laying_end_to_end():
    rng = random.Random(5)
    packer = packing.Packer(0)
    for n in range(300):
        packer.add(n, np.zeros(rng.randint(1, 1500), np.uint32))
    windows = packer.open
    before = len(packer.rows) + sum(len(w) for level in packer.held for w in level)
    packer.finish()
    assert windows > 50 and len(packer.rows) - before <= windows


def test_open_windows_are_bounded():
    packer = packing.Packer(0, window=16, open_windows=5)
    for n in range(200):
        packer.add(n, np.full(11, n, np.uint32))
        assert packer.open <= 5
    packer.finish()
    assert sum(r[2] for r in packer.rows) == 2200 and not packer.open


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), JSON, RANKS).collect() == []
