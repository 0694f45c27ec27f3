"""Repetition rules against plain loops."""

import random
import re
from collections import Counter

from bidtrail.llm import repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    n = len(words)
    windows = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    again = [False] * n
    for i in range(n - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            again[i : i + 8] = [True] * 8
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    matches = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            matches[i] = max(matches[i], k)
    held = [False] * n
    for i, k in enumerate(matches):
        if k >= repetition.MIN_REPEAT:
            held[i : i + k] = [True] * k
    longest, share = max(matches, default=0), sum(held) / max(n, 1)
    failed = n < 20 or 100 * sum(again) > 30 * n
    bad = share > repetition.MAX_COVERED or longest >= repetition.LONG_REPEAT and longest > repetition.MAX_LONGEST * n
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return (n, sum(map(len, words)), symbols, dup, sum(again), failed, not failed and not bad, share, longest)


def test_against_plain_loops(spark):
    rng = random.Random(8)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "a " * 300), (4, "x"), (5, "a b " * 90), (6, "é è *#|<>&%$ \x0b\x0c\r\n\n é"), (None, "one two")]
    for i in range(10, 60):
        words = ["w%d" % rng.randint(0, rng.choice([3, 40, 2000])) for _ in range(rng.randint(0, 160))]
        for _ in range(rng.randint(0, 2)):
            at, n = rng.randint(0, len(words)), rng.randint(4, 40)
            words[rng.randint(0, len(words)) :][:0] = words[at : at + n]
            words += words[at : at + n]
        rows.append((i, "".join(w + rng.choice([" ", " ", "\n", "  "]) for w in words)))
    rows += [rows[20], rows[20]]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id bigint, text string, kept boolean").repartition(2)
    got = sorted(map(tuple, repetition.judge(docs).collect()), key=str)
    assert got == sorted([(i, *plain(t)) for i, t in rows], key=str)


def test_verdict_on_long_texts_and_empty_table(spark):
    clean = " ".join("w%d" % i for i in range(200_000))
    twice = " ".join("w%d" % (i % 100_000) for i in range(200_000))
    docs = spark.createDataFrame([(1, clean), (2, twice)], "doc_id bigint, text string")
    assert {r["doc_id"]: (r["kept"], r["longest_repeat"]) for r in repetition.judge(docs).collect()} == {1: (True, 0), 2: (False, 100_000)}
    assert repetition.judge(docs.where("false")).collect() == []
