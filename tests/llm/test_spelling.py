import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from bidtrail.llm import spelling

DDL = "doc_id bigint, text string, word string, n int, short int"


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    """All pairs by plain loops: (word, form, root, n, n_near, form_n)."""
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) <= 1 and one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, words[w], len(near[w]), words.get(forms[w])))
    return sorted(out)


def found(spark, rows, **settings):
    return sorted(map(tuple, spelling.spelling_variants(spark.createDataFrame(rows, DDL).repartition(5), **settings).collect()))


def corpus(seed=3):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbbbb", "×÷éééé"]
    weights = [5 ** rng.randint(0, 4) for _ in stems]
    rows = []
    for i in range(300):
        words = rng.choices(stems, weights, k=40)
        words = [w.upper() if w.isascii() and rng.random() < 0.2 else w for w in words]
        rows.append((i, rng.choice([" ", ". ", "1", "ā", "\n"]).join(words), "clash", 1, 1))
    rows += [(None, "nobody " * 6 + "noboddy", None, None, None), (7, None, None, None, None), (8, "", None, None, None)]
    rows += [(9, "sameword samewort", None, None, None)] * 5 + [(10, ("longish " * 20_000), None, None, None), (11, "longist " * 5, None, None, None)]
    rows += [(12 + i, f"ledger{'s' * i} " * 10 ** (4 - i), None, None, None) for i in range(4)]
    rows += [(20, "aaaaaa aaaaab aaaaac aaabaa aaaaba " * 6, None, None, None)]
    return rows


@pytest.mark.parametrize("tile", [spelling.TILE, 3])
def test_equals_all_pairs(spark, tile):
    rows = corpus()
    want = plain(rows)
    assert any(r[2] != r[0] and r[1] != r[2] for r in want) and max(r[4] for r in want) > 3
    assert found(spark, rows, tile=tile) == want


def test_damaged_words_find_their_form(spark):
    """Every run whose checksum is a multiple of 199 loses a letter and counts as a variant."""
    rows = [(i, "remarkable " * 3, None, None, None) for i in range(3000)]
    assert found(spark, rows) == plain(rows) and len(plain(rows)) > 3


def test_empty_table(spark):
    assert found(spark, []) == []


def test_index_equals_comparison():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([6, 7]))) for _ in range(150)})
    index = spelling.PositionIndex(words, 6)
    for word in words:
        got = {w for i, w in enumerate(words) if index.near(word, 6, 0, 0) >> i & 1}
        assert got == {w for w in words if one_apart(word, w) and min(len(w), len(word)) == 6}
