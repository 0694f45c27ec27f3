import hashlib
import zlib

import pytest

from bidtrail.llm import tries

DDL = "conv_id bigint, turn bigint, role string, text string, depth string, n int"


def rebuilt(rows):
    """conv_id -> list of (role, text), by plain loops."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(rows):
    """All nodes by plain loops over prefixes."""
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for path, inside in members.items():
        children = {p for p in members if len(p) == len(path) + 1 and p[: len(path)] == path}
        ends = sorted(c for c in inside if len(convs[c]) == len(path))
        out[path] = [min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), len(children), int(not children), 0, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()]
        out[path][6] = (len(inside) - 1) * len(path[-1][1].split()) if path else 0
    for path in sorted(out, key=len, reverse=True):
        if path:
            for i in (5, 6):
                out[path[:-1]][i] += out[path][i]
    return sorted(map(tuple, out.values()), key=str)


def corpus():
    rows = []
    for c in range(130):
        opening = ["hello there", "hello", "hi you two"][c % 3]
        for t in range(c % 9):
            text = opening if t == 0 else f"turn {t} {c % (2 if t < 3 else 5 if t < 6 else 9)}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text, "x", 1))
    rows += [(200, 3, None, None, None, None), (200, None, "user", "first", None, None), (201, 1, "user", "", None, None)]
    rows += [(220, 1, "user", "same", None, None)] * 6 + [(221, 1, "user", "same", None, None)] * 6 + [(None, 1, "user", "nobody's", None, None)]
    rows += [(-21, 1, "a", "minus", None, None), (-21, 2, "a", "x", None, None), (-20, 1, "a", "y", None, None), (-39, 5, "a", "z", None, None)]
    rows += [(240, t, "user", f"long {t % 7}", None, None) for t in range(60)] + [(c, t, "user", f"long {t % 7}", None, None) for c in (260, 280) for t in range(50)]
    rows += [(300, 1, "user", "word " * 20_000, None, None), (301, 1, "us", "erword", None, None), (302, 1, "user", "word", None, None)]
    return rows


@pytest.mark.parametrize("block", [1, 4, 64])
def test_equals_plain_loops(spark, block, monkeypatch):
    monkeypatch.setattr(tries, "BLOCK", block)
    if block == 1:
        monkeypatch.setattr(tries, "PIECE", 5)
    rows = corpus()
    got = tries.conversation_trie(spark.createDataFrame(rows, DDL).repartition(6))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_empty_table(spark):
    assert tries.conversation_trie(spark.createDataFrame([], DDL)).collect() == []


def test_turnless_conversations_are_members_of_the_root(spark):
    """A conversation whose only turns give way to an opening that nobody has."""
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 1, "user", "gone", None, None)]
    empty = hashlib.sha256(str(c).encode()).hexdigest()
    assert [tuple(r) for r in tries.conversation_trie(spark.createDataFrame(rows, DDL)).collect()] == [(c, 0, None, 1, 0, 1, 0, empty)]


def test_long_chain_of_branches(spark):
    """Every conversation branches off the one before, so that chains hang deep below each other."""
    rows = [(c * 20 + 1000, t, "user", f"t{t}" if t < c else f"own {c}", None, None) for c in range(40) for t in range(c + 2)]
    assert sorted(map(tuple, tries.conversation_trie(spark.createDataFrame(rows, DDL)).collect()), key=str) == plain(rows)
