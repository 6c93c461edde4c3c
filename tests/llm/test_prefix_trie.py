"""The conversation trie against one built turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from tidemark.llm import prefix_trie


def plain(rows):
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            held.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    held = {c: [t[3:] for t in sorted(turns)] for c, turns in held.items()}
    members = {}
    for c, turns in held.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(held.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, len(path) == d))
    own = {p: (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p, m in members.items()}
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += own[p]
    least = {p: min(m)[0] for p, m in members.items()}
    return sorted((least[p], len(p), least[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c, ends in sorted(m) if ends).encode()).hexdigest()) for p, m in members.items())


def turns(seed, convs=90, longest=9):
    rng = random.Random(seed)
    first = [[("system" if rng.random() < 0.3 else "user", " ".join(rng.choice(["a", "bb", "Çc", "d\te", ""]) for _ in range(rng.randint(0, 3)))) for _ in range(longest)] for _ in range(4)]
    rows = []
    for c in [*range(convs), -3, -40, 10**12 + 20, 10**12 + 27]:
        base = rng.choice(first)
        path = base[: rng.randint(0, longest)] + [("user", f"t{rng.randint(0, 3)}") for _ in range(rng.randint(0, 3))] or [("user", "only")]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(path)]
    for c in range(1000, 1040):  # copies
        rows += [(c, i, *t) for i, t in enumerate(first[0])]
    rows += [(7, None, None, None), (7, 1, "user", "x"), (7, 1, "user", "x"), (None, 0, "user", "lost"), (2000, None, "user", None), (2001, 5, None, "late")]
    return rows


@pytest.mark.parametrize("limits", [{}, {"shard_rows": 5}, {"shard_rows": 9, "stratum": 3}, {"shard_rows": 4, "stratum": 1, "max_shards": 30}])
def test_against_turn_by_turn(frame, limits):
    rows = turns(5)
    given = frame("conv_id long, turn long, role string, text string, depth string, conv int", *((*r, "x", 1) for r in rows)).repartition(3)
    got = prefix_trie.shared(given, **limits)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_one_conversation_with_most_turns(frame):
    rows = [(1, i, "user", f"word {i % 7}") for i in range(700)] + [(2, i, "user", f"word {i % 7}") for i in range(600)] + [(21, 0, "user", "x"), (22, 3, "user", "y")]
    given = frame("conv_id long, turn long, role string, text string", *rows)
    got = sorted((tuple(r) for r in prefix_trie.shared(given, shard_rows=8).collect()), key=repr)
    assert got == sorted(plain(rows), key=repr) and max(r[1] for r in got) > 690


def test_empty(frame):
    ddl = "conv_id long, turn long, role string, text string"
    assert prefix_trie.shared(frame(ddl)).count() == 0
    assert prefix_trie.shared(frame(ddl, (None, 1, "user", "x"))).count() == 0
    lonely = [(23, 0, "user", "x")]
    assert sorted((tuple(r) for r in prefix_trie.shared(frame(ddl, *lonely)).collect()), key=repr) == sorted(plain(lonely), key=repr)
