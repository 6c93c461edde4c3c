"""Line templates against a plain version of the tree, and awkward documents."""

import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import lines


def plain(docs, min_docs, depth=3):
    """``docs``: (id, text) with unique texts; the texts with recurring lines dropped."""
    seen = []
    for i, text in docs:
        for no, raw in enumerate((text or "").split("\n")):
            masked = " ".join(re.sub(r"\S*[0-9]\S*", "<*>", raw, flags=re.A).split())
            if masked:
                seen.append((i, no, tuple(masked.split(" "))))
    leaf = lambda t: (len(t), t[:depth])
    in_leaf, kinds = defaultdict(set), defaultdict(set)
    for i, _, t in seen:
        in_leaf[leaf(t)].add(i)
        kinds[t].add(i)
    support = defaultdict(int)
    for t, who in kinds.items():
        for at, token in enumerate(t):
            support[leaf(t), at, token] += len(who) * (token != "<*>")
    template, users = {}, defaultdict(set)
    for t in kinds:
        texts, n = len(in_leaf[leaf(t)]), len(t)
        if texts < min_docs:
            continue
        steps = defaultdict(set)
        for at, token in enumerate(t):
            if (s := support[leaf(t), at, token]) >= min_docs:
                steps[((texts - 1) // (lines.LEAF_PARTS * s)).bit_length()].add((at, token))
        fixed = set()
        solid = lambda: len(fixed) >= n * lines.CONSTANT_SHARE and len(fixed) - min(n, depth) >= max(n - depth, 0) * lines.FREE_SHARE
        for step in sorted(steps):
            if not solid():
                fixed |= steps[step]
        if solid():
            template[t] = (leaf(t), frozenset(fixed))
            users[template[t]] |= kinds[t]
    first, gone = {}, defaultdict(set)
    for i, no, t in sorted(seen):
        if t in template and len(users[template[t]]) >= min_docs:
            if template[t] in first:
                gone[i].add(no)
            first.setdefault(template[t], (i, no))
    return {i: None if text is None else "\n".join(x for no, x in enumerate(text.split("\n")) if no not in gone[i]) for i, text in docs}


def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice("alpha beta gamma delta rho tau phi chi psi".split())
    docs = []
    for i in range(40):
        body = [" ".join(word() for _ in range(rng.randint(1, 12))) + f" only{chr(97 + i % 26)}{chr(97 + i // 26)}" for _ in range(4)]
        body.insert(2, f"Job {rng.randint(0, 9999)} was started by {word()} on the host at noon")
        if i % 2:
            body.append("All rights reserved.")
        if i % 7 == 0:
            body += ["", "  All   rights\treserved. "]
        docs.append((i, "\n".join(body)))
    return [*docs, (100, None), (101, ""), (102, "All rights reserved."), (103, "\n\n")]


@pytest.mark.parametrize("min_docs", [2, 5])
def test_against_the_plain_tree(frame, min_docs):
    docs = corpus()
    rows = frame("doc_id long, text string, lines string, _id long, _drop long", *((i, t, "", 1, 1) for i, t in docs))
    got = {r.doc_id: r for r in lines.drop_recurring(rows, min_docs=min_docs).collect()}
    want = plain(docs, min_docs)
    assert {i: r.text for i, r in got.items()} == want
    assert sum(r.lines_dropped for r in got.values()) > 50 and got[102].text == ""
    assert sum("was started by" in (t or "") for t in want.values()) < 9 and sum(bool(re.search(r"All\s+rights", t or "")) for t in want.values()) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lines_with_numbers(frame, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["red", "blue", "total", "for", "the", "of", "page", "x1", "2019", "7.5", "-", "a9"])
    shapes = [[word() for _ in range(rng.randint(1, 14))] for _ in range(12)]
    text = lambda: "\n".join(" ".join(w if rng.random() < 0.9 else word() for w in rng.choice(shapes)) for _ in range(rng.randint(1, 9)))
    docs = list(enumerate({text() for _ in range(60)}))
    got = lines.drop_recurring(frame("doc_id long, text string", *docs)).collect()
    assert {r.doc_id: r.text for r in got} == plain(docs, 2)


def test_tables_of_numbers_stay(frame):
    rng = random.Random(1)
    table = lambda: "\n".join(" ".join(f"{rng.random():.3f}" for _ in range(3)) for _ in range(20)) + "\nmean of all rows"
    got = lines.drop_recurring(frame("doc_id long, text string", (1, table()), (2, table()))).orderBy("doc_id").collect()
    assert [r.lines_dropped for r in got] == [0, 1]


def test_rows_without_id_repeats_and_clashes(frame):
    same = [(i, f"own line {chr(97 + i)} text\nShared boilerplate line here") for i in range(6)]
    rows = frame("doc_id long, text string, lines_dropped string", *((i, t, "") for i, t in same), (3, same[3][1], ""), (None, "Shared boilerplate line here\nno id", ""))
    out = lines.drop_recurring(rows, min_docs=5).collect()
    assert len(out) == 8 and [r.lines_dropped for r in out if r.doc_id == 3] == [1, 1]
    assert [r.text for r in out if r.doc_id is None] == ["Shared boilerplate line here\nno id"]


def test_exact_copies_count_once(frame):
    rows = frame("doc_id long, text string", *((i, "the very same text in full\nwith two lines of words") for i in range(20)))
    assert {r.lines_dropped for r in lines.drop_recurring(rows, min_docs=5).collect()} == {0}


def test_empty_table(frame):
    assert lines.report(frame("doc_id long, text string")).count() == 0


def test_a_long_line_of_two_documents_goes_from_the_second(frame):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    shared, *own = (" ".join(word() for _ in range(60)) for _ in range(5))
    rows = frame("doc_id long, text string", (1, f"{own[0]}\n{shared}\n{own[1]}"), (2, f"{own[2]}\n{own[3]}\n{shared}"))
    got = {r.doc_id: (r.text, r.lines_dropped) for r in lines.drop_recurring(rows).collect()}
    assert got == {1: (f"{own[0]}\n{shared}\n{own[1]}", 0), 2: (f"{own[2]}\n{own[3]}", 1)}


@pytest.mark.parametrize("n", [500, 10_000])
def test_a_template_with_two_fields_is_one_at_any_size(frame, n):
    rng = random.Random(n)
    value = lambda: "".join(rng.choice("abcdefghij") for _ in range(3))
    docs = [(i, f"Posted in the {value()} section by {value()} for readers today") for i in range(n)]
    docs += [(n + i, f"Posted in the {value()} archive with {value()} among its pages") for i in range(n // 50)]  # a small group in the leaf
    out = lines.drop_recurring(frame("doc_id long, text string", *docs)).where("lines_dropped = 0").collect()
    assert sorted(r.doc_id for r in out) == [0, n]
