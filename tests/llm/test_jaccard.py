"""The grouped prefix join against all pairs compared one by one."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import grams, jaccard, words


def plain(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 4 * len(a & sets[j]) >= 3 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return [(i, len(s), x) for i, (s, x) in enumerate(zip(sets, label))]


def corpus(seed, bases=6, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    common = [rng.choice(vocabulary) for _ in range(30)]
    texts = [None, "", " \t", "One two", "one  TWO", "one two three", "a b c d e", "A b c d e f"]
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))] + common
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, len(text) // 18)):
                at = rng.randrange(len(text))
                text[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
            texts.append(" ".join(text))
    texts += [" ".join(common), " ".join([*common, "x"])]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(frame, seed):
    texts = corpus(seed)
    docs = frame("doc_id long, text string, component_id string, n long, _drop long, _id long", *((i, t, "x", 0, 1, 1) for i, t in enumerate(texts)))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect())
    assert got == plain(texts)
    assert len({c for _, _, c in got}) < len(got) - 20
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got})


def test_members_that_link_without_their_leader(frame):
    """Equal prefixes, but the smallest id shares no more than that with the two others, which link with each other."""
    w = [f"x108.{i}" for i in range(18)]
    texts = [" ".join(t) for t in (w[:6] + w[12:17], w[:11], w[:10] + w[17:])]
    docs = frame("doc_id long, text string", *enumerate(texts))
    rows = jaccard.prefixes(docs, "doc_id", "text", 5, (np.zeros(0, np.uint64), np.zeros(0, np.int64))).collect()
    assert len({(r.n, r.group) for r in rows}) == 1
    assert plain(texts) == [(0, 7, 0), (1, 7, 1), (2, 7, 1)]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()) == plain(texts)
    assert sorted(r.doc_id for r in jaccard.keep_first(docs).collect()) == [0, 1]


def test_order_does_not_matter(frame, monkeypatch):
    texts = corpus(3, 4, 10)
    docs = frame("doc_id long, text string", *enumerate(texts))
    monkeypatch.setattr(jaccard, "HOT_LEAST", 2)
    monkeypatch.setattr(jaccard, "BROADCAST_IDS", 0)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()) == plain(texts)


def test_odd_rows(frame):
    text = "one two three four five six seven"
    docs = frame("doc_id int, text string", (5, text), (5, text), (None, text), (9, text), (7, None), (None, None))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted([(5, 3, 5), (5, 3, 5), (None, 3, None), (9, 3, 5), (7, 0, 7), (None, 0, None)], key=str)
    assert sorted(str(r.doc_id) for r in jaccard.keep_first(docs).collect()) == ["5", "7", "None", "None"]
    assert jaccard.near_duplicates(frame("doc_id long, text string")).count() == 0


def test_components(frame):
    edges = frame("a long, b long", *((i, i + 1) for i in range(1, 40)), (100, 101), (101, 100))
    got = {r.node: r.component for r in jaccard.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}
    assert jaccard.components(edges.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [3, 1 << 18])
def test_word_hashes(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    texts = ["a b  A b c d", "", " x", "éé\tb\x0bC", "q" * 30, "a a a b b"]
    hashes, counts = words.word_hashes(*grams.flat(pa.array(texts)))
    seen = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t.lower())]
    assert counts.tolist() == [6, 0, 1, 3, 1, 5] and len(set(hashes.tolist())) == len(set(seen))
    assert all((hashes[i] == hashes[j]) == (seen[i] == seen[j]) for i in range(len(seen)) for j in range(i))
    assert np.allclose(words.repeats(*grams.flat(pa.array(texts))), [0, 0, 0, 0, 0, 0.6])
