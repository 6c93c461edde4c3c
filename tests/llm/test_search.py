"""The two exact searches against scores of all rows, one by one."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import impact, lexical


def nearest(vectors, queries, k):
    out = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, seeds", [(4096, 1024), (16, 12), (7, 0)])
def test_topk_against_all_pairs(frame, monkeypatch, shard, seeds):
    monkeypatch.setattr(impact, "SHARD_VECTORS", shard)
    monkeypatch.setattr(impact, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(impact, "SEEDS", seeds)
    rng = random.Random(shard)
    centres = [[rng.gauss(0, 0.2) for _ in range(12)] for _ in range(4)]
    given = {i: [c + rng.gauss(0, 0.05) for c in rng.choice(centres)] for i in range(150)}
    for i in range(60, 110):  # many equal vectors, so many ties
        given[i] = given[60]
    given |= {200: [0.0] * 12, 201: [0.5], 202: []}
    rows = [(i, [float(np.float32(x)) for x in v], "x", 1.0) for i, v in given.items()]
    bad = [(300, None), (301, [0.1, None]), (302, [float("nan"), 0.2]), (303, [float("inf")]), (None, [0.1, 0.2]), (304, [0.3, float("-inf")])]
    rows += [(i, v, "x", 2.0) for i, v in bad] + rows[:3]
    vectors = frame("vec_id long, embedding array<float>, score string, rank double", *rows)
    got = sorted(tuple(r) for r in impact.search(vectors, F.col("vec_id") % 10 == 0).collect())
    whole = {i: [math.floor(256 * x) for x in v] + [0] * (12 - len(v)) for i, v, *_ in rows[: len(given)]}
    assert got == nearest(whole, [i for i in whole if i % 10 == 0], 5)


def test_topk_in_bundles_without_broadcast(frame, spark, monkeypatch):
    """Queries stream by bundles of several shards; none is sent through the driver, whatever its estimated size."""
    monkeypatch.setattr(impact, "SHARD_VECTORS", 7)
    monkeypatch.setattr(impact, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(impact, "SEEDS", 12)
    monkeypatch.setattr(impact, "BUNDLE_NUMBERS", 100, raising=False)
    rng = random.Random(5)
    given = {i: [float(np.float32(rng.gauss(0, 0.2))) for _ in range(6)] for i in range(160)}
    vectors = frame("vec_id long, embedding array<float>", *given.items())
    whole = {i: [math.floor(256 * x) for x in v] for i, v in given.items()}
    found = impact.search(vectors, F.col("vec_id") % 4 == 0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "RepartitionByExpression" in plan
    assert sorted(tuple(r) for r in found.collect()) == nearest(whole, [i for i in whole if i % 4 == 0], 5)


def test_topk_small_and_empty(frame):
    ddl = "vec_id long, embedding array<float>"
    assert impact.search(frame(ddl), F.col("vec_id") % 50 == 0).count() == 0
    assert impact.search(frame(ddl, (0, [1.0])), F.col("vec_id") % 50 == 0).count() == 0
    got = impact.search(frame(ddl, (0, [1.0, -1.0]), (3, [0.5, 0.5]), (2, [0.5, 0.5])), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 2, 0), (0, 2, 3, 0)]
    with pytest.raises(Exception, match="too large"):
        impact.search(frame(ddl, (0, [1e30]), (1, [1.0])), F.col("vec_id") % 50 == 0).collect()


def test_members_are_all_that_reach_the_threshold():
    rng = np.random.default_rng(3)
    for _ in range(20):
        vectors = rng.integers(-200, 200, (300, 9)) * (rng.random((300, 9)) < 0.6)
        shard, query = impact.Shard(np.arange(300), vectors), rng.integers(-200, 200, 9)
        scores = vectors @ query
        at = int(np.sort(scores)[-6])
        found = shard.members(query, at)
        assert set(np.flatnonzero(scores >= at)) <= set(found.tolist())
        assert len(found) < 150


def ranked(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, t in held:
            m = 10 + (90 * len(t) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in wanted if x in t)
            if score > 0:
                found.append((-score, math.inf if i is None else i, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["été", "naïve", "中文", "x9", "0"]
    text = lambda n: " ".join(rng.choice(words[: rng.choice([20, 120, 405])]).title() + rng.choice(["", ",", ".", "-", "\n"]) for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 40, 300]))) for i in range(160)]
    docs += [(500, None), (501, ""), (502, " .,;- "), (503, "w1 " * 5000 + text(3000)), (None, docs[3][1]), (None, "w1 w2")]
    docs += [docs[5]] * 4 + [(600 + i, docs[9][1]) for i in range(30)]
    items = [(i, text(30)) for i in range(25)] + [(40, docs[9][1]), (41, None), (42, ""), (43, "nowhere"), (None, "w1"), (44, "w1"), (44, "w2 w2"), (45, "w1 w1 W1")]
    return docs, items


@pytest.mark.parametrize("limits, seeds", [({}, 64), ({"item_bytes": 2000}, 2)])
def test_lexical_against_all_documents(frame, monkeypatch, limits, seeds):
    monkeypatch.setattr(lexical, "SEED_BLOCKS", seeds)
    docs, items = corpus(4)
    given = frame("doc_id long, text string, score string, rank int, item_id long", *((i, t, "x", 1, 2) for i, t in docs)).repartition(3)
    asked = frame("item_id long, text string, doc_id string", *((i, t, "x") for i, t in items))
    got = sorted((tuple(r) for r in lexical.search(given, asked, **limits).collect()), key=repr)
    assert got == ranked(docs, items)


def indexed(docs):
    blocks = list(lexical._blocks(pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs])))
    return [b | {"ids": b["ids"].to_pylist()} for b in blocks]


@pytest.mark.parametrize("changes", [{"BLOCK_DOCS": 7, "ITEMS_AT_ONCE": 3}, {"HASHES": 1, "BITS_PER_TERM": 1, "PLANES": 2}, {"BLOCK_BYTES": 2000}])
def test_lexical_with_other_signatures(monkeypatch, changes):
    """Bounds as loose as they come change nothing in the answer."""
    for name, value in changes.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = corpus(6)
    items = [(i, t) for i, t in items if i is not None and i not in (41, 42, 44)]
    blocks = indexed(docs)
    n, total = sum(b["n_docs"] for b in blocks), sum(b["n_terms"] for b in blocks)
    found = [t for b in blocks for t in np.frombuffer(b["terms"], np.uint64).tolist()]
    df = {t: found.count(t) for t in set(found)}
    terms = [next(lexical.term_counts(pa.array([t])))[1] for _, t in items]
    weights = [np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(x, 0) + 1))) for x in t.tolist()]) for t in terms]
    given = lexical.Plan(n, total, [i for i, _ in items], terms, weights)
    run = lexical._search(given, np.zeros(len(items), np.int64), 10)
    (batch,) = run([pa.RecordBatch.from_pylist(blocks, lexical._INDEX)])
    got = sorted((r["item"], -r["score"], math.inf if r["doc"] is None else r["doc"]) for r in batch.to_pylist())
    assert got == sorted((i, -s, math.inf if d is None else d) for i, _, d, s in ranked(docs, items))


def test_lexical_empty(frame):
    docs, items = frame("doc_id long, text string"), frame("item_id long, text string")
    assert lexical.search(docs, items).count() == 0
    assert lexical.search(frame("doc_id long, text string", (1, "a b")), items).count() == 0
    assert lexical.search(docs, frame("item_id long, text string", (1, "a b"))).count() == 0


def test_bounds_exclude_documents():
    """The signature's bounds are never below the score and refuse most documents without a term of the item."""
    docs, _ = corpus(9)
    blocks = indexed(docs)
    n, total = sum(b["n_docs"] for b in blocks), sum(b["n_terms"] for b in blocks)
    wanted = next(lexical.term_counts(pa.array(["w300 w301 w302 w303"])))[1]
    given = lexical.Plan(n, total, [1], [wanted], [np.array([1000] * len(wanted))])
    possible = true = 0
    for block in blocks:
        lengths = np.frombuffer(block["lengths"], np.int64)
        bits = np.frombuffer(block["signature"], np.uint8).reshape(-1, -(-len(lengths) // 8))
        m = 10 + 90 * lengths * n // total
        bound = lexical._Group(given, 0, 1).bounds(bits, len(lengths), lengths, m)[0]
        starts, terms, times = (np.frombuffer(block[c], k) for c, k in (("starts", np.int64), ("terms", np.uint64), ("times", np.int32)))
        for d in range(len(lengths)):
            span = slice(starts[d], starts[d + 1])
            here = np.isin(terms[span], wanted)
            score = int((1000 * lexical._share(times[span][here].astype(np.int64), m[d])).sum())
            assert bound[d] >= score
            possible, true = possible + (bound[d] > 0), true + (score > 0)
    assert true <= possible < n / 2
