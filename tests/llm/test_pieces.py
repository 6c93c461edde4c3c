"""Encoding in chunks against the model's own encoding of the whole text."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pieces

CODE = pieces.codec(pieces.MODEL)
PARTS = ["a", "the ", "ing", " ", "  ", "\n", "é", "漢", "z", "tion", "    ", "1", "\U0001f600", "0x", "▁"]


def chunked(text, chunk):
    seen = pieces.escaped(text)
    cuts = pieces._bounds(len(seen), chunk)
    at = [[(0, None)], *(pieces.states(CODE, seen, c) for c in cuts[1:-1]), [(len(seen), None)]]
    matrices = [pieces.transfer(CODE, seen, at[i], at[i + 1], cuts[i], cuts[i + 1]) for i in range(len(cuts) - 1)]
    ends = [0, *(at[i + 1][s][0] for i, s in enumerate(pieces.trace(matrices))), len(seen)]
    return [i for a, b in zip(ends, ends[1:]) for i in CODE.middle(seen[a:b])], matrices


def texts(n, size):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, size))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [20, 33, 150])
def test_chunks_give_the_whole_encoding(chunk):
    for text in texts(60, 150):
        assert chunked(text, chunk)[0] == CODE.whole(text), text


def test_product_is_associative():
    _, m = chunked(texts(1, 3000)[0] * 3, 200)
    left = pieces.combine(pieces.combine(m[0], m[1]), m[2])
    assert (left == pieces.combine(m[0], pieces.combine(m[1], m[2]))).all()


def test_rows(spark, frame):
    long = [t * 4 for t in texts(6, 200)]
    rows = [(i, t, "x") for i, t in enumerate([*long, "", None, "short", "short", "a▁b", " \n "])] + [(None, long[0], "x"), (0, long[1], "x")]
    docs = frame("doc_id long, text string, n_tokens string", *rows)
    whole = pieces.per_document(docs).select("doc_id", "n_tokens", "ids_digest", "round_trip")
    parts = pieces.per_document(docs, chunk=128)
    assert max(r.n_chunks for r in parts.collect()) > 2
    want = sorted(map(str, whole.collect()))
    assert sorted(map(str, parts.select("doc_id", "n_tokens", "ids_digest", "round_trip").collect())) == want
    got = {r.doc_id: r for r in whole.collect() if r.doc_id not in (None, 0)}
    for i, text, _ in rows[1:-2]:
        assert got[i].n_tokens == len(CODE.whole(text or "")) and got[i].round_trip == ("▁" not in (text or ""))


def test_empty_table(frame):
    docs = frame("doc_id long, text string")
    assert pieces.per_document(docs).count() == 0


def test_decoded_chunks_are_the_text(spark, frame):
    text = "Ünï  code 漢字 and more. " * 40
    rows = pieces.encode(frame("doc_id string, text string", ("a", text)), chunk=100).orderBy("chunk").collect()
    assert "".join(pieces.decode(CODE, r.ids, r.chunk == 0) for r in rows) == text and len(rows) > 5
