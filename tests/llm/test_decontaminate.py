"""The filter loses nothing, and the alignment finds the closest passage."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontaminate as d

ITEM = "Thntion be esaned that, thntwhre and wh orha be ansh thhaat stinst in thstnd in thtiingea haeser thnd!"
SCHEMA = "doc_id long, text string, item_id string, edits string"


def plain_distance(item, region):
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item):
        last, row = row, [i + 1]
        for j, b in enumerate(region):
            row.append(min(last[j] + (a != b), last[j + 1] + 1, row[j] + 1))
    return min(row)


def test_alignment():
    rng = random.Random(1)
    for _ in range(400):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        region = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 22)))
        most, want = rng.randint(0, 6), plain_distance(item, region)
        got = d.align(item, region, most)
        assert (got is None) == (want > most) and (got is None or got[0] == want)
        if got:
            assert plain_distance(item, region[got[1] : got[2]]) == want


def test_nothing_within_the_budget_is_lost():
    rng = random.Random(2)
    index = d.build([7], [ITEM])
    most = int(index.edits[0])
    assert most >= 5
    for _ in range(150):
        text, k = list(ITEM), rng.randint(0, most)
        for _ in range(k):
            at = rng.randrange(len(text))
            text[at : at + rng.choice([0, 1])] = rng.choice(["", "q", "zz"][: 2])
        doc = "x y z " * rng.randint(0, 30) + "".join(text) + " tail" * rng.randint(0, 30)
        plain, own, _ = d.normalise(np.frombuffer(doc.encode(), np.uint8), np.array([0, len(doc.encode())]))
        want = plain_distance(index.texts[0], plain.tobytes())
        got = list(d._passages(pa.array([doc]), index))
        assert (len(got) == 1 and got[0][2] == want) if want <= most else not got, doc


def test_places_and_folding(frame):
    text = "Vor. ÉÀ — „ “ " + ITEM.upper().replace(" ", "  \n") + " Ende"
    bench = frame("item_id long, text string", (1, ITEM), (2, None), (3, "short"), (None, "Ünïque words that are long enough to be found"))
    docs = frame(SCHEMA, (1, text, "a", "b"), (1, text, "a", "b"), (2, None, "", ""), (3, "", "", ""), (None, ITEM[:-1], "", ""), (4, "clean text here", "", ""),
                 (5, "x ÜNÏQUE words, that are long enough to be found.", "", ""))
    rows = d.contaminated(docs, bench).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.item_id) for r in rows if r.doc_id is not None) == [(False, 1, 1), (False, 1, 1), (False, 5, None)]
    assert [r.edits for r in rows] == [0] * 4
    found = next(r for r in rows if r.doc_id == 1)
    assert text[found.start_char : found.end_char] == ITEM.upper().replace(" ", "  \n")[:-1]
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_items_in_blocks_and_long_text(frame):
    items = [(i, f"{ITEM} number {i * 7919} {i * 104729}") for i in range(30)]
    bench = frame("item_id long, text string", *items)
    long = "word " * 300_000 + items[11][1] + " word" * 300_000
    docs = frame("doc_id long, text string", (1, long), (2, items[3][1]))
    for size in (1 << 20, 500):
        rows = d.contaminated(docs, bench, index_bytes=size, edit_share=0.0).collect()
        assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 11), (2, 3)]


def test_empty_tables(frame):
    bench, docs = frame("item_id long, text string"), frame("doc_id long, text string")
    assert d.contaminated(docs, bench).count() == 0 and d.clean(docs, frame("item_id long, text string", (1, ITEM))).count() == 0
    assert d.clean(frame("doc_id long, text string", (1, ITEM)), bench).count() == 1


def test_short_items_are_found_within_the_budget():
    letters = "abcdefghijklmnopqrstuvwxyz012345678"
    for size, places in ((5, ()), (11, ()), (12, ()), (17, (8,)), (22, (11,)), (23, (11,)), (34, (11, 22)), (35, (11, 23))):
        text = list(letters[:size])
        for at in places:
            text[at] = "9"
        index = d.build([1, 2], [letters[:size], ITEM])
        got = list(d._passages(pa.array(["zz zz", f"zz {''.join(text)} zz {ITEM}"]), index))
        assert [g[:4] for g in got] == [(1, 0, len(places), 3), (1, 1, 0, size + 7)], size


def test_a_repeated_phrase_in_long_texts_is_bounded():
    """Pairs of places of text and item are counted as they are made: memory follows the bands, not the pairs."""
    import tracemalloc

    index = d.build([1, 2], ["ab " * 100, "quite another item with words of its own here"])
    for size in (30_000, 300_000):
        text = np.frombuffer(("ab " * (size // 3)).encode(), np.uint8)
        tracemalloc.start()
        found = list(d.find(text, np.array([0, len(text)]), index))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert [f[:4] for f in found] == [(0, 0, 0, 0)] and peak < 200 << 20, (size, peak >> 20)


@pytest.mark.parametrize("pairs", [7, 1000])
def test_bands_do_not_depend_on_how_pairs_are_cut(monkeypatch, pairs):
    rng = np.random.default_rng(2)
    index = d.build([0, 1], ["abab" * 30 + "end of the item", "baba cdcd " * 9])
    text = rng.choice(np.frombuffer(b"abcd ", np.uint8), 3000)
    text[500:620] = np.frombuffer(b"abab" * 30, np.uint8)
    own = np.array([0, 700, 3000])
    want = list(d.find(text, own, index))
    monkeypatch.setattr(d, "PAIRS", pairs)
    assert list(d.find(text, own, index)) == want
