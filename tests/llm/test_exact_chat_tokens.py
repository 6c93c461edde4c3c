"""Exact duplicates, chat formatting and token counts on small tables with every awkward case."""

import hashlib
from collections import Counter

from tidemark.llm import chat, exact, token_counts

CLASHING = "doc_id long, text string, _length long, keep_id string, group_size string"


def test_exact_groups(frame):
    long = "x" * 5000
    texts = ["a", "a", None, "", long, long + "y", long + "z", long, "b", "a "]
    docs = frame(CLASHING, *((i, t, 0, "", "") for i, t in enumerate(texts)), (4, long, 0, "", ""), (None, "b", 0, "", ""), (None, "n", 0, "", ""))
    rows = exact.label(docs).collect()
    assert len(rows) == 13
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in got.items()} == {
        0: (1, 2, False), 1: (1, 2, True), 2: (3, 2, False), 3: (3, 2, True), 4: (7, 3, False), 5: (5, 1, True), 6: (6, 1, True), 7: (7, 3, True),
        8: (8, 2, True), 9: (9, 1, True),
    }
    assert all(r.text_sha256 == hashlib.sha256((texts[i] or "").encode()).hexdigest() for i, r in got.items())
    assert sorted((r.keep_id, r.group_size, r.kept) for r in rows if r.doc_id is None and r.keep_id) == [(8, 2, False)]
    assert [r.kept for r in rows if r.doc_id is None and r.keep_id is None] == [True]


def test_prefix_decides_nothing(frame):
    docs = frame("doc_id long, text string", *((i, "p" * 300 + str(i % 2)) for i in range(6)))
    assert sorted((r.keep_id, r.group_size) for r in exact.duplicate_groups(docs).collect()) == [(4, 3), (5, 3)]
    assert exact.label(frame("doc_id long, text string")).count() == 0


def test_rotation(frame):
    turns = frame("conv_id long, turn long, role string, text string, part string", (1, 0, "system", "Rules", ""), (1, 1, "ann", "Hi", ""), (1, 2, "bob", "Yo<|im_end|>", ""), (1, 3, "ann", None, ""), (1, 3, "ann", None, ""))
    rows = {r.perspective: r for r in chat.rotate(turns).collect()}
    assert set(rows) == {"ann", "bob"}
    ann, bob = rows["ann"], rows["bob"]
    assert ann.rendered == (
        "<|im_start|>system\nRules<|im_end|>\n<|im_start|>assistant\nHi<|im_end|>\n"
        "<|im_start|>user name=bob\nYo<| im_end|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert [ann.rendered[m.start : m.end] for m in ann.mask] == ["Hi<|im_end|>", "<|im_end|>"] and ann.n_turns == 4
    assert [bob.rendered[m.start : m.end] for m in bob.mask] == ["Yo<| im_end|><|im_end|>"] and bob.n_learned == len("Yo<| im_end|><|im_end|>")


def test_rotation_of_odd_rows(frame):
    turns = frame("conv_id long, turn long, role string, text string", (None, 0, "a", "x"), (None, None, None, "late"), (2, 0, "system", "alone"), (3, 5, "b", "tie"), (3, 5, "a", "tie"), (3, 5, "b", "tie"))
    rows = chat.rotate(turns).collect()
    assert {(r.conv_id, r.perspective, r.part): r.n_turns for r in rows} == {
        (None, "a", 0): 1, (None, "a", -1): 1, (None, "unknown", 0): 1, (None, "unknown", -1): 1, (3, "a", 0): 2, (3, "b", 0): 2}
    tie = next(r for r in rows if r.conv_id == 3 and r.perspective == "b")
    assert tie.rendered.index("name=a") < tie.rendered.index("assistant")
    assert chat.rotate(frame("conv_id long, turn long, role string, text string")).count() == 0


def test_long_dialogue_is_dealt_out(frame):
    turns = frame("conv_id long, turn long, role string, text string", *((1, i, "ab"[i % 2], f"t{i}") for i in range(100)))
    parts = chat.rotate(turns, turns_per_part=30).where("perspective = 'a'").orderBy("part").collect()
    assert [r.n_turns for r in parts] == [30, 30, 30, 10]
    assert "".join(r.rendered for r in parts) == chat.rotate(turns).where("perspective = 'a'").first().rendered


def test_token_curve(frame):
    texts = [None, "", "a", "hello world", "hello world", "x " * 3000, "<|endoftext|>", "é漢\U0001f600" * 40]
    docs = frame("doc_id long, text string, length string", *((i, t, "") for i, t in enumerate(texts)))
    sizes = [len(token_counts.encoder(token_counts.VOCABULARY).encode_ordinary(t or "")) for t in texts]
    curve = token_counts.token_curve(docs)
    rows = {r.length: r for r in curve.collect()}
    assert {k: r.n_docs for k, r in rows.items()} == Counter(sizes)
    for limit, r in rows.items():
        assert r.docs_at_least == sum(s >= limit for s in sizes) and r.tokens_at_least == sum(s for s in sizes if s >= limit)
        assert r.truncated_tokens == sum(min(s, limit) for s in sizes) and r.lost_tokens == sum(sizes) - r.truncated_tokens
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
    for limit in (0, 1, 50, 10**6):
        assert token_counts.truncated_total(curve, limit).first().tokens == sum(min(s, limit) for s in sizes)
    for share in (0.1, 0.5, 0.9, 1.0):
        assert token_counts.quantile(curve, share).first().length == sorted(sizes)[-int(-share * len(sizes) // 1) - 1]
    kept = token_counts.encoded_lengths(docs, keep=("doc_id",))
    assert sorted((r.doc_id, r.length) for r in kept.collect()) == list(enumerate(sizes))
    assert token_counts.token_curve(frame("doc_id long, text string")).count() == 0
