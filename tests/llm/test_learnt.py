"""The learnt operators: codes, decoding, the risk, the prior, and awkward rows."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import grams, language, quality, sampling

EN = "the cat and the dog went to the house with all of their friends "
DE = "der hund und die katze gingen mit allen freunden in das haus zurück "
FR = "le chien et le chat sont allés à la maison avec tous leurs amis "


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12, 40])
def test_codewords_are_apart(n):
    code = language.codewords(n)
    apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
    assert apart >= (1 if n == 2 else code.shape[1] // 4) and len({tuple(c) for c in code.T.tolist()}) <= code.shape[1]


def labelled(frame, extra=()):
    rows = [(i, (t + str(i)) * (1 + i % 3), lang, "s") for i in range(40) for t, lang in ((EN, "en"), (DE, "de"), (FR, "fr"))]
    return frame("doc_id long, text string, lang string, score string", *rows, *extra)


def test_language_rows(frame):
    extra = [(900, None, "en", ""), (901, "", "en", ""), (902, "12 ½ -- ²³", "en", ""), (903, DE * 3000, None, ""), (None, FR, "fr", ""), (905, "漢字かな", None, "")]
    docs = labelled(frame, extra)
    rows = {r.doc_id: r for r in language.held_out_predictions(docs).collect() if r.doc_id is None or r.doc_id >= 900}
    assert [rows[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and rows[900].score == 0
    assert rows[903].lang_pred == "de" and rows[None].lang_pred == "fr" and rows[None].held_out and rows[905].lang_pred in ("de", "en", "fr")
    kept = language.keep_decided(docs, language.train_on_folds(docs))
    assert kept.columns == docs.columns and {900, 901, 902}.isdisjoint(r.doc_id for r in kept.collect()) and kept.count() >= 121


def test_language_with_little_to_learn(frame):
    empty = frame("doc_id long, text string, lang string")
    assert language.held_out_predictions(empty).count() == 0
    none = frame("doc_id long, text string, lang string", (1, EN, None), (2, None, "en"))
    assert [r.lang_pred for r in language.held_out_predictions(none).collect()] == ["und", "und"]
    one = frame("doc_id long, text string, lang string", *((i, EN, "en") for i in range(8)))
    assert {r.lang_pred for r in language.held_out_predictions(one).collect()} == {"en"}


def test_decoding_prefers_the_nearest_codeword():
    code = language.codewords(4)
    model = language.Model(("a", "b", "c", "d"), code, np.eye(7, dtype=np.float32), np.zeros(7, np.float32), np.ones(7, np.float32))
    noisy = code.copy() * 3
    noisy[:, 2] *= -1  # one classifier is wrong everywhere
    best, score, lead = model.decode(noisy)
    assert best.tolist() == [0, 1, 2, 3] and (lead > language.AMBIGUOUS).all()
    assert model.decode(np.zeros((1, 7), np.float32))[2][0] < language.AMBIGUOUS


def test_histograms_do_not_depend_on_blocks():
    texts = pa.array(["abcABC", None, "", "xyz", "äää", "hello world " * 50])
    whole = np.concatenate([c for _, _, c in grams.histograms(texts, (1, 3), 64)])
    parts = np.concatenate([c for _, _, c in grams.histograms(texts, (1, 3), 64, block=7)])
    assert (whole == parts).all() and whole.sum(1).tolist() == [10, 0, 0, 4, 10, 600 + 598]


def test_prior_and_risk():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, (3000, 3)), rng.normal(-2, 1, (3000, 3))
    mixed = np.concatenate([good[:1400], bad[:600]])
    prior = quality.estimate_prior(good[1400:, 0], mixed[:, 0])
    assert 0.5 < prior <= 0.72
    model = quality.fit(good[1400:].astype(np.float32), mixed.astype(np.float32))
    assert (model.score(good[:500]) > 0.5).mean() > 0.97 and (model.score(bad[1000:1500]) < 0.5).mean() > 0.97


def test_quality_rows(frame):
    good = [(i, EN * (1 + i % 4) + str(i), "") for i in range(150)]
    junk = [(1000 + i, "### $$$ %%% " * 20 + str(i), "") for i in range(40)]
    docs = frame("doc_id long, text string, score string", *good, *junk, (5000, None, ""), (5001, "", ""), (None, EN, ""), (3, good[3][1], ""))
    labels = frame("doc_id long, quality int, toxic int", *((i, 1, None) for i in range(100)), *((1000 + i, 0, None) for i in range(20)), (None, 1, None), (1, None, None))
    rows = quality.held_out_scores(docs, labels).collect()
    assert len(rows) == 194 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[None].held_out and by[5000].score == by[5001].score
    assert np.mean([r.predicted for r in rows if r.doc_id and r.doc_id >= 1000 and r.doc_id < 5000]) < 0.2 < 0.9 < np.mean([r.predicted for r in rows if r.doc_id is not None and r.doc_id < 1000])


def test_quality_with_nothing_to_learn(frame):
    docs, labels = frame("doc_id long, text string", (1, EN), (2, None)), frame("doc_id long, quality int")
    assert [r.score for r in quality.held_out_scores(docs, labels).collect()] == [0.5, 0.5]
    assert quality.held_out_scores(docs.limit(0), labels).count() == 0


def test_sample_is_bounded_and_stable(frame):
    rows = frame("doc_id long, text string, g string", *((i, "t", "a" if i % 10 else "b") for i in range(3000)))
    one = sampling.thinned(rows, "doc_id", "g", 400)
    assert 250 < one.count() < 550 and one.exceptAll(sampling.thinned(rows.repartition(7), "doc_id", "g", 400)).count() == 0
    with pytest.raises(ValueError):
        sampling.thinned(rows, "doc_id", "doc_id", 10, 5)
