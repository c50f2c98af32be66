import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, edge_documents

from voxloom.llm import langid, words


def lettered(*texts):
    data, offsets = words.text_buffer(pa.array(texts, pa.string()))
    return langid.letter_words(data, offsets)


def plain_cuts(word):
    """All segmentations of a word; a character that is no piece stands for itself."""
    known = {name: i for i, name in enumerate(langid.vocabulary(None).names) if name}
    word = "▁" + word
    for bars in itertools.product([False, True], repeat=len(word) - 1):
        cuts = [0, *(i for i, b in enumerate(bars, 1) if b), len(word)]
        parts = [word[a:b] for a, b in itertools.pairwise(cuts)]
        if all(p in known or len(p) == 1 for p in parts):
            yield [known.get(p, 0) for p in parts]


def test_words_are_runs_of_letters_and_marks():
    codes, start, stop, row, letters = lettered("Ab c1d", "", None, "12 !", "ÉTÉ", "éx", "日本")
    text = codes.tobytes().decode("utf-32-le")
    assert [(int(r), text[a:b]) for r, a, b in zip(row, start, stop, strict=True)] == [
        (0, "ab"), (0, "c"), (0, "d"), (4, "été"), (5, "éx"), (6, "日本")]
    assert letters.tolist() == [True, False, False, False, True, True, True]


def test_forward_sums_all_segmentations():
    some = ["the", "tion", "über", "a", "hands", "x́z", "ꙮb"]
    codes, start, stop, _, _ = lettered(" ".join(some))
    vocab = langid.vocabulary(None)
    model = np.log(np.random.default_rng(3).dirichlet(np.ones(len(vocab.names)) / 9, 2).T + 1e-12)
    got = langid.log_likelihoods(vocab, codes, start, stop, model)
    for w, row in zip(some, got, strict=True):
        for k in range(2):
            assert row[k] == pytest.approx(math.log(sum(math.exp(model[p, k].sum()) for p in map(np.array, plain_cuts(w)))))
    [(_, lattice)] = langid.lattices(vocab, codes, start, stop)
    shares = lattice.shares(model[lattice.piece, 0])
    for n, w in enumerate(some):
        cuts = list(plain_cuts(w))
        p = np.array([math.exp(model[c, 0].sum()) for c in cuts])
        plain = np.zeros(len(vocab.names))
        for c, share in zip(cuts, p / p.sum(), strict=True):
            np.add.at(plain, c, share)
        own = lattice.word == n
        assert np.bincount(lattice.piece[own], shares[own], len(plain)) == pytest.approx(plain)


def test_small_products_and_remembered_words(monkeypatch):
    codes, start, stop, _, _ = lettered("日本語 hands the ꙮꙮꙮ hands übertragung")
    vocab = langid.vocabulary(None)
    model = np.log(np.random.default_rng(5).dirichlet(np.ones(len(vocab.names)) / 9, 3).T + 1e-12)
    plain = langid.log_likelihoods(vocab, codes, start, stop, model)
    [(_, lattice)] = langid.lattices(vocab, codes, start, stop)
    shares = lattice.shares(model[lattice.piece, 1])
    monkeypatch.setattr(langid, "SMALL", np.inf)
    assert langid.log_likelihoods(vocab, codes, start, stop, model) == pytest.approx(plain)
    assert lattice.shares(model[lattice.piece, 1]) == pytest.approx(shares)
    monkeypatch.setattr(langid, "KNOWN", 10)
    known = langid.Known(vocab, model)
    for some in ([0, 1], [1, 2, 3], [0, 1, 2, 3, 5], [5, 2]):
        keys, first, at = langid.different(codes, start[some], stop[some])
        assert known.of(keys, codes, start[some][first], stop[some][first])[at] == pytest.approx(plain[some])


def test_chunks_and_long_words_give_the_same(monkeypatch):
    codes, start, stop, _, _ = lettered("short " + "longword" * 400 + " end")
    vocab = langid.vocabulary(None)
    model = np.full((len(vocab.names), 1), -math.log(len(vocab.names)))
    whole = langid.log_likelihoods(vocab, codes, start, stop, model)
    monkeypatch.setattr(langid, "CHUNK", 1)
    assert langid.log_likelihoods(vocab, codes, start, stop, model) == pytest.approx(whole)
    assert np.isfinite(whole).all()


def test_languages_of_rows_not_learnt_from(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = langid.predict(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_never_reads_the_label_of_what_it_scores(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    learnt = langid.learn(docs)
    other = docs.selectExpr("doc_id", "text", "'xx' as lang", "'s' as source")
    assert sorted(langid.predict(docs, learnt).collect()) == sorted(langid.predict(other, learnt).collect())


def test_language_of_edge_rows(spark):
    docs = edge_documents(spark)
    rows = langid.predict(docs, langid.learn(docs)).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and by_id[0].score == 0
    assert by_id[5].lang_pred == "en" and by_id[5].score == 1 and by_id[None].held_out
    empty = docs.limit(0)
    assert langid.predict(empty, langid.learn(empty)).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.learn(empty)).collect()} == {"und"}
    unnamed = spark.createDataFrame([(1, "some words", None, None, None, None, None, None, None, None)], SCHEMA)
    assert [tuple(r)[2:] for r in langid.predict(unnamed, langid.learn(unnamed)).collect()] == [("und", 0.0)]
