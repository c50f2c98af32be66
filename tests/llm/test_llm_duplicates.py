import random

import numpy as np
from helpers import SCHEMA, components, documents, edge_documents, fingerprint, without_repeats

from voxloom.llm import components as stars
from voxloom.llm import simhash, substrings


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=1):
    rng = random.Random(seed)
    base = [[f"v{rng.randrange(3000)}" for _ in range(200)] for _ in range(6)]
    return [edited(rng, rng.choice(base), rng.randrange(4)) for _ in range(120)]


def test_fingerprints_and_components(spark):
    docs = edge_documents(spark, [*corpus(), "The END of it", "the end of it"])
    for crowd in (simhash.CROWD, 2):  # with two, crowded buckets take the finer scheme
        got = simhash.near_duplicates(docs, crowd).collect()
        assert len(got) == docs.count()
        texts = {r.doc_id: r.text for r in docs.collect()}
        assert all(int(r.fingerprint, 16) == fingerprint(texts[r.doc_id]) and len(r.fingerprint) == 16 for r in got)
        ids = [(i if i is not None else 10**9, fingerprint(t)) for i, t in texts.items()]
        want = components(ids)
        assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_one_document_of_a_group_stays(spark):
    docs = edge_documents(spark, ["same text of words"] * 3)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 3, 4, 5, 6, 7] and ids.count(None) == 1


def test_two_texts_under_one_id_count_each_for_itself(spark):
    first, other, third = ("alpha beta gamma delta", "one two three four five", "un deux trois quatre cinq six")
    rows = [(3, first), (5, first), (5, other), (7, other), (9, third), (9, third), (1, third)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, "en", "s", 1, 0.5, 7, "x", 1, 2) for i, t in order], SCHEMA)
        assert sorted((r.doc_id, r.text) for r in simhash.keep_first(docs).collect()) == [(1, third), (3, first), (5, other)]
    same = spark.createDataFrame([(1, first, "en"), (1, other, "en"), (1, first, "de")], "doc_id long, text string, lang string")
    kept = [tuple(r) for r in simhash.keep_first(same).collect()]
    assert len(kept) == 2 and {t for _, t, _ in kept} == {first, other}
    assert sorted(kept) == sorted(tuple(r) for r in simhash.keep_first(same.repartition(3, "lang")).collect())


def test_any_plan_finds_all_links():
    rng = np.random.default_rng(0)
    centre = rng.integers(0, 2**63, 40, dtype=np.int64)
    for total in (100, 10**7, 10**12):
        chosen = simhash.plan(centre, total)
        assert sum(t + 1 for _, t in chosen) == simhash.RADIUS + 1
        assert len({b for g, _ in chosen for b in g}) == sum(len(g) for g, _ in chosen)
        masks = [(sum(1 << b for b in g), t) for g, t in chosen]
        for _ in range(300):
            flip = sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))
            assert any((flip & mask).bit_count() <= t for mask, t in masks)


def test_roots_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    rows = {r.u: r.v for r in stars.roots(spark.createDataFrame(links, "u long, v long")).collect()}
    assert rows == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


def test_repeated_passages(spark):
    rng = random.Random(3)
    shared = [" ".join(f"s{rng.randrange(50)}" for _ in range(n)) for n in (9, 10, 11, 25, 60)]
    texts = []
    for _ in range(60):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(30))]
        parts = rng.sample(shared, rng.randrange(3)) + [" ".join(own)]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    texts += ["Ment, " * 80, "Ment, " * 40 + "x", texts[0], texts[5]]
    docs = edge_documents(spark, texts)
    rows = {r.doc_id: r.text for r in docs.collect()}
    want = without_repeats([(i if i is not None else 10**9, t) for i, t in rows.items()], 10)
    got = substrings.remove_repeats(docs, window=10, gram=3).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id if r.doc_id is not None else 10**9]


def test_repeats_of_nothing(spark):
    assert substrings.remove_repeats(documents(spark, [])).count() == 0
