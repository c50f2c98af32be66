import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from compare import compare, duck
from helpers import documents, edge_documents, fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from voxloom.llm import chat, packing, queries, topk


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, small, name):
    assert compare(spark, duck(small), small, queries.QUERIES[name], queries.SQL[name]) is None


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, slice string, n long")


def test_snapshots_collapse(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"),
            (3, 2, "user", "c"), (4, 0, "user", "a"), (4, 1, "assistant", "other"), (5, 7, "user", "a"), (5, 9, "assistant", "other"),
            (6, 0, None, None), (6, None, "system", "first"), (6, 0, None, None), (None, 0, "user", "lost")]
    got = {(r.conv_id, r.part): r for r in chat.render(conversations(spark, rows)).collect()}
    assert sorted(got) == [(3, 0), (4, 0), (6, 0), (6, 1)]
    assert got[3, 0].text == ("<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"
                              "<|im_start|>user\nc<|im_end|>\n")
    assert got[6, 0].text == "<|im_start|>system\nfirst<|im_end|>\n"
    assert chat.render(conversations(spark, rows).limit(0)).count() == 0


def test_long_conversations_in_slices(spark):
    long = [(1, t, "user", f"t{t}") for t in range(20)]
    shorter = [(2, t, "user", f"t{t}") for t in range(13)]
    other = [(3, t, "user", f"t{t}") for t in range(12)] + [(3, 12, "user", "else")]
    got = chat.render(conversations(spark, long + shorter + other), size=4).collect()
    assert {r.conv_id for r in got} == {1, 3}
    text = "".join(r.text for r in sorted(got, key=lambda r: r.part) if r.conv_id == 1)
    assert [x.split("<")[0] for x in text.split("user\n")[1:]] == [f"t{t}" for t in range(20)]
    assert max(r.n_turns for r in got) == 4


def plain_top(rows, step, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors[i] = [int(np.floor(256 * float(x))) for x in v]
    out = []
    for q in vectors:
        if q % step == 0:
            best = sorted((-sum(a * b for a, b in zip(vectors[q], w, strict=False)), i) for i, w in vectors.items() if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(i, [1.0] * 8) for i in range(300, 360)]  # ties
    rows += [(400, None), (401, [float("nan")] * 8), (402, [1.0, None] * 4), (403, [float("inf")] * 8), (None, [1.0] * 8),
             (350, [1.0] * 8), (404, []), (405, [3.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, cell int")
    for step in (50, 1):
        got = sorted(tuple(r) for r in topk.search_every(df, step).collect())
        assert got == plain_top([r for r in rows], step, 5)
    assert topk.search_every(df.limit(0), 50).count() == 0
    few = df.filter("vec_id in (0, 1, 300)")
    assert sorted(tuple(r) for r in topk.search_every(few, 1).collect()) == plain_top(rows[:2] + rows[300:301], 1, 5)


def test_last_round_visits_all_annuli(spark, monkeypatch):
    """Vectors so alike in length and spread that bounds hardly prune; more annuli than any round names."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=12)]) for i in range(400)]
    data = topk.vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    asked = data.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    index = topk.Index(data, pivots=48, annuli=8)
    assert len(index.cells) > topk.ROUNDS[-1]
    assert sorted(tuple(r) for r in index.search(asked, 5, rounds=(1, 2)).collect()) == plain_top(rows, 20, 5)


def test_scores_beyond_longs_are_an_error(spark):
    def table(rows):
        return spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    large = [(50, [2e6, 1.0]), (1, [3e6, -2.0]), (2, [-2e6, 4.0])]
    assert sorted(tuple(r) for r in topk.search_every(table(large), 50).collect()) == plain_top(large, 50, 5)
    for v in ([3e7], [4e16], [1e300]):
        with pytest.raises(ValueError, match="64-bit"):
            topk.search_every(table([(50, [1e7]), (1, v), (2, [3e7])]), 50)
    with pytest.raises(ValueError, match="64-bit"):
        data = topk.vectors(table([(1, [1.0])]))
        topk.Index(data).search(topk.vectors(table([(1, [1e17])])).withColumnRenamed("vec_id", "query_id"))


def test_crowded_annuli_are_split(spark, monkeypatch):
    monkeypatch.setattr(topk, "VISITORS", 7)
    rows = [(i, [1.0, float(i % 3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    data = topk.vectors(df)
    asked = data.withColumnRenamed("vec_id", "query_id")
    got = sorted(tuple(r) for r in topk.Index(data, block=16).search(asked, 5, rounds=(1, 2, 300)).collect())
    assert got == plain_top(rows, 1, 5)


def test_packing_is_whole_and_full(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "naïve", "Don't!!", "é.", "x1y2", "中文", "<|endoftext|>", "’s"]) for _ in range(rng.randrange(900)))
             for _ in range(60)]
    docs = edge_documents(spark, texts).coalesce(2)
    rows = docs.select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(docs, window_tokens=20_000).collect()
    for r in {(r.doc_id, r.text): r for r in rows}.values():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted((p for p in pieces if p.doc_id == r.doc_id), key=lambda p: p.start)
        copies = sum(x.doc_id == r.doc_id for x in rows)
        assert sum(p.length for p in own) == copies * len(ids)
        for p in own:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start: p.start + p.length].tobytes())
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length, p.sequence_tokens))
    for own in sequences.values():
        own.sort()
        ends = np.cumsum([n for _, n, _ in own])
        assert [o for o, _, _ in own] == [0, *ends[:-1]] and ends[-1] == own[0][2] <= packing.CAPACITY
        assert ends[-1] == packing.CAPACITY or ends[-1] & (ends[-1] - 1) == 0
    assert packing.pack(documents(spark, [])).count() == 0


def test_costs_are_balanced():
    rng = random.Random(0)
    lengths = [rng.randrange(1, 3000) for _ in range(2000)]
    pieces, sizes = packing.assign(lengths)
    cost, first_fit = np.zeros(len(sizes)), []
    for _, _, n, s, _ in pieces:
        cost[s] += packing.cost(n)
    full = cost[np.array(sizes) == packing.CAPACITY]
    bins, used = [], packing.CAPACITY
    for n in lengths:  # in the order of the rows
        if used + n > packing.CAPACITY:
            bins.append(0.0)
            used = 0
        bins[-1] += packing.cost(n)
        used += n
    assert full.std() / full.mean() < np.std(bins) / np.mean(bins) and not first_fit


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    schema, before = docs.schema, None
    for (_, stage), whole in zip(corpus_pipeline.STAGES[:-1], [False, False, False, True], strict=True):
        stage(spark, docs, sf).write.parquet(path := str(tmp_path / stage.__name__))
        after = spark.read.parquet(path)
        assert after.schema == schema and 0 < after.count() <= docs.count()
        if whole:
            assert after.count() == docs.count()
        before, docs = docs, after
    prints = [fingerprint(r.text) for r in before.collect()]
    near = sum((a ^ b).bit_count() <= 3 for i, a in enumerate(prints) for b in prints[:i])
    assert near == 0
    assert sum(r.length for r in corpus_pipeline.run(spark, sf).collect()) == sum(
        r.length for r in corpus_pipeline.packed(spark, docs, sf).collect())


def pipeline_tables(spark, folder, docs, labels, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_of_edge_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, a null id, columns with clashing names."""
    leak = " ".join(f"leak{i}" for i in range(30))
    docs = edge_documents(spark, [f"before {leak} after", "password=longenough123 in a text", "same words here now", "same words here now"])
    labels = [(i, 1, 0) for i in range(12)] + [(3, None, None), (None, 1, 1)]
    pipeline_tables(spark, tmp_path / "a", docs, labels, [(1, leak), (2, None), (3, "")])
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, str(tmp_path / "a"))
        held.write.parquet(str(tmp_path / name))
        held = spark.read.parquet(str(tmp_path / name))
        assert held.columns == docs.columns
    rows = {r.doc_id: r.text for r in held.collect()}
    # 1 and 2 are as empty as 0, 7 leaks, 10 repeats 9, rows 3 and 4 are there twice.
    assert sorted(rows, key=str) == sorted([0, 3, 4, 5, 6, 8, 9, None], key=str) and held.count() == 8
    assert rows[8] == "[assign] in a text" and rows[5] == "long " * 60_000
    pieces = corpus_pipeline.run(spark, str(tmp_path / "a")).collect()
    whole = {}
    for r in pieces:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
        assert whole[r.doc_id] <= r.doc_tokens
    assert set(whole) == set(rows) and whole == {r.doc_id: r.doc_tokens for r in pieces}


@pytest.mark.parametrize("labels", [[], [(1, 0, 0), (2, 1, 0)]])
def test_pipeline_of_empty_tables(spark, tmp_path, labels):
    pipeline_tables(spark, tmp_path / "b", documents(spark, []), labels, [])
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0
    docs = documents(spark, ["only one text", None])
    pipeline_tables(spark, tmp_path / "c", docs, labels, [])
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "c")).collect()} == {0, 1}
