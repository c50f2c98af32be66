import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, documents, edge_documents, sha

from voxloom.llm import divergence, fim


def plain_fim(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the contract's words."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def lined(count, seed):
    r = random.Random(seed)
    return ["".join(r.choice(["a b", "é中", "\n", "\n\n", "word\r\n", "<P", ">", "x" * 30]) for _ in range(r.randrange(30))) for _ in range(count)]


def check_fim(docs):
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = Counter()
    for i, t in given:
        n, form, a, b, out = plain_fim(i, t)
        want[i, n, form, a, b, sha(out), sha(t or "")] += 1
    assert Counter(tuple(r) for r in fim.digests(docs).collect()) == want
    assert Counter(tuple(r) for r in fim.texts(docs).collect()) == Counter((i, *plain_fim(i, t)) for i, t in given)


def test_fim_matches_plain_python(spark):
    check_fim(documents(spark, [*lined(150, 1), "has <P>\nin it", "<M>", "a\nb<S>", "one line", "\n", "end\n"]))
    check_fim(edge_documents(spark))


def test_fim_in_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(fim, "PIECE_CHARS", 7)
    monkeypatch.setattr(fim, "BATCH_CHARS", 50)
    texts = lined(40, 2)
    assert all("".join(fim.chunks(t, 0, len(t))) == t and max(map(len, fim.chunks(t, 0, len(t)))) <= 7 for t in texts)
    check_fim(documents(spark, [*texts, "x" * 100, "a\n" * 50]))


def test_fim_copies_of_one_row_and_empty_tables(spark):
    docs = documents(spark, ["a\nb\nc\n", "other"])
    copies = docs.filter("doc_id = 0").selectExpr("*", "explode(sequence(1, 300)) as k").drop("k").repartition(3)
    check_fim(docs.unionByName(copies))
    assert fim.digests(docs.limit(0)).count() == 0 and fim.texts(docs.limit(0)).count() == 0


def test_fim_pieces_come_in_one_shuffle(spark):
    plan = fim.digests(documents(spark, ["a\nb"]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def plain_audit(rows):
    docs = [(t or "", lang or "", s or "") for t, lang, s in rows]
    words = [(lang, s, Counter(w.decode().translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(
        rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.encode()))) for t, lang, s in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(s, c) for x, s, c in words if x == lang]
        df = Counter(w for _, c in own for w in c)
        kept = [w for w, n in df.items() if n >= 3]
        sources = sorted({s for s, _ in own})
        count = {s: Counter() for s in sources}
        for s, c in own:
            count[s].update({w: n for w, n in c.items() if df[w] >= 3})
        size = {s: sum(count[s].values()) for s in sources}
        if kept:
            p = {s: {w: 1 + 10**9 * (count[s][w] + 1) // (size[s] + len(kept)) for w in kept} for s in sources}
            q = {w: 1 + 10**9 * (sum(count[s][w] for s in sources) + 1) // (sum(size.values()) + len(kept)) for w in kept}
        for s in sources:
            pair = [(sum((p[s][w] - p[o][w])**2 // p[o][w] for w in kept), o) for o in sources if o != s]
            term = [((p[s][w] - q[w])**2 // q[w], w) for w in kept if count[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pair), ("term", term)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(ranked, 1) if part == "pair" or r <= 200]
    return sorted(out)


def corpus(count, seed, vocabulary, sources=4):
    r = random.Random(seed)
    word = [f"w{'x' * (i % 7)}{chr(97 + i % 26)}é{chr(97 + i // 26)}" for i in range(vocabulary)]
    return [(" ".join(r.choice(word).upper() if r.random() < 0.1 else r.choice(word) for _ in range(r.randrange(25))),
             r.choice(["a", "a", "b", None]), r.choice([None, *(f"s{i}" for i in range(sources))])) for _ in range(count)]


def as_table(spark, rows):
    return spark.createDataFrame([(1, t, lang, s, 1, 0.5, 7, "x", 1, 2) for t, lang, s in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("held, cells", [(divergence.HELD, divergence.CELLS), (9, 16)])
def test_audit_matches_plain_python(spark, monkeypatch, held, cells):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "CELLS", cells)
    rows = corpus(120, 5, 300)
    assert sorted(map(tuple, divergence.audit(as_table(spark, rows)).collect())) == plain_audit(rows)


def test_audit_ranks_to_the_limit(spark):
    rows = corpus(1500, 6, 900, sources=1)
    got = sorted(map(tuple, divergence.audit(as_table(spark, rows)).collect()))
    assert got == plain_audit(rows) and max(r[5] for r in got if r[2] == "term") == 200


def test_audit_of_edge_rows(spark):
    docs = edge_documents(spark, ["...", "12 34"])
    want = plain_audit([(r.text, r.lang, r.source) for r in docs.collect()])
    assert sorted(map(tuple, divergence.audit(docs).collect())) == want
    few = as_table(spark, [("only here", "a", "s"), ("other words", "a", "t"), (None, None, None)])
    assert sorted(map(tuple, divergence.audit(few).collect())) == [("a", "s", "pair", "t", 0, 1), ("a", "t", "pair", "s", 0, 1)]
    assert divergence.audit(docs.limit(0)).count() == 0


def test_shares_beyond_machine_numbers():
    count = np.array([0, 5, 10**12, 3 * 10**15])
    for total in (4 * 10**15, 2**60):
        assert divergence.share(count, np.array(total)).tolist() == [1 + 10**9 * (c + 1) // total for c in count.tolist()]
