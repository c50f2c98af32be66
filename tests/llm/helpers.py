"""Rows that every operator must take, and plain-Python versions of what the operators compute."""

import hashlib
import re

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, id string, part int, at int"


def documents(spark, texts, first=0):
    """A documents table, with further columns whose names clash with those inside operators."""
    rows = [(i, t, "en", "s", len(t or ""), 0.5, 7, "x", 1, 2) for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, SCHEMA)


def edge_documents(spark, extra=()):
    """Nulls, empty and blank texts, a very long one, repeated rows, a null id."""
    texts = [None, "", " \t\n ", "word", "two words", "long " * 60_000, "é Ünï – 中文   x", *extra]
    docs = documents(spark, texts)
    again = docs.filter("doc_id in (3, 4)")
    nameless = spark.createDataFrame([(None, "no id", None, None, None, None, None, None, None, None)], SCHEMA)
    return docs.unionByName(again).unionByName(nameless)


def fingerprint(text):
    lowered = re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(shingles))


def components(prints):
    """{id: smallest reachable id} of [(id, fingerprint)]."""
    label = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints:
            for j, b in prints:
                if (a ^ b).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def without_repeats(rows, window):
    """{id: (words, removed, sha256 of what is kept)} of [(id, text)], ids distinct."""
    split = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for i, t in rows}
    first = {}
    for i in sorted(split):
        for j in range(len(split[i]) - window + 1):
            first.setdefault(tuple(split[i][j:j + window]), i)
    out = {}
    for i, w in split.items():
        gone = {k for j in range(len(w) - window + 1) if first[tuple(w[j:j + window])] < i for k in range(j, j + window)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits))) % 10 == 0


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def pii_spans(text):
    return [(k, m.start(), m.end()) for k, (r, ok) in PII.items() for m in re.finditer(r, text or "") if ok(m[0])]


def secret_spans(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text or "", re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
