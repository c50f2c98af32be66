"""Personal data, and the terms that give it away: information-theoretic sanitisation.

Base spans are patterns (``email``, ``ip``, ``card``, ``phone``). Their values are the protected
entities. A term of a text that holds an entity may reveal it, wherever it stands; how strongly is
estimated from the whole corpus. With N documents, n(e) holding entity e, n(t) holding term t and
n(e,t) holding both:

    disclosure(t, e) = log(N n(e,t) / (n(e) n(t))) / log(N / n(e))

the pointwise mutual information as a share of the information in e itself: 1 where t is only seen
with e, 0 where it is as frequent elsewhere. At ``REMOVE`` or more every occurrence of the term is removed in
all texts that hold e, at ``GENERALISE`` or more it is generalised to what kind of word it is; in
texts without e it stays. A pair needs ``SUPPORT`` different surroundings (``NEAR`` words on either
side of the term and of the entity): copies of one text are a single piece of evidence.

Scale: pairs come from the few texts with an entity. Document frequencies are counted over all
documents, for the terms of supported pairs only: tasks look words up in a bit table of fixed size
(``2^TABLE_BITS`` bits, the only thing broadcast); a join takes out what the table lets through by
chance. Counts are aggregated before they are shuffled.

Null texts are empty. Rows are told apart by id and text: null ids, repeated rows and ties are
harmless, equal rows get equal results. An entity in every row discloses nothing. Very long texts
are scanned whole; further columns of any name are not read. An empty table gives no rows.

A text counts its terms with each of its entities that stand in ``SUPPORT`` texts or more, but for terms
too frequent to disclose the entity whatever the counts: rows grow with rare terms times entities of a
text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.llm.components import written
from voxloom.llm.substrings import Ranges
from voxloom.session import ship_package

NEAR = 10
SUPPORT = 3
REMOVE = 0.8
GENERALISE = 0.5
TABLE_BITS = 24
#: Frequent terms, the most frequent first, that tasks know the frequency of before pairs are counted.
MOST_FREQUENT = 1 << 20

BASE = ("email", "ip", "card", "phone")
TERMS = ("removed", "generalised")

# Possessive forms of the four patterns: the same matches, in time linear in the text.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)?")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

#: Bytes of a term: ASCII letters (lower-cased) and digits, and all beyond ASCII; others are blanks.
TERM_BYTES = np.full(256, 0x20, dtype=np.uint8)
TERM_BYTES[128:] = np.arange(128, 256)
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    TERM_BYTES[_c] = _c
    if _c >= ord("a"):
        TERM_BYTES[_c - 32] = _c


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points."""
    found = []
    if "@" in text:
        found += [("email", *m.span()) for m in _EMAIL.finditer(text) if m[1]]
    if not _DIGITS.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_DIGITS.findall(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def _entity(kind: str, value: str) -> int:
    """Values that differ in case or separators only are one entity."""
    plain = value.lower() if kind in ("email", "ip") else "".join(_DIGITS.findall(value))
    return _hash(f"{kind}:{plain}")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def term_hashes(terms: list[str]) -> np.ndarray:
    """Hashes as ``words.word_hashes`` gives them after ``TERM_BYTES``."""
    [texts] = words.slices(pa.array([" ".join(terms)]), 1 << 40, TERM_BYTES)
    return texts.hashes().view(np.int64)


_SCAN = ("doc_id long, row long, n_email long, n_ip long, n_card long, n_phone long, base string, "
         "entities array<long>, text string")


def _scan(docs: DataFrame) -> DataFrame:
    """The base spans and entities of every row; texts of rows with an entity only."""
    def run(batches):
        for batch in batches:
            counts, base, entities, texts = [[] for _ in BASE], [], [], []
            for text in words.plain_column(batch, "text"):
                text = text.as_py()
                spans = base_spans(text)
                base.append(",".join(f"{k}:{s}:{e}" for k, s, e in spans))
                for column, k in zip(counts, BASE, strict=True):
                    column.append(sum(s[0] == k for s in spans))
                entities.append(sorted({_entity(k, text[s:e]) for k, s, e in spans}))
                texts.append(text if spans else None)
            yield pa.RecordBatch.from_arrays(
                [words.plain_column(batch, "id"), words.plain_column(batch, "row"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(base, pa.string()), pa.array(entities, pa.list_(pa.int64())), pa.array(texts, pa.string())],
                ["doc_id", "row", *(f"n_{k}" for k in BASE), "base", "entities", "text"])

    return docs.mapInArrow(run, _SCAN)


def occurrences(text: str, entity: int, near: int = NEAR) -> tuple[np.ndarray, ...]:
    """(term, start, end, whether it is the first of its term, surroundings) of all terms outside base spans.

    Surroundings are the ``near`` words on either side of the term's first place and of the entity's.
    """
    spans = base_spans(text)
    found = [(m[0], *m.span()) for m in _TERM.finditer(text)]
    codes = term_hashes([x[0] for x in found]) if found else np.zeros(0, np.int64)
    start, end = (np.array([x[i] for x in found], np.int64) for i in (1, 2))
    ranges, at, n = Ranges(codes.view(np.uint64), 0x9E3779B97F4A7C15), np.arange(len(codes)), len(codes)
    own_start, own_end = next((s, e) for k, s, e in spans if _entity(k, text[s:e]) == entity)
    left, right = int(np.searchsorted(end, own_start, side="right")), int(np.searchsorted(start, own_end))
    sides = ranges.of(np.array([max(left - near, 0), right]), np.array([left, min(right + near, n)]))
    around = ranges.of(np.maximum(at - near, 0), np.minimum(at + near + 1, n))
    outside = np.ones(n, dtype=bool)
    for _, s, e in spans:
        outside[np.searchsorted(end, s, side="right"): np.searchsorted(start, e)] = False
    codes, start, end, around = codes[outside], start[outside], end[outside], around[outside]
    _, first, inverse = np.unique(codes, return_index=True, return_inverse=True)
    is_first = np.zeros(len(codes), dtype=bool)
    is_first[first] = True
    around = words.mix(around[first][inverse] + sides[:1] * np.uint64(3) + sides[1:] * np.uint64(5))
    return codes, start, end, is_first, around.view(np.int64)


def _frequent(held: DataFrame, docs: DataFrame, total: int, near: int) -> tuple[np.ndarray, np.ndarray]:
    """(terms, n_t) of terms of ``held`` that stand in so many rows that some entity cannot be disclosed by them.

    Of those at most ``MOST_FREQUENT``: the more are known, the fewer pairs are counted in vain.
    """
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            new: set[int] = set()
            for text, entity in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new.update(np.unique(occurrences(text, entity, near)[0]).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(sorted(new - seen), pa.int64())], ["term"])
            seen = seen | new if len(seen) < MOST_FREQUENT else set()

    terms = written(held.dropDuplicates(["row"]).select("text", "entity").mapInArrow(run, "term long").distinct(), "terms")
    found = (_frequencies(docs, terms).filter(F.col("n_t").cast("double") * F.col("n_t") > total)
             .orderBy(F.desc("n_t"), "term").limit(MOST_FREQUENT).toPandas().sort_values("term"))
    return found["term"].to_numpy(np.int64), found["n_t"].to_numpy(np.int64)


def _occurrences(held: DataFrame, near: int, frequent: tuple[np.ndarray, np.ndarray], total: int, least: float) -> DataFrame:
    """The occurrences of ``held`` (doc_id, row, text, entity, n_e) whose term may disclose the entity.

    A term in n_t of N rows discloses an entity in n_e of them by log(N / n_t) / log(N / n_e) at most,
    which is when it stands in all of its rows; below ``least`` the pair need not be counted.
    """
    shared = held.sparkSession.sparkContext.broadcast(frequent)
    names = ["doc_id", "row", "entity", "term", "start", "end", "first", "around"]

    def run(batches):
        for batch in batches:
            terms, counts = shared.value
            for i, (row, text, entity, n_e) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4)), strict=True)):
                found = occurrences(text, entity, near)
                at = np.minimum(np.searchsorted(terms, found[0]), max(len(terms) - 1, 0))
                n_t = np.where(terms[at] == found[0], counts[at], 1) if len(terms) else np.ones(len(found[0]))
                may = np.log(total / n_t) >= least * np.log(total / n_e) - 1e-9
                term, start, end, first, around = (x[may] for x in found)
                n = len(term)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(n, i))), pa.array(np.full(n, row, np.int64)), pa.array(np.full(n, entity, np.int64)),
                     pa.array(term), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(first), pa.array(around)], names)

    return held.select("doc_id", "row", "text", "entity", "n_e").mapInArrow(
        run, "doc_id long, row long, entity long, term long, start int, end int, first boolean, around long")


def _frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n_t: in how many rows each of ``terms`` (term) stands, over all rows."""
    size, part = 1 << TABLE_BITS, 1 << (TABLE_BITS - 4)

    def segment(slots: pa.Table) -> pa.Table:
        """Bits of a sixteenth of the table."""
        slot = slots.column("slot").to_numpy()
        bits = np.zeros(part, bool)
        bits[slot % part] = True
        return pa.table({"segment": pa.array([int(slot[0]) // part], pa.int64()),
                         "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    slots = terms.select((F.col("term").bitwiseAND(size - 1)).alias("slot")).distinct()  # at most 2^TABLE_BITS
    table = np.zeros(size // 8, dtype=np.uint8)
    for row in slots.groupBy(F.floor(F.col("slot") / part).alias("of")).applyInArrow(segment, "segment long, bits binary").collect():
        table[row["segment"] * part // 8: (row["segment"] + 1) * part // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        counts: dict[int, int] = {}

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])
            counts.clear()
            return out

        for batch in batches:
            for texts in words.slices(words.plain_column(batch, "text"), table=TERM_BYTES):
                h = texts.hashes().view(np.int64)
                slot = h & (size - 1)
                hit = (shared.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                row = np.repeat(np.arange(len(texts.offsets) - 1), np.diff(texts.doc_first))[hit]
                h = h[hit]
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                for term, n in zip(*(x.tolist() for x in np.unique(h[new], return_counts=True)), strict=True):
                    counts[term] = counts.get(term, 0) + n
            if len(counts) > 200_000:
                yield flush()
        yield flush()

    found = docs.mapInArrow(run, "term long, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n_t")).join(terms.select("term").distinct(), "term", "left_semi")


def disclosures(occurred: DataFrame, docs: DataFrame, entities: DataFrame, total: int, support: int = SUPPORT,
                generalise: float = GENERALISE) -> DataFrame:
    """entity, term, disclosure of the pairs of ``occurred`` at or above the lower threshold."""
    pairs = occurred.filter("first")  # a pair counts once per document
    # Rows of a pair first by surroundings, so that the larger counts are sums of partial ones.
    by_around = pairs.groupBy("entity", "term", "around").agg(F.count("*").alias("n"))
    both = (by_around.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("surroundings"))
            .filter(F.col("surroundings") >= support))
    both = written(both, "pairs")
    if both.isEmpty():
        return both.select("entity", "term", F.lit(None).cast("double").alias("disclosure"))
    rated = both.join(entities, "entity").join(_frequencies(docs, both.select("term")), "term")
    n_et = F.col("n_et")
    mutual = F.log(F.lit(float(total)) * n_et / (F.col("n_e") * F.col("n_t")))
    # An entity in every row tells rows apart no more than a term could: its own information is 0.
    rated = rated.withColumn("disclosure", F.try_divide(mutual, F.log(F.lit(float(total)) / F.col("n_e"))))
    return rated.filter(F.col("disclosure") >= generalise).select("entity", "term", "disclosure")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "row", F.xxhash64("text"))


def find(docs: DataFrame, near: int = NEAR, support: int = SUPPORT, remove: float = REMOVE,
         generalise: float = GENERALISE) -> DataFrame:
    """doc_id, row (text hash), n_email.. n_phone, base, terms of every row of ``docs``.

    ``base`` are the base spans as text, ``terms`` an array of (kind, start, end) of revealing terms.
    """
    ship_package(docs.sparkSession)
    rows = _keyed(docs)
    scan = written(_scan(rows), "pii")
    each = scan.select("doc_id", "row", "text", F.explode("entities").alias("entity"))
    # A pair has at most as many surroundings as its entity has different texts: no others can be supported.
    entities = written(each.groupBy("entity").agg(F.count("*").alias("n_e"), F.count_distinct("row").alias("texts"))
                       .filter(F.col("texts") >= support).select("entity", "n_e"), "entities")
    held, total = each.join(entities, "entity"), scan.count()
    frequent = _frequent(held, rows, total, near)
    telling = written(disclosures(_occurrences(held, near, frequent, total, generalise), rows, entities, total, support, generalise), "telling")
    flagged = _occurrences(held.join(telling.select("entity").distinct(), "entity", "left_semi"), near, frequent, total, generalise).join(
        telling, ["entity", "term"])
    kind = F.when(F.col("disclosure") >= remove, 0).otherwise(1)
    spans = flagged.groupBy("doc_id", "row", "start", "end").agg(F.min(kind).alias("k")).groupBy("doc_id", "row").agg(
        F.array_sort(F.collect_list(F.struct("k", "start", "end"))).alias("terms"))
    spans = spans.withColumnRenamed("doc_id", "s_id").withColumnRenamed("row", "s_row")
    return scan.drop("entities", "text").join(spans, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("row") == F.col("s_row")), "left").drop(
        "s_id", "s_row")


def report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs``."""
    more = F.transform("terms", lambda t: F.concat_ws(":", F.element_at(F.array(*map(F.lit, TERMS)), t["k"] + 1), t["start"], t["end"]))
    spans = F.array_join(F.concat(F.when(F.col("base") != "", F.array("base")).otherwise(F.array().cast("array<string>")),
                                  F.coalesce(more, F.array().cast("array<string>"))), ",")
    return find(docs, **settings).select("doc_id", *[f"n_{k}" for k in BASE], F.sha2("base", 256).alias("base_sha256"),
                                         spans.alias("spans"))


def sanitised(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, text of every row, with personal data and revealing terms replaced.

    Base spans become ``[kind]``; removed terms go; generalised ones become ``[number]``, ``[name]``
    or ``[term]``.
    """
    found = find(docs, **settings).select(F.col("doc_id").alias("f_id"), F.col("row").alias("f_row"), "base", "terms").distinct()
    joined = _keyed(docs).join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("row") == F.col("f_row")))

    @F.pandas_udf("string")
    def replaced(text, base, terms):
        return text.combine(base.combine(terms, lambda b, t: (b, t)), lambda x, bt: clean(x, *bt))

    return joined.select(F.col("id").alias("doc_id"), replaced("text", "base", F.to_json("terms")).alias("text"))


def clean(text: str, base: str, terms: str | None) -> str:
    import json

    spans = [(int(s), int(e), f"[{kind}]") for kind, s, e in (b.split(":") for b in base.split(",") if b)]
    for t in json.loads(terms) if terms else ():
        word = text[t["start"]: t["end"]]
        kind = "[number]" if any(c.isdigit() for c in word) else "[name]" if word[:1].isupper() else "[term]"
        spans.append((t["start"], t["end"], "" if t["k"] == 0 else kind))
    out, at = [], 0
    for start, end, new in sorted(spans):
        if start >= at:
            out += [text[at:start], new]
        at = max(at, end)
    return "".join([*out, text[at:]])
