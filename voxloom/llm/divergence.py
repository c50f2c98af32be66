"""Source divergence audit by in-mapper stripes.

For each language, how far the words of each source lie from those of each other source, and which
terms set a source apart from its language.

1. The groups (lang, source) are listed and handed to all tasks: the result has a row for each pair
   of them in a language, so the list is about the square root of it.
2. Each task folds whole documents into a table of stripes, (lang, term) -> (document frequency,
   {source: count}), terms hashed by dictionary encoding. When the table holds ``HELD`` counts or
   ``HELD_BYTES`` of terms, its stripes go to the shuffle and it starts anew.
3. Stripes are dealt and sorted by (lang, term), and merged as a stream: of a key that goes on, a
   task holds one merged stripe, with at most one count per source. Terms in fewer than ``MIN_DOCS``
   documents of a language go. Sizes of the groups are sums over the merged stripes.
4. Merged stripes emit divergences: a stripe adds, for each source that has the term and every
   source of the language, what differs from the case that neither has it; that case is the same for
   all terms and is added once per pair. So work grows with counts times sources, not terms times
   pairs. A task adds up its pairs, and keeps the ``top`` best terms per group.

All arithmetic is on integers: shares are p = 1 + floor(SCALE * (count + 1) / (N + V)), divergences
floor((p - q)^2 / q).

Null texts, languages and sources are empty. ``doc_id`` is not read: repeated rows and rows without
an id are documents of their own; further columns are not read. Ties go to the smaller item in
UTF-8 order. A group without terms has all counts 0; a language without kept terms has divergences
of 0; an empty table gives no rows. Very long texts are folded whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.llm.components import written
from voxloom.session import ship_package

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
HELD, HELD_BYTES = 300_000, 16 << 20
#: Terms whose best are not chosen yet.
CANDIDATES = 100_000
#: Numbers of an intermediate matrix.
CELLS = 1 << 18
BATCH = 8_000
#: Bytes of text folded at once.
SLICE_BYTES = 1 << 18

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"): ord("Z") + 1] = _LETTER[ord("a"): ord("z") + 1] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32

STRIPES = "lang int, term string, docs long, sources array<int>, counts array<long>"
_EMITTED = "lang int, source int, other int, term string, value long"


class Groups:
    """The sources of each language, both in order; a source is known by its place in its language."""

    def __init__(self, pairs: list[tuple[str, str]]):
        self.names: list[str] = sorted({lang for lang, _ in pairs})
        self.sources: list[list[str]] = [[] for _ in self.names]
        self.place: dict[tuple[str, str], tuple[int, int]] = {}
        number = {name: i for i, name in enumerate(self.names)}
        for lang, source in sorted(pairs):
            own = self.sources[number[lang]]
            self.place[lang, source] = number[lang], len(own)
            own.append(source)
        self.most = max(map(len, self.sources), default=1)

    def of(self, langs: pa.Array, sources: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Language and place of the source of each row."""
        found = [self.place[x] for x in zip(langs.to_pylist(), sources.to_pylist(), strict=True)]
        out = np.array(found, np.int64).reshape(-1, 2)
        return out[:, 0], out[:, 1]


def _first_of_runs(*columns: np.ndarray) -> np.ndarray:
    change = np.ones(len(columns[0]), bool)
    change[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(change)


def _stripes(lang: np.ndarray, terms: pa.Array, docs: np.ndarray, stripe: np.ndarray, source: np.ndarray,
             count: np.ndarray, most: int) -> pa.RecordBatch:
    """Stripes (lang, term, docs) with their counts, given as (stripe, source, count) in any order, equal ones added up."""
    key = stripe * most + source
    order = np.argsort(key, kind="stable")
    first = _first_of_runs(key[order])
    key, count = key[order][first], np.add.reduceat(count[order], first)
    offsets = np.searchsorted(key, np.arange(len(docs) + 1) * most).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.int32()), terms, pa.array(docs, pa.int64()),
         pa.ListArray.from_arrays(offsets, pa.array(key % most, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(count, pa.int64()))],
        ["lang", "term", "docs", "sources", "counts"])


def _letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(the terms of some texts, dictionary-encoded, how many stand before each text)."""
    starts, ends = words.word_bounds(data, offsets, ~_LETTER)
    solid = np.ascontiguousarray(_LOWER[data[_LETTER[data]]])
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(solid))
    return terms.dictionary_encode(), np.searchsorted(starts, offsets)


class Table:
    """Counts of the documents folded so far; terms are dictionary-encoded per slice of texts until they leave."""

    def __init__(self, most: int):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.terms, self.docs, self.counts, self.held, self.bytes, self.size = [], [], [], 0, 0, 0

    def fold(self, data: np.ndarray, offsets: np.ndarray, lang: np.ndarray, source: np.ndarray) -> None:
        terms, first = _letter_runs(data, offsets)
        size = len(terms.dictionary)
        if not size:
            return
        row = np.repeat(np.arange(len(lang)), np.diff(first))
        each, n = np.unique(row * size + terms.indices.to_numpy(), return_counts=True)  # one of each document and term
        row, term = each // size, each % size
        self.terms.append(terms.dictionary)
        for held, key, value in ((self.docs, lang[row] * size + term, np.ones(len(each), np.int64)),
                                 (self.counts, (lang[row] * self.most + source[row]) * size + term, n)):
            key, at = np.unique(key, return_inverse=True)
            held.append((key // size, key % size + self.size, np.bincount(at, value).astype(np.int64)))
        self.size += size
        self.held += len(self.counts[-1][0])
        self.bytes += terms.dictionary.nbytes

    def full(self) -> bool:
        return self.held >= HELD or self.bytes >= HELD_BYTES

    def emptied(self):
        """All stripes in batches; the table is empty afterwards."""
        if self.terms:
            names = pa.concat_arrays(self.terms).dictionary_encode()
            known, size = names.indices.to_numpy().astype(np.int64), len(names.dictionary)
            lang, term, docs = (np.concatenate(x) for x in zip(*self.docs, strict=True))
            group, each, count = (np.concatenate(x) for x in zip(*self.counts, strict=True))
            self._clear()
            key, at = np.unique(lang * size + known[term], return_inverse=True)
            docs = np.bincount(at, docs).astype(np.int64)
            stripe = np.searchsorted(key, group // self.most * size + known[each])
            whole = _stripes(key // size, names.dictionary.take(pa.array(key % size)), docs, stripe, group % self.most, count, self.most)
            for i in range(0, len(whole), BATCH):
                yield whole.slice(i, BATCH)


def _merged(batch: pa.RecordBatch, most: int) -> pa.RecordBatch:
    """Stripes in order of (lang, term), those of one key added up."""
    lang, terms, docs, sources, counts = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in batch.columns)
    lang = lang.to_numpy()
    new = np.ones(len(lang), bool)
    new[1:] = (lang[1:] != lang[:-1]) | pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    stripe = np.repeat(np.cumsum(new) - 1, pc.list_value_length(sources).to_numpy())
    return _stripes(lang[first], terms.take(pa.array(first)), np.add.reduceat(docs.to_numpy(), first), stripe,
                    sources.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy(), most)


def stripes(docs: DataFrame, groups: Groups, min_docs: int = MIN_DOCS) -> DataFrame:
    """``STRIPES`` of ``docs`` (text, lang, source): each kept term of a language once."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(groups)
    most = groups.most

    def fold(batches):
        table = Table(most)
        for batch in batches:
            data, offsets = words.text_buffer(words.plain_column(batch, "text"))
            lang, source = shared.value.of(*(words.plain_column(batch, c) for c in ("lang", "source")))
            for a, b in words.row_cuts(offsets, SLICE_BYTES):
                table.fold(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], lang[a:b], source[a:b])
                if table.full():
                    yield from table.emptied()
        yield from table.emptied()

    def merge(batches):
        held = None  # the last stripe: its key may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            batch = batch if held is None else pa.Table.from_batches([held, batch.cast(held.schema)]).combine_chunks().to_batches()[0]
            whole = _merged(batch, most)
            held = whole.slice(len(whole) - 1)
            done = whole.slice(0, len(whole) - 1)
            yield done.filter(pc.greater_equal(done.column(2), min_docs))
        if held is not None:
            yield held.filter(pc.greater_equal(held.column(2), min_docs))

    folded = docs.select("text", *[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).mapInArrow(fold, STRIPES)
    return folded.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(merge, STRIPES)


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) for count < total, exactly."""
    count, total = np.broadcast_arrays(count, total)
    if total.max(initial=0) >= 1 << 53:
        return (1 + (count.astype(object) + 1) * SCALE // total.astype(object)).astype(np.int64)
    out, rest = np.divmod(count + 1, total)
    for _ in range(3):  # a thousand at a time, within 64 bits
        digit, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + digit
    return 1 + out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Language:
    """Number of the kept words of each source of a language, and of its kept terms."""

    def __init__(self, sizes: list[int], terms: int):
        self.totals = np.array(sizes, np.int64) + terms
        self.total = np.array(sum(sizes) + terms)
        self.absent = share(np.zeros(len(sizes), np.int64), self.totals)


def _pair_sums(lang: Language, stripe: np.ndarray, source: np.ndarray, p: np.ndarray, step: int):
    """(first of a block of sources, sums): what stripes add to the pairs (source, block) and (block, source)."""
    size = len(lang.totals)
    order = np.argsort(source, kind="stable")
    first = _first_of_runs(source[order])
    row = np.cumsum(np.diff(stripe, prepend=stripe[0]) > 0)
    for low in range(0, size, step):
        block = np.arange(low, min(low + step, size))
        shares = np.tile(lang.absent[block], (row[-1] + 1, 1))
        has = np.zeros(shares.shape, bool)
        inside = (source >= low) & (source < low + step)
        shares[row[inside], source[inside] - low] = p[inside]
        has[row[inside], source[inside] - low] = True
        mine, other = lang.absent[:, None], lang.absent[block]
        ahead = divergence(p[:, None], shares[row]) - divergence(mine, other)[source]
        back = np.where(has[row], 0, divergence(other, p[:, None]) - divergence(other, mine)[source])
        sums = np.zeros((2, size, len(block)), np.int64)
        for k, x in enumerate((ahead, back)):
            sums[k, source[order][first]] = np.add.reduceat(x[order], first)
        yield low, sums


class Best:
    """The best terms of each group so far."""

    def __init__(self, top: int):
        self.top, self.held, self.rows = top, [], 0
        self.floor: dict[tuple[int, int], int] = {}

    def add(self, lang: int, source: np.ndarray, value: np.ndarray, terms: pa.Array) -> None:
        least = np.array([self.floor.get((lang, s), -1) for s in range(source.max(initial=-1) + 1)], np.int64)
        good = np.flatnonzero(value >= least[source]) if len(source) else source
        if len(good):
            self.held.append(pa.table({"lang": pa.array(np.full(len(good), lang), pa.int32()), "source": pa.array(source[good], pa.int32()),
                                       "term": terms.take(pa.array(good)), "value": pa.array(value[good])}))
            self.rows += len(good)
        if self.rows > CANDIDATES:
            self.held = [self.trimmed()]
            self.rows = len(self.held[0])

    def trimmed(self) -> pa.Table:
        whole = pa.concat_tables(self.held).combine_chunks()
        whole = whole.take(pc.sort_indices(whole, [("lang", "ascending"), ("source", "ascending"), ("value", "descending"), ("term", "ascending")]))
        lang, source, value = (whole.column(c).to_numpy() for c in ("lang", "source", "value"))
        first = _first_of_runs(lang, source)
        rank = np.arange(len(lang)) - np.repeat(first, np.diff(np.append(first, len(lang))))
        for at in np.flatnonzero(rank == self.top - 1):
            self.floor[int(lang[at]), int(source[at])] = int(value[at])
        return whole.filter(pa.array(rank < self.top))


def emitted(kept: DataFrame, languages: list[Language | None], top: int = TOP) -> DataFrame:
    """``_EMITTED``: sums of pairs and best terms of each task; languages and sources by their places."""
    shared = kept.sparkSession.sparkContext.broadcast(languages)
    names = [f.split()[0] for f in _EMITTED.split(", ")]

    def run(batches):
        sums, best = {}, Best(top)

        def pairs():
            for (lang, low), (ahead, back) in sums.items():
                for x, turned in ((ahead, False), (back, True)):
                    source, column = np.nonzero(x)
                    sides = [pa.array(source, pa.int32()), pa.array(column + low, pa.int32())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(source), lang), pa.int32()), *(sides[::-1] if turned else sides),
                         pa.nulls(len(source), pa.string()), pa.array(x[source, column])], names)
            sums.clear()

        for batch in batches:
            langs = batch.column(batch.schema.get_field_index("lang")).to_numpy()
            for i in np.unique(langs).tolist():
                own = batch.filter(pa.array(langs == i))
                terms, sources, counts = (own.column(own.schema.get_field_index(c)) for c in ("term", "sources", "counts"))
                lang, size = shared.value[i], pc.list_value_length(sources).to_numpy()
                stripe = np.repeat(np.arange(len(size)), size)
                source, count = sources.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy()
                p = share(count, lang.totals[source])
                step = max(1, CELLS // len(lang.totals))
                ends = np.concatenate(([0], np.cumsum(size)))
                for a, b in words.row_cuts(ends, max(1, CELLS // min(step, len(lang.totals)))):
                    some = slice(ends[a], ends[b])
                    for low, added in _pair_sums(lang, stripe[some], source[some], p[some], step):
                        sums[i, low] = sums[i, low] + added if (i, low) in sums else added
                        if sum(x.size for x in sums.values()) > 8 * CELLS:
                            yield from pairs()
                whole = np.add.reduceat(count, ends[:-1])
                q = share(whole, lang.total)[stripe]
                apart = np.flatnonzero(p > q)
                best.add(i, source[apart], divergence(p, q)[apart], terms.take(pa.array(stripe[apart])))
        yield from pairs()
        if best.held:
            last = best.trimmed()
            none = pa.chunked_array([pa.nulls(len(last), pa.int32())])
            for out in pa.table([last["lang"], last["source"], none, last["term"], last["value"]], names).to_batches():
                yield out

    return kept.mapInArrow(run, _EMITTED)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of ``docs`` (text, lang, source)."""
    spark = docs.sparkSession
    pairs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct().collect()
    groups = Groups([(r["lang"], r["source"]) for r in pairs])
    kept = written(stripes(docs, groups, min_docs), "stripes")
    sizes = {(r["lang"], r["source"]): r["n"] for r in kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy(
        "lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("n")).collect()}
    terms = {r["lang"]: r["n"] for r in kept.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = [Language([sizes.get((i, k), 0) for k in range(len(own))], terms[i]) if i in terms else None
                 for i, own in enumerate(groups.sources)]
    table = [(i, groups.names[i], k, name, int(languages[i].absent[k]) if i in terms else 1, terms.get(i, 0))
             for i, own in enumerate(groups.sources) for k, name in enumerate(own)]
    named = spark.createDataFrame(table, "lang int, lang_name string, source int, name string, absent long, terms long")
    found = written(emitted(kept, languages, top), "divergences")

    left, right = named.alias("a"), named.alias("b")
    pairs = left.join(right, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source"))).select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("source"), F.col("b.source").alias("other"), F.lit(None).cast("string").alias("term"),
        F.expr("a.terms * ((a.absent - b.absent) * (a.absent - b.absent) div b.absent)").alias("value"))
    sums = found.filter("other is not null").unionByName(pairs).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    others = named.select("lang", F.col("source").alias("other"), F.col("name").alias("item"))
    pair = sums.join(others, ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    term = found.filter("other is null").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return (pair.unionByName(term).withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= top))
            .join(named, ["lang", "source"])
            .select(F.col("lang_name").alias("lang"), F.col("name").alias("source"), "part", "item", "value", "rank"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents),
w AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
p AS (SELECT k.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
  1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (gn.n + v.v) AS p
  FROM k JOIN gn USING (lang) JOIN v USING (lang)
  LEFT JOIN c ON c.lang = k.lang AND c.source = gn.source AND c.term = k.term),
whole AS (SELECT lang, sum(n) AS n FROM gn GROUP BY lang),
q AS (SELECT p.lang, p.term, 1 + 1000000000::HUGEINT * (sum(p.n) + 1) // (any_value(whole.n) + any_value(v.v)) AS q
  FROM p JOIN whole USING (lang) JOIN v USING (lang) GROUP BY p.lang, p.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""
