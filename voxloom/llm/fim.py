"""Fill-in-middle transformation by secondary sort: pieces keyed by document and output position.

A text is a row of units (lines with their ends). Two of its unit bounds, picked by a hash of
``doc_id``, part it into prefix, middle and suffix, which are put out in another order behind
sentinels (see ``FORMS``). A text that is empty, holds a sentinel or is left out by ``rate`` stays
plain.

Plan, in the manner of repartitionAndSortWithinPartitions:

1. Each task walks its texts in their own order and emits pieces of whole units, at most
   ``PIECE_CHARS`` code points long (a longer unit is cut), keyed by document and output position.
2. One shuffle by document, sorted by document and position, puts the output together. It is
   streamed: digests are fed piece by piece, so no text is whole in the memory of this step.
3. Restoration reads that stream and the form alone: sentinels in it tell which part follows, each
   piece gets its place in the original, and the same partitions are sorted again by that place; no
   second shuffle.

Documents are told apart by a digest of id and text and by the map partition's number modulo
``SALTS``, so copies of one row (also a third of all rows) spread over tasks; copies that meet are
streamed once and counted. A lost task emits the same pieces again.

Null texts are empty; a null ``doc_id`` hashes as the empty text; repeated rows have a row each;
further columns are not read; an empty table gives no rows; texts are read whole at any length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.session import ship_package

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Parts in order of output; each stands behind its sentinel.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
#: Parts in order of the original.
ORIGINAL = (PREFIX, MIDDLE, SUFFIX)
PLAIN = "plain"
SEED, RATE, SPM_RATE = 7, 100, 50
PIECE_CHARS = 4096
SALTS = 64
#: Code points held back before a batch of pieces is handed on.
BATCH_CHARS = 1 << 20

_SENTINEL = re.compile(f"({PREFIX}|{SUFFIX}|{MIDDLE})")
_FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = f"key binary, salt int, at long, text string, {_FACTS}"
_RETURNED = f"key binary, salt int, at long, text string, {_FACTS}, output_sha256 string, copies long"


def unit_count(text: str) -> int:
    return text.count("\n") + (not text.endswith("\n") and text != "")


def unit_end(text: str, k: int, n: int) -> int:
    """Code points in the first k of n units."""
    return 0 if k == 0 else len(text) if k == n else len(text) - len(text.split("\n", k)[-1])


def division(doc_id: int | None, text: str, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, int, int]:
    """(units, form, end of the prefix, end of the middle)."""
    n = unit_count(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i: i + 8], 16) for i in range(0, 32, 8)]
    if not text or _SENTINEL.search(text) or h[2] % 100 >= rate:
        return n, PLAIN, 0, 0
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return n, "spm" if h[3] % 100 < spm_rate else "psm", unit_end(text, low, n), unit_end(text, high, n)


def chunks(text: str, start: int, stop: int) -> Iterator[str]:
    """``text[start:stop]`` in pieces that end with a unit where one ends within ``PIECE_CHARS``."""
    while stop - start > PIECE_CHARS:
        cut = text.rfind("\n", start, start + PIECE_CHARS) + 1
        cut = cut if cut > start else start + PIECE_CHARS
        yield text[start:cut]
        start = cut
    yield text[start:stop]


class _Rows:
    """Rows collected into batches of bounded size."""

    def __init__(self, schema: str):
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        self.fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]
        self.rows, self.held = [], 0

    def add(self, *row, size: int = 0) -> bool:
        """Whether a batch is due."""
        self.rows.append(row)
        self.held += size + 16
        return self.held >= BATCH_CHARS

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in self.fields]
        out = pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, self.fields, strict=True)],
                                         [name for name, _ in self.fields])
        self.rows, self.held = [], 0
        return out


def pieces(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``PIECES`` of the outputs of ``docs`` (doc_id, text); the facts of a document are on its first piece."""
    ship_package(docs.sparkSession)

    def run(batches):
        salt, out = TaskContext.get().partitionId() % SALTS, _Rows(PIECES)
        for batch in batches:
            columns = (words.plain_column(batch, name).to_pylist() for name in ("doc_id", "text"))
            for doc_id, text in zip(*columns, strict=True):
                text = text or ""
                n, form, a, b = division(doc_id, text, seed, rate, spm_rate)
                key = hashlib.blake2b(f"{doc_id}\n{text}".encode(), digest_size=16).digest()
                if form == PLAIN:
                    parts, facts = [(0, "", 0, len(text))], (doc_id, n, form, None, None)
                else:
                    place, facts = FORMS[form].index, (doc_id, n, form, a, b - a)
                    bounds = zip(ORIGINAL, (0, a, b), (a, b, len(text)), strict=True)
                    parts = [(place(mark), mark, start, stop) for mark, start, stop in bounds]
                for rank, mark, start, stop in parts:
                    for k, piece in enumerate(chunks(text, start, stop)):
                        first = rank == 0 and k == 0
                        if out.add(key, salt, rank << 40 | k, piece if k else mark + piece,
                                   *(facts if first else (None,) * 5), size=len(piece)):
                            yield out.batch()
        yield out.batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def _streams(batches, fields: list[str]):
    """(key, rows in order of their place, equal places once, number of copies) of each document in turn."""
    rows = (row for batch in batches for row in zip(*(batch.column(batch.schema.get_field_index(f)).to_pylist()
                                                      for f in ("key", "salt", "at", *fields)), strict=True))
    for key, own in groupby(rows, key=lambda r: r[:2]):
        yield key, groupby(own, key=lambda r: r[2])


def sorted_by_document(pieces: DataFrame) -> DataFrame:
    """The pieces of a document together, in order of output: one shuffle."""
    return pieces.repartition("key", "salt").sortWithinPartitions("key", "salt", "at")


def texts(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row of ``docs``: the outputs as whole texts."""
    schema = f"{_FACTS}, output string, copies long"

    def run(batches):
        out = _Rows(schema)
        for _, places in _streams(batches, ["text", *(f.split()[0] for f in _FACTS.split(", "))]):
            whole, facts, copies = [], None, 0
            for _, same in places:
                row = next(same)
                if facts is None:
                    facts, copies = row[4:], 1 + sum(1 for _ in same)
                whole.append(row[3])
            if out.add(*facts, "".join(whole), copies, size=sum(map(len, whole))):
                yield out.batch()
        yield out.batch()

    ordered = sorted_by_document(pieces(docs, **parameters))
    return ordered.mapInArrow(run, schema).withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


def digests(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every row of ``docs``."""
    facts = [f.split()[0] for f in _FACTS.split(", ")]
    none = (None,) * len(facts)

    def put_out(batches):
        """Digest of each output, and its pieces with their place in the original, told by sentinels."""
        out = _Rows(_RETURNED)
        for (key, salt), places in _streams(batches, ["text", *facts]):
            digest, known, copies, part, k = hashlib.sha256(), None, 0, 0, 0
            for _, same in places:
                row = next(same)
                if known is None:
                    known, copies = row[4:], 1 + sum(1 for _ in same)
                digest.update(row[3].encode())
                for text in [row[3]] if known[2] == PLAIN else _SENTINEL.split(row[3]):
                    if text in ORIGINAL and known[2] != PLAIN:
                        part, k = ORIGINAL.index(text), 0
                    elif text:
                        k += 1
                        if out.add(key, salt, part << 40 | k, text, *none, None, None, size=len(text)):
                            yield out.batch()
            if out.add(key, salt, -1, "", *known, digest.hexdigest(), copies):
                yield out.batch()
        yield out.batch()

    result = f"{_FACTS}, output_sha256 string, restored_sha256 string, copies long"

    def restore(batches):
        out = _Rows(result)
        for _, places in _streams(batches, ["text", *facts, "output_sha256", "copies"]):
            digest, known = hashlib.sha256(), None
            for at, same in places:
                row = next(same)
                known = row[4:] if at == -1 else known
                digest.update(row[3].encode())
            if out.add(*known[:-1], digest.hexdigest(), known[-1], size=256):
                yield out.batch()
        yield out.batch()

    returned = sorted_by_document(pieces(docs, **parameters)).mapInArrow(put_out, _RETURNED)
    found = returned.sortWithinPartitions("key", "salt", "at").mapInArrow(restore, result)
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
  CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
  CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(l) AS BIGINT) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a,
  greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b FROM u),
p AS (SELECT doc_id, n, t, array_to_string(l[1:a], '') AS prefix, array_to_string(l[a + 1:b], '') AS middle,
  array_to_string(l[b + 1:], '') AS suffix,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
       WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
