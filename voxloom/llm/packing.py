"""Cost-balanced packing of tokenised documents into training sequences.

A document's ids are those of a public tokenizer, then ``END``. Each task tokenises its rows and
packs them in windows of about ``WINDOW_TOKENS`` ids, so no text, id or length is shuffled and the
memory of a task is bounded by a window and its longest document. Within a window:

1. Full pieces of ``CAPACITY`` ids are cut off long documents; each is a sequence.
2. The rests are sorted by estimated cost, ``LINEAR * n + QUADRATIC * n^2`` (attention stays within
   a document), and each goes, most costly first, to the sequence of lowest cost so far with room
   for it. Where none has room it is cut: the lowest-cost sequence with any room takes what fits.
3. The rests of a window rarely fill whole sequences. What is over goes to sequences whose lengths
   are powers of two, which need no padding; so all sequences are full.

The longer the window, the more even the costs; the results of a task depend on its rows alone, so
a lost task is simply run again. Sequence ids are unique over all tasks.

Words, or their letters and marks, are tokenised once and kept in bounded tables per worker: the
tokenizer drops white space and never joins characters across it, so the ids of a text are those of
its words.

Null and empty texts are the end id alone. Repeated rows and null ids are documents like any other;
a very long text is tokenised whole and cut into full sequences; further columns of any name are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.session import ship_package

TOKENIZER = "word_bpe_49k.json"
END = 2
CAPACITY = 4096
WINDOW_TOKENS = 1 << 21
#: Cost of a token, and of a pair of tokens in one document, in units of the former.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Units of a table; a worker holds two of them.
KNOWN_WORDS = 400_000

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_tokens long")
_IDS = np.dtype("<u4")
#: Byte-level tokenizers write the bytes 0x80 to 0xA0 and 0xAD of a text as letters from U+0122 on, others as Latin-1.
_BYTE_LETTERS = {b: 0x122 + i for i, b in enumerate([*range(0x80, 0xA1), 0xAD])}
_PROBES = [w.encode() for w in ("a", "the", "zymurgy", "über", "àéîõüýþßæ", "façade", "incomprehensibilities", ".", "?!", ".,;:!?")]
#: Bytes of text tokenised at once: the more, the fewer look-ups of a frequent unit.
SLICE_BYTES = 4 << 20
_LETTER, _MARK, _LATIN = (np.zeros(256, bool) for _ in range(3))
_LETTER[ord("A"): ord("Z") + 1] = _LETTER[ord("a"): ord("z") + 1] = True
_MARK[list(b".,;:!?")] = True
_LATIN[0x80:0xC0] = True  # behind 0xC3: the Latin-1 letters, but for two signs
_LATIN[[0x97, 0xB7]] = False
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[ord("A"): ord("Z") + 1] += 32


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def units(texts: words.Texts, split: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where units start and end, which are simple): words, and their letters and marks apart.

    A word of ASCII and Latin-1 letters with marks behind is two simple units: the tokenizer ignores
    case and never joins the two, so words that differ in case or marks share their letters' ids.
    All other words are one unit as they stand.
    """
    data, starts, ends = texts.data, texts.starts, texts.ends
    if not split or not len(starts):
        return data, starts, ends, np.zeros(len(starts), bool)
    letter, mark = _LETTER[data], _MARK[data]
    pair = (data[:-1] == 0xC3) & _LATIN[data[1:]]
    letter[:-1] |= pair
    letter[1:] |= pair
    letters, marks = (np.concatenate(([0], np.cumsum(x, dtype=np.int32))) for x in (letter, mark))
    n = letters[ends] - letters[starts]
    cut = starts + n
    plain = (n > 0) & (n + marks[ends] - marks[starts] == ends - starts) & (letters[cut] - letters[starts] == n)
    data = np.where(np.repeat(plain, np.diff(np.append(starts, len(data)))), words.lower(data[starts[0]:], _SMALL), data[starts[0]:])
    data = np.concatenate((texts.data[: starts[0]], data))
    two = np.flatnonzero(plain & (cut < ends))
    return data, np.insert(starts, two + 1, cut[two]), np.insert(ends, two, cut[two]), np.insert(plain, two + 1, True)


class WordTokens:
    """Ids of units, as little-endian bytes, in two bounded tables: recent units, and those before."""

    def __init__(self, path: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool) if suffix else None
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # A byte-level tokenizer that takes small letters and marks as they are, each unit as one piece.
        self.direct = array("I").itemsize == 4 and sys.byteorder == "little"
        self.direct = self.direct and self._encode_simple(_PROBES) == self._encode(_PROBES)
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _encode(self, some: list[bytes]) -> list[bytes]:
        codes = self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
        return [np.array(code.ids, _IDS).tobytes() for code in codes]

    def _encode_simple(self, some: list[bytes]) -> list[bytes]:
        """Of simple units, straight from the tokenizer's model where that is the same."""
        if not self.direct:
            return self._encode_joined(some)
        own = self.tokenizer.model.tokenize
        return [array("I", [t.id for t in own(w.decode("latin-1").translate(_BYTE_LETTERS))]).tobytes() for w in some]

    def _encode_joined(self, some: list[bytes]) -> list[bytes]:
        """Of units that are one piece each, as one text: a piece ends with an id marked so."""
        [code] = self.tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)
        ids = np.array(code.ids, _IDS)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(some) or ends[-1] != len(ids):
            return self._encode(some)
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *(4 * ends[:-1]).tolist()], (4 * ends).tolist(), strict=True)]

    def learn(self, new: list[bytes], encode) -> None:
        for at in range(0, len(new), 512):
            some = new[at: at + 512]
            self.known.update(zip(some, encode(some), strict=True))

    def documents(self, texts: words.Texts) -> list[bytes]:
        """The ids of each row. Each different unit of the slice is looked up once."""
        data, starts, ends, simple = units(texts, self.last is not None)
        raw, h = data.tobytes(), words.word_hashes(data, starts, ends)
        _, first, at = np.unique(h, return_index=True, return_inverse=True)
        parts = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        if len(self.known) > KNOWN_WORDS:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new = [(w, s) for w, s in zip(parts, simple[first].tolist(), strict=True) if w not in known]
        known.update((w, before[w]) for w, _ in new if w in before)
        self.learn([w for w, s in new if s and w not in known], self._encode_simple)
        self.learn([w for w, s in new if not s and w not in known], self._encode)
        codes = [known[w] for w in parts]
        flat = np.frombuffer(b"".join(codes), _IDS)
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        begin = np.cumsum(sizes) - sizes
        size = sizes[at]  # of each word in turn
        rows = len(texts.offsets) - 1
        row = np.repeat(np.repeat(np.arange(rows), np.diff(np.searchsorted(starts, texts.offsets))), size)
        place = np.arange(len(row))
        out = np.full(len(row) + rows, END, dtype=_IDS)
        out[place + row] = flat[np.repeat(begin[at] - (np.cumsum(size) - size), size) + place]
        ends = np.cumsum(np.bincount(row, minlength=rows) + 1)
        return [out[a:b].tobytes() for a, b in zip(np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True)]


@cache
def word_tokens(path: str | None) -> WordTokens:
    return WordTokens(path)


def assign(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """([(document, start, length, sequence, offset)], sizes of the sequences), all full."""
    pieces, sizes, rests = [], [], []
    for doc, n in enumerate(lengths):
        full = n // capacity
        for k in range(full):
            pieces.append((doc, k * capacity, capacity, len(sizes), 0))
            sizes.append(capacity)
        if n % capacity:
            rests.append((n % capacity, doc, full * capacity))
    total = sum(r[0] for r in rests)
    own = [capacity] * (total // capacity)
    own += [1 << b for b in range(total.bit_length() - 1, -1, -1) if (total % capacity) >> b & 1]
    room = np.array(own, dtype=np.int64)
    spent = np.zeros(len(own))
    base = len(sizes)
    sizes += own
    rests.sort(key=lambda r: -cost(r[0]))  # stable: ties in the order of the rows
    for n, doc, start in rests:
        while n:
            fits = np.where(room >= n, spent, np.inf)
            at = int(fits.argmin())
            if fits[at] == np.inf:
                at = int(np.where(room > 0, spent, np.inf).argmin())
            take = min(n, int(room[at]))
            pieces.append((doc, start, take, base + at, own[at] - int(room[at])))
            room[at] -= take
            spent[at] += cost(take)
            n, start = n - take, start + take
    return pieces, sizes


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """One row per piece of every row of ``docs`` (doc_id, text), see ``SCHEMA``."""
    ship_package(docs.sparkSession)

    def emit(held: list, first_sequence: int) -> tuple[pa.RecordBatch, int]:
        pieces, sizes = assign([len(ids) // 4 for _, ids in held], capacity)
        columns = [[], [], [], [], [], [], [], []]
        for doc, start, length, sequence, offset in pieces:
            doc_id, ids = held[doc]
            row = (doc_id, start, length, zlib.crc32(ids[4 * start: 4 * (start + length)]), len(ids) // 4,
                   first_sequence + sequence, offset, sizes[sequence])
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names), first_sequence + len(sizes)

    def run(batches):
        tokens = word_tokens(path)
        sequence = TaskContext.get().partitionId() << 40
        held, size = [], 0
        for batch in batches:
            ids = words.plain_column(batch, "doc_id").to_pylist()
            for texts in words.slices(words.plain_column(batch, "text"), SLICE_BYTES):
                for doc_id, code in zip(ids[texts.rows], tokens.documents(texts), strict=True):
                    held.append((doc_id, code))
                    size += len(code) // 4
                    if size >= window_tokens:
                        out, sequence = emit(held, sequence)
                        yield out
                        held, size = [], 0
        if held:
            yield emit(held, sequence)[0]

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
