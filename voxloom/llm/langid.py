"""Language identification by unigrams over a public vocabulary, all segmentations summed.

A word (a run of letters and marks, lower-cased, with a mark for its beginning) can be cut into
pieces of a fixed public vocabulary in many ways. A language is a probability for each piece; the
probability of a word in it is the sum, over all its segmentations, of the products of their pieces,
found by the forward algorithm. Pieces do not cross words, so a text's sum over its segmentations is
the product of its words'. A character that is no piece is a piece of its own kind.

Learning: the words of all texts with a language that are not held out are counted per language (no
sample), and ``ROUNDS`` rounds of expectation-maximisation distribute each word over its pieces by
the forward-backward algorithm. A round is one pass over the table of counted words, which is
written once; the driver sees sums per piece and language only, that is the size of the model.
Pieces rare in a language fall back on their share in all languages.

Scoring: a task finds each different word's sum once (it remembers a bounded number of words) and
adds up logarithms. The
score is the posterior of the best language, with the shares of documents as prior; ties go to the
smaller name. The model (pieces x languages) is all that is broadcast.

Null and empty texts and texts without a letter are ``und`` with score 0; so is every text where no
language was learnt. A null ``doc_id`` counts as held out; repeated rows are rows like any other;
further columns are not read; an empty table gives no rows. Texts and words of any length are read
whole: time is linear in them, and a batch works on a text of more than ``SLICE_BYTES`` alone.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.llm.components import written
from voxloom.llm.training import held_out
from voxloom.session import ship_package

VOCABULARY = "piece_bpe_32k.model"
ROUNDS = 2
#: Weight, in pieces, of the shares of all languages in those of one.
BACKOFF = 200.0
FLOOR = 0.1
UNKNOWN = "und"
SLICE_BYTES = 2 << 20
#: Characters of different words (times languages) that the forward algorithm takes at once.
CHUNK = 1 << 20
LONG = 32
#: Products below this are left to logarithms.
SMALL = 1e-250
#: Words (times languages) whose scores a task remembers.
KNOWN = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_LAST_LETTER = 0x33480  # beyond all assigned letters
_MARK = 0x2581  # begins a word in the vocabulary's pieces


@cache
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower case, is a letter, is a letter or mark) of each code point; one further entry stands for the rest."""
    low = np.arange(_LAST_LETTER + 1, dtype=np.uint32)
    letter, inside = np.zeros(_LAST_LETTER + 1, bool), np.zeros(_LAST_LETTER + 1, bool)
    for i in range(_LAST_LETTER):
        c = chr(i)
        kind = unicodedata.category(c)[0]
        letter[i], inside[i] = kind == "L", kind in "LM"
        small = c.lower()
        if len(small) == 1:
            low[i] = ord(small)
    return low, letter, inside


class Spans:
    """64-bit hashes of any spans of an array of code points."""

    def __init__(self, codes: np.ndarray):
        weights = words.powers(_U(_BASE), len(codes))
        sums = words.mix((codes.astype(_U) + _U(1)) * _U(_BASE)) * weights
        self.sums = np.concatenate((np.zeros(1, _U), np.cumsum(sums, dtype=_U)))
        self.back = words.powers(_U(_BACK), len(codes) + 1)

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return words.mix((self.sums[stop] - self.sums[start]) * self.back[start] + (stop - start).astype(_U) * _U(_BASE))


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of UTF-8 texts: (lower-cased code points, start, stop and row of each word, whether a row has a letter)."""
    low, letter, inside = _characters()
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kept = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    at = np.minimum(codes, _LAST_LETTER)
    codes = np.where(codes < _LAST_LETTER, low[at], codes)
    solid = inside[at]
    before, after, cut = (np.zeros(len(codes) + 1, bool) for _ in range(3))
    before[1:], after[:-1], cut[kept] = solid, solid, True
    start, stop = np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))
    row = np.searchsorted(kept, start, side="right") - 1
    letters = np.concatenate(([0], np.cumsum(letter[at])))
    return codes, start, stop, row, letters[kept[1:]] > letters[kept[:-1]]


class Vocabulary:
    """The pieces of a public vocabulary, found in words by their hashes. Piece 0 is any other character."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [None] + [model.id_to_piece(i) for i in range(model.vocab_size())
                               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        ends = np.cumsum([len(p) for p in self.names[1:]])
        starts = np.concatenate(([0], ends[:-1]))
        codes = np.frombuffer("".join(self.names[1:]).encode("utf-32-le"), np.uint32)
        keys = Spans(codes).hashes(starts, ends)
        self.longest = int((ends - starts).max())
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys >> _U(44)).astype(np.int64)] = True

    def pieces(self, codes: np.ndarray, word_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, stop, piece) of every piece in the words that stand one after another in ``codes``."""
        spans, place = Spans(codes), np.arange(len(codes))
        bounds = np.append(word_start, len(codes))
        left = np.repeat(bounds[1:], np.diff(bounds)) - place
        found = []
        for n in range(1, self.longest + 1):
            start = place[left >= n]
            keys = spans.hashes(start, start + n)
            likely = self.maybe[(keys >> _U(44)).astype(np.int64)]
            start, keys = start[likely], keys[likely]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            true = self.keys[at] == keys
            start = start[true]
            found.append((start, start + n, self.order[at[true]] + 1))
            if n == 1:
                other = np.setdiff1d(place, start)
                found.append((other, other + 1, np.zeros(len(other), np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


@cache
def vocabulary(path: str | None) -> Vocabulary:
    return Vocabulary(path)


def _sweep(values: np.ndarray, source: np.ndarray, target: np.ndarray, weight: np.ndarray, level: np.ndarray, length: np.ndarray,
           logs: bool) -> None:
    """Add up values[source] * weight in values[target], level by level; or the same in logarithms."""
    key = level * (int(length.max()) + 1) + length  # within a key no target stands twice
    order = np.argsort(key.astype(np.uint16) if key.max() < 1 << 16 else key, kind="stable")
    source, target, weight = source[order], target[order], weight[order]
    cuts = np.flatnonzero(np.diff(key[order])) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(key)), strict=True):
        to = target[a:b]
        if logs:
            values[to] = np.logaddexp(values[to], values[source[a:b]] + weight[a:b])
        else:
            values[to] += values[source[a:b]] * weight[a:b]


class Lattice:
    """All segmentations of different words; nodes are the places between their characters."""

    def __init__(self, vocab: Vocabulary, codes: np.ndarray, start: np.ndarray, stop: np.ndarray):
        size = stop - start + 1
        self.first = np.cumsum(size) - size
        flat = np.full(int(size.sum()), _MARK, np.uint32)
        place = np.arange(len(flat)) - np.repeat(self.first, size)
        flat[place > 0] = codes[(np.repeat(start, size) + place - 1)[place > 0]]
        begin, end, self.piece = vocab.pieces(flat, self.first)
        self.word = np.repeat(np.arange(len(size)), size)[begin]
        self.source, self.target = begin + self.word, end + self.word
        self.nodes = len(flat) + len(start)
        self.heads = self.first + np.arange(len(start))
        self.tails = self.heads + size
        self.far, self.near = end - self.first[self.word], size[self.word] - (begin - self.first[self.word])

    def _run(self, weight: np.ndarray, ends: np.ndarray, logs: bool, back: bool = False) -> np.ndarray:
        values = np.full((self.nodes, *weight.shape[1:]), -np.inf if logs else 0.0)
        values[ends] = 0 if logs else 1
        if len(self.piece):
            way = (self.target, self.source) if back else (self.source, self.target)
            _sweep(values, *way, weight, self.near if back else self.far, self.target - self.source, logs)
        return values

    def scores(self, model: np.ndarray) -> np.ndarray:
        """Log of the sum over all segmentations of each word; ``model`` has logarithms, pieces x languages.

        Sums are of plain products; words whose products come near the smallest numbers are done by logarithms.
        """
        sums = self._run(np.exp(model)[self.piece], self.heads, False)[self.tails]
        with np.errstate(divide="ignore"):
            out = np.log(sums)
        small = sums.min(axis=1) < SMALL
        if small.any():
            out[small] = self._run(model[self.piece], self.heads, True)[self.tails][small]
        return out

    def shares(self, weight: np.ndarray) -> np.ndarray:
        """Expected number of times that each piece of the lattice is used; ``weight`` in logarithms."""
        plain = np.exp(weight)
        ahead, back = self._run(plain, self.heads, False), self._run(plain, self.tails, False, True)
        whole = ahead[self.tails]
        small = (whole < SMALL)[self.word]
        with np.errstate(divide="ignore", invalid="ignore"):
            out = ahead[self.source] * plain * back[self.target] / whole[self.word]
        if small.any():
            ahead, back = self._run(weight, self.heads, True), self._run(weight, self.tails, True, True)
            out[small] = np.exp(ahead[self.source] + weight + back[self.target] - ahead[self.tails[self.word]])[small]
        return out


def lattices(vocab: Vocabulary, codes: np.ndarray, start: np.ndarray, stop: np.ndarray, wide: int = 1):
    """(which words, lattice), so many words at once that memory stays bounded; long words by themselves."""
    size = stop - start + 1
    for some in (np.flatnonzero(size <= LONG), np.flatnonzero(size > LONG)):
        for a, b in words.row_cuts(np.concatenate(([0], np.cumsum(size[some]))), max(CHUNK // wide, 1)):
            own = some[a:b]
            yield own, Lattice(vocab, codes, start[own], stop[own])


def different(codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the different words in order, one word of each, which of them each word is)."""
    return np.unique(Spans(codes).hashes(start, stop), return_index=True, return_inverse=True)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n of all words of ``docs`` (text, lang); counted per slice before the shuffle."""
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            data, offsets = words.text_buffer(words.plain_column(batch, "text"))
            langs = words.plain_column(batch, "lang").dictionary_encode()
            lang = langs.indices.to_numpy()
            for a, b in words.row_cuts(offsets, SLICE_BYTES):
                codes, start, stop, row, _ = letter_words(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                if not len(start):
                    continue
                _, first, at = different(codes, start, stop)
                key, n = np.unique(at * len(langs.dictionary) + lang[a:b][row], return_counts=True)
                text = codes.tobytes().decode("utf-32-le")
                names = [text[i:j] for i, j in zip(start[first].tolist(), stop[first].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(key % len(langs.dictionary))),
                     pa.array(names, pa.string()).take(pa.array(key // len(langs.dictionary))), pa.array(n, pa.int64())],
                    ["lang", "word", "n"])

    return (docs.select("text", "lang").mapInArrow(run, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _expected(counts: DataFrame, langs: list[str], model: np.ndarray | None, path: str | None) -> np.ndarray:
    """Expected uses of each piece in each language; without a model all pieces are alike."""
    size = len(vocabulary(path).names)
    shared = counts.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        vocab, total = vocabulary(path), np.zeros((size, len(langs)))
        for batch in batches:
            data, offsets = words.text_buffer(words.plain_column(batch, "word"))
            codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            kept = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
            lang = batch.column(batch.schema.get_field_index("lang")).to_numpy()
            n = batch.column(batch.schema.get_field_index("n")).to_numpy()
            for some, lattice in lattices(vocab, codes, kept[:-1], kept[1:]):
                own = lang[some][lattice.word]
                weight = np.full(len(own), -np.log(size)) if shared.value is None else shared.value[lattice.piece, own]
                np.add.at(total, (lattice.piece, own), lattice.shares(weight) * n[some][lattice.word])
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], ["piece", "lang", "uses"])

    number = F.create_map(*[F.lit(x) for i, name in enumerate(langs) for x in (name, i)])
    rows = (counts.select(number[F.col("lang")].cast("long").alias("lang"), "word", "n")
            .mapInArrow(run, "piece long, lang long, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))
            .toArrow())
    out = np.zeros((size, len(langs)))
    out[rows.column("piece").to_numpy(), rows.column("lang").to_numpy()] = rows.column("uses").to_numpy()
    shared.destroy()
    return out


def learn(docs: DataFrame, rounds: int = ROUNDS, path: str | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log shares of documents, log probabilities of pieces x languages).

    Learns from the rows of ``docs`` (doc_id, text, lang) that have a language and are not held out.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out())
    sizes = sorted((r["lang"], r["n"]) for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect())
    langs = [name for name, _ in sizes]
    if not langs:
        return [], np.zeros(0), np.zeros((0, 0))
    counts, model = written(word_counts(known), "words"), None
    for _ in range(rounds):
        uses = _expected(counts, langs, model, path)
        share = uses.sum(1) + FLOOR
        share /= share.sum()
        model = np.log((uses + BACKOFF * share[:, None]) / (uses.sum(0) + BACKOFF))
    prior = np.array([n for _, n in sizes], float)
    return langs, np.log(prior / prior.sum()), model


def log_likelihoods(vocab: Vocabulary, codes: np.ndarray, start: np.ndarray, stop: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Words x languages."""
    out = np.zeros((len(start), model.shape[1]))
    for some, lattice in lattices(vocab, codes, start, stop, model.shape[1]):
        out[some] = lattice.scores(model)
    return out


class Known:
    """Scores of words seen before, by hash; it starts anew when it holds ``KNOWN`` numbers."""

    def __init__(self, vocab: Vocabulary, model: np.ndarray):
        self.vocab, self.model = vocab, model
        self._clear()

    def _clear(self) -> None:
        self.keys, self.scores = np.zeros(0, _U), np.zeros((0, self.model.shape[1]))

    def of(self, keys: np.ndarray, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Words x languages of different words; ``keys`` are their hashes in order."""
        if len(self.scores) * self.model.shape[1] > KNOWN:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        seen = np.append(self.keys, _U(0))[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.zeros((len(keys), self.model.shape[1]))
        out[seen] = self.scores[at[seen]]
        new = ~seen
        out[new] = log_likelihoods(self.vocab, codes, start[new], stop[new], self.model)
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.scores = np.insert(self.scores, at[new], out[new], axis=0)
        return out


def predict(docs: DataFrame, learnt: tuple[list[str], np.ndarray, np.ndarray], path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text)."""
    ship_package(docs.sparkSession)
    langs, prior, model = learnt
    shared = docs.sparkSession.sparkContext.broadcast((prior, model))

    def run(batches):
        prior, model = shared.value
        known = Known(vocabulary(path), model) if langs else None
        for batch in batches:
            data, offsets = words.text_buffer(words.plain_column(batch, "text"))
            best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
            for a, b in words.row_cuts(offsets, SLICE_BYTES):
                codes, start, stop, row, letters = letter_words(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
                if not langs:
                    letters[:] = False
                if not letters.any():
                    best.append(np.full(b - a, -1))
                    score.append(np.zeros(b - a))
                    continue
                keys, first, at = different(codes, start, stop)
                each = known.of(keys, codes, start[first], stop[first])
                total = np.stack([np.bincount(row, each[at, k], b - a) for k in range(len(langs))], axis=1) + prior
                top = total.argmax(1)
                best.append(np.where(letters, top, -1))
                score.append(np.where(letters, 1 / np.exp(total - total.max(1, keepdims=True)).sum(1), 0.0))
            names = pa.array([*langs, UNKNOWN]).take(pa.array(np.concatenate(best) % (len(langs) + 1)))
            yield pa.RecordBatch.from_arrays(
                [words.plain_column(batch, "doc_id"), names, pa.array(np.concatenate(score))], ["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
