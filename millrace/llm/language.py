"""Language identification by unigrams over a fixed public vocabulary, summed over all
segmentations.

Each language has a probability for every piece of the vocabulary. A word's probability
in a language is the sum, over all ways to cut it into pieces, of the product of their
probabilities, by the forward algorithm; a text's is the product over its words. Pieces
never reach over white space, so that is exact, and a word met again is not computed
again. Characters that are no piece have a small probability of their own.

Probabilities are fitted by expectation maximisation over the same segmentations
(forward-backward), on the words of at most about ``SAMPLE`` texts per language, chosen
by a hash of their id: the fit's size does not grow with the corpus. Every text is
scored as a whole, where it is, by words in lower case cut to ``WORD`` characters at a
time.

Defined results: a null text, or one without a letter, is ``und`` with score 0; texts
without a language teach nothing; without any language everything is ``und``. The score
is the probability of the predicted language given the text, all languages being
equally likely beforehand; of equal ones the first in the alphabet is taken. Columns of
the texts are kept, save ``lang_pred`` and ``score``. Bytes that are no UTF-8 are read as
U+FFFD.
"""

from __future__ import annotations

import pickle
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import add_columns, place_of, share_of, small_batches, texts_of

VOCABULARY = "piece_bpe_32k.model"
SAMPLE = 400
WORD = 40
ROUNDS = 3
CACHE_BYTES = 60_000_000  # about, for the words whose probabilities a worker remembers
UNKNOWN = "und"
_START = "▁"  # how the vocabulary marks a word's first piece


def pieces(path: str) -> list[str]:
    """The vocabulary's pieces, without control and byte symbols, each once in lower
    case, since words are."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    all_ids = range(model.get_piece_size())
    known = {
        model.id_to_piece(i).lower()
        for i in all_ids
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    return sorted(piece for piece in known if _START not in piece[1:])


def _tails(vocabulary: list[str]) -> dict[str, int]:
    """The number of each piece, and -1 for what is only the end of one."""
    tails = {piece[i:]: -1 for piece in vocabulary for i in range(len(piece))}
    tails.update((piece, i) for i, piece in enumerate(vocabulary))
    return tails


class Lattice:
    """All segmentations of some words: for each length of piece, the piece that ends
    at each place (-1: none).

    ``tails`` has the ends of all pieces (``_tails``), so that no longer pieces are looked
    for where none ends any more.
    """

    def __init__(self, words: list[str], tails: dict[str, int], n_pieces: int, longest: int):
        texts = [_START + word for word in words]
        self.size = np.array([len(text) for text in texts])
        width = int(self.size.max())
        self.longest = min(longest, width)
        self.piece = np.full((self.longest + 1, width + 1, len(texts)), -1, dtype=np.int32)
        inside = np.arange(1, width + 1)[:, None] <= self.size
        self.piece[1, 1:][inside] = n_pieces
        find = tails.get
        lengths, ends, places, found = [], [], [], []
        for i, text in enumerate(texts):
            for end in range(1, len(text) + 1):
                for start in range(end - 1, max(end - self.longest, 0) - 1, -1):
                    piece = find(text[start:end])
                    if piece is None:
                        break
                    if piece >= 0:
                        lengths.append(end - start)
                        ends.append(end)
                        places.append(i)
                        found.append(piece)
        self.piece[lengths, ends, places] = found

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """``forward[end, word, ...]``: the sum over the segmentations of a prefix."""
        width = self.piece.shape[1]
        sums = np.zeros((width, self.piece.shape[2], *probability.shape[1:]))
        sums[0] = 1
        for end in range(1, width):
            for length in range(1, min(end, self.longest) + 1):
                here = self.piece[length, end]
                hit = np.flatnonzero(here >= 0)
                sums[end, hit] += sums[end - length, hit] * probability[here[hit]]
        return sums

    def total(self, forward: np.ndarray) -> np.ndarray:
        return forward[self.size, np.arange(len(self.size))]

    def expected(self, probability: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all segmentations by their probability."""
        forward = self.forward(probability)
        backward = np.zeros_like(forward)
        backward[self.size, np.arange(len(self.size))] = 1
        width = self.piece.shape[1]
        counts = np.zeros(len(probability))
        scale = weight / np.maximum(self.total(forward), 1e-300)
        for end in range(width - 1, 0, -1):
            for length in range(1, min(end, self.longest) + 1):
                here = self.piece[length, end]
                hit = np.flatnonzero((here >= 0) & (end <= self.size))
                step = probability[here[hit]] * backward[end, hit]
                backward[end - length, hit] += step
                used = forward[end - length, hit] * step * scale[hit]
                counts += np.bincount(here[hit], used, minlength=len(probability))
        return counts


class Model:
    """Piece probabilities by language."""

    def __init__(self, languages: list[str], vocabulary: list[str], table: np.ndarray):
        self.languages, self.vocabulary, self.table = languages, vocabulary, table
        self.tails = _tails(vocabulary)
        self.longest = max(map(len, vocabulary))
        self.most = CACHE_BYTES // (150 + 8 * len(languages))
        self.cached: dict[str, int] = {}
        self.logs = np.zeros((0, len(languages)))

    def __getstate__(self):
        return self.languages, self.vocabulary, self.table

    def __setstate__(self, state):
        self.__init__(*state)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log probabilities, one row per text and one column per language."""
        if len(self.cached) > self.most:
            self.cached, self.logs = {}, np.zeros((0, len(self.languages)))
        split = [_words(text) for text in texts]
        fresh = list(dict.fromkeys(w for ws in split for w in ws if w not in self.cached))
        fresh.sort(key=len)
        new = [self.logs]
        for start in range(0, len(fresh), 2000):
            part = fresh[start : start + 2000]
            lattice = Lattice(part, self.tails, len(self.vocabulary), self.longest)
            total = lattice.total(lattice.forward(self.table))
            new.append(np.log(np.maximum(total, 1e-300)))
        for word in fresh:
            self.cached[word] = len(self.cached)
        self.logs = np.concatenate(new)
        return np.stack(
            [self.logs[[self.cached[w] for w in ws]].sum(axis=0) for ws in split]
        )


def _words(text: str) -> list[str]:
    found = text.lower().split()
    if max(map(len, found), default=0) <= WORD:
        return found
    return [word[i : i + WORD] for word in found for i in range(0, len(word), WORD)]


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    lang_column: str,
    use: Column | None = None,
    sample: int = SAMPLE,
) -> Model | None:
    """A model of the languages of ``docs``; None if there is none. ``use``, a condition
    on ``id``, says which texts may be learnt from."""
    rows = small_batches(docs).select(
        F.col(id_column).alias("id"),
        F.col(lang_column).cast("string").alias("lang"),
        F.col(text_column).alias("text"),
    ).filter("lang is not null and text is not null")
    if use is not None:
        rows = rows.filter(use)
    sizes = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.lit(0).cast("bigint")
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(share_of(sample, n))).otherwise(share)
    chosen = rows.filter(place_of(F.col("id"), 23) < share)
    path = public_tokenizers.path(VOCABULARY)
    fitted = (
        chosen.select("lang", "text")
        .mapInArrow(_count_words, "lang string, word string, n bigint")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .repartition(len(sizes), "lang")
        .mapInArrow(lambda batches: _fit_rows(batches, path), "lang string, table binary")
        .collect()
    )
    tables = {row["lang"]: np.frombuffer(row["table"], dtype=np.float64) for row in fitted}
    languages = sorted(tables)
    if not languages:
        return None
    return Model(languages, pieces(path), np.stack([tables[x] for x in languages], axis=1))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text"))):
            counts.update((lang, word) for word in _words(text))
        yield pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([lang for lang, _ in counts], pa.string()),
                "word": pa.array([word for _, word in counts], pa.string()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )


def _fit_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    by_lang: dict[str, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            by_lang.setdefault(row["lang"], []).append((row["word"], row["n"]))
    vocabulary = pieces(path)
    tails = _tails(vocabulary)
    longest = max(map(len, vocabulary))
    for lang, counted in sorted(by_lang.items()):
        counted.sort(key=lambda x: (len(x[0]), x[0]))
        lattices = [
            (
                Lattice([w for w, _ in part], tails, len(vocabulary), longest),
                np.array([n for _, n in part], dtype=float),
            )
            for part in (counted[i : i + 2000] for i in range(0, len(counted), 2000))
        ]
        # Longer pieces start out less likely, so that no length is favoured.
        table = np.array([10.0 ** -len(piece) for piece in vocabulary] + [1e-6])
        for _ in range(ROUNDS):
            counts = sum(lattice.expected(table, weight) for lattice, weight in lattices)
            table = (counts + 0.05) / (counts + 0.05).sum()
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang]), "table": pa.array([table.tobytes()], pa.binary())}
        )


# The model that a Python worker used last, with the words it has met.
_known: dict[str, Model | None] = {}


def identify(docs: DataFrame, text_column: str, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    number = uuid.uuid4().hex

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if number not in _known:
            _known.clear()
            _known[number] = pickle.loads(shared.value)
        texts = texts_of(batch.column(text_column))
        langs, scores = [], []
        for start in range(0, len(texts), 200):
            part = texts[start : start + 200]
            for lang, score in _identify(part, _known[number]):
                langs.append(lang)
                scores.append(score)
        return {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}

    return add_columns(docs, "lang_pred string, score double", make)


def _identify(texts: list[str | None], model: Model | None) -> list[tuple[str, float]]:
    lettered = [i for i, text in enumerate(texts) if text and _has_letter(text)]
    found = [(UNKNOWN, 0.0)] * len(texts)
    if model is None or not lettered:
        return found
    logs = model.scores([texts[i] for i in lettered])
    best = logs.argmax(axis=1)
    likely = np.exp(logs - logs.max(axis=1, keepdims=True))
    for at, i in enumerate(lettered):
        score = likely[at, best[at]] / likely[at].sum()
        found[i] = (model.languages[best[at]], float(score))
    return found
