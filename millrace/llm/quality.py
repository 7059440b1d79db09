"""Text quality by a factorisation machine over hashed words and structure.

The score of a text with features ``x`` is the logistic function of
``bias + w.x + sum over pairs <v_i, v_j> x_i x_j``; the pairs are summed in linear time
as ``((sum v_i x_i)^2 - sum (v_i x_i)^2) / 2`` per factor. Features are the text's words,
hashed to ``SLOTS`` places, and measures of its form (see ``STRUCTURE``).

The machine is fitted in one task on at most about ``sample`` labelled texts, chosen by a
hash of their id: what a task holds does not grow with the corpus. Every text is scored
as a whole, where it is.

Defined results: a null or empty text has no words and all measures 0, and is scored;
texts without a label, labels without a text and null labels teach nothing; without any
usable label every score is 0.5. Columns of the texts are kept, save ``score``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import SPACED, Chunk, Hashes, chunks, lowered, mix, words
from millrace.llm.frames import add_columns, place_of, share_of, small_batches

SLOTS = 1 << 15
FACTORS = 8
SAMPLE = 20_000
STRUCTURE = (
    "bytes, as a logarithm",
    "words, as a logarithm",
    "bytes a word",
    "capitals among ASCII letters",
    "digits among bytes",
    "ASCII signs among bytes",
    "signs that do not end or part sentences among bytes",
    "bytes beyond ASCII",
    "distinct words among words",
    "words in repeated runs of five among words",
    "line breaks among words",
    "repeated lines among lines",
)
_BATCH, _EPOCHS, _RATE, _DECAY = 128, 6, 0.05, 1e-5

_bytes = np.arange(256)
_CAPITAL = (_bytes >= 65) & (_bytes <= 90)
_LETTER = _CAPITAL | ((_bytes >= 97) & (_bytes <= 122))
_DIGIT = (_bytes >= 48) & (_bytes <= 57)
_SIGN = (_bytes > 32) & (_bytes < 127) & ~_LETTER & ~_DIGIT
_ODD_SIGN = _SIGN & ~np.isin(_bytes, [ord(c) for c in ".,;:?'\"()-"])
_BEYOND = _bytes > 127


class Features:
    """Of the texts of a chunk: words as sorted ``text, slot, value``, and measures."""

    def __init__(self, chunk: Chunk):
        texts = len(chunk.starts)
        low = lowered(chunk)
        found = words(low, SPACED)
        codes = Hashes.of_bytes(low.data).runs(found.starts, found.ends)
        size = found.last - found.first
        owner = np.repeat(np.arange(texts), size)
        key = owner * SLOTS + (codes % np.uint64(SLOTS)).astype(np.int64)
        key, count = np.unique(key, return_counts=True)
        self.text, self.slot = key // SLOTS, key % SLOTS
        value = np.log1p(count)
        norm = np.sqrt(np.bincount(self.text, value**2, minlength=texts))
        self.value = value / np.maximum(norm, 1e-9)[self.text]
        self.structure = _structure(chunk, codes, owner, size)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _repeats(owner: np.ndarray, codes: np.ndarray, texts: int) -> np.ndarray:
    """Per text how many of its codes have occurred in it before."""
    mixed = mix(codes ^ mix(owner.astype(np.uint64)))
    _, first = np.unique(mixed, return_index=True)
    fresh = np.bincount(owner[first], minlength=texts)
    return np.bincount(owner, minlength=texts) - fresh


def _structure(
    chunk: Chunk, codes: np.ndarray, owner: np.ndarray, size: np.ndarray
) -> np.ndarray:
    texts = len(chunk.starts)
    length = chunk.ends - chunk.starts

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(table[chunk.data])))
        return sums[chunk.ends] - sums[chunk.starts]

    runs = Hashes(codes).grams(5)
    same_text = owner[4:] == owner[: len(owner) - 4] if len(owner) > 4 else np.zeros(0, bool)
    repeated = _repeats(owner[: len(runs)][same_text], runs[same_text], texts)
    not_break = np.ones(256, dtype=bool)
    not_break[10] = False
    lines = words(chunk, not_break)
    line_codes = Hashes.of_bytes(chunk.data).runs(lines.starts, lines.ends)
    n_lines = lines.last - lines.first
    line_owner = np.repeat(np.arange(texts), n_lines)
    return np.stack(
        [
            np.log1p(length),
            np.log1p(size),
            _share(length, size) * (size > 0),
            _share(count(_CAPITAL), count(_LETTER)),
            _share(count(_DIGIT), length),
            _share(count(_SIGN), length),
            _share(count(_ODD_SIGN), length),
            _share(count(_BEYOND), length),
            1 - _share(_repeats(owner, codes, texts), size),
            _share(repeated, size),
            _share(count(~not_break), size),
            _share(_repeats(line_owner, line_codes, texts), n_lines),
        ],
        axis=1,
    )


class Machine:
    """A factorisation machine over ``SLOTS`` words and the measures behind them."""

    def __init__(self):
        features = SLOTS + len(STRUCTURE)
        self.bias = 0.0
        self.linear = np.zeros(features)
        self.factors = np.random.default_rng(7).normal(0, 0.01, (features, FACTORS))
        self.mean = np.zeros(len(STRUCTURE))
        self.spread = np.ones(len(STRUCTURE))

    def rows(self, features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All features as ``text, feature, value``."""
        texts = len(features.structure)
        scaled = np.clip((features.structure - self.mean) / self.spread, -3, 3) / 3
        return (
            np.concatenate((features.text, np.repeat(np.arange(texts), len(STRUCTURE)))),
            np.concatenate((features.slot, np.tile(SLOTS + np.arange(len(STRUCTURE)), texts))),
            np.concatenate((features.value, scaled.ravel())),
        )

    def sums(self, text: np.ndarray, feature: np.ndarray, value: np.ndarray, texts: int):
        """Logits, and per text and factor the sum of ``v_i x_i``."""
        terms = self.factors[feature] * value[:, None]
        total = np.stack(
            [np.bincount(text, terms[:, f], minlength=texts) for f in range(FACTORS)], axis=1
        )
        squares = np.bincount(text, (terms**2).sum(axis=1), minlength=texts)
        linear = np.bincount(text, self.linear[feature] * value, minlength=texts)
        return self.bias + linear + ((total**2).sum(axis=1) - squares) / 2, total

    def score(self, features: Features) -> np.ndarray:
        texts = len(features.structure)
        logits, _ = self.sums(*self.rows(features), texts)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    def fit(self, blocks: list[tuple[Features, np.ndarray]]) -> None:
        """Logistic loss by AdaGrad over small batches, in an order fixed by a seed.

        Each block holds one text. All features are held once, in 12 bytes each.
        """
        structure = np.concatenate([features.structure for features, _ in blocks])
        self.mean = structure.mean(axis=0)
        self.spread = np.maximum(structure.std(axis=0), 1e-6)
        sizes = [len(features.text) + len(STRUCTURE) for features, _ in blocks]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        feature = np.empty(ends[-1], dtype=np.int32)
        value = np.empty(ends[-1], dtype=np.float32)
        for (features, _), start, end in zip(blocks, ends, ends[1:]):
            _, feature[start:end], value[start:end] = self.rows(features)
        labels = np.concatenate([labels for _, labels in blocks])
        known = [1e-6, np.full(len(self.linear), 1e-6), np.full(self.factors.shape, 1e-6)]
        random = np.random.default_rng(11)
        for _ in range(_EPOCHS):
            shuffled = random.permutation(len(labels))
            for start in range(0, len(labels), _BATCH):
                chosen = shuffled[start : start + _BATCH]
                sizes = ends[chosen + 1] - ends[chosen]
                at = np.repeat(ends[chosen], sizes) + (
                    np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                )
                owner = np.repeat(np.arange(len(chosen)), sizes)
                self._step(owner, feature[at], value[at], labels[chosen], known)

    def _step(self, owner, feature, value, labels, known) -> None:
        logits, total = self.sums(owner, feature, value, len(labels))
        error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) / len(labels)
        touched, place = np.unique(feature, return_inverse=True)
        weight = error[owner] * value
        linear = np.bincount(place, weight) + _DECAY * self.linear[touched]
        pull = weight[:, None] * (total[owner] - self.factors[feature] * value[:, None])
        factors = np.stack(
            [np.bincount(place, pull[:, f]) for f in range(FACTORS)], axis=1
        ) + _DECAY * self.factors[touched]
        known[0] += error.sum() ** 2
        known[1][touched] += linear**2
        known[2][touched] += factors**2
        self.bias -= _RATE * error.sum() / np.sqrt(known[0])
        self.linear[touched] -= _RATE * linear / np.sqrt(known[1][touched])
        self.factors[touched] -= _RATE * factors / np.sqrt(known[2][touched])


def fit(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    labels: DataFrame,
    label_id_column: str,
    label_column: str,
    sample: int = SAMPLE,
    use: Column | None = None,
) -> Machine | None:
    """A machine fitted on labelled texts; None without any. ``use``, a condition on
    ``id``, says which labels may be learnt from."""
    usable = labels.select(
        F.col(label_id_column).alias("id"), F.col(label_column).cast("double").alias("label")
    ).filter("id is not null and label is not null")
    if use is not None:
        usable = usable.filter(use)
    found = usable.count()
    if not found:
        return None
    # About ``sample`` labels, however many there are: few enough to broadcast.
    chosen = usable.filter(place_of(F.col("id"), 17) < share_of(sample, found))
    texts = small_batches(docs).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text")
    )
    taught = (
        texts.join(F.broadcast(chosen), "id")
        .select("id", "label", "text")
        .mapInArrow(_feature_rows, "id string, label double, features binary")
    )
    rows = taught.repartition(1).mapInArrow(_fit_rows, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else None


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            made = Features(next(chunks(row.column("text"))))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": row.column("id").cast(pa.string()),
                    "label": row.column("label"),
                    "features": pa.array([pickle.dumps(_thin(made))], pa.binary()),
                }
            )


def _thin(features: Features) -> Features:
    """The same in half the bytes, to be held for a whole sample."""
    features.text = features.text.astype(np.int32)
    features.slot = features.slot.astype(np.int32)
    features.value = features.value.astype(np.float32)
    return features


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [
        (row["id"], row["label"], row["features"]) for batch in batches for row in batch.to_pylist()
    ]
    if not rows:
        return
    # The order in which rows arrive must not matter.
    rows.sort(reverse=True)
    blocks = []
    while rows:
        _, label, features = rows.pop()
        blocks.append((pickle.loads(features), np.array([label])))
    machine = Machine()
    machine.fit(blocks)
    model = pa.array([pickle.dumps(machine)], pa.binary())
    yield pa.RecordBatch.from_pydict({"model": model})


def score(docs: DataFrame, text_column: str, machine: Machine | None) -> DataFrame:
    """``docs`` with ``score``, from 0 to 1: how likely a text is good."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        known = shared.value
        if known is None:
            return {"score": pa.array([0.5] * batch.num_rows, pa.float64())}
        scores = [known.score(Features(chunk)) for chunk in chunks(batch.column(text_column))]
        joined = np.concatenate(scores) if scores else np.zeros(0)
        return {"score": pa.array(joined, pa.float64())}

    return add_columns(docs, "score double", make)
