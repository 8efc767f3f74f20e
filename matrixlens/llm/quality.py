"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score of a document with features x is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)),

the last term being all pairwise interactions in the time of one pass over the features.
Features are words hashed into ``WORD_SLOTS`` slots (log counts, scaled to unit length), and
binned statistics of the text's structure and of its metadata, one slot per bin.

The model is fitted on the driver on at most ``TRAINING_ROWS`` labelled rows (those whose id
hashes lowest), which bounds its time and memory; every document is scored, in one pass over
the table and without a shuffle.  The model is ``SLOTS * (FACTORS + 1)`` floats, 2.4 MB, whatever
the corpus.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.llm.simhash import words_of
from matrixlens.llm.tables import in_fold

TRAINING_ROWS = 4_000
WORD_SLOTS, BINS = 1 << 16, 16
FACTORS = 8
EPOCHS, BATCH, RATE, SHRINK = 8, 64, 0.1, 1e-5
THRESHOLD = 0.3
#: Structure statistics and metadata; each has BINS slots after those of the words.
STATISTICS = (
    "log2 words", "word length", "share of letters", "share of capitals", "share of digits", "share of punctuation",
    "share of other bytes", "different words", "share of first word", "words a line", "different lines",
    "single-character words", "words ending in a sign", "words like the one before", "log2 stated size", "stated size wrong",
)
SLOTS = WORD_SLOTS + BINS * len(STATISTICS)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_HIGH = np.arange(256) >= 128
_SIGN = ~(_SPACE | _LOWER | _UPPER | _DIGIT | _HIGH) & (np.arange(256) > 32)


class _Slots(dict):
    """Word to its slot, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        slot = self[word] = xxhash.xxh64_intdigest(word) % WORD_SLOTS
        return slot


def _bin(share: float) -> int:
    """Square-root scale, finer for small shares."""
    return min(BINS - 1, int(BINS * min(1.0, max(0.0, share)) ** 0.5))


def _log_bin(n: float) -> int:
    return min(BINS - 1, int(n).bit_length())


def features(text: str | None, stated: int | None, slots: _Slots) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their values; ``stated`` is the size the metadata give, if any."""
    text = text or ""
    raw = text.encode()
    words = words_of(text)
    n = max(1, len(words))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    total = max(1, int(counts[~_SPACE].sum()))
    lines = text.split("\n")
    ends = sum(1 for w in words if _SIGN[w[-1]])
    bins = [
        _log_bin(len(words)), min(BINS - 1, len(raw) // n), _bin(counts[_LOWER | _HIGH].sum() / total), _bin(counts[_UPPER].sum() / total),
        _bin(counts[_DIGIT].sum() / total), _bin(counts[_SIGN].sum() / total), _bin(counts[_HIGH].sum() / total),
        _bin(len(set(words)) / n), _bin(words.count(words[-1]) / n if words else 0), _log_bin(n / len(lines)),
        _bin(len(set(lines)) / len(lines)), _bin(sum(1 for w in words if len(w) == 1) / n), _bin(ends / n),
        _bin(sum(map(operator.eq, words, words[1:])) / n), 0 if stated is None else _log_bin(stated), 2 if stated is None else int(stated != len(text)),
    ]
    ids, times = np.unique(np.fromiter(map(slots.__getitem__, words), np.int32, len(words)), return_counts=True)
    values = np.log1p(times).astype(np.float32)
    values /= max(1e-6, float(np.sqrt((values**2).sum())))
    own = WORD_SLOTS + np.arange(len(bins), dtype=np.int32) * BINS + np.array(bins, np.int32)
    return np.concatenate([ids, own]).astype(np.int32), np.concatenate([values, np.full(len(own), 0.5, np.float32)])


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray  # SLOTS
    factors: np.ndarray  # SLOTS x FACTORS

    def margins(self, ids: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of documents whose features follow one another, each beginning at ``starts``."""
        weighted = self.factors[ids] * values[:, None]
        sums = np.add.reduceat(weighted, starts, axis=0)
        squares = np.add.reduceat(weighted**2, starts, axis=0)
        return self.bias + np.add.reduceat(self.linear[ids] * values, starts) + 0.5 * (sums**2 - squares).sum(axis=1)

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> FactorisationMachine:
        """Logistic loss, AdaGrad, mini-batches in a fixed random order."""
        rng = np.random.default_rng(0)
        share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
        model = cls(float(np.log(share / (1 - share))), np.zeros(SLOTS, np.float32), rng.normal(0, 0.05, (SLOTS, FACTORS)).astype(np.float32))
        seen_linear, seen_factors = np.full(SLOTS, 1e-2, np.float32), np.full((SLOTS, FACTORS), 1e-2, np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                ids = np.concatenate([rows[i][0] for i in chosen])
                values = np.concatenate([rows[i][1] for i in chosen])
                sizes = np.array([len(rows[i][0]) for i in chosen])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                error = 1 / (1 + np.exp(-model.margins(ids, values, starts))) - labels[chosen]
                each = np.repeat(error, sizes).astype(np.float32) * values
                weighted = model.factors[ids] * values[:, None]
                sums = np.repeat(np.add.reduceat(weighted, starts, axis=0), sizes, axis=0)
                touched, where = np.unique(ids, return_inverse=True)
                grad = np.zeros((len(touched), FACTORS + 1), np.float32)
                np.add.at(grad, where, np.concatenate([each[:, None], each[:, None] * (sums - weighted)], axis=1))
                grad /= len(chosen)
                grad[:, 0] += SHRINK * model.linear[touched]
                grad[:, 1:] += SHRINK * model.factors[touched]
                seen_linear[touched] += grad[:, 0] ** 2
                seen_factors[touched] += grad[:, 1:] ** 2
                model.linear[touched] -= RATE * grad[:, 0] / np.sqrt(seen_linear[touched])
                model.factors[touched] -= RATE * grad[:, 1:] / np.sqrt(seen_factors[touched])
                model.bias -= RATE * float(error.mean())
        return model


def _inputs(docs: DataFrame, doc_id: str, text: str, stated: str | None) -> DataFrame:
    size = F.col(stated).cast("long") if stated else F.lit(None).cast("long")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), size.alias("stated"))


def _training_rows(docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str, text: str, stated: str | None, label: str):
    ids = labels.where(~held_out & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    ids = ids.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    ids = ids.orderBy(F.xxhash64("_id"), "_id").limit(TRAINING_ROWS)  # at most so many ids, and so small
    found = _inputs(docs, doc_id, text, stated).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for batch in batches:
            rows = [features(t.as_py(), s.as_py(), slots) for t, s in zip(batch.column(1), batch.column(2), strict=True)]
            packed = [pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), *packed], names=["doc_id", "label", "ids", "values"])

    found = found.select("doc_id", "text", "stated", "_id", F.col("_label").cast("int"))
    kind = docs.schema[doc_id].dataType.simpleString()
    packed = found.mapInArrow(work, f"doc_id {kind}, label int, ids binary, values binary")
    # Rows that share an id count once, so that no id can fill the sample.
    return packed.groupBy("doc_id").agg(F.min(F.struct("label", "ids", "values")).alias("row")).select("row.*")


def train(docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", stated: str | None = "n_chars", label: str = "quality") -> FactorisationMachine:
    """Fit on labelled rows of ``labels`` (doc_id, label) outside ``held_out``, a condition on its columns.

    Rows without an id or a label are passed over; of several labels of an id the largest
    counts.  Without any labelled row the model gives 0.5 to every document.
    """
    rows = _training_rows(docs, labels, held_out, doc_id, text, stated, label).orderBy("ids").collect()
    sparse = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["values"], np.float32)) for r in rows]
    return FactorisationMachine.fit(sparse, np.array([float(r["label"]) for r in rows]))


def _scores(model: FactorisationMachine, texts: list[str | None], sizes: list[int | None], slots: _Slots) -> np.ndarray:
    out = [np.zeros(0)]
    for at in range(0, len(texts), 256):
        rows = [features(t, s, slots) for t, s in zip(texts[at : at + 256], sizes[at : at + 256], strict=True)]
        lengths = np.array([len(r[0]) for r in rows])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        margins = model.margins(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), starts)
        out.append(1 / (1 + np.exp(-np.clip(margins.astype(np.float64), -60, 60))))
    return np.concatenate(out)


def score(docs: DataFrame, model: FactorisationMachine, doc_id: str = "doc_id", text: str = "text", stated: str | None = "n_chars") -> DataFrame:
    """doc_id and score (0 to 1, higher is better) of every row of ``docs``.

    Null and empty texts are scored by their structure alone; repeated rows get equal scores;
    no other column is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _Slots()
        for batch in batches:
            scores = _scores(shared.value, batch.column(1).to_pylist(), batch.column(2).to_pylist(), slots)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return _inputs(docs, doc_id, text, stated).mapInArrow(work, f"doc_id {kind}, score double")


def accepted(docs: DataFrame, model: FactorisationMachine, text: str = "text", stated: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, with all their columns.

    The text crosses to Python once and the columns do not: each row's own score decides, so
    repeated and null ids make no difference.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series, sizes: pd.Series) -> pd.Series:
        stated_sizes = [None if pd.isna(s) else int(s) for s in sizes]
        return pd.Series(_scores(shared.value, texts.tolist(), stated_sizes, _Slots()))

    size = F.col(stated).cast("long") if stated else F.lit(None).cast("long")
    return docs.where(scored(F.col(text), size) >= THRESHOLD)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train outside the fold crc32(id) mod 5 = 0 and score all: doc_id, held_out, score, predicted."""
    model = train(docs, labels, in_fold("doc_id", 5, 0))
    scored = score(docs, model)
    return scored.select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
