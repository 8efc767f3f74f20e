"""SimHash fingerprints of word shingles, and what is done with them word by word."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

#: Seed of XXH64, as in Spark's own function.
SEED = 42
_CHUNK = 1 << 16
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers (uint64) scattered by a bijection, so that all their bits look random."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 with A-Z lower-cased; none for null."""
    return text.encode().lower().split() if text else []


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, space-joined; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    joined, size = b" ".join(words), min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes; no hashes give zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):  # bounds the memory for very long texts
        some = np.ascontiguousarray(hashes[at : at + _CHUNK]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def text_key(text: Column) -> Column:
    """SHA-256 of a text, one zero byte for null: what tells texts apart where they are not at hand."""
    return F.coalesce(F.unhex(F.sha2(text.cast("binary"), 256)), F.lit(b"\0"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, with_key: bool = False) -> DataFrame:
    """doc_id and the 64-bit fingerprint ``fp`` (as a signed long) of every row of ``docs``; ``text_key`` too if asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(words_of(t.as_py()), size)) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))]
            if with_key:
                texts = (t.as_py() for t in batch.column(1))
                columns.append(pa.array([b"\0" if t is None else hashlib.sha256(t.encode()).digest() for t in texts], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "text_key"][: len(columns)])

    kind = docs.schema[doc_id].dataType.simpleString()
    returned = f"doc_id {kind}, fp long" + (", text_key binary" if with_key else "")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, returned)
