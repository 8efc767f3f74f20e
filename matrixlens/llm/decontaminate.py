"""Benchmark decontamination by SimHash windows of the items' own sizes.

A document is compared with a benchmark item in windows of as many words as the item has, one
at every word.  Window and item have a 64-bit SimHash over their five-word shingles, weighted by
the characters of their words.  Fingerprints are cut into four blocks; if two differ in at most
``RADIUS`` bits, one block differs in at most ``RADIUS // 4``.  Items are entered under every such
neighbour of each block, so that an equi-join on (size, block, value) finds all items
within the radius.  What it finds is verified word by word: the weighted similarity
(sum of minima over sum of maxima) of the shingles must be ``SIMILARITY`` or more.

Two filters of fixed size spare most work and lose nothing.  A window whose shingles are for
less than ``SIMILARITY`` of its weight among the benchmark's shingles cannot reach that
similarity with any item; shingles are looked up in a bitmap of ``2**SHINGLE_BITS`` bits.  And a
block is handed to the join only if some item has its key, by a bitmap of ``2**KEY_BITS`` bits.
Larger benchmarks make the filters pass more, never less; they do not make them larger.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.llm.simhash import mixed
from matrixlens.llm.tables import fresh, written

SHINGLE, SIMILARITY = 5, 0.8
#: Windows of similarity 0.8 differ in 7 to 10 bits on average and hardly ever in more than 19.
RADIUS, BLOCKS, BLOCK_BITS = 19, 4, 16
#: Items handed on at once: each has some 10,000 keys.
_ITEMS_AT_ONCE = 64
SHINGLE_BITS, KEY_BITS = 22, 24
#: Windows whose bits are summed at once.
_AT_ONCE = 4096
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: ASCII signs and controls part words; A-Z have been lower-cased before.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8, parted by blanks and ASCII punctuation."""
    return text.lower().encode().translate(_PLAIN).split() if text else []


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(words: list[bytes], known: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and weight (characters of its words, in bytes) of every five-word shingle."""
    n = len(words) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    one = np.array(list(map(known.__getitem__, words)), np.uint64)
    sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    total = one[:n].copy()
    for i in range(1, SHINGLE):
        total = total * _FACTOR + one[i : i + n]
    before = np.concatenate([[0], sizes[: n - 1]])
    return mixed(total), sizes[SHINGLE - 1 :] - before


def window_fingerprints(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """SimHash of the ``n`` shingles from each of the sorted ``starts``."""
    out = []
    for at in range(0, len(starts), _AT_ONCE):
        some = starts[at : at + _AT_ONCE]
        # Starts may lie far apart; only stretches between them are cut out.
        cuts = np.flatnonzero(np.diff(some) > n) + 1
        for run in np.split(some, cuts):
            low, high = int(run[0]), min(int(run[-1]) + n, len(hashes))
            bits = np.unpackbits(np.ascontiguousarray(hashes[low:high]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sums = np.zeros((high - low + 1, 65), np.int64)
            np.cumsum(bits * weights[low:high, None], axis=0, out=sums[1:, :64])
            np.cumsum(weights[low:high], out=sums[1:, 64])
            ends = np.minimum(run - low + n, high - low)
            ones = sums[ends] - sums[run - low]
            out.append(np.packbits(2 * ones[:, :64] > ones[:, 64:], axis=1, bitorder="little").view(np.uint64).ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _neighbours(bits: int, radius: int) -> np.ndarray:
    """Masks of up to ``radius`` set bits."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], np.int64)


def block_values(fps: np.ndarray) -> np.ndarray:
    shifts = np.arange(BLOCKS, dtype=np.uint64) * np.uint64(BLOCK_BITS)
    return ((fps[:, None] >> shifts) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


def _key(size: np.ndarray | int, block: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One number for (size, block, value)."""
    return (np.asarray(size, np.int64) << 18) | (block << BLOCK_BITS) | value


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, masks = _Hashes(), _neighbours(BLOCK_BITS, RADIUS // BLOCKS)
    blocks = np.repeat(np.arange(BLOCKS), len(masks))
    parts = (batch.slice(at, _ITEMS_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, _ITEMS_AT_ONCE))
    for batch in parts:
        rows = {name: [] for name in ("item_id", "size", "item_fp", "item", "slots", "keys", "key_slots")}
        for item_id, text in zip(batch.column(0), batch.column(1), strict=True):
            words = plain_words(text.as_py())
            hashes, weights = shingles(words, known)
            if not len(hashes):
                continue
            fp = window_fingerprints(hashes, weights, np.zeros(1, np.int64), len(hashes))
            keys = _key(len(words), blocks, (block_values(fp)[0][:, None] ^ masks).ravel())
            found = (item_id, len(words), int(fp.view(np.int64)[0]), b" ".join(words).decode(), _slot(hashes, SHINGLE_BITS), keys, _slot(keys, KEY_BITS))
            for name, value in zip(rows, found, strict=True):
                rows[name].append(value)
        kinds = (batch.column(0).type, pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))


def _bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """Bits of a column ``slot``, put together by Spark; ``2**bits`` bits come to the driver, whatever the input."""
    slot = F.col("slot")
    parts = slots.groupBy(F.bitmap_bucket_number(slot).alias("no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("part"))
    out = np.zeros((1 << bits) + (1 << 15), np.uint8)
    for no, part in parts.collect():
        # Bucket numbers begin at 1 and bit positions at 0, for the slots from 1; slot 0 is in bucket 0.
        unpacked = np.unpackbits(np.frombuffer(part, np.uint8), bitorder="little")
        low = ((no - 1) << 15) + 1 if no else 0
        out[low : low + len(unpacked)] |= unpacked
    return out[: 1 << bits].astype(bool)


def _scan(sizes: list[int], shingle_map, key_map):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, keyed = _Hashes(), shingle_map.value, key_map.value
        region = (TaskContext.get().partitionId() << 40) - 1
        for batch in batches:
            out = {"doc": [], "region": [], "text": [], "start": [], "size": [], "fp": [], "key": []}
            for row, value in enumerate(batch.column(1)):
                words = plain_words(value.as_py())
                hashes, weights = shingles(words, known)
                if not len(hashes):
                    continue
                hit = seen[_slot(hashes, SHINGLE_BITS)]
                if not hit.any():
                    continue
                found = list(_windows(hashes, weights, hit, len(words), sizes, keyed))
                if not found:
                    continue
                covered = np.zeros(len(words) + 1, np.int64)
                for starts, size, *_ in found:
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, np.minimum(starts + size, len(words)), -1)
                inside = np.concatenate([[False], np.cumsum(covered[:-1]) > 0, [False]])
                edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
                for low, high in edges:
                    region += 1
                    for name, v in zip(out, (row, region, b" ".join(words[low:high]).decode(), None, None, None, None), strict=True):
                        out[name].append(v)
                    for starts, size, fps, keys in found:
                        own = (starts >= low) & (starts < high)
                        n = int(own.sum())
                        for name, v in zip(out, ([row] * n, [region] * n, [None] * n, starts[own] - low, [size] * n, fps[own].view(np.int64), keys[own]), strict=True):
                            out[name].extend(v)
            rows = pa.array(out.pop("doc"), pa.int64())
            owners = [batch.column(0).take(rows), batch.column(2).take(rows)]
            kinds = (pa.int64(), pa.string(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([*owners, *(pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True))], names=["doc_id", "text_key", *out])

    return scan


def _possible_starts(shared: np.ndarray, total: np.ndarray, n: int) -> np.ndarray:
    """Where a window of ``n`` shingles or more could begin that has ``SIMILARITY`` of its weight in hits.

    ``shared`` and ``total`` are sums of weights up to each shingle.  Some starts are too many, as
    windows of any greater length are asked for, but none is missing; a last window may be shorter.
    """
    excess = shared - SIMILARITY * total
    best = np.maximum.accumulate(excess[::-1])[::-1]
    ends = np.minimum(np.arange(n, len(excess) - 1 + n), len(excess) - 1)
    # Weights are whole numbers; what rounding does to sums of them is far less.
    return np.flatnonzero(best[ends] - excess[:-1] >= -0.01)


def _windows(hashes, weights, hit, n_words, sizes, keyed):
    """(starts, size, fingerprints, keys) of windows that could match, an entry per window and block; ``sizes`` ascend."""
    total = np.concatenate([[0], np.cumsum(weights)])
    shared = np.concatenate([[0], np.cumsum(weights * hit)])
    # Most texts have a hit by chance and no window for it: one look, not one for each size.
    near = _possible_starts(shared, total, max(1, sizes[0] - SHINGLE + 1))
    if not len(near):
        return
    for size in sizes:
        n = size - SHINGLE + 1
        some = near[: np.searchsorted(near, max(0, n_words - size), "right")]
        ends = np.minimum(some + n, len(hashes))
        starts = some[shared[ends] - shared[some] >= SIMILARITY * (total[ends] - total[some])]
        if not len(starts):
            continue
        fps = window_fingerprints(hashes, weights, starts, n)
        keys = _key(size, np.arange(BLOCKS), block_values(fps))
        where, block = np.nonzero(keyed[_slot(keys.ravel(), KEY_BITS).reshape(keys.shape)])
        if len(where):
            yield starts[where], size, fps[where], keys[where, block]


def similarity(one: list[str], other: list[str]) -> float:
    """Weighted similarity of two word lists by their five-word shingles, repeats included."""
    a, b = (Counter(tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)) for w in (one, other))
    weight = {s: sum(len(w.encode()) for w in s) for s in a | b}
    most = sum(n * weight[s] for s, n in (a | b).items())
    return sum(n * weight[s] for s, n in (a & b).items()) / most if most else 0.0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, starts, sizes, items = (batch.column(i).to_pylist() for i in (3, 4, 5, 6))
        scores = []
        for text, start, size, item in zip(texts, starts, sizes, items, strict=True):
            scores.append(similarity(text.split(" ")[start : start + size], item.split(" ")))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores, pa.float64())], names=["doc_id", "text_key", "item_id", "similarity"])


def _matches(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_key (a hash of the text), item_id and similarity of every verified window."""
    sc = docs.sparkSession.sparkContext
    item_kind, doc_kind = benchmark.schema["item_id"].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    lists = "slots array<long>, keys array<long>, key_slots array<long>"
    items = benchmark.select("item_id", "text").mapInArrow(_items, f"item_id {item_kind}, size long, item_fp long, item string, {lists}")
    items = written(items)
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    maps = [sc.broadcast(_bitmap(items.select(F.explode(c).alias("slot")), bits)) for c, bits in (("slots", SHINGLE_BITS), ("key_slots", KEY_BITS))]
    schema = f"doc_id {doc_kind}, text_key long, region long, text string, start long, size long, fp long, key long"
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    found = written(texts.mapInArrow(_scan(sizes, *maps), schema))
    keys = items.select("item_id", "item_fp", F.explode(F.array_distinct("keys")).alias("key"))
    near: Column = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS
    windows = found.where("text IS NULL").join(keys, "key").where(near)
    windows = windows.select("region", "start", "size", "item_id").distinct()
    regions = found.where("text IS NOT NULL").select("doc_id", "text_key", "region", "text")
    wanted = items.select(F.col("item_id").alias("_item"), F.col("size").alias("_size"), "item")
    full = windows.join(regions, "region").join(wanted, F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("size") == F.col("_size")))
    full = full.select("doc_id", "text_key", "item_id", "text", "start", "size", "item")
    scored = full.mapInArrow(_verify, f"doc_id {doc_kind}, text_key long, item_id {item_kind}, similarity double")
    return scored.where(F.col("similarity") >= SIMILARITY)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that hold a benchmark item: doc_id, item_id, similarity (of the best window).

    One row per document and item of at least ``SIMILARITY``; clean documents give none.  Words are
    lower-cased and parted by blanks and ASCII punctuation.  Items of fewer than five words
    have no shingle and match nothing; null and empty texts neither.  Repeated items count each
    under its id, rows of one document id together.  A document shorter than an item is one
    window.  Ids may be null; other columns are not looked at.
    """
    found = _matches(docs, benchmark, doc_id, text)
    return found.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns are kept.

    Rows that share an id, or have none, are judged each by its own text.
    """
    bad, key = fresh(docs, "_bad"), fresh(docs, "_key")
    found = _matches(docs, benchmark, doc_id, text).select(F.col("doc_id").alias(bad), F.col("text_key").alias(key)).distinct()
    same = F.col(doc_id).eqNullSafe(F.col(bad)) & (F.xxhash64(text) == F.col(key))
    return docs.join(found, same, "left_anti")
