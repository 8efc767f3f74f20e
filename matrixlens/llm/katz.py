"""Katz back-off language model: fitted on part of a corpus, evaluated on all of it.

An n-gram seen ``c`` times after its history has probability ``d(c) c / c(history)`` with the
Good-Turing discount ``d``; an unseen one has the history's back-off weight times the
probability after the shorter history, down to single tokens; unknown tokens share what the
discounts leave over of those.  Weights are such that the probabilities after each history,
over the vocabulary and one unknown token, sum to one.

Moving every token of the corpus through a join would shuffle many times its size.  Instead
the corpus is cut into blocks of some millions of tokens, and blocks exchange packed, sorted
key lists with the tables, which are partitioned into buckets by ranges of a hash:

1. ``_tokenise``: documents to blocks (distinct words, the tokens as numbers of these).
2. ``_ask``: a block sends its distinct n-grams, with their counts in training documents, to
   their buckets.  However frequent an n-gram, a block sends it once.
3. ``_tally``: a bucket merges these into the table of n-gram counts, sends every block its
   totals, and names for each n-gram one block as its owner.
4. ``_evaluate``: a block scores its tokens as far as counts go.  For each n-gram it owns it adds
   to the sums that normalise the history's back-off weight, and it asks for the weights of
   histories that some of its tokens back off from.
5. ``_weigh``: a bucket turns the sums into the table of back-off weights and answers.
6. ``_finish``: a block adds the weights and gives a row for each document.

N-grams of two and more words are known by 56 bits of their hash, single words by 64.
Intermediate tables are written once each to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.llm.simhash import mixed, words_of
from matrixlens.llm.tables import discard, write_scratch, written

ORDER = 2
#: Counts above this are discounted by a constant, not by Good-Turing.
LARGEST_RARE = 5
#: Slopes that the counts of counts may have, and the one they are given where they do not tell.
STEEPNESS, ZIPF = (-8.0, -1.25), -2.0
#: Blocks whose lists one bucket takes, about.
BLOCKS_A_BUCKET = 8
#: Tokens after which a block is closed.
BLOCK_TOKENS = 1_500_000
#: Ends every document; holds a blank, so it is no word.
END = b" end"
_KNOWN_WORDS = 200_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_KEPT = np.uint64(0xFFFFFFFFFFFFFF00)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _pack(a: np.ndarray) -> bytes:
    """Compressed byte by byte: all first bytes, all second bytes, and so on."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


def _small(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint32) if not len(a) or a.max() < 1 << 32 else a.astype(np.uint64)


def _pack_counts(a: np.ndarray) -> bytes:
    a = _small(a)
    return bytes([a.itemsize]) + _pack(a)


def _unpack_counts(raw: bytes) -> np.ndarray:
    return _unpack(raw[1:], np.uint32 if raw[0] == 4 else np.uint64).astype(np.int64)


def _slices(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted keys, by equal ranges of the hash, and where each lies; empty ones are left out."""
    bounds = np.searchsorted(((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        yield b, slice(int(bounds[b]), int(bounds[b + 1]))


def slope(n: list[int]) -> float:
    """Of the line through the logarithms of counts of counts, ``n[r - 1]`` n-grams that occur ``r`` times.

    Each is averaged over the empty counts around it first.  Kept within ``STEEPNESS``, so that a line
    that says nothing, or there being none, does no harm; without two points it is Zipf's.
    """
    seen = [r for r, x in enumerate(n, 1) if x > 0]
    if len(seen) < 2:
        return ZIPF
    sides = zip(seen, [0, *seen[:-1]], [*seen[1:], 2 * seen[-1] - seen[-2]], strict=True)
    y = np.log([n[r - 1] / (0.5 * (after - before)) for r, before, after in sides])
    return float(np.clip(np.polyfit(np.log(seen), y, 1)[0], *STEEPNESS))


def discounts(n: list[int]) -> np.ndarray:
    """What is subtracted from counts 0, 1, ..., ``LARGEST_RARE`` and all above.

    ``n[r - 1]`` n-grams occur ``r`` times, up to ``r = LARGEST_RARE + 1``.  Katz's discounts, with
    counts of counts smoothed by a line through their logarithms (simple Good-Turing): raw ones
    jump where a corpus holds copies.  Steeper than -1, the line gives discounts between 0 and 1
    at any size.  Counts above ``LARGEST_RARE`` lose as much as it does, so that every history has
    something left for what it has not been followed by.
    """
    k, b = LARGEST_RARE, slope(n) + 1
    common = (k + 1) ** b
    r = np.arange(1, k + 1)
    loss = r * (1 - (((r + 1) / r) ** b - common) / (1 - common))
    return np.array([0.0, *loss, loss[-1]])


def _lowered(counts: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return counts - loss[np.minimum(counts, LARGEST_RARE + 1)]


@dataclass
class Statistics:
    """Of the training tokens: number, different words, and by order what discounts subtract and what words leave over."""

    tokens: int
    vocabulary: int
    loss: list[np.ndarray]
    unknown: float


class _Block:
    """The tokens of a block with the keys of its n-grams, order by order.

    Per order: ``keys`` of the n-gram that ends at each token, ``at`` the tokens that have one,
    the ``distinct`` keys, the ``first`` token of each, and the ``number`` each one has among them.
    """

    def __init__(self, words: np.ndarray, stream: np.ndarray, lengths: np.ndarray, order: int) -> None:
        self.lengths = lengths
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.keys, self.at, self.distinct, self.first, self.number = [words[stream]], [slice(None)], [words], [None], [stream]
        begins = np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
        place = np.arange(len(stream), dtype=np.int32) - begins
        del begins
        for k in range(1, order):
            longer = np.zeros(len(stream), np.uint64)
            longer[1:] = mixed(self.keys[-1][:-1] * _FACTOR + self.keys[0][1:]) & _KEPT
            at = np.flatnonzero(place >= k).astype(np.int32)
            distinct, first, number = np.unique(longer[at], return_index=True, return_inverse=True)
            for held, value in zip((self.keys, self.at, self.distinct, self.first, self.number), (longer, at, distinct, at[first], number.astype(np.int32)), strict=True):
                held.append(value)


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, end = _Hashes(), np.array([xxhash.xxh64_intdigest(END)], np.uint64)
    block = TaskContext.get().partitionId() << 32
    ids, held, parts, size = [], [], [], 0

    def close() -> pa.RecordBatch:
        words, stream = np.unique(np.concatenate(parts), return_inverse=True)
        lengths = np.array([len(p) for p in parts], np.int64)
        row = {"block": block, "ids": ids, "held": held, "lengths": _pack(lengths), "words": _pack_sorted(words), "stream": _pack(stream.astype(np.int32))}
        return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

    for batch in batches:
        for i, h, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = words_of(text)
            ids.append(i)
            held.append(h)
            parts.append(np.concatenate([np.array(list(map(known.__getitem__, words)), np.uint64), end]))
            size += len(parts[-1])
            if size >= BLOCK_TOKENS:
                yield close()
                block += 1
                ids, held, parts, size = [], [], [], 0
    if parts:
        yield close()


_BLOCKS = pa.schema({"block": pa.int64(), "ids": pa.list_(pa.string()), "held": pa.list_(pa.bool_()), "lengths": pa.binary(), "words": pa.binary(), "stream": pa.binary()})
_BLOCKS_SQL = "block long, ids array<string>, held array<boolean>, lengths binary, words binary, stream binary"


def _opened(row: dict, order: int) -> tuple[_Block, np.ndarray]:
    """The block, and per token whether it is for training."""
    lengths = _unpack(row["lengths"], np.int64)
    block = _Block(_unpack_sorted(row["words"]), _unpack(row["stream"], np.int32), lengths, order)
    return block, np.repeat(~np.array(row["held"], bool), lengths)


_LISTS = pa.schema({"kind": pa.string(), "order": pa.int32(), "bucket": pa.int32(), "block": pa.int64(), "p1": pa.binary(), "p2": pa.binary(), "p3": pa.binary(), "p4": pa.binary()})
_LISTS_SQL = "kind string, order int, bucket int, block long, p1 binary, p2 binary, p3 binary, p4 binary"


def _rows(rows: list[tuple]) -> pa.Table:
    """Rows of ``_LISTS``; those that lack payloads get nulls."""
    return pa.table([pa.array([r[i] if i < len(r) else None for r in rows], f.type) for i, f in enumerate(_LISTS)], schema=_LISTS)


def _ask(order: int, buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, training = _opened(row, order)
                for k in range(order):
                    counts = np.bincount(block.number[k], weights=training[block.at[k]], minlength=len(block.distinct[k])).astype(np.int64)
                    rows = [
                        ("ask", k, b, row["block"], _pack_sorted(block.distinct[k][s]), _pack_counts(counts[s]))
                        for b, s in _slices(block.distinct[k], buckets)
                    ]
                    yield from _rows(rows).to_batches()

    return ask


def _tally(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["block"])
    order, bucket = rows[0]["order"], rows[0]["bucket"]
    lists = [_unpack_sorted(r["p1"]) for r in rows]
    sizes = [len(x) for x in lists]
    keys, counts = np.concatenate(lists), np.concatenate([_unpack_counts(r["p2"]) for r in rows])
    del lists
    by_key = np.argsort(keys, kind="stable")
    keys = keys[by_key]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    totals = np.add.reduceat(counts[by_key], np.flatnonzero(first))
    answer = np.empty(len(keys), np.int64)
    # Twice the total, and one more for the first block that has the n-gram: its owner.
    answer[by_key] = 2 * totals[np.cumsum(first) - 1] + first
    ends = np.cumsum(sizes)
    out = [("reply", order, bucket, r["block"], _pack_counts(answer[e - n : e])) for r, n, e in zip(rows, sizes, ends, strict=True)]
    keys, totals = keys[first][totals > 0], totals[totals > 0]
    often = np.bincount(np.minimum(totals, LARGEST_RARE + 2), minlength=LARGEST_RARE + 3)[1 : LARGEST_RARE + 2]
    out.append(("ngrams", order, bucket, None, _pack_sorted(keys), _pack_counts(totals)))
    big = np.maximum(totals - LARGEST_RARE - 1, 0)
    out.append(("totals", order, bucket, None, np.array([*often, len(keys), totals.sum(), big.sum()], np.int64).tobytes()))
    return _rows(out)


def _statistics(totals: DataFrame, order: int) -> Statistics:
    """From the ``totals`` rows: a few numbers for each bucket, added up by Spark."""
    width = LARGEST_RARE + 4

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(1)]
            columns = [pa.array([int(v[i]) for v in values], pa.int64()) for i in range(width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["order", *(f"n{i}" for i in range(width))])

    numbers = totals.select("order", "p1").mapInArrow(unpacked, "order int, " + ", ".join(f"n{i} long" for i in range(width)))
    sums = {r[0]: r[1:] for r in numbers.groupBy("order").agg(*(F.sum(f"n{i}") for i in range(width))).collect()}
    zero = (0,) * width
    loss = [discounts(list(sums.get(k, zero)[: LARGEST_RARE + 1])) for k in range(order)]
    *often, vocabulary, tokens, _ = sums.get(0, zero)
    lost = float(np.dot(loss[0][1 : LARGEST_RARE + 2], often)) + loss[0][-1] * (vocabulary - sum(often))
    return Statistics(tokens, vocabulary, loss, lost / tokens if tokens else 1.0)


def _answers(replies: pa.Table, order: int) -> list[np.ndarray]:
    """A block's replies, joined by order and bucket."""
    rows = sorted(replies.select(["order", "bucket", "p1"]).to_pylist(), key=lambda r: (r["order"], r["bucket"]))
    return [np.concatenate([_unpack_counts(r["p1"]) for r in rows if r["order"] == k] or [np.zeros(0, np.int64)]) for k in range(order)]


_SCORED = pa.schema([*_LISTS, *(pa.field(n, pa.list_(t)) for n, t in (("ids", pa.string()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("part", pa.float64())))])
_SCORED_SQL = _LISTS_SQL + ", ids array<string>, held array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>, part array<double>"


def _evaluate(order: int, buckets: int, stats: Statistics):
    def evaluate(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        block, _ = _opened(row, order)
        answers = _answers(replies, order)
        n_docs, doc = len(block.lengths), block.doc
        total = answers[0] >> 1
        with np.errstate(divide="ignore"):
            single = np.where(total > 0, _lowered(total, stats.loss[0]) / max(1, stats.tokens), stats.unknown)
            plain = np.log10((total + 0.5) / (stats.tokens + 0.5 * (stats.vocabulary + 1)))
        stream = block.number[0]
        probability = single[stream]  # after the history one shorter, where seen
        logs = np.log10(probability)
        seen_before = total[stream]  # counts of the n-gram that ends at each token
        out, needs, offset = [], [], 0
        for k in range(1, order):
            at, number = block.at[k], block.number[k]
            total = answers[k] >> 1
            history = seen_before[at - 1]
            counts = total[number]
            seen = counts > 0
            after = np.zeros(len(stream))
            after[at[seen]] = _lowered(counts[seen], stats.loss[k]) / history[seen]
            logs[at[seen]] = np.log10(after[at[seen]])
            own = (answers[k] & 1).astype(bool) & (total > 0)
            where = block.first[k][own]
            names, first, group = np.unique(block.keys[k - 1][where - 1], return_index=True, return_inverse=True)
            used = np.bincount(group, weights=_lowered(total[own], stats.loss[k]), minlength=len(names))
            shorter = np.bincount(group, weights=probability[where], minlength=len(names))
            size = seen_before[where - 1][first]
            out += [("sums", k, b, row["block"], _pack_sorted(names[s]), _pack(used[s]), _pack(shorter[s]), _pack_counts(size[s])) for b, s in _slices(names, buckets)]
            back = ~seen & (history > 0)
            names, group = np.unique(block.keys[k - 1][at[back] - 1], return_inverse=True)
            out += [("ask", k, b, row["block"], _pack_sorted(names[s])) for b, s in _slices(names, buckets)]
            pairs, times = np.unique((group + offset) * n_docs + doc[at[back]], return_counts=True)
            needs.append((pairs, times))
            offset += len(names)
            probability = after
            seen_before = np.zeros(len(stream), np.int64)
            seen_before[at] = counts
        pairs, times = (np.concatenate([n[i] for n in needs] or [np.zeros(0, np.int64)]) for i in (0, 1))
        found = _rows(out)
        known = np.bincount(doc, weights=(answers[0] >> 1)[stream] > 0, minlength=n_docs).astype(np.int64)
        sums = [np.bincount(doc, weights=x, minlength=n_docs) for x in (plain[stream], logs)]
        docs = {"kind": "docs", "order": 0, "bucket": 0, "block": row["block"], "p1": _pack_sorted(pairs.astype(np.uint64)), "p2": _pack_counts(times)}
        docs |= {"ids": row["ids"], "held": row["held"], "n_tokens": block.lengths.tolist(), "n_known": known.tolist(), "base": sums[0].tolist(), "part": sums[1].tolist()}
        empty = [pa.nulls(found.num_rows, f.type) for f in list(_SCORED)[len(_LISTS) :]]
        return pa.concat_tables([pa.table([*found.columns, *empty], schema=_SCORED), pa.Table.from_pylist([docs], schema=_SCORED)])

    return evaluate


def _weigh(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["block"])
    order, bucket = rows[0]["order"], rows[0]["bucket"]
    sums = [r for r in rows if r["kind"] == "sums"]
    names = np.concatenate([_unpack_sorted(r["p1"]) for r in sums] or [np.zeros(0, np.uint64)])
    keys, first, where = np.unique(names, return_index=True, return_inverse=True)
    if len(keys):
        used, shorter = (np.bincount(where, weights=np.concatenate([_unpack(r[p], np.float64) for r in sums])) for p in ("p2", "p3"))
        size = np.concatenate([_unpack_counts(r["p4"]) for r in sums])[first]
        left = np.maximum(1 - used / size, 1e-12)
        weights = np.log10(left / np.maximum(1 - shorter, 1e-12))
    else:
        weights = np.zeros(0)
    out = [("weights", order, bucket, None, _pack_sorted(keys), _pack(weights))]
    for r in rows:
        if r["kind"] == "ask":
            wanted = _unpack_sorted(r["p1"])
            # Whatever was seen as a history was followed by something, so its sums are here.
            out.append(("answer", order, bucket, r["block"], _pack(weights[np.searchsorted(keys, wanted)])))
    return _rows(out)


_FINAL_SQL = "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"
_FINAL = pa.schema({"doc_id": pa.string(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()})


def _finish(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    row = blocks.to_pylist()[0]
    replies = sorted(answers.select(["order", "bucket", "p1"]).to_pylist(), key=lambda r: (r["order"], r["bucket"]))
    weights = np.concatenate([_unpack(r["p1"], np.float64) for r in replies] or [np.zeros(0)])
    pairs, times = _unpack_sorted(row["p1"]).astype(np.int64), _unpack_counts(row["p2"])
    n = len(row["ids"])
    backed = np.bincount(pairs % n, weights=weights[pairs // n] * times, minlength=n)
    columns = (row["ids"], row["held"], row["n_tokens"], row["n_known"], row["base"], np.array(row["part"]) + backed)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _FINAL, strict=True)], schema=_FINAL)


@dataclass
class KatzModel:
    """Scores of the documents, and the tables behind them, partitioned by order.

    ``ngrams`` and ``weights`` have a row per order (0: single words) and bucket; ``counts_of`` and
    ``weights_of`` unfold them.
    """

    scores: DataFrame
    ngrams: DataFrame
    weights: DataFrame
    statistics: Statistics

    def counts_of(self) -> DataFrame:
        """order, key, count of every n-gram of the training documents."""
        return _unfolded(self.ngrams, _unpack_counts, "count long")

    def weights_of(self) -> DataFrame:
        """order, key, log10 weight of every history; the order is that of the n-grams backed off from."""
        return _unfolded(self.weights, lambda raw: _unpack(raw, np.float64), "weight double")


def _unfolded(lists: DataFrame, unpack, column: str) -> DataFrame:
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order, keys, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names = _unpack_sorted(keys).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([order] * len(names), pa.int32()), pa.array(names), pa.array(unpack(values))], names=["order", "key", column.split()[0]])

    return lists.select("order", "p1", "p2").mapInArrow(unfold, f"order int, key long, {column}")


def fit_and_score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> KatzModel:
    """Fit on the rows outside ``held_out`` and score all rows of ``docs``.

    ``scores`` has doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.  Tokens are
    words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end; a null or empty text is its end
    alone.  The first tokens of a text have the histories there are.  ``score`` is the log10 of
    the text's probability, ``base_score`` that under single words with half a count added.
    Repeated rows count each; a null ``held_out`` counts as false; without training rows all
    tokens are unknown and scores are zero.  Other columns are not looked at.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(doc_id).cast("string").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text"))
    folder = write_scratch(chosen.mapInArrow(_tokenise, _BLOCKS_SQL))
    blocks = spark.read.schema(_BLOCKS_SQL).parquet(folder)
    # A bucket's share of all lists does not grow with the corpus.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks.count() // BLOCKS_A_BUCKET)
    asked = blocks.mapInArrow(_ask(order, buckets), _LISTS_SQL)
    tables = written(asked.groupBy("bucket", "order").applyInArrow(_tally, _LISTS_SQL), "kind", "order")
    stats = _statistics(tables.where("kind = 'totals'"), order)
    replies = tables.where("kind = 'reply'").select("block", "order", "bucket", "p1")
    scored = written(blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_evaluate(order, buckets, stats), _SCORED_SQL), "kind")
    discard(spark, folder)  # all that is needed of the blocks is in what was written after them
    sums = scored.where("kind IN ('sums', 'ask')").select("kind", "order", "bucket", "block", "p1", "p2", "p3", "p4")
    weights = written(sums.groupBy("bucket", "order").applyInArrow(_weigh, _LISTS_SQL), "kind", "order")
    answers = weights.where("kind = 'answer'").select("block", "order", "bucket", "p1")
    whole = scored.where("kind = 'docs'").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_finish, _FINAL_SQL)
    scores = whole.select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType), "held_out", "n_tokens", "n_known", F.lit(stats.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
    return KatzModel(scores, tables.where("kind = 'ngrams'"), weights.where("kind = 'weights'"), stats)
