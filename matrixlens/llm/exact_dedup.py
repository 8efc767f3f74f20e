"""Exact deduplication: counting quotient filters find repeats, bytes confirm them.

Texts are equal when they agree after every blank of ``[\\x20\\x09-\\x0D]`` is deleted.

1. Each row is marked with a 64-bit hash of its normalised text (the fingerprint), its
   SHA-256 and its length, and the marks are written once.
2. Each task builds a counting quotient filter of its fingerprints: the high bits name a
   segment and a quotient (a run of slots), the rest is the remainder; remainders are sorted
   within their run and carry a count.  A group with a third of all rows is one counter.
3. Filters of a segment meet and merge without loss, remainder by remainder.  Nothing but
   fingerprints with a merged count above one goes on.
4. Only texts with such a fingerprint are read again and grouped by their bytes, counted per
   task before they move; a fingerprint shared by different texts is told apart here.

A segment's filter is bounded: the number of segments grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from matrixlens.llm.tables import fresh, written

#: Fingerprints a segment's merged filter is meant to hold: some 16 MB.
SEGMENT_FINGERPRINTS = 1 << 20
_BITS = 64


@dataclass
class CountingQuotientFilter:
    """Sorted remainders with counts, in runs by quotient; exact for the fingerprints put in.

    Of a fingerprint the leading ``segment_bits`` are left out (all entries share them), the
    next ``quotient_bits`` are the quotient.
    """

    segment_bits: int
    quotient_bits: int
    run_lengths: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, segment_bits: int) -> CountingQuotientFilter:
        """From distinct sorted fingerprints (uint64) of one segment."""
        quotient_bits = max(1, int(len(fingerprints)).bit_length() - 1)
        rest = np.uint64(_BITS - segment_bits - quotient_bits)
        quotients = (fingerprints >> rest) & np.uint64((1 << quotient_bits) - 1)
        remainders = fingerprints & np.uint64((1 << int(rest)) - 1)
        runs = np.bincount(quotients.astype(np.int64), minlength=1 << quotient_bits)
        return cls(segment_bits, quotient_bits, runs.astype(np.uint32), remainders, counts.astype(np.uint64))

    def fingerprints(self, segment: int) -> np.ndarray:
        rest = np.uint64(_BITS - self.segment_bits - self.quotient_bits)
        quotients = np.repeat(np.arange(len(self.run_lengths), dtype=np.uint64), self.run_lengths)
        lead = np.uint64(segment << (_BITS - self.segment_bits)) if self.segment_bits else np.uint64(0)
        return lead | (quotients << rest) | self.remainders

    def to_bytes(self) -> bytes:
        head = np.array([self.segment_bits, self.quotient_bits, len(self.remainders)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.run_lengths, self.remainders, self.counts))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        segment_bits, quotient_bits, n = (int(x) for x in np.frombuffer(raw, np.int64, 3))
        runs = np.frombuffer(raw, np.uint32, 1 << quotient_bits, 24)
        at = 24 + runs.nbytes
        return cls(segment_bits, quotient_bits, runs, np.frombuffer(raw, np.uint64, n, at), np.frombuffer(raw, np.uint64, n, at + 8 * n))


def merge_sorted(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Merge two sorted lists of (distinct fingerprints, counts); counts of equal entries add up."""
    keys = np.concatenate([first[0], second[0]])
    counts = np.concatenate([first[1], second[1]])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _build(segment_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for batch in batches]
        if not parts:
            return
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        segments = (keys >> np.uint64(_BITS - segment_bits)).astype(np.int64) if segment_bits else np.zeros(len(keys), np.int64)
        names, starts = np.unique(segments, return_index=True)
        ends = [*starts[1:], len(keys)]
        filters = [CountingQuotientFilter.of(keys[a:b], counts[a:b], segment_bits).to_bytes() for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_pydict({"segment": pa.array(names, pa.int64()), "filter": pa.array(filters, pa.binary())})

    return build


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    segment = int(group["segment"].iloc[0])
    lists = []
    for raw in group["filter"]:
        one = CountingQuotientFilter.from_bytes(raw)
        lists.append((one.fingerprints(segment), one.counts))
    while len(lists) > 1:  # in pairs, so that each entry is moved a few times only
        lists = [merge_sorted(*lists[i : i + 2]) if i + 1 < len(lists) else lists[i] for i in range(0, len(lists), 2)]
    keys, counts = lists[0]
    return pd.DataFrame({"fp": keys[counts > 1].view(np.int64)})


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).alias("n"), normalised(F.col(text)).alias("_plain"))
    return plain.select("doc_id", "n", F.xxhash64("_plain").alias("fp"), F.sha2(F.col("_plain").cast("binary"), 256).alias("text_sha256"))


def repeated_fingerprints(marks: DataFrame, n_rows: int) -> DataFrame:
    """Distinct values of ``fp`` that more than one row has, by merged quotient filters."""
    least = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = max(least, -(-n_rows // SEGMENT_FINGERPRINTS))
    filters = marks.select("fp").mapInArrow(_build((segments - 1).bit_length()), "segment long, filter binary")
    return filters.groupBy("segment").applyInPandas(_merge, "fp long")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text stays, then the
    smallest id; a null id comes after all others.  A null text counts as empty, so null, empty
    and blank texts are one group.  Rows that agree in id as well count each; ``kept`` is true
    for all rows with the id that stays and the text of most code points.  Other columns are
    not looked at.  ``text_sha256`` is of the normalised text.
    """
    marks = written(_marked(docs, doc_id, text))
    repeats = written(repeated_fingerprints(marks, marks.count()))
    texts = docs.select(normalised(F.col(text)).alias("_plain")).withColumn("fp", F.xxhash64("_plain"))
    classes = texts.join(repeats, "fp", "left_semi").groupBy("fp", "_plain").agg(F.count(F.lit(1)).alias("group_size"))
    # One row per different text from here on; two of them never share a SHA-256, or it is said.
    classes = classes.groupBy("fp", F.sha2(F.col("_plain").cast("binary"), 256).alias("text_sha256")).agg(
        F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("_texts")
    )
    size = F.when(F.col("_texts") > 1, F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.col("group_size"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id")))
    keepers = marks.join(repeats, "fp", "left_semi").groupBy("fp", "text_sha256").agg(best.alias("_best"))
    groups = classes.join(keepers, ["fp", "text_sha256"]).select(
        "fp", "text_sha256", size.alias("group_size"), F.col("_best.id").alias("keep_id"), (-F.col("_best.less")).alias("_n"), F.lit(True).alias("_grouped")
    )
    groups = written(groups)  # both sides of the join below are dealt anew then, so a hot group can be split
    joined = marks.join(groups, ["fp", "text_sha256"], "left")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("_n"))
    return joined.select(
        "doc_id",
        F.when(F.col("_grouped"), F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.when(F.col("_grouped"), stays).otherwise(F.lit(True)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    The decisions are those of ``exact_groups``; of rows that agree in id, text and length any
    one stays.
    """
    id_, sha, place = (fresh(docs, name) for name in ("_id", "_sha", "_place"))
    decided = written(exact_groups(docs, doc_id, text).select(F.col("doc_id").alias(id_), "kept", F.col("text_sha256").alias(sha)))
    ids = decided.groupBy(id_).agg(F.bool_or("kept").alias("some"), F.count(F.lit(1)).alias("n"))
    same_id = F.col(doc_id).eqNullSafe(F.col(id_))
    single = docs.join(ids.where("n > 1 OR NOT some").select(id_), same_id, "left_anti")
    # Ids that occur more than once: told apart by text, and one row of each kept text stays.
    repeated = ids.where("some AND n > 1").select(F.col(id_).alias("repeated"))
    unclear = decided.where("kept").join(repeated, F.col(id_).eqNullSafe(F.col("repeated")), "left_semi").select(id_, F.col(sha).alias(f"{sha}2")).distinct()
    if unclear.isEmpty():
        return single
    marked = docs.withColumn(sha, F.sha2(normalised(F.col(text)).cast("binary"), 256))
    several = marked.join(unclear, same_id & (F.col(sha) == F.col(f"{sha}2")), "left_semi")
    first = Window.partitionBy(doc_id, sha).orderBy(F.length(text).desc_nulls_last())
    several = several.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place, sha)
    return single.unionByName(several)
