"""Near duplicates: SimHash fingerprints within three bits, found by Golay-code fuzzy hashing.

A fingerprint is cut into three segments (22, 21 and 21 bits).  If two fingerprints differ in at
most three bits, then by the pigeonhole principle

* a segment is equal and one of the two others has at most one error, or
* each of the three has exactly one error.

Segments with at most one error share the index of a nearby Golay codeword (``golay.keys``), so
a fingerprint gets the keys (equal segment, codeword of another) and (three codewords, which
segments are even): some 50 of 34 bits and more, by which distinct fingerprints meet.  What
meets is verified by its Hamming distance: nothing within three bits is missed, nothing
beyond is linked, and copies have been reduced to one fingerprint before.

``near_duplicate_groups`` names the component of every row, ``one_per_group`` keeps one row of
each component.  Both link fingerprints of three-word shingles and look at nothing else.

Keys are dealt by hash and sorted; a task goes through them key by key and hands on links
that span what it found, never all pairs: of a run of many fingerprints, those already reached
are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from matrixlens.llm import golay
from matrixlens.llm.components import connected_components
from matrixlens.llm.simhash import fingerprints, text_key
from matrixlens.llm.tables import fresh, hand_on, scratch, written

RADIUS = 3
#: Bits of the segments, from the low end.
SEGMENTS = (22, 21, 21)
#: Runs up to this length are compared lag by lag, longer ones by spreading from link to link.
SHORT_RUN = 8
_KEY_BITS = 40


def segment_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of the fingerprints (uint64), as two int64 arrays."""
    rest, parts = fps, []
    for bits in SEGMENTS:
        parts.append((rest & np.uint64((1 << bits) - 1)).astype(np.int64))
        rest = rest >> np.uint64(bits)
    near = [golay.keys(p) for p in parts]
    rows, found = [], []

    def put(key: np.ndarray, valid: np.ndarray, tag: int) -> None:
        where = np.nonzero(valid)
        rows.append(where[0])
        found.append(key[where] | (tag << _KEY_BITS))

    tag = 0
    for equal in range(3):
        for other in range(3):
            if other != equal:
                put((parts[equal][:, None] << golay.INDEX_BITS) | near[other], near[other] >= 0, tag)
                tag += 1
    # One error in each segment turns all three parities: the class is that of the smaller pattern.
    parity = sum((np.bitwise_count(p).astype(np.int64) & 1) << i for i, p in enumerate(parts))
    kind = np.minimum(parity, 7 - parity)[:, None, None, None]
    a, b, c = near[0][:, :, None, None], near[1][:, None, :, None], near[2][:, None, None, :]
    put((kind << 36) | (a << 24) | (b << 12) | c, (a >= 0) & (b >= 0) & (c >= 0), tag)
    return np.concatenate(rows), np.concatenate(found)


def _spread(run: np.ndarray) -> list[np.ndarray]:
    """Links that connect what is connected within ``run``."""
    links, rest = [], run
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = front.pop()
            close = np.bitwise_count(rest ^ one) <= RADIUS
            reached, rest = rest[close], rest[~close]
            links.append(np.stack([np.full(len(reached), one), reached], axis=1))
            front += list(reached)
    return links


def link_runs(keys: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Links (n x 2) among fingerprints (uint64) with equal keys, sorted by key."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.append(starts, len(keys)))
    out = [np.zeros((0, 2), fps.dtype)]
    short = np.repeat((lengths > 1) & (lengths <= SHORT_RUN), lengths)
    for lag in range(1, SHORT_RUN):
        at = np.flatnonzero(short[:-lag] & (keys[:-lag] == keys[lag:])) if len(keys) > lag else np.zeros(0, np.int64)
        if not len(at):
            break
        at = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= RADIUS]
        out.append(np.stack([fps[at], fps[at + lag]], axis=1))
    for i in np.flatnonzero(lengths > SHORT_RUN):
        out += _spread(fps[starts[i] : starts[i] + lengths[i]])
    return np.unique(np.concatenate(out), axis=0)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints to rows (key, fp)."""
    for batch in batches:
        every = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 4096):
            fps = every[at : at + 4096]
            rows, keys = segment_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], names=["key", "fp"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by key; the last run of a batch is kept until the next key is seen."""
    held = [np.zeros(0, np.int64)] * 2

    def linked(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        found = link_runs(keys, fps.view(np.uint64)).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["a", "b"])

    for batch in batches:
        held = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
        last = np.searchsorted(held[0], held[0][-1]) if len(held[0]) else 0
        if last:
            yield linked(*(h[:last] for h in held))
            held = [h[last:] for h in held]
    if len(held[0]):
        yield linked(*held)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fp`` within three bits."""
    keyed = distinct.select("fp").mapInArrow(_deal, "key long, fp long")
    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_links, "a long, b long").where("a != b").distinct()


def near_duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased A-Z and cut into words by ``[\\x20\\x09-\\x0D]``; a fingerprint is taken
    over their ``size``-word shingles, of the whole sequence if there are fewer words.  Null,
    empty and blank texts have fingerprint zero and are linked like any other.
    ``component_id`` is the smallest id reachable over links of at most three bits; null ids are
    passed over, and it is null where no id is reachable.  Repeated rows are rows like any
    other.  Other columns are not looked at.
    """
    marked = written(fingerprints(docs, doc_id, text, size))
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("_least")))
    components = connected_components(fingerprint_links(distinct))
    rooted = distinct.join(components, F.col("fp") == F.col("node"), "left").select("fp", "_least", "root")
    least = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("_least").alias("_of_root"))
    component = F.when(F.col("root").isNull(), F.col("_least")).otherwise(F.col("_of_root"))
    named = written(rooted.join(least, "root", "left").select("fp", component.alias("component_id")))
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicate_groups``; all columns are kept.

    The row with the smallest id stays, null ids come after all others; of rows that agree in id
    the one whose text has the smallest SHA-256, a null text first; of rows that agree in
    both any one.  An empty table stays empty.  Texts are told apart by 256 bits.
    """
    id_, key, place = (fresh(docs, name) for name in ("_id", "_key", "_place"))
    marked = written(fingerprints(docs, doc_id, text, size, with_key=True))
    order = F.struct(F.col("doc_id").isNull().alias("lacks"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    with scratch(docs.sparkSession) as folders:
        distinct = written(marked.groupBy("fp").agg(F.min(order).alias("first")))
        components = connected_components(fingerprint_links(distinct))
        rooted = distinct.join(components, F.col("fp") == F.col("node"), "left")
        first = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
        stays = written(first.select(F.col("first.id").alias(id_), F.col("first.key").alias(key)))
        hand_on(folders)
    same = F.col(doc_id).eqNullSafe(F.col(id_)) & (text_key(F.col(text)) == F.col(key))
    # Rows that agree in id and text: a few, told from the others by a count.
    twice = marked.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("id2"), F.col("text_key").alias("key2"))
    if twice.isEmpty():
        return docs.join(stays, same, "left_semi")
    is_twice = F.col(id_).eqNullSafe(F.col("id2")) & (F.col(key) == F.col("key2"))
    single = docs.join(stays.join(twice, is_twice, "left_anti"), same, "left_semi")
    several = docs.join(stays.join(twice, is_twice, "left_semi"), same, "left_semi").withColumn(key, text_key(F.col(text)))
    window = Window.partitionBy(doc_id, key).orderBy(key)
    return single.unionByName(several.withColumn(place, F.row_number().over(window)).where(F.col(place) == 1).drop(place, key))
