"""Source divergence audit: how differently the sources of a language use its terms.

Every (lang, source) group gives each kept term of the language a smoothed share in whole
billionths.  Two groups diverge by the sum, over all kept terms, of the difference of shares;
a term marks a group if its share there is above that in the whole language.

A share depends on nothing but the term's count in the group, and counts repeat.  So the terms
are held as bitsets, one for each (group, count): the AND of two bitsets of two groups holds
the terms in one joint cell of their counts, all with the same difference, and its number of
bits times that difference is their part of the sum.  Counts of zero have no bitset: their cells
are what the others leave over.

1. Tasks count words by group; Spark adds the counts up.
2. The kept terms of a language are dealt to blocks by hash and numbered within them.
3. The bitsets of a block are built and stored; all are of one length.
4. A task takes a block and two tiles of sources, and adds up what it has for each pair.

Sums are of whole numbers, so nothing depends on the order of tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from matrixlens.llm.tables import written
from matrixlens.session import small_side

LEAST_DOCUMENTS, SMOOTHING, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Different (group, term) pairs a task holds before it hands them on.
HELD = 400_000
#: (Source, term) cells in a block, about, and sources in a tile.
CELLS, SOURCES = 1 << 16, 64
_LETTERS = bytes(b if b >= 0x80 or bytes([b]).isalpha() else 0x20 for b in range(256))
#: Bytes that the joint cells of one pair may take at once.
_STEP = 1 << 24


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, in UTF-8, with A-Z lower-cased."""
    return text.encode().lower().translate(_LETTERS).split() if text else []


_COUNTS = pa.schema({"lang": pa.string(), "source": pa.string(), "term": pa.string(), "n": pa.int64(), "docs": pa.int64()})


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text) to counts; a row without a term says that a group occurs."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in groups.items():
            terms = pa.array(list(times), pa.binary()).cast(pa.string())
            lists = [terms, pa.array(list(times.values()), pa.int64()), pa.array([docs[t] for t in times], pa.int64())]
            names = [pa.array([name] * len(times), pa.string()) for name in (lang, source)]
            yield from pa.table([*names, *lists], schema=_COUNTS).to_batches(max_chunksize=1 << 16)
            yield pa.RecordBatch.from_pylist([{"lang": lang, "source": source, "n": 0, "docs": 0}], schema=_COUNTS)
        groups.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            times, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            found = Counter(terms_of(text))
            held -= len(times)
            times.update(found)
            docs.update(found.keys())
            held += len(times)
            if held >= HELD:
                yield from handed()
                held = 0
    yield from handed()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n, docs: how often, and in how many documents, each term occurs in each group.

    A group has one more row, of a null term, that is there even if it has no terms.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))]
    counted = docs.select(*names, F.col(text).alias("text")).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str) -> Column:
    """Smoothed share of a term in whole billionths, exactly, in a group with the columns ``total`` and V; 0 if V is 0."""
    part = f"CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + {SMOOTHING} AS DECIMAL(20, 0)) DIV CAST({total} + {SMOOTHING} * V AS DECIMAL(20, 0))"
    return F.expr(f"CASE WHEN V = 0 THEN 0 ELSE 1 + ({part}) END")


def _bitmaps(group: pa.Table) -> pa.Table:
    """The cells (lang, block, size, source, n, p, slot) of a block to bitsets, one for each source and count."""
    width = 8 * (-(-group["size"][0].as_py() // 64))
    slots = group["slot"].to_numpy()
    keys = group.select(["source", "n", "p"]).to_pandas()
    number = keys.groupby(["source", "n"], sort=False).ngroup().to_numpy()
    first = np.unique(number, return_index=True)[1]
    bits = np.zeros((len(first), width), np.uint8)
    np.bitwise_or.at(bits, (number, slots >> 3), np.left_shift(1, slots & 7).astype(np.uint8))
    kept = group.select(["lang", "block", "size", "source", "n", "p"]).take(pa.array(first))
    return kept.append_column("bits", pa.array([row.tobytes() for row in bits], pa.binary()))


def joint_difference(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray], zeros: tuple[int, int], size: int) -> int:
    """Sum of differences of shares over ``size`` terms of a block.

    Each side is its levels' shares and their bitsets (levels x words, uint64); ``zeros`` are the
    two shares of a term that does not occur.
    """
    (p, a), (q, b) = one, other
    total, seen_a, seen_b = 0, np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    left_b, both = seen_b.copy(), 0
    step = max(1, _STEP // max(1, b.nbytes))
    for at in range(0, len(a), step):
        cells = np.bitwise_count(a[at : at + step, None, :] & b[None, :, :]).sum(axis=2, dtype=np.int64)
        total += int((cells * np.abs(p[at : at + step, None] - q[None, :])).sum())
        # Terms that the other side does not have.
        total += int(((seen_a[at : at + step] - cells.sum(axis=1)) * np.abs(p[at : at + step] - zeros[1])).sum())
        left_b -= cells.sum(axis=0)
        both += int(cells.sum())
    total += int((left_b * np.abs(q - zeros[0])).sum())
    neither = size - int(seen_a.sum()) - int(seen_b.sum()) + both
    return total + neither * abs(zeros[0] - zeros[1])


_PAIRS = pa.schema({"lang": pa.string(), "a": pa.string(), "b": pa.string(), "value": pa.int64()})


def _pairs(group: pa.Table) -> pa.Table:
    """Sums of a block over the pairs of sources of two tiles; a bitset of null gives a source's share of zero."""
    lang, size = group["lang"][0].as_py(), group["size"][0].as_py()
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    words = -(-size // 64)
    levels: dict[str, list[tuple[int, bytes]]] = {}
    zero, tile = {}, {}
    for source, at, p, bits in zip(*(group[c].to_pylist() for c in ("source", "tile", "p", "bits")), strict=True):
        if bits is None:
            zero[source], tile[source] = p, at
        else:
            levels.setdefault(source, []).append((p, bits))
    sides = {}
    for source in zero:
        found = levels.pop(source, [])
        bits = np.frombuffer(b"".join(b for _, b in found), np.uint64).reshape(len(found), words) if found else np.zeros((0, words), np.uint64)
        sides[source] = (np.array([p for p, _ in found], np.int64), bits)
    rows = []
    for a in sorted(zero):
        for b in sorted(zero):
            if {tile[a], tile[b]} == {low, high} and a < b:
                rows.append((lang, a, b, joint_difference(sides[a], sides[b], (zero[a], zero[b]), size)))
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PAIRS)], schema=_PAIRS)


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP, cells: int = CELLS, sources: int = SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank: how far groups are apart, and by which terms.

    Null text, lang and source are empty.  Terms are runs of ASCII letters and of characters
    beyond ASCII, A-Z lower-cased.  A language keeps the terms in at least ``least`` of its
    documents; its groups, and itself, give each a share of
    ``1 + floor(1e9 * (count + 5) / (N + 5 V))``, with N the counts' sum over the V kept terms.

    Part ``pair`` has a row for each other source of the language: the differences of shares
    summed over all kept terms, 0 if there are none.  Part ``term`` has the kept terms that occur
    in the group with a share above the language's, by the difference, down to rank ``top``.
    Ranks go by value, largest first, then by item in the order of UTF-8.  A language of one
    source has no pairs; an empty table gives no rows.  Repeated rows count each; other columns
    are not looked at.
    """
    counts = written(term_counts(docs, lang, source, text))
    occurring = counts.where("term IS NOT NULL")
    known = written(occurring.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("total").alias("lang_tokens"))
    groups = counts.where("term IS NULL").select("lang", "source")
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("S")).join(sizes, "lang", "left").fillna(0, ["V", "lang_tokens"])
    tiles = F.ceil(F.col("S") / sources)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("V") * F.least("S", F.lit(2 * sources)) / cells))
    langs = written(langs.select("lang", "V", "lang_tokens", tiles.alias("tiles"), blocks.alias("blocks")))
    n_langs = langs.count()

    dealt = known.join(small_side(langs, n_langs), "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks"))
    within = Window.partitionBy("lang", "block")
    slots = dealt.withColumn("slot", F.row_number().over(within.orderBy("term")) - 1).withColumn("size", F.count(F.lit(1)).over(within))
    slots = written(slots.select("lang", "term", "total", "block", "slot", "size"))
    cells_ = written(occurring.join(small_side(slots, slots.count()), ["lang", "term"]).select("lang", "source", "term", "n", "total", "block", "slot", "size"))
    sums = cells_.groupBy("lang", "source").agg(F.sum("n").alias("tokens"))
    groups = groups.join(sums, ["lang", "source"], "left").fillna(0, ["tokens"]).join(small_side(langs, n_langs), "lang")
    groups = written(groups.withColumn("tile", F.pmod(F.xxhash64("source"), "tiles")).withColumn("p0", share("0", "tokens")))
    shared = cells_.join(small_side(groups, groups.count()), ["lang", "source"]).withColumn("p", share("n", "tokens"))

    # Part pair: bitsets by block, source and count; then sums by block and tiles of sources.
    held = shared.select("lang", "block", "size", "source", "n", "p", "slot")
    bitmaps = written(held.groupBy("lang", "block").applyInArrow(_bitmaps, "lang string, block long, size long, source string, n long, p long, bits binary"))
    of_block = slots.groupBy("lang", "block").agg(F.first("size").alias("size"))
    every = langs.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    every = every.join(of_block, ["lang", "block"], "left").fillna(0, ["size"])
    zeros = every.join(small_side(groups, groups.count()), "lang").select("lang", "block", "size", "source", F.col("p0").alias("p"), F.lit(None).cast("binary").alias("bits"))
    levels = zeros.unionByName(bitmaps.drop("n")).join(small_side(groups.select("lang", "source", "tile", "tiles"), groups.count()), ["lang", "source"])
    levels = levels.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    levels = levels.withColumns({"low": F.least("tile", "with"), "high": F.greatest("tile", "with")}).drop("with", "tiles")
    summed = levels.groupBy("lang", "block", "low", "high").applyInArrow(_pairs, "lang string, a string, b string, value long")
    summed = written(summed.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = summed.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(summed.select("lang", "b", "a", "value"))

    # Part term.
    above = shared.withColumn("q", share("total", "lang_tokens")).where("p > q")
    above = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    parts = [df.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part)) for df, part in ((both, "pair"), (above, "term"))]
    return parts[0].unionByName(parts[1].where(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
