"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

1. Documents are tokenised where they lie; one row per piece goes on, with a number of its own.
   Only documents longer than a sequence are cut, and whole sequences are done at once.
2. The other pieces are dealt by hash to blocks of some thousand.  Of each block several islands
   evolve populations of packings, founded by best-fit in slightly different orders.  A child
   takes well-filled bins of one parent whole; bins of the other parent that share documents with
   them are dissolved, and the displaced documents are best-fitted again, largest first.
3. After an epoch each island's elite migrates to the next one.  Epochs are jobs over tables
   with one row per island, so a lost executor costs an epoch of its islands.  A block is finished
   when its packing has as few bins as its bound allows, or when an epoch saved no island a bin.
4. The emptiest bins of all blocks are opened and their pieces packed again on the next level, in
   fewer blocks, until one block is left: the waste of blocks does not add up.
"""

from __future__ import annotations

import functools
import itertools
import random
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from matrixlens.llm.tables import written

CAPACITY = 2048
#: The id that ends every document.
END_ID = 0
#: Pieces in a block, about; islands of a block, packings of an island, epochs, and children in each.
BLOCK, ISLANDS, POPULATION, EPOCHS, CHILDREN = 8192, 3, 4, 3, 24
#: Most of a parent's bins that a child takes, and of the bins that a mutation opens, as shares.
TAKEN, OPENED = 0.3, 0.1
#: How far the order of displaced pieces may stray from largest first: not at all, a little, much.
SPREADS = (0.0, 0.1, 8.0)
#: A block hands on its emptiest bins until it wastes less than one sequence in this many, but no more than one piece in ``HANDED``.
WASTE, HANDED = 64, 16
#: Different chunks a worker remembers, chunks looked up at a time, and characters of a text that is cut as a whole.
KNOWN, WINDOW, WHOLE = 700_000, 1 << 18, 1 << 20
#: New chunks that the tokenizer is given as one text, parted by a special token.
TOGETHER = 64
#: Fixed values of the byte-level vocabulary: how it cuts a text before it merges bytes.
CHUNKS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The first character that the Latin form of these does not know, and its white space.
_LATIN, _BLANK = 0x250, " \t\n\x0b\x0c\r\x85\xa0"


# -- tokens --------------------------------------------------------------------------------


def _latin_chunks() -> re.Pattern:
    """``CHUNKS`` for texts of characters below ``_LATIN``, with classes spelt out; the standard library is much faster there."""

    def those(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(_LATIN) if unicodedata.category(chr(c))[0] == kind)

    letters, numbers, blanks = those("L"), those("N"), re.escape(_BLANK)
    spelt = CHUNKS.replace(r"[^\s\p{L}\p{N}]", f"[^{blanks}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return re.compile(spelt.replace(r"\s", f"[{blanks}]").replace(r"\S", f"[^{blanks}]"))


def _divider(special: dict[int, tokenizers.AddedToken]) -> tuple[int, str] | None:
    """A special token that takes nothing of the texts beside it and runs together with no other one; none if there is none."""

    def apart(one: str, other: str) -> bool:
        """Whether neither holds the other or begins as the other ends."""
        ends = range(1, min(len(one), len(other)))
        return (one == other or (one not in other and other not in one)) and not any(one[-k:] == other[:k] or one[:k] == other[-k:] for k in ends)

    for number, token in special.items():
        plain = not (token.lstrip or token.rstrip or token.single_word or token.normalized)
        if plain and all(apart(token.content, t.content) for t in special.values()):
            return number, token.content
    return None


class Encoder:
    """Ids of texts as little-endian 32-bit numbers; each different chunk is encoded once while it is remembered."""

    def __init__(self, file: str) -> None:
        self.model = tokenizers.Tokenizer.from_file(file)
        added = self.model.get_added_tokens_decoder()
        self.divider = _divider(added)
        special = [t.content for t in added.values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.any, self.latin, self.other = regex.compile(CHUNKS), _latin_chunks(), re.compile(f"[^\0-{chr(_LATIN - 1)}]")
        self.known: dict[str, bytes] = {}

    def _encoded(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, none of which holds a special token."""
        if self.divider and len(chunks) > 1:
            # Special tokens are cut out before anything else, so chunks between them are encoded each by itself.
            number, text = self.divider
            (one,) = self.model.encode_batch_fast([text.join(chunks)], add_special_tokens=False)
            ids = array("I", one.ids)
            ends = [4 * i for i, x in enumerate(ids) if x == number]
            if len(ends) == len(chunks) - 1:
                every = ids.tobytes()
                return [every[low:high] for low, high in zip([0, *(end + 4 for end in ends)], [*ends, len(every)], strict=True)]
        return [array("I", one.ids).tobytes() for one in self.model.encode_batch_fast(chunks, add_special_tokens=False)]

    def _joined(self, runs: list[list[str]]) -> list[bytes]:
        """Ids of lists of chunks."""
        if len(self.known) > KNOWN:
            # Go on with the chunks at hand: the frequent ones are among them.
            self.known = {c: self.known[c] for c in {c for run in runs for c in run} if c in self.known}
        found = [list(map(self.known.get, run)) for run in runs]
        lacking = [(run, ids, [k for k, x in enumerate(ids) if x is None]) for run, ids in zip(runs, found, strict=True) if None in ids]
        new = list({run[k] for run, _, places in lacking for k in places})
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            self.known.update(zip(some, self._encoded(some), strict=True))
        for run, ids, places in lacking:
            for k in places:
                ids[k] = self.known[run[k]]
        return [b"".join(ids) for ids in found]

    def _runs(self, text: str) -> Iterator[list[str]]:
        """Chunks of a text; of a very long one some at a time."""
        pattern = self.any if self.other.search(text) else self.latin
        if len(text) <= WHOLE:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while run := list(itertools.islice(found, WINDOW)):
            yield run

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def look_up() -> None:
            nonlocal size
            for (i, _), ids in zip(held, self._joined([run for _, run in held]), strict=True):
                out[i].append(ids)
            held.clear()
            size = 0

        for i, text in enumerate(texts):
            # A special token's string is that token, wherever it stands.
            for k, part in enumerate(self.special.split(text) if self.special and self.special.search(text) else [text]):
                if k % 2:
                    look_up()
                    out[i].append(array("I", [self.model.token_to_id(part)]).tobytes())
                    continue
                for run in self._runs(part):
                    held.append((i, run))
                    size += len(run)
                    if size >= WINDOW:
                        look_up()
        look_up()
        return [b"".join(parts) for parts in out]


@functools.cache
def encoder(file: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(file)


def cut_points(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole sequences, but for the first one."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def token_pieces(docs: DataFrame, file: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, piece, start, length, ids_crc32 of every piece; ``row`` numbers them by task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = encoder(file), TaskContext.get().partitionId() << 40
        for batch in batches:
            found, source = [], []
            for i, ids in enumerate(encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += END_ID.to_bytes(4, "little")
                for piece, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                    found.append((row, piece, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
                    source.append(i)
                    row += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            row_, *rest = (pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds))
            yield pa.RecordBatch.from_arrays([row_, batch.column(0).take(pa.array(source, pa.int64())), *rest], names=["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[doc_id].dataType.simpleString()
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(work, f"row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


# -- packings ------------------------------------------------------------------------------
# A packing is an array with the number of its bin for each piece; numbers have no gaps.


def best_fit(lengths: list[int], order: list[int], of: list[int], room: list[int], capacity: int) -> None:
    """Put the pieces of ``order`` one by one into the bin that has least room left for them."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: a bin with room r
    for b, r in enumerate(room):
        by_room[r].append(b)
        some |= 1 << r
    for i in order:
        size = lengths[i]
        fits = some >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                some ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        of[i] = b
        r -= size
        room[b] = r
        by_room[r].append(b)
        some |= 1 << r


def _largest_first(lengths: np.ndarray, items: np.ndarray, rng: random.Random, spread: float) -> list[int]:
    weights = lengths[items] * (1 + spread * np.array([rng.random() for _ in range(len(items))])) if spread else lengths[items]
    return items[np.argsort(-weights, kind="stable")].tolist()


def founded(lengths: np.ndarray, capacity: int, rng: random.Random, spread: float) -> np.ndarray:
    of = [0] * len(lengths)
    best_fit(lengths.tolist(), _largest_first(lengths, np.arange(len(lengths)), rng, spread), of, [], capacity)
    return np.array(of, np.int32)


def _refitted(lengths: np.ndarray, of: np.ndarray, displaced: np.ndarray, capacity: int, rng: random.Random) -> np.ndarray:
    """Number the bins of the other pieces anew and best-fit the ``displaced`` ones."""
    kept = ~displaced
    _, numbers = np.unique(of[kept], return_inverse=True)
    now = np.zeros(len(of), np.int32)
    now[kept] = numbers
    room = (capacity - np.bincount(numbers, weights=lengths[kept])).astype(np.int64).tolist() if kept.any() else []
    found = now.tolist()
    best_fit(lengths.tolist(), _largest_first(lengths, np.flatnonzero(displaced), rng, rng.choice(SPREADS)), found, room, capacity)
    return np.array(found, np.int32)


def crossed(lengths: np.ndarray, one: np.ndarray, other: np.ndarray, capacity: int, rng: random.Random) -> np.ndarray:
    """``one`` with some well-filled bins of ``other`` taken whole."""
    fill = np.bincount(other, weights=lengths)
    wanted = max(1, int(TAKEN * rng.random() ** 2 * len(fill)))
    fullest = np.argsort(-fill, kind="stable")[: max(wanted, len(fill) // 2)]
    taken = np.zeros(len(fill), bool)
    taken[rng.sample(fullest.tolist(), min(wanted, len(fullest)))] = True
    injected = taken[other]
    dissolved = np.zeros(one.max() + 1, bool)
    dissolved[one[injected]] = True
    child = np.where(injected, len(dissolved) + other, one)
    return _refitted(lengths, child, dissolved[one] & ~injected, capacity, rng)


def mutated(lengths: np.ndarray, one: np.ndarray, capacity: int, rng: random.Random) -> np.ndarray:
    """``one`` with some of its emptiest bins, and as many others, opened and their pieces fitted again."""
    fill = np.bincount(one, weights=lengths)
    n = max(1, int(OPENED * rng.random() ** 2 * len(fill)))
    opened = np.zeros(len(fill), bool)
    opened[np.argsort(fill, kind="stable")[:n]] = True
    opened[rng.sample(range(len(fill)), min(n + 1, len(fill)))] = True
    return _refitted(lengths, one, opened[one], capacity, rng)


def fitness(lengths: np.ndarray, of: np.ndarray) -> tuple[int, int]:
    """Less is better: bins, then how unevenly they are filled."""
    fill = np.bincount(of, weights=lengths)
    return len(fill), -int((fill * fill).sum())


def bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins."""
    return max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))


def evolved(lengths: np.ndarray, packings: list[np.ndarray], capacity: int, rng: random.Random, children: int) -> list[np.ndarray]:
    """The packings after ``children`` births, best first; a child replaces the worst packing if it is better."""
    ranked = sorted(((fitness(lengths, p), i, p) for i, p in enumerate(packings)), key=lambda x: x[:2])
    least = bound(lengths, capacity)
    for birth in range(children):
        if ranked[0][0][0] <= least:
            break
        one, other = (min(rng.sample(ranked, min(2, len(ranked))), key=lambda x: x[:2])[2] for _ in range(2))
        child = crossed(lengths, one, other, capacity, rng)
        if rng.random() < 0.5:
            child = mutated(lengths, child, capacity, rng)
        found = (fitness(lengths, child), len(packings) + birth, child)
        # Two packings of one fitness are most often one packing.
        if found[0] < ranked[-1][0] and all(found[0] != r[0] for r in ranked):
            ranked = sorted([*ranked[:-1], found], key=lambda x: x[:2])
    return [p for _, _, p in ranked]


# -- the job -------------------------------------------------------------------------------

_ISLAND = "block long, island int, epoch int, bins long, worth long, finished boolean, gained boolean, lengths binary, packings array<binary>"
_ISLAND_NAMES = [c.split()[0] for c in _ISLAND.split(", ")]
_ISLAND_KINDS = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.list_(pa.binary()))


def _island(block: int, island: int, epoch: int, lengths: np.ndarray, packings: list[np.ndarray], capacity: int, gained: bool = True) -> tuple:
    bins, worth = fitness(lengths, packings[0])
    return block, island, epoch, bins, worth, bins <= bound(lengths, capacity), gained, lengths.astype(np.int32).tobytes(), [p.astype(np.int32).tobytes() for p in packings]


def _islands(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_ISLAND_KINDS)], names=_ISLAND_NAMES)


def _found(capacity: int, islands: int, population: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (block, lengths) to the block's islands."""
        for batch in batches:
            for block, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lengths = np.array(sizes, np.int64)
                rows = []
                for island in range(islands):
                    rng = random.Random(f"{block} {island}")
                    # The first packing of the first island is best-fit, largest first.
                    packings = [founded(lengths, capacity, rng, 0.05 * (island * population + i)) for i in range(population)]
                    rows.append(_island(block, island, 0, lengths, sorted(packings, key=lambda p: fitness(lengths, p)), capacity))
                    if rows[-1][5]:
                        break
                yield _islands(rows)

    return found


def _evolve(capacity: int, children: int):
    def evolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Islands with an ``elite`` from elsewhere to islands an epoch later."""
        for batch in batches:
            rows = []
            for block, island, epoch, *_, raw, held, elite in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lengths = np.frombuffer(raw, np.int32).astype(np.int64)
                packings = [np.frombuffer(p, np.int32) for p in (*held[: max(1, len(held) - 1)], elite)]
                rng = random.Random(f"{block} {island} {epoch + 1}")
                before = min(fitness(lengths, p)[0] for p in packings)
                after = evolved(lengths, packings, capacity, rng, children)
                rows.append(_island(block, island, epoch + 1, lengths, after, capacity, fitness(lengths, after[0])[0] < before))
            yield _islands(rows)

    return evolve


def handed_on(lengths: np.ndarray, of: np.ndarray, capacity: int) -> np.ndarray:
    """Which bins a block opens for the next level: the emptiest, until little is wasted in the others."""
    fill = np.bincount(of, weights=lengths)
    pieces = np.bincount(of)
    order = np.argsort(fill, kind="stable")
    waste = (capacity - fill)[order]
    left = waste.sum() - np.concatenate([[0], np.cumsum(waste)[:-1]])
    some = (left >= capacity / WASTE) & (waste > 0) & (np.cumsum(pieces[order]) <= max(len(of) // HANDED, pieces[order[0]]))
    opened = np.zeros(len(fill), bool)
    opened[order[np.cumprod(some).astype(bool)]] = True
    return opened


def _place(capacity: int, level: int, last: bool):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks with their best packing to (row, length, sequence_id, offset, again)."""
        for batch in batches:
            for block, rows, sizes, packing in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lengths, of = np.array(sizes, np.int64), np.frombuffer(packing, np.int32).astype(np.int64)
                opened = np.zeros(of.max() + 1, bool) if last else handed_on(lengths, of, capacity)
                order = np.argsort(of, kind="stable")
                ends = np.cumsum(lengths[order])
                starts = ends - lengths[order]
                first = np.concatenate([[True], of[order][1:] != of[order][:-1]])
                begins = starts[first][np.cumsum(first) - 1]
                columns = [np.array(rows, np.int64)[order], lengths[order], (level << 58) | (block << 24) | of[order], starts - begins]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(opened[of[order]])], names=["row", "length", "sequence_id", "offset", "again"])

    return place


def _packed(items: DataFrame, n: int, level: int, capacity: int, block: int, islands: int, population: int, epochs: int, children: int) -> DataFrame:
    """row, length, sequence_id, offset, again of the ``n`` items (row, length)."""
    n_blocks = -(-n // block)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(n_blocks)))
    lists = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("length", "row")), asc=False).alias("items"))
    blocks = written(lists.select("block", F.col("items.row").alias("rows"), F.col("items.length").alias("lengths")))
    living = written(blocks.select("block", "lengths").mapInArrow(_found(capacity, islands, population), _ISLAND))
    best = None
    for epoch in range(epochs + 1):
        ranked = living.groupBy("block").agg(
            F.min(F.struct("bins", "worth", "island", F.col("packings")[0].alias("packing"))).alias("best"), (F.bool_or("finished") | ~F.bool_or("gained")).alias("finished")
        )
        ranked = written(ranked.select("block", "finished", F.col("best.packing").alias("packing")))
        # Blocks that are finished, or have had their epochs, are told apart by an equi-join on the block.
        done = ranked if epoch == epochs else ranked.where("finished")
        best = done.select("block", "packing") if best is None else best.union(done.select("block", "packing"))
        open_ = ranked.where("NOT finished").select("block")
        if epoch == epochs or open_.isEmpty():
            break
        going = living.join(open_, "block")
        elites = going.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("packings")[0].alias("elite"))
        living = written(going.join(elites, ["block", "island"]).select(*_ISLAND_NAMES, "elite").mapInArrow(_evolve(capacity, children), _ISLAND))
    placed = blocks.join(best, "block").select("block", "rows", "lengths", "packing")
    return written(placed.mapInArrow(_place(capacity, level, n_blocks == 1), "row long, length long, sequence_id long, offset long, again boolean"))


def pack(
    docs: DataFrame, file: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text",
    block: int = BLOCK, islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS, children: int = CHILDREN,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Each text is tokenised whole by the tokenizer in ``file`` and ended by id 0; a null text is
    empty, so its one piece is the end alone.  Documents of more than ``capacity`` tokens are cut
    into pieces of that length, but for the first one, which may be shorter; no other document is
    cut.  Sequences hold up to ``capacity`` tokens without gaps, in any order.  Repeated rows and ids are
    documents like any other; an empty table gives no rows; other columns are not looked at.
    """
    pieces = written(token_pieces(docs, file, capacity, doc_id, text))
    whole = F.col("length") == capacity
    placed = pieces.where(whole).select("row", (F.col("row").bitwiseOR(F.lit(1 << 62))).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items, level = pieces.where(~whole).select("row", "length"), 0
    while n := items.count():
        found = _packed(items, n, level, capacity, block, islands, population, epochs, children)
        placed = placed.union(found.where("NOT again").select("row", "sequence_id", "offset"))
        items, level = found.where("again").select("row", "length"), level + 1
    return pieces.join(placed, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
