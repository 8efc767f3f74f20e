"""Conversation structure repair: the cheapest edits to well-formed turns, by parallel Viterbi.

A repaired conversation's roles are ``(system? (user assistant)+)?``, so four states tell what may
come next.  Costs to go are a vector over the states; each row turns the vector after it into
the vector before it, and the vector before the first row says what the repair costs.

Long conversations are cut into chunks, and all chunks begin at once, from a speculative vector
at their right ends.  Fix-up passes then hand every chunk the vector of the chunk after it.  A
chunk whose vector was another one runs again, but only until it meets a vector that differs from
its earlier one by a constant: what lies before stays as it is.  Vectors are kept less their
smallest entry, so such vectors are equal, and there are few of them.  When no chunk's vector
changes, the stitched costs are those of one long run.

The audit is traced from the left by these costs: at each step the least letter among the
cheapest.  A chunk is traced from each of the four states, which gives its map of states; maps
are composed along the conversation, and each chunk learns the state it begins in.

Rows are put in order once, by range, so a conversation of any length lies in many partitions.
One that lies wholly inside a partition and a chunk is finished on the spot; of the others the
chunks' codes, a byte a row, go through the passes, and their texts move again only to be
hashed, which SHA-256 does in order: one task reads a conversation's repaired text piece by piece.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from matrixlens.llm.tables import BLANKS, written

#: Rows and characters after which a chunk is closed.
CHUNK_ROWS, CHUNK_CHARS = 1024, 1 << 21
#: Chunks whose maps one task composes.
FAN = 1024
#: Costs of the edits, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FINE, CUT, DUPLICATE, BLANK = range(4)
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: What a kept row of each kind of role leads to; kinds beside s, u and a: no initial, any other.
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {q: q for q in STATES}, "-": {}}
_KINDS = list(_AFTER)
#: What an inserted row, or one given another role, leads to.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs to go after the last row, and the inserts they stand for.
END_COSTS = (0, 2 * INSERT, INSERT, 0)
END_EDITS = ("", "II", "I", "")
_LEGAL = {"su", "ua", "au"}
_NEVER = 1 << 20


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with a fault in some rows, chosen by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 sets its role to user.  Nulls are
    one blank, in that key too.
    """
    kind = _damage()
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = turns.withColumns({"role": F.coalesce(F.col("role").cast("string"), F.lit(" ")), "text": F.coalesce("text", F.lit(" "))})
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))).drop("col")


def _damage() -> Column:
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    return F.crc32(F.concat_ws(":", *names).cast("binary")) % 20


# -- costs and edits of one row ------------------------------------------------------------


def code_of(role: str, fault: int) -> int:
    initial = role[:1]
    return 4 * _KINDS.index(initial if initial in _AFTER else "-") + fault


def _options(code: int, after: tuple) -> tuple[list[int], list[int]]:
    """Costs of the best way that deals with the row at once, and of the best way at all, for each state."""
    kind, fault = _AFTER[_KINDS[code >> 2]], code & 3
    more = TRUNCATED if fault == CUT else 0
    stays = fault in (FINE, CUT)
    direct = [
        min(
            DELETE + after[q],
            KEEP + more + after[kind[q]] if stays and q in kind else _NEVER,
            REROLE + more + after[_NEXT[q]] if stays else _NEVER,
        )
        for q in STATES
    ]
    once = [INSERT + direct[_NEXT[q]] for q in STATES]
    return direct, [min(direct[q], once[q], INSERT + once[_NEXT[q]]) for q in STATES]


@functools.cache
def before(code: int, after: tuple) -> tuple:
    """The vector before a row, less its smallest entry."""
    best = _options(code, after)[1]
    return tuple(b - min(best) for b in best)


@functools.cache
def moves(code: int, after: tuple) -> tuple[tuple[str, int, int], ...]:
    """For each state: the least letters among the cheapest edits up to and with the row, the state they lead to, and what they cost."""
    direct, best = _options(code, after)
    kind, fault = _AFTER[_KINDS[code >> 2]], code & 3
    more = TRUNCATED if fault == CUT else 0
    found = []
    for q in STATES:
        letters, cost = "", 0
        while True:
            if DELETE + after[q] == best[q]:
                found.append((letters + "D", q, cost + DELETE))
            elif INSERT + best[_NEXT[q]] == best[q]:
                letters, q, cost = letters + "I", _NEXT[q], cost + INSERT
                continue
            elif q in kind and KEEP + more + after[kind[q]] == best[q]:
                found.append((letters + "K", kind[q], cost + KEEP + more))
            else:
                found.append((letters + "R", _NEXT[q], cost + REROLE + more))
            break
    return tuple(found)


# -- costs and edits of a chunk ------------------------------------------------------------


def backward(codes: bytes, right: tuple) -> tuple[tuple, list[tuple]]:
    """The vector before the first row, and the vector after each row."""
    vectors, now = [right] * len(codes), right
    for i in range(len(codes) - 1, -1, -1):
        vectors[i] = now
        now = before(codes[i], now)
    return now, vectors


def fixed(codes: bytes, right: tuple, left: tuple, vectors: list[tuple]) -> tuple[tuple, int]:
    """Mend ``vectors`` for another vector at the right end; the new left vector and the rows that were run again.

    It stops at the first vector that differs from the earlier one by a constant.
    """
    now = right
    for i in range(len(codes) - 1, -1, -1):
        if vectors[i] == now:
            return left, len(codes) - 1 - i
        vectors[i] = now
        now = before(codes[i], now)
    return now, len(codes)


def traced(codes: bytes, vectors: list[tuple], state: int) -> tuple[list[str], int, int]:
    """Letters by row, the state at the end, and the cost, from ``state``."""
    letters, total = [], 0
    for code, after in zip(codes, vectors, strict=True):
        some, state, cost = moves(code, after)[state]
        letters.append(some)
        total += cost
    return letters, state, total


def _lines(letters: list[str], roles: list[str], texts: list[str], state: int) -> Iterator[str]:
    for some, role, text in zip(letters, roles, texts, strict=True):
        for letter in some:
            if letter == "D":
                continue
            state = _AFTER[role[:1]][state] if letter == "K" else _NEXT[state]
            yield f"{role}:{text}" if letter == "K" else f"{_ROLE[state]}:{text if letter == 'R' else ''}"


def faults_of(roles: list[str], texts: list[str]) -> tuple[bytearray, list[bytes | None]]:
    """Codes of the rows of a chunk, duplicates inside it included, and a key of each row that may repeat an earlier chunk's."""
    codes, keys, seen = bytearray(), [], set()
    for role, text in zip(roles, texts, strict=True):
        plain = text.rstrip(BLANKS)
        name = role.encode()
        key = xxhash.xxh3_128_digest(len(name).to_bytes(8, "little") + name + text.encode()) if plain else None
        fault = BLANK if not plain else DUPLICATE if key in seen else CUT if plain[-1] not in ".!?" else FINE
        codes.append(code_of(role, fault))
        keys.append(None if key in seen else key)
        seen.add(key)
    return codes, keys


class _Report:
    """What is returned of a conversation, gathered chunk by chunk from the left."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.hash, self.lines, self.audit = conv_id, hashlib.sha256(), 0, []
        self.faults, self.illegal, self.cost, self.initial = [0, 0, 0, 0], 0, 0, None
        self.lowest = self.highest = None
        self.distinct = 0

    def turns(self, first: int | None, last: int | None, distinct: int) -> None:
        """First and last turn number of a chunk, nulls passed over, and how many different ones it has."""
        if first is not None:
            self.distinct += distinct - (first == self.highest)
            self.lowest = first if self.lowest is None else self.lowest
            self.highest = last

    def rows(self, codes: bytes, roles: list[str]) -> None:
        for code, role in zip(codes, roles, strict=True):
            self.faults[code & 3] += 1
            self.illegal += self.initial is not None and self.initial + role[:1] not in _LEGAL
            self.initial = role[:1]

    def edits(self, letters: str, cost: int, lines: int, text: bytes) -> None:
        self.audit.append(letters)
        self.cost += cost
        if lines:
            self.hash.update(b"\n" + text if self.lines else text)
        self.lines += lines

    def row(self) -> dict:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.distinct
        counts = {"gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT], "illegal": self.illegal, "cost": self.cost}
        return {"conv_id": self.conv_id, **counts, "audit": "".join(self.audit), "repaired_sha256": self.hash.hexdigest()}


def _edited(codes: bytes, roles: list[str], texts: list[str], vectors: list[tuple], state: int, last: bool) -> tuple[str, int, int, bytes]:
    """Letters, cost, number of lines and repaired text of a chunk; with the inserts after it if it is the last."""
    letters, end, cost = traced(codes, vectors, state)
    lines = list(_lines(letters, roles, texts, state))
    if last:
        letters.append(END_EDITS[end])
        cost += END_COSTS[end]
        for _ in END_EDITS[end]:
            end = _NEXT[end]
            lines.append(f"{_ROLE[end]}:")
    return "".join(letters), cost, len(lines), "\n".join(lines).encode()


# -- the job -------------------------------------------------------------------------------

_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_CHUNK = "whole boolean, part int, seq long, first_turn long, last_turn long, n_turns long, roles array<string>, texts array<string>, codes binary, keys array<binary>"
_CHUNK_NAMES = [c.split()[0] for c in _CHUNK.split(", ")]


def _schema(id_type: pa.DataType) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([("conv_id", id_type), *((n, kinds[k]) for n, k in (c.split() for c in f"{_RESULT}, {_CHUNK}".split(", ")))])


def _turns(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _cut(rows: int, chars: int):
    """Ordered rows to chunks, or to results where a conversation is one chunk with others of its partition around it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema = None
        held: list[tuple] = []
        size = seq = 0
        conv_id = begun = lone = None
        out: list[dict] = []

        def chunk(whole: bool) -> dict:
            nonlocal seq
            turns, roles, texts = (list(c) for c in zip(*held, strict=True))
            codes, keys = faults_of(roles, texts)
            if whole:
                report = _Report(conv_id)
                report.turns(*_turns(turns))
                report.rows(codes, roles)
                report.edits(*_edited(codes, roles, texts, backward(codes, END_COSTS)[1], START, True))
                return {**report.row(), "whole": True}
            row = dict(zip(_CHUNK_NAMES, (False, part, seq, *_turns(turns), roles, texts, bytes(codes), keys), strict=True))
            seq += 1
            return {"conv_id": conv_id, **row}

        for batch in batches:
            schema = schema or _schema(batch.schema.field(0).type)
            for name, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun is None or name != conv_id:
                    if held:
                        # The first conversation of a partition may have begun in the one before.
                        out.append(chunk(bool(lone and begun)))
                    begun, conv_id, lone = begun is not None, name, True
                    held, size = [], 0
                elif len(held) >= rows or size >= chars:
                    out.append(chunk(False))
                    held, size, lone = [], 0, False
                held.append(tuple(row))
                size += len(row[2])
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if held:
            out.append(chunk(False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return cut


def _pack(vectors: list[tuple]) -> bytes:
    return bytes(x for v in vectors for x in v)


def _unpack(raw: bytes) -> list[tuple]:
    return [tuple(raw[i : i + 4]) for i in range(0, len(raw), 4)]


def _marked(codes: bytes, repeats: list[int] | None) -> bytes:
    """Codes with the rows that repeat an earlier chunk's."""
    found = bytearray(codes)
    for i in repeats or ():
        found[i] = found[i] & ~3 | DUPLICATE
    return bytes(found)


_STATE = "part int, seq long, codes binary, right binary, left binary, vectors binary, rerun long"
_STATE_NAMES = [c.split()[0] for c in _STATE.split(", ")]


def _states(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=_STATE_NAMES)


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, seq, codes, repeats) to the state of a chunk that ends with what follows a last row."""
    for batch in batches:
        rows = []
        for part, seq, codes, repeats in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            codes = _marked(codes, repeats)
            left, vectors = backward(codes, END_COSTS)
            rows.append((part, seq, codes, bytes(END_COSTS), bytes(left), _pack(vectors), len(codes)))
        yield _states(rows)


def _fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States with the left vector of the next chunk, ``want``, to states that end with it."""
    for batch in batches:
        rows = []
        for part, seq, codes, _, left, raw, _, want in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            vectors = _unpack(raw)
            now, rerun = fixed(codes, tuple(want), tuple(left), vectors)
            rows.append((part, seq, codes, want, bytes(now), _pack(vectors), rerun))
        yield _states(rows)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = [[traced(codes, _unpack(raw), q)[1] for q in STATES] for codes, raw in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.list_(pa.int32()))], names=["part", "seq", "exits"])


def stitched(chunks: DataFrame, numbers: DataFrame) -> tuple[DataFrame, int]:
    """States of the ``chunks`` (part, seq, codes, repeats) when no vector changes any more, and the passes it took.

    ``numbers`` gives each chunk (part, seq) the ``next_part`` and ``next_seq`` of the chunk after it, if any.
    """
    states = written(chunks.select("part", "seq", "codes", "repeats").mapInArrow(_speculate, _STATE))
    passes = 0
    while True:
        following = states.select(F.col("part").alias("next_part"), F.col("seq").alias("next_seq"), F.col("left").alias("want"))
        wanted = numbers.join(following, ["next_part", "next_seq"]).select("part", "seq", "want")
        met = states.join(wanted, ["part", "seq"], "left")
        stale = F.col("want").isNotNull() & (F.col("want") != F.col("right"))
        changed = written(met.where(stale).select(*_STATE_NAMES, "want").mapInArrow(_fix, _STATE))
        if changed.isEmpty():
            return states, passes
        passes += 1
        states = written(met.where(~stale).select(*_STATE_NAMES).union(changed))


def entry_states(maps: DataFrame, fan: int = FAN) -> DataFrame:
    """conv_id, no, state: where each chunk begins, from ``maps`` (conv_id, no, exits) of chunks numbered from 0.

    Groups of ``fan`` maps are composed, and the groups' own maps likewise, so no task holds more than ``fan``.
    """
    most = maps.agg(F.max("no")).first()[0]
    if most is None:
        return maps.select("conv_id", "no", F.lit(START).alias("state"))
    group = F.floor(F.col("no") / fan).alias("group")
    lists = maps.groupBy("conv_id", group).agg(F.array_sort(F.collect_list(F.struct("no", "exits"))).alias("run"))
    if most < fan:
        begun = lists.withColumn("state", F.lit(START))
    else:
        lists = written(lists)
        same = F.array(*(F.lit(q) for q in STATES))
        whole = F.aggregate("run", same, lambda now, x: F.transform(now, lambda q: F.element_at(x["exits"], q + 1)))
        above = entry_states(lists.select("conv_id", F.col("group").alias("no"), whole.alias("exits")), fan)
        above = above.select(F.col("conv_id").alias("of"), F.col("no").alias("at"), "state")
        begun = lists.join(above, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("group") == F.col("at"))).select("conv_id", "run", "state")
    none = F.array().cast("array<struct<no: bigint, state: int>>")
    walked = F.aggregate(
        "run",
        F.struct(F.col("state").alias("now"), none.alias("out")),
        lambda s, x: F.struct(F.element_at(x["exits"], s["now"] + 1).alias("now"), F.array_append(s["out"], F.struct(x["no"].alias("no"), s["now"].alias("state"))).alias("out")),
        lambda s: s["out"],
    )
    return begun.select("conv_id", F.inline(walked))


_PIECE = "first_turn long, last_turn long, n_turns long, initials array<string>, codes binary, letters string, cost long, lines long, text binary"
_PIECE_NAMES = [c.split()[0] for c in _PIECE.split(", ")]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with codes, vectors and state to what they add to their conversation."""
    for batch in batches:
        rows = batch.to_pylist()
        out = [_edited(r["codes"], r["roles"], r["texts"], _unpack(r["vectors"]), r["state"], r["last"]) for r in rows]
        same = [batch.column(n) for n in ("conv_id", "no", "first_turn", "last_turn", "n_turns")]
        initials = pa.array([[role[:1] for role in r["roles"]] for r in rows], pa.list_(pa.string()))
        edits = [pa.array([e[i] for e in out], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([*same, initials, batch.column("codes"), *edits], names=["conv_id", "no", *_PIECE_NAMES])


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (conv_id, no) to results; a piece at a time is in memory."""
    report = schema = None
    for batch in batches:
        schema = schema or pa.schema(list(_schema(batch.schema.field(0).type))[: len(_NAMES) + 1])
        done = []
        for row in batch.to_pylist():
            if report is None or report.conv_id != row["conv_id"]:
                if report is not None:
                    done.append(report.row())
                report = _Report(row["conv_id"])
            report.turns(row["first_turn"], row["last_turn"], row["n_turns"])
            report.rows(row["codes"], row["initials"])
            report.edits(row["letters"], row["cost"], row["lines"], row["text"])
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    if report is not None:
        yield pa.RecordBatch.from_pylist([report.row()], schema=schema)


def repair(turns: DataFrame, rows: int = CHUNK_ROWS, chars: int = CHUNK_CHARS, fan: int = FAN) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): its faults and its cheapest repair.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    Rows are taken by turn, nulls first, then by role and text.  A row's first fault counts: blank (no
    character beside ASCII white space), duplicate (role and text seen earlier, by 128 bits of
    hash), truncated (the last such character is none of ``.!?``).  Blank and duplicate rows are
    deleted; of the cheapest edits those with the least letters are chosen.

    Null roles and texts are one blank.  Rows without a conversation id form one conversation.  A
    role without letters leaves the order of roles as it is.  Repeated rows are duplicates.  An
    empty table gives no rows; other columns are not looked at.
    """
    ordered = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = ordered.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv_id", "turn", "role", "text")
    cut = written(ordered.mapInArrow(_cut(rows, chars), f"conv_id {kind}, {_RESULT}, {_CHUNK}"), "whole")
    finished = cut.where("whole").select("conv_id", *_NAMES)
    chunks = cut.where("NOT whole").select("conv_id", *_CHUNK_NAMES[1:])

    # Numbers along the conversation: a row for each partition that holds some of it, added up in order.
    of_part = chunks.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    along = Window.partitionBy("conv_id").orderBy("part")
    of_part = of_part.withColumns({
        "passed": F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "next_part": F.lead("part").over(along),
        "next_first": F.lead("first").over(along),
    })
    of_part = of_part.withColumnsRenamed({"conv_id": "of", "part": "in_part"})
    mine = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part"))
    end = F.col("seq") == F.col("first") + F.col("n") - 1
    numbers = chunks.select("conv_id", "part", "seq").join(of_part, mine).select(
        "conv_id", "part", "seq", (F.col("passed") + F.col("seq") - F.col("first")).alias("no"),
        F.when(end, F.col("next_part")).otherwise(F.col("part")).alias("next_part"),
        F.when(end, F.col("next_first")).otherwise(F.col("seq") + 1).alias("next_seq"),
    )
    numbers = written(numbers)

    # Rows that repeat an earlier chunk's.
    keyed = chunks.select("part", "seq", F.posexplode("keys").alias("at", "key")).where("key IS NOT NULL").join(numbers.select("conv_id", "part", "seq", "no"), ["part", "seq"])
    keyed = written(keyed)
    often = keyed.groupBy(F.col("conv_id").alias("of"), F.col("key").alias("same")).agg(F.min("no").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeats = keyed.join(often, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("same"))).where("no > first")
    repeats = repeats.groupBy("part", "seq").agg(F.collect_list("at").alias("repeats"))
    states, _ = stitched(chunks.join(repeats, ["part", "seq"], "left"), numbers.where("next_part IS NOT NULL"))

    maps = states.select("part", "seq", "codes", "vectors").mapInArrow(_exits, "part int, seq long, exits array<int>").join(numbers, ["part", "seq"])
    entries = entry_states(written(maps.select("conv_id", "no", "exits")), fan)
    entries = entries.select(F.col("conv_id").alias("of"), F.col("no").alias("at"), "state")
    placed = numbers.join(entries, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("no") == F.col("at")))
    placed = placed.select("part", "seq", "no", "state", F.col("next_part").isNull().alias("last"))
    full = chunks.drop("codes", "keys").join(states.select("part", "seq", "codes", "vectors"), ["part", "seq"]).join(placed, ["part", "seq"])
    pieces = full.mapInArrow(_pieces, f"conv_id {kind}, no long, {_PIECE}")
    long = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "no").mapInArrow(_reports, f"conv_id {kind}, {_RESULT}")
    return finished.unionByName(long)


def repair_damaged(turns: DataFrame, **sizes: int) -> DataFrame:
    """``repair`` of the ``damaged`` rows, with a row of zeros and the hash of nothing for each conversation that lost all its rows."""
    gone = turns.groupBy("conv_id").agg(F.bool_and(_damage() == 0).alias("gone")).where("gone")
    zeros = [F.lit(0).cast("long").alias(n) for n in _NAMES[:6]]
    empty = gone.select("conv_id", *zeros, F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    return repair(damaged(turns), **sizes).unionByName(empty)
