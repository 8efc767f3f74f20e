from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from matrixlens.llm import repair as R

BLANKS = " \t\n\x0b\x0c\r"


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(initials, faults):
    """Cost and audit by a search over (row, initials so far, reduced to what the pattern needs) in order of (cost, letters)."""
    done = set()
    queue = [(0, "", 0, "")]
    while True:
        cost, audit, i, shape = heapq.heappop(queue)
        if (i, shape) in done:
            continue
        done.add((i, shape))
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", shape):
            return cost, audit

        def go(letter, price, j, added, cost=cost, audit=audit, shape=shape):
            grown = shape + added
            if re.fullmatch("s?(ua)*u?", grown):
                grown = re.sub("(ua)+", "ua", grown)  # one pair stands for many
                heapq.heappush(queue, (cost + price, audit + letter, j, grown))

        for role in "ua":
            go("I", 3, i, role)
        if i < len(initials):
            go("D", 4, i + 1, "")
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                go("K", more, i + 1, initials[i])
                for role in "ua":
                    go("R", 3 + more, i + 1, role)


def slow_repair(rows, ids):
    result = {}
    groups = {c: [r for r in rows if r[0] == c] for c in ids}
    for conv, group in groups.items():
        group.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in group:
            plain = text.strip(BLANKS)
            faults.append("blank" if not plain else "duplicate" if (role, text) in seen else "truncated" if plain[-1] not in ".!?" else None)
            seen.add((role, text))
        initials = [r[2][:1] for r in group]
        cost, audit = cheapest(initials, faults)
        lines, shape, i = [], "", 0
        for letter in audit:
            wanted = "assistant" if shape.endswith("u") else "user"
            if letter == "I":
                lines.append(f"{wanted}:")
                shape += wanted[0]
                continue
            _, _, role, text = group[i]
            i += 1
            if letter != "D":
                role = wanted if letter == "R" else role
                shape += role[:1]
                lines.append(f"{role}:{text}")
        turns = [r[1] for r in group if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        result[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        turn = rng.randrange(-2, 3)
        for _ in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "Ünit"])
            text = rng.choice([None, "", " \t", "yes.", "no!", "why", "Is it? ", "ok.  ", "x" * 50 + ".", f"word {rng.randrange(30)}.", "a.b!"])
            rows.append((conv, rng.choice([turn, turn, turn, None]), role, text))
            turn += rng.choice([0, 1, 1, 1, 1, 2])
    rng.shuffle(rows)
    return rows


def table(spark, rows, slices=3):
    full = [(*r, 1, "x", True) for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, no int, state string, whole boolean").repartition(slices)


@pytest.mark.parametrize(("seed", "n", "longest", "sizes"), [(1, 60, 12, {}), (2, 8, 90, {"rows": 4, "fan": 3}), (3, 5, 40, {"rows": 1, "fan": 2}), (4, 10, 60, {"chars": 100})])
def test_against_a_search(spark, seed, n, longest, sizes):
    rows = conversations(seed, n, longest)
    got = {r.conv_id: tuple(r)[1:] for r in R.repair_damaged(table(spark, rows), **sizes).collect()}
    assert got == slow_repair(slow_damage(rows), {r[0] for r in rows})


def test_awkward_tables(spark):
    gone = next(c for c in range(1000) if all(zlib.crc32(f"{c}:{t}".encode()) % 20 == 0 for t in (0,)))
    rows = [(gone, 0, "user", "hi."), (None, None, None, None), (7, 1, "user", "long " * 200_000 + "."), (7, 2, "assistant", "Ja.")] + [(8, 3, "user", "same.")] * 40
    got = R.repair_damaged(table(spark, rows), rows=8)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = {r.conv_id: tuple(r)[1:] for r in got.collect()}
    assert found == slow_repair(slow_damage(rows), {r[0] for r in rows})
    assert found[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert R.repair_damaged(table(spark, []), rows=8).count() == 0


def test_vectors_converge_within_a_few_rows():
    """Whatever vector a chunk begins from, after some rows it differs by a constant only."""
    rng = random.Random(5)
    ran = []
    for _ in range(200):
        codes = bytes(R.code_of(rng.choice(["user", "assistant", "system", "tool"]), rng.choice([R.FINE, R.FINE, R.CUT, R.DUPLICATE])) for _ in range(400))
        left, vectors = R.backward(codes, R.END_COSTS)
        for other in set(vectors[:50]):
            kept = list(vectors)
            now, rerun = R.fixed(codes, other, left, kept)
            assert (now, kept) == R.backward(codes, other)
            ran.append(rerun)
        assert len(set(vectors)) < 60
    assert sorted(ran)[len(ran) // 2] < 40
