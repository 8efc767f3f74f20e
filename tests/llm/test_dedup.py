from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from matrixlens.llm import golay
from matrixlens.llm.components import connected_components
from matrixlens.llm.exact_dedup import CountingQuotientFilter, deduplicate, exact_groups, merge_sorted
from matrixlens.llm.near_dedup import RADIUS, fingerprint_links, link_runs, near_duplicate_groups, one_per_group, segment_keys
from matrixlens.llm.simhash import fingerprint, shingle_hashes, words_of
from tests.llm.cases import AWKWARD, WORDS, documents, prose


def plain(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def expected_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append((i, t or ""))
    out = []
    for i, t in rows:
        group = groups[plain(t)]
        best = min(group, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        kept = i == best[0] and len(t or "") == len(best[1])
        out.append((i, best[0], len(group), kept, hashlib.sha256(plain(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups(spark):
    rows = [*AWKWARD, *((100 + i, prose(5, 20)) for i in range(40)), (90, prose(5, 20) + " ")]
    got = exact_groups(documents(spark, rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_groups(rows)


def test_exact_groups_of_nothing(spark):
    assert exact_groups(documents(spark).limit(0)).count() == 0
    assert deduplicate(documents(spark).limit(0)).count() == 0


def test_deduplicate_keeps_one_of_each(spark):
    docs = documents(spark)
    left = deduplicate(docs)
    assert left.columns == docs.columns
    texts = [plain(r.text) for r in left.collect()]
    assert sorted(texts) == sorted({plain(t) for _, t in AWKWARD})
    assert {r.doc_id for r in left.collect() if plain(r.text) == plain(prose(1, 50))} == {4}


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40), max_size=60), st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40), max_size=60))
@settings(max_examples=60, deadline=None)
def test_quotient_filters_merge_without_loss(one, other):
    sides = []
    for values in (one, other):
        keys, counts = np.unique(np.array(values, np.uint64), return_counts=True)
        kept = CountingQuotientFilter.from_bytes(CountingQuotientFilter.of(keys, counts, 0).to_bytes())
        assert (kept.fingerprints(0) == keys).all()
        sides.append((kept.fingerprints(0), kept.counts))
    keys, counts = merge_sorted(*sides)
    want, times = np.unique(np.array(one + other, np.uint64), return_counts=True)
    assert keys.tolist() == want.tolist() and counts.tolist() == times.tolist()


def test_golay_code():
    checks, errors, further = golay._tables()
    codewords = (np.arange(4096) << 11) | checks
    assert min(int(c).bit_count() for c in codewords[1:]) == 7
    assert (np.bitwise_count(errors << 11 | 0) <= 3).all() and ((further >= 0).all(axis=1).sum() == 1771)
    words = np.random.default_rng(1).integers(0, 1 << 23, 4000)
    for bit in (None, 0, 7, 22):
        other = words if bit is None else words ^ (1 << bit)
        a, b = golay.keys(words), golay.keys(other)
        common = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any(axis=(1, 2))
        assert common.all()


def test_every_error_pattern_shares_a_key():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000, dtype=np.uint64)
    other = base.copy()
    for i in range(len(base)):
        for bit in rng.choice(64, i % 4, replace=False):
            other[i] ^= np.uint64(1 << int(bit))
    a, b = (set(zip(*(x.tolist() for x in segment_keys(v)), strict=True)) for v in (base, other))
    assert {row for row, _ in a & b} == set(range(3000))


def components_of(fps):
    fps = sorted(set(fps))
    root = {f: f for f in fps}
    for i, f in enumerate(fps):
        for g in fps[i + 1 :]:
            if (f ^ g).bit_count() <= RADIUS and root[f] != root[g]:
                old, new = max(root[f], root[g]), min(root[f], root[g])
                root = {k: new if v == old else v for k, v in root.items()}
    return root


@pytest.mark.parametrize("long_run", [False, True])
def test_links_of_runs_connect_what_belongs_together(long_run):
    rng = random.Random(3)
    fps = sorted({0xF0F0 ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for _ in range(60 if long_run else 7)})
    links = link_runs(np.zeros(len(fps), np.int64), np.array(fps, np.uint64))
    assert all((int(a) ^ int(b)).bit_count() <= RADIUS for a, b in links)
    got = {f: f for f in fps}
    for _ in fps:
        for a, b in links.tolist():
            got[a] = got[b] = min(got[a], got[b])
    assert got == components_of(fps)


def test_fingerprint_links_against_all_pairs(spark):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(25)]
    fps = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for c in centres for _ in range(25)} | {0, 1, 2**64 - 1}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    links = fingerprint_links(spark.createDataFrame(signed, "fp long"))
    roots = {r.node % 2**64: r.root for r in connected_components(links).collect()}
    want = components_of(fps)
    groups = {}
    for f in fps:
        groups.setdefault(roots.get(f, ("alone", f)), set()).add(f)
    expected = {}
    for f in fps:
        expected.setdefault(want[f], set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    chain = list(range(0, 400))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:], strict=False)) + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(400)}, **{i: 1000 for i in range(1000, 1200)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicate_groups(spark):
    base = prose(11, 400).split()
    near = [" ".join(base[:i] + [WORDS[i % 20]] + base[i + 1 :]) for i in range(0, 400, 20)]
    rows = [*AWKWARD, *((200 + i, t) for i, t in enumerate(near)), (199, " ".join(base))]
    got = near_duplicate_groups(documents(spark, rows))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    fps = {t: slow_fingerprint(t) for _, t in rows}
    assert fingerprint(shingle_hashes(words_of(rows[7][1]), 3)) == fps[rows[7][1]]
    roots = components_of(fps.values())
    least = {}
    for i, t in rows:
        if i is not None:
            least[roots[fps[t]]] = min(i, least.get(roots[fps[t]], i))
    want = [(i, f"{fps[t]:016x}", least.get(roots[fps[t]])) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def slow_groups(rows):
    """The row that stays of each component, by comparing all pairs of fingerprints."""
    roots = components_of({slow_fingerprint(t) for _, t in rows})
    groups = {}
    for i, t in rows:
        groups.setdefault(roots[slow_fingerprint(t)], []).append((i is None, i or 0, b"\0" if t is None else hashlib.sha256(t.encode()).digest(), t))
    return {min(g, key=lambda r: r[:3]) for g in groups.values()}


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(9)
    rows = [r for r in AWKWARD if r[1] is None or len(r[1]) < 100_000]
    for i in range(40):
        words = prose(700 + i, 150).split()
        rows.append((1000 + 10 * i, " ".join(words)))
        for k in range(1 + i % 3):
            changed = list(words)
            for at in rng.sample(range(150), 1 + k):
                changed[at] = rng.choice(WORDS) + "x"
            rows.append((1001 + 10 * i + k, " ".join(changed)))
    rows += [(2000 + i, f"{prose(5, 200)} tail{i}") for i in range(60)] + [(None, "x y z"), (3000, "x y z"), (3000, "X y\tz"), (3000, "x y z")]
    docs = documents(spark, rows)
    left = one_per_group(docs)
    assert left.columns == docs.columns
    want = slow_groups(rows)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(((None if lacks else i, t) for lacks, i, _, t in want), key=repr)
    assert len(want) < len(rows) - 40
    assert one_per_group(docs.limit(0)).count() == 0 and near_duplicate_groups(docs.limit(0)).count() == 0
