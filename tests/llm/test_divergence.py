from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from matrixlens.llm import divergence as D

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return LETTERS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow_audit(rows, least, top):
    docs = [(lang or "", source or "", slow_terms(text)) for lang, source, text in rows]
    groups, seen = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        groups[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in seen.keys() | {g[0] for g in groups}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        of = {s: c for (g, s), c in groups.items() if g == lang}

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // total for t in kept}

        whole = shares(sum(of.values(), Counter()))
        share = {s: shares(c) for s, c in of.items()}
        for s in of:
            pairs = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode()) for o in of if o != s]
            terms = [(whole[t] - share[s][t], t.encode()) for t in kept if of[s][t] > 0 and share[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(sorted(found)[:most])]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ab", "éß", "CD", "日本", "x") for b in ("", "ra", "Zo", "ñi", "q")]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "Ü", "c", None]), " 1-".join(rng.choices(words, weights=range(1, 26), k=rng.randrange(12)))) for _ in range(n)]
    return rows + [("fr", "only", "seul. seul"), ("xx", "s1", None), ("xx", "s2", ""), ("xx", "s3", "12 _ \u0000 !"), ("en", "a", "long Word" * 30_000), ("en", "z", "ab ab ab")] + [("de", "b", "Copy ab")] * 40


def table(spark, rows):
    full = [(*r, 1, "t", 5) for r in rows]
    return spark.createDataFrame(full, "lang string, source string, text string, n int, term string, rank int").repartition(4)


@pytest.mark.parametrize(("seed", "n", "least", "sizes"), [(1, 600, 30, {}), (2, 400, 3, {"cells": 16, "sources": 2}), (3, 300, 1, {"cells": 8, "sources": 1, "top": 5}), (4, 50, 30, {})])
def test_against_brute_force(spark, monkeypatch, seed, n, least, sizes):
    rows = corpus(seed, n)
    got = D.source_divergence(table(spark, rows), least=least, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == slow_audit(rows, least, sizes.get("top", 50))


def test_empty_table(spark):
    assert D.source_divergence(table(spark, [("en", "a", "x")]).limit(0)).count() == 0


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    rows = corpus(7, 200)
    batch = table(spark, rows).select("lang", "source", "text").na.fill("").toArrow().to_batches()
    monkeypatch.setattr(D, "HELD", 10)
    found = defaultdict(int)
    for part in D._count(iter(batch)):
        for r in part.to_pylist():
            found[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter((lang or "", source or "", t) for lang, source, text in rows for t in slow_terms(text))
    assert {k: v for k, v in found.items() if k[2]} == want


def test_joint_difference_with_many_levels(monkeypatch):
    """The cells of counts, zeros by complement, against sums term by term."""
    monkeypatch.setattr(D, "_STEP", 1)
    rng = np.random.default_rng(3)
    for size in (1, 63, 64, 200):
        sides, shares = [], []
        for _ in range(2):
            counts = rng.integers(0, 6, size)
            share = {c: int(rng.integers(1, 10**9)) for c in range(6)}
            levels = [c for c in range(1, 6) if (counts == c).any()]
            bits = np.zeros((len(levels), 8 * -(-size // 64)), np.uint8)
            for i, c in enumerate(levels):
                packed = np.packbits(counts == c, bitorder="little")
                bits[i, : len(packed)] = packed
            sides.append((np.array([share[c] for c in levels], np.int64), bits.view(np.uint64)))
            shares.append((np.array([share[c] for c in counts]), share[0]))
        want = int(np.abs(shares[0][0] - shares[1][0]).sum())
        assert D.joint_difference(*sides, (shares[0][1], shares[1][1]), size) == want
