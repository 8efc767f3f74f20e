from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from matrixlens.llm import decontaminate as leaks, katz, quality
from matrixlens.llm.decontaminate import SIMILARITY, _bitmap, contaminated, decontaminate, plain_words, similarity
from matrixlens.llm.queries import PIECE_MODEL
from matrixlens.llm.sentencepieces import ChunkTable, encode_documents
from matrixlens.llm.tables import in_fold
from tests.llm.cases import AWKWARD, LONG, documents, prose

TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\nb \t c", "▁x ▁", " é ﬁ ①", "<s> x </s>", "<0x0A>", "日本語 テキスト", "😀 ​﻿", "x" * 3000, "a▁▁b", "\x00 a",
    "é " * 50, LONG[:20000],
]


def test_pieces_as_the_library_gives_them(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=str(PIECE_MODEL))
    rows = [*AWKWARD, *((100 + i, t) for i, t in enumerate(TEXTS))]
    docs = documents(spark, rows)
    whole = encode_documents(docs, str(PIECE_MODEL)).collect()
    digests = encode_documents(docs, str(PIECE_MODEL), digest=True).collect()
    want = Counter()
    short = Counter()
    for i, t in rows:
        ids = sp.encode(t or "")
        back = sp.decode(ids)
        want[(i, len(ids), tuple(ids), back)] += 1
        short[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in whole) == want
    assert Counter(map(tuple, digests)) == short
    assert encode_documents(docs.limit(0), str(PIECE_MODEL)).count() == 0


def test_chunk_table_that_overflows_gives_the_same(monkeypatch):
    monkeypatch.setattr("matrixlens.llm.sentencepieces.TABLE_CHUNKS", 3)
    sp = sentencepiece.SentencePieceProcessor(model_file=str(PIECE_MODEL))
    table = ChunkTable(str(PIECE_MODEL))
    for text in TEXTS:
        ids = sp.encode(text)
        assert table.encode(text) == (len(ids), ",".join(map(str, ids)), sp.decode(ids))


# -- benchmark decontamination -------------------------------------------------------------

ITEMS = [(1, prose(50, 30)), (2, prose(51, 30)), (3, prose(52, 12)), (4, prose(53, 55)), (5, "too short"), (6, None), (7, prose(52, 12)), (None, prose(54, 25))]


def slow_matches(rows, items):
    out = {}
    for i, t in rows:
        words = [w.decode() for w in plain_words(t)]
        for k, item in items:
            want = [w.decode() for w in plain_words(item)]
            if len(want) < 5:
                continue
            best = max(similarity(words[a : a + len(want)], want) for a in range(max(1, len(words) - len(want) + 1)))
            if best >= SIMILARITY:
                out[i, k] = max(best, out.get((i, k), 0))
    return out


def test_leaks_are_found_and_clean_documents_left_alone(spark):
    edited = ITEMS[3][1].split()
    edited[20] = "changed"
    rows = [
        *AWKWARD,
        (20, f"{prose(60, 100)} {ITEMS[0][1]} {prose(61, 100)}"),
        (21, ITEMS[1][1].upper().replace(" ", " | ")),
        (22, " ".join(edited)),
        (23, f"{ITEMS[2][1]}, {ITEMS[2][1]} {ITEMS[7][1]}"),
        (24, " ".join(ITEMS[0][1].split()[:15])),
        (25, prose(62, 300)),
        (26, "too short"),
        *((300 + i, f"{prose(i, 5)} {ITEMS[0][1]}") for i in range(30)),
    ]
    docs, items = documents(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2)
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(docs, items).collect()}
    want = slow_matches([r for r in rows if r[1] != LONG], ITEMS)
    assert got == pytest.approx(want)
    assert (22, 4) in got and 24 not in {i for i, _ in got}
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    bad = {i for i, _ in want}
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in rows if i not in bad)
    assert contaminated(docs.limit(0), items).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == len(rows)


class _Sizes(list):
    """Sizes of windows that count how often they are gone through."""

    times = 0

    def __iter__(self):
        self.times += 1
        return super().__iter__()


def test_windows_are_looked_for_near_hits_only():
    """All windows with enough weight in hits are found, and a lone hit costs no look for each size."""
    rng = np.random.default_rng(11)
    keyed = np.ones(1 << leaks.KEY_BITS, bool)
    for n_words, share in [(400, 0.5), (400, 0.75), (60, 0.8), (14, 0.9), (5, 1.0), (30, 1.0), (300, 0.02)]:
        words = [b"w" * int(k) for k in rng.integers(1, 12, n_words)]
        hashes, weights = leaks.shingles(words, leaks._Hashes())
        hit = rng.random(len(hashes)) < share
        total, shared = (np.concatenate([[0], np.cumsum(x)]) for x in (weights, weights * hit))
        sizes = [5, 7, 15, 16, 40, 59] if n_words < 300 else [15, 16, 40, 59]
        want = {}
        for size in sizes:
            begin = np.arange(max(0, n_words - size) + 1)
            end = np.minimum(begin + size - 4, len(hashes))
            want[size] = np.flatnonzero(shared[end] - shared[begin] >= SIMILARITY * (total[end] - total[begin])).tolist()
        found = {size: sorted(set(starts.tolist())) for starts, size, *_ in leaks._windows(hashes, weights, hit, n_words, sizes, keyed)}
        assert found == {size: starts for size, starts in want.items() if starts}
    lone = np.zeros(len(hashes), bool)
    lone[100] = True
    sizes = _Sizes([15, 16, 40, 59])
    assert not list(leaks._windows(hashes, weights, lone, n_words, sizes, keyed)) and not sizes.times


def test_edited_leaks_are_found_as_by_brute_force(spark):
    rng, items, rows = random.Random(8), [], []
    for i in range(60):
        words = prose(8000 + i, 15 + 3 * (i % 15)).split()
        items.append((i, " ".join(words)))
        for k in range(12):
            n, edited = len(words), list(words)
            cut = rng.randrange(1, n // 9 + 1)
            if k % 3 == 0:
                for at in rng.sample(range(n), 1 + n // 40):
                    edited[at] = "changed"
            elif k % 3 == 1:
                edited = edited[cut:] + ["tail"] * cut
            else:
                edited = ["head"] * cut + edited[:-cut]
            if SIMILARITY <= similarity(edited, words) < 0.9:
                rows.append((1000 * i + k, f"{prose(9000 + i, 20)} {' '.join(edited)} {prose(9500 + k, 20)}"))
    want = {(d, i): slow_matches([(d, t)], [items[d // 1000]])[d, d // 1000] for d, t in rows for i in (d // 1000,)}
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 200 and got == pytest.approx(want)


def test_rows_without_an_id_are_judged_by_their_text(spark):
    rows = [(None, prose(70, 40)), (None, ITEMS[0][1]), (1, prose(71, 40)), (1, ITEMS[0][1])]
    left = decontaminate(documents(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert sorted(r.text for r in left.collect()) == sorted([prose(70, 40), prose(71, 40)])


def test_bitmap_has_every_slot(spark):
    slots = [0, 1, 2, 32767, 32768, 32769, 65536, 99999]
    found = _bitmap(spark.createDataFrame([(s,) for s in slots], "slot long"), 17)
    assert np.flatnonzero(found).tolist() == slots


# -- language model ------------------------------------------------------------------------


def slow_katz(rows, order):
    tokens = [(i, (t or "").encode().lower().split() + [katz.END]) for i, t in rows]
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1 for i, _ in rows}
    counts = [Counter() for _ in range(order)]
    for i, words in tokens:
        if not held[i]:
            for k in range(order):
                counts[k].update(tuple(words[j - k : j + 1]) for j in range(k, len(words)))
    n, v = sum(counts[0].values()), len(counts[0])
    loss = [katz.discounts([sum(1 for x in c.values() if x == r) for r in range(1, katz.LARGEST_RARE + 2)]) for c in counts]
    followers = defaultdict(set)
    for c in counts[1:]:
        for gram in c:
            followers[gram[:-1]].add(gram[-1])

    def lowered(k, c):
        return c - loss[k][min(c, katz.LARGEST_RARE + 1)]

    unknown = 1 - sum(lowered(0, c) for c in counts[0].values()) / n if n else 1.0

    @cache
    def probability(history, word):
        c = counts[len(history)][(*history, word)]
        if not history:
            return lowered(0, c) / n if c else unknown
        if c:
            return lowered(len(history), c) / counts[len(history) - 1][history]
        weight = backoff(history) if counts[len(history) - 1][history] else 1
        return weight * probability(history[1:], word)

    @cache
    def backoff(history):
        seen = sum(lowered(len(history), counts[len(history)][(*history, w)]) for w in followers[history])
        return (1 - seen / counts[len(history) - 1][history]) / (1 - sum(probability(history[1:], w) for w in followers[history]))

    out = []
    for i, words in tokens:
        base = sum(math.log10((counts[0][(w,)] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        score = sum(math.log10(probability(tuple(words[max(0, j - order + 1) : j]), w)) for j, w in enumerate(words))
        out.append((i, held[i], len(words), sum(counts[0][(w,)] > 0 for w in words), n, base, score))
    return out, probability, counts, followers


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_against_counting_by_hand(spark, monkeypatch, order):
    rows = [(i, t) for i, t in AWKWARD if t != LONG] + [(100 + i, prose(80 + i % 7, 40 + i)) for i in range(40)]
    docs = documents(spark, rows)
    model = katz.fit_and_score(docs, in_fold("doc_id", 5, 1), order=order)
    want, probability, counts, followers = slow_katz(rows, order)
    got = model.scores
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    order_by = lambda r: (repr(r[0]), r[2], r[6])
    for a, b in zip(sorted(map(tuple, got.collect()), key=order_by), sorted(want, key=order_by), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-8)
    for history in list(followers)[:20]:
        assert sum(probability(history, w[0]) for w in counts[0]) + probability(history, b"never seen") == pytest.approx(1)
    assert {r["order"]: r["count"] for r in model.counts_of().groupBy("order").count().collect()} == {k: len(c) for k, c in enumerate(counts)}
    if order > 1:
        assert model.weights_of().count() == len(followers)


def test_discounts_follow_good_turing():
    """Between 0 and the count, growing, of Katz's form for the smoothed counts of counts; rough, sparse and flat ones too."""
    k = katz.LARGEST_RARE
    for n in ([1479748, 227505, 46829, 19665, 17371, 6978], [9, 4, 0, 0, 1, 0], [5, 5, 5, 5, 5, 5], [0] * 6, [7, 0, 0, 0, 0, 0], [0, 3, 0, 9, 0, 0], [1, 2, 4, 8, 16, 32]):
        loss = katz.discounts(n)
        assert loss[0] == 0 and loss[-1] == loss[-2] and len(loss) == k + 2
        ratio = 1 - loss[1 : k + 1] / np.arange(1, k + 1)
        assert ((0 < ratio) & (ratio < 1)).all() and (np.diff(ratio) > 0).all()
        smooth = [r ** katz.slope(n) for r in range(1, k + 2)]
        common = (k + 1) * smooth[k] / smooth[0]
        assert ratio == pytest.approx([((r + 1) * smooth[r] / (r * smooth[r - 1]) - common) / (1 - common) for r in range(1, k + 1)])
    exact = [round(1e9 * r**-2.5) for r in range(1, k + 2)]
    assert katz.slope(exact[:1] + exact[1:]) == pytest.approx(-2.5, abs=0.2)


def test_katz_without_training_rows_or_documents(spark):
    docs = documents(spark)
    rows = katz.fit_and_score(docs, F.lit(True)).scores.collect()
    assert len(rows) == len(AWKWARD) and all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in rows)
    assert katz.fit_and_score(docs.limit(0), F.lit(False)).scores.count() == 0


def test_blocks_do_not_change_scores(spark):
    rows = [(i, prose(i % 9, 30)) for i in range(60)]
    one = {r.doc_id: r.score for r in katz.fit_and_score(documents(spark, rows, 1), in_fold("doc_id", 5, 1)).scores.collect()}
    many = {r.doc_id: r.score for r in katz.fit_and_score(documents(spark, rows, 7), in_fold("doc_id", 5, 1)).scores.collect()}
    assert one == pytest.approx(many)


# -- quality -------------------------------------------------------------------------------


def test_interactions_by_the_sum_of_squares():
    rng = np.random.default_rng(0)
    model = quality.FactorisationMachine(0.3, rng.normal(size=quality.SLOTS), rng.normal(size=(quality.SLOTS, quality.FACTORS)))
    ids, values = rng.choice(quality.SLOTS, 12, replace=False), rng.normal(size=12)
    pairs = sum(values[a] * values[b] * model.factors[ids[a]] @ model.factors[ids[b]] for a in range(12) for b in range(a))
    want = 0.3 + model.linear[ids] @ values + pairs
    assert model.margins(np.tile(ids, 2), np.tile(values, 2), np.array([0, 12])) == pytest.approx([want, want])


def test_quality_of_held_out_rows(spark):
    good = [(i, prose(i, 60)) for i in range(120)]
    bad = [(1000 + i, prose(i, 60).replace(" ", "### ")) for i in range(120)]
    docs = documents(spark, [*AWKWARD, *good, *bad])
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (5, None), (3, 1), (3, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.quality_scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(AWKWARD) + 240 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    truth = {i: 1 for i, _ in good} | {i: 0 for i, _ in bad}
    held = [r for r in rows if r.held_out and r.doc_id in truth and r.doc_id > 20]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    model = quality.train(docs, labels, in_fold("doc_id", 5, 0))
    left = quality.accepted(docs, model)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r.doc_id for r in rows if r.predicted)
    same = quality.score(documents(spark, [(1, "x y"), (1, "x y")]), model)
    assert same.count() == 2 and same.select("score").distinct().count() == 1


def test_quality_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(abs(r.score - 0.5) < 0.1 for r in quality.quality_scores(documents(spark), none).collect())
    assert quality.quality_scores(documents(spark).limit(0), none).count() == 0
