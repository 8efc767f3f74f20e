from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from matrixlens.llm import packing as P
from tests.llm.cases import AWKWARD, documents, prose

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return tokenizers.Tokenizer.from_file(FILE)


def test_ids_are_the_tokenizers(model, monkeypatch):
    encode = P.Encoder(FILE)
    texts = [t for _, t in AWKWARD if t] + [
        "it's we'll they'd 'S", "a  b   c\n\n d \t\n", "  ", "\n", " \n x", "x\x1c\x1dy \x1f z\x85q\xa0 r  s", "12 ½ ⅷ ٣٤ x²", "don’t – “quote”", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>",
        "\x00\x01 \x7f", "नमस्ते दुनिया ภาษาไทย 中文字 한국어", "é ‍👩‍👩‍👧 ퟿﻿", "A" * 5000, " " * 3000, "1" * 999, "!?" * 700, "tab\there\r\nnew",
    ]
    rng = random.Random(1)
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x370), 32, 10, 39])) for _ in range(300)) for _ in range(200)]
    texts += ["".join(chr(rng.randrange(0x260)) for _ in range(400)) for _ in range(200)]
    want = [model.encode(text, add_special_tokens=False).ids for text in texts]
    for text, ids, found in zip(texts, want, encode(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == ids, text[:50]
    monkeypatch.setattr(P, "WHOLE", 10)
    monkeypatch.setattr(P, "WINDOW", 7)
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want
    assert [i for t in range(0x250) for i in np.frombuffer(encode([chr(t) * 3])[0], "<u4")] == [i for t in range(0x250) for i in model.encode(chr(t) * 3, add_special_tokens=False).ids]


def test_forgotten_chunks(model, monkeypatch):
    monkeypatch.setattr(P, "KNOWN", 20)
    monkeypatch.setattr(P, "WINDOW", 7)
    encode = P.Encoder(FILE)
    for seed in range(5):
        assert np.frombuffer(encode([prose(seed, 60)])[0], "<u4").tolist() == model.encode(prose(seed, 60), add_special_tokens=False).ids


class _Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, model):
        self.model, self.given = model, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        return self.model.encode_batch_fast(texts, **options)


def test_new_chunks_are_encoded_together(model):
    texts = [" ".join(a + b + c for c in "abcdefghij") for a in "blmñs" for b in ("an", "éa", "<|", "ort")] + ["'s a 's  \n\n <|endoftext |> <| endoftext|>", "\n<|", "endoftext|>\n"]
    want = [model.encode(text, add_special_tokens=False).ids for text in texts]
    for divider, most in ((True, 0.05), (False, 1)):
        encode = P.Encoder(FILE)
        encode.model = counted = _Counted(encode.model)
        encode.divider = encode.divider if divider else None
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == want
        assert len(encode.known) > 150 and counted.given <= most * len(encode.known)


def test_dividers_do_not_run_together():
    def divider(*tokens, **options):
        return P._divider({i: tokenizers.AddedToken(t, special=True, normalized=False, **options) for i, t in enumerate(tokens)})

    assert divider("<a>") == (0, "<a>") and divider("aa", "<a>") == (1, "<a>")
    for tokens in [(), ("aa",), ("aba",), ("<a>", "<a>b"), ("<a>", "b<a>c"), ("<a", "a>")]:
        assert divider(*tokens) is None, tokens
    for option in ("lstrip", "rstrip", "single_word"):
        assert divider("<a>", **{option: True}) is None


def check(rows, docs, model, capacity):
    """Every document is there, cut as stated, and sequences have neither gaps nor too much; their number is returned."""
    expected = []
    for i, text in docs:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            expected.append((i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(expected, key=repr)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_awkward_documents(spark, model):
    docs = documents(spark)
    got = P.pack(docs, FILE, capacity=128)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(got.collect(), AWKWARD, model, 128)
    assert P.pack(docs.limit(0), FILE).count() == 0


def test_blocks_levels_and_islands(spark, model):
    rng = random.Random(2)
    docs = [(i, prose(i, rng.randrange(1, 60))) for i in range(700)]
    rows = P.pack(documents(spark, docs), FILE, capacity=256, block=64).collect()
    used = check(rows, docs, model, 256)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id >> 58 for r in rows}) > 1
    assert used <= 1.02 * -(-total // 256) + 1


def optimum(lengths, capacity):
    """Fewest bins, by trying every bin for every piece."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= lengths[i]}:
            k = rooms.index(r)
            go(i + 1, [*rooms[:k], r - lengths[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


def test_evolution_against_the_optimum():
    """Of cases where best-fit, largest first, takes a bin too many, evolution mends most."""
    mended = missed = 0
    for seed in range(150):
        rng = random.Random(seed)
        lengths = np.array([rng.randrange(15, 60) for _ in range(11)], np.int64)
        packings = [P.founded(lengths, 100, rng, 0.1 * i) for i in range(4)]
        after = P.evolved(lengths, packings, 100, rng, 200)[0]
        assert np.bincount(after, weights=lengths).max() <= 100 and set(after) == set(range(after.max() + 1))
        least = optimum(lengths.tolist(), 100)
        assert P.bound(lengths, 100) <= least <= after.max() + 1 <= packings[0].max() + 1
        if packings[0].max() + 1 > least:
            mended += after.max() + 1 == least
            missed += after.max() + 1 > least
    assert mended >= 4 and missed <= 1


def test_evolution_of_a_block():
    rng = random.Random(8)
    lengths = np.array([rng.randrange(500, 1100) for _ in range(3000)], np.int64)
    packings = [P.founded(lengths, 2048, rng, 0.05 * i) for i in range(4)]
    after = P.evolved(lengths, packings, 2048, rng, 60)[0]
    assert P.bound(lengths, 2048) <= after.max() + 1 < packings[0].max()


def test_children_are_packings():
    rng = random.Random(3)
    lengths = np.array([rng.randrange(1, 100) for _ in range(500)], np.int64)
    one, other = P.founded(lengths, 100, rng, 0.3), P.founded(lengths, 100, rng, 0.9)
    for child in (P.crossed(lengths, one, other, 100, rng), P.mutated(lengths, one, 100, rng)):
        fill = np.bincount(child, weights=lengths)
        assert len(child) == 500 and fill.max() <= 100 and fill.min() > 0
    bins = {frozenset(np.flatnonzero(other == b)) for b in range(other.max() + 1)}
    child = P.crossed(lengths, one, other, 100, rng)
    assert sum(frozenset(np.flatnonzero(child == b)) in bins for b in range(child.max() + 1)) >= 1


def test_empty_bins_go_to_the_next_level():
    lengths = np.array([100, 60, 40, 30, 100, 99], np.int64)
    of = np.array([0, 1, 1, 2, 3, 4])
    assert P.handed_on(lengths, of, 100).tolist() == [False, False, True, False, False]
