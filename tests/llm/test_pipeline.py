from __future__ import annotations

import hashlib
import importlib
import re
import sys

import pytest
import sentencepiece

import corpus_pipeline
from matrixlens.llm.queries import PIECE_MODEL
from tests.llm.cases import prose
from tests.llm.test_dedup import plain, slow_groups
from tests.llm.test_text_operators import slow_matches

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of a small corpus with planted copies, leaks and junk."""
    out = tmp_path_factory.mktemp("corpus")
    good = [(i, prose(i, 120)) for i in range(200)]
    junk = [(1000 + i, prose(i + 500, 120).replace(" ", "### ")) for i in range(100)]
    items = [(i, prose(3000 + i, 40)) for i in range(10)]
    copies = [(2000 + i, good[i][1].replace(" ", "  ")) for i in range(20)] + [(2100, prose(7, 900))]
    near = [(2200 + i, " ".join([*prose(7, 900).split()[:-1], f"last{i}"])) for i in range(5)]
    leaks = [(2300 + i, f"{prose(4000 + i, 90)} {items[i][1]} {prose(5000 + i, 90)}") for i in range(10)]
    rows = [*good, *junk, *copies, *near, *leaks, (5000, None), (5001, ""), (None, prose(6000, 100)), (50, good[50][1])]
    docs = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out), rows, items


def test_stages(spark, folder):
    sf, rows, items = folder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, [(r.doc_id, r.text) for r in docs.collect()]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding and decoding",
    ]
    for (name, stage), last in zip(corpus_pipeline.STAGES, (False, False, False, False, True), strict=True):
        docs = stage(spark, docs, sf)
        if last:
            break
        assert docs.columns == columns
        after = [(r.doc_id, r.text) for r in docs.collect()]
        ids = {i for i, _ in after}
        if name == "quality classifier":
            assert not [i for i in ids if i is not None and 1000 <= i < 2000]
            assert {i for i, t in before if t and i is not None and not 1000 <= i < 2000} <= ids
        elif name == "exact dedup":
            assert sorted(map(plain, (t for _, t in after))) == sorted({plain(t) for _, t in before})
        elif name == "SimHash near-dedup":
            want = [(None if lacks else i, t) for lacks, i, _, t in slow_groups(before)]
            assert sorted(after, key=repr) == sorted(want, key=repr) and len(after) < len(before)
        else:
            bad = {i for i, _ in slow_matches(before, items)}
            assert len(bad) == 10 and sorted(ids, key=repr) == sorted({i for i, _ in before} - bad, key=repr)
        before = after
    sp = sentencepiece.SentencePieceProcessor(model_file=str(PIECE_MODEL))
    got = {r.doc_id: r for r in docs.collect()}
    assert set(got) == {i for i, _ in before}
    for i, t in before:
        assert list(got[i].ids) == sp.encode(t or "") and got[i].decoded == (t or "") and got[i].n_tokens == len(got[i].ids)


def test_run(spark):
    first = corpus_pipeline.run(spark, SF_DIR)
    again = corpus_pipeline.run(spark, SF_DIR)
    digest = [hashlib.sha256(repr(sorted(map(tuple, df.select("doc_id", "n_tokens", "ids").collect()))).encode()).hexdigest() for df in (first, again)]
    assert digest[0] == digest[1] and first.count() > 0


@pytest.mark.parametrize("missing", ["sentencepiece", "matrixlens.llm.queries"])
def test_entry_without_a_dependency(monkeypatch, missing):
    import __spark_entry__ as entry

    full = entry.queries()
    assert {re.match(r"op(\d+)_", name)[1] for name in full if name.startswith("op")} == {str(n) for n in range(1, 14)}
    kept = {name: module for name, module in sys.modules.items()}
    for name in kept:
        if name.startswith("matrixlens.llm.") or name == "corpus_pipeline":
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.delattr("matrixlens.llm.queries")
    monkeypatch.setitem(sys.modules, missing, None)
    try:
        importlib.reload(entry)
        assert set(entry.queries()) == {name for name in full if name != "pipeline" and not re.match(r"op\d", name)}
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
    assert set(entry.queries()) == set(full)
