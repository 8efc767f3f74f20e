"""Globs, names and positions, nested paths."""

from __future__ import annotations

import fnmatch
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from matrixlens import Document
from matrixlens.functions.globs import glob_grams, glob_to_regex, literal_runs, select_names
from matrixlens.functions.nested import nested_value
from matrixlens.operators import selection
from matrixlens.operators.selection import arrays_to_columns, first_positions, match_names, unmatched_patterns

ITEMS = ["2019 spring", "2019 autumn", "2020 spring", "wind.north", "wind.east", "wind-east", "Snow", "snow", "[draft]", ""]
ALPHABET = "ab-]![^&\\.*?{}\n|~éB"


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(list(enumerate(ITEMS)), "_pos int, _index string")


def expected(patterns):
    """By the standard library: hits in pattern order then item order, and what hits nothing."""
    hits = [[i for i in ITEMS if fnmatch.fnmatchcase(i, p)] for p in patterns]
    return list(dict.fromkeys(i for h in hits for i in h)), [p for p, h in zip(patterns, hits, strict=True) if not h]


CASES = [
    ["*spring"], ["snow", "S*", "s*"], ["wind?east", "wind.*", "2019*"], ["[[]*", "*]"], ["????", "Snow"], ["", "*"], ["[!0-9]*t", "fog*", "hail"],
    ["hail", "fog"], ["20[12][09] *", "2020 spring"], [],
]


@pytest.mark.parametrize("inline", [True, False])
@pytest.mark.parametrize("patterns", CASES)
def test_patterns(names, monkeypatch, patterns, inline):
    if not inline:
        monkeypatch.setattr(selection, "INLINE_PATTERNS", 0)
    matched, unmatched = expected(patterns)
    assert select_names(ITEMS, patterns) == (matched, unmatched)
    if patterns:
        rows = match_names(names, patterns).orderBy("pattern_no", "position").collect()
        assert [r["name"] for r in rows] == matched
        left = unmatched_patterns(names, patterns).orderBy("pattern_no").collect()
        assert [r["pattern"] for r in left] == unmatched


def test_grams_find_whatever_matches(spark, monkeypatch):
    """Every kind of glob over odd names, against the standard library."""
    monkeypatch.setattr(selection, "INLINE_PATTERNS", 0)
    rng = random.Random(11)
    letters = "ab\u00e9\U0001f600.\x02\x03-"
    items = ["", "a", "ab", "aab", "*", "a*b", "[a]", "\x02", "\x03a\x02", *("".join(rng.choices(letters, k=rng.randrange(9))) for _ in range(150)), None]
    patterns = ["*", "?", "???", "**", "?*", "a?", "*a", "*ab*", "[!a]*", "[a-b]", "[", "[]a]b", "a[*]b", "*\x03", "\x02*", "zzz*", "*zzz*"]
    patterns += ["".join(rng.choices([*letters, "*", "*", "?", "[ab]", "[!a]"], k=rng.randrange(1, 6))) for _ in range(150)]
    patterns += patterns[:20]
    names = spark.createDataFrame(list(enumerate(items)), "_pos long, _index string")
    matched, unmatched = select_names([i for i in items if i is not None], patterns)
    rows = match_names(names, patterns).orderBy("pattern_no", "position").collect()
    assert [r["name"] for r in rows] == matched
    assert [r["pattern"] for r in unmatched_patterns(names, patterns).orderBy("pattern_no").collect()] == unmatched
    assert match_names(names.limit(0), patterns).count() == 0


def test_a_glob_meets_few_names(spark):
    """Globs without a literal head do not meet all names."""
    names = spark.range(20_000).select(F.col("id").alias("position"), F.format_string("item_%05d", "id").alias("name"))
    globs = [(i, f"*{i:04d}") for i in range(0, 2000, 10)] + [(5000 + i, f"*_1{i:03d}?") for i in range(100)]
    hits = selection._by_grams(names, globs)
    assert hits.count() == 2 * 200 + 10 * 100
    joined = hits._jdf.queryExecution().optimizedPlan().toString()
    met = hits.sparkSession.createDataFrame([(g, r) for g, r in ((p, literal_runs(p)) for _, p in globs)], "glob string, runs array<string>")
    said = {r["glob"]: set(r["grams"]) for r in met.select("glob", glob_grams(F.col("runs")).alias("grams")).collect()}
    assert said["*0010"] == {"001", "010", "10\x03"} and "RLIKE" in joined.upper() and "CartesianProduct" not in joined


def test_thousands_of_patterns(spark):
    names = spark.range(3000).select(F.col("id").alias("_pos"), F.concat(F.lit("n"), F.col("id")).alias("_index"))
    patterns = [p for i in range(1700) for p in (f"n{i}?", f"x{i}*", f"n{2 * i}")]
    first = {}
    for name in (f"n{i}" for i in range(3000)):
        i = int(name[1:])
        hits = [3 * (i // 10)] * (i >= 10 and i // 10 < 1700) + [3 * (i // 2) + 2] * (i % 2 == 0 and i // 2 < 1700)
        if hits:
            first[name] = min(hits)
    assert {r["name"]: r["pattern_no"] for r in match_names(names, patterns).collect()} == first
    assert unmatched_patterns(names, patterns).filter("pattern LIKE 'x%'").count() == 1700


@settings(max_examples=500, deadline=None)
@given(st.text(ALPHABET, max_size=6), st.text(ALPHABET, max_size=4))
def test_globs_mean_what_the_standard_library_says(pattern, item):
    assert (select_names([item], [pattern])[0] == [item]) == fnmatch.fnmatchcase(item, pattern)


def test_globs_mean_the_same_in_the_jvm(spark):
    patterns = ["[a-]x", "[]a]", "[!]a]", "a.b", "a\\d", "[[]*", "[z-a]", "[!z-a]", "*\n", "a&&b", "[a&&b]", "é?", "[^a]", "{a}", "[", "a[", "[\\]", "???"]
    items = ["ax", "-x", "]", "a", "b", "a.b", "acb", "a\\d", "a1", "[a", "x\n", "x", "a&&b", "&", "éa", "^", "{a}", "[", "a[", "\\", "abc", "a\nb"]
    table = spark.createDataFrame([(i,) for i in items], "item string")
    checked = table.select("item", *[F.col("item").rlike(glob_to_regex(p)).alias(f"m{k}") for k, p in enumerate(patterns)])
    for row in checked.collect():
        for k, pattern in enumerate(patterns):
            assert row[f"m{k}"] == fnmatch.fnmatchcase(row["item"], pattern), (row["item"], pattern)


def test_repeated_names_use_the_first_position(spark):
    df = spark.createDataFrame([(5, "a"), (2, "b"), (1, "a"), (0, "c")], "_pos int, _index string")
    assert {r["name"]: r["position"] for r in first_positions(df).collect()} == {"a": 1, "b": 2, "c": 0}
    rows = match_names(df, ["b", "[ac]"]).orderBy("pattern_no", "position").collect()
    assert [(r["name"], r["position"]) for r in rows] == [("b", 2), ("c", 0), ("a", 1)]


def test_array_block_as_table(spark):
    block = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "row_pos int, values array<double>")
    table = arrays_to_columns(block, ["a", "b"])
    assert table.columns == ["row_pos", "a", "b"]
    assert [tuple(r) for r in table.orderBy("row_pos").collect()] == [(0, 1.0, 2.0), (1, 3.0, 4.0)]
    with pytest.raises(ValueError, match="1 names for 2 columns"):
        arrays_to_columns(block, ["a"])


def test_nested_documents(spark):
    doc = Document.of(spark, {"station": {"id": 12, "at": {"lat": 51.5}}, "tags": ["new", "wet"], "o'clock": 7, 'the "gate"': None})

    def text(*keys):
        return doc.at(list(keys)).text().first()[0]

    assert [text("station", "id"), text("station", "at", "lat"), text("tags", 0), text("o'clock")] == ["12", "51.5", "new", "7"]
    assert text("station", "at") == '{"lat":51.5}'
    assert doc.at([]) is doc
    for path in (["gate"], ["station", "name"], ["station", "id", "x"], ["tags", 9]):
        with pytest.raises(KeyError, match="nothing at key path " + " -> ".join(map(str, path))):
            doc.at(path)
    entries = {r["key"]: r["type"] for r in doc.entries().collect()}
    assert set(entries) == {"station", "tags", "o'clock", 'the "gate"'} and entries["o'clock"] == "BIGINT"


def test_nested_columns(spark):
    df = spark.sql(
        """SELECT named_struct('m', map('k', array(1, 2))) AS s, '{"a": {"b": 7}}' AS j, 'no json' AS bad, parse_json('{"v": "w"}') AS v"""
    )
    kinds = {f.name: f.dataType for f in df.schema}

    def value(name, keys, as_type):
        return df.select(nested_value(F.col(name), kinds[name], keys, as_type)).first()[0]

    assert value("s", ["m", "k", 1], "int") == 2
    assert value("s", ["m", "absent", 1], "int") is None
    assert value("j", ["a", "b"], "int") == 7
    assert value("bad", ["a"], "int") is None
    assert value("v", ["v"], "string") == "w"
    with pytest.raises(KeyError, match="nothing at key path zzz"):
        value("s", ["zzz"], "int")
