from __future__ import annotations

import hashlib
import re
from collections import Counter
from datetime import datetime, timezone
from urllib.parse import quote

import pytest
import zstandard
from pyspark.sql import functions as F

from matrixlens.llm import personal_data as pii, warc
from matrixlens.llm.perspectives import rotate_perspectives
from matrixlens.llm.queries import URL_RULES, op3_url_filters, op4_personal_data, op7_chat_perspectives
from matrixlens.llm.url_filter import filter_urls
from tests.llm.cases import AWKWARD, documents, prose

SF_DIR = "/root/testdata/sf0.001"


def test_no_python_in_native_operators(spark):
    for query in (op3_url_filters, op4_personal_data, op7_chat_perspectives):
        plan = query(spark, SF_DIR)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# -- URL rules -----------------------------------------------------------------------------

URLS = [
    (1, "http://a.example.org/es/x"), (2, "https://example.org/en/12?q#f"), (3, "HTTP://B.Example.ORG/En/1"), (4, "http://other.com/de/"), (5, "http://other.com/fr/"),
    (6, None), (7, ""), (8, "no scheme/es/"), (9, "http://example.org"), (10, "http://notexample.org/es/"), (11, "http://example.org?x=/es/"), (12, "://org/"),
    (12, "://org/"), (13, "http:///org/"), (14, "http://example.org./es/"), (15, "x://y://example.org/es/"), (None, "http://a.b.c.com/de/é"), (16, "http://..org//"),
    (17, "http://user@example.org/es/"), (18, "http://example.org:80/es/"), (19, "http://ÀB.org/" + "x" * 100_000), (20, "http://" + "a." * 20_000 + "org/y"),
]


def judged(url, rules, default="allow"):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


@pytest.mark.parametrize("rules", [URL_RULES, [*URL_RULES, ("org", "/", "block"), ("c.com", "", "allow"), ("b.example.org", "/En/", "allow"), (None, "/", "block")], []])
def test_url_rules(spark, rules):
    pages = spark.createDataFrame([(i, u, "h", "p", "r") for i, u in URLS], "page_id long, url string, host string, path string, _head string")
    got = filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    usable = [r for r in rules if r[0]]
    assert Counter(map(tuple, got.collect())) == Counter((i, *judged(u, usable)) for i, u in URLS)
    assert filter_urls(pages.limit(0), spark.createDataFrame(URL_RULES, "host string, path string, verdict string")).count() == 0


# -- perspectives --------------------------------------------------------------------------


def rendered(turns, speaker):
    text, spans = "", []
    for role, said in turns:
        said = said.replace("<|", "< |")
        head = "<|assistant|>\n" if role == speaker else "<|system|>\n" if role == "system" else f"<|user name={role}|>\n"
        if role == speaker:
            spans.append(f"{len(text + head)}-{len(text + head + said) + 7}")
        text += f"{head}{said}<|end|>\n"
    return text, ",".join(spans)


def test_every_participant_gets_the_dialogue(spark):
    turns = [
        (1, 0, "system", "Be kind.", "x"), (1, 1, "ann", "Hello <|end|>", "x"), (1, 2, "bob", "Hi 😀", "x"), (1, 3, "cy", None, "x"), (1, 3, "cy", None, "x"),
        (2, 0, None, "who", "x"), (2, 1, "ann", "me", "x"), (3, 0, "system", "alone", "x"), (None, 0, "ann", "lost", "x"), (4, None, "ann", "late", "x"), (4, 1, "bob", "first", "x"),
        (5, 2, "bob", "b", "x"), (5, 2, "ann", "a", "x"), (6, 0, "ann", "", "x"),
    ]
    turns += [(7, 1, "ann", "ok", "x")] * 3 + [(7, None, "ann", "ok", "x")] * 2 + [(None, None, "ann", "ok", "x")] * 12 + [(8, 1, "ann", "long " * 100_000, "x")]
    for size in (1024, 8, 3):
        names = "conv_id long, turn long, role string, text string, part string, _conv string, _at int, _n int"
        got = rotate_perspectives(spark.createDataFrame([(*t, "c", 1, 2) for t in turns], names), size=size)
        assert got.columns == ["conv_id", "perspective", "part", "n_turns", "text", "mask"]
        want = {}
        for conv in {t[0] for t in turns}:
            own = sorted((t[1] is not None, t[1] or 0, t[2] or "unknown", t[3] or "") for t in turns if t[0] == conv)
            for part in range(-(-len(own) // size)):
                said = [(role, text) for *_, role, text in own[part * size : (part + 1) * size]]
                for speaker in {role for *_, role, _ in own} - {"system"}:
                    want[conv, speaker, part] = (len(said), *rendered(said, speaker))
        rows = got.collect()
        assert {(r.conv_id, r.perspective, r.part): (r.n_turns, r.text, r.mask) for r in rows} == want and len(rows) == len(want)
    assert got.limit(0).count() == 0


def test_long_and_crowded_conversations_are_split_without_loss(spark):
    turns = [(1, i, "ab"[i % 2], f"t{i:02}") for i in range(50)] + [(2, 7, "ab"[i % 2], f"same {i:02}") for i in range(50)] + [(None, None, "ab"[i % 2], f"x{i % 5}") for i in range(40)]
    rows = rotate_perspectives(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), size=8).collect()
    assert max(r.n_turns for r in rows) == 8 and sum(r.n_turns for r in rows) == 2 * len(turns)
    for conv in (1, 2, None):
        for speaker in "ab":
            own = sorted((r.part, r.text) for r in rows if (r.conv_id, r.perspective) == (conv, speaker))
            said = re.findall(r"\|>\n(.*?)<\|end\|>", "".join(t for _, t in own))
            assert said == [t for *_, t in sorted((t[1] or 0, t[2], t[3]) for t in turns if t[0] == conv)]
    assert rotate_perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# -- WARC ----------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    page = prose(1, 400)
    pages = [(1, page), (2, page), (9, page), (3, "short"), (4, "short"), (5, None), (6, ""), (None, page), (None, "é\r\n\r\nWARC/1.1\r\n"), (7, "x" * 999), (8, "x" * 999), (10, "y" * 1000), (11, "y" * 1000)]
    pages += [(100 + i, prose(200 + i, 300)) for i in range(60)] + [(12, page), (12, page), (13, prose(5, 30_000))]
    df = spark.createDataFrame([(i, "u", h, "d", 0) for i, h in pages], "page_id long, url string, html string, payload_digest string, refers_to int").repartition(3)
    got = warc.archive_round_trip(df)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = Counter()
    for i, h in pages:
        raw = (h or "").encode()
        last = max([j for j, g in pages if j is not None and g == h] or [None], key=lambda j: j or 0)
        older = len(raw) >= 1000 and last is not None and i != last
        want[(i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if older else "response", last if older else None)] += 1
    assert Counter(map(tuple, got.collect())) == want
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_archives_are_plain_zstandard_with_a_leading_dictionary(spark, tmp_path):
    df = spark.createDataFrame([(i, prose(i, 200)) for i in range(80)], "page_id long, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"))
    (file,) = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-") and f.stat().st_size > 100]
    raw = file.read_bytes()
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_FRAME
    n = int.from_bytes(raw[4:8], "little")
    assert n > 256
    trained = zstandard.ZstdCompressionDict(raw[8 : 8 + n])
    frames = [f for f in raw[8 + n :].split(warc.EMPTY_FRAME.encode()) if f]
    one = zstandard.ZstdDecompressor(dict_data=trained).decompress(frames[5])
    assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n")
    damaged = bytearray(raw)
    damaged[-20] ^= 1
    with pytest.raises((zstandard.ZstdError, ValueError, KeyError)):
        for fields, content in warc._records(bytes(damaged)):
            if hashlib.sha1(content).hexdigest().encode() != fields[b"WARC-Payload-Digest"][5:]:
                raise ValueError("damaged")


def test_records_have_the_fields_the_format_requires(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    page, urls = prose(3, 500), ["http://a.example/x", "http://b.example/a b\r\nWARC-Type: x", "", None]
    rows = [(i, urls[i % 4], page if i % 10 < 2 else prose(i, 300)) for i in range(100)] + [(91, urls[3], page)] * 2 + [(None, None, page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, str(tmp_path / "w"), date=datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc))
    files = [f.read_bytes() for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert len(files) > 3 and all(len(f) < 20_000 + 5_000 for f in files)
    found = [(fields, content) for f in files for fields, content in warc._records(f)]
    assert len(found) == len(rows)
    ids = {fields[b"WARC-Record-ID"]: fields for fields, _ in found}
    assert len(ids) == len(rows)  # each its own, repeated rows too
    by_id = {}
    for fields, content in found:
        assert fields[b"WARC-Date"] == b"2024-05-06T07:08:09Z" and fields[b"WARC-Type"] in (b"response", b"revisit")
        page_id = fields.get(b"X-Page-ID")
        given = urls[int(page_id) % 4] if page_id and int(page_id) < 91 else None
        assert fields[b"WARC-Target-URI"] == (quote(given, safe=warc._URI_SAFE).encode() if given else fields[b"WARC-Target-URI"])
        assert re.fullmatch(rb"[a-z]+:[!-~]+", fields[b"WARC-Target-URI"])
        if fields[b"WARC-Type"] == b"revisit":
            original = ids[fields[b"WARC-Refers-To"]]
            assert original[b"WARC-Type"] == b"response" and original[b"X-Page-ID"] == fields[b"X-Refers-To-Page-ID"] == b"91"
        else:
            assert hashlib.sha1(content).hexdigest().encode() == fields[b"WARC-Payload-Digest"][5:]
            by_id[page_id] = content
    assert by_id[b"91"] == page.encode()


@pytest.mark.parametrize("rows", [[(1, "")], [(1, "x")], [(i, "") for i in range(40)], [(1, "y" * 3_000_000)]])
def test_every_archive_has_a_dictionary(spark, tmp_path, rows):
    """Few, empty and huge pages too, where none can be trained."""
    warc.write_archives(spark.createDataFrame(rows, "page_id long, html string").coalesce(1), str(tmp_path / "w"))
    (file,) = [f.read_bytes() for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert int.from_bytes(file[:4], "little") == warc.DICTIONARY_FRAME and int.from_bytes(file[4:8], "little") > 100
    assert sorted(content.decode() for _, content in warc._records(file)) == sorted(html for _, html in rows)


# -- personal data -------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if good[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


SAMPLES = [
    "a@b.cd%x@y.zz and me@a.b. then x@y.z@q.com or 123456789012@x.com", "1.2.3.4.5.6.7.8 00.1.2.3 300.1.1.1 1.2.3.4.55555 999999999999999999999.1.1.1",
    "4111 1111 1111 1111, é4111-1111-1111-1111 💡 4111111111111112 12345678901234567890123", "+1 (555) 123-4567 +12 345 6789 0123 45 6 7 +49-89-123456-  +1",
    "a" * 60_000 + "@b.c", "1" * 60_000, "1 " * 20_000, "+1 " * 3_000, "+" + "1 " * 20_000, "a@b.c " * 2_000, "@" * 5_000, "4111111111111111 " * 3,
]


def test_personal_data_against_plain_patterns(spark):
    rows = [*AWKWARD, *((50 + i, t) for i, t in enumerate(SAMPLES)), *((70 + i, f'{prose(i, 8)} token = "2aeb8253858bf047bc9bb976166a40ef87db38b{i % 10}" ok') for i in range(30))]
    got = pii.personal_data(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows if i is not None}
    added = Counter()
    for r in got:
        if r.doc_id is None:
            continue
        base = base_spans(texts[r.doc_id]) if r.doc_id != 9 else []
        listed = [f"{kind}:{a}:{b}" for a, _, b, kind in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in base) for kind in PLAIN]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if s.split(":")[0] in PLAIN] == listed
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
        added.update(s.split(":")[0] for s in spans if s.split(":")[0] not in PLAIN)
    assert added["secret"] >= 30
    assert pii.personal_data(documents(spark).limit(0)).count() == 0
    assert pii.personal_data(documents(spark)).where("spans != ''").count() == 0


def test_em_recovers_reliabilities():
    import random

    rng = random.Random(0)
    rates, counts = [0.95, 0.9, 0.7, 0.8, 0.6], Counter()
    for _ in range(20_000):
        truth, code = rng.random() < 0.6, 0
        for rate in rates:
            said = truth if rng.random() < rate else not truth
            code = code * 3 + (0 if rng.random() < 0.2 else 1 + said)
        counts[code] += 1
    reliable, share, posterior = pii.estimate([(0, code, n) for code, n in sorted(counts.items())])
    assert reliable == pytest.approx(rates, abs=0.05) and share[0] == pytest.approx(0.6, abs=0.03)
    weights = pii.train_classifier([(0, code, 1, n) for code, n in sorted(counts.items())], posterior)
    assert len(weights) == 8 + 4 + 10 and weights[13] > 0 > weights[12]


def test_folds(spark):
    from matrixlens.llm.tables import in_fold

    got = spark.range(50).select("id", in_fold("id", 5, 1).alias("held")).where(F.col("held")).collect()
    import zlib

    assert {r.id for r in got} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1}
