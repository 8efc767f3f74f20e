"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans (email, ip, card, phone) are what their patterns and checks accept; they always stay.
Further candidates (account numbers, local phone numbers, secrets, handles) come from looser
patterns.  Five labelers vote on every span, base ones included: its exact form, gazetteers of
domains, issuers and key words, the words before it, its surroundings, and the variety of its
characters.  Each says yes, no or nothing.

Expectation-maximisation then estimates, over all spans of the corpus, how often each labeler is
right and how common true spans are among the candidates of a kind.  It needs nothing but how
often each combination of kind, votes and length class occurs: Spark counts these, and
their number is bounded by the labelers, not by the corpus.  A logistic regression is trained on
the same counts with EM's posteriors as labels; its probability, as a column expression, admits
further spans from ``THRESHOLD`` on.

DataFrame functions only, one scan of the texts, no shuffle but the one of the counts.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.llm.tables import written

#: Kinds of base spans, in the order that breaks ties.
BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("account", "local_phone", "secret", "handle")
THRESHOLD = 0.5
#: Code points looked at before a span.
CONTEXT = 32
LABELERS = ("form", "gazetteer", "before", "around", "variety")

# A run of the leading class is tried from its start or from the end of the last match only, and
# possessively: long runs take linear time, and matches are those of the plain patterns.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of at least twelve digits; shorter ones cannot pass the check.
    "card": r"[0-9](?:[\x20-]?+[0-9]){11}(?:[\x20-]?+[0-9])*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9+(][\x20-]?)(?:\([0-9]{3}\)[\x20-]?|[0-9]{3}[\x20-])[0-9]{3}-[0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+",
    "handle": r"(?<![A-Za-z0-9._%+@-])@[A-Za-z0-9_]{3,30}(?![A-Za-z0-9_@.-])",
}
#: What a text must hold for a pattern to be worth trying.
_HINTS = {"email": "@", "ip": ".", "phone": "+", "handle": "@", "local_phone": "-"}

#: Gazetteers.
_DOMAINS = r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|uk|eu|co)$"
_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
_TOLL_FREE = r"(^|[^0-9])\(?(800|888|877|866|900)\)?[\x20-]"
_CUES = {
    "email": r"(?i)(mail|contact|kontakt|correo|courriel|write to)\W",
    "ip": r"(?i)(\bip\b|address|host|server|login|from)\W",
    "card": r"(?i)(card|visa|master|credit|karte|tarjeta|carte)\W",
    "phone": r"(?i)(phone|tel|call|fax|mobile|cell|telefon)\W",
    "account": r"(?i)(account|iban|konto|cuenta|compte|card|number|no\.)\W",
    "local_phone": r"(?i)(phone|tel|call|fax|mobile|cell|telefon)\W",
    "secret": r"(?i)(token|secret|passw|api.?key|\bkey|auth|credential)\w*[\"']?\s*[:=]?\s*[\"']?$",
    "handle": r"(?i)(follow|twitter|user|via|by)\W",
}


def _position_all(text: Column, pattern: str, hint: str | None) -> Column:
    """array<struct<start, end, value>> of all matches, in code points, end exclusive.

    The pieces between matches, together with the matches, add up to the text.
    """
    whole = f"({pattern})"
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    matches = F.regexp_extract_all(text, F.lit(whole), F.lit(1))
    paired = F.arrays_zip(matches.alias("match"), F.split(text, whole, -1).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["match"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["found"], span).alias("found"))

    found = F.aggregate(F.filter(paired, lambda p: p["match"].isNotNull()), start, step, lambda state: state["found"])
    possible = F.regexp_like(text, F.lit(whole))
    return F.when(F.contains(text, F.lit(hint)) & possible if hint else possible, found).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum of the decimal digits fits."""
    figures = F.transform(F.split(F.reverse(digits), ""), lambda c: F.try_to_number(c, F.lit("9")).cast("int"))
    doubled = F.transform(figures, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _small_part(part: Column) -> Column:
    """At most 255; leading zeros do not count."""
    plain = F.regexp_replace(part, "^0+", "")
    return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)


def _accepts(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, "\\."), _small_part)
    n = F.length(_digits(value))
    if kind == "phone":
        return n.between(9, 15)
    return n.between(12, 19) & _luhn(_digits(value))


def _votes(kind: str, span: Column, text: Column) -> Column:
    """The labelers' votes in base 3 (0 nothing, 1 no, 2 yes), the first labeler first."""
    value, digits = span["value"], _digits(span["value"])
    begin = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, begin + 1, span["start"] - begin)
    last, after = F.right(before, F.lit(1)), F.substring(text, span["end"] + 1, F.lit(1))

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 2).when(no, 1).otherwise(0)

    never = F.lit(False)
    form = {
        "email": vote(F.length(value) <= 64, F.length(value) > 128),
        "ip": vote(~F.regexp_like(value, F.lit(r"(^|\.)0[0-9]")), F.regexp_like(value, F.lit(r"(^|\.)0[0-9]"))),
        "card": vote(F.length(digits).between(13, 16), F.length(digits) > 16),
        "phone": vote(F.length(digits).between(10, 13), never),
        "account": vote(F.length(digits).isin(16), F.length(digits) > 22),
        "local_phone": vote(F.lit(True), never),
        "secret": vote(F.regexp_like(value, F.lit("[0-9]")) & F.regexp_like(value, F.lit("[A-Za-z]")), ~F.regexp_like(value, F.lit("[0-9]"))),
        "handle": vote(F.regexp_like(value, F.lit("[a-z]")), F.regexp_like(value, F.lit("^@[0-9]+$"))),
    }[kind]
    gazetteer = {
        "email": vote(F.regexp_like(value, F.lit(_DOMAINS)), never),
        "ip": vote(never, F.regexp_like(value, F.lit(r"^(0|127|255)\."))),
        "card": vote(F.regexp_like(digits, F.lit(_ISSUERS)), never),
        "phone": vote(never, F.regexp_like(value, F.lit(_TOLL_FREE))),
        "account": vote(F.regexp_like(digits, F.lit(_ISSUERS)), never),
        "local_phone": vote(never, F.regexp_like(value, F.lit(_TOLL_FREE))),
        "secret": vote(F.regexp_like(before, F.lit(_CUES["secret"])), F.regexp_like(before, F.lit(r"(?i)(https?:|www\.|/)\S*$"))),
        "handle": vote(never, F.regexp_like(value, F.lit(r"(?i)^@(media|import|param|return|override|charset)$"))),
    }[kind]
    context = vote(F.regexp_like(before, F.lit(_CUES[kind])), never)
    glued = F.regexp_like(last, F.lit(r"[A-Za-z0-9_/.]")) | F.regexp_like(after, F.lit(r"[A-Za-z0-9_/]"))
    around = vote(~glued, glued)
    kinds_of = F.size(F.array_distinct(F.split(F.lower(value), "")))
    variety = vote(kinds_of >= 6, kinds_of <= 3)
    return reduce(lambda code, v: code * 3 + v, (form, gazetteer, context, around, variety), F.lit(0)).cast("int")


def _length_class(value: Column) -> Column:
    return F.when(F.length(value) < 12, 0).when(F.length(value) < 20, 1).when(F.length(value) < 36, 2).otherwise(3)


def _find(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id and ``found``: spans with start, end, kind (a number), votes and length class, and whether they are base spans."""
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(doc_id).alias("doc_id"), body.alias("_text"))

    def accepted(kind: str):
        return lambda s: _accepts(kind, s["value"])

    docs = docs.select("*", *(_position_all(F.col("_text"), p, _HINTS.get(k)).alias(f"_{k}") for k, p in _PATTERNS.items()))
    for kind in BASE_KINDS:
        if kind == "card":
            # Runs of digits that are no card may still be account numbers.
            docs = docs.withColumn("_account", F.filter("_card", lambda s: F.length(_digits(s["value"])).between(12, 24) & ~_accepts("card", s["value"])))
        docs = docs.withColumn(f"_{kind}", F.filter(f"_{kind}", accepted(kind)))

    def voted(number: int, kind: str) -> Column:
        def entry(s: Column) -> Column:
            return F.struct(
                s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), F.lit(kind in BASE_KINDS).alias("base"),
                _votes(kind, s, F.col("_text")).alias("votes"), _length_class(s["value"]).alias("length"),
            )

        return F.transform(f"_{kind}", entry)

    kinds = (*BASE_KINDS, *EXTRA_KINDS)
    docs = docs.select("doc_id", *(voted(i, k).alias(f"_{k}") for i, k in enumerate(kinds)))
    base, extra = (F.concat(*(F.col(f"_{k}") for k in some)) for some in (BASE_KINDS, EXTRA_KINDS))
    docs = docs.select("doc_id", base.alias("_base"), extra.alias("_extra"))
    free = F.filter("_extra", lambda e: ~F.exists("_base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))
    return docs.select("doc_id", F.array_sort(F.concat("_base", free)).alias("found"))


def _trits(code: int) -> list[int]:
    out = []
    for _ in LABELERS:
        code, trit = divmod(code, 3)
        out.append(trit - 1 if trit else None)  # None: nothing, 0: no, 1: yes
    return out[::-1]


def estimate(patterns: list[tuple[int, int, int]], rounds: int = 50) -> tuple[list[float], dict[int, float], list[float]]:
    """EM over (kind, votes, count): the labelers' reliabilities, true shares by kind, a posterior each.

    Labelers are taken as independent given the truth.  Reliabilities begin at 0.8, shares at
    one half; a weak prior of two imagined spans keeps all of them inside (0, 1).
    """
    votes = [_trits(code) for _, code, _ in patterns]
    reliable, share = [0.8] * len(LABELERS), {kind: 0.5 for kind, _, _ in patterns}
    posterior = [0.5] * len(patterns)
    for _ in range(rounds):
        for i, (kind, _, _) in enumerate(patterns):
            yes, no = share[kind], 1 - share[kind]
            for vote, r in zip(votes[i], reliable, strict=True):
                if vote is not None:
                    yes *= r if vote else 1 - r
                    no *= 1 - r if vote else r
            posterior[i] = yes / (yes + no)
        for j in range(len(LABELERS)):
            right = said = 0.0
            for (_, _, n), vote, p in zip(patterns, votes, posterior, strict=True):
                if vote[j] is not None:
                    said += n
                    right += n * (p if vote[j] else 1 - p)
            # A labeler is assumed to be right more often than wrong, or truth and error could swap.
            reliable[j] = max(0.5, (right + 1.6) / (said + 2))
        for kind in share:
            own = [(n, p) for (k, _, n), p in zip(patterns, posterior, strict=True) if k == kind]
            share[kind] = (sum(n * p for n, p in own) + 1) / (sum(n for n, _ in own) + 2)
    return reliable, share, posterior


def _features(kind: int, votes: int, length: int) -> list[int]:
    """Indices of the features that are on: the kind, the length class, and each labeler's yes or no."""
    n_kinds = len(BASE_KINDS) + len(EXTRA_KINDS)
    said = [n_kinds + 4 + 2 * j + v for j, v in enumerate(_trits(votes)) if v is not None]
    return [kind, n_kinds + length, *said]


def train_classifier(patterns: list[tuple[int, int, int, int]], posterior: list[float], rounds: int = 200) -> list[float]:
    """Weights of a logistic regression on (kind, votes, length, count) towards the posteriors."""
    weights = [0.0] * (len(BASE_KINDS) + len(EXTRA_KINDS) + 4 + 2 * len(LABELERS))
    squares = [1e-6] * len(weights)
    on = [_features(kind, votes, length) for kind, votes, length, _ in patterns]
    total = sum(n for *_, n in patterns) or 1
    for _ in range(rounds):
        gradient = [1e-4 * w for w in weights]
        for (*_, n), features, p in zip(patterns, on, posterior, strict=True):
            error = n / total * (1 / (1 + math.exp(-sum(weights[f] for f in features))) - p)
            for f in features:
                gradient[f] += error
        for f, g in enumerate(gradient):
            squares[f] += g * g
            weights[f] -= 0.5 * g / math.sqrt(squares[f])
    return weights


def _probability(span: Column, weights: list[float]) -> Column:
    n_kinds = len(BASE_KINDS) + len(EXTRA_KINDS)
    table = F.array(*(F.lit(float(w)) for w in weights))
    margin = F.get(table, span["kind"]) + F.get(table, F.lit(n_kinds) + span["length"])
    for j in range(len(LABELERS)):
        trit = F.floor(span["votes"] / (3 ** (len(LABELERS) - 1 - j))).cast("int") % 3
        margin = margin + F.when(trit > 0, F.get(table, F.lit(n_kinds + 4 + 2 * j - 1) + trit)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-margin))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in (*BASE_KINDS, *EXTRA_KINDS)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, details.

    The counts and ``base_sha256`` are of base spans, written ``kind:start:end`` in order of start,
    then kind, comma-joined (the digest of the empty string where there are none); ``spans`` lists
    base spans and those the classifier adds, in the same form; ``details`` has each with its
    probability.  Additional spans do not overlap base ones.  A null text is empty; repeated
    rows are rows like any other; without any span there is nothing to learn and nothing is
    added.  Other columns are not looked at.
    """
    found = written(_find(docs, doc_id, text))
    span = found.select(F.explode("found").alias("s"))
    counted = span.groupBy("s.kind", "s.votes", "s.length").agg(F.count(F.lit(1)).alias("n"))
    # At most kinds x 3**labelers x length classes rows, whatever the corpus.
    rows = sorted(tuple(r) for r in counted.collect())
    _, _, posterior = estimate([(kind, votes, n) for kind, votes, _, n in rows])
    weights = train_classifier(rows, posterior)
    judged = F.transform("found", lambda s: F.struct(*(s[c].alias(c) for c in ("start", "kind", "end", "base")), _probability(s, weights).alias("probability")))
    kept = found.select("doc_id", F.filter(judged, lambda s: s["base"] | (s["probability"] >= THRESHOLD)).alias("_all"))
    kept = kept.withColumn("_base", F.filter("_all", lambda s: s["base"]))
    names = F.array(*(F.lit(k) for k in (*BASE_KINDS, *EXTRA_KINDS)))

    def number(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    def detail(s: Column) -> Column:
        return F.struct(F.get(names, s["kind"]).alias("kind"), *(s[c].alias(c) for c in ("start", "end", "probability")))

    return kept.select(
        "doc_id",
        *(number(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)),
        F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("_all")).alias("spans"),
        F.transform("_all", detail).alias("details"),
    )
