"""Small documents with what real ones go wrong with."""

from __future__ import annotations

import random

WORDS = "amber birch cedar delta ember fjord grove heron inlet jetty knoll ledge maple north ocean prism quartz ridge stone thicket".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


LONG = prose(99, 60_000)

#: (doc_id, text): nulls, empty and blank texts, repeated rows, a repeated id, a very long text.
AWKWARD = [
    (None, None), (1, None), (2, ""), (3, " \n\t"), (4, prose(1, 50)), (4, prose(1, 50)), (5, prose(1, 50).replace(" ", "\n")),
    (6, "Ünï cödé — 日本語 😀 x"), (7, LONG), (8, "a"), (9, "a b"), (9, prose(2, 40)), (None, prose(3, 30)), (10, prose(3, 30).upper()),
]


def documents(spark, rows=AWKWARD, slices: int = 3):
    """With extra columns named like what operators use inside or return."""
    full = [(i, t, "en", "src", None if t is None else len(t), "x", 1.5, True, "y", 7) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, host string, score double, kept boolean, _id string, fp long"
    return spark.createDataFrame(full, schema).repartition(slices)
