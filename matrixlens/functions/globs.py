"""Shell globs as anchored regular expressions for ``Column.rlike``."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# `*`, `?`, a complete bracket set, or any single character.
_PIECE = re.compile(r"\*|\?|\[(?P<negated>!?+)(?P<members>\][^\]]*|[^\]]+)\]|.", re.S)
_MEMBER = re.compile(r"(?P<low>.)-(?P<high>.)|.", re.S)

#: Marks around a name, and the characters in a run by which names are found.
BEGIN, END, GRAM = "\x02", "\x03", 3


def _code(char: str) -> str:
    """One literal character, written so that it is never a metacharacter."""
    return char if char.isalnum() and char.isascii() else rf"\x{{{ord(char):x}}}"


def _bracket_set(members: str, negated: bool) -> str:
    parts = []
    for m in _MEMBER.finditer(members):
        if m["low"] is None:
            parts.append(_code(m[0]))
        elif m["low"] <= m["high"]:
            parts.append(f"{_code(m['low'])}-{_code(m['high'])}")
    if not parts:  # only empty ranges such as [z-a]
        return "." if negated else "(?!)"
    return f"[{'^' if negated else ''}{''.join(parts)}]"


def glob_to_regex(pattern: str) -> str:
    """Translate ``* ? [seq] [!seq]`` into a whole-string, case-sensitive regex."""
    parts = []
    for m in _PIECE.finditer(pattern):
        if m[0] == "*":
            parts.append(".*")
        elif m[0] == "?":
            parts.append(".")
        elif m["members"] is not None:
            parts.append(_bracket_set(m["members"], bool(m["negated"])))
        else:
            parts.append(_code(m[0]))
    return rf"(?s)\A{''.join(parts)}\z"


def is_plain(pattern: str) -> bool:
    """True if the pattern can only match its own text."""
    return not any(c in pattern for c in "*?[")


def literal_runs(pattern: str) -> list[str]:
    """Texts that every match holds, once it is put between ``BEGIN`` and ``END``: the pattern's runs of literal characters."""
    runs = [BEGIN]
    for m in _PIECE.finditer(pattern):
        if m[0] in ("*", "?") or m["members"] is not None:
            runs.append("")
        else:
            runs[-1] += m[0]
    runs[-1] += END
    return [run for run in runs if run]


def grams(text: Column, size: Column | int) -> Column:
    """The runs of ``size`` characters of a text, in order; none if it is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    none = F.array().cast("array<string>")
    return F.when(F.length(text) >= size, F.transform(starts, lambda at: F.substring(text, at, F.lit(size) if isinstance(size, int) else size))).otherwise(none)


def name_grams(name: Column, size: int = GRAM) -> Column:
    """The different runs of up to ``size`` characters of a name between ``BEGIN`` and ``END``."""
    marked = F.concat(F.lit(BEGIN), name, F.lit(END))
    return F.array_distinct(F.flatten(F.array(*(grams(marked, n) for n in range(1, size + 1)))))


def glob_grams(runs: Column, size: int = GRAM) -> Column:
    """The different runs of ``size`` characters in a glob's ``literal_runs``; shorter ones if there are none."""
    most = F.least(F.lit(size), F.array_max(F.transform(runs, F.length)))
    return F.array_distinct(F.flatten(F.transform(runs, lambda run: grams(run, most))))


def glob_match(item: Column, pattern: str) -> Column:
    """Boolean column: does ``item`` match the glob?"""
    return item == F.lit(pattern) if is_plain(pattern) else item.rlike(glob_to_regex(pattern))


def select_names(items: Iterable[str], patterns: Iterable[str]) -> tuple[list[str], list[str]]:
    """Glob selection over names already at hand, such as the columns of a schema.

    Returns the names in pattern order then item order without repeats, and the patterns
    that matched nothing.
    """
    items = list(items)
    chosen: dict[str, None] = {}
    unmatched = []
    for pattern in patterns:
        regex = re.compile(_python_form(glob_to_regex(pattern)))
        hits = [name for name in items if regex.search(name)]
        if not hits:
            unmatched.append(pattern)
        chosen.update(dict.fromkeys(hits))
    return list(chosen), unmatched


def _python_form(regex: str) -> str:
    """Same regex in the driver's dialect: ``\\z`` and ``\\x{...}`` are JVM spellings."""
    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: rf"\U{int(m[1], 16):08x}", regex.replace(r"\z", r"\Z"))
