"""The binary Golay code of length 23: every word is within three bits of exactly one codeword.

Words that differ in one bit need not share their nearest codeword, but share one of those
within four bits.  ``keys`` gives the indices of these, so that equal words and words one bit
apart always have a key in common.  Of two words one bit apart one has an even number of ones;
it is enough that the even words look four bits far and the odd ones three.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, INDEX_BITS, CHECK_BITS = 23, 12, 11
#: Fixed value: a generator polynomial of the code.
GENERATOR = 0b110001110101
#: Most keys of a word: its nearest codeword, and five more four bits away.
MOST_KEYS = 6


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK_BITS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Check bits by index; by syndrome, the index bits of the error, and of those to five more codewords (-1: none)."""
    checks = np.array([_remainder(i << CHECK_BITS) for i in range(1 << INDEX_BITS)], np.int64)
    codewords = (np.arange(1 << INDEX_BITS) << CHECK_BITS) | checks
    sevens = codewords[np.bitwise_count(codewords) == 7]
    errors = np.zeros(1 << CHECK_BITS, np.int64)
    further = np.full((1 << CHECK_BITS, MOST_KEYS - 1), -1, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            error = sum(1 << b for b in bits)
            syndrome = _remainder(error)
            errors[syndrome] = error >> CHECK_BITS
            if weight == 3:
                further[syndrome] = sevens[(sevens & error) == error] >> CHECK_BITS
    return checks, errors, further


def keys(words: np.ndarray) -> np.ndarray:
    """For words (int64, below 2**23), indices of nearby codewords in six columns, -1 where there are fewer."""
    checks, errors, further = _tables()
    head = words >> CHECK_BITS
    syndrome = checks[head] ^ (words & ((1 << CHECK_BITS) - 1))
    nearest = head ^ errors[syndrome]
    more = further[syndrome]
    even = (np.bitwise_count(words) & 1) == 0
    more = np.where((more >= 0) & even[:, None], nearest[:, None] ^ more, -1)
    return np.concatenate([nearest[:, None], more], axis=1)
