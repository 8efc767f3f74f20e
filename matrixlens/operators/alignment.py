"""Keeping the rows of any table or matrix whose position a filter has kept."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from matrixlens import session
from matrixlens.functions.columns import POSITION

#: Largest bitmap of positions that is sent to every executor: two thousand million positions.
BITMAP_BYTES = 256 << 20
_WORD_BITS, _BLOCK_WORDS = 6, 9  # 64 positions in a long, 512 longs in a block


class KeptPositions:
    """The positions left on an axis, counted once, and what they keep of other parts.

    Few positions are broadcast as they are.  More are broadcast as a bitmap, one bit for each
    position up to the largest, so that keeping half of an axis does not move the matrix.  Only
    beyond ``BITMAP_BYTES`` do both sides meet in a shuffle.
    """

    def __init__(self, positions: DataFrame) -> None:
        self.positions = positions.select(POSITION)

    @cached_property
    def _counted(self) -> tuple[int, int | None, int | None]:
        return tuple(self.positions.agg(F.count(F.lit(1)), F.min(POSITION), F.max(POSITION)).first())

    @property
    def count(self) -> int:
        return self._counted[0]

    def rows_of(self, df: DataFrame, name: str) -> DataFrame:
        """Rows of ``df`` whose column ``name`` is a kept position."""
        n, low, high = self._counted
        if not n:
            return df.filter(F.lit(False))
        # The bounds let the Parquet reader skip row groups.
        df = df.filter(F.col(name).between(low, high))
        side = self.positions.select(F.col(POSITION).alias(name))
        if n <= session.BROADCAST_ROWS:
            return df.join(F.broadcast(side), name, "left_semi")
        if (high - low) // 8 + 1 <= BITMAP_BYTES:
            return df.join(F.broadcast(self._bitmap), _block(F.col(name)) == F.col("_block"), "inner").filter(_is_set(F.col(name))).select(df.columns)
        return df.join(side, name, "left_semi")

    @cached_property
    def _bitmap(self) -> DataFrame:
        """``(_block, _bits)``: 512 longs for each stretch of positions that has a kept one."""
        position = F.col(POSITION)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), position.bitwiseAND(63).cast("int"))
        words = self.positions.groupBy(_block(position).alias("_block"), _word(position).alias("_word")).agg(F.bit_or(bit).alias("_long"))
        all_words = F.explode(F.sequence(F.lit(0), F.lit((1 << _BLOCK_WORDS) - 1))).alias("_word")
        empty = words.select("_block").distinct().select("_block", all_words, F.lit(0).cast("bigint").alias("_long"))
        dense = words.unionByName(empty).groupBy("_block", "_word").agg(F.bit_or("_long").alias("_long"))
        bits = F.array_sort(F.collect_list(F.struct("_word", "_long")))["_long"]
        return dense.groupBy("_block").agg(bits.alias("_bits"))


def _block(position: Column) -> Column:
    return F.shiftright(position, _WORD_BITS + _BLOCK_WORDS)


def _word(position: Column) -> Column:
    return F.shiftright(position, _WORD_BITS).bitwiseAND((1 << _BLOCK_WORDS) - 1).cast("int")


def _is_set(position: Column) -> Column:
    word = F.get("_bits", _word(position))
    return F.call_function("shiftright", word, position.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1
