"""Row-wise operators that work unchanged on streaming DataFrames.

Filters and column selection keep no state, so they run on ``readStream`` sources as they
do on tables.  Everything else here needs whole tables.
"""

from matrixlens.operators.predicates import filter_rows, mask, row_filter

__all__ = ["filter_rows", "mask", "row_filter"]
