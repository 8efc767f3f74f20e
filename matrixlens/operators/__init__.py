"""Operators: filters, selection, slices and statistics, all DataFrame in, DataFrame out."""
