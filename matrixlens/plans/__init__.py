"""Composed plans: dataset summaries, fixture datasets and the registered queries."""
