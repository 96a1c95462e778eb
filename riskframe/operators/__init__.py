"""Relational operators: measures, comparisons, windows, n-tiles, cleaning, distributions, sampling."""
