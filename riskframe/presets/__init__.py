"""Presets that bind the generic operators to a concrete table layout."""
