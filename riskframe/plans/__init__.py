"""Composite plans: the question registry, the cleaning chain and the star-schema bindings."""
