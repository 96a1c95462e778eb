"""riskframe: Spark-native credit-risk analytics operators.

Operators are ``DataFrame -> DataFrame`` functions that take column names or
Column expressions as arguments, so the same operator runs on a loan table
(see ``riskframe.presets.loans``) or on any other table.
"""

from .session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
