"""All star-schema bindings and their oracle SQL, gathered in one place."""

from __future__ import annotations

from . import star, star_clean, star_dist, star_io, star_loans, star_merge, star_misc, star_ml, star_sql

REGISTRY = star.REGISTRY
ORACLE: dict[str, str] = {**star_sql.ORACLE, **star_clean.ORACLE_CLEAN,
                         **star_misc.ORACLE_MISC, **star_dist.ORACLE_DIST,
                         **star_io.ORACLE_IO, **star_ml.ORACLE_ML,
                         **star_loans.ORACLE_LOANS, **star_merge.ORACLE_MERGE}
