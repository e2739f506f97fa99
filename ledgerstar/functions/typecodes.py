"""Transaction type code normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_type(col: Column | str) -> Column:
    """Upper-case, hyphens to underscores (CASH-IN -> CASH_IN)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.upper(c), "-", "_")
