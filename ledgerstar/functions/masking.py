"""Salted identifier masking (JVM-side sha2, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MASK_HEX_CHARS


def mask_id(col: Column | str, salt: str) -> Column:
    """First 32 hex characters of SHA-256(salt || id). NULL id -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(F.sha2(F.concat(F.lit(salt), c), 256), 1, MASK_HEX_CHARS)


def is_masked_id(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike("^[0-9a-f]{32}$")
