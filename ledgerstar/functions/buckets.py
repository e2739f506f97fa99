"""Deterministic attribute buckets drawn from the hex digits of a masked id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MERCHANT_CATEGORIES, REGIONS


def hex_bucket(col: Column | str, start: int, n: int, width: int = 4) -> Column:
    """Integer value of ``width`` hex digits starting at 1-based ``start``, mod n."""
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.substring(c, start, width), 16, 10).cast("int") % F.lit(n)


def bucket_pick(col: Column | str, start: int, values: Sequence[str]) -> Column:
    """Pick ``values[hex_bucket]``; a NULL id gives the first value."""
    c = F.col(col) if isinstance(col, str) else col
    arr = F.array(*[F.lit(v) for v in values])
    picked = F.element_at(arr, hex_bucket(c, start, len(values)) + 1)
    return F.when(c.isNull(), F.lit(values[0])).otherwise(picked)


def region_of(col: Column | str) -> Column:
    return bucket_pick(col, 1, REGIONS)


def merchant_category_of(col: Column | str) -> Column:
    return bucket_pick(col, 5, MERCHANT_CATEGORIES)
