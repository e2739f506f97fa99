"""Continuous percentiles per group (PERCENTILE_CONT semantics).

Exact variant, two passes, no per-group sort of all values:

1. Count rows per (group, bucket), where the bucket is a monotone coarse
   function of the value (about 64 buckets per doubling). Partial
   aggregation makes this a tiny table even when one group holds a third of
   all rows. Cumulative counts per group over buckets (a few thousand rows
   per group) tell, for each needed rank floor(h) and ceil(h) with
   h = 1 + (n - 1) p, which bucket holds it and at which offset.
2. Only rows of those target buckets (at most groups x 2 x probabilities)
   are counted per distinct value; cumulative counts inside one bucket
   locate the order statistic. Interpolation is exact decimal.

Approximate variant: ``percentile_approx`` (fixed-size sketch per group).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_DOUBLING = 64


def value_bucket(value: Column) -> Column:
    """Monotone non-decreasing in ``value``: sign * floor(64 * log2(|v| + 1))."""
    v = value.cast("double")
    mag = F.floor(F.log2(F.abs(v) + F.lit(1.0)) * BUCKETS_PER_DOUBLING)
    return (F.signum(v) * mag).cast("long")


def bucket_bounds(bucket: int) -> tuple[Decimal, Decimal]:
    """Amounts in cents between which all values of a bucket lie. A little
    wider than the bucket, for filters that a scan can apply by statistics."""
    low, high = (2.0 ** (k / BUCKETS_PER_DOUBLING) - 1 for k in (abs(bucket), abs(bucket) + 1))
    low, high = (-high if bucket == 0 else low), high
    if bucket < 0:
        low, high = -high, -low
    cent, slack = Decimal("0.01"), lambda v: max(0.02, abs(v) * 1e-9)
    return Decimal(low - slack(low)).quantize(cent), Decimal(high + slack(high)).quantize(cent)


def exact_percentiles(df: DataFrame, group: str, value: str, probs: list[float],
                      names: list[str]) -> DataFrame:
    vals = df.select(group, value).filter(F.col(value).isNotNull()) \
        .withColumn("_b", value_bucket(F.col(value)))
    # pass 1: bucket histogram per group
    hist = vals.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    return order_statistics(vals, rank_targets(hist, group, probs, names), group, value, names)


def rank_targets(hist: DataFrame, group: str, probs: list[float], names: list[str]) -> DataFrame:
    """Buckets of the histogram (group, _b, _c) that hold a wanted order
    statistic, and its offset there: groups x probabilities x 2 rows."""
    w = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.select(group, "_b", "_c", F.sum("_c").over(w).alias("_cum"),
                       F.sum("_c").over(Window.partitionBy(group)).alias("_n"))
    wanted = []
    for p, name in zip(probs, names):
        h = F.lit(1) + (F.col("_n") - 1).cast("decimal(20,0)") * F.lit(Decimal(str(p))).cast("decimal(10,6)")
        for side, rank in ((0, F.floor(h)), (1, F.ceil(h))):
            wanted.append(F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"),
                                   rank.cast("long").alias("rank"), (h - F.floor(h)).alias("frac")))
    return (hist.select(group, "_b", "_c", "_cum", F.explode(F.array(*wanted)).alias("t"))
               .filter((F.col("_cum") - F.col("_c") < F.col("t.rank")) & (F.col("t.rank") <= F.col("_cum")))
               .select(group, "_b", F.col("t.name").alias("_name"), F.col("t.side").alias("_side"),
                       (F.col("t.rank") - (F.col("_cum") - F.col("_c"))).alias("_off"),
                       F.col("t.frac").alias("_frac")))


def order_statistics(vals: DataFrame, targets: DataFrame, group: str, value: str, names: list[str]) -> DataFrame:
    """Percentiles per group from the values (group, value, _b) of the target buckets."""
    # pass 2: exact order statistics inside the target buckets only.
    # targets has groups x probabilities x 2 rows: tiny for a few groups, but
    # it grows with the number of groups, so no broadcast hint here; AQE
    # broadcasts it after measuring it (five types: a few dozen rows).
    in_targets = vals.join(targets.select(group, "_b").distinct(), [group, "_b"], "left_semi")
    counts = in_targets.groupBy(group, "_b", value).agg(F.count(F.lit(1)).alias("_vc"))
    wb = Window.partitionBy(group, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select(group, "_b", value, "_vc", F.sum("_vc").over(wb).alias("_vcum"))
    hit = counts.join(targets, [group, "_b"]).filter(
        (F.col("_vcum") - F.col("_vc") < F.col("_off")) & (F.col("_off") <= F.col("_vcum")))
    sides = hit.groupBy(group, "_name").agg(
        F.max(F.when(F.col("_side") == 0, F.col(value))).alias("_lo"),
        F.max(F.when(F.col("_side") == 1, F.col(value))).alias("_hi"),
        F.max("_frac").alias("_frac"))
    interp = sides.select(group, "_name",
                          (F.col("_lo") + F.col("_frac") * (F.col("_hi") - F.col("_lo"))).alias("_v"))
    return interp.groupBy(group).pivot("_name", names).agg(F.first("_v"))


def approx_percentiles(df: DataFrame, group: str, value: str, probs: list[float],
                       names: list[str], accuracy: int = 10000) -> DataFrame:
    p = F.percentile_approx(F.col(value).cast("double"), probs, accuracy)
    return df.groupBy(group).agg(p.alias("_p")).select(
        group, *[F.col("_p")[i].alias(n) for i, n in enumerate(names)])
