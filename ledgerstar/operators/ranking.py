"""Distributed global place, rank and NTILE (W-G1), several measures at once.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one
task. Here a row's place is counted instead of sorted for: rows are counted
by group, a group being a value and the first characters of the tie-breaking
key. Groups of a coarse, monotone bucket of the value are summed up in
order, the buckets (a few thousand, whatever the number of rows) likewise,
and only rows of one group are numbered among each other. A value that a
third of all rows share is spread over thousands of groups by the key's
characters. All measures of a frame go through the same counting, so the
frame is read twice, however many there are: once to count and once to place.
Nothing is written, sampled or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .percentiles import value_bucket

#: Characters of a string key that split the rows of one value.
KEY_CHARS = 3
_BEFORE = [Window.unboundedPreceding, -1]


def ntile_of(row_number: Column, total: Column, k: int) -> Column:
    """Bucket of a 1-based row number among ``total`` rows, as SQL NTILE(k):
    the first ``total % k`` buckets hold one row more."""
    b = F.floor(total / k)
    r = total % k
    big = r * (b + 1)
    return F.when(row_number <= big, F.ceil(row_number / (b + 1))) \
        .otherwise(r + F.ceil((row_number - big) / b)).cast("int")


def _grouped(df: DataFrame, measures: dict[str, Column], ties: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` once per measure (_m) with their group (_g), and per
    group where it starts (_start, from 0), where its value starts
    (_value_start) and how many rows there are (_total)."""
    values = df.withColumns({f"_v{i}": v for i, v in enumerate(measures.values())})
    of = range(len(measures))
    first = F.substring(ties[0], 1, KEY_CHARS) if isinstance(df.schema[ties[0]].dataType, StringType) else value_bucket(F.col(ties[0]))
    m = F.explode(F.array(*[F.lit(i) for i in of])) if len(measures) > 1 else F.lit(0)
    own = [F.when(F.col("_m") == i, F.col(f"_v{i}")) for i in of]  # NULL but for the row's measure
    value = F.struct(F.col("_m"), *[v.alias(f"v{i}") for i, v in enumerate(own)])
    bucket = F.coalesce(*[value_bucket(v) for v in own])
    rows = (values.withColumn("_m", m).withColumn("_g", F.struct(value.alias("v"), first.alias("p"))).withColumn("_b", bucket)
            .drop(*[f"_v{i}" for i in of]))

    counts = rows.groupBy("_m", "_b", "_g").agg(F.count(F.lit(1)).alias("_n"))
    # at most a few thousand buckets of a measure, whatever the rows
    buckets = counts.groupBy("_m", "_b").agg(F.sum("_n").alias("_size"))
    by_measure = Window.partitionBy("_m")
    buckets = buckets.select(F.col("_m").alias("_bm"), F.col("_b").alias("_bb"),
                             F.coalesce(F.sum("_size").over(by_measure.orderBy(F.col("_b").asc_nulls_first()).rowsBetween(*_BEFORE)), F.lit(0)).alias("_off"),
                             F.sum("_size").over(by_measure).alias("_total"))
    in_bucket, same_value = Window.partitionBy("_m", "_b"), Window.partitionBy("_m", "_b", "_g.v")
    starts = counts.select(
        "_m", "_b", F.col("_g").alias("_sg"),
        F.coalesce(F.sum("_n").over(in_bucket.orderBy("_g").rowsBetween(*_BEFORE)), F.lit(0)).alias("_in"),
        (F.sum("_n").over(in_bucket.orderBy("_g.v")) - F.sum("_n").over(same_value)).alias("_value_in"))
    starts = starts.join(F.broadcast(buckets), (F.col("_m") == F.col("_bm")) & F.col("_b").eqNullSafe(F.col("_bb")))
    return rows.drop("_b"), starts.select("_sg", (F.col("_off") + F.col("_in")).alias("_start"),
                                          (F.col("_off") + F.col("_value_in")).alias("_value_start"), "_total")


def _gathered(placed: DataFrame, columns: list[str], ties: list[str], place: Column, names: list[str]) -> DataFrame:
    """One row per row of the frame again, with ``place`` per measure, and _total."""
    if len(names) == 1:
        return placed.select(*columns, place.alias(names[0]), "_total")
    rest = [c for c in columns if c not in ties]
    out = placed.groupBy(*ties).agg(*[F.first(c).alias(c) for c in rest],
                                    *[F.max(F.when(F.col("_m") == i, place)).alias(n) for i, n in enumerate(names)], F.first("_total").alias("_total"))
    return out.select(*columns, *names, "_total")


def global_places(df: DataFrame, measures: dict[str, Column], ties: list[str]) -> DataFrame:
    """Adds, for each measure (name -> number), the 1-based place of the row in
    the order of the measure, ascending, NULL first, then of ``ties``
    ascending, NULL first; and the number of rows as ``_total``.

    ``ties`` are columns that identify a row; the first is a string whose
    first characters spread the rows, or a number. For a descending measure
    pass its negative.
    """
    rows, starts = _grouped(df, measures, ties)
    in_group = Window.partitionBy("_g").orderBy(*[F.col(t).asc_nulls_first() for t in ties])
    placed = (rows.join(starts, F.col("_g") == F.col("_sg"))
              .withColumn("_place", F.col("_start") + F.row_number().over(in_group)))
    return _gathered(placed, df.columns, ties, F.col("_place"), list(measures))


def global_ntiles(df: DataFrame, measures: dict[str, Column], ties: list[str], k: int) -> DataFrame:
    """Adds NTILE(k) for each measure, over the order of ``global_places``."""
    placed = global_places(df, measures, ties)
    return placed.withColumns({n: ntile_of(F.col(n), F.col("_total"), k) for n in measures}).drop("_total")


def global_ranks(df: DataFrame, measures: dict[str, Column], ties: list[str]) -> DataFrame:
    """Adds SQL RANK() for each measure, ascending, NULL first: one more than
    the rows with a smaller value. ``ties`` as in ``global_places``."""
    rows, starts = _grouped(df, measures, ties)
    ranked = rows.join(starts, F.col("_g") == F.col("_sg"))
    return _gathered(ranked, df.columns, ties, F.col("_value_start") + 1, list(measures)).drop("_total")
