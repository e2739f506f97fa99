"""Row rules and full-row de-duplication of raw transactions (F1-F7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typecodes import normalise_type
from ..schemas import MAX_STEP, MIN_STEP, RAW_COLUMNS, VALID_TYPE_CODES

CORRUPT_COLUMN = "_corrupt_record"


def _not_blank(c: str) -> Column:
    return F.col(c).isNotNull() & (F.trim(F.col(c)) != "")


def rule_columns(strict_types: bool = False) -> list[tuple[str, Column]]:
    """Ordered (name, passes) predicates; a row is kept only if all pass.

    With ``strict_types`` the whitelist sees the raw type (so CASH-IN is
    dropped); by default the type is normalised before the whitelist.
    """
    type_col = F.col("type") if strict_types else normalise_type("type")
    amount = F.col("amount")
    return [
        ("blank_orig", _not_blank("nameOrig")),
        ("blank_dest", _not_blank("nameDest")),
        ("bad_amount", amount.isNotNull() & (amount >= 0) & ~F.isnan(amount)),
        ("bad_step", F.col("step").between(MIN_STEP, MAX_STEP)),
        ("bad_type", F.coalesce(type_col.isin(*VALID_TYPE_CODES), F.lit(False))),
    ]


def _filtered(df: DataFrame, strict_types: bool) -> DataFrame:
    keep = F.lit(True)
    for _, passes in rule_columns(strict_types):
        keep = keep & passes
    out = df.filter(keep)
    if not strict_types:
        out = out.withColumn("type", normalise_type("type"))
    return out.select(*RAW_COLUMNS)


def clean(df: DataFrame, strict_types: bool = False) -> DataFrame:
    """Drop rows that cannot be loaded, then exact duplicates (all 11 columns).

    The de-duplication is a hash aggregate with a map-side partial step, so a
    heavily repeated row is collapsed before the shuffle.
    """
    return _filtered(df, strict_types).dropDuplicates(RAW_COLUMNS)


REJECTED_BY = "rejected_by"


def judged(df: DataFrame, strict_types: bool = False) -> DataFrame:
    """Every raw row with the first rule that it fails, or NULL, and whether
    its line could not be parsed."""
    failed = F.lit(None).cast("string")
    for name, passes in reversed(rule_columns(strict_types)):
        failed = F.when(~F.coalesce(passes, F.lit(False)), name).otherwise(failed)
    corrupt = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in df.columns else F.lit(False)
    return df.select(*RAW_COLUMNS, failed.alias(REJECTED_BY), corrupt.alias("corrupt"))


def accepted(rows: DataFrame, strict_types: bool = False) -> DataFrame:
    """The rows of ``judged`` that no rule rejects, as ``clean`` returns them."""
    kept = rows.filter(F.col(REJECTED_BY).isNull())
    if not strict_types:
        kept = kept.withColumn("type", normalise_type("type"))
    return kept.select(*RAW_COLUMNS).dropDuplicates(RAW_COLUMNS)


def judged_counts(rows: DataFrame, corrupt: bool = False) -> DataFrame:
    """``rule_counts`` from rows that ``judged`` has tagged."""
    by = F.col(REJECTED_BY)
    aggs = [F.count(F.lit(1)).alias("rows_in"),
            *[F.count_if(by == name).cast("long").alias(f"dropped_{name}") for name, _ in rule_columns()],
            F.count_if(by.isNull()).cast("long").alias("passed"),
            F.count_if(by.isNull() & (F.col("nameOrig") != F.trim(F.col("nameOrig")))).cast("long").alias("padded_orig_ids")]
    if corrupt:
        aggs.append(F.count_if(F.col("corrupt")).cast("long").alias("corrupt_rows"))
    return rows.agg(*aggs)


def rule_counts(df: DataFrame, strict_types: bool = False) -> DataFrame:
    """One row: rows_in, rows dropped by each rule (first failing rule wins),
    rows passed, padded originator ids that were kept, unparsable lines if
    the reader marked them. One aggregate over the raw rows."""
    aggs = [F.count(F.lit(1)).alias("rows_in")]
    earlier = F.lit(True)
    for name, passes in rule_columns(strict_types):
        fails = ~F.coalesce(passes, F.lit(False))
        aggs.append(F.count_if(earlier & fails).cast("long").alias(f"dropped_{name}"))
        earlier = earlier & F.coalesce(passes, F.lit(False))
    aggs.append(F.count_if(earlier).cast("long").alias("passed"))
    aggs.append(F.count_if(earlier & (F.col("nameOrig") != F.trim(F.col("nameOrig"))))
                .cast("long").alias("padded_orig_ids"))
    if CORRUPT_COLUMN in df.columns:  # CSV lines that did not parse (PERMISSIVE)
        aggs.append(F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).cast("long").alias("corrupt_rows"))
    return df.agg(*aggs)


def clean_report(df: DataFrame, strict_types: bool = False) -> DataFrame:
    """``rule_counts``, with duplicates removed and rows_out."""
    counts = rule_counts(df, strict_types)
    rows_out = clean(df, strict_types).agg(F.count(F.lit(1))).scalar()
    dropped = [c for c in counts.columns if c.startswith("dropped_")]
    rest = [c for c in counts.columns if c in ("padded_orig_ids", "corrupt_rows")]
    return (counts.withColumn("rows_out", rows_out)
            .select("rows_in", *dropped, (F.col("passed") - F.col("rows_out")).alias("dropped_duplicates"), *rest, "rows_out"))
