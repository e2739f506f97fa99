"""Expose a warehouse as SQL views, so analysts' SQL runs on Spark SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .star import Warehouse


def register_views(wh: Warehouse, prefix: str = "") -> list[str]:
    names = []
    for name, df in wh.tables().items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def split_statements(text: str) -> list[str]:
    """Split a SQL script on ';' outside quotes and comments."""
    out, buf, quote, i = [], [], None, 0
    while i < len(text):
        ch = text[i]
        if quote:
            buf.append(ch)
            if ch == quote:
                quote = None
        elif ch in ("'", '"'):
            quote = ch
            buf.append(ch)
        elif text.startswith("--", i):
            j = text.find("\n", i)
            i = len(text) if j < 0 else j
            continue
        elif text.startswith("/*", i):
            j = text.find("*/", i + 2)
            i = len(text) if j < 0 else j + 2
            buf.append(" ")
            continue
        elif ch == ";":
            stmt = "".join(buf).strip()
            if stmt:
                out.append(stmt)
            buf = []
        else:
            buf.append(ch)
        i += 1
    stmt = "".join(buf).strip()
    if stmt:
        out.append(stmt)
    return out


_BARE_NUMERIC = re.compile(r"(?:::|\bas)\s*(?:numeric|decimal)\b(?!\s*\()", re.I)


def run_script(spark: SparkSession, text: str) -> list[DataFrame]:
    """A frame per statement. A cast to ``numeric`` without a precision keeps
    all digits in PostgreSQL and none after the point in Spark, so it is
    refused: write ``decimal(38, 6)``, or what the values need."""
    statements = split_statements(text)
    for s in statements:
        if _BARE_NUMERIC.search(s):
            raise ValueError(f"cast to numeric without precision and scale in: {s[:200]}")
    return [spark.sql(s) for s in statements]
