"""URL filters by hash prefixes of host-suffix and path-prefix expressions.

A rule is a host and a path prefix. Each URL is expanded into those of its
(host suffix, path prefix) expressions that a rule could have: only the
numbers of labels and path lengths that occur among the rules are cut, so a
URL yields at most as many expressions as the rules have shapes, whatever its
length. Expressions meet rules on the first bytes of their SHA-256; the full
digest then confirms the rule, and the longest confirmed rule wins.

DataFrame operations only. Rules are broadcast if there are at most
``broadcast_rows`` of them, otherwise the join shuffles.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX_HEX = 8  # four bytes
BROADCAST_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, A-Z lower-cased; empty without ://."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From the host's end up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """(rule, verdict) from pairs such as ("example.org/es/", "block")."""
    return spark.createDataFrame(list(rules), "rule string, verdict string")


def _digest(suffix: Column, prefix: Column) -> Column:
    return F.sha2(F.concat_ws("\n", suffix, prefix).cast("binary"), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict per row of ``pages``.

    Reads page_id and url of ``pages`` and rule and verdict of ``rules``. A
    rule without a path fits every path. Null rules are ignored; a null or
    unparsable url has an empty host and path and fits none. If several rules
    fit, the longest wins, then the one with the longer host, then ``block``,
    then the first in order. Without a fitting rule, rule is null and the
    verdict is ``default``. Repeated rows come back as often as they are
    given; other columns are ignored; empty tables give no rows, or defaults.
    """
    known = (rules.where("rule is not null and verdict is not null").select("rule", "verdict").distinct()
             .withColumn("rhost", F.translate(F.regexp_extract("rule", r"^([^/]*)", 1), _UPPER, _LOWER))
             .withColumn("rpath", F.expr("substring(rule, length(rhost) + 1)"))
             .withColumn("labels", F.size(F.split("rhost", r"\."))).withColumn("cut", F.length("rpath")))
    shapes = [(r["labels"], r["cut"]) for r in known.select("labels", "cut").distinct().collect()]  # label counts x path lengths of rules
    order = F.struct(F.length("rule").alias("len"), F.length("rhost").alias("hlen"), (F.col("verdict") == "block").alias("block"))
    known = known.select(_digest(F.col("rhost"), F.col("rpath")).alias("rdigest"), "rule", "verdict", order.alias("rank"))
    known = known.withColumn("rprefix", F.substring("rdigest", 1, PREFIX_HEX))
    if known.count() <= broadcast_rows:
        known = F.broadcast(known)

    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = urls.groupBy("page_id", "url").agg(F.count("*").alias("copies")).withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    schema = "array<struct<labels:int,cut:int>>"
    shape_list = F.array(*(F.struct(F.lit(a).alias("labels"), F.lit(b).alias("cut")) for a, b in shapes)).cast(schema)
    n_labels = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.")))
    fits = F.filter(shape_list, lambda s: (s["labels"] <= n_labels) & (s["cut"] <= F.length("path")))
    cut = urls.select("page_id", "url", "host", "path", "copies", F.explode_outer(fits).alias("shape"))
    suffix = F.expr("substring_index(host, '.', -shape.labels)")
    prefix = F.expr("substring(path, 1, shape.cut)")
    cut = cut.withColumn("digest", F.when(F.col("shape").isNotNull(), _digest(suffix, prefix)))
    met = cut.join(known, F.substring("digest", 1, PREFIX_HEX) == F.col("rprefix"), "left")
    best = F.max(F.when(F.col("digest") == F.col("rdigest"), F.struct("rank", F.struct("rule", "verdict").alias("won"))))
    out = met.groupBy("page_id", "url", "host", "path", "copies").agg(best.alias("best"))
    out = out.select("page_id", "host", "path", F.col("best.won.rule").alias("rule"), F.coalesce("best.won.verdict", F.lit(default)).alias("verdict"), "copies")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
