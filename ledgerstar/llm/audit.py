"""Filter interaction audit by min-plus removal ranks.

Every row fails a subset of the filters (its mask). In an order of the
filters, a row goes at the smallest position of a filter that it fails: the
min-plus product of the mask matrix (0 where the mask holds the filter, else
infinite) and the matrix of the orders' inverse permutations (position of
each filter in each order). That one product gives the removal step of every
mask in every order; counts of rows by mask are then scattered over the steps,
and what fails a filter without being removed by it is redundant there.

A row is reduced to its part, mask and labels before anything is shuffled,
and rows to counts before the product: each part sends at most four rows per
mask to the task that builds its report, whatever the number of documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, arrow_rows, written

FILTERS = "ABCDE"
#: The last filter fails for a text that a smaller id has too; the others read one text.
COPY = "E"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
UPPER_PERCENT = 10
_NO_SYMBOL = bytes(set(range(256)) - set(b"#$%&*|"))
_NO_UPPER = bytes(set(range(256)) - set(range(65, 91)))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_mask(text: str | None) -> tuple[int, bytes]:
    """Bits of the filters A to D that the text fails, and its digest."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split parts at \x20 and \x09-\x0D, no other space
    n = len(words)
    fails = (n < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * n,
             100 * len(raw.translate(None, _NO_UPPER)) > UPPER_PERCENT * len(text), bool(raw.translate(None, _NO_SYMBOL)))
    return sum(bit << i for i, bit in enumerate(fails)), hashlib.blake2b(raw, digest_size=16).digest()


def removal_ranks(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product of ``masks`` (mask x filter, true where it fails) and
    ``positions`` (filter x order): the step that removes the mask in the
    order, or one beyond the last if it fails nothing."""
    beyond = len(positions) + 1
    cost = np.where(masks, 0, beyond)
    return np.minimum((cost[:, :, None] + positions[None, :, :]).min(axis=1), beyond)


def orders(filters: str = FILTERS) -> tuple[list[str], np.ndarray]:
    """All orders, and the position (from 1) of each filter in each of them."""
    names = ["".join(p) for p in permutations(filters)]
    forward = np.array([[filters.index(c) for c in name] for name in names])
    return names, np.argsort(forward, axis=1).T + 1


def tabulate(masks: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """COUNTS per order and step from ``n`` rows of each mask (bits in the
    order of ``filters``), ``good`` and ``toxic`` of which carry the label."""
    m = len(filters)
    names, position = orders(filters)
    fails = (masks[:, None] >> np.arange(m)) & 1 == 1
    rank = removal_ranks(fails, position)

    def scatter(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((len(names), m + 2), np.int64)
        np.add.at(out, (np.broadcast_to(np.arange(len(names)), rank.shape), rank), np.broadcast_to(weight[:, None], rank.shape))
        return out[:, 1:m + 1]

    removed = scatter(n)
    failing = fails.T.astype(np.int64) @ n
    alone = np.where(fails.sum(axis=1) == 1, n, 0) @ fails
    at = np.argsort(position, axis=0).T  # the filter at each step
    by_filter = np.zeros(m, np.int64)
    np.add.at(by_filter, at, removed)
    # what fails a step's filter but goes elsewhere went earlier: ranks are minimal
    return {"kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": failing[at] - removed,
            "unique_fails": alone[at], "good_lost": scatter(good), "toxic_lost": scatter(toxic), "shapley": by_filter[at]}


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): how many rows of ``docs`` fail which filters."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return arrow_out(schema, ((i, part, *text_mask(text)) for i, part, text in arrow_rows(batches)))

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.col(text_col).cast("string").alias("text"))
    seen = read.mapInArrow(run, "doc_id long, part string, mask int, digest binary")
    # equal rows are one from here on; a null id never meets a label or an original, so it stays with its text
    rows = written(seen.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n")), "masks")
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id")).select(F.col("digest").alias("first_digest"), "first_id")
    # the original is met by text and id, so a text with many copies is no hot key
    is_first = (F.col("digest") == F.col("first_digest")) & (F.col("doc_id") == F.col("first_id"))
    known = (labels.groupBy(F.col("doc_id").cast("string").alias("label_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    named = rows.where("doc_id is not null").join(first, is_first, "left").withColumn("copy", F.col("first_id").isNull())
    labelled = named.join(known, F.col("doc_id").cast("string") == F.col("label_id"), "left")
    plain = rows.where("doc_id is null").withColumns({"copy": F.lit(False), "good": F.lit(False), "toxic": F.lit(False)})
    cols = ["part", (F.col("mask") + F.when(F.col("copy"), 1 << FILTERS.index(COPY)).otherwise(0)).alias("mask"),
            F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n"]
    return labelled.select(*cols).unionByName(plain.select(*cols)).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, filter_order, step and COUNTS: a row per part, order and step.

    Null and empty texts have no words: they fail A. A null part is the part
    of the empty string. Repeated rows count as often as they come; rows that
    share an id and a text are all originals if no smaller id has the text. A
    null id is neither a copy nor an original, and has no label. An id that
    ``labels`` holds more than once is good, or toxic, if one row says so;
    null labels say nothing. Texts of any length are read whole, one at a
    time. Other columns, also ones with the names used here, are ignored.
    An empty table has no parts and gives no rows.
    """
    names, _ = orders()
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *((c, pa.int64()) for c in COUNTS)])

    def report(key: tuple, table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("mask", "n", "good", "toxic")}
        counts = tabulate(col["mask"], col["n"], col["n"] * col["good"], col["n"] * col["toxic"])
        m = len(FILTERS)
        cells = {"part": [key[0].as_py()] * (m * len(names)), "filter_order": np.repeat(names, m),
                 "step": np.tile(np.arange(1, m + 1, dtype=np.int32), len(names)), **{c: x.ravel() for c, x in counts.items()}}
        return pa.Table.from_arrays([pa.array(cells[f.name], f.type) for f in schema], schema=schema)

    # at most 2 ** filters x 4 rows of a part
    return failures(docs, labels, id_col, text_col, part_col).groupBy("part").applyInArrow(
        report, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
