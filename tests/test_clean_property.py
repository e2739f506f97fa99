"""Random raw rows with defects: clean() equals a direct reading of the rules."""

import math
import random

from pyspark.sql import types as T

from ledgerstar.operators.clean import clean, clean_report
from ledgerstar.schemas import RAW_SCHEMA

VALID = {"PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"}
SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_SCHEMA.fields])


def _row(rnd):
    return (
        rnd.choice([None, -1, 0, 1, 5, 744, 745]),
        rnd.choice([None, "PAYMENT", "payment", "CASH-IN", "cash_out", "DEBIT", "UNKNOWN", ""]),
        rnd.choice([None, -0.0, 0.0, -2.5, 3.25, float("nan"), 10.0]),
        rnd.choice([None, "", "  ", "C1", "C1 ", "C2"]),
        0.0, 0.0,
        rnd.choice([None, "", "M1", "C3"]),
        0.0, 0.0, rnd.choice([0, 1]), 0,
    )


def _keep(r):
    step, typ, amount, orig, _, _, dest = r[:7]
    ok_id = lambda s: s is not None and s.strip(" ") != ""
    return (ok_id(orig) and ok_id(dest) and amount is not None and not math.isnan(amount)
            and amount >= 0 and step is not None and 1 <= step <= 744
            and typ is not None and typ.upper().replace("-", "_") in VALID)


def _norm(r):
    r = list(r)
    r[1] = r[1].upper().replace("-", "_")
    r[2] = 0.0 if r[2] == 0 else r[2]  # -0.0 and 0.0 are one value for dedup
    return tuple(r)


def test_clean_equals_rules(spark):
    rnd = random.Random(99)
    rows = [_row(rnd) for _ in range(400)]
    rows += rows[:50]  # exact duplicates
    df = spark.createDataFrame(rows, SCHEMA)
    expected = {_norm(r) for r in rows if _keep(r)}
    got = {tuple(0.0 if (isinstance(v, float) and v == 0) else v for v in r) for r in clean(df).collect()}
    assert got == expected
    rep = clean_report(df).first()
    assert rep["rows_out"] == len(expected) and rep["rows_in"] == len(rows)
