import math

from ledgerstar.operators.clean import clean, clean_report
from ledgerstar.schemas import RAW_SCHEMA


def _rows():
    base = dict(step=1, type="PAYMENT", amount=10.0, nameOrig="C1", oldbalanceOrg=1.0,
                newbalanceOrig=0.0, nameDest="M1", oldbalanceDest=0.0, newbalanceDest=0.0,
                isFraud=0, isFlaggedFraud=0)
    cases = [
        {},                                    # good
        {},                                    # exact duplicate
        {"nameOrig": None},                    # F1
        {"nameOrig": "  "},                    # F1 (spaces)
        {"nameDest": ""},                      # F2
        {"amount": -1.0},                      # F3
        {"amount": None},                      # F3
        {"amount": float("nan")},              # F3 (NaN passes >= 0 in Spark)
        {"amount": 0.0, "nameOrig": "C2"},     # zero amount is allowed
        {"step": 745},                         # F4
        {"step": 0},                           # F4
        {"type": "UNKNOWN"},                   # F5
        {"type": "CASH-IN", "nameOrig": "C3"},  # normalised, kept
        {"nameOrig": "C1 "},                   # padded, kept as a different id
    ]
    out = []
    for c in cases:
        r = dict(base)
        r.update(c)
        out.append(tuple(r[f.name] for f in RAW_SCHEMA.fields))
    return out


def test_clean_rules(spark):
    df = spark.createDataFrame(_rows(), RAW_SCHEMA.fields and _schema())
    out = clean(df).collect()
    assert len(out) == 4
    types = sorted(r["type"] for r in out)
    assert "CASH_IN" in types
    assert all(not (isinstance(r["amount"], float) and math.isnan(r["amount"])) for r in out)


def test_strict_types_drop_hyphenated(spark):
    df = spark.createDataFrame(_rows(), _schema())
    assert clean(df, strict_types=True).count() == 3


def test_clean_report_counts(spark):
    df = spark.createDataFrame(_rows(), _schema())
    r = clean_report(df).first().asDict()
    assert r["rows_in"] == 14
    assert r["dropped_blank_orig"] == 2
    assert r["dropped_blank_dest"] == 1
    assert r["dropped_bad_amount"] == 3
    assert r["dropped_bad_step"] == 2
    assert r["dropped_bad_type"] == 1
    assert r["dropped_duplicates"] == 1
    assert r["padded_orig_ids"] == 1
    assert r["rows_out"] == 4
    dropped = sum(v for k, v in r.items() if k.startswith("dropped_"))
    assert r["rows_in"] - dropped == r["rows_out"]


def _schema():
    from pyspark.sql import types as T
    # nullable everywhere: literal test rows carry the defects on purpose
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_SCHEMA.fields])


def test_csv_source_counts_corrupt_rows(spark, tmp_dir):
    from ledgerstar.schemas import RAW_SCHEMA as CONTRACT
    from ledgerstar.sources.raw import read_raw_csv
    header = ",".join(f.name for f in CONTRACT.fields)
    with open(f"{tmp_dir}/part-0.csv", "w") as fh:
        fh.write(header + "\n")
        fh.write("1,PAYMENT,10.0,C1,1.0,0.0,M1,0.0,0.0,0,0\n")
        fh.write("2,PAYMENT,not-a-number,C2,1.0,0.0,M1,0.0,0.0,0,0\n")
        fh.write("3,cash-in,5.0,C3 ,1.0,0.0,C4,0.0,5.0,0,0\n")
    df = read_raw_csv(spark, tmp_dir, keep_corrupt=True)
    r = clean_report(df).first().asDict()
    assert r["rows_in"] == 3 and r["corrupt_rows"] == 1
    assert r["dropped_bad_amount"] == 1 and r["rows_out"] == 2 and r["padded_orig_ids"] == 1
    assert len(CONTRACT.fields) == 11  # the shared contract is untouched
    assert clean(df).columns == [f.name for f in CONTRACT.fields]
