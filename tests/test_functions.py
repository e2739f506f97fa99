import hashlib

from pyspark.sql import functions as F

from ledgerstar.functions import (date_key_of, day_name, hex_bucket, is_weekend, iso_day_of_week,
                                  mask_id, month_name, normalise_type, region_of,
                                  step_to_timestamp, timestamp_to_step, week_of_month)
from ledgerstar.schemas import REGIONS


def test_mask_matches_sha256_prefix(spark):
    df = spark.createDataFrame([("C7",), ("M1",), (None,)], "id string")
    got = {r["id"]: r["m"] for r in df.select("id", mask_id("id", "salt").alias("m")).collect()}
    assert got["C7"] == hashlib.sha256(b"saltC7").hexdigest()[:32]
    assert got["C7"] == "a7ef2c4b961a03376f4f26576fc7a91d"
    assert got[None] is None


def test_region_bucket_is_hex_mod(spark):
    h = "a7ef2c4b961a03376f4f26576fc7a91d"
    df = spark.createDataFrame([(h,)], "id string")
    r = df.select(region_of("id").alias("r"), hex_bucket("id", 1, 6).alias("b")).first()
    assert r["b"] == int(h[:4], 16) % 6 == 1
    assert r["r"] == REGIONS[1]


def test_null_id_gets_first_region(spark):
    df = spark.createDataFrame([(None,)], "id string")
    assert df.select(region_of("id").alias("r")).first()["r"] == REGIONS[0]


def test_step_calendar(spark):
    df = spark.createDataFrame([(1,), (24,), (25,), (744,)], "step int")
    ts = step_to_timestamp("step")
    rows = df.select("step", date_key_of(ts).alias("k"), iso_day_of_week(ts).alias("dow"),
                     day_name(ts).alias("dn"), month_name(ts).alias("mn"),
                     week_of_month(ts).alias("wom"), is_weekend(ts).alias("we"),
                     timestamp_to_step(ts).alias("back")).orderBy("step").collect()
    assert [r["k"] for r in rows] == [2024010100, 2024010123, 2024010200, 2024013123]
    assert rows[0]["dow"] == 1 and rows[0]["dn"] == "Monday" and rows[0]["mn"] == "January"
    assert rows[3]["dow"] == 3 and rows[3]["wom"] == 5  # 31 Jan 2024 is a Wednesday
    assert [r["back"] for r in rows] == [1, 24, 25, 744]
    assert not any(r["we"] for r in rows)


def test_calendar_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(1,)], "step int")
        r = df.select(date_key_of(step_to_timestamp("step")).alias("k")).first()
        assert r["k"] == 2024010100
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_normalise_type(spark):
    df = spark.createDataFrame([("cash-in",), ("CASH_OUT",), ("Transfer",)], "t string")
    got = [r[0] for r in df.select(normalise_type("t")).collect()]
    assert got == ["CASH_IN", "CASH_OUT", "TRANSFER"]


def test_weekend_flag(spark):
    df = spark.createDataFrame([(24 * 4 + 1,), (24 * 5 + 1,), (24 * 6 + 1,)], "step int")
    got = [r[1] for r in df.select("step", is_weekend(step_to_timestamp("step"))).orderBy("step").collect()]
    assert got == [False, True, True]  # 5 Jan Fri, 6 Jan Sat, 7 Jan Sun  # 6 Jan Sat, 7 Jan Sun, 8 Jan Mon
