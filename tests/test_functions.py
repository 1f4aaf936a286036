"""Column functions against hand-made values (traps T1-T7)."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark import functions as tf


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_email_hash_is_upper_hex_of_normalised(spark):
    raw = " \tUser@Example.COM \n"
    want = hashlib.sha256(b"user@example.com").hexdigest().upper()
    assert one(spark, tf.email_hash, raw) == want


def test_customer_key_hashes_the_hex_text(spark):
    h = hashlib.sha256(b"a@b.c").hexdigest().upper()
    want = hashlib.sha256(h.encode()).hexdigest().upper()
    assert one(spark, lambda c: tf.customer_key_of(tf.email_hash(c)), "a@b.c") == want


@pytest.mark.parametrize("raw,norm", [
    ("  a@b.c ", "a@b.c"), ("\ta@b.c", "a@b.c"), ("A@B.C\n", "a@b.c"), ("a b@c.d", "a b@c.d"),
])
def test_strip_all_whitespace(spark, raw, norm):
    assert one(spark, tf.email_norm, raw) == norm


@pytest.mark.parametrize("norm,domain,mask", [
    ("john@x.com", "x.com", "j***@x.com"),
    ("nodomain", None, None),            # no '@': NULL domain, NULL mask (T3)
    ("a@b@c", "b", "a***@b"),            # two '@': second field
    ("a@", "", "a***@"),                 # empty field exists: ''
    (None, None, None),
])
def test_domain_and_mask(spark, norm, domain, mask):
    assert one(spark, tf.email_domain, norm) == domain
    assert one(spark, tf.email_mask, norm) == mask


@pytest.mark.parametrize("name,first,initial", [
    ("Ada Lovelace", "Ada", "L"), ("Plato", "Plato", None), ("A B C", "A", "B"), (None, None, None),
])
def test_name_split(spark, name, first, initial):
    assert one(spark, tf.first_word, name) == first
    assert one(spark, tf.second_word_initial, name) == initial


def ts(s):
    return dt.datetime.fromisoformat(s)


@pytest.mark.parametrize("start,end,months", [
    ("2001-01-31 00:00:00", "2001-02-28 00:00:00", 1),   # Jan 31 + 1 month clamps to Feb 28
    ("2001-01-31 10:00:00", "2001-02-28 09:00:00", 0),   # ... but not before its time of day
    ("2001-01-15 10:00:00", "2001-02-15 09:00:00", 0),   # same day, earlier hour
    ("2001-01-15 10:00:00", "2001-02-15 10:00:00", 1),
    ("2001-01-15 10:00:00", "2002-01-15 10:00:01", 12),
    ("2001-03-01 00:00:00", "2001-01-01 00:00:00", -2),  # future start
])
def test_months_between_whole(spark, start, end, months):
    df = spark.createDataFrame([(ts(start), ts(end))], "a timestamp, b timestamp")
    assert df.select(tf.months_between_whole("a", "b").alias("m")).first()["m"] == months


def test_months_null_and_clamp(spark):
    df = spark.createDataFrame([(None, ts("2001-01-01 00:00:00"))], "a timestamp, b timestamp")
    r = df.select(tf.clamp_non_negative(tf.months_between_whole("a", "b")).alias("m")).first()
    assert r["m"] is None                      # T5: greatest(NULL, 0) stays NULL
    df2 = spark.createDataFrame([(-3,), (4,)], "x int")
    assert [r[0] for r in df2.select(tf.clamp_non_negative("x")).collect()] == [0, 4]


def test_hours_between_whole(spark):
    df = spark.createDataFrame([(ts("2001-01-01 10:00:00"), ts("2001-01-01 12:59:59"))],
                               "a timestamp, b timestamp")
    assert df.select(tf.hours_between("a", "b")).first()[0] == 2


def test_try_casts_keep_rows(spark):
    df = spark.createDataFrame([("garbage",), ("2001-02-03",), ("2001-02-03T04:05:06+02:00",)], "x string")
    got = [r[0] for r in df.select(tf.try_instant("x").cast("timestamp_ntz")).collect()]
    assert got == [None, dt.datetime(2001, 2, 3), dt.datetime(2001, 2, 3, 2, 5, 6)]
    ep = spark.createDataFrame([("86400",), ("x",)], "x string")
    got = [r[0] for r in ep.select(tf.from_epoch_seconds("x").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(1970, 1, 2), None]


def test_pct_and_ratio_null_on_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "a long, b long")
    got = df.select(tf.pct("a", "b").alias("p"), tf.ratio("a", "b").alias("r")).collect()
    assert (got[0]["p"], got[0]["r"]) == (33.33, 0.333)
    assert (got[1]["p"], got[1]["r"]) == (None, None)
