import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import (
    exact_decimal,
    na_to_null,
    round_half_even,
    strip,
    to_double,
    to_int,
)
from tidemark.schemas import NA_TOKENS


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "c string").select(expression(F.col("c"))).first()[0]


def test_strip_removes_what_python_removes(spark):
    white = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    cells = ["\t a b  \n", " x ", "", " ", "plain", "​kept"]
    cells += [w + "a" + w + "b" + w for w in white]
    got = spark.createDataFrame(list(enumerate(cells)), "i int, c string").select("i", strip(F.col("c"))).collect()
    assert {i: v for i, v in got} == {i: c.strip() for i, c in enumerate(cells)}


@pytest.mark.parametrize("text,expected", [("1.0005", 1.0), ("2.0005", 2.001), ("0.0025", 0.002), ("-2.5", -2.5)])
def test_rounding_is_half_even_after_scaling(spark, text, expected):
    assert one(spark, text, lambda c: round_half_even(to_double(c, "v"))) == expected


def test_rounding_equals_numpy(spark):
    import numpy as np

    rng = random.Random(7)
    values = [rng.uniform(-1e6, 1e6) for _ in range(2000)] + [i / 2000 for i in range(-500, 500)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = dict(df.select("i", round_half_even(F.col("v"))).collect())
    assert [got[i] for i in range(len(values))] == list(np.round(np.array(values), 3))


def test_na_tokens_match_before_trimming(spark):
    df = spark.createDataFrame([(t,) for t in [*NA_TOKENS, " NA", "x"]], "c string")
    assert sorted(r[0] for r in df.select(na_to_null(F.col("c"))).where("1=1").collect() if r[0]) == [" NA", "x"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["", "19x5", "1995.0", "99999999999", None])
def test_bad_integers_fail_in_either_mode(spark, failing, ansi, text):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(text,)], "c string").select(to_int(F.col("c"), "year"))
        assert "year: cannot read" in failing(df)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("text", ["", "abc", "1.5d", "2F", "1,5"])
def test_bad_doubles_fail(spark, failing, text):
    df = spark.createDataFrame([(text,)], "c string").select(to_double(F.col("c"), "value"))
    assert "value: cannot read" in failing(df)


def test_doubles(spark):
    assert one(spark, "NaN", lambda c: to_double(c, "v")) is None
    assert one(spark, None, lambda c: to_double(c, "v")) is None
    assert one(spark, "1e3", lambda c: to_double(c, "v")) == 1000.0
    assert math.isinf(one(spark, "-inf", lambda c: to_double(c, "v")))


def test_value_too_large_for_an_exact_sum_fails(spark, failing):
    df = spark.createDataFrame([(1e300,)], "v double").select(exact_decimal(F.col("v"), "value"))
    assert "value: cannot read" in failing(df)
