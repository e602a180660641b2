import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import paths


@pytest.mark.parametrize(
    "url,container,key",
    [
        ("s3://b/k/x.csv", "b", "k/x.csv"),
        ("b/k", "b", "k"),
        ("s3://b/", "b", ""),
        ("s3://b", None, None),
        ("plain", None, None),
        ("a/b\nc", "a", "b\nc"),
    ],
)
def test_container_and_key(spark, url, container, key):
    df = spark.createDataFrame([(url,)], "u string")
    got = df.select(paths.container(F.col("u")), paths.key(F.col("u"))).first()
    assert tuple(got) == (container, key)


@pytest.mark.parametrize("d,n", [("data/raw", "f"), ("", "f"), ("a/", "f"), ("/", "f"), ("a", "/f"), ("a//", "f")])
def test_join_path(spark, d, n):
    df = spark.createDataFrame([(d, n)], "d string, n string")
    assert df.select(paths.join_path(F.col("d"), F.col("n"))).first()[0] == (os.path.join(d, n) if d else n)


@pytest.mark.parametrize("p", ["a/b/c.json", "c.json", "/c.json", "a/", "a//b", "", "//b"])
def test_directory_and_name(spark, p):
    df = spark.createDataFrame([(p,)], "p string")
    got = df.select(paths.directory_of(F.col("p")), paths.file_name_of(F.col("p"))).first()
    assert tuple(got) == (os.path.dirname(p), os.path.basename(p))


def test_prefixes(spark):
    df = spark.createDataFrame([("s3://a",), ("http://a",), ("https://a",), ("ftp://a",)], "u string")
    got = df.select(paths.is_object_url(F.col("u")), paths.is_http_url(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, True), (False, False)]
