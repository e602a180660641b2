"""Scalars over locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = "s3://"


def is_object_url(c: Column) -> Column:
    return c.startswith(_SCHEME)


def is_http_url(c: Column) -> Column:
    return c.startswith("http://") | c.startswith("https://")


def _without_scheme(c: Column) -> Column:
    return F.when(is_object_url(c), F.substring(c, F.lit(len(_SCHEME) + 1), F.length(c))).otherwise(c)


def container(c: Column) -> Column:
    """The part before the first `/`; the `s3://` scheme is optional. NULL without a `/`."""
    rest = _without_scheme(c)
    return F.when(rest.contains("/"), F.substring_index(rest, "/", 1))


def key(c: Column) -> Column:
    """The part after the first `/`. NULL without a `/`."""
    rest = _without_scheme(c)
    slash = F.locate("/", rest)
    return F.when(slash > 0, F.substring(rest, slash + 1, F.length(rest)))


def join_path(directory: Column, name: Column) -> Column:
    """Directory and name with one `/`; an empty directory or a rooted name gives the name."""
    no_directory = directory.isNull() | (directory == "") | name.startswith("/")
    slash = F.when(directory.endswith("/"), F.lit("")).otherwise(F.lit("/"))
    return F.when(no_directory, name).otherwise(F.concat(directory, slash, name))


def directory_of(c: Column) -> Column:
    """The part before the last `/`, or an empty text; a path in the root keeps its `/`."""
    head = F.regexp_extract(c, r"(?s)^(.*/)[^/]*$", 1)
    trimmed = F.rtrim(head, F.lit("/"))
    return F.when(trimmed == "", head).otherwise(trimmed)


def file_name_of(c: Column) -> Column:
    """The part after the last `/`."""
    return F.substring_index(c, "/", -1)
