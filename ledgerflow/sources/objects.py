"""Reading the attachment store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_object(stored: DataFrame, file_key: str) -> DataFrame:
    """The object under one key."""
    return stored.filter(F.col("file_key") == file_key)


def read_objects(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """Objects for a table of keys; a key asked for twice is read once."""
    keys = wanted.select("file_key").distinct()
    return stored.join(keys, "file_key", "left_semi")


def list_objects(stored: DataFrame, prefix: str = "") -> DataFrame:
    """Keys and sizes under a prefix; the object bytes are not read."""
    return stored.filter(F.col("file_key").startswith(prefix)).select("file_key", "size_bytes")


def first_objects(stored: DataFrame, n: int, prefix: str = "") -> DataFrame:
    """At most ``n`` objects under a prefix, in key order."""
    return list_objects(stored, prefix).orderBy("file_key").limit(n)
