"""Object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_name(filename: Column) -> Column:
    """Last component of a slash path; empty and ``.`` components do not count."""
    parts = F.filter(F.split(filename, "/"), lambda part: ~part.isin("", "."))
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))


def object_key(
    user_id: Column,
    source_id: Column,
    folder_name: Column,
    uid_validity: Column,
    uid: Column,
    filename: Column,
) -> Column:
    """``user/source/folder/validity/uid/name``; a NULL part makes the key NULL."""
    slash = F.lit("/")
    return F.concat(
        user_id, slash,
        source_id.cast("string"), slash,
        folder_name, slash,
        uid_validity, slash,
        uid.cast("string"), slash,
        base_name(filename),
    )


def digest_bucket(key: Column) -> Column:
    """A number from 0 to 4095 that spreads any key text evenly."""
    return F.conv(F.substring(F.md5(key), 1, 3), 16, 10).cast("bigint")
