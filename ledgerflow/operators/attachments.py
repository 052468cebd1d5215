"""Attachment keys, upload of missing objects, listing and deletion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.keys import object_key

FILE_ORDER = ["source_folder_id", "uid", "position"]


def message_key(filename: Column) -> Column:
    """Object key of a file of the message a row describes (context columns needed)."""
    return object_key(
        F.col("user_id"), F.col("source_id"), F.col("folder_name"),
        F.col("uid_validity"), F.col("uid"), filename,
    )


def attached_files(filenames: Column) -> Column:
    """File references of a message from the array of its attachment names.

    The name is kept as the sender wrote it; only the key uses its last component.
    Two files of one message may share a key, and both references are kept.
    """
    return F.transform(
        filenames,
        lambda name: F.struct(name.alias("file_name"), message_key(name).alias("file_key")),
    )


def with_file_key(files: DataFrame) -> DataFrame:
    """Add ``file_key`` to exploded attachments that carry their message's context."""
    return files.withColumn("file_key", message_key(F.col("filename")))


def first_files(attachments: Column) -> Column:
    """Of a message's files that share a key only the first.

    A key holds folder and uid, so equal keys occur within one message only and nothing
    has to be shuffled to find them.
    """
    keys = F.transform(attachments, lambda file: message_key(file["filename"]))
    return F.filter(attachments, lambda file, i: F.coalesce(
        F.array_position(keys, F.element_at(keys, i + 1)) == i + 1, F.lit(True)))


def missing_objects(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Objects to append to the store: files whose key, unique here, is not stored yet."""
    return files.join(stored.select("file_key"), "file_key", "left_anti").select(
        "file_key", "content_type", "data", F.octet_length("data").cast("bigint").alias("size_bytes"))


def upload_missing(
    files: DataFrame, stored: DataFrame, order: list[str] | None = None
) -> DataFrame:
    """Objects to append to the store: keys not stored yet, the first file of each.

    For files of any origin, whose keys may be equal across rows; the files of parsed
    messages are told apart by ``first_files``, without a sort of the bytes.
    """
    first = Window.partitionBy("file_key").orderBy(*(order or FILE_ORDER))
    return (
        files.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .transform(missing_objects, stored)
    )


def delete_by_prefix(stored: DataFrame, prefix: str) -> DataFrame:
    """The store without the objects under a prefix."""
    return stored.filter(~F.col("file_key").startswith(prefix))


def count_by_prefix(stored: DataFrame, prefix: str) -> DataFrame:
    """How many objects a delete under this prefix removes."""
    under = F.col("file_key").startswith(prefix)
    return stored.agg(F.count_if(under).alias("deleted"))


def key_collisions(files: DataFrame) -> DataFrame:
    """Keys that several files share, so that only the first one's bytes are stored."""
    return (
        files.groupBy("file_key")
        .agg(F.count(F.lit(1)).alias("files"))
        .filter(F.col("files") > 1)
    )
