"""Message connectors.

A connector is anything that yields ``(source_folder_id, uid, rfc822_data)`` rows,
``uid`` unique within a folder.  Instead of the folder's id a table may name the folder by
its natural key (``source_id, folder_name, uid_validity``); the run resolves it.  A table
may add ``size_bytes`` (NULL for a message that could not be fetched); selection then
never has to open the raw bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerflow import schemas

MESSAGE_TABLE = StructType(
    schemas.RAW_MESSAGE.fields + [StructField("size_bytes", LongType(), True)]
)

NATURAL_KEY = ["source_id", "folder_name", "uid_validity"]
# <folder id>/<uid>.eml
EML_PATH = r"/(\d+)/(\d+)\.eml$"


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages captured as Parquet."""
    return spark.read.schema(MESSAGE_TABLE).parquet(path)


def stream_messages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same table as a file stream."""
    return (
        spark.readStream.schema(MESSAGE_TABLE)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def _from_files(files: DataFrame) -> DataFrame:
    return files.select(
        F.regexp_extract("path", EML_PATH, 1).try_cast("bigint").alias("source_folder_id"),
        F.regexp_extract("path", EML_PATH, 2).try_cast("bigint").alias("uid"),
        F.col("content").alias("rfc822_data"),
        F.col("length").alias("size_bytes"),
    ).filter(F.col("source_folder_id").isNotNull())


def read_eml(spark: SparkSession, path: str) -> DataFrame:
    """``.eml`` files in one directory per folder id, named by uid."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.eml")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return _from_files(files)


def stream_eml(spark: SparkSession, path: str, files_per_batch: int = 10_000) -> DataFrame:
    """The same directories as a file stream."""
    files = (
        spark.readStream.format("binaryFile")
        .option("pathGlobFilter", "*.eml")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return _from_files(files)


def read_connector(spark: SparkSession, name: str, **options: str) -> DataFrame:
    """Messages of any registered Spark data source, a Python ``DataSource`` included."""
    loaded = spark.read.format(name).options(**options).load()
    extra = ["size_bytes"] if "size_bytes" in loaded.columns else []
    return loaded.select(
        F.col("source_folder_id").cast("bigint").alias("source_folder_id"),
        F.col("uid").cast("bigint").alias("uid"),
        F.col("rfc822_data").cast("binary").alias("rfc822_data"),
        *extra,
    )


def stream_connector(spark: SparkSession, name: str, **options: str) -> DataFrame:
    """The same as a stream, of data sources that have a stream reader."""
    return spark.readStream.format(name).options(**options).load()


def message_keys(messages: DataFrame) -> DataFrame:
    """``(source_folder_id, uid, readable)`` without the raw bytes.

    Messages that name their folder by its natural key keep that in place of the id.
    """
    if "size_bytes" in messages.columns:
        readable = F.col("size_bytes").isNotNull()
    elif "rfc822_data" in messages.columns:
        readable = F.col("rfc822_data").isNotNull()
    else:
        readable = F.lit(True)
    folder = ["source_folder_id"] if "source_folder_id" in messages.columns else NATURAL_KEY
    return messages.select(*folder, "uid", readable.alias("readable"))


def readable_messages(messages: DataFrame) -> DataFrame:
    """Drop messages whose fetch failed; an empty message is still a message."""
    return messages.filter(F.col("rfc822_data").isNotNull())
