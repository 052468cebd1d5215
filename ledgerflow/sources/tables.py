"""Scans and lookups over the ``source`` and ``source_folder`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow import schemas

SOURCE_COLUMNS = schemas.SOURCE.fieldNames()
FOLDER_COLUMNS = schemas.SOURCE_FOLDER.fieldNames()


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table under its declared schema."""
    return spark.read.schema(schema).parquet(path)


def deal_out(table: DataFrame) -> DataFrame:
    """Spread a table that is read in fewer splits than the session has cores.

    Costly steps per row, such as parsing and decoding, then use every core.  A table
    of many splits is left as it is, without a shuffle.  Meant for plain scans.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def scan_sources(sources: DataFrame) -> DataFrame:
    """All sources, named columns only, by id."""
    return sources.select(*SOURCE_COLUMNS).orderBy("id")


def source_by_id(sources: DataFrame, source_id: int) -> DataFrame:
    """The source with this id: no row or one."""
    return sources.select(*SOURCE_COLUMNS).filter(F.col("id") == source_id)


def by_source_type(sources: DataFrame, source_type: str) -> DataFrame:
    """Sources one connector serves."""
    return sources.filter(F.col("source_type") == source_type)


def folders_of_source(folders: DataFrame, source_id: int) -> DataFrame:
    """The folders of one source, by id."""
    return (
        folders.select(*FOLDER_COLUMNS).filter(F.col("source_id") == source_id).orderBy("id")
    )


def folder_by_id(folders: DataFrame, folder_id: int) -> DataFrame:
    """The folder with this id: no row or one."""
    return folders.select(*FOLDER_COLUMNS).filter(F.col("id") == folder_id)


def folder_by_natural_key(
    folders: DataFrame, source_id: int, folder_name: str, uid_validity: str
) -> DataFrame:
    """The folder a mailbox names: source, folder name and validity epoch together."""
    return folders.select(*FOLDER_COLUMNS).filter(
        (F.col("source_id") == source_id)
        & (F.col("folder_name") == folder_name)
        & (F.col("uid_validity") == uid_validity)
    )
