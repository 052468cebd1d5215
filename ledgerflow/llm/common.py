"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import TEXT_SETTINGS, configure, new_run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark, TEXT_SETTINGS).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Lineage ends there: a lost executor costs a read, not the work before.
    """
    spark = frame.sparkSession
    path = new_run_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor``; null stays null."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker; its user bounds its size."""
    holder = sys.modules.setdefault("_worker_cache", types.ModuleType("_worker_cache"))
    return holder.__dict__.setdefault(name, {})
