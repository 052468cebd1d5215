"""Run documents, one JSON line per folder run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schemas


def write_metrics(documents: DataFrame, path: str, mode: str = "append") -> None:
    """Add run documents as JSON lines under ``run_date=...``, or put them in place of others.

    A folder that fetched nothing writes no document.
    """
    (
        documents.filter(F.col("emails_fetched") > 0)
        .withColumn("run_date", F.substring("timestamp", 1, 10))
        .write.mode(mode)
        .partitionBy("run_date")
        .option("ignoreNullFields", "false")
        .json(path)
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Run documents below a path or glob."""
    return spark.read.schema(schemas.RUN_DOCUMENT).json(path)


def explode_chunks(documents: DataFrame) -> DataFrame:
    """The chunk metrics within run documents, one row each."""
    return documents.select(F.explode("metrics").alias("m")).select("m.*")
