"""Chunk, folder and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIMINGS = [
    "duration_sec",
    "classification_time_sec",
    "extraction_time_sec",
    "s3_upload_time_sec",
    "db_commit_time_sec",
]
COUNTS = ["emails_fetched", "emails_processed", "invoices_found", "non_invoices"]

# What became of a message.
INVOICE = "invoice"
NON_INVOICE = "non_invoice"
NO_EXTRACTION = "no_extraction"
FAILED = "failed"


def _exact_sum(column: str) -> Column:
    """Sum of seconds that does not depend on the order of the rows."""
    return F.sum(F.col(column).cast("decimal(18,6)")).cast("double")


def collect_errors() -> Column:
    """``[{uid, error}]`` of a chunk, by uid; a chunk bounds its length."""
    entry = F.when(F.col("error").isNotNull(), F.struct("uid", "error"))
    return F.array_sort(F.collect_list(entry))


def chunk_metrics(outcomes: DataFrame, worker_id: Column | None = None) -> DataFrame:
    """One metrics row per chunk from one row per message.

    ``outcomes`` has ``source_folder_id, chunk_num, uid, status, error`` and the
    timings.  Messages without an extraction count as processed and as errors;
    failed ones only as errors.
    """
    status = F.col("status")
    return (
        outcomes.groupBy("source_folder_id", "chunk_num")
        .agg(
            F.count(F.lit(1)).alias("emails_fetched"),
            F.count_if(status != FAILED).alias("emails_processed"),
            F.count_if(status == INVOICE).alias("invoices_found"),
            F.count_if(status == NON_INVOICE).alias("non_invoices"),
            collect_errors().alias("errors"),
            *[_exact_sum(name).alias(name) for name in TIMINGS],
        )
        .select(
            (F.lit("") if worker_id is None else worker_id).alias("worker_id"),
            "source_folder_id", "chunk_num", *COUNTS, "errors", *TIMINGS,
        )
    )


def folder_rollup(chunks: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Sums per folder.

    A failed chunk ``(source_folder_id, chunk_num, emails)`` adds all its messages to
    the errors and is not among the chunks processed.
    """
    good = chunks.select(
        "source_folder_id",
        "emails_fetched",
        F.lit(1).alias("chunks"),
        "invoices_found",
        "non_invoices",
        F.size("errors").cast("bigint").alias("errors"),
    )
    if failures is not None:
        zero = F.lit(0).cast("bigint")
        good = good.unionByName(
            failures.select(
                "source_folder_id",
                F.col("emails").alias("emails_fetched"),
                F.lit(0).alias("chunks"),
                zero.alias("invoices_found"),
                zero.alias("non_invoices"),
                F.col("emails").alias("errors"),
            )
        )
    return good.groupBy("source_folder_id").agg(
        F.sum("emails_fetched").alias("emails_fetched"),
        F.sum("chunks").alias("chunks_processed"),
        F.sum("invoices_found").alias("invoices_found"),
        F.sum("non_invoices").alias("non_invoices"),
        F.sum("errors").alias("errors"),
    )


def folder_documents(rollup: DataFrame, chunks: DataFrame, stamp: Column) -> DataFrame:
    """The document a folder run writes: its rollup and its chunk metrics, by chunk.

    A folder has at most batch size over chunk size chunks per run.
    """
    names = [name for name in chunks.columns if name != "batch_id"]
    nested = chunks.groupBy("source_folder_id").agg(
        F.array_sort(
            F.collect_list(F.struct("chunk_num", F.struct(*names).alias("chunk")))
        ).alias("_chunks")
    )
    return rollup.join(nested, "source_folder_id", "left").select(
        "source_folder_id",
        stamp.alias("timestamp"),
        "emails_fetched", "chunks_processed", "invoices_found", "non_invoices", "errors",
        F.coalesce(
            F.col("_chunks.chunk"), F.array().cast(_array_of(chunks, names))
        ).alias("metrics"),
    )


def _array_of(chunks: DataFrame, names: list[str]) -> str:
    return f"array<{chunks.select(*names).schema.simpleString()}>"


def worker_results(spawned: DataFrame, results: DataFrame, failures: DataFrame) -> DataFrame:
    """One row per folder that was started: its sums, or the reason it has none."""
    reasons = failures.select("source_folder_id", F.col("error").alias("error"))
    return (
        spawned.select("source_folder_id")
        .join(results, "source_folder_id", "left")
        .join(reasons, "source_folder_id", "left")
    )


def run_rollup(results: DataFrame, tokens: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Totals of a run, missing values counted as zero.

    A folder that failed still counts as completed.
    """
    usable = tokens.filter(F.col("access_token").isNotNull()).agg(F.count(F.lit(1))).scalar()
    folders = reconciled.agg(F.count(F.lit(1))).scalar()

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(f"total_{name}")

    return results.agg(
        F.count(F.lit(1)).alias("workers_spawned"),
        total("emails_fetched"),
        total("invoices_found"),
        total("non_invoices"),
        total("errors"),
    ).select(
        usable.alias("sources_processed"),
        folders.alias("folders_reconciled"),
        "workers_spawned",
        F.col("workers_spawned").alias("workers_completed"),
        "total_emails_fetched", "total_invoices_found", "total_non_invoices", "total_errors",
    )


def run_kpis(chunks: DataFrame) -> DataFrame:
    """Totals, rates, throughput and latency over chunk metrics; a rate over nothing is NULL."""

    def ratio(above: Column, below: Column) -> Column:
        return F.try_divide(above.cast("double"), below.cast("double"))

    fetched, seconds = F.col("emails_fetched"), F.col("duration_sec")
    return (
        chunks.agg(
            F.count(F.lit(1)).alias("chunks"),
            *[F.sum(name).alias(name) for name in COUNTS],
            F.sum(F.size("errors")).alias("errors"),
            _exact_sum("duration_sec").alias("duration_sec"),
        )
        .withColumns({
            "success_rate": ratio(F.col("emails_processed"), fetched),
            "error_rate": ratio(F.col("errors"), fetched),
            "emails_per_minute": ratio(fetched * 60, seconds),
            "sec_per_email": ratio(seconds, fetched),
            "sec_per_chunk": ratio(seconds, F.col("chunks")),
        })
    )


def confusion_counts(predictions: DataFrame, gold: DataFrame, on: list[str]) -> DataFrame:
    """``(predicted, expected, n)`` over the labelled rows."""
    return (
        predictions.join(gold, on)
        .groupBy("predicted", "expected")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def classifier_accuracy(predictions: DataFrame, gold: DataFrame, on: list[str]) -> DataFrame:
    """Share of labelled rows the classifier got right."""
    return predictions.join(gold, on).agg(
        F.count(F.lit(1)).alias("labelled"),
        F.count_if(F.col("predicted") == F.col("expected")).alias("correct"),
        F.avg((F.col("predicted") == F.col("expected")).cast("double")).alias("accuracy"),
    )
