"""One run: sources to folders to messages to committed invoices, marks and metrics."""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators import attachments as att
from ledgerflow.operators import commit as cm
from ledgerflow.operators import decoding, intervals, metrics, parsing, prompts, reconcile, scoring, selection
from ledgerflow.operators.joins import lookup_join
from ledgerflow.operators.ledger import OUTCOME, BatchId, Ledger
from ledgerflow.operators.staging import together
from ledgerflow.sources.layout import MailLayout
from ledgerflow.sources.messages import message_keys, readable_messages
from ledgerflow.sources.metrics import read_metrics, write_metrics

KEY = ["source_folder_id", "uid"]

# Rows that name messages in, the same rows with ``rfc822_data`` out.
Fetch = Callable[[DataFrame], DataFrame]
# Rows with a prompt in, the same rows with response, error and elapsed_sec out.
Answerer = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class RunSizes:
    """How much one run reads per folder, and how it is cut up."""

    batch_size: int = selection.BATCH_SIZE
    chunk_size: int = selection.CHUNK_SIZE
    conflict_keys: Sequence[str] = cm.CONFLICT_KEYS
    advance_empty: bool = False
    # read what earlier runs passed over between a folder's marks
    fill_gaps: bool = True


def answers_from_table(responses: DataFrame) -> Answerer:
    """Captured model answers as the model."""
    return lambda rows, stage: scoring.join_responses(rows.drop("prompt"), responses, stage)


def answers_from_scorer(
    factory: scoring.ScorerFactory,
    profile: ResourceProfile | None = None,
    limits: scoring.CallLimits = scoring.CallLimits(),
) -> Answerer:
    """A scorer inside the tasks as the model."""
    return lambda rows, stage: scoring.score_batch(rows, stage, factory, profile, limits)


def _ask(messages: DataFrame, stage: str, answer: Answerer) -> DataFrame:
    wanted = prompts.with_prompt(messages, stage).select(*KEY, "subject", "prompt")
    return answer(wanted, stage)


def _outcomes(parsed: DataFrame, classified: DataFrame, extracted: DataFrame) -> DataFrame:
    """What became of each message, one narrow row per message.

    Only the model calls are timed per message.  Upload, commit and the whole are not, so
    their times are NULL and no rate is computed from them.
    """
    called = F.coalesce(F.col("classify_sec"), F.lit(0.0))
    drawn = F.coalesce(F.col("extract_sec"), F.lit(0.0))
    error = F.coalesce(F.col("parse_error"), F.col("extract_error"))
    status = (
        F.when(F.col("parse_error").isNotNull(), metrics.FAILED)
        .when(~F.col("is_invoice"), metrics.NON_INVOICE)
        .when(F.col("extract_error") == decoding.NO_EXTRACTION, metrics.NO_EXTRACTION)
        .when(F.col("extract_error").isNotNull(), metrics.FAILED)
        .otherwise(metrics.INVOICE)
    )
    return (
        parsed.select(*KEY, "chunk_num", "parse_error")
        .join(classified.select(*KEY, "is_invoice", F.col("elapsed_sec").alias("classify_sec")), KEY, "left")
        .join(extracted.select(*KEY, "extract_error", F.col("elapsed_sec").alias("extract_sec")), KEY, "left")
        .select(
            *KEY,
            "chunk_num",
            status.alias("status"),
            error.alias("error"),
            F.lit(True).alias("committed"),
            F.lit(None).cast("double").alias("duration_sec"),
            called.alias("classification_time_sec"),
            drawn.alias("extraction_time_sec"),
            F.lit(None).cast("double").alias("s3_upload_time_sec"),
            F.lit(None).cast("double").alias("db_commit_time_sec"),
        )
    )


def located_and_lost(
    chosen: DataFrame, context: DataFrame, folders: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Messages whose folder and source are there, and the outcomes of all others.

    A message without folder or source fails with the reason; it does not count as
    processed and moves no mark.
    """
    there = context.select("source_folder_id")
    owners = folders.select(
        F.col("id").alias("source_folder_id"), "source_id").dropDuplicates(["source_folder_id"])
    lost = lookup_join(
        chosen.join(there, "source_folder_id", "left_anti"), owners, ["source_folder_id"], how="left")
    error = F.when(
        F.col("source_id").isNull(),
        F.concat(F.lit("Source folder "), F.col("source_folder_id").cast("string"), F.lit(" not found")),
    ).otherwise(F.concat(F.lit("Source "), F.col("source_id").cast("string"), F.lit(" not found")))
    lost = lost.select(
        *KEY, F.lit(metrics.FAILED).alias("status"), error.alias("error"), F.lit(False).alias("committed"))
    missing = [f for f in OUTCOME.fields if f.name not in lost.columns]
    return chosen.join(there, "source_folder_id", "left_semi"), lost.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in missing})


class StageClock:
    """Seconds of the jobs of a batch, as the driver sees them."""

    def __init__(self):
        self.begun = time.perf_counter()
        self.seconds: dict[str, float] = {}

    @contextlib.contextmanager
    def timed(self, stage: str):
        begun = time.perf_counter()
        yield
        self.seconds[stage] = self.seconds.get(stage, 0.0) + time.perf_counter() - begun

    def on_chunks(self, chunks: DataFrame) -> DataFrame:
        """Chunk rows with the times that are taken for a batch as a whole.

        One job serves all chunks, so each has the share of its messages.
        """
        total = F.coalesce(chunks.agg(F.sum("emails_fetched")).scalar(), F.lit(1))

        def share(seconds: float) -> Column:
            return F.round(F.lit(seconds) * F.col("emails_fetched") / total, 6)

        return chunks.withColumns({
            "duration_sec": share(time.perf_counter() - self.begun),
            "s3_upload_time_sec": share(self.seconds.get("upload", 0.0)),
            "db_commit_time_sec": share(self.seconds.get("commit", 0.0)),
        })


def process_messages(
    ledger: Ledger,
    batch_id: BatchId,
    chosen: DataFrame,
    fetch: Fetch,
    state: DataFrame,
    context: DataFrame,
    answer: Answerer,
    now: Column,
    sizes: RunSizes = RunSizes(),
    failures: DataFrame | None = None,
    extra_marks: DataFrame | None = None,
    lost: DataFrame | None = None,
    expected: int | None = None,
) -> None:
    """Parse, classify, extract and commit chosen messages as one batch.

    ``chosen`` names the messages and their ``chunk_num``; ``fetch`` adds the raw bytes to
    such rows.  They are fetched twice: for the texts of all messages, and later for the
    files of invoices, whose bytes are the only ones that are written.  ``state`` holds the
    marks and ``context`` the user, source and folder fields per ``source_folder_id``.
    ``failures`` names chunks to leave out, ``lost`` the outcomes of messages without a
    folder, ``expected`` how many messages there are about.  The caller has begun the batch.
    """
    clock = StageClock()
    readable = parsing.dealt(readable_messages(fetch(chosen)).select(*KEY, "chunk_num", "rfc822_data"), expected)
    parsed = ledger.hand_over("parsed", _lean(parsing.parse_texts(readable)), batch_id)

    # the short question goes to every message, the long one to likely invoices only
    asked = _ask(parsing.parsed_messages(parsed), "classify", answer)
    classified = ledger.hand_over("classified", decoding.decode_classification(asked), batch_id)
    likely = parsed.join(classified.filter("is_invoice").select(*KEY), KEY, "left_semi")
    extracted = ledger.hand_over(
        "extracted", decoding.decode_invoice(_ask(likely, "extract", answer)), batch_id
    )

    outcome = _outcomes(parsed, classified, extracted)
    if failures is not None:
        left_out = failures.select("source_folder_id", "chunk_num").distinct().withColumn(
            "_failed", F.lit(True))
        outcome = outcome.join(left_out, ["source_folder_id", "chunk_num"], "left").withColumn(
            "committed", F.col("_failed").isNull()).drop("_failed")
    if lost is not None:
        outcome = outcome.unionByName(lost)
    ledger.stage("outcome", outcome, batch_id)
    outcome = ledger.staged("outcome", batch_id).filter(F.col("chunk_num").isNotNull())
    chunks = metrics.chunk_metrics(outcome, F.lit(str(batch_id)))
    committed = outcome
    if failures is not None:
        committed = cm.successful_chunks(outcome, failures)
        chunks = cm.successful_chunks(chunks, failures)

    # invoices with their narrow columns: what is looked for in the ledger, and in which buckets
    found = outcome.filter(F.col("status") == metrics.INVOICE).select(*KEY, "chunk_num")
    fields = context.select("source_folder_id", *reconcile.NATURAL_KEY, "user_id")
    located = ledger.hand_over(
        "located",
        lookup_join(found, fields, ["source_folder_id"])
        .join(parsed.select(*KEY, "message_id", "filenames"), KEY)
        .join(extracted.select(*KEY, F.col("invoice.invoice_number").alias("invoice_number")), KEY),
        batch_id,
    )

    def upload() -> None:
        with clock.timed("upload"):
            # files of a failed chunk are stored as well: they go up before the commit
            ledger.stage("attachment", _new_files(ledger, batch_id, located, fetch, expected), batch_id)

    def add_invoices() -> None:
        kept = located if failures is None else cm.successful_chunks(located, failures)
        invoices = (
            kept.drop("invoice_number").join(extracted.select(*KEY, "invoice.*"), KEY)
            .withColumns({
                "attached_files": att.attached_files(F.col("filenames")),
                "created_at": now,
                "updated_at": now,
            })
            .drop("filenames")
        )
        # equal keys have equal numbers, so the numbers' buckets hold every conflict
        buckets = None
        if "invoice_number" in sizes.conflict_keys:
            buckets = ledger.touched("invoice", kept)
        new = cm.insert_invoices(
            invoices, ledger.read("invoice", buckets=buckets),
            ["source_folder_id", "chunk_num", "uid"], sizes.conflict_keys, ledger.newest().top_id,
        )
        ledger.stage("invoice", new, batch_id)

    def move_marks() -> None:
        marks = cm.merge_watermarks(state, cm.uid_bounds(committed))
        if extra_marks is not None:
            marks = marks.unionByName(extra_marks)
        # every bucket that is touched has to be written whole, so the buckets of all messages do
        places = ledger.touched_by(
            outcome.withColumn("span", intervals.span_of("uid")), "watermark", "processed")
        moved = ledger.moved_marks(
            marks.withColumn("processed_at", now), places["watermark"] if extra_marks is None else None)
        together(
            ledger.spark,
            lambda: ledger.stage("watermark", moved, batch_id),
            lambda: ledger.stage(
                "processed", ledger.more_processed(committed, places["processed"]), batch_id),
        )

    def commit() -> None:
        with clock.timed("commit"):
            together(ledger.spark, add_invoices, move_marks)

    # none reads what another writes, and nobody sees any of it before the marker
    together(ledger.spark, upload, commit)
    ledger.stage("chunk_metrics", clock.on_chunks(chunks), batch_id)
    ledger.commit(batch_id)
    ledger.release(batch_id)


def _lean(parsed: DataFrame) -> DataFrame:
    """Parsed messages with what later steps read: bodies cut, files by name."""
    return prompts.cut_bodies(parsed).withColumn("filenames", F.col("attachments.filename")).drop(
        "attachments", "to_address", "date")


def _new_files(
    ledger: Ledger, batch_id: BatchId, located: DataFrame, fetch: Fetch, expected: int | None = None
) -> DataFrame:
    """The files of invoices that the store does not hold, with their bytes.

    Which ones are missing is found by names alone, in the buckets of their keys; then the
    messages that have some are fetched once more and their files parsed.
    """
    named = F.transform("filenames", lambda name: F.struct(name.alias("filename")))
    names = located.filter(F.size("filenames") > 0).withColumn(
        "attachments", att.first_files(named)).drop("filenames")
    keys = names.select(*KEY, F.explode("attachments.filename").alias("filename"), *reconcile.NATURAL_KEY, "user_id")
    keys = ledger.hand_over("file_keys", att.with_file_key(keys).select(*KEY, "file_key"), batch_id)
    stored = ledger.read("attachment", buckets=ledger.touched("attachment", keys)).select("file_key")
    missing = keys.join(stored, "file_key", "left_anti").groupBy(*KEY).agg(
        F.collect_list("file_key").alias("wanted"))
    whose = located.select(*KEY, *reconcile.NATURAL_KEY, "user_id").join(missing, KEY)
    raw = parsing.dealt(readable_messages(fetch(whose)), expected)
    files = parsing.parse_files(raw.select(*KEY, *reconcile.NATURAL_KEY, "user_id", "wanted", "rfc822_data"))
    files = files.withColumn("attachments", att.first_files(F.col("attachments"))).withColumn(
        "attachments", F.filter("attachments", lambda f: F.array_contains("wanted", att.message_key(f["filename"]))))
    exploded = parsing.explode_attachments(files, *reconcile.NATURAL_KEY, "user_id")
    return att.with_file_key(exploded).select("file_key", "content_type", "data", "size_bytes")


def run_folders(
    ledger: Ledger,
    batch_id: BatchId,
    messages: DataFrame | MailLayout,
    state: DataFrame,
    context: DataFrame,
    answer: Answerer,
    now: Column,
    sizes: RunSizes = RunSizes(),
    failures: DataFrame | None = None,
) -> None:
    """Select what the folders in ``state`` read next, and process it."""
    if ledger.is_committed(batch_id):
        return
    ledger.begin(batch_id)
    _run_folders(
        ledger, batch_id, messages, state, context, answer, now, sizes, failures
    )


def _run_folders(
    ledger: Ledger,
    batch_id: BatchId,
    messages: DataFrame | MailLayout,
    state: DataFrame,
    context: DataFrame,
    answer: Answerer,
    now: Column,
    sizes: RunSizes,
    failures: DataFrame | None,
    created: bool = False,
) -> None:
    laid_out = isinstance(messages, MailLayout)
    keys = messages.keys() if laid_out else message_keys(messages)
    by_name = "source_folder_id" not in keys.columns
    names = context.select("source_folder_id", *reconcile.NATURAL_KEY)
    if by_name:
        keys = lookup_join(keys, names, reconcile.NATURAL_KEY).drop(*reconcile.NATURAL_KEY)
    folders = ledger.read("source_folder").unionByName(
        ledger.staged("source_folder", batch_id)) if created else ledger.read("source_folder")
    gaps = None
    if sizes.fill_gaps:
        before = folders.select(
            F.col("id").alias("source_folder_id"), "high_water_mark", "low_water_mark")
        gaps = selection.gap_messages(keys, state, before, ledger.intervals())
    chosen = ledger.hand_over(
        "selected",
        selection.select_batch(keys, state, sizes.batch_size, sizes.chunk_size, gaps),
        batch_id,
    )
    expected = chosen.count()
    # messages of folders that nobody knows are reported as well
    unknown = keys.select(*KEY).join(
        folders.select(F.col("id").alias("source_folder_id")), "source_folder_id", "left_anti")
    chosen, lost = located_and_lost(
        chosen.unionByName(unknown, allowMissingColumns=True), context, folders)

    def fetch(rows: DataFrame) -> DataFrame:
        if by_name and not set(reconcile.NATURAL_KEY) <= set(rows.columns):
            rows = lookup_join(rows, names, ["source_folder_id"])
        return messages.fetch(rows) if laid_out else selection.fetch_selected(messages, rows)

    seen = keys.filter("readable")  # a span of unreadable messages is as good as empty
    extra = (
        cm.advance_empty_spans(state, seen, sizes.batch_size) if sizes.advance_empty else None
    )
    process_messages(
        ledger, batch_id, chosen, fetch, state, context, answer, now, sizes, failures, extra, lost,
        expected)


def run_isolated(
    ledger: Ledger,
    run_id: BatchId,
    messages: DataFrame | MailLayout,
    state: DataFrame,
    context: DataFrame,
    answer: Answerer,
    now: Column,
    sizes: RunSizes = RunSizes(),
    groups: int = 8,
    halvings: int = 2,
    key: Column | None = None,
) -> list[tuple[str, str]]:
    """Run groups of folders as batches of their own, so that one that fails costs only itself.

    Folders are dealt into ``groups`` by ``key`` (a digest of their id).  A group whose jobs
    fail is cut in two and both halves are tried, ``halvings`` times over; what fails then is
    recorded as the outcome of its folders and left as it was: its rows are unseen and its
    marks unmoved, so that any later run reads its messages.  Groups that were committed
    under this ``run_id`` before are passed over, so the same call also completes a run.

    ``messages`` name their folder by its id.  Each group scans their keys; groups follow one
    another, for a ledger has one writer.  Returns ``(batch, reason)`` of what failed.
    """
    place = F.xxhash64("source_folder_id") if key is None else key
    failed: list[tuple[str, str]] = []

    def attempt(parts: int, part: int, left: int) -> None:
        name, mine = f"{run_id}-{part}-of-{parts}", F.pmod(place, F.lit(parts)) == part
        folders = state.filter(mine)
        try:
            run_folders(
                ledger, name, messages.filter(mine), folders, context, answer, now, sizes)
        except Exception as error:
            if left:
                # a folder of this part is in one of the two parts of twice as many
                for half in (part, part + parts):
                    attempt(parts * 2, half, left - 1)
            else:
                failed.append((name, _reason(error)))
                _record_failure(ledger, name, folders, failed[-1][1])

    for part in range(groups):
        attempt(groups, part, halvings)
    return failed


def _reason(error: Exception) -> str:
    lines = str(error).strip().splitlines()
    return lines[0] if lines else type(error).__name__


def _record_failure(ledger: Ledger, name: str, folders: DataFrame, reason: str) -> None:
    """An outcome for every folder of a failed group, as a batch that moves nothing."""
    batch_id = f"{name}-failed-{uuid.uuid4().hex}"
    ledger.begin(batch_id)
    known = {
        "source_folder_id": F.col("source_folder_id"), "status": F.lit(metrics.FAILED),
        "error": F.lit(reason), "committed": F.lit(False),
    }
    ledger.stage("outcome", folders.select(*[
        known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in OUTCOME.fields
    ]), batch_id)
    ledger.commit(batch_id)


def documents_path(ledger: Ledger, batch_id: BatchId) -> str:
    return f"{ledger.root}/documents/batch_id={batch_id}"


def write_documents(ledger: Ledger, batch_id: BatchId, now: Column) -> None:
    """The documents of a batch, one per folder it read, from the ledger's own rows.

    Written anew they are the same, so a crash behind the commit costs nothing.
    """
    chunks = batch_rows(ledger, "chunk_metrics", batch_id)
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss")
    write_metrics(
        metrics.folder_documents(metrics.folder_rollup(chunks), chunks, stamp),
        documents_path(ledger, batch_id), mode="overwrite")


def documents(ledger: Ledger, batch_id: BatchId) -> DataFrame:
    return read_metrics(ledger.spark, documents_path(ledger, batch_id)).drop("run_date")


def run(
    ledger: Ledger,
    batch_id: BatchId,
    sources: DataFrame,
    refreshes: DataFrame,
    listing: DataFrame,
    messages: DataFrame | MailLayout,
    answer: Answerer,
    now: Column,
    sizes: RunSizes = RunSizes(),
    failures: DataFrame | None = None,
) -> DataFrame:
    """The whole run; returns its one-row summary.

    ``now`` is one literal without zone, in UTC, for the whole run.  ``messages`` may name
    their folder by its natural key, so that mail of a folder this run creates is read in
    this run; ``folder_results`` tells what became of each folder and ``documents`` holds
    one document for each folder that was read.
    """
    tokens = reconcile.source_tokens(sources, refreshes, now)
    usable = tokens.filter(F.col("access_token").isNotNull()).select("source_id")
    listed = listing.join(usable, "source_id", "left_semi")
    stamp = now.cast("timestamp")
    if not ledger.is_committed(batch_id):
        ledger.begin(batch_id)
        known = ledger.folders()
        missing = reconcile.reconcile_missing(listed, known)
        ledger.stage("source_folder", reconcile.create_folders(missing, known, stamp), batch_id)
        created = ledger.staged("source_folder", batch_id)
        folders = known.unionByName(created)
        context = run_context(listed, folders, sources)
        state = folders.select(
            F.col("id").alias("source_folder_id"), "high_water_mark", "low_water_mark"
        ).join(context.select("source_folder_id"), "source_folder_id", "left_semi")
        _run_folders(
            ledger, batch_id, messages, state, context, answer, stamp, sizes, failures,
            created=True,
        )
    write_documents(ledger, batch_id, now)
    reconciled = run_context(listed, ledger.read("source_folder"), sources)
    rollup = metrics.folder_rollup(
        batch_rows(ledger, "chunk_metrics", batch_id),
        None if failures is None else failed_emails(ledger, batch_id, failures),
    )
    results = reconciled.select("source_folder_id").join(rollup, "source_folder_id", "left")
    return metrics.run_rollup(results, tokens, reconciled)


def run_context(listing: DataFrame, folders: DataFrame, sources: DataFrame) -> DataFrame:
    """Folder, source and user fields of every listed folder, by ``source_folder_id``."""
    owners = sources.select(F.col("id").alias("source_id"), "user_id")
    listed = reconcile.reconcile_existing(listing, folders)
    return lookup_join(listed, owners, ["source_id"]).withColumnRenamed(
        "id", "source_folder_id"
    )


def folder_results(ledger: Ledger, batch_id: BatchId, folders: DataFrame) -> DataFrame:
    """One row per folder a batch was to read: its sums, or the reason it has none."""
    reasons = (
        batch_rows(ledger, "outcome", batch_id).filter(F.col("chunk_num").isNull())
        .groupBy("source_folder_id").agg(F.min("error").alias("error"))
    )
    spawned = folders.select("source_folder_id").union(reasons.select("source_folder_id")).distinct()
    rollup = metrics.folder_rollup(batch_rows(ledger, "chunk_metrics", batch_id))
    return metrics.worker_results(spawned, rollup, reasons)


def batch_rows(ledger: Ledger, table: str, batch_id: BatchId) -> DataFrame:
    return (
        ledger.read(table, with_batch=True).filter(F.col("batch_id") == str(batch_id)).drop("batch_id")
    )


def failed_emails(ledger: Ledger, batch_id: BatchId, failures: DataFrame) -> DataFrame:
    """``(source_folder_id, chunk_num, emails)`` of the chunks a batch left out."""
    failed = failures.select("source_folder_id", "chunk_num").distinct()
    return (
        batch_rows(ledger, "outcome", batch_id)
        .join(failed, ["source_folder_id", "chunk_num"], "left_semi")
        .groupBy("source_folder_id", "chunk_num")
        .agg(F.count(F.lit(1)).alias("emails"))
    )
