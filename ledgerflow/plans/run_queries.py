"""Whole runs and the stream, on raw messages made from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from ledgerflow.operators import commit as cm
from ledgerflow.operators import decoding as dc
from ledgerflow.operators import selection as sel
from ledgerflow.operators.ledger import Ledger
from ledgerflow.plans import catalog as c
from ledgerflow.plans import run as rn
from ledgerflow.plans.catalog import query, with_ctes
from ledgerflow.plans.fixtures import Inputs, now
from ledgerflow.plans.ingest_queries import MERGED, MIXED
from ledgerflow.plans.ledger_queries import empty_ledger
from ledgerflow.session import new_run_dir
from ledgerflow.sources.connector import CapturedSource, capture
from ledgerflow.sources.layout import MailLayout
from ledgerflow.sources.messages import read_connector, stream_connector
from ledgerflow.streaming import keyed_state
from ledgerflow.streaming.incremental import ingest_arrivals, start_incremental

EVENTS = StructType([
    StructField("event_id", LongType()),
    StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()),
    StructField("event_type", StringType()),
    StructField("value", DoubleType()),
    StructField("props", StringType()),
])


@query("second_run_marks", with_ctes([
    *MIXED, *c.selected(20, 4), MERGED,
    """state_2 AS (
  SELECT s.source_folder_id, coalesce(m.high_water_mark, s.high_water_mark) AS high_water_mark,
    coalesce(m.low_water_mark, s.low_water_mark) AS low_water_mark
  FROM state s LEFT JOIN merged m USING (source_folder_id))""",
    *[
        text.replace("state s", "state_2 s").replace("eligible", "eligible_2")
        .replace("capped", "capped_2").replace("selection", "selection_2")
        .replace("merged", "merged_2")
        for text in [*c.selected(20, 4), MERGED]
    ],
], """
SELECT s.source_folder_id, coalesce(m.high_water_mark, s.high_water_mark) AS high_water_mark,
  coalesce(m.low_water_mark, s.low_water_mark) AS low_water_mark
FROM state_2 s LEFT JOIN merged_2 m USING (source_folder_id)"""))
def second_run_marks(i):
    """Two runs, one after the other: folders move on forward and backward."""
    state = i.state()
    for _ in range(2):
        chosen = sel.select_batch(i.messages(), state, 20, 4)
        state = cm.next_state(state, cm.merge_watermarks(state, cm.uid_bounds(chosen)))
    return state


# -- stream ----------------------------------------------------------------------


ARRIVALS = 5


def arrival_of(event_id):
    """With which arrival an event comes; every arrival runs through all uids."""
    return (event_id * 3 + 1) % ARRIVALS


def arrive(i: Inputs, path: str, number: int) -> None:
    """Write one arrival of events to the folder a stream reads.

    A stream reads a small file in one task and parses its mail there, so a table of fewer
    splits than cores is dealt out first.
    """
    part = i.dealt("events").filter(arrival_of(F.col("event_id")) == number)
    part.write.mode("append").parquet(path)


def drain(i: Inputs, ledger: Ledger, path: str, checkpoint: str) -> None:
    """Run a stream over a folder of events until it is dry; what is new is one micro-batch."""
    events = i.spark.readStream.schema(EVENTS).parquet(path)
    start_incremental(
        i.raw_events(events), ledger, i.event_context(),
        rn.answers_from_table(i.event_responses()), checkpoint,
        now=lambda: now().cast("timestamp"),
    ).awaitTermination()


def drained(i: Inputs, ledger: Ledger, name: str) -> str:
    """Let the event table arrive part by part, no folder's uids in order, and take it in."""
    path, checkpoint = (new_run_dir(i.spark, f"{name}-{what}") for what in ("events", "checkpoint"))
    for number in range(ARRIVALS):
        arrive(i, path, number)
        drain(i, ledger, path, checkpoint)
    return path


def streamed(i: Inputs, name: str) -> Ledger:
    """A ledger that took the whole event table in through the stream."""
    ledger = empty_ledger(i, name, i.event_folders())
    drained(i, ledger, name)
    return ledger


FOUND = f"""found AS (
  SELECT source_folder_id, uid, CAST(source_folder_id % 25 AS VARCHAR) AS user_id,
    CASE WHEN uid % 10 <> 0 THEN 'INV-' || (uid % 500) END AS invoice_number,
    CAST(round(value, 2) AS DOUBLE) AS total_amount,
    (source_folder_id % 25) || '/' || source_folder_id || '/INBOX/1/' || uid || '/props.json' AS file_key
  FROM messages WHERE event_type = 'purchase')"""
STREAM_FIRSTS = """firsts AS (
  SELECT * EXCLUDE (r) FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_number ORDER BY source_folder_id, uid) AS r
    FROM found) WHERE r = 1 OR invoice_number IS NULL)"""
# of equal numbers that of the first arrival counts
ARRIVAL_FIRSTS = STREAM_FIRSTS.replace(
    "ORDER BY source_folder_id", "ORDER BY ((uid - 1) * 3 + 1) % 5, source_folder_id")


@query("incremental_stream", with_ctes([c.MESSAGES, FOUND, ARRIVAL_FIRSTS], """
SELECT source_folder_id, uid, user_id, invoice_number, total_amount,
  '[{"file_name":"props.json","file_key":"' || file_key || '"}]' AS attached_files,
  '<' || (uid - 1) || '@example.com>' AS message_id FROM firsts"""))
def incremental_stream(i):
    """Invoices in the ledger after the stream has run dry, over five arrivals out of order."""
    return streamed(i, "stream").read("invoice").select(
        "source_folder_id", "uid", "user_id", "invoice_number",
        F.col("total_amount").cast("double").alias("total_amount"),
        dc.attached_files_json(F.col("attached_files")).alias("attached_files"),
        "message_id",
    )


@query("folder_state", with_ctes([c.MESSAGES], """
SELECT source_folder_id, max(uid) AS high_water_mark, min(uid) AS low_water_mark
FROM messages GROUP BY 1"""))
def folder_state(i):
    """Marks of every folder after the stream has run dry."""
    return streamed(i, "state").state()


@query("stored_attachments", with_ctes([c.MESSAGES, FOUND], """
SELECT f.file_key, 'text/plain' AS content_type, props AS content
FROM found f JOIN events e ON e.event_id + 1 = f.uid"""))
def stored_attachments(i):
    """Objects in the store after the stream has run dry."""
    return streamed(i, "objects").read("attachment").select(
        "file_key", "content_type", F.decode("data", "UTF-8").alias("content")
    )


@query("idempotent_replay", with_ctes([c.MESSAGES, FOUND, STREAM_FIRSTS], """
SELECT invoice_number IS NULL AS unnumbered,
  CAST(count(*) * CASE WHEN invoice_number IS NULL THEN 2 ELSE 1 END AS BIGINT) AS invoices,
  (SELECT count(*) FROM found) AS objects
FROM firsts GROUP BY 1"""))
def idempotent_replay(i):
    """The same messages once more: as the same batch, then as new arrivals.

    The committed batch is skipped.  New arrivals add no numbered invoice and no
    object; invoices without a number are entered again.
    """
    ledger = empty_ledger(i, "replay", i.event_folders())
    answer = rn.answers_from_table(i.event_responses())
    arrivals = i.raw_events(i.dealt("events"))
    stamp = now().cast("timestamp")
    for batch_id in (0, 0):
        ingest_arrivals(ledger, batch_id, arrivals, i.event_context(), answer, stamp)
    every = sel.select_arrivals(arrivals.select("source_folder_id", "uid"), i.first_state())
    rn.process_messages(
        ledger, 1, every, lambda rows: sel.fetch_selected(arrivals, rows), i.first_state(),
        i.event_context(), answer, stamp,
    )
    objects = cm.affected_count(ledger.read("attachment")).scalar()
    return (
        ledger.read("invoice")
        .groupBy(F.col("invoice_number").isNull().alias("unnumbered"))
        .agg(F.count(F.lit(1)).alias("invoices"))
        .withColumn("objects", objects)
    )


PROCESSED = with_ctes([c.MESSAGES], """
SELECT source_folder_id, uid, CAST(1 AS BIGINT) AS times FROM messages""")


def processed_times(ledger: Ledger) -> DataFrame:
    return ledger.processed().groupBy("source_folder_id", "uid").agg(
        F.count(F.lit(1)).alias("times"))


@query("stream_after_batch", PROCESSED)
def stream_after_batch(i):
    """A small run, then the stream on the same ledger: every message once."""
    ledger = empty_ledger(i, "after-batch", i.event_folders())
    rn.run_folders(
        ledger, 0, i.raw_events(i.dealt("events")), ledger.state(), i.event_context(),
        rn.answers_from_table(i.event_responses()), now().cast("timestamp"),
        rn.RunSizes(batch_size=3, chunk_size=2),
    )
    drained(i, ledger, "after-batch")
    return processed_times(ledger)


@query("stream_two_checkpoints", PROCESSED)
def stream_two_checkpoints(i):
    """The same files through two streams with checkpoints of their own: every message once."""
    ledger = empty_ledger(i, "two", i.event_folders())
    drain(i, ledger, drained(i, ledger, "two"), new_run_dir(i.spark, "two-second"))
    return processed_times(ledger)


@query("run_missing_context", with_ctes([c.MESSAGES, FOUND, STREAM_FIRSTS.replace(
    "FROM found)", "FROM found WHERE source_folder_id % 5 > 0 AND source_folder_id % 7 > 0)")], """
SELECT source_folder_id, CASE WHEN source_folder_id % 7 = 0
    THEN 'Source folder ' || source_folder_id || ' not found'
    WHEN source_folder_id % 5 = 0 THEN 'Source ' || source_folder_id || ' not found' END AS error,
  count(*) AS messages,
  CASE WHEN source_folder_id % 7 = 0 OR source_folder_id % 5 = 0 THEN CAST(0 AS BIGINT)
    ELSE count(*) FILTER (event_type = 'purchase') END AS found,
  (SELECT count(*) FROM firsts f WHERE f.source_folder_id = m.source_folder_id) AS inserted
FROM messages m GROUP BY source_folder_id"""))
def run_missing_context(i):
    """Mail of folders that are gone, or whose source is, fails with the reason; no mark moves."""
    key = F.col("source_folder_id")
    ledger = empty_ledger(i, "missing", i.event_folders().filter(F.col("id") % 7 > 0))
    context = i.event_context().filter((key % 5 > 0) & (key % 7 > 0))
    ingest_arrivals(
        ledger, "missing", i.raw_events(i.dealt("events")), context,
        rn.answers_from_table(i.event_responses()), now().cast("timestamp"),
    )
    inserted = ledger.read("invoice").groupBy("source_folder_id").agg(
        F.count(F.lit(1)).alias("inserted"))
    marked = ledger.marks().select("source_folder_id", F.lit(True).alias("marked"))
    outcome = ledger.read("outcome").join(marked, "source_folder_id", "left")
    # a mark on a folder that failed would show as an error text of its own
    told = F.when(F.col("committed"), F.lit(None)).when(F.col("marked"), F.lit("marked")).otherwise(
        F.col("error"))
    return outcome.groupBy("source_folder_id", told.alias("error")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("status") == "invoice").alias("found"),
    ).join(inserted, "source_folder_id", "left").withColumn(
        "inserted", F.coalesce("inserted", F.lit(0)))


@query("isolated_failures", with_ctes([c.MESSAGES], """
SELECT source_folder_id, CASE WHEN source_folder_id % 4 = 3 THEN CAST(0 AS BIGINT) ELSE count(*) END AS first_run,
  count(*) AS both_runs,
  CASE WHEN source_folder_id % 4 = 3 THEN 'model lost' END AS error FROM messages GROUP BY 1"""))
def isolated_failures(i):
    """A run in which the model fails for one of two groups, then one in which it does not.

    The group is halved, and only the half with the failing folders is left out.
    """
    ledger = empty_ledger(i, "isolated", i.event_folders())
    arrivals, ready = i.raw_events(i.dealt("events")), rn.answers_from_table(i.event_responses())
    sizes = rn.RunSizes(batch_size=FAR_MORE, chunk_size=FAR_MORE, fill_gaps=False)

    def failing(rows: DataFrame, stage: str) -> DataFrame:
        lost = F.when(F.col("source_folder_id") % 4 == 3, F.raise_error(F.lit("model lost")))
        return ready(rows, stage).withColumn("error", F.coalesce(lost.cast("string"), "error"))

    def times(of: DataFrame, name: str) -> DataFrame:
        return of.groupBy("source_folder_id").agg(F.count(F.lit(1)).alias(name))

    runs = []
    for name, answer, groups in (("bad", failing, 2), ("good", ready, 1)):
        rn.run_isolated(
            ledger, name, arrivals, ledger.state(), i.event_context(), answer,
            now().cast("timestamp"), sizes, groups=groups, halvings=1, key=F.col("source_folder_id"),
        )
        # read now: later batches would show up in a frame that is read later
        runs.append(ledger.hand_over(f"seen-{name}", ledger.processed(), name))
    told = F.when(F.col("error").contains("model lost"), F.lit("model lost")).otherwise(F.col("error"))
    reasons = ledger.read("outcome").filter("uid IS NULL").select("source_folder_id", told.alias("error"))
    return (
        times(runs[1], "both_runs").join(times(runs[0], "first_run"), "source_folder_id", "left")
        .join(reasons, "source_folder_id", "left")
        .withColumn("first_run", F.coalesce("first_run", F.lit(0).cast("bigint")))
    )


# no folder holds so many messages
FAR_MORE = 1 << 20


@query("capped_runs", with_ctes([c.MESSAGES], """
SELECT source_folder_id, uid, CAST(1 AS BIGINT) AS times FROM messages"""))
def capped_runs(i):
    """More new mail than a run may read: the next run reads what the first one passed over."""
    most = i.messages().groupBy("source_folder_id").count().agg(F.max("count")).first()[0]
    ledger = empty_ledger(i, "capped", i.event_folders())
    # the second run's backfill span holds nothing: the first run also took the lowest uids
    lowest = i.table("events").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    arrivals = i.raw_events(i.dealt("events"))
    first = i.raw_events(i.table("events").join(lowest, ["user_id", "event_id"], "left_semi"))
    for name, mail, cap in (("lowest", first, 1), ("newest", arrivals, (most + 1) // 2), ("rest", arrivals, most)):
        rn.run_folders(
            ledger, name, mail, ledger.state(), i.event_context(),
            rn.answers_from_table(i.event_responses()), now().cast("timestamp"),
            rn.RunSizes(batch_size=cap, chunk_size=7),
        )
    return processed_times(ledger)


@query("keyed_marks", with_ctes([c.MESSAGES], """
SELECT source_folder_id, max(uid) AS high_water_mark, min(uid) AS low_water_mark, count(*) AS messages
FROM messages GROUP BY 1"""))
def keyed_marks(i):
    """The marks once more, from the state of a stream; every arrival restarts from its checkpoint."""
    path, checkpoint, out = (new_run_dir(i.spark, f"keyed-{what}") for what in ("events", "checkpoint", "runs"))
    for number in range(2):
        # the second arrival also brings the first one again
        for part in range(number + 1):
            i.table("events").filter(F.col("event_id") % 2 == part).write.mode("append").parquet(path)
        arrivals = i.raw_events(i.spark.readStream.schema(EVENTS).parquet(path))
        keyed_state.keep_runs(arrivals, out, checkpoint).awaitTermination()
    messages = keyed_state.runs(i.spark, out).groupBy("source_folder_id").agg(
        F.sum(F.col("high") - F.col("low") + 1).alias("messages"))
    return keyed_state.marks(i.spark, out).join(messages, "source_folder_id")


# -- mail through a connector --------------------------------------------------------


@query("scan_messages", with_ctes([c.MESSAGES], """
SELECT source_folder_id, uid, event_type AS subject, TRUE AS whole FROM messages"""))
def scan_messages(i):
    """All mail as the Python data source fetches it."""
    i.spark.dataSource.register(CapturedSource)
    path = new_run_dir(i.spark, "captured")
    capture(i.raw_events(i.dealt("events")), path)
    raw = F.decode("rfc822_data", "UTF-8")
    return read_connector(i.spark, "captured_mail", path=path, uids_per_partition="20000").select(
        "source_folder_id", "uid", F.regexp_extract(raw, r"Subject: (\w+)\r\n", 1).alias("subject"),
        (F.octet_length("rfc822_data") == F.col("size_bytes")).alias("whole"))


@query("stream_connector", PROCESSED)
def connector_stream(i):
    """Mail streamed from the data source into the ledger, in two arrivals: every message once."""
    i.spark.dataSource.register(CapturedSource)
    path, checkpoint = (new_run_dir(i.spark, f"connector-{what}") for what in ("mail", "checkpoint"))
    ledger = empty_ledger(i, "connector", i.event_folders())
    events = i.table("events")
    middle = events.agg(F.floor(F.avg("event_id")).alias("middle")).first().middle or 0
    # within a mailbox uids only grow
    for later in (False, True):
        capture(i.raw_events(events.filter((F.col("event_id") > middle) == later)), path)
        start_incremental(
            stream_connector(i.spark, "captured_mail", path=path), ledger, i.event_context(),
            rn.answers_from_table(i.event_responses()), checkpoint,
            now=lambda: now().cast("timestamp"),
        ).awaitTermination()
    return processed_times(ledger)


# -- mail laid out by arrival, band and bucket ---------------------------------------


def laid_out(i: Inputs, name: str) -> MailLayout:
    """The event table as two arrivals: the lower uids, then the higher ones."""
    layout = MailLayout.at(i.spark, new_run_dir(i.spark, name), bands=4)
    events = i.table("events")
    middle = events.agg(F.floor(F.avg("event_id")).alias("middle")).first().middle or 0
    for arrival in range(2):
        part = events.filter((F.col("event_id") > middle).cast("int") == arrival)
        layout.append(i.raw_events(part), arrival)
    return layout


@query("pruned_fetch", with_ctes(MIXED, """
SELECT m.source_folder_id, m.uid, m.event_type AS subject FROM messages m JOIN state s USING (source_folder_id)
WHERE s.low_water_mark > 1
  AND m.uid BETWEEN greatest(1, s.low_water_mark - 1000) AND s.low_water_mark - 1"""))
def pruned_fetch(i):
    """The backfill mail, fetched from the places that hold any."""
    layout = laid_out(i, "pruned")
    keys = new_run_dir(i.spark, "pruned-keys")
    sel.backfill_only(layout.keys(), i.state(), 1000).select("source_folder_id", "uid").write.parquet(keys)
    raw = F.decode("rfc822_data", "UTF-8")
    return layout.fetch(i.spark.read.parquet(keys)).select(
        "source_folder_id", "uid", F.regexp_extract(raw, r"Subject: (\w+)\r\n", 1).alias("subject"))


@query("laid_out_run", with_ctes([c.MESSAGES], """
SELECT source_folder_id, uid, CASE WHEN event_type = 'purchase' THEN 'invoice'
  WHEN event_type IN ('view', 'click') THEN 'non_invoice'
  WHEN event_type = 'signup' THEN 'no_extraction' ELSE 'failed' END AS status
FROM (SELECT *, row_number() OVER (PARTITION BY source_folder_id ORDER BY uid DESC) AS r FROM messages)
WHERE r <= 30"""))
def laid_out_run(i):
    """A run whose mail lies in such a layout: selection, parsing, both model steps, commit."""
    ledger = empty_ledger(i, "laid-out", i.event_folders())
    rn.run_folders(
        ledger, 0, laid_out(i, "laid-out-mail"), ledger.state(), i.event_context(),
        rn.answers_from_table(i.event_responses()), now().cast("timestamp"),
        rn.RunSizes(batch_size=30, chunk_size=7),
    )
    return ledger.read("outcome").select("source_folder_id", "uid", "status")


# -- whole run ---------------------------------------------------------------------


def customer_listing(i: Inputs) -> DataFrame:
    """Two folders per source, of which only some inboxes are known."""
    names = F.explode(F.array(F.lit("INBOX"), F.lit("Spam"))).alias("name")
    return i.table("customer").select(
        F.col("c_custkey").alias("source_id"), names, F.lit("1").alias("uid_validity")
    )


RUN_CTES = [
    c.SOURCES, c.REFRESHES, c.TOKENS, c.MESSAGES,
    "usable AS (SELECT source_id FROM tokens WHERE access_token IS NOT NULL)",
    """taken_messages AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY source_folder_id, uid % 3 = 0 ORDER BY uid DESC) AS r
                 FROM messages WHERE source_folder_id IN (SELECT source_id FROM usable))
  WHERE r <= 50)""",
]


@query("run_documents", with_ctes(RUN_CTES, """
SELECT sum(n)::BIGINT AS emails, count(*) AS documents, sum(ceil(n / 7))::BIGINT AS chunks, CAST(0 AS BIGINT) AS untimed
FROM (SELECT source_folder_id, uid % 3 = 0 AS spam, count(*) AS n FROM taken_messages GROUP BY 1, 2)"""))
def run_documents(i):
    """The documents that a run writes: one per folder read, with the times of every chunk."""
    ledger, summary = whole_run(i, "documents")
    summary.first()
    chunks = F.col("metrics")
    timed = F.forall(chunks, lambda m: m["duration_sec"].isNotNull() & m["s3_upload_time_sec"].isNotNull()
                     & m["db_commit_time_sec"].isNotNull() & (m["duration_sec"] > 0))
    return rn.documents(ledger, 0).agg(
        F.sum("emails_fetched").alias("emails"), F.count(F.lit(1)).alias("documents"),
        F.sum("chunks_processed").alias("chunks"), F.count_if(~timed).alias("untimed"))


@query("run_summary", with_ctes(RUN_CTES, """
SELECT (SELECT count(*) FROM usable) AS sources_processed,
  2 * (SELECT count(*) FROM usable) AS folders_reconciled,
  2 * (SELECT count(*) FROM usable) AS workers_spawned,
  2 * (SELECT count(*) FROM usable) AS workers_completed,
  count(*) AS total_emails_fetched,
  count(*) FILTER (event_type = 'purchase') AS total_invoices_found,
  count(*) FILTER (event_type IN ('view', 'click')) AS total_non_invoices,
  count(*) FILTER (event_type IN ('error', 'signup')) AS total_errors
FROM taken_messages"""))
def run_summary(i):
    """Tokens, folders, selection, parsing, both model steps, commit and totals in one run.

    A third of the mail lies in folders that only this run creates.
    """
    return whole_run(i, "run")[1]


def whole_run(i: Inputs, name: str) -> tuple[Ledger, DataFrame]:
    """The ledger after one run over sources, listing and mail, and the summary of the run."""
    ledger = empty_ledger(i, name, i.event_folders())
    named = i.raw_events(i.dealt("events")).select(
        F.col("source_folder_id").alias("source_id"),
        F.when(F.col("uid") % 3 == 0, "Spam").otherwise("INBOX").alias("folder_name"),
        F.lit("1").alias("uid_validity"), "uid", "rfc822_data",
        F.octet_length("rfc822_data").cast("bigint").alias("size_bytes"),
    )
    responses = i.event_responses().drop("source_folder_id")

    def answer(rows: DataFrame, stage: str) -> DataFrame:
        # captured under the uid alone, for the folders' ids are not known before the run
        asked = responses.filter(F.col("stage") == stage).select("uid", "response", "error")
        return rows.drop("prompt").join(asked, "uid", "left").withColumn("elapsed_sec", F.lit(0.0))

    return ledger, rn.run(
        ledger, 0, i.sources(), i.refreshes(), customer_listing(i), named, answer, now(),
        rn.RunSizes(batch_size=50, chunk_size=7),
    )
