"""Invoices, marks, attachments, metrics, audits and whole runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators import attachments as att
from ledgerflow.operators import commit as cm
from ledgerflow.operators import decoding as dc
from ledgerflow.operators import metrics as mt
from ledgerflow.operators import quality as ql
from ledgerflow.operators import selection as sel
from ledgerflow.operators.ledger import Ledger
from ledgerflow.plans import catalog as c
from ledgerflow.plans.catalog import query, with_ctes
from ledgerflow.plans.fixtures import now
from ledgerflow.plans.ingest_queries import (
    FOLDER_TABLE,
    MERGED,
    MIXED,
    merged,
    plain_times,
    tokens,
)
from ledgerflow.session import new_run_dir
from ledgerflow.sources import metrics as sm
from ledgerflow.sources import objects as ob

# -- invoices --------------------------------------------------------------------

INVOICE_COLUMNS = ["invoice_number", "user_id", "source_id", "uid"]
FIRSTS = """firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY invoice_number ORDER BY uid) AS r
                 FROM invoices) WHERE r = 1 OR invoice_number IS NULL)"""
FRESH = """fresh AS (
  SELECT invoice_number, user_id, source_id, uid FROM firsts WHERE invoice_number IS NULL
    OR invoice_number NOT IN (SELECT invoice_number FROM taken))"""
INSERTED = "inserted AS (" + c.numbered("fresh", ["uid"], "(SELECT max(id) FROM taken)") + ")"


@query("invoice_dedupe", with_ctes([c.INVOICES, FIRSTS], """
SELECT invoice_number, user_id, source_id, uid FROM firsts"""))
def invoice_dedupe(i):
    return cm.first_wins(i.invoices(), ["uid"]).select(*INVOICE_COLUMNS)


@query("invoice_dedupe_per_user", with_ctes([c.INVOICES], """
SELECT invoice_number, user_id, source_id, uid FROM (
  SELECT *, row_number() OVER (PARTITION BY invoice_number, user_id ORDER BY uid) AS r FROM invoices)
WHERE r = 1 OR invoice_number IS NULL"""))
def invoice_dedupe_per_user(i):
    return cm.first_wins(i.invoices(), ["uid"], ["invoice_number", "user_id"]).select(
        *INVOICE_COLUMNS
    )


@query("null_numbers_pass", with_ctes([c.INVOICES], """
SELECT user_id, count(*) AS invoices FROM invoices WHERE invoice_number IS NULL GROUP BY 1"""))
def null_numbers_pass(i):
    fresh = cm.drop_conflicts(
        cm.first_wins(i.invoices(), ["uid"]), i.existing_invoices(), ["uid"]
    )
    return (
        fresh.filter(F.col("invoice_number").isNull())
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("invoices"))
    )


@query("invoice_conflict", with_ctes([c.INVOICES, c.TAKEN], """
SELECT invoice_number, user_id, source_id, uid FROM invoices WHERE invoice_number IS NULL
  OR invoice_number NOT IN (SELECT invoice_number FROM taken)"""))
def invoice_conflict(i):
    return cm.drop_conflicts(i.invoices(), i.existing_invoices(), ["uid"]).select(
        *INVOICE_COLUMNS
    )


@query("insert_invoices", with_ctes([c.INVOICES, c.TAKEN, FIRSTS, FRESH, INSERTED], """
SELECT id, invoice_number, user_id, source_id, uid FROM inserted"""))
def insert_invoices(i):
    return cm.insert_invoices(i.invoices().drop("id"), i.existing_invoices(), ["uid"]).select(
        "id", *INVOICE_COLUMNS
    )


@query("affected_counts", with_ctes([c.INVOICES, c.TAKEN, FIRSTS, FRESH], """
SELECT (SELECT count(*) FROM invoices) AS offered, (SELECT count(*) FROM fresh) AS inserted"""))
def affected_counts(i):
    fresh = cm.insert_invoices(i.invoices().drop("id"), i.existing_invoices(), ["uid"])
    inserted = cm.affected_count(fresh).scalar()
    return cm.affected_count(i.invoices(), "offered").withColumn("inserted", inserted)


def cleared(ledger: Ledger, table: str) -> DataFrame:
    """Empty a table of the ledger; one row with the number of rows deleted."""
    left, deleted = cm.clear_table(ledger.read(table))
    count = deleted.first().deleted
    ledger.replace(f"clear-{table}", {table: left})
    return ledger.spark.range(1).select(F.lit(count).alias("deleted"))


@query("clear_invoices", "SELECT count(*) AS deleted, CAST(0 AS BIGINT) AS remaining FROM orders")
def clear_invoices(i):
    """The ledger's invoices are deleted for every later reader."""
    ledger = empty_ledger(i, "clear")
    ledger.replace("fill", {"invoice": i.invoices()})
    deleted = cleared(ledger, "invoice")
    return deleted.withColumn("remaining", cm.affected_count(ledger.read("invoice")).scalar())


@query("clear_folders", with_ctes(FOLDER_TABLE, """
SELECT count(*) AS deleted, CAST(0 AS BIGINT) AS remaining FROM folders"""))
def clear_folders(i):
    ledger = empty_ledger(i, "clear-folders", i.folders())
    deleted = cleared(ledger, "source_folder")
    return deleted.withColumn("remaining", cm.affected_count(ledger.read("source_folder")).scalar())


# -- marks and commits -------------------------------------------------------------


@query("update_watermarks", with_ctes([*MIXED, *c.selected(1000, 100), MERGED, *FOLDER_TABLE], """
SELECT f.id, f.source_id, f.folder_name, f.uid_validity,
  CASE WHEN m.source_folder_id IS NULL THEN f.high_water_mark ELSE m.high_water_mark END
    AS high_water_mark,
  CASE WHEN m.source_folder_id IS NULL THEN f.low_water_mark ELSE m.low_water_mark END
    AS low_water_mark,
  CASE WHEN m.source_folder_id IS NOT NULL THEN TIMESTAMP '2024-07-01' END AS last_processed_at,
  f.created_at,
  CASE WHEN m.source_folder_id IS NULL THEN f.updated_at ELSE TIMESTAMP '2024-07-01' END AS updated_at
FROM folders f LEFT JOIN merged m ON m.source_folder_id = f.id"""))
def update_watermarks(i):
    return plain_times(cm.update_watermarks(i.folders(), merged(i), now().cast("timestamp")))


def empty_ledger(i, name: str, folders: DataFrame | None = None) -> Ledger:
    return Ledger.create(i.spark, new_run_dir(i.spark, name), folders)


@query("commit_visible", with_ctes([c.INVOICES], """
SELECT invoice_number, user_id, source_id, uid FROM invoices WHERE uid % 2 = 0"""))
def commit_visible(i):
    """Two batches are written, one is committed, and the other stays out of sight."""
    ledger = empty_ledger(i, "commit")
    even = F.col("uid") % 2 == 0
    ledger.stage("invoice", i.invoices().filter(even), 1)
    ledger.stage("invoice", i.invoices().filter(~even), 2)
    ledger.commit(1)
    return ledger.read("invoice").select(*INVOICE_COLUMNS)


FAILED_CHUNKS = """failed AS (
  SELECT DISTINCT source_folder_id, chunk_num FROM selection WHERE (source_folder_id + chunk_num) % 5 = 0)"""


def chosen(i):
    return sel.select_batch(i.messages(), i.state(), 50, 7)


def failed_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.filter((F.col("source_folder_id") + F.col("chunk_num")) % 5 == 0)


@query("failed_chunk_rollback", with_ctes([*MIXED, *c.selected(50, 7), FAILED_CHUNKS], """
SELECT s.source_folder_id, count(*) AS emails,
  greatest(any_value(st.high_water_mark), max(s.uid)) AS high_water_mark,
  least(any_value(st.low_water_mark), min(s.uid)) AS low_water_mark
FROM selection s JOIN state st USING (source_folder_id)
WHERE NOT EXISTS (SELECT 1 FROM failed f
  WHERE f.source_folder_id = s.source_folder_id AND f.chunk_num = s.chunk_num)
GROUP BY 1"""))
def failed_chunk_rollback(i):
    """Failed chunks leave neither rows nor marks; the chunks around them do."""
    rows = cm.successful_chunks(chosen(i), failed_chunks(chosen(i)))
    emails = rows.groupBy("source_folder_id").agg(F.count(F.lit(1)).alias("emails"))
    return cm.merge_watermarks(i.state(), cm.uid_bounds(rows)).join(emails, "source_folder_id")


# -- attachments -------------------------------------------------------------------

FILE_CTES = [c.FILES, c.STORED]


@query("attachment_keys", with_ctes([c.FILES], "SELECT uid, position, filename, file_key FROM files"))
def attachment_keys(i):
    return att.with_file_key(i.files()).select("uid", "position", "filename", "file_key")


@query("upload_missing", with_ctes(FILE_CTES, """
SELECT file_key, 'text/plain' AS content_type, md5(content) AS content,
  octet_length(encode(content)) AS size_bytes
FROM (SELECT *, row_number() OVER (PARTITION BY file_key
        ORDER BY source_folder_id, uid, position) AS r FROM files)
WHERE r = 1 AND file_key NOT IN (SELECT file_key FROM stored)"""))
def upload_missing(i):
    new = att.upload_missing(att.with_file_key(i.files()), i.stored_files())
    return new.select("file_key", "content_type", F.md5("data").alias("content"), "size_bytes")


@query("attached_files_json", with_ctes([c.FILES], r"""
SELECT uid, '[' || string_agg('{"file_name":"' || replace(filename, '\', '\\') || '","file_key":"'
    || replace(file_key, '\', '\\') || '"}', ',' ORDER BY position) || ']' AS attached_files
FROM files GROUP BY uid"""))
def attached_files_json(i):
    first = i.files().filter(F.col("position") == 0)
    second = i.files().filter(F.col("position") == 1).select(
        "uid", F.col("filename").alias("other")
    )
    names = F.array("filename", "other")
    return first.join(second, "uid").select(
        "uid", dc.attached_files_json(att.attached_files(names)).alias("attached_files")
    )


@query("key_collisions", with_ctes([c.FILES], """
SELECT file_key, count(*) AS files FROM files GROUP BY 1 HAVING count(*) > 1"""))
def key_collisions(i):
    return att.key_collisions(att.with_file_key(i.files()))


@query("read_attachments", with_ctes(FILE_CTES, """
SELECT file_key, content, size_bytes FROM stored
WHERE file_key IN (SELECT file_key FROM files WHERE position = 1)"""))
def read_attachments(i):
    wanted = att.with_file_key(i.files()).filter(F.col("position") == 1)
    return ob.read_objects(i.stored_files(), wanted).select(
        "file_key", F.decode("data", "UTF-8").alias("content"), "size_bytes"
    )


@query("list_objects", with_ctes(FILE_CTES, """
SELECT file_key, size_bytes FROM stored WHERE starts_with(file_key, '1')"""))
def list_objects(i):
    return ob.list_objects(i.stored_files(), "1")


@query("first_objects", with_ctes(FILE_CTES, """
SELECT file_key, size_bytes FROM stored ORDER BY file_key LIMIT 10"""))
def first_objects(i):
    return ob.first_objects(i.stored_files(), 10)


@query("delete_by_prefix", with_ctes(FILE_CTES, """
SELECT file_key, (SELECT count(*) FROM stored WHERE starts_with(file_key, '1')) AS deleted
FROM stored WHERE NOT starts_with(file_key, '1')"""))
def delete_by_prefix(i):
    """Objects in the ledger's store after all under a prefix were deleted there."""
    ledger = empty_ledger(i, "prefix")
    ledger.replace("fill", {"attachment": i.stored_files()})
    deleted = att.count_by_prefix(ledger.read("attachment"), "1").first().deleted
    ledger.replace("delete", {"attachment": att.delete_by_prefix(ledger.read("attachment"), "1")})
    return ledger.read("attachment").select("file_key", F.lit(deleted).alias("deleted"))


# -- metrics -----------------------------------------------------------------------

OUTCOMES = """outcomes AS (
  SELECT source_folder_id, chunk_num, uid,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'invoice'
      WHEN 'signup' THEN 'no_extraction' ELSE 'non_invoice' END AS status,
    CASE event_type WHEN 'error' THEN 'malformed message'
      WHEN 'signup' THEN 'Invoice extraction returned None' END AS error,
    CAST(value AS DECIMAL(18, 6)) AS seconds FROM selection)"""
CHUNKS = """chunks AS (
  SELECT source_folder_id, chunk_num, count(*) AS emails_fetched,
    count(*) FILTER (status <> 'failed') AS emails_processed,
    count(*) FILTER (status = 'invoice') AS invoices_found,
    count(*) FILTER (status = 'non_invoice') AS non_invoices,
    count(error) AS errors, sum(seconds) AS seconds FROM outcomes GROUP BY 1, 2)"""
METRICS = [*MIXED, *c.selected(50, 7), OUTCOMES, CHUNKS]


def chunk_rows(i):
    return mt.chunk_metrics(i.outcomes(chosen(i)), F.lit("run 1"))


@query("chunk_metrics", with_ctes(METRICS, """
SELECT source_folder_id, chunk_num, emails_fetched, emails_processed, invoices_found, non_invoices,
  errors, CAST(seconds * 4 AS DOUBLE) AS duration_sec, CAST(seconds AS DOUBLE) AS classification_time_sec,
  CAST(seconds * 2 AS DOUBLE) AS extraction_time_sec, emails_fetched * 0.25::DOUBLE AS s3_upload_time_sec,
  emails_fetched * 0.75::DOUBLE AS db_commit_time_sec, 'run 1' AS worker_id FROM chunks"""))
def chunk_metrics(i):
    return chunk_rows(i).withColumn("errors", F.size("errors").cast("bigint"))


@query("count_rules", with_ctes(METRICS, """
SELECT count(*) AS chunks, CAST(0 AS BIGINT) AS broken FROM chunks"""))
def count_rules(i):
    """Fetched = processed + failed; processed = invoices + non-invoices + no extraction."""
    failed = F.count_if(F.col("status") == mt.FAILED).alias("failed")
    none = F.count_if(F.col("status") == mt.NO_EXTRACTION).alias("none")
    by = ["source_folder_id", "chunk_num"]
    outcomes = i.outcomes(chosen(i))
    joined = mt.chunk_metrics(outcomes).join(outcomes.groupBy(*by).agg(failed, none), by)
    holds = (F.col("emails_fetched") == F.col("emails_processed") + F.col("failed")) & (
        F.col("emails_processed")
        == F.col("invoices_found") + F.col("non_invoices") + F.col("none")
    )
    return joined.agg(F.count(F.lit(1)).alias("chunks"), F.count_if(~holds).alias("broken"))


@query("collect_errors", with_ctes(METRICS, """
SELECT source_folder_id, chunk_num, coalesce(
    '[' || string_agg('{"uid":' || uid || ',"error":"' || error || '"}', ',' ORDER BY uid)
      FILTER (error IS NOT NULL) || ']', '[]') AS errors
FROM outcomes GROUP BY 1, 2"""))
def collect_errors(i):
    return chunk_rows(i).select(
        "source_folder_id", "chunk_num", F.to_json("errors").alias("errors")
    )


ROLLUP = """failing AS (SELECT * FROM chunks WHERE (source_folder_id + chunk_num) % 5 = 0),
rollup_ AS (
  SELECT source_folder_id, CAST(sum(emails_fetched) AS BIGINT) AS emails_fetched,
    CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS chunks_processed,
    CAST(sum(CASE WHEN bad THEN 0 ELSE invoices_found END) AS BIGINT) AS invoices_found,
    CAST(sum(CASE WHEN bad THEN 0 ELSE non_invoices END) AS BIGINT) AS non_invoices,
    CAST(sum(CASE WHEN bad THEN emails_fetched ELSE errors END) AS BIGINT) AS errors
  FROM (SELECT *, (source_folder_id + chunk_num) % 5 = 0 AS bad FROM chunks) GROUP BY 1)"""


def rollup(i):
    chunks = chunk_rows(i)
    failed = failed_chunks(chunks).select(
        "source_folder_id", "chunk_num", F.col("emails_fetched").alias("emails")
    )
    good = cm.successful_chunks(chunks, failed_chunks(chunks))
    return mt.folder_rollup(good, failed)


@query("folder_rollup", with_ctes([*METRICS, ROLLUP], "SELECT * FROM rollup_"))
def folder_rollup(i):
    return rollup(i)


# folders that were started, of which some ended in an error
LOST = """lost AS (
  SELECT source_folder_id, 'worker lost' AS error FROM state WHERE source_folder_id % 8 = 6),
results AS (
  SELECT s.source_folder_id, r.* EXCLUDE (source_folder_id), l.error
  FROM state s LEFT JOIN (SELECT * FROM rollup_ WHERE source_folder_id % 8 <> 6) r USING (source_folder_id)
  LEFT JOIN lost l USING (source_folder_id))"""


def results(i):
    lost = F.col("source_folder_id") % 8 == 6
    spawned = i.state().select("source_folder_id")
    reasons = spawned.filter(lost).withColumn("error", F.lit("worker lost"))
    return mt.worker_results(spawned, rollup(i).filter(~lost), reasons)


@query("worker_results", with_ctes([*METRICS, ROLLUP, LOST], "SELECT * FROM results"))
def worker_results(i):
    return results(i)


@query("run_rollup", with_ctes(
    [*METRICS, ROLLUP, LOST, c.SOURCES, c.REFRESHES, c.TOKENS, *FOLDER_TABLE], """
SELECT (SELECT count(*) FROM tokens WHERE access_token IS NOT NULL) AS sources_processed,
  (SELECT count(*) FROM folders) AS folders_reconciled,
  count(*) AS workers_spawned, count(*) AS workers_completed,
  CAST(sum(coalesce(emails_fetched, 0)) AS BIGINT) AS total_emails_fetched,
  CAST(sum(coalesce(invoices_found, 0)) AS BIGINT) AS total_invoices_found,
  CAST(sum(coalesce(non_invoices, 0)) AS BIGINT) AS total_non_invoices,
  CAST(sum(coalesce(errors, 0)) AS BIGINT) AS total_errors FROM results"""))
def run_rollup(i):
    return mt.run_rollup(results(i), tokens(i), i.folders())


@query("metrics_round_trip", with_ctes(METRICS, """
SELECT source_folder_id, chunk_num, emails_fetched, errors,
  CAST(seconds AS DOUBLE) AS classification_time_sec, '20240701_000000' AS stamp FROM chunks"""))
def metrics_round_trip(i):
    """Folder documents written as JSON lines and read back chunk by chunk."""
    path = new_run_dir(i.spark, "metrics")
    chunks = chunk_rows(i)
    stamp = F.date_format(now(), "yyyy-MM-dd'T'HH:mm:ss")
    documents = mt.folder_documents(mt.folder_rollup(chunks), chunks, stamp)
    sm.write_metrics(documents, path)
    back = sm.read_metrics(i.spark, path)
    file_stamp = F.date_format(F.col("timestamp").cast("timestamp"), "yyyyMMdd_HHmmss")
    return back.select(file_stamp.alias("stamp"), F.explode("metrics").alias("m")).select(
        "m.source_folder_id", "m.chunk_num", "m.emails_fetched",
        F.size("m.errors").cast("bigint").alias("errors"), "m.classification_time_sec", "stamp",
    )


@query("run_kpis", with_ctes(METRICS, """
SELECT *, emails_processed / emails_fetched AS success_rate, errors / emails_fetched AS error_rate,
  emails_fetched * 60 / duration_sec AS emails_per_minute, duration_sec / emails_fetched AS sec_per_email,
  duration_sec / chunks AS sec_per_chunk
FROM (SELECT count(*) AS chunks, CAST(sum(emails_fetched) AS BIGINT) AS emails_fetched,
    CAST(sum(emails_processed) AS BIGINT) AS emails_processed,
    CAST(sum(invoices_found) AS BIGINT) AS invoices_found,
    CAST(sum(non_invoices) AS BIGINT) AS non_invoices, CAST(sum(errors) AS BIGINT) AS errors,
    CAST(sum(seconds * 4) AS DOUBLE) AS duration_sec FROM chunks)"""))
def run_kpis(i):
    return mt.run_kpis(chunk_rows(i))


# -- accuracy ----------------------------------------------------------------------

PREDICTED = """predicted AS (
  SELECT d.doc_id, n_chars % 3 <> 0 AS predicted, quality = 1 AS expected
  FROM documents d JOIN labels USING (doc_id))"""


def labelled(i):
    predictions = i.table("documents").select(
        "doc_id", (F.col("n_chars") % 3 != 0).alias("predicted")
    )
    gold = i.table("labels").select("doc_id", (F.col("quality") == 1).alias("expected"))
    return predictions, gold


@query("classifier_accuracy", with_ctes([PREDICTED], """
SELECT count(*) AS labelled, count(*) FILTER (predicted = expected) AS correct,
  avg(CASE WHEN predicted = expected THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM predicted"""))
def classifier_accuracy(i):
    return mt.classifier_accuracy(*labelled(i), ["doc_id"])


@query("confusion_counts", with_ctes([PREDICTED], """
SELECT predicted, expected, count(*) AS n FROM predicted GROUP BY 1, 2"""))
def confusion_counts(i):
    return mt.confusion_counts(*labelled(i), ["doc_id"])


# -- audits --------------------------------------------------------------------------

TABLE_CTES = [c.USERS, c.SOURCES, *FOLDER_TABLE, c.INVOICES]


def audit_sql() -> str:
    """One SELECT per declared rule."""
    views = {"user": "users", "source": "sources", "source_folder": "folders", "invoice": "invoices"}
    # the only required column that the inputs leave NULL anywhere
    parts = []
    for table, columns in ql.REQUIRED.items():
        for column in columns:
            broken = "id IS NULL"
            if (table, column) == ("user", "email_verified"):
                broken = "email_verified IS NULL"
            parts.append(
                f"SELECT 'not_null:{table}.{column}' AS rule, count(*) FILTER ({broken}) AS n "
                f"FROM {views[table]}"
            )
    for table, column in ql.UNIQUE:
        parts.append(
            f"SELECT 'unique:{table}.{column}', count({column}) - count(DISTINCT {column}) "
            f"FROM {views[table]}"
        )
    for table, column, parent in ql.FOREIGN:
        parts.append(
            f"SELECT 'foreign:{table}.{column}->{parent}', count(*) FROM {views[table]} "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT id FROM {views[parent]})"
        )
    return with_ctes(TABLE_CTES, "\nUNION ALL ".join(parts))


@query("constraint_audit", audit_sql())
def constraint_audit(i):
    return ql.constraint_audit(i.tables())


def ids_of(tables: dict[str, DataFrame]) -> DataFrame:
    """One comparable row per remaining row of every table."""
    none = F.lit(None).cast("bigint")
    parts = [
        tables["user"].select(F.lit("user").alias("tab"), "id", none.alias("a"), none.alias("b")),
        tables["source"].select(F.lit("source").alias("tab"), F.col("id").cast("string").alias("id"), none.alias("a"), none.alias("b")),
        tables["source_folder"].select(F.lit("source_folder").alias("tab"), F.col("id").cast("string").alias("id"), F.col("source_id").alias("a"), none.alias("b")),
        tables["invoice"].select(F.lit("invoice").alias("tab"), F.col("id").cast("string").alias("id"), F.col("source_id").alias("a"), F.col("source_folder_id").alias("b")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("delete_users", with_ctes([*TABLE_CTES, """gone AS (
  SELECT id FROM users WHERE CAST(id AS INTEGER) % 5 = 1),
gone_sources AS (SELECT id FROM sources WHERE user_id IN (SELECT id FROM gone)),
gone_folders AS (SELECT id FROM folders WHERE source_id IN (SELECT id FROM gone_sources))"""], """
SELECT 'user' AS tab, id, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b
FROM users WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'source', CAST(id AS VARCHAR), NULL, NULL FROM sources
WHERE id NOT IN (SELECT id FROM gone_sources)
UNION ALL SELECT 'source_folder', CAST(id AS VARCHAR), source_id, NULL FROM folders
WHERE id NOT IN (SELECT id FROM gone_folders)
UNION ALL SELECT 'invoice', CAST(id AS VARCHAR),
  CASE WHEN source_id NOT IN (SELECT id FROM gone_sources) THEN source_id END,
  CASE WHEN source_folder_id NOT IN (SELECT id FROM gone_folders) THEN source_folder_id END
FROM invoices WHERE user_id NOT IN (SELECT id FROM gone)"""))
def delete_users(i):
    gone = i.users().filter(F.col("id").cast("int") % 5 == 1).select("id")
    return ids_of(ql.delete_users(i.tables(), gone))


@query("delete_sources", with_ctes([*TABLE_CTES, """gone AS (
  SELECT id FROM sources WHERE id % 6 = 1),
gone_folders AS (SELECT id FROM folders WHERE source_id IN (SELECT id FROM gone))"""], """
SELECT 'user' AS tab, id, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b FROM users
UNION ALL SELECT 'source', CAST(id AS VARCHAR), NULL, NULL FROM sources
WHERE id NOT IN (SELECT id FROM gone)
UNION ALL SELECT 'source_folder', CAST(id AS VARCHAR), source_id, NULL FROM folders
WHERE id NOT IN (SELECT id FROM gone_folders)
UNION ALL SELECT 'invoice', CAST(id AS VARCHAR),
  CASE WHEN source_id NOT IN (SELECT id FROM gone) THEN source_id END,
  CASE WHEN source_folder_id NOT IN (SELECT id FROM gone_folders) THEN source_folder_id END
FROM invoices"""))
def delete_sources(i):
    """What is left after sources were deleted, folders and invoices as the ledger has them."""
    gone = i.sources().filter(F.col("id") % 6 == 1).select("id")
    ledger = empty_ledger(i, "purge", i.folders())
    ledger.replace("fill", {"invoice": i.invoices()})
    stored = {name: ledger.read(name) for name in ("source_folder", "invoice")}
    left = ql.delete_sources({**i.tables(), **stored}, gone)
    ledger.replace("purge", {name: left[name] for name in stored})
    return ids_of({**left, **{name: ledger.read(name) for name in stored}})


@query("unprocessed_gaps", with_ctes([*MIXED, *c.selected(10, 4), MERGED], """
SELECT m.source_folder_id, m.uid FROM messages m JOIN merged g USING (source_folder_id)
WHERE m.uid BETWEEN g.low_water_mark AND g.high_water_mark
  AND NOT EXISTS (SELECT 1 FROM selection s
    WHERE s.source_folder_id = m.source_folder_id AND s.uid = m.uid)"""))
def unprocessed_gaps(i):
    """Messages within the new marks that this small batch did not take."""
    taken = sel.select_batch(i.messages(), i.state(), 10, 4)
    state = cm.merge_watermarks(i.state(), cm.uid_bounds(taken))
    return ql.unprocessed_gaps(i.messages(), state, taken)
