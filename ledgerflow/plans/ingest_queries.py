"""Selection, sources, listings and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.operators import commit as cm
from ledgerflow.operators import reconcile as rc
from ledgerflow.operators import selection as sel
from ledgerflow.plans import catalog as c
from ledgerflow.plans.catalog import query, with_ctes
from ledgerflow.plans.fixtures import now
from ledgerflow.sources import listing as ls
from ledgerflow.sources import tables as tb

SELECTION_COLUMNS = "SELECT source_folder_id, uid, first_run, chunk_num FROM selection"
MIXED = [c.MESSAGES, c.SPAN, c.STATE]


@query("next_batch_selection", with_ctes(
    [c.MESSAGES, c.SPAN, c.LATER_STATE, *c.selected(10, 4)], SELECTION_COLUMNS))
def next_batch_selection(i):
    return sel.select_batch(i.messages(), i.later_state(), 10, 4)


@query("first_run_latest_n", with_ctes([c.MESSAGES], """
SELECT source_folder_id, uid, newest_rank FROM (
  SELECT source_folder_id, uid, CAST(row_number() OVER (
    PARTITION BY source_folder_id ORDER BY uid DESC) AS INTEGER) AS newest_rank FROM messages)
WHERE newest_rank <= 25"""))
def first_run_latest_n(i):
    eligible = sel.select_join(i.messages(), i.first_state(), 25)
    return sel.newest_per_folder(eligible, 25).select("source_folder_id", "uid", "newest_rank")


@query("mixed_first_and_later_runs", with_ctes([*MIXED, *c.selected(1000, 100)], SELECTION_COLUMNS))
def mixed_first_and_later_runs(i):
    return sel.select_batch(i.messages(), i.state())


@query("chunk_numbering", with_ctes([*MIXED, *c.selected(50, 7)], """
SELECT source_folder_id, chunk_num, count(*) AS emails, max(uid) AS max_uid, min(uid) AS min_uid
FROM selection GROUP BY 1, 2"""))
def chunk_numbering(i):
    chosen = sel.select_batch(i.messages(), i.state(), 50, 7)
    return chosen.groupBy("source_folder_id", "chunk_num").agg(
        F.count(F.lit(1)).alias("emails"),
        F.max("uid").alias("max_uid"),
        F.min("uid").alias("min_uid"),
    )


@query("arrival_chunks", with_ctes(MIXED, """
SELECT source_folder_id, uid, first_run,
  CAST((row_number() OVER (PARTITION BY source_folder_id
        ORDER BY CASE WHEN first_run THEN uid ELSE -uid END) - 1) // 6 + 1 AS INTEGER) AS chunk_num
FROM (SELECT m.*, s.high_water_mark IS NULL AND s.low_water_mark IS NULL AS first_run
      FROM messages m JOIN state s USING (source_folder_id)
      WHERE (s.high_water_mark IS NULL AND s.low_water_mark IS NULL) OR uid > s.high_water_mark)"""))
def arrival_chunks(i):
    return sel.select_arrivals(i.messages(), i.state(), 6)


@query("forward_only", with_ctes(MIXED, """
SELECT m.source_folder_id, m.uid FROM messages m JOIN state s USING (source_folder_id)
WHERE m.uid > s.high_water_mark"""))
def forward_only(i):
    return sel.forward_only(i.messages(), i.state()).select("source_folder_id", "uid")


@query("backfill_only", with_ctes(MIXED, """
SELECT m.source_folder_id, m.uid FROM messages m JOIN state s USING (source_folder_id)
WHERE s.low_water_mark > 1
  AND m.uid BETWEEN greatest(1, s.low_water_mark - 1000) AND s.low_water_mark - 1"""))
def backfill_only(i):
    return sel.backfill_only(i.messages(), i.state(), 1000).select("source_folder_id", "uid")


@query("uid_bounds", with_ctes([*MIXED, *c.selected(50, 7)], """
SELECT source_folder_id, chunk_num, max(uid) AS max_uid, min(uid) AS min_uid
FROM selection GROUP BY 1, 2"""))
def uid_bounds(i):
    return cm.uid_bounds(sel.select_batch(i.messages(), i.state(), 50, 7))


MERGED = """merged AS (
  SELECT s.source_folder_id, greatest(s.high_water_mark, b.max_uid) AS high_water_mark,
    least(s.low_water_mark, b.min_uid) AS low_water_mark
  FROM state s JOIN (SELECT source_folder_id, max(uid) AS max_uid, min(uid) AS min_uid
                     FROM selection GROUP BY 1) b USING (source_folder_id))"""


def merged(i):
    chosen = sel.select_batch(i.messages(), i.state())
    return cm.merge_watermarks(i.state(), cm.uid_bounds(chosen))


@query("watermark_merge", with_ctes(
    [*MIXED, *c.selected(1000, 100), MERGED], "SELECT * FROM merged"))
def watermark_merge(i):
    return merged(i)


@query("empty_span_marks", with_ctes(MIXED, """
SELECT source_folder_id, high_water_mark, greatest(1, low_water_mark - 20) AS low_water_mark
FROM state s WHERE low_water_mark > 1 AND NOT EXISTS (
  SELECT 1 FROM messages m WHERE m.source_folder_id = s.source_folder_id
    AND m.uid BETWEEN greatest(1, s.low_water_mark - 20) AND s.low_water_mark - 1)"""))
def empty_span_marks(i):
    return cm.advance_empty_spans(i.state(), i.messages(), 20)


# -- scans ---------------------------------------------------------------------


def plain_times(rows):
    """Times without zone, as the checker compares them."""
    zoned = [f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


@query("scan_sources", with_ctes([c.SOURCES], "SELECT * FROM sources"))
def scan_sources(i):
    return plain_times(tb.scan_sources(i.sources()))


@query("source_by_id", with_ctes([c.SOURCES], "SELECT * FROM sources WHERE id = 17"))
def source_by_id(i):
    return plain_times(tb.source_by_id(i.sources(), 17))


@query("sources_of_type", with_ctes(
    [c.SOURCES], "SELECT id, source_type FROM sources WHERE source_type = 'gmail'"))
def sources_of_type(i):
    return tb.by_source_type(i.sources(), "gmail").select("id", "source_type")


FOLDER_TABLE = [c.ALL_FOLDERS, c.FOLDERS]


@query("folders_of_source", with_ctes(FOLDER_TABLE, "SELECT * FROM folders WHERE source_id = 11"))
def folders_of_source(i):
    return plain_times(tb.folders_of_source(i.folders(), 11))


@query("folder_by_id", with_ctes(FOLDER_TABLE, "SELECT * FROM folders WHERE id = 23"))
def folder_by_id(i):
    return plain_times(tb.folder_by_id(i.folders(), 23))


@query("folder_by_natural_key", with_ctes(FOLDER_TABLE, """
SELECT * FROM folders WHERE source_id = 13 AND folder_name = 'Spam' AND uid_validity = '3'"""))
def folder_by_natural_key(i):
    return plain_times(tb.folder_by_natural_key(i.folders(), 13, "Spam", "3"))


@query("folder_listing_parse", with_ctes([c.ALL_FOLDERS], """
SELECT source_id, folder_name AS name, CAST(source_id AS VARCHAR) AS uid_validity
FROM all_folders WHERE source_id % 9 <> 0 AND source_id % 7 <> 0 AND source_id % 13 <> 0"""))
def folder_listing_parse(i):
    return ls.parse_folder_listing(i.listing_lines())


# -- tokens and reconciliation ---------------------------------------------------

TOKEN_CTES = [c.SOURCES, c.REFRESHES, c.TOKENS]


def tokens(i):
    return rc.source_tokens(i.sources(), i.refreshes(), now())


@query("token_state", with_ctes(TOKEN_CTES, """
SELECT source_id, token_state, access_token IS NOT NULL AS usable FROM tokens"""))
def token_state(i):
    return tokens(i).select(
        "source_id", "token_state", F.col("access_token").isNotNull().alias("usable")
    )


@query("eligible_sources", with_ctes(TOKEN_CTES, """
SELECT id, user_id, email_address, source_type FROM sources
WHERE id IN (SELECT source_id FROM tokens WHERE access_token IS NOT NULL)"""))
def eligible_sources(i):
    return rc.eligible_sources(i.sources(), tokens(i)).select(
        "id", "user_id", "email_address", "source_type"
    )


RECONCILE = [c.ALL_FOLDERS, c.FOLDERS, c.LISTING]


@query("reconcile_existing", with_ctes([*RECONCILE, c.EXISTING], "SELECT * FROM existing"))
def reconcile_existing(i):
    return rc.reconcile_existing(i.listing(), i.folders())


@query("reconcile_missing", with_ctes([*RECONCILE, c.MISSING], "SELECT * FROM missing"))
def reconcile_missing(i):
    return rc.reconcile_missing(i.listing(), i.folders())


def created(i):
    missing = rc.reconcile_missing(i.listing(), i.folders())
    return rc.create_folders(missing, i.folders(), now())


@query("create_folders", with_ctes([*RECONCILE, c.MISSING, c.CREATED], """
SELECT id, source_id, folder_name, uid_validity, CAST(NULL AS BIGINT) AS high_water_mark,
  CAST(NULL AS BIGINT) AS low_water_mark, TIMESTAMP '2024-07-01' AS created_at FROM created"""))
def create_folders(i):
    return created(i).select(
        "id", "source_id", "folder_name", "uid_validity",
        "high_water_mark", "low_water_mark", "created_at",
    )


@query("reconcile_all", with_ctes([*RECONCILE, c.MISSING, c.CREATED, c.EXISTING], """
SELECT id, source_id, folder_name, uid_validity FROM existing
UNION ALL SELECT id, source_id, folder_name, uid_validity FROM created"""))
def reconcile_all(i):
    return rc.all_folders(rc.reconcile_existing(i.listing(), i.folders()), created(i))


@query("epoch_change", with_ctes([*RECONCILE, c.MISSING, c.CREATED], """
SELECT f.id AS old_id, n.id AS new_id, f.uid_validity AS old_validity,
  n.uid_validity AS new_validity
FROM folders f JOIN created n USING (source_id, folder_name)"""))
def epoch_change(i):
    old = i.folders().select(
        "source_id", "folder_name",
        F.col("id").alias("old_id"), F.col("uid_validity").alias("old_validity"),
    )
    new = created(i).select(
        "source_id", "folder_name",
        F.col("id").alias("new_id"), F.col("uid_validity").alias("new_validity"),
    )
    return old.join(new, ["source_id", "folder_name"]).select(
        "old_id", "new_id", "old_validity", "new_validity"
    )


# -- context -------------------------------------------------------------------

# sources that still exist, so that some folders have lost theirs
LIVE_SOURCES = "live AS (SELECT * FROM sources WHERE id % 7 <> 3)"


def wanted_folders(i):
    return i.all_folders().select(F.col("id").alias("source_folder_id"))


@query("folder_with_source", with_ctes([*FOLDER_TABLE, c.SOURCES, LIVE_SOURCES], """
SELECT w.id AS source_folder_id, f.source_id, f.folder_name, f.uid_validity,
  s.user_id, s.email_address,
  CASE WHEN f.id IS NULL THEN 'Source folder ' || w.id || ' not found'
       WHEN s.id IS NULL THEN 'Source ' || f.source_id || ' not found' END AS error
FROM all_folders w LEFT JOIN folders f USING (id) LEFT JOIN live s ON s.id = f.source_id"""))
def folder_with_source(i):
    live = i.sources().filter(F.col("id") % 7 != 3)
    return rc.folder_with_source(wanted_folders(i), i.folders(), live)


@query("folder_token", with_ctes([*FOLDER_TABLE, *TOKEN_CTES], """
SELECT f.id AS source_folder_id, f.source_id, t.access_token
FROM all_folders w JOIN folders f USING (id) JOIN tokens t ON t.source_id = f.source_id
WHERE t.access_token IS NOT NULL"""))
def folder_token(i):
    return rc.folder_token(wanted_folders(i), i.folders(), tokens(i))


@query("message_context", with_ctes([c.MESSAGES, *FOLDER_TABLE, c.SOURCES], """
SELECT m.source_folder_id, m.uid, f.source_id, f.folder_name, f.uid_validity, s.user_id
FROM messages m JOIN folders f ON f.id = m.source_folder_id
JOIN sources s ON s.id = f.source_id"""))
def message_context(i):
    return rc.message_context(
        i.messages().select("source_folder_id", "uid"), i.folders(), i.sources()
    )
