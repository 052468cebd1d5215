"""Registry of queries and of the SQL that says what each must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.plans.fixtures import Inputs
from ledgerflow.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Inputs`` under a name, with its SQL where there is one."""

    def add(build: Callable[[Inputs], DataFrame]):
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Inputs(configure(spark), sf_dir))

        QUERIES[name] = call
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# -- relations in SQL, independent of the DataFrame definitions ------------------

MESSAGES = """messages AS (
  SELECT user_id AS source_folder_id, event_id + 1 AS uid, event_type, value FROM events)"""

SPAN = """span AS (
  SELECT source_folder_id, min(uid) AS low, max(uid) AS high FROM messages GROUP BY 1)"""

STATE = """state AS (
  SELECT source_folder_id,
    CASE WHEN source_folder_id % 3 = 0 THEN NULL
         WHEN source_folder_id % 10 = 2 THEN high
         ELSE low + (high - low) * 3 // 4 END AS high_water_mark,
    CASE WHEN source_folder_id % 3 = 0 OR source_folder_id % 10 = 4 THEN NULL
         WHEN source_folder_id % 10 = 1 THEN 1
         WHEN source_folder_id % 10 = 5 THEN 40
         ELSE low + (high - low) // 2 END AS low_water_mark
  FROM span)"""

LATER_STATE = """state AS (
  SELECT source_folder_id, low + (high - low) * 3 // 4 AS high_water_mark,
         low + (high - low) // 2 AS low_water_mark FROM span)"""


def selected(batch: int, chunk: int) -> list[str]:
    """The selection of a run as CTEs over ``messages`` and ``state``."""
    return [
        f"""eligible AS (
  SELECT m.*, s.high_water_mark IS NULL AND s.low_water_mark IS NULL AS first_run
  FROM messages m JOIN state s USING (source_folder_id)
  WHERE (s.high_water_mark IS NULL AND s.low_water_mark IS NULL)
     OR m.uid > s.high_water_mark
     OR (s.low_water_mark > 1
         AND m.uid BETWEEN greatest(1, s.low_water_mark - {batch}) AND s.low_water_mark - 1))""",
        f"""capped AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_folder_id ORDER BY uid DESC) AS r
                 FROM eligible) WHERE r <= {batch})""",
        f"""selection AS (
  SELECT source_folder_id, uid, event_type, value, first_run,
    CAST((row_number() OVER (PARTITION BY source_folder_id
          ORDER BY CASE WHEN first_run THEN uid ELSE -uid END) - 1) // {chunk} + 1 AS INTEGER)
      AS chunk_num
  FROM capped)""",
    ]


MONEY = "cast({0} // 100 AS VARCHAR) || '.' || lpad(cast({0} % 100 AS VARCHAR), 2, '0')"

SOURCES = """sources AS (
  SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS user_id, c_name AS name,
    lower(c_name) || '@example.com' AS email_address,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'outlook' ELSE 'gmail' END AS source_type,
    CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 9 = 1 THEN ''
         ELSE 'held-' || c_custkey END AS oauth2_access_token,
    'renew-' || c_custkey AS oauth2_refresh_token,
    CASE WHEN c_custkey % 7 = 0 THEN NULL
         ELSE TIMESTAMP '2024-01-01' + to_hours(CAST(floor(c_acctbal) AS INTEGER)) END
      AS oauth2_access_token_expires_at,
    CAST(NULL AS TIMESTAMP) AS oauth2_refresh_token_expires_at,
    TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-01' AS updated_at
  FROM customer)"""

REFRESHES = """refreshes AS (
  SELECT c_custkey AS source_id,
    CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 8 = 5 THEN ''
         ELSE 'new-' || c_custkey END AS new_token
  FROM customer WHERE c_custkey % 11 <> 0)"""

TOKENS = """tokens AS (
  SELECT s.id AS source_id,
    CASE WHEN s.oauth2_access_token_expires_at > TIMESTAMP '2024-07-01' THEN 'valid'
         ELSE 'needs_refresh' END AS token_state,
    nullif(CASE WHEN s.oauth2_access_token_expires_at > TIMESTAMP '2024-07-01'
                THEN s.oauth2_access_token ELSE r.new_token END, '') AS access_token
  FROM sources s LEFT JOIN refreshes r ON r.source_id = s.id)"""

ALL_FOLDERS = """all_folders AS (
  SELECT c_custkey * 2 + CASE WHEN f.folder_name = 'INBOX' THEN 1 ELSE 2 END AS id,
    c_custkey AS source_id, f.folder_name, CAST(c_custkey % 5 AS VARCHAR) AS uid_validity,
    CASE WHEN c_custkey % 3 <> 0 THEN c_custkey + 100 END AS high_water_mark,
    CASE WHEN c_custkey % 3 <> 0 THEN c_custkey + 50 END AS low_water_mark,
    CAST(NULL AS TIMESTAMP) AS last_processed_at,
    TIMESTAMP '2024-01-01' AS created_at, TIMESTAMP '2024-01-01' AS updated_at
  FROM customer, (VALUES ('INBOX'), ('Spam')) f(folder_name))"""

FOLDERS = "folders AS (SELECT * FROM all_folders WHERE source_id % 4 <> 0)"

LISTING = """listing AS (
  SELECT DISTINCT source_id, folder_name,
    CASE WHEN source_id % 6 = 0 THEN CAST(source_id % 5 + 100 AS VARCHAR) ELSE uid_validity END
      AS uid_validity
  FROM all_folders)"""

MISSING = """missing AS (
  SELECT l.* FROM listing l WHERE NOT EXISTS (
    SELECT 1 FROM folders f WHERE f.source_id = l.source_id
      AND f.folder_name = l.folder_name AND f.uid_validity = l.uid_validity))"""


def numbered(rows: str, keys: list[str], start: str) -> str:
    """Ids past ``start`` by digest bucket and rank within it."""
    text = " || '/' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    bucket = f"CAST('0x' || substr(md5({text}), 1, 3) AS BIGINT)"
    return f"""SELECT *, {start} + (row_number() OVER (PARTITION BY {bucket}
      ORDER BY {', '.join(keys)}) - 1) * 4096 + {bucket} + 1 AS id FROM {rows}"""


CREATED = "created AS (" + numbered(
    "missing", ["source_id", "folder_name", "uid_validity"], "(SELECT max(id) FROM folders)"
) + ")"

EXISTING = """existing AS (
  SELECT min(f.id) AS id, l.source_id, l.folder_name, l.uid_validity
  FROM listing l JOIN folders f USING (source_id, folder_name, uid_validity) GROUP BY 2, 3, 4)"""

USERS = """users AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS id, min(c_name) AS name,
    CASE WHEN c_nationkey % 8 = 3 THEN 'shared@example.com'
         ELSE 'user' || c_nationkey || '@example.com' END AS email,
    CASE WHEN c_nationkey % 6 <> 5 THEN true END AS email_verified
  FROM customer WHERE c_nationkey % 9 <> 4 GROUP BY c_nationkey)"""

INVOICES = """invoices AS (
  SELECT o_orderkey + 1 AS id, o_custkey AS source_id,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'INV-' || (o_orderkey % 1000) END AS invoice_number,
    CAST(o_custkey % 25 AS VARCHAR) AS user_id, o_orderkey AS uid,
    o_custkey * 2 + 1 AS source_folder_id, o_orderdate AS created_at
  FROM orders)"""

TAKEN = """taken AS (
  SELECT (o_orderkey % 1000) + 1 AS id, 'INV-' || (o_orderkey % 1000) AS invoice_number
  FROM orders WHERE o_orderkey % 1000 < 100 GROUP BY o_orderkey % 1000)"""

SUFFIX = "CASE doc_id % 3 WHEN 0 THEN ' Invoice' WHEN 1 THEN ' unpaid bill' ELSE '' END"

EMAILS = f"""emails AS (
  SELECT d.doc_id, source || ' ' || lang || {SUFFIX} AS subject,
    source || '@example.com' AS from_address,
    CASE WHEN d.doc_id % 5 = 0 THEN NULL WHEN d.doc_id % 7 = 0 THEN '' ELSE text END AS body_text,
    html AS body_html
  FROM documents d LEFT JOIN pages ON page_id = d.doc_id)"""

ANSWERS = f"""answers AS (
  SELECT doc_id, subject, CASE doc_id % 10
    WHEN 0 THEN a
    WHEN 1 THEN '```json' || chr(10) || a || chr(10) || '```'
    WHEN 2 THEN '<think>' || text || '</think>' || chr(10) || a
    WHEN 3 THEN substr(a, 1, length(a) - 1)
    WHEN 4 THEN a || ' as asked'
    WHEN 5 THEN text || ' ' || a || ' done'
    WHEN 6 THEN '<think>' || text || a
    WHEN 7 THEN '[' || a || ']'
    WHEN 8 THEN '```' || chr(10) || text || chr(10) || '``` ' || a
    ELSE '```JSON' || chr(10) || a || chr(10) || '```' END AS response
  FROM (SELECT d.doc_id, text, source || ' ' || lang || {SUFFIX.replace('doc_id', 'd.doc_id')} AS subject,
          '{{"is_invoice": ' || CASE quality WHEN 1 THEN 'true' WHEN 0 THEN '"no"' ELSE 'null' END
          || ', "confidence": "high", "reasoning": "' || lang || '"}}' AS a
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id))"""

# The cleaning ladder, on DuckDB's own regular expressions.
CLEANED = r"""stripped AS (
  SELECT *, trim(response, E' \t\n\r') AS t0 FROM answers),
unthought AS (
  SELECT *, CASE WHEN t0 LIKE '%<think>%' OR t0 LIKE '%</think>%'
    THEN trim(regexp_replace(t0, '(?s)<think>.*?</think>', '', 'g'), E' \t\n\r') ELSE t0 END AS t
  FROM stripped),
cleaned AS (
  SELECT *, CASE
    WHEN t LIKE '%```%' THEN coalesce(
      nullif(regexp_extract(t, '(?s)```(?:json)?\s*(\{.*?\})\s*```', 1), ''),
      nullif(regexp_extract(t, '(?s)\{.*\}'), ''), t)
    WHEN NOT starts_with(t, '{') THEN coalesce(nullif(regexp_extract(t, '(?s)\{.*\}'), ''), t)
    ELSE t END AS cleaned
  FROM unthought)"""

FILES = """files AS (
  SELECT doc_id % 50 AS source_folder_id, doc_id + 1 AS uid, position,
    CAST(doc_id % 25 AS VARCHAR) AS user_id, doc_id % 50 AS source_id, filename, content,
    CAST(doc_id % 25 AS VARCHAR) || '/' || (doc_id % 50) || '/INBOX/7/' || (doc_id + 1) || '/'
      || base AS file_key
  FROM (
    SELECT doc_id, 0 AS position, 'dir/' || source || '.txt' AS filename, source || '.txt' AS base,
      text AS content FROM documents
    UNION ALL
    SELECT doc_id, 1, CASE doc_id % 3 WHEN 0 THEN source || '.txt'
        WHEN 1 THEN 'a\\b/' || lang || '/.' ELSE '..' END,
      CASE doc_id % 3 WHEN 0 THEN source || '.txt' WHEN 1 THEN lang ELSE '..' END, lang
    FROM documents))"""
FILES = FILES.replace("\\\\", "\\")

STORED = """stored AS (
  SELECT file_key, content, octet_length(encode(content)) AS size_bytes
  FROM files WHERE position = 0 AND uid % 2 = 1)"""
