"""Bodies, prompts, model answers, scoring and parsing."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ledgerflow.functions import text as tx
from ledgerflow.functions import typed as ty
from ledgerflow.operators import decoding as dc
from ledgerflow.operators import parsing, prompts, scoring
from ledgerflow.plans import catalog as c
from ledgerflow.plans.catalog import query, with_ctes
from ledgerflow.sources.messages import readable_messages

BODY = "coalesce(nullif(body_text, ''), nullif(body_html, ''), '')"


@query("body_choice", with_ctes([c.EMAILS], f"""
SELECT doc_id, length({BODY}) AS chars, md5({BODY}) AS body,
  length(substr({BODY}, 1, 2000)) AS classify_chars,
  length(substr({BODY}, 1, 4000)) AS extract_chars FROM emails"""))
def body_choice(i):
    body = F.col("body")
    return i.emails().withColumn("body", prompts.choose_body()).select(
        "doc_id",
        F.length(body).alias("chars"),
        F.md5(body).alias("body"),
        F.length(prompts.truncate_body(body, prompts.CLASSIFY_BODY_CHARS)).alias("classify_chars"),
        F.length(prompts.truncate_body(body, prompts.EXTRACT_BODY_CHARS)).alias("extract_chars"),
    )


def prompt_sql(template: str, chars: int) -> str:
    def literal(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    head, rest = template.split("{subject}")
    middle, rest = rest.split("{sender}")
    before, tail = rest.split("{body}")
    return with_ctes([c.EMAILS], f"""
SELECT doc_id, {literal(head)} || subject || {literal(middle)} || from_address || {literal(before)}
  || substr({BODY}, 1, {chars}) || {literal(tail)} AS prompt FROM emails""")


@query("classify_prompt", prompt_sql(prompts.CLASSIFY_PROMPT, prompts.CLASSIFY_BODY_CHARS))
def classify_prompt(i):
    return prompts.with_prompt(i.emails(), "classify").select("doc_id", "prompt")


@query("extract_prompt", prompt_sql(prompts.EXTRACT_PROMPT, prompts.EXTRACT_BODY_CHARS))
def extract_prompt(i):
    return prompts.with_prompt(i.emails(), "extract").select("doc_id", "prompt")


@query("clean_response", with_ctes(
    [c.ANSWERS, c.CLEANED], "SELECT doc_id, cleaned FROM cleaned"))
def clean_response(i):
    return dc.with_clean_response(i.classify_answers()).select("doc_id", "cleaned")


REPAIRED = """repaired AS (
  SELECT doc_id, subject, CASE WHEN cleaned LIKE '%}' THEN cleaned ELSE cleaned || '}' END AS fixed
  FROM cleaned)"""


@query("repair_brace", with_ctes(
    [c.ANSWERS, c.CLEANED, REPAIRED], "SELECT doc_id, fixed AS cleaned FROM repaired"))
def repair_brace(i):
    return dc.with_clean_response(i.classify_answers(), repair=True).select("doc_id", "cleaned")


CLASSIFIED = """typed AS (
  SELECT doc_id, subject,
    CASE WHEN json_valid(fixed) AND starts_with(fixed, '{') THEN fixed END AS doc FROM repaired),
flags AS (
  SELECT *, CASE WHEN json_type(doc, '$.is_invoice') = 'BOOLEAN'
      THEN json_extract_string(doc, '$.is_invoice') = 'true'
    WHEN lower(json_extract_string(doc, '$.is_invoice')) IN ('yes', 'y', 'true', 't', 'on', '1') THEN true
    WHEN lower(json_extract_string(doc, '$.is_invoice')) IN ('no', 'n', 'false', 'f', 'off', '0') THEN false
    END AS flag FROM typed),
classified AS (
  SELECT doc_id, coalesce(flag, regexp_matches(lower(subject), 'invoice|receipt|payment|paid|bill'))
      AS is_invoice,
    flag IS NULL AS fallback,
    CASE WHEN flag IS NULL THEN 'low' ELSE json_extract_string(doc, '$.confidence') END AS confidence,
    CASE WHEN flag IS NULL THEN 'Fallback classification (error: '
        || CASE WHEN doc IS NULL THEN 'not a JSON object' ELSE 'invalid fields' END || ')'
      ELSE json_extract_string(doc, '$.reasoning') END AS reasoning
  FROM flags)"""


def classified(i):
    return dc.decode_classification(i.classify_answers())


@query("decode_classification", with_ctes(
    [c.ANSWERS, c.CLEANED, REPAIRED, CLASSIFIED], "SELECT * FROM classified"))
def decode_classification(i):
    return classified(i).select("doc_id", "is_invoice", "fallback", "confidence", "reasoning")


@query("invoice_filter", with_ctes([c.ANSWERS, c.CLEANED, REPAIRED, CLASSIFIED], """
SELECT is_invoice, count(*) AS emails FROM classified GROUP BY 1"""))
def invoice_filter(i):
    return classified(i).groupBy("is_invoice").agg(F.count(F.lit(1)).alias("emails"))


@query("keyword_fallback", """
SELECT conv_id, turn,
  regexp_matches(lower(text), 'invoice|receipt|payment|paid|bill') AS in_text,
  regexp_matches(lower(role || text || CASE WHEN turn % 2 = 0 THEN ' Re: BILLING' ELSE '' END),
                 'invoice|receipt|payment|paid|bill') AS in_subject
FROM conversations""")
def keyword_fallback(i):
    subject = F.concat(
        "role", "text", F.when(F.col("turn") % 2 == 0, " Re: BILLING").otherwise("")
    )
    return i.table("conversations").select(
        "conv_id",
        "turn",
        dc.keyword_fallback(F.col("text")).alias("in_text"),
        dc.keyword_fallback(subject).alias("in_subject"),
    )


# -- extraction --------------------------------------------------------------

EXTRACTED = """lines AS (
  SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, p_name
  FROM lineitem JOIN part ON p_partkey = l_partkey),
parts AS (
  SELECT *, cents // 100 || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS money,
    l_orderkey % 7 IN (3, 5) OR (l_orderkey % 11 = 0 AND l_orderkey % 13 <> 0)
      OR l_linenumber % 7 IN (1, 6) AS void
  FROM lines),
amounts AS (
  SELECT *, CASE WHEN void THEN NULL
      WHEN l_orderkey % 7 IN (0, 1) THEN CAST(money AS DECIMAL(10, 2))
      WHEN l_orderkey % 7 = 4 THEN try_cast(cents * 100000 AS DECIMAL(10, 2))
      WHEN l_orderkey % 7 = 6 THEN CAST(money || '5' AS DECIMAL(10, 2)) END AS amount
  FROM parts),
extracted AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, money, l_quantity,
    CASE WHEN void THEN 'Invoice extraction returned None'
         WHEN l_orderkey % 7 = 4 AND amount IS NULL THEN 'total_amount does not fit numeric(10,2)'
      END AS extract_error,
    CAST(amount AS DOUBLE) AS total_amount,
    CASE WHEN l_orderkey % 13 <> 0 THEN 'INV-' || l_orderkey || '-' || l_linenumber END
      AS invoice_number,
    CASE l_linenumber % 7 WHEN 0 THEN l_shipdate WHEN 3 THEN l_shipdate
      WHEN 4 THEN l_shipdate + INTERVAL 630 MINUTE WHEN 5 THEN l_shipdate + INTERVAL 495 MINUTE
      END AS due_date,
    CASE l_partkey % 3 WHEN 0 THEN 'USD' WHEN 2 THEN 'EUR' END AS currency,
    CASE l_partkey % 2 WHEN 0 THEN 'paid' END AS payment_status
  FROM amounts)"""


def extracted(i):
    return dc.decode_invoice(i.extract_answers())


@query("decode_invoice", with_ctes([EXTRACTED], """
SELECT l_orderkey, l_linenumber, l_partkey, p_name AS vendor_name, invoice_number, due_date,
  total_amount, currency, payment_status
FROM extracted WHERE extract_error IS NULL"""))
def decode_invoice(i):
    found = extracted(i).filter(F.col("extract_error").isNull())
    return found.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("invoice.vendor_name").alias("vendor_name"),
        F.col("invoice.invoice_number").alias("invoice_number"),
        F.col("invoice.due_date").cast("timestamp_ntz").alias("due_date"),
        F.col("invoice.total_amount").cast("double").alias("total_amount"),
        F.col("invoice.currency").alias("currency"),
        F.col("invoice.payment_status").alias("payment_status"),
    )


@query("extraction_routing", with_ctes([EXTRACTED], """
SELECT coalesce(extract_error, 'ok') AS outcome, count(*) AS emails FROM extracted GROUP BY 1"""))
def extraction_routing(i):
    return (
        extracted(i)
        .groupBy(F.coalesce("extract_error", F.lit("ok")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("emails"))
    )


ITEMS_SQL = """CASE WHEN l_suppkey % 10 = 0 THEN '[]' ELSE
  '[{"description":"' || p_name || '","quantity":' || CAST(l_quantity AS DOUBLE)
  || ',"unit_price":' || CAST(money AS DOUBLE)
  || '},{"description":"tax","quantity":2.5,"unit_price":1.25}]' END"""


def line_items(i):
    answers = dc.with_document(dc.with_clean_response(i.extract_answers()))
    return answers.withColumn("items", dc.decode_line_items(F.col("doc")))


@query("decode_line_items", with_ctes([EXTRACTED], """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 2 END AS items,
  CASE WHEN l_suppkey % 10 <> 0 THEN CAST(l_quantity AS DOUBLE) + 2.5 END AS quantity,
  CASE WHEN l_suppkey % 10 <> 0 THEN CAST(CAST(money AS DECIMAL(18, 2)) + 1.25 AS DOUBLE) END AS price
FROM extracted"""))
def decode_line_items(i):
    def total(field, kind):
        zero = F.lit(0).cast(kind)
        return F.when(F.size("items") > 0, F.aggregate(
            "items", zero, lambda sum_, item: (sum_ + item[field].cast(kind)).cast(kind)
        ).cast("double"))

    return line_items(i).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.size("items").alias("items"),
        total("quantity", "double").alias("quantity"),
        total("unit_price", "decimal(38,18)").alias("price"),
    )


@query("line_items_json", with_ctes([EXTRACTED], f"""
SELECT l_orderkey, l_linenumber, l_partkey, {ITEMS_SQL} AS line_items FROM extracted"""))
def line_items_json(i):
    return line_items(i).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        dc.line_items_json(F.col("items")).alias("line_items"),
    )


@query("wide_prices", """
SELECT p_partkey, d AS description, CASE d WHEN 'long' THEN p_partkey || '.0000000000000000000000001'
  WHEN 'large' THEN '1.0E30' WHEN 'small' THEN '1.0E-20' END AS unit_price,
  CASE d WHEN 'small' THEN 2.0::DOUBLE END AS quantity
FROM part, (VALUES ('long'), ('large'), ('small')) v(d)""")
def wide_prices(i):
    """Prices of any size and length stay as they are; numbers that are not finite do not."""
    text = F.concat(
        F.lit('{"line_items": [{"description": "long", "unitPrice": "'), F.col("p_partkey").cast("string"),
        F.lit('.0000000000000000000000001"}, {"description": "large", "unitPrice": 1e30}, '
              '{"description": "small", "unit_price": 1e-20, "quantity": 2}, '
              '{"description": "endless", "quantity": 1e999}, {"description": "dear", "unitPrice": "1e999"}]}'),
    )
    answers = dc.with_document(i.table("part").select("p_partkey", text.alias("cleaned")))
    return answers.select("p_partkey", F.inline(dc.decode_line_items(F.col("doc")))).select(
        "p_partkey", "description", "unit_price", "quantity"
    )


@query("amount_cast", """
SELECT o_orderkey, CAST(CAST(v AS DECIMAL(10, 2)) AS DOUBLE) AS amount, v IS NOT NULL AS valid
FROM (SELECT o_orderkey, CASE o_orderkey % 4
        WHEN 0 THEN cents // 1000 || '.' || lpad(CAST(cents % 1000 AS VARCHAR), 3, '0')
        WHEN 1 THEN CAST(cents AS VARCHAR) WHEN 2 THEN cents // 100 || '.5' END AS v
      FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders))""")
def amount_cast(i):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    thousandths = F.concat(
        F.floor(cents / 1000).cast("string"), F.lit("."),
        F.lpad((cents % 1000).cast("string"), 3, "0"),
    )
    case = F.col("o_orderkey") % 4
    text = (
        F.when(case == 0, thousandths)
        .when(case == 1, F.concat(F.lit('"  '), cents.cast("string"), F.lit(' "')))
        .when(case == 2, F.concat(F.floor(cents / 100).cast("string"), F.lit(".5e0")))
        .otherwise(F.concat(F.lit('"'), cents.cast("string"), F.lit(' USD"')))
    )
    number = ty.to_number_text(F.col("v"), ty.kind(F.col("v")))
    return i.table("orders").withColumn("v", F.try_parse_json(text)).select(
        "o_orderkey",
        number.try_cast("decimal(10,2)").cast("double").alias("amount"),
        number.isNotNull().alias("valid"),
    )


# -- scoring and parsing -------------------------------------------------------


def length_scorer(stage, sampling):
    """Stands in for a model: answers with the length of what it was asked."""

    def answer(asked):
        return [
            ValueError("refused") if text.startswith("system") else
            json.dumps({"stage": stage, "chars": len(text), "limit": sampling.max_tokens})
            for text in asked
        ]

    return answer


@query("score_batch", """
SELECT conv_id, turn, CASE WHEN role <> 'system'
    THEN '{"stage": "classify", "chars": ' || length(role || ' ' || text) || ', "limit": 256}' END
    AS response,
  CASE WHEN role = 'system' THEN 'refused' END AS error FROM conversations""")
def score_batch(i):
    asked = i.table("conversations").select(
        "conv_id", "turn", F.concat_ws(" ", "role", "text").alias("prompt")
    )
    return scoring.score_batch(asked, "classify", length_scorer).drop("elapsed_sec")


@query("parse_round_trip", r"""
SELECT doc_id % 50 AS source_folder_id, doc_id + 1 AS uid, source || ' no. ' || doc_id AS subject,
  lang || '@example.com' AS from_address, '' AS to_address, '<' || doc_id || '@example.com>' AS message_id,
  'Mon, 1 Jan 2024 00:00:00 +0000' AS "date",
  CASE WHEN doc_id % 5 <> 2 THEN trim(text, E' \t\n\r') END AS body_text,
  CASE WHEN doc_id % 5 >= 2 THEN trim(text, E' \t\n\r') END AS body_html,
  CASE WHEN doc_id % 5 = 4 THEN 1 ELSE 0 END AS files
FROM documents""")
def parse_round_trip(i):
    return parsing.parsed_messages(parsing.parse_messages(i.raw_documents())).select(
        "source_folder_id", "uid", "subject", "from_address", "to_address", "message_id", "date",
        "body_text", "body_html", F.size("attachments").alias("files"),
    )


@query("parse_attachments", """
SELECT doc_id % 50 AS source_folder_id, doc_id + 1 AS uid, 0 AS position,
  'd' || doc_id || '.csv' AS filename, 'text/csv' AS content_type,
  doc_id || ';' || lang AS content, CAST(length(doc_id || ';' || lang) AS BIGINT) AS size_bytes
FROM documents WHERE doc_id % 5 = 4""")
def parse_attachments(i):
    return parsing.explode_attachments(parsing.parse_messages(i.raw_documents())).select(
        "source_folder_id", "uid", "position", "filename", "content_type",
        F.decode("data", "UTF-8").alias("content"), "size_bytes",
    )


@query("parse_errors", """
SELECT doc_id % 50 AS source_folder_id, doc_id + 1 AS uid FROM documents WHERE doc_id % 4 = 0""")
def parse_errors(i):
    """Every fourth document's message says a text that is no valid Unicode."""
    broken = F.concat(
        F.lit("Subject: x\r\nContent-Type: text/plain; charset=unicode_escape\r\n\r\n\\ud800"),
        "text",
    )
    raw = i.raw_documents().join(
        i.table("documents").select((F.col("doc_id") + 1).alias("uid"), "text"), "uid"
    )
    hurt = raw.withColumn(
        "rfc822_data",
        F.when(F.col("uid") % 4 == 1, F.encode(broken, "UTF-8")).otherwise(F.col("rfc822_data")),
    ).drop("text")
    return parsing.parse_errors(parsing.parse_messages(hurt)).select("source_folder_id", "uid")


@query("readable_messages", """
SELECT doc_id % 50 AS source_folder_id, doc_id + 1 AS uid FROM documents WHERE doc_id % 6 <> 0""")
def readable(i):
    lost = F.col("uid") % 6 == 1
    raw = i.raw_documents().withColumn(
        "rfc822_data", F.when(lost, F.lit(None)).otherwise(F.col("rfc822_data"))
    )
    return readable_messages(raw).select("source_folder_id", "uid")


@query("strip_blanks", r"""
SELECT doc_id, md5(trim(text, E' \t\n\r')) AS stripped FROM documents""")
def strip_blanks(i):
    padded = F.concat(F.lit(" \x1f\n "), "text", F.lit("\t 　\r\n"))
    return i.table("documents").select("doc_id", F.md5(tx.strip(padded)).alias("stripped"))
