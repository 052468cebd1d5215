"""Prompts for the two model calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# How much of the body a prompt shows, in code points.
CLASSIFY_BODY_CHARS = 2000
EXTRACT_BODY_CHARS = 4000

# Prompt texts around subject, sender and body.
CLASSIFY_PROMPT = """Analyze this email and determine if it contains an invoice or receipt.

Subject: {subject}
From: {sender}
Body (first 2000 chars):
{body}

Respond with ONLY a JSON object. Do not include thinking process, markdown blocks, or any text before or after the JSON.

Output JSON with these exact fields:
{
  "is_invoice": true or false,
  "confidence": "high" or "medium" or "low",
  "reasoning": "brief explanation"
}"""

EXTRACT_PROMPT = """Extract invoice information from this email.

Subject: {subject}
From: {sender}
Body:
{body}

Respond with ONLY a JSON object. Do not include thinking process, markdown blocks, or any text before or after the JSON.

Output JSON with these exact fields:
{
  "vendor_name": "company name",
  "invoice_number": "invoice/receipt number or null",
  "due_date": "YYYY-MM-DD or null",
  "total_amount": number or null,
  "currency": "USD",
  "payment_status": "paid" or "unpaid" or "unknown" or null,
  "line_items": [
    {"description": "item description", "quantity": 1, "unitPrice": 10.00}
  ]
}"""
# ----------------------------------------------------------------------------


def choose_body() -> Column:
    """Plain text, else HTML, else nothing; an empty body counts as absent."""
    return F.coalesce(
        F.nullif(F.col("body_text"), F.lit("")),
        F.nullif(F.col("body_html"), F.lit("")),
        F.lit(""),
    )


def truncate_body(body: Column, chars: int) -> Column:
    return F.substring(body, 1, chars)


def cut_bodies(messages: DataFrame) -> DataFrame:
    """Messages with as much of their chosen body as the longest prompt takes.

    Prompts made of these are the same, and what is joined later carries no whole body.
    """
    longest = max(CLASSIFY_BODY_CHARS, EXTRACT_BODY_CHARS)
    return messages.withColumns({
        "body_text": truncate_body(choose_body(), longest),
        "body_html": F.lit(None).cast("string"),
    })


def _fill(template: str, chars: int) -> Column:
    head, rest = template.split("{subject}")
    middle, rest = rest.split("{sender}")
    before_body, tail = rest.split("{body}")
    return F.concat(
        F.lit(head),
        F.col("subject"),
        F.lit(middle),
        F.col("from_address"),
        F.lit(before_body),
        truncate_body(choose_body(), chars),
        F.lit(tail),
    )


def classify_prompt() -> Column:
    return _fill(CLASSIFY_PROMPT, CLASSIFY_BODY_CHARS)


def extract_prompt() -> Column:
    return _fill(EXTRACT_PROMPT, EXTRACT_BODY_CHARS)


def with_prompt(messages: DataFrame, stage: str) -> DataFrame:
    """Messages with the prompt of a stage, ``classify`` or ``extract``."""
    prompt = {"classify": classify_prompt, "extract": extract_prompt}[stage]()
    return messages.withColumn("prompt", prompt)
