"""Declared schemas of every table and transient relation; nothing is inferred on read."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _f(name, kind, required=False):
    return StructField(name, kind, not required)


USER = StructType([
    _f("id", StringType(), True),
    _f("name", StringType(), True),
    _f("email", StringType(), True),
    _f("email_verified", BooleanType(), True),
    _f("image", StringType()),
    _f("created_at", TimestampNTZType(), True),
    _f("updated_at", TimestampNTZType(), True),
])

SOURCE = StructType([
    _f("id", LongType(), True),
    _f("user_id", StringType(), True),
    _f("name", StringType(), True),
    _f("email_address", StringType(), True),
    _f("source_type", StringType(), True),
    _f("oauth2_access_token", StringType()),
    _f("oauth2_refresh_token", StringType()),
    _f("oauth2_access_token_expires_at", TimestampNTZType()),
    _f("oauth2_refresh_token_expires_at", TimestampNTZType()),
    _f("created_at", TimestampType(), True),
    _f("updated_at", TimestampType(), True),
])

SOURCE_FOLDER = StructType([
    _f("id", LongType(), True),
    _f("source_id", LongType(), True),
    _f("folder_name", StringType(), True),
    _f("uid_validity", StringType(), True),
    _f("high_water_mark", LongType()),
    _f("low_water_mark", LongType()),
    _f("last_processed_at", TimestampType()),
    _f("created_at", TimestampType(), True),
    _f("updated_at", TimestampType(), True),
])

# The unit price is number text, so that no price a model writes is rounded or cut by size.
UNIT_PRICE = StringType()
AMOUNT = DecimalType(10, 2)

LINE_ITEMS = ArrayType(StructType([
    _f("description", StringType()),
    _f("quantity", DoubleType()),
    _f("unit_price", UNIT_PRICE),
]))

ATTACHED_FILES = ArrayType(StructType([
    _f("file_name", StringType()),
    _f("file_key", StringType()),
]))

INVOICE = StructType([
    _f("id", LongType(), True),
    _f("source_id", LongType()),
    _f("message_id", StringType()),
    _f("invoice_number", StringType()),
    _f("vendor_name", StringType()),
    _f("due_date", TimestampType()),
    _f("total_amount", AMOUNT),
    _f("currency", StringType()),
    _f("payment_status", StringType()),
    _f("line_items", LINE_ITEMS),
    _f("created_at", TimestampType(), True),
    _f("updated_at", TimestampType(), True),
    _f("user_id", StringType(), True),
    _f("attached_files", ATTACHED_FILES),
    _f("uid", LongType()),
    _f("source_folder_id", LongType()),
])

FOLDER_LISTING = StructType([
    _f("source_id", LongType(), True),
    _f("name", StringType(), True),
    _f("uid_validity", StringType(), True),
])

RAW_MESSAGE = StructType([
    _f("source_folder_id", LongType(), True),
    _f("uid", LongType(), True),
    _f("rfc822_data", BinaryType()),
])

ATTACHMENT_PARTS = ArrayType(StructType([
    _f("filename", StringType()),
    _f("content_type", StringType()),
    _f("data", BinaryType()),
    _f("size_bytes", LongType()),
]))

# What the parse job adds to a message row in place of its raw bytes.
PARSED_FIELDS = [
    _f("subject", StringType()),
    _f("from_address", StringType()),
    _f("to_address", StringType()),
    _f("date", StringType()),
    _f("body_text", StringType()),
    _f("body_html", StringType()),
    _f("message_id", StringType()),
    _f("attachments", ATTACHMENT_PARTS),
    _f("parse_error", StringType()),
]

PARSED_EMAIL = StructType(RAW_MESSAGE.fields[:2] + PARSED_FIELDS)

MODEL_RESPONSE = StructType([
    _f("source_folder_id", LongType()),
    _f("uid", LongType()),
    _f("stage", StringType()),
    _f("response", StringType()),
    _f("error", StringType()),
])

TOKEN_REFRESH = StructType([
    _f("source_id", LongType(), True),
    _f("new_token", StringType()),
    _f("error", StringType()),
])

ATTACHMENT = StructType([
    _f("file_key", StringType(), True),
    _f("content_type", StringType()),
    _f("data", BinaryType(), True),
    _f("size_bytes", LongType(), True),
])

ERRORS = ArrayType(StructType([_f("uid", LongType()), _f("error", StringType())]))

CHUNK_METRICS = StructType([
    _f("worker_id", StringType()),
    _f("source_folder_id", LongType()),
    _f("chunk_num", IntegerType()),
    _f("emails_fetched", LongType()),
    _f("emails_processed", LongType()),
    _f("invoices_found", LongType()),
    _f("non_invoices", LongType()),
    _f("errors", ERRORS),
    _f("duration_sec", DoubleType()),
    _f("classification_time_sec", DoubleType()),
    _f("extraction_time_sec", DoubleType()),
    _f("s3_upload_time_sec", DoubleType()),
    _f("db_commit_time_sec", DoubleType()),
])

# One document per folder run, as it is written for monitoring.
RUN_DOCUMENT = StructType([
    _f("source_folder_id", LongType()),
    _f("timestamp", StringType()),
    _f("emails_fetched", LongType()),
    _f("chunks_processed", LongType()),
    _f("invoices_found", LongType()),
    _f("non_invoices", LongType()),
    _f("errors", LongType()),
    _f("metrics", ArrayType(CHUNK_METRICS)),
])

WATERMARK = StructType([
    _f("source_folder_id", LongType()),
    _f("high_water_mark", LongType()),
    _f("low_water_mark", LongType()),
    _f("processed_at", TimestampType()),
])
