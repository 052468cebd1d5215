"""Bulk message parsing: one Arrow-batched job over a message table."""

from __future__ import annotations

import email
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ledgerflow import schemas

# Rows go back to Spark whenever this many bytes of messages have been parsed.
FLUSH_BYTES = 4 * 1024 * 1024
# Fewer messages than this a task cost less than starting the task.
MESSAGES_PER_TASK = 2_000


def _header(headers: dict[str, str], name: str, default: str | None) -> str | None:
    value = headers.get(name)
    if value is None:
        return default
    # bytes outside ASCII arrive as surrogates; read them as UTF-8
    return value.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


def _body(part) -> str:
    """A part's payload as text; bytes its charset cannot read are left out."""
    charset = part.get_content_charset() or "utf-8"
    return part.get_payload(decode=True).decode(charset, "ignore")


def _bodies(message) -> dict[str, str | None]:
    """First plain text and first HTML body."""
    found: dict[str, str | None] = {"text/plain": None, "text/html": None}
    if not message.is_multipart():
        kind = message.get_content_type()
        slot = kind if kind in found else "text/plain"
        try:
            if message.get_payload(decode=True):
                found[slot] = _body(message)
        except Exception:
            # an unknown charset: the payload as it was sent
            found["text/plain"] = str(message.get_payload())
        return found
    for part in message.walk():
        kind = part.get_content_type()
        wanted = kind in found and found[kind] is None
        if not wanted or "attachment" in str(part.get("Content-Disposition", "")):
            continue
        try:
            found[kind] = _body(part)
        except Exception:
            continue
    return found


def _attachments(message, with_data: bool = True) -> list[dict]:
    """Every part with a file name and a payload, inline ones included.

    Without data the parts are found all the same, and their bytes are left behind here.
    """
    files = []
    for part in message.walk():
        name = part.get_filename()
        if not name:
            continue
        try:
            name.encode("utf-8")
            data = part.get_payload(decode=True)
        except Exception:
            continue
        if data is not None:
            files.append({
                "filename": name,
                "content_type": part.get_content_type(),
                "data": data if with_data else None,
                "size_bytes": len(data),
            })
    return files


def parse_one(raw: bytes, with_data: bool = True) -> dict:
    """Headers, bodies and attachments of one message, by the ``PARSED_FIELDS`` names."""
    message = email.message_from_bytes(raw)
    headers: dict[str, str] = {}
    for name, value in message.raw_items():
        headers.setdefault(name.lower(), value)
    bodies = {kind: text and text.strip() for kind, text in _bodies(message).items()}
    row = {
        "subject": _header(headers, "subject", ""),
        "from_address": _header(headers, "from", ""),
        "to_address": _header(headers, "to", ""),
        "date": _header(headers, "date", ""),
        "body_text": bodies["text/plain"],
        "body_html": bodies["text/html"],
        "message_id": _header(headers, "message-id", None),
        "attachments": _attachments(message, with_data),
        "parse_error": None,
    }
    for kind in ("body_text", "body_html"):
        if row[kind] is not None:
            row[kind].encode("utf-8")
    return row


def _failed(error: Exception) -> dict:
    row = {field.name: None for field in schemas.PARSED_FIELDS}
    row.update(subject="", from_address="", to_address="", date="", attachments=[])
    row["parse_error"] = str(error) or type(error).__name__
    return row


def _parse_safely(raw: bytes, with_data: bool = True) -> dict:
    try:
        return parse_one(raw, with_data)
    except Exception as error:
        return _failed(error)


def _texts_only(raw: bytes) -> dict:
    return _parse_safely(raw, with_data=False)


def _files_only(raw: bytes) -> dict:
    try:
        return {"attachments": _attachments(email.message_from_bytes(raw))}
    except Exception:
        return {"attachments": []}


def dealt(messages: DataFrame, expected: int | None = None) -> DataFrame:
    """Messages in a few tasks of like size for every core.

    Spark cuts a join's output by its bytes, and mail costs far more to parse than to move: it
    comes in about one task a core, or in a single one, and most cores wait for the last.  Only
    the messages that are parsed are moved for it.  Where the caller says how many are
    ``expected``, there are no more than three tasks a core for a few of them.
    """
    spark = messages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if expected is not None:
        parts = min(parts, -(-expected // MESSAGES_PER_TASK))
    return messages.repartition(max(3 * spark.sparkContext.defaultParallelism, parts))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Replace ``rfc822_data`` by the parsed fields; all other columns are carried along.

    A message that cannot be parsed keeps its row, with the reason in ``parse_error``.
    Needs no folder locality, so it runs on whatever partitions the messages are in.
    """
    return _mapped(messages, _parse_safely, schemas.PARSED_FIELDS)


def parse_texts(messages: DataFrame) -> DataFrame:
    """The same without the bytes of the attachments, whose ``data`` is NULL."""
    return _mapped(messages, _texts_only, schemas.PARSED_FIELDS)


def parse_files(messages: DataFrame) -> DataFrame:
    """Replace ``rfc822_data`` by the ``attachments``, with their bytes."""
    fields = [f for f in schemas.PARSED_FIELDS if f.name == "attachments"]
    return _mapped(messages, _files_only, fields)


def _mapped(
    messages: DataFrame, parse_raw: Callable[[bytes], dict], fields: list[StructField]
) -> DataFrame:
    kept = [name for name in messages.columns if name != "rfc822_data"]
    schema = StructType([
        *[StructField(name, messages.schema[name].dataType, True) for name in kept], *fields])
    arrow_schema = to_arrow_schema(schema)
    parsed_names = [field.name for field in fields]

    def rows_of(batch: pa.RecordBatch, start: int, parsed: list[dict]) -> pa.RecordBatch:
        arrays = [
            batch.column(batch.schema.get_field_index(name))
            .slice(start, len(parsed))
            .cast(arrow_schema.field(name).type)
            for name in kept
        ]
        arrays += [
            pa.array([row[name] for row in parsed], arrow_schema.field(name).type)
            for name in parsed_names
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(batch.schema.get_field_index("rfc822_data"))
            start, held, parsed = 0, 0, []
            for index in range(batch.num_rows):
                data = raw[index].as_py()
                parsed.append(parse_raw(data))
                held += len(data)
                if held >= FLUSH_BYTES:
                    yield rows_of(batch, start, parsed)
                    start, held, parsed = index + 1, 0, []
            if parsed:
                yield rows_of(batch, start, parsed)

    return messages.filter(F.col("rfc822_data").isNotNull()).mapInArrow(parse, schema)


def parsed_messages(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNull()).drop("parse_error")


def parse_errors(parsed: DataFrame) -> DataFrame:
    """Messages set aside because they could not be parsed."""
    return parsed.filter(F.col("parse_error").isNotNull()).select(
        "source_folder_id", "uid", F.col("parse_error").alias("error")
    )


def explode_attachments(parsed: DataFrame, *context: str) -> DataFrame:
    """One row per attachment, numbered in message order, with the named context columns."""
    key = ["source_folder_id", "uid", *context]
    return parsed.select(
        *key, F.posexplode("attachments").alias("position", "file")
    ).select(*key, "position", "file.*")
