"""From model answers to typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import text as tx
from ledgerflow.functions import typed as ty
from ledgerflow.operators.staging import staged

NO_EXTRACTION = "Invoice extraction returned None"
TOO_LARGE = "total_amount does not fit numeric(10,2)"
DEFAULT_CURRENCY = "USD"


def with_clean_response(answers: DataFrame, repair: bool = False) -> DataFrame:
    """Add ``cleaned`` to rows with a ``response``; ``repair`` closes a cut-off object."""
    rows = staged(answers, _text=tx.strip(F.col("response")))
    rows = staged(rows, _text=tx.without_thinking(F.col("_text")))
    rows = staged(rows, cleaned=tx.json_part(F.col("_text"))).drop("_text")
    if repair:
        rows = staged(rows, cleaned=tx.repair_brace(F.col("cleaned")))
    return rows


def with_document(answers: DataFrame) -> DataFrame:
    """Add ``doc``: the VARIANT of ``cleaned``, NULL unless that is one JSON object."""
    cleaned = F.col("cleaned")
    rows = staged(answers, doc=ty.wrap_whole(cleaned))
    rows = staged(rows, doc=ty.whole_value(F.col("doc"), cleaned))
    return staged(rows, doc=F.when(ty.is_object(ty.kind(F.col("doc"))), F.col("doc")))


def with_fields(rows: DataFrame, names: list[str]) -> DataFrame:
    """Add the named members of ``doc`` as ``_name`` and their kinds as ``_name_kind``."""
    rows = staged(rows, **{f"_{name}": ty.get(F.col("doc"), name) for name in names})
    return staged(rows, **{f"_{name}_kind": ty.kind(F.col(f"_{name}")) for name in names})


def _field(name: str) -> tuple[Column, Column]:
    return F.col(f"_{name}"), F.col(f"_{name}_kind")


def _field_columns(names: list[str]) -> list[str]:
    return [f"_{name}{end}" for name in names for end in ("", "_kind")]


def keyword_fallback(subject: Column) -> Column:
    """Classification by subject words, for when the model gives nothing usable."""
    return tx.contains_any(subject)


def decode_classification(answers: DataFrame) -> DataFrame:
    """Add ``is_invoice``, ``confidence``, ``reasoning`` and ``fallback``.

    Needs ``subject`` and ``response``, and uses ``error`` where the call itself
    failed.  Whatever goes wrong, the subject words decide and confidence is ``low``.
    """
    if "error" not in answers.columns:
        answers = answers.withColumn("error", F.lit(None).cast("string"))
    names = ["is_invoice", "confidence", "reasoning"]
    rows = with_fields(with_document(with_clean_response(answers, repair=True)), names)
    rows = staged(
        rows,
        _flag=ty.to_bool(*_field("is_invoice")),
        _said_confidence=ty.to_text(*_field("confidence")),
        _said_reasoning=ty.to_text(*_field("reasoning")),
    )
    usable = ty.all_valid([
        F.col("error").isNull(),
        F.col("doc").isNotNull(),
        F.col("_flag").isNotNull(),
        ty.optional(F.col("_confidence_kind"), F.col("_said_confidence")),
        ty.optional(F.col("_reasoning_kind"), F.col("_said_reasoning")),
    ])
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("response").isNull(), F.lit("no response"))
        .when(F.col("doc").isNull(), F.lit("not a JSON object"))
        .otherwise(F.lit("invalid fields"))
    )
    rows = staged(rows, fallback=~F.coalesce(usable, F.lit(False)))
    fallback = F.col("fallback")
    said = F.concat(F.lit("Fallback classification (error: "), reason, F.lit(")"))
    return staged(
        rows,
        is_invoice=F.when(fallback, keyword_fallback(F.col("subject"))).otherwise(
            F.col("_flag")
        ),
        confidence=F.when(fallback, F.lit("low")).otherwise(F.col("_said_confidence")),
        reasoning=F.when(fallback, said).otherwise(F.col("_said_reasoning")),
    ).drop(
        *_field_columns(names), "_flag", "_said_confidence", "_said_reasoning",
        "doc", "cleaned", "response", "error",
    )


def decode_line_items(doc: Column) -> Column:
    """Valid line items of a document as an array of structs.

    Anything but a list gives an empty array.  An item needs a text description;
    quantity and unit price are optional finite numbers of any size; the price keeps all
    its digits, as text.  ``unit_price`` counts before ``unitPrice`` where both occur.  An
    item that breaks a rule, a number beyond all doubles among them, is left out.
    """
    items = F.try_variant_get(
        doc,
        "$.line_items",
        "array<struct<description variant, quantity variant, unitPrice variant, unit_price variant>>",
    )
    described = F.filter(
        F.coalesce(items, F.array()),
        lambda item: item.isNotNull() & ty.is_text(ty.kind(item["description"])),
    )
    opened = F.transform(described, lambda item: F.struct(
        ty.as_text(item["description"]).alias("description"),
        item["quantity"].alias("quantity"),
        ty.kind(item["quantity"]).alias("quantity_kind"),
        F.coalesce(item["unit_price"], item["unitPrice"]).alias("price"),
        ty.kind(F.coalesce(item["unit_price"], item["unitPrice"])).alias("price_kind"),
        # the value that does not count must still be a number
        F.when(item["unit_price"].isNotNull(), item["unitPrice"]).alias("shadowed"),
    ))

    def finite(number: Column) -> Column:
        return F.abs(number) < float("inf")

    # numbers are read here and tested below: a step of its own, so that each is read once
    def numbers(item: Column) -> Column:
        return F.struct(
            item["description"].alias("description"),
            item["quantity_kind"].alias("quantity_kind"),
            ty.to_double(item["quantity"], item["quantity_kind"]).alias("quantity"),
            item["price_kind"].alias("price_kind"),
            ty.to_number_text(item["price"], item["price_kind"]).alias("unit_price"),
            (
                item["shadowed"].isNull()
                | ty.is_absent(ty.kind(item["shadowed"]))
                | ty.to_number_text(item["shadowed"], ty.kind(item["shadowed"])).isNotNull()
            ).alias("shadowed_ok"),
        )

    def typed(item: Column) -> Column:
        return F.struct(
            item["description"].alias("description"),
            item["quantity_kind"].alias("quantity_kind"),
            F.when(finite(item["quantity"]), item["quantity"]).alias("quantity"),
            item["price_kind"].alias("price_kind"),
            F.when(finite(item["unit_price"].try_cast("double")), item["unit_price"]).alias("unit_price"),
            item["shadowed_ok"].alias("shadowed_ok"),
        )

    def valid(item: Column) -> Column:
        return (
            ty.optional(item["quantity_kind"], item["quantity"])
            & ty.optional(item["price_kind"], item["unit_price"])
            & item["shadowed_ok"]
        )

    kept = F.filter(F.transform(F.transform(opened, numbers), typed), valid)
    return F.transform(kept, lambda item: F.struct(
        item["description"].alias("description"),
        item["quantity"].alias("quantity"),
        item["unit_price"].alias("unit_price"),
    ))


def decode_invoice(answers: DataFrame) -> DataFrame:
    """Add ``invoice`` and ``extract_error`` to rows with a ``response``.

    One invalid field voids the whole invoice.  ``currency`` defaults only when the
    key is absent.  An amount the ledger column cannot hold is an error of that
    message alone.
    """
    if "error" not in answers.columns:
        answers = answers.withColumn("error", F.lit(None).cast("string"))
    doc = F.col("doc")
    names = [
        "vendor_name", "invoice_number", "due_date", "total_amount", "currency", "payment_status",
    ]
    rows = with_fields(with_document(with_clean_response(answers)), names)
    texts = ["vendor_name", "invoice_number", "currency", "payment_status"]
    rows = staged(
        rows,
        _due=ty.to_time(*_field("due_date")),
        _amount_text=ty.to_number_text(*_field("total_amount")),
        **{f"_said_{name}": ty.to_text(*_field(name)) for name in texts},
    )
    valid = ty.all_valid([
        F.col("error").isNull(),
        doc.isNotNull(),
        ty.optional(F.col("_due_date_kind"), F.col("_due")),
        ty.optional(F.col("_total_amount_kind"), F.col("_amount_text")),
        *[ty.optional(F.col(f"_{name}_kind"), F.col(f"_said_{name}")) for name in texts],
    ])
    rows = staged(
        rows,
        _valid=F.coalesce(valid, F.lit(False)),
        _amount=F.col("_amount_text").try_cast("decimal(10,2)"),
    )
    too_large = F.col("_amount_text").isNotNull() & F.col("_amount").isNull()
    rows = staged(
        rows,
        extract_error=F.when(~F.col("_valid"), F.lit(NO_EXTRACTION)).when(too_large, F.lit(TOO_LARGE)),
    )
    currency = F.when(
        F.col("_currency_kind") == ty.ABSENT, F.lit(DEFAULT_CURRENCY)
    ).otherwise(F.col("_said_currency"))
    invoice = F.struct(
        F.col("_said_vendor_name").alias("vendor_name"),
        F.col("_said_invoice_number").alias("invoice_number"),
        F.col("_due").alias("due_date"),
        F.col("_amount").alias("total_amount"),
        currency.alias("currency"),
        F.col("_said_payment_status").alias("payment_status"),
        decode_line_items(doc).alias("line_items"),
    )
    # a plain column: who asks for the error alone does not have every line item decoded
    return rows.withColumn("invoice", F.when(F.col("extract_error").isNull(), invoice)).drop(
        *_field_columns(names), *[f"_said_{name}" for name in texts],
        "_due", "_amount_text", "_amount", "_valid", "doc", "cleaned", "response", "error",
    )


def line_items_json(items: Column) -> Column:
    """Line items as they are stored: prices as numbers, nulls kept."""
    written = F.transform(items, lambda item: F.struct(
        item["description"].alias("description"),
        item["quantity"].alias("quantity"),
        item["unit_price"].cast("double").alias("unit_price"),
    ))
    return F.to_json(written, {"ignoreNullFields": "false"})


def attached_files_json(files: Column) -> Column:
    return F.to_json(files, {"ignoreNullFields": "false"})


def read_line_items_json(text: Column) -> Column:
    """Stored line items back to structs; both spellings of the unit price are read."""
    opened = F.from_json(
        text,
        "array<struct<description string, quantity double, "
        "unit_price string, unitPrice string>>",
    )
    return F.transform(opened, lambda item: F.struct(
        item["description"].alias("description"),
        item["quantity"].alias("quantity"),
        F.coalesce(item["unit_price"], item["unitPrice"]).alias("unit_price"),
    ))


def read_attached_files_json(text: Column) -> Column:
    """Stored file references back to structs; both spellings of the keys are read."""
    opened = F.from_json(
        text,
        "array<struct<file_name string, file_key string, fileName string, fileKey string>>",
    )
    return F.transform(opened, lambda item: F.struct(
        F.coalesce(item["file_name"], item["fileName"]).alias("file_name"),
        F.coalesce(item["file_key"], item["fileKey"]).alias("file_key"),
    ))
