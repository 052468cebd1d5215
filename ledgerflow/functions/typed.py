"""Typed reading of model answers through VARIANT.

Each ``to_*`` helper takes a JSON value with its kind and gives the typed form, or NULL
where the value may not stand in such a field.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import strip

# --- fixed values -----------------------------------------------------------
# Texts that count as a truth value.
TRUE_WORDS = ["1", "on", "t", "true", "y", "yes"]
FALSE_WORDS = ["0", "off", "f", "false", "n", "no"]
# Above this many units an epoch number is read as milliseconds.
EPOCH_SECONDS_LIMIT = 2e10
# Epoch seconds of the years 1600 and 9999, the range that is accepted.
EPOCH_MIN = -11_676_096_000
EPOCH_MAX = 253_402_300_799
# ----------------------------------------------------------------------------

ABSENT = "ABSENT"
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
EPOCH_PATTERN = r"^[+-]?\d+(\.\d+)?$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DATETIME_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2})[Tt _](\d{2}:\d{2})(:\d{2}(?:[.,]\d+)?)?([Zz]|[+-]\d{2}:?\d{2})?$"
)


def wrap_whole(text: Column) -> Column:
    """The text as first element of a JSON array that ends in the text's own digest.

    The VARIANT parser stops after the first value and ignores what follows.  In
    the wrapped form anything after the value breaks the array or hides the digest.
    """
    digest = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), digest, F.lit("]")))


def whole_value(wrapped: Column, text: Column) -> Column:
    """The value of a ``wrap_whole`` column, NULL unless the text was exactly one value."""
    complete = F.try_variant_get(wrapped, "$[1]", "bigint") == F.xxhash64(text)
    return F.when(complete, F.try_variant_get(wrapped, "$[0]", "variant"))


def get(doc: Column, name: str) -> Column:
    """A member as VARIANT: NULL when the key is absent, variant null for JSON null."""
    return F.try_variant_get(doc, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """``STRING``, ``BIGINT``, ``OBJECT<...>`` and so on; an absent key has no kind.

    The ``to_*`` helpers take it as their second argument, so that it is computed
    once per value.
    """
    return F.coalesce(F.schema_of_variant(value), F.lit(ABSENT))


def is_object(k: Column) -> Column:
    return k.startswith("OBJECT")


def is_text(k: Column) -> Column:
    return k == "STRING"


def is_number(k: Column) -> Column:
    return (k == "BIGINT") | (k == "DOUBLE") | k.startswith("DECIMAL")


def is_bool(k: Column) -> Column:
    return k == "BOOLEAN"


def is_absent(k: Column) -> Column:
    """The key is missing or holds JSON null."""
    return k.isin(ABSENT, "VOID")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def as_double(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


def optional(k: Column, value: Column) -> Column:
    """An optional field is in order when it is absent or has a typed value."""
    return is_absent(k) | value.isNotNull()


def to_text(value: Column, k: Column) -> Column:
    """Text only: a number or a boolean is not turned into text."""
    return F.when(is_text(k), as_text(value))


def to_bool(value: Column, k: Column) -> Column:
    """Truth value: JSON booleans, 0 and 1, and the listed words."""
    word = F.lower(as_text(value))
    number = as_double(value)
    return (
        F.when(is_bool(k), F.try_variant_get(value, "$", "boolean"))
        .when(is_number(k) & number.isin(0.0, 1.0), number == 1.0)
        .when(is_text(k) & word.isin(TRUE_WORDS), F.lit(True))
        .when(is_text(k) & word.isin(FALSE_WORDS), F.lit(False))
    )


def to_number_text(value: Column, k: Column) -> Column:
    """Number or numeric string as plain number text.

    A JSON number goes through its shortest double form, a string keeps all its
    digits; blanks around and underscores within a string do not count.
    """
    written = F.translate(strip(as_text(value)), "_", "")
    return F.when(is_number(k), as_double(value).cast("string")).when(
        is_text(k), F.nullif(F.regexp_extract(written, NUMBER_PATTERN, 0), F.lit(""))
    )


def to_double(value: Column, k: Column) -> Column:
    """Number or numeric string; booleans count as 0 and 1."""
    return F.when(is_number(k) | is_bool(k), as_double(value)).otherwise(
        to_number_text(value, k).try_cast("double")
    )


def _from_epoch(number: Column) -> Column:
    seconds = F.when(F.abs(number) > EPOCH_SECONDS_LIMIT, number / 1000).otherwise(number)
    micros = F.round(seconds * 1_000_000).cast("bigint")
    return F.when(seconds.between(EPOCH_MIN, EPOCH_MAX), F.timestamp_micros(micros))


def parse_time(text: Column) -> Column:
    """ISO date, ISO date and time, or epoch number in text form; no zone means UTC."""
    clock = F.regexp_extract(text, DATETIME_PATTERN, 3)
    zone = F.regexp_extract(text, DATETIME_PATTERN, 4)
    normal = F.concat(
        F.regexp_extract(text, DATETIME_PATTERN, 1),
        F.lit("T"),
        F.regexp_extract(text, DATETIME_PATTERN, 2),
        F.when(clock == "", F.lit(":00")).otherwise(F.translate(clock, ",", ".")),
        F.when(F.upper(zone).isin("", "Z"), F.lit("Z")).otherwise(
            F.regexp_replace(zone, r"^(...):?(..)$", "$1:$2")
        ),
    )
    return (
        F.when(text.startswith("0000"), F.lit(None).cast("timestamp"))
        .when(text.rlike(DATE_PATTERN), F.concat(text, F.lit("T00:00:00Z")).try_cast("timestamp"))
        .when(text.rlike(DATETIME_PATTERN), normal.try_cast("timestamp"))
        .when(text.rlike(EPOCH_PATTERN), _from_epoch(text.try_cast("double")))
    )


def to_time(value: Column, k: Column) -> Column:
    """Moment from text or epoch number."""
    return F.when(is_text(k), parse_time(as_text(value))).when(
        is_number(k), _from_epoch(as_double(value))
    )


def all_valid(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, flags)
