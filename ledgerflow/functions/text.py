"""Text expressions: stripping, keyword tests and cleaning of model answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Words that mark a subject as an invoice when the model gives no usable answer.
INVOICE_KEYWORDS = ["invoice", "receipt", "payment", "paid", "bill"]

# Patterns that find the JSON object in a model answer.
THINK_PATTERN = r"(?s)<think>.*?</think>"
OBJECT_PATTERN = r"(?s)\{.*\}"
# ----------------------------------------------------------------------------

# Every character that counts as blank at either end of a text: the Unicode
# blanks and the four ASCII separators.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_BLANK_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*"
)
FENCE_PATTERN = r"(?s)```(?:json)?" + _BLANK_CLASS + r"(\{.*?\})" + _BLANK_CLASS + "```"


def strip(text: Column) -> Column:
    """Remove blanks, Unicode ones included, from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def contains_any(text: Column, words: list[str] | None = None) -> Column:
    """True when the lower-cased text has one of the words as a substring."""
    lowered = F.lower(text)
    tests = [lowered.contains(word) for word in (words or INVOICE_KEYWORDS)]
    return reduce(lambda a, b: a | b, tests)


def _first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """The matched text, or NULL where the pattern does not occur."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def without_thinking(text: Column) -> Column:
    """Drop the closed think blocks of a stripped text; an open one stays."""
    tagged = text.contains("<think>") | text.contains("</think>")
    return F.when(tagged, strip(F.regexp_replace(text, THINK_PATTERN, ""))).otherwise(text)


def json_part(text: Column) -> Column:
    """The JSON object of a stripped answer without think blocks.

    A fenced object comes first, then the span from the first to the last brace,
    then the text as it is.  A text that starts with a brace and has no fence is
    left alone, so junk after its object makes it unparsable later on.
    """
    fenced = text.contains("```")
    span = F.coalesce(_first_match(text, OBJECT_PATTERN), text)
    return (
        F.when(fenced, F.coalesce(_first_match(text, FENCE_PATTERN, 1), span))
        .when(~text.startswith("{"), span)
        .otherwise(text)
    )


def repair_brace(text: Column) -> Column:
    """Append the closing brace a cut-off classification answer lacks."""
    return F.when(text.endswith("}"), text).otherwise(F.concat(text, F.lit("}")))
