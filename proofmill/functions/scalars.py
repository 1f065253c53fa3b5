"""Small typed readers: scores, integer counts, whole numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL_TEXT = r"^\s*[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?\s*$"
# Plain spellings, which a cast reads as they are: most numbers, without the rules for the others.
_PLAIN_SCORE = r"\A-?[0-9]{1,15}(\.[0-9]{1,15})?\z"
_PLAIN_COUNT = r"\A[0-9]{1,15}(\.0*)?\z"
_WHOLE_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def _number(text: Column) -> Column:
    return F.regexp_replace(text, r"[_\s]", "").try_cast("double")


def score_value(raw: Column) -> Column:
    """Number of a score read as text; NULL when missing or not a finite number."""
    number = F.when(raw.rlike(_DECIMAL_TEXT), _number(raw))
    return F.when(raw.rlike(_PLAIN_SCORE), raw.try_cast("double")).when(F.abs(number) < F.lit(float("inf")), number)


def score_problem(raw: Column) -> Column:
    """Why a non-NULL score is refused; the text never repeats the value.

    A bare NaN or Infinity in a document reaches a text column in quotes.
    """
    number = F.when(raw.rlike(_DECIMAL_TEXT), _number(raw))
    return (
        F.when(raw.isNull() | raw.rlike(_PLAIN_SCORE) | (F.abs(number) < F.lit(float("inf"))), F.lit(None).cast("string"))
        .when(raw.isin("true", "false"), F.lit("boolean is not a score"))
        .when(
            number.isNotNull() | F.lower(raw).rlike(r'^"?\s*[+-]?(nan|inf|infinity)\s*"?$'), F.lit("non-finite score")
        )
        .otherwise(F.lit("non-numeric score"))
    )


def count_value(raw: Column) -> Column:
    """Whole number of a count read as text, also where it is written as a float; NULL when missing or no whole number."""
    number = score_value(raw)
    return F.when(raw.rlike(_PLAIN_COUNT), F.substring_index(raw, ".", 1).try_cast("bigint")).when(
        number == F.floor(number), F.coalesce(raw.try_cast("bigint"), number.try_cast("bigint"))
    )


def count_problem(raw: Column) -> Column:
    """Why a non-NULL count is refused."""
    return F.when(raw.isNotNull() & count_value(raw).isNull(), F.lit("count is not a whole number"))


def whole_number(value: Column) -> Column:
    """Integer held by a VARIANT: integers and integral floats only; text and booleans are NULL."""
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    return F.when(
        (kind == "BIGINT") | ((kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")) & (number == F.floor(number))),
        F.try_variant_get(value, "$", "decimal(38,0)").try_cast("bigint"),
    )


def plain_integer(value: Column) -> Column:
    """Text of a VARIANT that is a whole number of a few digits, else NULL: most ids and counts, without a cast of the variant."""
    return F.get(F.regexp_extract_all(F.to_json(value), F.lit(r"\A-?[0-9]{1,15}\z"), F.lit(0)), 0)


def repeat_number(value: Column) -> Column:
    """Repeat index of a line: numbers are cut to integers, whole-number text is read, else 0."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return F.coalesce(
        F.when(kind == "STRING", F.when(text.rlike(_WHOLE_TEXT), F.regexp_replace(text, r"[_\s]", "").try_cast("bigint")))
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("bigint"))
        .otherwise(F.try_variant_get(value, "$", "double").try_cast("bigint")),
        F.lit(0).cast("bigint"),
    )


def decodable_base64(payload: Column) -> tuple[Column, Column]:
    """(well-formed, cleaned payload): characters outside the alphabet are dropped first,
    data ends at the first padding, and the padding must complete a group of four."""
    kept = F.regexp_replace(payload, "[^A-Za-z0-9+/=]", "")
    first_pad = F.instr(kept, "=")
    size = F.when(first_pad == 0, F.length(kept)).otherwise(first_pad - 1)
    rest = size % 4
    well_formed = (
        ((rest == 0) & ((first_pad == 0) | (F.rtrim(F.substring(kept, size + 1, F.length(kept)), F.lit("=")) == "")))
        | ((rest == 2) & (F.substring(kept, size + 1, F.lit(2)) == "=="))
        | ((rest == 3) & (first_pad > 0))
    )
    padding = F.when(rest == 2, F.lit("==")).when(rest == 3, F.lit("=")).otherwise(F.lit(""))
    return well_formed, F.concat(F.substring(kept, F.lit(1), size), padding)
