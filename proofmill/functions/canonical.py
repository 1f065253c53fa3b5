"""Canonical JSON text and SHA-256 digests as column expressions.

Canonical form: keys in sorted order, no blanks, non-ASCII characters kept,
control characters escaped with lower-case hex.  Every identity in the package
is the SHA-256 of such a text, so all hashing goes through this module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# to_json writes these as \u00XX with upper-case hex; the canonical form is lower-case.
_HEX_CONTROLS = r"[\x00-\x07\x0b\x0e-\x1f]"
_ESCAPED = r'["\\\x00-\x1f]'  # text without these is its own literal
_AROUND_CONTROL = rf"(?<={_HEX_CONTROLS})|(?={_HEX_CONTROLS})"

# The control escapes that to_json writes with a letter, each with its canonical spelling.
_LETTERED = [(f"\\u{n:04X}", f"\\u{n:04x}") for n in (0x0B, 0x0E, 0x0F, *range(0x1A, 0x20))]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _quoted(col: Column) -> Column:
    # the literal starts and ends with a quote (or is null), so only the brackets go
    return F.btrim(F.to_json(F.array(col)), F.lit("[]"))


def _unquoted(col: Column) -> Column:
    quoted = _quoted(col)
    return F.substring(quoted, F.lit(2), F.length(quoted) - 2)


def json_text(col: Column) -> Column:
    """JSON string literal of a text column; NULL becomes ``null``."""
    quoted = _quoted(col)
    pieces = F.transform(
        F.split(col, _AROUND_CONTROL),
        lambda piece: F.when(
            piece.rlike(f"^{_HEX_CONTROLS}$"), F.concat(F.lit("\\u00"), F.lower(F.hex(piece)))
        ).otherwise(_unquoted(piece)),
    )
    rebuilt = F.concat(F.lit('"'), F.array_join(pieces, ""), F.lit('"'))
    return F.when(~col.rlike(_ESCAPED), F.concat(F.lit('"'), col, F.lit('"'))).when(quoted.contains("\\u00"), rebuilt).otherwise(quoted)


def json_hex(col: Column) -> Column:
    """JSON literal of a digest column (hex needs no escaping); NULL becomes ``null``."""
    return F.coalesce(F.concat(F.lit('"'), col, F.lit('"')), F.lit("null"))


def json_bool(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit("null"))


def json_object(**members: Column) -> Column:
    """JSON object from columns that already hold JSON; keys are sorted here."""
    parts: list[Column] = []
    for index, name in enumerate(sorted(members)):
        parts.append(F.lit(f'{"," if index else "{"}"{name}":'))
        parts.append(members[name])
    return F.concat(*parts, F.lit("}"))


def json_list(elements: Column) -> Column:
    """JSON array from an array column of JSON texts (NULL elements are left out)."""
    return F.concat(F.lit("["), F.array_join(elements, ","), F.lit("]"))


def json_strings(values: Column) -> Column:
    """JSON array of an ``array<string>`` column, NULL elements kept as ``null``."""
    plain = F.to_json(values)
    return F.when(plain.contains("\\u00"), json_list(F.transform(values, json_text))).otherwise(plain)


def digest(json: Column) -> Column:
    return F.sha2(json, 256)


def canonical_variant(value: Column) -> Column:
    """Canonical JSON of a VARIANT of any depth; NULL stays NULL.

    ``to_json`` sorts the members of a variant at every level; only the spelling of control escapes differs. Text is cut at
    escaped backslashes first, so what looks like an escape behind one is left alone.
    """

    def lowered(piece: Column) -> Column:
        for written, wanted in _LETTERED:
            piece = F.replace(piece, F.lit(written), F.lit(wanted))
        return piece

    def fixed(text: Column) -> Column:
        pieces = F.transform(F.split(text, r"\\\\", -1), lowered)
        return F.when(text.contains("\\u00"), F.array_join(pieces, "\\\\")).otherwise(text)

    return let(F.to_json(value), fixed)


# Private-use characters stand around a number while it is found, the first before its text while the document is a variant.
_NUMBER_MARK, _NUMBER_END = "\ue000", "\ue001"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"


def keep_numbers(json: Column) -> Column:
    """JSON text in which every number is a marked string, so that a variant keeps it as written (``5.0`` is not ``5``).

    ``restore_numbers`` undoes it. A string that is the mark and a number itself would be taken for one.
    """
    told = F.regexp_replace(json, f"({_STRING})|({_NUMBER})", f"$1{_NUMBER_MARK}$2{_NUMBER_END}")
    bare = F.replace(told, F.lit(_NUMBER_MARK + _NUMBER_END), F.lit(""))
    return F.regexp_replace(bare, f"{_NUMBER_MARK}({_NUMBER}){_NUMBER_END}", f'"{_NUMBER_MARK}$1"')


def restore_numbers(json: Column) -> Column:
    return F.regexp_replace(json, f'"{_NUMBER_MARK}({_NUMBER})"', "$1")
