"""Tolerant parsing of text columns. Malformed text becomes NULL, with ANSI mode on or off."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_DECIMAL_TAIL = r"^(\s*[+-]?)(\d*)\.\d*(\s*)$"
_TWO_DIGITS = {"MM", "dd", "HH", "hh", "mm", "ss"}
_FORMAT_TOKEN = re.compile(r"'(?P<quoted>[^']*)'|(?P<run>(?P<letter>[A-Za-z])(?P=letter)*)|(?P<other>.)")


def parse_int(col: Column, type_name: str = "int") -> Column:
    """Text to ``int`` or ``long``; a decimal tail is cut off, other text is NULL.

    ``'12'``, ``' 12 '``, ``'12.0'`` and ``'12.7'`` give 12; ``''`` and ``'abc'`` give NULL. The
    digits never pass through a double, so long ids keep every digit. Only text that fails the
    plain cast and has a point meets the regular expression.
    """
    whole_part = F.when(col.contains("."), F.regexp_replace(col, _DECIMAL_TAIL, "$10$2"))
    return F.coalesce(col.try_cast(type_name), whole_part.try_cast(type_name))


def parse_double(col: Column) -> Column:
    """Text to ``double``; malformed text is NULL."""
    return col.try_cast("double")


def parse_number(col: Column) -> Column:
    """Trimmed text to ``double``; NULL, empty and malformed text are NULL."""
    text = F.trim(col)
    return F.when(text != "", text.try_cast("double"))


def parse_bool(col: Column) -> Column:
    """``true/t/yes/y/1`` and their opposites in any case, else NULL."""
    return F.lower(F.trim(col)).try_cast("boolean")


def parse_timestamp(col: Column, formats: Sequence[str]) -> Column:
    """The first format that matches wins, else NULL.

    A failed format costs an exception per row inside the formatter. A regular expression made from
    the format keeps text of another shape away from it, and lets through all that could parse.
    """
    return F.coalesce(
        *[F.when(col.rlike(_shape(fmt)), F.try_to_timestamp(col, F.lit(fmt))) for fmt in formats]
    )


def _shape(fmt: str) -> str:
    """Regular expression that every text of a date-time format matches."""
    parts = []
    for token in _FORMAT_TOKEN.finditer(fmt):
        if token["quoted"] is not None:
            parts.append(re.escape(token["quoted"]))
        elif token["letter"] == "y" and len(token["run"]) == 4:
            parts.append(r"[+-]?\d{4,}")
        elif token["run"] in _TWO_DIGITS:
            parts.append(r"\d{2}")
        elif token["letter"]:
            parts.append(r".+")
        else:
            parts.append(re.escape(token["other"]))
    return "(?i)^" + "".join(parts) + "$"
