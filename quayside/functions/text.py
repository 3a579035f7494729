"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped from both ends of a booked PO number, and
# from a PO header identifier.
BOOKED_PO_STRIP = " ()#abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-&:.%"
HEADER_PO_STRIP = "PO#"

# Fixed value: separators between PO numbers typed into one booking field.
PO_SEPARATORS = "\n|/ |, | "

CONFIG_CODE_LENGTH = 7
SAMPLE_CODE_LENGTH = 11


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def holds(c: Column | str, part: str) -> Column:
    """Whether a text has a part, in the same case; NULL for missing text."""
    return as_col(c).contains(part)


def as_key(c: Column | str) -> Column:
    """Join keys are always text."""
    return as_col(c).cast("string")


def fold_code(c: Column | str) -> Column:
    """Scanned codes are compared in upper case."""
    return F.upper(as_col(c))


def strip_chars(c: Column | str, chars: str) -> Column:
    """Remove any of `chars` from both ends."""
    return F.btrim(as_col(c), F.lit(chars))


def kv_fields(c: Column | str, names: Sequence[str]) -> list[Column]:
    """Values of a `label: value;label: value` list, by position.

    A value ends at a second `: ` inside its field; a missing field is NULL.
    """
    fields = F.split(as_col(c), ";")
    return [
        F.get(F.split(F.get(fields, F.lit(i)), ": "), F.lit(1)).alias(name)
        for i, name in enumerate(names)
    ]


def split_pieces(c: Column | str, pattern: str = PO_SEPARATORS) -> Column:
    return F.split(as_col(c), pattern)


def prefix(c: Column | str, length: int) -> Column:
    return F.substring(as_col(c), 1, length)


def config_code(sku: Column | str) -> Column:
    """A full sample code carries the config code in front; others are one already."""
    c = as_col(sku)
    return F.when(
        F.length(c) == SAMPLE_CODE_LENGTH, prefix(c, CONFIG_CODE_LENGTH)
    ).otherwise(c)


def token_before(c: Column | str, delimiter: str) -> Column:
    return F.substring_index(as_col(c), delimiter, 1)


def date_text(c: Column | str, pattern: str) -> Column:
    return F.date_format(as_col(c), pattern)
