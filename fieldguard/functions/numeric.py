"""Text cells to numbers, and the missing-value vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that a CSV round trip turns into "missing".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Texts that a column of booleans may hold.
BOOL_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")


def present(value: Column, na_tokens: Sequence[str] = NA_TOKENS) -> Column:
    """The cell, or NULL when it holds one of the missing-value texts."""
    if not na_tokens:
        return value
    return F.when(~value.isin(*na_tokens), value)


def parse_number(value: Column) -> Column:
    """DOUBLE of a text cell, NULL where it is not a number; NaN counts as missing.

    The cast alone also takes Java's type suffixes (``1d``, ``1f``) and hexadecimal floats, so
    those are cut off first without a regular expression.
    """
    text = F.lower(F.trim(value))
    last = F.right(text, F.lit(1))
    foreign = text.contains("x") | (last.isin("d", "f") & ~text.endswith("inf"))
    number = F.when(~foreign, value).try_cast("double")
    return F.when(~F.isnan(number), number)


def bool_number(value: Column) -> Column:
    """1.0 / 0.0 for a boolean text, NULL otherwise."""
    return F.when(value.isin(*BOOL_TOKENS), F.when(F.lower(value) == "true", 1.0).otherwise(0.0))


def has_content(value: Column, na_tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Presence test of a non-numeric cell: not missing, not blank, not "nan"."""
    return F.coalesce(
        present(value, na_tokens).isNotNull()
        & (F.trim(value) != "")
        & (F.lower(value) != "nan"),
        F.lit(False),
    )
