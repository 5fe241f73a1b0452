"""Strict number and time parsing as column expressions.

The plain casts of the SQL engine are more lenient than the feeds allow (exponents, padded
integers), so every text is matched against its grammar before it is cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import AMOUNT, MAX_EPOCH_MS, MIN_EPOCH_MS

_SPACE = r"[\t-\r ]*"
_DIGITS = r"(?:[0-9][0-9,]*(?:\.[0-9]*)?|\.[0-9]+)"
PLAIN_NUMBER = r"\A[+-]?[0-9]+(?:\.[0-9]*)?\z"
NUMBER = rf"\A{_SPACE}(?:[+-]?{_DIGITS}|{_DIGITS}{_SPACE}[+-]){_SPACE}\x00*\z"
INTEGER = r"\A[+-]?[0-9]+\z"


def number_grammar(text: Column) -> Column:
    """Outer whitespace, thousands commas and one leading or trailing sign; no exponent."""
    return F.coalesce(text.rlike(PLAIN_NUMBER) | text.rlike(NUMBER), F.lit(False))


def strict_decimal(text: Column) -> Column:
    """DECIMAL(38,18), or NULL when the text breaks the grammar or does not fit."""
    bare = F.regexp_replace(text, r"[\t-\r ,\x00]", "")
    sign_first = F.regexp_replace(bare, r"\A([^+-]+)([+-])\z", "$2$1")
    return (
        F.when(text.rlike(PLAIN_NUMBER), text)
        .when(text.rlike(NUMBER), sign_first)
        .try_cast(AMOUNT)
    )


def strict_bigint(text: Column) -> Column:
    """BIGINT when the whole text is an integer that fits, else NULL."""
    return F.when(text.rlike(INTEGER), text).try_cast("bigint")


def exact_epoch_ms(epoch_ms: Column, seconds_text: Column) -> Column:
    """Epoch milliseconds with fractions, from whole milliseconds or else from a text of seconds.

    Seconds are first held in DECIMAL(30,18), so that the product stays exact; a text with more than
    twelve integer digits is far outside the storable range and gives NULL.
    """
    from_seconds = strict_decimal(seconds_text).try_cast("decimal(30,18)") * F.lit(1000)
    return F.coalesce(epoch_ms.cast("decimal(37,18)"), from_seconds.cast("decimal(37,18)"))


def epoch_ms_in_range(ms: Column) -> Column:
    return F.coalesce(ms.between(F.lit(MIN_EPOCH_MS), F.lit(MAX_EPOCH_MS)), F.lit(False))


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Instant for epoch milliseconds, fractions cut toward zero; NULL outside the storable range."""
    return F.when(epoch_ms_in_range(ms), F.timestamp_millis(ms.cast("bigint")))


def slot_of(t: Column, width: int) -> Column:
    """Number of the slot of `width` units that holds t; slots start at multiples since the epoch."""
    return ((t - F.pmod(t, F.lit(width))) / F.lit(width)).cast("bigint")
