"""Lenient text casts: bad text becomes NULL instead of failing the job.

They give what a plain cast gives with ``spark.sql.ansi.enabled=false``, under
either setting, so results do not depend on the session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number with a decimal point, surrounded by blanks or control characters.
# Group 1 is what is left of it after truncation towards zero; it may have no
# digit ('.5', '-.', even '.'), which the built-in cast takes as zero.
_DECIMAL = r"^[\x00-\x20\x7f]*([+-]?[0-9]*)\.[0-9]*[\x00-\x20\x7f]*$"
_NO_DIGITS = ["", "+", "-"]


def text_to_int(text: Column) -> Column:
    """Text to INT, truncating fractions (``'100.7'`` is 100).

    ``try_cast`` alone returns NULL for fractional text. Plain integers, the
    usual case, never reach the regular expression: ``coalesce`` stops first.
    """
    whole = F.regexp_extract(text, _DECIMAL, 1)
    truncated = F.when(whole.isin(_NO_DIGITS), F.lit(0)).otherwise(whole.try_cast("int"))
    return F.coalesce(text.try_cast("int"), F.when(text.rlike(_DECIMAL), truncated))


def text_to_double(text: Column) -> Column:
    return text.try_cast("double")


def text_to_timestamp(text: Column) -> Column:
    """Text to TIMESTAMP; text without a zone is read in the session time zone."""
    return text.try_cast("timestamp")

