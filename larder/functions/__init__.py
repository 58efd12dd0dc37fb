"""Column expressions: text standardising, tolerant casts, ratios, rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space around a text, and as a line end.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_ENDS = "\n\r\v\f\x1c\x1d\x1e\x85\u2028\u2029"


def collapse_spaces(text: Column) -> Column:
    """Every run of white space becomes one space, none at either end."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normal_text(text: Column) -> Column:
    """Collapsed and lower-cased."""
    return F.lower(collapse_spaces(text))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def number_or_null(value: Column) -> Column:
    """The value as a double, null where it is not a number."""
    return value.try_cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def rounded(value: Column, places: int) -> Column:
    """The nearest double with ``places`` decimals.

    Decided by the exact value of the double, not by a scaled one: 2.675 is a little
    less than its digits say and gives 2.67.  Exact halves go to the even digit.
    """
    x, scale = value.cast("double"), float(10**places)
    scaled = x * scale
    near = F.rint(scaled)
    # the product's own rounding error, exactly: x in two halves of 26 bits
    wide = x * float(2**27 + 1)
    high = wide - (wide - x)
    error = (high * scale - scaled) + (x - high) * scale
    # it decides where the product looks like a half
    off = scaled - near
    settled = (
        F.when((off == 0.5) & (error > 0), near + 1)
        .when((off == -0.5) & (error < 0), near - 1)
        .otherwise(near)
    )
    whole = F.abs(x) >= float(2**52)  # has no decimals to round
    return F.when(whole, x).otherwise(settled / scale)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return rounded(ratio(part, whole) * 100.0, places)


def ended_lines(text: Column) -> Column:
    """The text with ``\\n`` for every kind of line end, the last line ended too."""
    other_ends = "\r\n|[" + LINE_ENDS.replace("\n", "") + "]"
    # an empty text has no line to end: its last character, "", counts as contained
    ended = F.contains(F.lit(LINE_ENDS), F.right(text, F.lit(1)))
    return F.concat(
        F.regexp_replace(text, other_ends, "\n"), F.when(ended, "").otherwise("\n")
    )
