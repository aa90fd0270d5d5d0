"""Expressions that decode worksheet text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barograph import fixed
from barograph.schema import CHANNEL

# Casts from text are lax where these guards are strict: a cast to DOUBLE takes "12d" and
# "inf", one to TIMESTAMP_NTZ drops a time zone.
NUMBER_CHARACTERS = r"^[0-9eE+.\s-]+$"
WHOLE_SECONDS = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"

# English month names, of which three letters are enough.
MONTH_NAMES = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"

# All forms in one pattern, with groups of its own for the year, month and day of each: year first; month, day, year; where
# that is no month, day, month, year; month's name first or second. Of a name the group holds three letters. Then come the
# clock, of which AM or PM leaves its first letter, and a time zone. The last branch leaves nothing of other texts.
NAMED = rf"(?=(?:{MONTH_NAMES})(?![a-z]))([a-z]{{3}})[a-z]*\.?"
MONTH = r"(0?[1-9]|1[0-2])"
TIME = (
    r"(?is)^(?:\s*(?:(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"
    rf"|{MONTH}[-/.](\d{{1,2}})[-/.](\d{{4}})"
    rf"|(\d{{1,2}})[-/.]{MONTH}[-/.](\d{{4}})"
    rf"|{NAMED}\s+(\d{{1,2}}),?\s+(\d{{4}})"
    rf"|(\d{{1,2}})(?:-|\s+){NAMED}[-\s,]+(\d{{4}}))"
    r"(?:(?:\s+|t)(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d+)?)?)(?:\s?([ap])\.?m\.?)?(?:\s?(?:z|utc|gmt|[-+]\d{2}:?(?:\d{2})?))?)?\s*|.*)$"
)
YEAR_FIRST = "$1$6$9$12$15-$2$4$8$10$14-$3$5$7$11$13 $16$17"
COMPACT = r"(?i)^\s*(\d{4})(\d{2})(\d{2})(?:\s+|t)?(\d{2})(\d{2})(\d{2})\s*$"

# Decimal texts of up to 15 digits are the same number read as decimal or as double.
EXACT_LENGTH = 16


def present(cell: Column) -> Column:
    """The cell's text, or NULL where it reads as missing."""
    return F.when(~cell.isin(fixed.MISSING_TEXTS), cell)


def channel_value(text: Column) -> Column:
    """Stored channel: the number as a double, rounded half up to two decimals; NULL where
    the text is no plain decimal number or its value is out of range.

    Short texts, that is nearly all, go straight to DECIMAL. Only the long ones that a
    spreadsheet writes for some values (25.344999999999999) need the double in between.
    """
    as_double = F.when(text.rlike(NUMBER_CHARACTERS), text.try_cast("double"))
    return F.when(F.length(text) <= EXACT_LENGTH, text.try_cast(CHANNEL)).otherwise(as_double.try_cast(CHANNEL))


def year_first(text: Column) -> Column:
    """`Y-M-D H:M:S` of a time in any form, as far as it has them, with `a` or `p` at the end for AM or PM; a month may still
    be the start of its name."""
    spaced = F.when(F.contains(text, F.lit(":")), text).otherwise(F.regexp_replace(text, COMPACT, "$1-$2-$3 $4:$5:$6"))
    return F.regexp_replace(spaced, TIME, YEAR_FIRST)


def in_numbers(found: Column) -> Column:
    """The same with the number of a named month."""
    number = F.ceil(F.position(F.lower(F.substring(found, 6, 3)), F.lit(MONTH_STARTS)) / 3).cast("string")
    named = F.concat(F.substring(found, 1, 5), number, F.substring(found, 9, 100))
    return F.when(F.substring(found, 6, 1) >= "A", named).otherwise(found)


def nearest_second(found: Column) -> Column:
    """The time of such a text, or NULL."""

    def rounded(text: Column) -> Column:
        whole = F.substring_index(text, ".", 1).try_cast("timestamp_ntz")
        up = F.when(text.rlike(r"\.[5-9]"), whole + F.expr("INTERVAL '1' SECOND")).otherwise(whole)
        return F.when(F.contains(text, F.lit(".")), up).otherwise(text.try_cast("timestamp_ntz"))

    letter = F.substring(found, -1, 1)
    of_half = rounded(F.replace(F.left(found, F.length(found) - 1), F.lit(" 12:"), F.lit(" 0:")))
    later = F.when(F.lower(letter) == "p", of_half + F.expr("INTERVAL '12' HOUR")).otherwise(of_half)
    return F.when(letter >= "A", F.when(found.rlike(" (?:1[0-2]|0?[1-9]):"), later)).otherwise(rounded(found))


def sample_time(text: Column) -> Column:
    """TIMESTAMP_NTZ at the nearest second, or NULL where the text is not a time.

    The logger's own form comes first. Others: dates in numbers, year first or last, with
    ``-``, ``/`` or ``.``; year-last dates are month first unless that is no month. English
    month names before or after the day. The clock and its seconds may be left out; it may
    have AM or PM. A time zone is passed over: the clock counts as it is written. Date and
    clock may also come as digits only.

    Any other form is first written year first, by one replacement for all of them. An array of one element holds
    that text, since an expression that is used more than once within a condition would be computed each time.
    """
    other = F.transform(F.transform(F.array(year_first(text)), in_numbers), nearest_second)
    return F.when(text.rlike(WHOLE_SECONDS), text.try_cast("timestamp_ntz")).otherwise(F.get(other, F.lit(0)))
