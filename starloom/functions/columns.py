"""Reusable column expressions.  All of them stay inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sums and means of doubles depend on the order in which tasks finish.  So a double is
# taken for the shortest decimal that stands for it and added in whole numbers, whose sums
# are exact in any order: multiples of 2^30, the rest of the whole part, and the fraction
# in units of 1/PLACES.  Other values (more than four places, or from MOST_PLACED on) go
# through a decimal, from which multiples of 2^30 are taken first.
UNIT_BITS = 30
UNIT = float(1 << UNIT_BITS)
PLACES = 10_000.0
MOST_PLACED = 9e11
LARGEST = float(1 << 84)
EXACT = "decimal(38,18)"

# The column in which a CSV reader keeps, by column name, text that did not parse.
UNPARSED = "unparsed_text"

# Label, first hour, last hour (both inclusive).  Any other hour,
# and a missing hour, is "Night".
DAY_PARTS = (
    ("Morning", 6, 11),
    ("Afternoon", 12, 17),
    ("Evening", 18, 21),
)
OTHER_DAY_PART = "Night"


def timestamp(name: str) -> Column:
    """Parse a timestamp without zone; text that is no timestamp gives NULL."""
    return F.col(name).try_cast("timestamp_ntz")


def number(name: str) -> Column:
    """Read a double from any column type; text that is no number gives NULL."""
    return F.col(name).try_cast("double")


def not_read(df: DataFrame, name: str) -> Column:
    """True where a column to be read as a number holds text that is none; never NULL."""
    blank = F.trim(F.col(name).cast("string")) == ""
    bad = F.col(name).isNotNull() & ~blank & number(name).isNull()
    if UNPARSED in df.columns:
        bad = bad | F.coalesce(F.map_contains_key(UNPARSED, name), F.lit(False))
    return bad


def whole_number(name: str) -> Column:
    """Read an integer from any column type; what is no whole number gives NULL."""
    value = F.col(name).try_cast("double")
    return F.when(value == F.floor(value), value.try_cast("int"))


def lower_trimmed(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def upper_trimmed(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def zip_label(name: str) -> Column:
    """Zip for display, zero-padded to five characters; a longer one stays whole."""
    text = F.col(name).cast("string")
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text)


def day_part(hour: Column) -> Column:
    label = F.lit(OTHER_DAY_PART)
    for name, first, last in reversed(DAY_PARTS):
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label


def days_between(start: str, end: str) -> Column:
    """Calendar days from start to end, as a double; NULL if either is missing."""
    return F.datediff(F.col(end), F.col(start)).cast("double")


def null_if_not_positive(value: Column) -> Column:
    return F.when(value <= 0, F.lit(None)).otherwise(value)


def at_least(value: Column, floor: float) -> Column:
    """Raise values below ``floor`` to it, and leave NULL as it is."""
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def has_text(name: str) -> Column:
    """True for text with something other than spaces; never NULL."""
    return F.coalesce(F.length(F.trim(F.col(name))) > 0, F.lit(False))


def sentiment(score: Column) -> Column:
    return (
        F.when(score >= 4, "positive").when(score == 3, "neutral").otherwise("negative")
    )


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows; NULL if there is none.

    What is added are the decimals that the doubles print as, up to the eighteenth place
    (from 2^30 on, those with more than four places lose what a double's rest does not
    hold); the total is rounded to a double once.  NaN and infinity show in the sum, as they
    do in a plain one, and so do values from 2^84 (2e25) on, which are added as doubles.
    """
    x = value.cast("double")
    fits = F.abs(x) < LARGEST
    placed = F.rint(x * PLACES)
    short = (F.abs(x) < MOST_PLACED) & (placed / PLACES == x)
    whole = F.when(short, x).cast("bigint")
    units = F.when(short, F.shiftright(whole, UNIT_BITS)).when(fits, (x * (1 / UNIT)).cast("bigint"))
    ones = F.sum(whole.bitwiseAND(F.lit((1 << UNIT_BITS) - 1)))
    places = F.sum(F.when(short, placed - whole * PLACES).cast("bigint"))
    rest = F.sum(F.when(fits & ~short, x - units * UNIT).cast(EXACT))
    other = F.sum(F.when(~fits, x))
    exact = _joined(F.sum(units), ones, places, rest)
    return F.coalesce(exact + other, exact, other)


def _joined(units: Column, ones: Column, places: Column, rest: Column) -> Column:
    """The double next to a sum in parts; NULL without ``units``."""
    none = F.lit(0).cast("bigint")
    whole = units.cast("decimal(20,0)") * F.lit(1 << UNIT_BITS) + F.coalesce(ones, none)
    below = F.coalesce(places, none).cast("decimal(20,0)") / F.lit(int(PLACES)).cast("decimal(5,0)")
    below = below.cast(EXACT) + F.coalesce(rest, F.lit(0).cast(EXACT))
    # Eighteen places fit beside a whole part of so many digits.
    small = F.abs(whole) < F.lit(10**18)
    return F.when(small, (F.when(small, whole).cast(EXACT) + below).cast("double")).otherwise(
        whole.cast("double") + below.cast("double")
    )


def exact_mean(value: Column) -> Column:
    """Mean whose last digits do not depend on the order of the rows."""
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def mean_coordinate(name: str) -> Column:
    """Mean latitude or longitude; NaN shows in it, text that is no number is left out."""
    return exact_mean(number(name))


def rounded(value: Column, digits: int) -> Column:
    return F.round(value, digits).cast("double")
