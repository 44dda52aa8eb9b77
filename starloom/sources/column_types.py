"""Types of columns that nobody has named, found while the rows pass by.

Every text is given the narrowest kind that it fits, as one bit, and a column's kinds are
the bits of its texts, joined by OR: tasks join their parts in any order, one aggregate
serves all columns, and it can ride along with a write as an observed metric, so that the
text is read once.  From its kinds a column gets the narrowest type that holds them all:

    int < bigint < decimal(n, 0) < double,    date < timestamp_ntz,    boolean,    string

A column without any text stays text, as does one that mixes branches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The shapes of text that are read as each type.
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
NOT_FINITE = ("NaN", "Inf", "-Inf", "Infinity", "-Infinity")
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?$"
BOOLEANS = ("true", "false")

MOST_DIGITS = 38

KINDS = ("int", "bigint", "decimal", "double", "date", "timestamp_ntz", "boolean", "string")
NUMBERS, TIMES = KINDS[:4], KINDS[4:6]


def _digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "^[+-]?0*", ""))


def _kind(text: Column) -> Column:
    """The narrowest kind that a text fits, as a bit; NULL for no text."""
    whole = (
        F.when(text.try_cast("int").isNotNull(), "int")
        .when(text.try_cast("bigint").isNotNull(), "bigint")
        .when(_digits(text) <= MOST_DIGITS, "decimal")
        .otherwise("double")
    )
    name = (
        F.when(text.rlike(WHOLE), whole)
        .when(text.rlike(NUMBER) | text.isin(*NOT_FINITE), "double")
        .when(text.rlike(DATE) & text.try_cast("date").isNotNull(), "date")
        .when(text.rlike(TIME) & text.try_cast("timestamp_ntz").isNotNull(), "timestamp_ntz")
        .when(F.lower(text).isin(*BOOLEANS), "boolean")
        .otherwise("string")
    )
    bits = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, 1 << i)])
    return F.when(text.isNotNull(), F.element_at(bits, name))


def tallies(columns: Sequence[str], among: Column | None = None) -> list[Column]:
    """Two aggregates for each column of text, over the rows where ``among`` holds."""
    out = []
    for i, name in enumerate(columns):
        text = F.nullif(F.col(f"`{name}`"), F.lit(""))
        if among is not None:
            text = F.when(among, text)
        digits = F.when(text.rlike(WHOLE), _digits(text))
        out += [F.bit_or(_kind(text)).alias(f"{i}:kinds"), F.max(digits).alias(f"{i}:digits")]
    return out


def narrowest(columns: Sequence[str], found: Mapping[str, int | None]) -> dict[str, str]:
    """The type of every column that is not text, from its tallies."""
    types = {}
    for i, name in enumerate(columns):
        bits = found[f"{i}:kinds"] or 0
        kinds = {k for place, k in enumerate(KINDS) if bits >> place & 1}
        for branch in (NUMBERS, TIMES, ("boolean",)):
            if kinds and kinds <= set(branch):
                types[name] = max(kinds, key=branch.index)
        if types.get(name) == "decimal":
            types[name] = f"decimal({found[f'{i}:digits']},0)"
    return types


def infer_types(
    text: DataFrame, columns: Sequence[str], among: Column | None = None
) -> dict[str, str]:
    """The types of ``columns``, by one aggregate over the rows."""
    if not columns:
        return {}
    return narrowest(columns, text.agg(*tallies(columns, among)).first().asDict())


class TypesOnTheWay:
    """Types found while ``rows`` are written; ask for them once the write is done."""

    def __init__(self, text: DataFrame, columns: Sequence[str], among: Column | None = None):
        self.columns = list(columns)
        self._seen = Observation("column types") if self.columns else None
        self.rows = text.observe(self._seen, *tallies(columns, among)) if self.columns else text

    def types(self) -> dict[str, str]:
        return narrowest(self.columns, self._seen.get) if self.columns else {}
