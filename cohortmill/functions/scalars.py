"""Scalar column functions used by the cleaning and feature operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def named(name: str) -> Column:
    """Column by exact name, also when the name itself contains dots."""
    return F.col("`" + name.replace("`", "``") + "`")


# The character after "9".  Whatever a cast trims or accepts at either end of an integer
# (control characters, blanks, signs, digits) sorts before it, except DEL.
_AFTER_DIGITS = ":"
_DELETE = "\x7f"
# Letters that may end a double: type suffixes, and the words for NaN and infinity.
_DOUBLE_ENDINGS = ("d", "D", "f", "F", "n", "N", "y", "Y")


def _starts_like_number(column: Column) -> Column:
    """Comparing the whole text decides at its first byte and copies nothing."""
    return ((column < _AFTER_DIGITS) & (column != "")) | column.startswith(_DELETE)


def _ends_like_number(column: Column, *letters: str) -> Column:
    last = F.substring(column, -1, 1)
    return (last < _AFTER_DIGITS) | last.isin(_DELETE, *letters)


def int_key(column: Column, is_text: bool = True, kind: str = "int") -> Column:
    """Integer key of type ``kind``; NULL where the text is not such an integer.

    A failing ``try_cast`` raises and catches an exception per row, some hundred
    times the cost of a cast that succeeds.  Text that cannot be a number by its
    first or last character never reaches the cast.
    """
    cast = column.try_cast(kind)
    if not is_text:
        return cast
    return F.when(_starts_like_number(column) & _ends_like_number(column), cast)


def number(column: Column, is_text: bool = True) -> Column:
    """Double; NULL where the text is not a number.  Guarded like ``int_key``."""
    cast = column.try_cast("double")
    if not is_text:
        return cast
    special = F.lower(F.substring(column, 1, 3)).isin("nan", "inf")
    plausible = (_starts_like_number(column) | special) & _ends_like_number(
        column, *_DOUBLE_ENDINGS
    )
    return F.when(plausible, cast)


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def truth_flag(column: Column, true_word: str) -> Column:
    """1 where the text equals ``true_word`` in any case, 0 everywhere else, NULL included."""
    return F.coalesce((F.lower(column) == true_word.lower()).cast("int"), F.lit(0))


def log_scale(column: Column, floor: float | None = None) -> Column:
    """ln(1 + x).  ``floor`` lifts smaller values first, as ln(1 + x) is NULL from -1 down."""
    return F.log1p(column if floor is None else F.greatest(column, F.lit(floor)))


def rounded_mean(mean: Column, digits: int = 2) -> Column:
    """A mean rounded the same way on every run.

    The last bits of a sum of doubles depend on the order in which tasks finish; at
    a tie such as 23.195 they would decide the result.  Nine digits settle them.
    """
    return F.round(F.round(mean, 9), digits)


def contains_any(column: Column, words: Iterable[str]) -> Column:
    """True where the text contains any of the words, ignoring case."""
    text = F.lower(column)
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word.lower())
    return F.coalesce(hit, F.lit(False))


def magnitude_text(value: Column, unit: Column) -> Column:
    """Number as a chart caption: thousands without decimals, else one decimal, small money with two.

    Only captions above a thousand have a thousands mark.
    """

    def plain(digits: int) -> Column:
        return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))

    return (
        F.when(value > 1000, F.format_number(value, 0))
        .when(value > 10, plain(1))
        .when(unit == "$", F.concat(F.lit("$"), plain(2)))
        .otherwise(plain(1))
    )
