"""Scalar column expressions; everything here stays inside the JVM.

Blank and white space follow Unicode, not only ASCII. Nothing raises under ANSI
mode: text that cannot be read gives null, and the caller decides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: what counts as white space, beyond Unicode's property
SPACE = r"[\s\x1c-\x1f]"


def let(c: Column, then: Callable[[Column], Column]) -> Column:
    """``then(c)`` with ``c`` computed once, however often the result names it."""
    return F.transform(F.array(c), then)[0]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def squeeze(c: Column) -> Column:
    """Trimmed, with every run of white space as one space."""
    return F.regexp_replace(strip(c), rf"(?U){SPACE}+", " ")


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


NUMBER = r"\A([+-]?)(?=\.?[0-9])([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]+))?\z"


def _exponent(exp: Column) -> Column:
    """An exponent too long for a number only matters by its sign."""
    far = F.when(exp.startswith("-"), F.lit(-(10**15))).otherwise(F.lit(10**15))
    return F.when(exp == "", F.lit(0)).otherwise(F.coalesce(exp.try_cast("bigint"), far))


def is_count(c: Column) -> Column:
    """A finite whole number of at least 0, thousands commas dropped; decided on the digits, so length is no limit."""

    def by_digits(t: Column) -> Column:
        digits = F.concat(F.regexp_extract(t, NUMBER, 2), F.regexp_extract(t, NUMBER, 3))
        spare = F.length(F.regexp_extract(digits, r"(0*)\z", 1)) - F.length(F.regexp_extract(t, NUMBER, 3))
        whole = _exponent(F.regexp_extract(t, NUMBER, 4)) + spare >= 0
        return t.rlike(NUMBER) & (digits.rlike(r"\A0*\z") | (whole & ~t.startswith("-")))

    plain = r"\A\+?(?:[0-9]+(?:\.0*)?|\.0+)\z"
    return let(F.regexp_replace(strip(c), ",", ""), lambda t: F.when(t.rlike(plain), F.lit(True)).otherwise(by_digits(t)))


def plain_number(c: Column) -> Column:
    """Canonical text of a number: no sign on zero, no leading or trailing zeros; null for other text."""

    def tidy(t: Column) -> Column:
        cut = F.regexp_replace(F.regexp_replace(t, r"(\.[0-9]*?)0+\z", "$1"), r"\.\z", "")
        return F.regexp_replace(F.regexp_replace(cut, r"\A(-?)0+(?=[0-9])", "$1"), r"\A(-?)\.", "$10.")

    def canonical(t: Column) -> Column:
        zero = t.rlike(r"\A[+-]?[0.]+(?:[eE].*)?\z")
        return (
            F.when(~t.rlike(NUMBER), F.lit(None).cast("string"))
            .when(zero, F.lit("0"))
            .when(t.rlike("[eE]"), F.coalesce(tidy(t.try_cast("decimal(38,12)").cast("string")), F.lower(t)))
            .otherwise(tidy(F.regexp_replace(t, r"\A\+", "")))
        )

    return let(F.regexp_replace(strip(c), ",", ""), canonical)


def calendar_day(c: Column) -> Column:
    """The date of month/day/year (4 or 2 digits), year-month-day or year/month/day text; else null.

    Leading zeros are optional; two digits mean 1969 to 2068.
    """
    us, iso = r"\A([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})\z", r"\A([0-9]{4})([-/])([0-9]{1,2})\2([0-9]{1,2})\z"

    def century(y: Column) -> Column:
        return F.when(F.length(y) == 4, y).when(y >= "69", F.concat(F.lit("19"), y)).otherwise(F.concat(F.lit("20"), y))

    def iso_text(t: Column) -> Column:
        american = F.concat_ws("-", century(F.regexp_extract(t, us, 3)), F.regexp_extract(t, us, 1), F.regexp_extract(t, us, 2))
        return F.when(t.rlike(us), american).when(t.rlike(iso), F.regexp_replace(t, "/", "-"))

    return let(let(strip(c), iso_text), lambda t: F.when(~t.startswith("0000"), t.try_cast("date")))
