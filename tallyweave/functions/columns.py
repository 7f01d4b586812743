"""Names, text, money and ranges."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MONEY


def col(name: str) -> Column:
    """The top-level column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_text(name: str, upper: bool = False) -> Column:
    """Text without leading and trailing spaces (tabs stay), in upper case if asked."""
    text = F.upper(col(name)) if upper else col(name)
    return F.trim(text)


def money(name: str, default: int | None = None) -> Column:
    """An amount as decimal(18,2), rounded half up; NULL becomes ``default`` if one is given.

    NaN, infinity and amounts over 16 digits have no such value. They stop the job rather than turn into
    NULL and then zero; the gate finds them beforehand.
    """
    fault = F.concat(F.lit(f"{name} holds an amount that is no money: "), col(name).cast("string"))
    choices = [col(name).cast(MONEY), F.when(col(name).isNotNull(), F.raise_error(fault))]
    if default is not None:
        choices.append(F.lit(default).cast(MONEY))
    return F.coalesce(*choices)


def outside_range(name: str, low=None, high=None) -> Column:
    """True below ``low`` or above ``high``. Without bounds nothing is outside; NULL never is."""
    tests = []
    if low is not None:
        tests.append(col(name) < F.lit(low))
    if high is not None:
        tests.append(col(name) > F.lit(high))
    return reduce(or_, tests) if tests else F.lit(False)
