"""Numeric, date and array functions as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from start to end, rounded down."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000.0)).cast("long")


def grade(mark: Column) -> Column:
    """Letter for a mark of 0 to 100; anything else has none."""
    return (
        F.when((mark < 0) | (mark > 100), F.lit(None))
        .when(mark >= 90, "A").when(mark >= 80, "B").when(mark >= 60, "C")
        .when(mark >= 40, "D").when(mark >= 0, "F")
    )


def parity_adjust(n: Column) -> Column:
    """Odd: 10 away from zero. Even: times 10.5, or divided by 10.3 when negative."""
    odd = F.abs(n) % 2 == 1
    return (
        F.when(n > 0, F.when(odd, n + 10).otherwise(n * 10.5))
        .when(n < 0, F.when(odd, n - 10).otherwise(n / 10.3))
        .otherwise(n)
        .cast("double")
    )


# Account rules: minimum amount and yearly rate in percent (fixed values).
ACCOUNT_RULES = {"Saving": (10_000, 6.0), "Current": (5_000, None)}


def simple_interest(kind: Column, amount: Column, months: Column) -> Column:
    """Struct (eligible, interest, reason) of an account under ``ACCOUNT_RULES``."""
    eligible, interest, reason = F.lit(False), F.lit(None).cast("double"), F.lit("unknown account type")
    for name, (minimum, rate) in ACCOUNT_RULES.items():
        enough = amount >= minimum
        earned = F.when(enough, amount * rate * months / 1200) if rate is not None else F.lit(None)
        eligible = F.when(kind == name, enough).otherwise(eligible)
        interest = F.when(kind == name, earned).otherwise(interest)
        reason = F.when(
            kind == name, F.when(enough, F.lit("ok")).otherwise(F.lit(f"minimum is {minimum}"))
        ).otherwise(reason)
    return F.struct(eligible.alias("eligible"), interest.alias("interest"), reason.alias("reason"))


def safe_divide(a: Column, b: Column) -> Column:
    """Struct (value, error): null and a message where the division is undefined."""
    return F.struct(
        F.try_divide(a, b).alias("value"), F.when(b == 0, F.lit("division by zero")).alias("error")
    )


def safe_int(text: Column) -> Column:
    """Struct (value, error) of reading text as a whole number of up to 38 digits."""
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)\s*$", 1)
    value = digits.try_cast("decimal(38,0)")
    return F.struct(
        value.alias("value"),
        F.when(value.isNotNull() | text.isNull(), F.lit(None)).when(digits == "", F.lit("not a whole number"))
        .otherwise(F.lit("too many digits")).alias("error"),
    )


def identity_matrix(n: int) -> Column:
    """n × n nested array with ones on the diagonal."""
    index = F.sequence(F.lit(1), F.lit(n))
    return F.transform(index, lambda i: F.transform(index, lambda j: (i == j).cast("double")))


def combine_lists(lists: Sequence[Column]) -> Column:
    """Combine by how many lists there are: the list itself, largest plus smallest
    of two, the sum of three, and from four on all squares followed by all odd values."""
    flat = F.flatten(F.array(*lists))
    if len(lists) == 1:
        return lists[0]
    if len(lists) == 2:
        return F.array(F.array_max(flat) + F.array_min(flat))
    if len(lists) == 3:
        return F.array(F.aggregate(flat, F.lit(0).cast("long"), lambda a, x: a + x))
    return F.concat(F.transform(flat, lambda x: x * x), F.filter(flat, lambda x: x % 2 != 0))
