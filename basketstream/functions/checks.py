"""Reusable rule expressions: first failing rule, or all failing rules."""

from functools import reduce

from pyspark.sql import Column, functions as F

from basketstream import fixed_values as fixed
from basketstream.functions.times import source_time


def first_failure(rules) -> Column:
    """Code of the first rule whose failing condition is true, else null."""
    return F.coalesce(*[F.when(failing, F.lit(code)) for code, failing in rules])


def failing_codes(rules) -> Column:
    """Codes of every rule whose failing condition is true, in rule order."""
    return F.array_compact(F.array(*[F.when(failing, F.lit(code)) for code, failing in rules]))


def no_codes() -> Column:
    return F.array_compact(F.array(F.lit(None).cast("string")))


def all_failures(rules) -> Column:
    """``failing_codes`` where nearly all rows break no rule: whether one is broken is compiled code, the list is not."""
    return F.when(any_failure(rules), failing_codes(rules)).otherwise(no_codes())


def any_failure(rules) -> Column:
    """Whether any rule's failing condition is true; never null."""
    return reduce(lambda a, b: a | b, [F.coalesce(failing, F.lit(False)) for _, failing in rules])


def null_or(value: Column, failing: Column) -> Column:
    return value.isNull() | failing


# The functions below give an error text or null, so that coalesce() over them
# keeps the first one.


def integer_error(value: Column, name: str) -> Column:
    return F.when(value.isNull(), F.lit(name + fixed.MSG_NOT_INTEGER)).when(
        value < 0, F.lit(name + fixed.MSG_NEGATIVE)
    )


def string_error(value: Column, name: str) -> Column:
    return F.when(value.isNull(), F.lit(name + fixed.MSG_NOT_STRING))


def event_time_error(text: Column) -> Column:
    canonical = text.rlike(fixed.SOURCE_TIME_PATTERN) & (F.length(text) == 19)
    return F.coalesce(
        string_error(text, "timestamp"),
        F.when(~canonical, F.lit(fixed.MSG_TIME_FORMAT)),
        F.when(source_time(text).isNull(), F.lit(fixed.MSG_TIME_CALENDAR)),
    )


def vector_error(text: Column, name: str, message: str) -> Column:
    bracketed = text.startswith("[") & text.endswith("]")
    return F.coalesce(string_error(text, name), F.when(~bracketed, F.lit(message)))
