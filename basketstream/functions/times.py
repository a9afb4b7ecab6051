"""The two clocks: zone-free source time and UTC processing time."""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

from basketstream.fixed_values import PUBLISHED_FORMAT, SOURCE_TIME_FORMAT, SOURCE_TIME_PATTERN

_TEXT_FORMAT = "%Y-%m-%d %H:%M:%S"
_PUBLISHED_UTC = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def source_time(text: Column) -> Column:
    """Strict parse of source time text; anything not canonical becomes null."""
    quick = _plain_time(text, SOURCE_TIME_PATTERN, 19)
    return F.when(quick, text.try_cast("timestamp_ntz")).otherwise(F.try_to_timestamp(text, F.lit(SOURCE_TIME_FORMAT)).cast("timestamp_ntz"))


def _plain_time(text: Column, pattern: str, length: int) -> Column:
    """Text of the usual form, which a cast reads as the pattern does and several times faster; only the year 0 is read by the cast alone."""
    return text.rlike(pattern) & (F.length(text) == length) & ~text.startswith("0000")


def source_time_or_fail(text: Column) -> Column:
    """Strict parse that fails the job on a non-null value that cannot be read."""
    parsed = source_time(text)
    problem = F.concat(F.lit("Unreadable source timestamp: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(problem)).otherwise(parsed)


def published_time(text: Column) -> Column:
    quick = _plain_time(text, _PUBLISHED_UTC, 20)
    return F.when(quick, text.try_cast("timestamp")).otherwise(F.try_to_timestamp(text, F.lit(PUBLISHED_FORMAT)))


def utc_text(instant: Column) -> Column:
    """Instant as UTC text with seconds precision (session zone is UTC)."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_literal(instant: datetime) -> Column:
    """A zone-aware Python instant as UTC text; a naive one is refused."""
    if instant.tzinfo is None:
        raise ValueError("published_at needs a time zone")
    seconds = int(instant.timestamp() // 1)
    return utc_text(F.timestamp_seconds(F.lit(seconds)))


def hours_between(start: Column, end: Column) -> Column:
    """Hours from ``start`` to ``end`` (zone-free values), exact to the microsecond."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return micros.cast("double") / F.lit(3.6e9)


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def as_date(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def day_bounds(day) -> tuple[str, str]:
    """Half-open text bounds of one source day."""
    start = as_date(day)
    return f"{start} 00:00:00", f"{start + timedelta(days=1)} 00:00:00"


def check_window(start: str, end: str) -> None:
    """Both bounds canonical and increasing, else ValueError."""
    for bound in (start, end):
        if datetime.strptime(bound, _TEXT_FORMAT).strftime(_TEXT_FORMAT) != bound:
            raise ValueError(f"Window bound is not canonical: {bound}")
    if not start < end:
        raise ValueError("Window start must lie before its end")
