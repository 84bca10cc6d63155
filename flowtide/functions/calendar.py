"""Column expressions over timestamps. All stay in generated JVM code."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowtide.constants import DATE_ORIGIN, DATE_SPAN_DAYS, RUSH_HOURS, SLOT_MINUTES


def parse_timestamp(text: Column | str, strict: bool = True) -> Column:
    """Text with or without a fraction or a zone suffix, as a zone-free timestamp.

    ``strict`` fails the job on text that is no timestamp; otherwise it is NULL.
    """
    column = F.col(text) if isinstance(text, str) else text
    return column.cast("timestamp_ntz") if strict else column.try_cast("timestamp_ntz")


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def without_zone(instant: Column | str) -> Column:
    """The UTC wall clock of a zoned timestamp, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def as_utc_instant(time: Column | str) -> Column:
    """Inverse of :func:`without_zone`; stream watermarks need a zoned timestamp."""
    time = F.col(time) if isinstance(time, str) else time
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), time))


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def slot(time: Column | str, slot_minutes: int = SLOT_MINUTES) -> Column:
    """Start of the slot that holds ``time``."""
    return F.window(time, f"{slot_minutes} minutes")["start"]


def floor_day(time: Column | str) -> Column:
    # to_date and back: date_trunc would return a zoned timestamp
    return F.to_date(time).cast("timestamp_ntz")


def ceil_day(time: Column) -> Column:
    """Next midnight, or ``time`` itself when it is a midnight."""
    day = floor_day(time)
    return F.when(time == day, day).otherwise(day + F.expr("INTERVAL 1 DAY"))


def clock_hours(time: Column | str) -> Column:
    """Hours since midnight with whole seconds; fractions of a second are cut."""
    return F.hour(time) + F.minute(time) / F.lit(60.0) + F.second(time) / F.lit(3600.0)


def slot_hours(time: Column | str) -> Column:
    """Hours since midnight of a slot start."""
    return F.hour(time) + F.minute(time) / F.lit(60.0)


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes between two timestamps, to the microsecond."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(6e7)


def monday_based_weekday(time: Column | str) -> Column:
    return F.weekday(time)


def is_rush_hour(hour: Column, closed: bool = True) -> Column:
    """1 within the rush hours. ``closed`` counts the end of each range too."""
    flag = F.lit(False)
    for first, last in RUSH_HOURS:
        upper = (hour <= last) if closed else (hour < last)
        flag = flag | ((hour >= first) & upper)
    return flag.cast("int")


def scaled_date(time: Column | str) -> Column:
    """Days since the origin over the days of its year: 0.0 up to 1.0 a year on."""
    return F.datediff(F.to_date(time), F.lit(DATE_ORIGIN).cast("date")) / F.lit(DATE_SPAN_DAYS)


def day_of_scaled_date(date: Column | str) -> Column:
    """Inverse of :func:`scaled_date`."""
    date = F.col(date) if isinstance(date, str) else date
    days = F.round(date * F.lit(DATE_SPAN_DAYS)).cast("int")
    return F.date_add(F.lit(DATE_ORIGIN).cast("date"), days)
