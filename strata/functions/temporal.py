"""Times, dates, ages and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = 1_000_000


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds (whole or fractional) as a timestamp."""
    return seconds.cast("timestamp")


def parse_timestamp(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text as a timestamp; null where it does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def parse_date(text: Column, pattern: str = "MM/dd/yyyy") -> Column:
    """Text as a date; null where it does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes from start to end, from whole seconds, to two decimals."""
    return F.round((F.unix_seconds(end) - F.unix_seconds(start)) / 60, 2)


def age_in_years(birth: Column, as_of: Column | None = None) -> Column:
    """Completed years between birth and as_of (default: today)."""
    return F.floor(F.months_between(as_of if as_of is not None else F.current_date(), birth) / 12)


# First age of each band and the band's name.
AGE_BANDS = [
    (18, "18-25"),
    (25, "25-35"),
    (35, "35-45"),
    (45, "45-55"),
    (55, "55-65"),
    (65, "65-75"),
    (75, "75-85"),
    (85, "85-95"),
    (95, "95+"),
]
YOUNGEST_BAND = "under 18"
NO_BAND = "invalid age"


def age_band(age: Column) -> Column:
    """Name of the band an age falls into; a null age gets its own name."""
    band = F.when(age.isNull(), NO_BAND)
    for first_age, name in reversed(AGE_BANDS):
        band = band.when(age >= first_age, name)
    return band.otherwise(YOUNGEST_BAND)


def time_slot(ts: Column, seconds: int) -> Column:
    """Start, in epoch micros, of the slot of the given width that holds ts."""
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(seconds * _MICROS))


def next_slot(slot: Column, seconds: int) -> Column:
    return slot + F.lit(seconds * _MICROS)
