"""Clock text and game time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PERIOD_SECONDS = 1200


# Text of one clock: blanks may stand around either number.
_BLANKS = r"[\x00-\x20\x7f]*"
_CLOCK = (rf"^{_BLANKS}(\+?[0-9]+|-0+){_BLANKS}:"
          rf"{_BLANKS}(\+?0*[0-5]?[0-9]|-0+){_BLANKS}\z")


def _minutes(text: Column) -> Column:
    return F.substring_index(text, ":", 1).try_cast("bigint")


def clock_seconds(text: Column) -> Column:
    """Seconds of ``M:SS`` text; NULL for NULL, for text that is no clock and beyond 64 bits."""
    seconds = F.substring_index(text, ":", -1).try_cast("bigint")
    return F.when(
        text.rlike(_CLOCK), F.try_add(F.try_multiply(_minutes(text), F.lit(60)), seconds))


def clock_is_bad(text: Column) -> Column:
    """True for text that is present but is no clock."""
    return F.when(text.rlike(_CLOCK), _minutes(text).isNull()).otherwise(text.isNotNull())


def abs_seconds(period: Column, seconds: Column, period_seconds: int = PERIOD_SECONDS) -> Column:
    """Seconds since the start of the game; NULL if either part is NULL."""
    return (period.cast("bigint") - 1) * period_seconds + seconds


def clock_minutes(text: Column) -> Column:
    """Minutes of clock text, NULL where they are no number."""
    return F.substring_index(text, ":", 1).try_cast("bigint")


def shift_period_type(period: Column) -> Column:
    return F.when(period >= 4, "OT").when(period.isNotNull(), "REG")


def season_start(code: Column) -> Column:
    """20242025 -> 2024."""
    return F.floor(code / 10000).cast("bigint")


def season_code(start_year: Column) -> Column:
    """2024 -> 20242025."""
    return start_year * 10000 + start_year + 1


def season_snapshot(start_year: Column) -> Column:
    """Day on which a season's final standings are read."""
    return F.make_date((start_year + 1).cast("int"), F.lit(4), F.lit(30))
