"""Derived metrics: percents, differences from a baseline, severity categories, query ids."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity categories and the percents that bound them.
UNDER_5 = "lessThan5Percent"
FROM_5_TO_9 = "5to9percent"
FROM_10_TO_15 = "10to15percent"
OVER_15 = "GreaterThan15Percent"

# Category of a day that has no baseline to compare with.
NO_BASELINE = "noBaseline"

# An id holds when a run started (in 128ths of a second from the epoch on), the check, and the row's number.
# 39 bits of time last until the year 2106.
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
_PER_SECOND = 128
_TIME_BITS, _CHECK_BITS, _ROW_BITS = 39, 2, 22


def improper_percent(improper: Column, total: Column) -> Column:
    """Unrounded share of improper rows in percent; NULL for an empty day."""
    return F.try_divide(improper * F.lit(100.0), total)


def rounded_percent(improper: Column, total: Column) -> Column:
    """The same share rounded half-up to two decimals, by exact integer arithmetic."""
    doubled = improper * F.lit(20000) + total
    hundredths = F.call_function("div", doubled, F.nullif(total * F.lit(2), F.lit(0).cast("long")))
    return hundredths / F.lit(100.0)


def percent_difference(value: Column, baseline: Column) -> Column:
    """Difference from the baseline in percent, cut toward zero; NULL without a baseline."""
    percent = (value - baseline) / baseline * F.lit(100.0)
    return F.when(baseline > 0, F.when(percent < 0, F.ceil(percent)).otherwise(F.floor(percent)))


def category(percent: Column) -> Column:
    """Severity of a percent by its size; NULL and NaN count as the worst."""
    size = F.abs(percent)
    return (
        F.when(size < 5, UNDER_5)
        .when(size < 10, FROM_5_TO_9)
        .when(size <= 15, FROM_10_TO_15)
        .otherwise(OVER_15)
    )


def drift_category(difference: Column) -> Column:
    """Severity of a baseline difference, where NULL means there was no baseline."""
    return F.when(difference.isNull(), NO_BASELINE).otherwise(category(difference))


@dataclass(frozen=True)
class Run:
    """When a check ran. One log date and one id prefix hold for all rows of the run."""

    started: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc))

    @property
    def log_date(self) -> int:
        return int(self.started.strftime("%Y%m%d"))

    @property
    def log_time(self) -> int:
        return int(self.started.strftime("%Y%m%d%H%M%S"))

    def _prefix(self, check: int) -> int:
        if not 0 <= check < 1 << _CHECK_BITS:
            raise ValueError(f"no such check number: {check}")
        ticks = (self.started.astimezone(dt.timezone.utc) - _EPOCH) // dt.timedelta(microseconds=1) * _PER_SECOND // 1_000_000
        if not 0 <= ticks < 1 << _TIME_BITS:
            raise ValueError(f"a run that started {self.started} has no ids")
        return (ticks << _CHECK_BITS | check) << _ROW_BITS

    def id_range(self, check: int = 0) -> tuple[int, int]:
        """The smallest and the largest id that rows of this run of a check can have."""
        prefix = self._prefix(check)
        return prefix, prefix + (1 << _ROW_BITS) - 1

    def query_id(self, row_number: Column, check: int = 0) -> Column:
        """Id of one result row: when the run started, the number of its check, the row's in the run.

        Unlike a hash it cannot collide, also between checks that share a log and between runs of one check
        that start in the same second (but for the same 128th of it), and a later run always has the larger
        id, which settles "latest" between runs of one log date. A run of more than four million rows is an error.
        """
        number = row_number.cast("long")
        too_many = F.raise_error(F.lit(f"a run has at most {1 << _ROW_BITS} rows")).cast("long")
        return F.when(number < 1 << _ROW_BITS, F.lit(self._prefix(check)) + number).otherwise(too_many)
