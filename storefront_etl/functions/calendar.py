"""Calendar features: weekday/month numbers and names, hour, day differences.

Names come from a fixed array indexed by the number, so the expression is
native and code-generated.  Parity default: a NULL number maps to the last
name ('saturday' / 'december'), as the source job's chained conditional did;
pass ``null_name=None`` to get NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# English lowercase names; weekday 1 = Sunday (Spark dayofweek).
DAY_NAMES = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

LAST = "last"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _name_of(number: Column, names: tuple[str, ...], null_name: str | None) -> Column:
    in_range = number.between(F.lit(1), F.lit(len(names)))
    looked_up = F.when(in_range, F.element_at(F.array(*[F.lit(n) for n in names]), number))
    if null_name is None:
        return looked_up
    fill = names[-1] if null_name == LAST else null_name
    # The source job's conditional chain sends every value that matches none
    # of the first n-1 numbers (NULL included) to the last name.
    return F.coalesce(looked_up, F.lit(fill))


def day_of_week_name(day_number: ColumnOrName, null_name: str | None = LAST) -> Column:
    """1..7 (1 = Sunday) -> 'sunday'..'saturday'."""
    return _name_of(_col(day_number), DAY_NAMES, null_name)


def month_name(month_number: ColumnOrName, null_name: str | None = LAST) -> Column:
    """1..12 -> 'january'..'december'."""
    return _name_of(_col(month_number), MONTH_NAMES, null_name)


def with_day_of_week(
    df: DataFrame,
    source: ColumnOrName,
    number_col: str,
    name_col: str,
    null_name: str | None = LAST,
) -> DataFrame:
    """Add weekday number (1 = Sunday) and weekday name columns."""
    number = F.dayofweek(_col(source))
    return df.withColumns({number_col: number, name_col: day_of_week_name(number, null_name)})


def with_month(
    df: DataFrame,
    source: ColumnOrName,
    number_col: str,
    name_col: str,
    null_name: str | None = LAST,
) -> DataFrame:
    """Add month number and month name columns."""
    number = F.month(_col(source))
    return df.withColumns({number_col: number, name_col: month_name(number, null_name)})


def with_hour(df: DataFrame, source: ColumnOrName, out: str) -> DataFrame:
    """Add the hour of day (session time zone for zoned timestamps)."""
    return df.withColumn(out, F.hour(_col(source)))


def with_day_diff(df: DataFrame, end: ColumnOrName, start: ColumnOrName, out: str) -> DataFrame:
    """Add calendar-day difference end - start (may be negative; NULL in -> NULL)."""
    return df.withColumn(out, F.datediff(_col(end), _col(start)))
