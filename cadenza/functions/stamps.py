"""Time stamps as long milliseconds (Column functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = r"^\s*(\d+):(\d+):(\d+)[,.](\d+)\s*$"


def to_ms(stamp: Column) -> Column:
    """`H:MM:SS,mmm` (comma or point) to milliseconds; null if it is no stamp.  The digits after the mark count milliseconds."""
    part = lambda i: F.regexp_extract(stamp, STAMP, i).cast("long")
    return F.when(stamp.rlike(STAMP), part(1) * 3_600_000 + part(2) * 60_000 + part(3) * 1000 + part(4))


def seconds_to_ms(seconds: Column) -> Column:
    """Half-even rounding of seconds to milliseconds."""
    return F.bround(seconds * 1000).cast("long")


def from_ms(ms: Column) -> Column:
    """Milliseconds to `HH:MM:SS,mmm`; rounding happens before, so no field can roll over."""
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def minutes(ms: Column) -> Column:
    """Milliseconds to `MM:SS`; minutes may pass 59."""
    return F.format_string("%02d:%02d", F.floor(ms / 60_000), F.floor(ms / 1000) % 60)


def clock_to_ms(clock: Column) -> Column:
    """`MM:SS` or `HH:MM:SS` (fractions allowed) to milliseconds."""
    return F.bround(F.aggregate(F.split(clock, ":"), F.lit(0.0).cast("double"), lambda a, x: a * 60 + x.cast("double")) * 1000).cast("long")


def ranges(text: Column) -> Column:
    """`MM:SS-MM:SS,...` to an array of (lo_ms, hi_ms); parts that are no range are left out."""
    part = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x.rlike(r"^[\d:.]+-[\d:.]+$"))
    return F.transform(part, lambda x: F.struct(clock_to_ms(F.split(x, "-")[0]).alias("lo_ms"), clock_to_ms(F.split(x, "-")[1]).alias("hi_ms")))
