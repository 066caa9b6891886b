"""Interval joins.  Spark has no interval join: both sides are dealt to time buckets, equi-joined there, and a
pair is kept only in the first bucket it shares, so nothing has to be made distinct afterwards.

A row whose end lies before its start is dealt by its ordered bounds, since the overlap tests can hold for it
too.  A row of more than LONG buckets (a corrupt end, say) is not dealt: it meets the rows of its keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_MS = 60_000
#: Buckets a row may be dealt to; a longer one takes the second, equally exact way.
LONG = 1024


def identity(df: DataFrame) -> list[str]:
    """What tells the rows of a film apart: source and place in the file; cue numbers repeat in bad files and serve only where there is no place."""
    return [c for c in ("source", "seq") if c in df.columns] if "seq" in df.columns else ["cue_id"]


def overlaps(left: DataFrame, right: DataFrame, pad_ms: int = 0, inclusive: bool = False, keys: tuple[str, ...] = ("film_id",), bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Inner join on `keys` where right overlaps left widened by pad_ms on both ends (strict, or inclusive).

    Columns: keys, then l_<name> and r_<name> of both sides; both need start_ms and end_ms.
    """
    lo, hi = F.col("l_start_ms") - pad_ms, F.col("l_end_ms") + pad_ms
    l = _ranged(left.select(*keys, *[F.col(c).alias(f"l_{c}") for c in left.columns if c not in keys]), "l", lo, hi, bucket_ms)
    r = _ranged(right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys]), "r", F.col("r_start_ms"), F.col("r_end_ms"), bucket_ms)
    meets = (F.col("r_end_ms") >= lo) & (F.col("r_start_ms") <= hi) if inclusive else (F.col("r_end_ms") > lo) & (F.col("r_start_ms") < hi)
    deal = lambda x, s: x.where(f"__{s}long = false").withColumn("__bucket", F.explode(F.sequence(f"__{s}from", f"__{s}upto")))
    short = deal(l, "l").join(deal(r, "r"), [*keys, "__bucket"]).where(meets & (F.col("__bucket") == F.greatest("__lfrom", "__rfrom"))).drop("__bucket")
    long = l.where("__llong").join(r, list(keys)).where(meets).unionByName(l.where("not __llong").join(r.where("__rlong"), list(keys)).where(meets))
    return short.unionByName(long).drop("__lfrom", "__lupto", "__llong", "__rfrom", "__rupto", "__rlong")


def _ranged(x: DataFrame, side: str, start, end, bucket_ms: int) -> DataFrame:
    """First and last bucket of each row (rows without both bounds overlap nothing), and whether it is too long to deal."""
    x = x.where(start.isNotNull() & end.isNotNull())
    x = x.withColumn(f"__{side}from", F.floor(F.least(start, end) / bucket_ms).cast("long")).withColumn(f"__{side}upto", F.floor(F.greatest(start, end) / bucket_ms).cast("long"))
    return x.withColumn(f"__{side}long", F.col(f"__{side}upto") - F.col(f"__{side}from") >= LONG)


def windows(left: DataFrame, right: DataFrame, pad_ms: int, inclusive: bool = False, keys: tuple[str, ...] = ("film_id",), separator: str = " / ") -> DataFrame:
    """`left` with `window`: the texts of overlapping right rows in the order of their file (seq); empty if there are none."""
    ids = identity(left)
    pairs = overlaps(left.select(*keys, *ids, "start_ms", "end_ms"), right.select(*keys, "seq", "start_ms", "end_ms", "text"), pad_ms, inclusive, keys)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r_seq", "r_text"))), lambda x: x["r_text"]), separator)
    found = pairs.groupBy(*keys, *[F.col(f"l_{c}").alias(c) for c in ids]).agg(text.alias("window"))
    return left.join(found, [*keys, *ids], "left").withColumn("window", F.coalesce("window", F.lit("")))


def uncovered(reference: DataFrame, output: DataFrame, pad_ms: int = 500, keys: tuple[str, ...] = ("film_id",)) -> DataFrame:
    """Reference rows that no output row overlaps (coverage anti-join)."""
    ids = identity(reference)
    hit = overlaps(reference.select(*keys, *ids, "start_ms", "end_ms"), output.select(*keys, "start_ms", "end_ms"), pad_ms, keys=keys).select(*keys, *[F.col(f"l_{c}").alias(c) for c in ids]).distinct()
    return reference.join(hit, [*keys, *ids], "left_anti")


def starts_within(points: DataFrame, spans: DataFrame, keys: tuple[str, ...] = ("film_id",), bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Rows of `points` whose start lies in a span [start, end], once for each such span (ends included)."""
    p = points.select(*keys, *[F.col(c).alias(f"l_{c}") for c in points.columns if c not in keys])
    s = spans.select(*keys, *[F.col(c).alias(f"r_{c}") for c in spans.columns if c not in keys]).where("r_end_ms >= r_start_ms")
    s = _ranged(s, "r", F.col("r_start_ms"), F.col("r_end_ms"), bucket_ms)
    dealt = s.where("not __rlong").withColumn("__bucket", F.explode(F.sequence("__rfrom", "__rupto")))
    short = p.withColumn("__bucket", F.floor(F.col("l_start_ms") / bucket_ms).cast("long")).join(dealt, [*keys, "__bucket"]).drop("__bucket")
    long = p.join(s.where("__rlong"), list(keys))
    return short.unionByName(long).where("l_start_ms between r_start_ms and r_end_ms").drop("__rfrom", "__rupto", "__rlong")
