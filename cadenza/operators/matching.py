"""Cues matched across transcripts by time and words, and the roll-ups of a review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .intervals import identity, overlaps
from .review import split_normal

KEYS = ("film_id",)


def _shared(left: Column, right: Column) -> Column:
    """Distinct normalised words in both texts; words that normalise to nothing do not count."""
    return F.size(F.array_remove(F.array_intersect(split_normal(left), split_normal(right)), ""))


def _pairs(left: DataFrame, right: DataFrame, pad_ms: int, keys) -> DataFrame:
    slim = lambda d: d.select(*keys, *dict.fromkeys([*identity(d), "cue_id", "start_ms", "end_ms", "text"]))
    return overlaps(slim(left), slim(right), pad_ms, keys=keys).withColumn("shared", _shared(F.col("l_text"), F.col("r_text"))).where("shared > 0")


def start_deltas(reference: DataFrame, ours: DataFrame, pad_ms: int = 1200, keys=KEYS) -> DataFrame:
    """Each reference cue with the overlapping cue of ours that shares most words (ties: the earlier one), and the start delta.

    The tolerance and the tie rule are our own choice.
    """
    best = F.max(F.struct("shared", (-F.col("r_start_ms")).alias("s"), (-F.col("r_cue_id")).alias("c"))).alias("b")
    ids = [c for c in identity(reference) if c != "cue_id"]
    found = _pairs(reference, ours, pad_ms, keys).groupBy(*keys, *[F.col(f"l_{c}").alias(c) for c in (*ids, "cue_id", "start_ms")]).agg(best)
    return found.select(*keys, *ids, "cue_id", "start_ms", (-F.col("b.c")).alias("other_id"), F.col("b.shared").alias("shared"), (-F.col("b.s") - F.col("start_ms")).alias("delta_ms"))


def corroborated(recovered: DataFrame, sources: DataFrame, pad_ms: int = 1200, keys=KEYS) -> DataFrame:
    """`recovered` with `tag`: corroborated if any source cue near it shares a word, else unconfirmed."""
    ids = identity(recovered)
    hit = _pairs(recovered, sources, pad_ms, keys).select(*keys, *[F.col(f"l_{c}").alias(c) for c in ids]).distinct().withColumn("__hit", F.lit(True))
    return recovered.join(hit, [*keys, *ids], "left").withColumn("tag", F.when(F.col("__hit"), "corroborated").otherwise("unconfirmed")).drop("__hit")


def prioritised(gaps: DataFrame, suspects: DataFrame, pad_ms: int = 0, keys=KEYS) -> DataFrame:
    """`gaps` (told apart by start_ms) with `priority`: does a suspect span overlap the gap?  Such gaps are looked into whatever their rank."""
    hit = overlaps(gaps.select(*keys, "start_ms", "end_ms"), suspects.select(*keys, "start_ms", "end_ms"), pad_ms, keys=keys)
    hit = hit.select(*keys, F.col("l_start_ms").alias("start_ms")).distinct().withColumn("priority", F.lit(True))
    return gaps.join(hit, [*keys, "start_ms"], "left").withColumn("priority", F.coalesce("priority", F.lit(False)))


def in_context(cues: DataFrame, keys=KEYS, order: str = "seq") -> DataFrame:
    """`cues` with the texts before and after, and `runs_on`: the text ends without a closing mark and another follows."""
    w = Window.partitionBy(*keys).orderBy(order)
    x = cues.withColumn("before", F.lag("text").over(w)).withColumn("after", F.lead("text").over(w))
    return x.withColumn("runs_on", F.coalesce(F.col("after").isNotNull() & ~F.rtrim("text").rlike("[.!?…]$"), F.lit(False)))


def timed(lines: DataFrame, sources: list[str]) -> DataFrame:
    """Start of reconstructed lines from the first source that has one (columns of those names, best first), and `timing`: its name.

    `even_ms`, the evenly spaced place, is the last resort and is flagged as `even`.
    """
    name = F.coalesce(*[F.when(F.col(s).isNotNull(), F.lit(s)) for s in sources], F.lit("even"))
    return lines.withColumn("timing", name).withColumn("start_ms", F.coalesce(*[F.col(s) for s in sources], F.col("even_ms")))


def chunk_status(expected: DataFrame, made: DataFrame, keys=("film_id", "chunk_no")) -> DataFrame:
    """Per expected chunk the number of its cues and `status`: ok, or empty."""
    n = made.groupBy(*keys).agg(F.count("*").alias("n_cues"))
    x = expected.select(*keys).distinct().join(n, list(keys), "left").withColumn("n_cues", F.coalesce("n_cues", F.lit(0)))
    return x.withColumn("status", F.when(F.col("n_cues") > 0, "ok").otherwise("empty"))


def failed(status: DataFrame, keys=KEYS) -> DataFrame:
    """Per film: chunks, those without cues, and whether any failed."""
    bad = F.col("status") != "ok"
    return status.groupBy(*keys).agg(F.count("*").alias("n_chunks"), F.count_if(bad).alias("n_failed"), F.bool_or(bad).alias("failed"))


def roll_up(findings: DataFrame) -> DataFrame:
    """Findings of all batches per verdict: rows, those with a text to put in."""
    return findings.groupBy("verdict").agg(F.count("*").alias("n"), F.count_if(F.length(F.trim("fix_text")) > 0).alias("n_with_text"))


def most_frequent(rows: DataFrame, column: str, n: int = 3) -> DataFrame:
    """The n most frequent values (a report); ties: the lesser value."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column).limit(n)


def incomplete(media: DataFrame, container: DataFrame, tolerance_ms: int = 500, keys=KEYS) -> DataFrame:
    """Films whose extracted duration is off the container's by over tolerance_ms, or missing."""
    x = container.select(*keys, F.col("duration_ms").alias("whole_ms")).join(media.select(*keys, "duration_ms"), list(keys), "left")
    return x.where("duration_ms is null or abs(duration_ms - whole_ms) > " + str(int(tolerance_ms)))


def realtime(metrics: DataFrame) -> DataFrame:
    """`factor`: seconds of audio for a second of work; null without work."""
    return metrics.withColumn("factor", F.expr("try_divide(audio_ms, elapsed_ms)"))
