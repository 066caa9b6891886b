"""Cue building: checks, gaps, runs, grouping, timing, wrapping."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from ..functions import text as T
from ..sources.timings import word_order
from .intervals import starts_within

KEYS = ("film_id",)


def _by(keys, *order):
    return Window.partitionBy(*keys).orderBy(*order)


def structure(cues: DataFrame, keys=KEYS) -> DataFrame:
    """Per film: cues, overlaps, backward starts, wrong numbers, non-positive durations, median and longest duration, span, verdict.

    Checks follow the order of the file (seq), not of time.
    """
    w = _by(keys, "seq")
    x = cues.withColumn("__next", F.lead("start_ms").over(w)).withColumn("__n", F.row_number().over(w)).withColumn("__d", F.col("end_ms") - F.col("start_ms"))
    out = x.groupBy(*keys).agg(
        F.count("*").alias("n_cues"), F.count_if(F.col("end_ms") > F.col("__next")).alias("n_overlaps"), F.count_if(F.col("start_ms") > F.col("__next")).alias("n_backward"),
        F.count_if(F.col("cue_id") != F.col("__n")).alias("n_misnumbered"), F.count_if(F.col("__d") <= 0).alias("n_empty"),
        F.median("__d").cast("double").alias("median_ms"), F.max("__d").alias("longest_ms"),
        (F.max_by("end_ms", "seq") - F.min_by("start_ms", "seq")).alias("span_ms"),
    )
    return out.withColumn("passed", (F.col("n_overlaps") + F.col("n_backward") + F.col("n_misnumbered") + F.col("n_empty")) == 0)


def _length() -> Column:
    """Characters of a cue's lines, joined by single spaces."""
    return F.aggregate("lines", F.lit(0), lambda a, x: a + F.length(x)) + F.greatest(F.size("lines") - 1, F.lit(0))


def reading_speed(cues: DataFrame, max_cps: int = 25, max_lines: int = 2, max_line: int = 45) -> DataFrame:
    """Characters per second (null for non-positive durations) and flags."""
    d = F.col("end_ms") - F.col("start_ms")
    return cues.withColumn("cps", F.when(d > 0, _length() * 1000 / d)).withColumn("too_fast", F.coalesce(F.col("cps") > max_cps, F.lit(False))).withColumn("too_many_lines", F.size("lines") > max_lines).withColumn("too_long", F.exists("lines", lambda x: F.length(x) > max_line))


def reading_summary(cues: DataFrame, keys=KEYS, max_cps: int = 25) -> DataFrame:
    """Per film: median characters a second and length, longest, duration percentiles 50 and 99, cues too fast, with over two lines, and lines over 45."""
    x = reading_speed(cues, max_cps).withColumn("__d", F.col("end_ms") - F.col("start_ms")).withColumn("__l", _length())
    return x.groupBy(*keys).agg(
        F.count("*").alias("n_cues"), F.median("cps").alias("median_cps"), F.median("__l").cast("double").alias("median_chars"), F.max("__l").cast("long").alias("longest_chars"),
        F.percentile("__d", 0.5).alias("p50_ms"), F.percentile("__d", 0.99).alias("p99_ms"),
        F.count_if("too_fast").alias("n_fast"), F.count_if("too_many_lines").alias("n_many_lines"), F.sum(F.size(F.filter("lines", lambda y: F.length(y) > 45))).cast("long").alias("n_long_lines"),
    )


def coverage_summary(reference: DataFrame, missed: DataFrame, keys=KEYS) -> DataFrame:
    """Per film of the reference: its cues, the uncovered ones, their share and their time in minutes."""
    gone = missed.groupBy(*keys).agg(F.count("*").alias("n_uncovered"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("__ms"))
    x = reference.groupBy(*keys).agg(F.count("*").alias("n_reference")).join(gone, list(keys), "left").withColumn("n_uncovered", F.coalesce("n_uncovered", F.lit(0)))
    return x.withColumn("share", F.expr("try_divide(n_uncovered, n_reference)")).withColumn("minutes", F.coalesce(F.col("__ms") / 60_000, F.lit(0.0))).drop("__ms")


def runs(rows: DataFrame, gap_ms: int = 12_000, keys=KEYS, order=("start_ms", "cue_id")) -> DataFrame:
    """Gap-and-island runs: a row joins the one before if it starts under gap_ms after that row's end.

    The end of the row before counts, not the latest end so far.  A run's end is its last row's.
    """
    w = _by(keys, *order)
    new = F.coalesce((F.col("start_ms") - F.lag("end_ms").over(w)) >= gap_ms, F.lit(True))
    x = rows.withColumn("__run", F.sum(new.cast("long")).over(w)).withColumn("__at", F.struct(*order))
    return x.groupBy(*keys, F.col("__run").alias("run")).agg(F.min("start_ms").alias("start_ms"), F.max_by("end_ms", "__at").alias("end_ms"), F.count("*").alias("n_cues"))


def top_gaps(found: DataFrame, least: int = 3, n: int = 6) -> DataFrame:
    """The n longest runs of at least `least` cues (a report)."""
    return found.where(F.col("n_cues") >= least).orderBy((F.col("end_ms") - F.col("start_ms")).desc(), "start_ms", *KEYS).limit(n)


def bare_runs(cues: DataFrame, least: int = 12, keys=KEYS, order: str = "seq") -> DataFrame:
    """Maximal runs of cues with words and without any of . ! ? , : ; that hold at least `least` words; ends at their true last cue."""
    n = F.size(F.filter(F.split("text", r"\s+"), lambda x: x != ""))
    bare = ~F.col("text").rlike("[.!?,:;]") & (n > 0)
    x = cues.withColumn("__n", n).withColumn("__bare", bare).withColumn("__run", F.sum((~bare).cast("long")).over(_by(keys, order))).where("__bare")
    return x.groupBy(*keys, "__run").agg(F.min(order).alias("first_seq"), F.max(order).alias("last_seq"), F.sum("__n").alias("n_words")).where(F.col("n_words") >= least).drop("__run")


def word_gaps(words: DataFrame, keys=KEYS) -> DataFrame:
    """`words` with `gap_ms`: the pause since the word before, in film order."""
    return words.withColumn("gap_ms", F.col("start_ms") - F.lag("end_ms").over(_by(keys, *word_order(words))))


def inner_silence(spans: DataFrame, words: DataFrame, keys=KEYS) -> DataFrame:
    """Per span (cue_id): its largest positive gap between consecutive words that start in it, and that gap's middle; ties: the first."""
    w = starts_within(words.select(*keys, "start_ms", "end_ms"), spans.select(*keys, "cue_id", "start_ms", "end_ms"), keys)
    x = w.withColumn("gap_ms", F.lead("l_start_ms").over(_by((*keys, "r_cue_id"), "l_start_ms", "l_end_ms")) - F.col("l_end_ms")).where("gap_ms > 0")
    best = x.groupBy(*keys, F.col("r_cue_id").alias("cue_id")).agg(F.max(F.struct("gap_ms", (-F.col("l_end_ms")).alias("e"))).alias("b"))
    return best.select(*keys, "cue_id", "b.gap_ms", (F.col("b.gap_ms") / 2 - F.col("b.e")).alias("middle_ms"))


def clamp(words: DataFrame, flag_ms: int = 6000) -> DataFrame:
    """Words cut to their longest credible duration; `suspect` marks those over flag_ms before."""
    raw = F.col("end_ms") - F.col("start_ms")
    return words.withColumn("raw_ms", raw).withColumn("suspect", raw > flag_ms).withColumn("end_ms", F.col("start_ms") + F.least(raw, T.duration_cap(F.col("word"))))


def clamped_share(clamped: DataFrame, keys=KEYS) -> DataFrame:
    """Per film: words, those cut, their share, and suspects."""
    x = clamped.groupBy(*keys).agg(F.count("*").alias("n_words"), F.count_if(F.col("end_ms") - F.col("start_ms") < F.col("raw_ms")).alias("n_clamped"), F.count_if("suspect").alias("n_suspects"))
    return x.withColumn("share", F.col("n_clamped") / F.greatest("n_words", F.lit(1)))


def group_words(words: DataFrame, gap_ms: int = 800, long_ms: int = 6000, chars: int = 84, sentence_chars: int = 40, keys=KEYS) -> DataFrame:
    """Greedy cues: (keys, cue_id, start_ms, end_ms, text).

    Before a word is added the open cue closes if the pause is over gap_ms, the cue would last over long_ms
    or hold over `chars` characters, or the last word ends a sentence and the cue would pass sentence_chars.
    Words are sorted within partitions and folded batch by batch; only the open cue is held between batches,
    so a film may be longer than a task's memory.
    """
    kinds = [f for f in words.schema if f.name in keys]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds) + ", cue_id int, start_ms long, end_ms long, text string"
    names = [*(f.name for f in kinds), "cue_id", "start_ms", "end_ms", "text"]

    def fold(batches):
        film, held, size, start, end, n = None, [], 0, 0, 0, 0
        out: list[list] = [[] for _ in names]

        def close():
            for column, value in zip(out, (*film, n, start, end, " ".join(held))):
                column.append(value)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for key, w, s, e in zip(zip(*columns[:-3]), *columns[-3:]):
                if key != film:
                    if held:
                        close()
                    film, held, n = key, [], 0
                elif held:
                    grown = size + 1 + len(w)
                    if s - end > gap_ms or e - start > long_ms or grown > chars or (grown > sentence_chars and held[-1][-1:] in (".", "!", "?")):
                        close()
                        held = []
                if not held:
                    start, size, n = s, -1, n + 1
                held.append(w)
                size += 1 + len(w)
                end = e
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
            out = [[] for _ in names]
        if held:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    types = [*(to_arrow_type(f.dataType) for f in kinds), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    order = [c for c in word_order(words) if c not in keys]
    rows = words.select(*[f.name for f in kinds], *order, "word", "end_ms")
    rows = rows.repartition(*[f.name for f in kinds]).sortWithinPartitions(*[f.name for f in kinds], *order).select(*[f.name for f in kinds], "word", "start_ms", "end_ms")
    return rows.mapInArrow(fold, schema)


def extend(cues: DataFrame, keys=KEYS, least_ms: int = 900, cps: int = 20, keep_off: bool = False) -> DataFrame:
    """Longer ends for reading: at least least_ms, text length / cps if the next cue leaves room, never into it.

    keep_off: a cue whose successor starts at once is cut to that start instead of lasting least_ms.
    """
    w = _by(keys, "start_ms", "cue_id")
    x = cues.withColumn("__next", F.lead("start_ms").over(w))
    s, first = F.col("start_ms"), F.greatest("end_ms", F.col("start_ms") + least_ms)
    need = (F.length("text") * (1000 / cps)).cast("long")
    room = F.coalesce(F.col("__next") - 80, F.col("end_ms") + 2500)
    e = F.when(first - s < need, F.least(s + need, F.greatest(first, room))).otherwise(first)
    e = F.coalesce(F.least(e, F.col("__next") - 40), e)
    e = F.when(e <= s, F.least(s + least_ms, F.greatest(F.col("__next"), s + 1)) if keep_off else s + least_ms).otherwise(e)
    return x.withColumn("end_ms", e).drop("__next")


def wrapped(text: Column, limit: int = 42, tolerance: int = 0, marks: str = "[,.!?;:]$", starts: bool = True, fallback: bool = True) -> Column:
    """Two lines of at most `limit` characters: the split of least cost; ties: the first.

    The cost is the difference of lengths, less 12 after a mark and less 20 before a sentence start.  If no
    split fits: the most balanced one (fallback), or one line.
    """
    most = limit + tolerance
    best = "struct<late:int,cost:int,a:int>"

    def split(line, total):
        """One walk over the words; a and b: lengths of the two lines if the next word opens the second."""

        def step(acc, word):
            a = acc["a"]
            b = total - a - 1
            cost = F.abs(a - b)
            fits = (a <= most) & (b <= most)
            cheap = cost - F.when(acc["before"].rlike(marks), 12).otherwise(0)
            if starts:
                cheap = cheap - F.when(T.starts_sentence(acc["before"], word), 20).otherwise(0)
            option = F.struct((~fits).cast("int").alias("late"), F.when(fits, cheap).otherwise(cost).alias("cost"), a.alias("a"))
            return F.struct((a + 1 + F.length(word)).alias("a"), word.alias("before"), F.when(a >= 0, F.least(acc["best"], option)).alias("best"))

        first = F.struct(F.lit(-1).alias("a"), F.lit("").alias("before"), F.lit(None).cast(best).alias("best"))
        return F.aggregate(F.split(line, " "), first, step, lambda acc: acc["best"])

    def balanced(line, total):
        """A text too long for any split is cut at the space nearest to its middle, without weighing every split."""
        half = F.floor((total - 1) / 2).cast("int")
        before = half + 2 - F.locate(" ", F.reverse(F.substring(line, 1, half + 1)))
        after = F.call_function("locate", F.lit(" "), line, half + 2)
        at = F.when((F.locate(" ", F.substring(line, 1, half + 1)) > 0) & ((after == 0) | (F.abs(2 * (before - 1) - (total - 1)) <= F.abs(2 * (after - 1) - (total - 1)))), before).otherwise(after)
        return _with(at, lambda at: _cut(line, at - 1, total))

    def weighed(line, total):
        short = text if fallback else line
        out = F.when((F.length(short) <= limit) | ~F.contains(line, F.lit(" ")), short).when(total > 2 * most + 1, balanced(line, total) if fallback else line)
        return out.otherwise(_with(split(line, total), lambda x: _cut(line, x["a"], total) if fallback else F.when(x["late"] == 0, _cut(line, x["a"], total)).otherwise(line)))

    # what is used several times is computed once, also inside a CASE; most cues are short and need none of it
    line = F.trim(F.regexp_replace(text, r"\s+", " "))
    long = _with(line, lambda x: _with(F.length(x), lambda total: weighed(x, total)))
    return F.when(F.length(text) <= limit, text if fallback else line).otherwise(long)


def _with(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _cut(line: Column, a: Column, total: Column) -> Column:
    """The line broken after `a` characters, at a space."""
    return F.concat(F.substring(line, F.lit(1), a), F.lit("\n"), F.substring(line, a + 2, total))


def renumber(cues: DataFrame, keys=KEYS, order=("start_ms", "seq")) -> DataFrame:
    return cues.withColumn("cue_id", F.row_number().over(_by(keys, *order)).cast("int"))


def tiles(cues: DataFrame, width: int = 150, keys=KEYS) -> DataFrame:
    """Review batches [lo, hi] of `width` cue numbers, with the next batch's bounds."""
    n = cues.groupBy(*keys).agg(F.max("cue_id").cast("long").alias("n")).where("n > 0")
    x = n.select(*keys, "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(width).cast("long"))).alias("lo"))
    x = x.withColumn("hi", F.least(F.col("lo") + width - 1, F.col("n")))
    ahead = F.col("hi") < F.col("n")
    return x.withColumn("next_lo", F.when(ahead, F.col("hi") + 1)).withColumn("next_hi", F.when(ahead, F.least(F.col("hi") + 1 + F.col("hi") - F.col("lo"), F.col("n"))))


def tiles_complete(batches: DataFrame, keys=KEYS) -> DataFrame:
    """Per film: do the batches cover 1..n without gaps?"""
    x = batches.withColumn("__next", F.lead("lo").over(_by(keys, "lo")))
    return x.groupBy(*keys).agg(((F.min("lo") == 1) & F.bool_and(F.coalesce(F.col("__next") == F.col("hi") + 1, F.lit(True))) & (F.max("hi") == F.max("n"))).alias("complete"))


def cut_points(films: DataFrame, silences: DataFrame, target_ms: int, keys=KEYS) -> DataFrame:
    """Cut plan per film (duration_ms): from the last cut an ideal point target_ms on, moved to the nearest silence within target/6
    (and over target/2 after the last cut; ties: the first), until under a fifth of the target is left; then the end.

    A film's silences are one sorted array of numbers, walked once.
    """
    s = silences.groupBy(*keys).agg(F.array_sort(F.collect_list("at_ms")).alias("silences"))
    x = films.join(s, list(keys), "left").withColumn("silences", F.coalesce("silences", F.array().cast("array<bigint>")))

    @F.pandas_udf("array<bigint>")
    def walk(duration: pd.Series, quiet: pd.Series) -> pd.Series:
        return pd.Series([cut_walk(int(d), q, target_ms) for d, q in zip(duration, quiet)])

    return x.where("duration_ms is not null").select(*keys, F.posexplode(walk("duration_ms", "silences")).alias("chunk_no", "cut_ms"))


def cut_walk(duration: int, quiet, target: int) -> list[int]:
    """One walk over the sorted silences: each cut looks at those around its ideal point only."""
    cuts, at = [0], 0
    while 5 * (cuts[-1] + target) < 5 * duration - target:
        ideal = cuts[-1] + target
        while at < len(quiet) and 6 * (ideal - quiet[at]) >= target:
            at += 1
        k, best = at, None
        while k < len(quiet) and 6 * (quiet[k] - ideal) < target:
            if best is None or abs(quiet[k] - ideal) < abs(best - ideal):
                best = int(quiet[k])
            k += 1
        cuts.append(ideal if best is None else best)
    return [*cuts, duration]


def nearest_silence(points: DataFrame, silences: DataFrame, tolerance_ms: int, keys=KEYS) -> DataFrame:
    """`points` (at_ms) with `nearest_ms`: the silence nearest to it within the tolerance (strict; ties: the earlier), else the point itself."""
    spans = points.select(*keys, "at_ms").distinct().select(*keys, "at_ms", (F.col("at_ms") - tolerance_ms).alias("start_ms"), (F.col("at_ms") + tolerance_ms).alias("end_ms"))
    near = starts_within(silences.select(*keys, F.col("at_ms").alias("start_ms")), spans, keys, bucket_ms=max(1000, 4 * tolerance_ms))
    off = F.abs(F.col("l_start_ms") - F.col("r_at_ms"))
    best = near.where(off < tolerance_ms).groupBy(*keys, F.col("r_at_ms").alias("at_ms")).agg(F.min(F.struct(off.alias("d"), "l_start_ms")).alias("b"))
    return points.join(best.select(*keys, "at_ms", F.col("b.l_start_ms").alias("nearest_ms")), [*keys, "at_ms"], "left").withColumn("nearest_ms", F.coalesce("nearest_ms", "at_ms"))
