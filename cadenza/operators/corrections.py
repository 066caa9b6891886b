"""Rule-based correction and its checks."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def java(replacement: str) -> str:
    """A replacement with \\1 groups as Java writes it."""
    return re.sub(r"\\(\d)", r"$\1", replacement.replace("$", "\\$"))


def rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Rules in order, case-sensitive; each sees the one before's output."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, "(?U)" + pattern, java(replacement))
    return text


def apply_rules(cues: DataFrame, rules: list[tuple[str, str]], drop: list[str] = (), foreign_between: tuple[int, int] | None = None, threshold: float = 0.34) -> DataFrame:
    """Dropped: cues that match a drop pattern (any case), and foreign ones that start in the window.  Then rewriting; `changed` tells where.  A cue that a rule emptied stays, with empty text."""
    out = cues
    for pattern in drop:
        out = out.where(~F.col("text").rlike("(?iuU)" + pattern))
    if foreign_between:
        out = out.where(~(F.col("start_ms").between(*foreign_between) & (T.foreign_share(F.col("text"), T.FOREIGN_DROP) > threshold)))
    out = out.withColumn("__was", F.col("text")).withColumn("text", rewrite(F.col("text"), rules))
    return out.withColumn("changed", F.col("text") != F.col("__was")).drop("__was")


def apply_files(cues: DataFrame, settings: DataFrame) -> DataFrame:
    """`apply_rules` by each film's own settings (`timings.rules`; a film without any is left as it is).

    The patterns are columns, so films with different rules go through one plan.
    """
    x = cues.join(settings, "film_id", "left")
    listed = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    dropped = F.exists(listed(F.col("drop_matching"), "array<string>"), lambda p: F.regexp_like("text", F.concat(F.lit("(?iuU)"), p)))
    window = F.col("drop_cues_between")
    inside = (F.col("start_ms") >= F.get(window, F.lit(0)) * 1000) & (F.col("start_ms") <= F.get(window, F.lit(1)) * 1000)
    foreign = inside & (F.col("drop_if_foreign") == "en") & (T.foreign_share(F.col("text"), T.FOREIGN_DROP) > F.col("drop_threshold"))
    put_in = lambda r: F.regexp_replace(F.replace(r[1], F.lit("$"), F.lit("\\$")), r"\\(\d)", r"\$$1")
    new = F.aggregate(listed(F.col("replacements"), "array<array<string>>"), F.col("text"), lambda t, r: F.regexp_replace(t, F.concat(F.lit("(?U)"), r[0]), put_in(r)))
    x = x.where(~dropped & ~F.coalesce(foreign, F.lit(False))).withColumn("__was", F.col("text")).withColumn("text", new)
    return x.withColumn("changed", F.col("text") != F.col("__was")).select(*cues.columns, "changed")


def clean_lines(cues: DataFrame, lang: str) -> DataFrame:
    """Optical-reading repair of each line; emptied lines go, and cues of which none is left.  `n_changed`: lines that changed."""
    fixed = F.transform("lines", lambda y: T.ocr_line(y, lang))
    changed = F.size(F.filter(F.arrays_zip(F.col("lines").alias("a"), fixed.alias("b")), lambda z: z["a"] != z["b"]))
    return cues.withColumn("n_changed", changed).withColumn("lines", F.filter(fixed, lambda y: y != "")).where("size(lines) > 0")


def residual(cues: DataFrame, patterns: list[str]) -> DataFrame:
    """Landing check: patterns that still match a cue's white-space-normalised text, with the number of cues."""
    text = F.trim(F.regexp_replace("text", r"(?U)\s+", " "))
    hits = F.array(*[F.when(text.rlike("(?U)" + T.pattern_spaces(p)), F.lit(p)) for p in patterns])
    return cues.select(F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n_cues"))


def lost_stamps(before: DataFrame, after: DataFrame, keys=("film_id",)) -> DataFrame:
    """Time lines of the output that its input does not have; must be empty."""
    return after.select(*keys, "start_ms", "end_ms").exceptAll(before.select(*keys, "start_ms", "end_ms"))


def stamps_survive(before: DataFrame, after: DataFrame, keys=("film_id",)) -> DataFrame:
    """Starts and ends of the input that are in no start or end of the output; must be empty."""
    both = lambda d: d.select(*keys, F.explode(F.array("start_ms", "end_ms")).alias("at_ms")).distinct()
    return both(before).join(both(after), [*keys, "at_ms"], "left_anti")
