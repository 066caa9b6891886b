"""Cross-source review: which words of a cue do the other transcripts not support?"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.window import Window

from ..functions import text as T
from .intervals import identity, overlaps, windows


def unsupported(words: list[str], window: list[str]) -> list[int]:
    """Positions of normalised words outside every matching block; words that normalise to nothing never count."""
    window = [w for w in window if w]
    support = set()
    for block in SequenceMatcher(None, words, window, autojunk=False).get_matching_blocks():
        support.update(range(block.a, block.a + block.size))
    return [i for i, w in enumerate(words) if w and i not in support]


@F.pandas_udf(T_.ArrayType(T_.IntegerType()))
def dissent(words: pd.Series, window: pd.Series) -> pd.Series:
    """Unsupported positions of array<string> words in array<string> window; null where the window is null or empty."""
    return pd.Series([None if b is None or not len(b) else unsupported(list(a), list(b)) for a, b in zip(words, window)])


def split_normal(text):
    return F.transform(F.filter(F.split(text, r"\s+"), lambda x: x != ""), T.normal)


def tiers(cues: DataFrame, windows: list[str], film: str = "film_id") -> DataFrame:
    """`cues` (text and one window text column per voting source) with dissent maps, agreed positions, tier and marked text.

    both: at least two sources vote and share an unsupported position; one: any voter dissents; none: otherwise.
    A source without text there abstains.
    """
    out = cues.withColumn("__words", F.filter(F.split("text", r"\s+"), lambda x: x != "")).withColumn("__normal", split_normal(F.col("text")))
    for name in windows:
        out = out.withColumn(f"dissent_{name}", dissent("__normal", F.when(F.length(F.trim(name)) > 0, split_normal(F.col(name)))))
    out = out.withColumn("__votes", F.filter(F.array(*[F.col(f"dissent_{n}") for n in windows]), lambda v: v.isNotNull()))
    return verdict(out).drop("__words", "__normal", "__votes")


def verdict(out: DataFrame) -> DataFrame:
    """Tier of `__votes` (array of position arrays, abstentions left out) over `__words`."""
    none = F.array().cast("array<int>")
    agreed = F.when(F.size("__votes") == 0, none).otherwise(F.aggregate(F.slice("__votes", 2, F.greatest(F.size("__votes"), F.lit(1))), F.get("__votes", F.lit(0)), lambda a, v: F.array_intersect(a, v)))
    dissenters = F.size(F.filter("__votes", lambda v: F.size(v) > 0))
    out = out.withColumn("agreed", agreed).withColumn("n_dissent", dissenters)
    tier = F.when((F.size("__votes") >= 2) & (F.size("agreed") > 0), "both").when(F.col("n_dissent") > 0, "one").otherwise("none")
    marked = F.array_join(F.transform("__words", lambda w, i: F.when(F.array_contains(F.col("agreed"), i), F.concat(F.lit("[["), w, F.lit("]]"))).otherwise(w)), " ")
    return out.withColumn("tier", tier).withColumn("marked", marked)


def ranked(rows: DataFrame, keys=("film_id",)) -> DataFrame:
    """`rank` from 1 in each film's report: both, one, none; then most agreed words; then start, then place in the file."""
    order = F.when(F.col("tier") == "both", 0).when(F.col("tier") == "one", 1).otherwise(2)
    last = "seq" if "seq" in rows.columns else "cue_id"
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order, F.size("agreed").desc(), "start_ms", last)))


def selected(rows: DataFrame, lo: int | None = None, hi: int | None = None, tier: str = "all") -> DataFrame:
    """Rows of cues lo..hi (inclusive) and of one tier, or of all."""
    if tier not in ("both", "one", "none", "all"):
        raise ValueError("tier is both, one, none or all")
    if lo is not None:
        rows = rows.where(F.col("cue_id") >= lo)
    if hi is not None:
        rows = rows.where(F.col("cue_id") <= hi)
    return rows if tier == "all" else rows.where(F.col("tier") == tier)


def tier_shares(rows: DataFrame, keys=("film_id",)) -> DataFrame:
    """Per film: cues, those of each tier, and the tiers' shares."""
    x = rows.groupBy(*keys).agg(F.count("*").alias("n_cues"), *[F.count_if(F.col("tier") == t).alias(f"n_{t}") for t in ("both", "one", "none")])
    return x.select("*", *[(F.col(f"n_{t}") / F.col("n_cues")).alias(f"share_{t}") for t in ("both", "one", "none")])


def request(args: list[str]) -> dict:
    """A review's settings from a command's words: draft, lo, hi, LABEL=path ..., --asr A,B, --tier, --rank; or draft, reference, lo, hi, which is one REF source."""
    out = {"asr": ["CAN", "QWN"], "tier": "all", "rank": False}
    if len(args) == 4 and not args[1].isdigit():
        return out | {"draft": args[0], "lo": int(args[2]), "hi": int(args[3]), "sources": [f"REF={args[1]}"]}
    rest, words = [], iter(args)
    for word in words:
        if word == "--asr":
            out["asr"] = [x.strip().upper()[:3] for x in next(words).split(",") if x.strip()]
        elif word == "--tier":
            out["tier"] = next(words)
        elif word == "--rank":
            out["rank"] = True
        else:
            rest.append(word)
    if len(rest) < 4 or any("=" not in x for x in rest[3:]):
        raise ValueError("draft, first cue, last cue, then LABEL=path for each source")
    return out | {"draft": rest[0], "lo": int(rest[1]), "hi": int(rest[2]), "sources": rest[3:]}


def first_match(cues: DataFrame, terms: list[str], keys=("film_id",)) -> DataFrame:
    """Per term the first cue of each film that holds it as a whole word; every term of a cue counts."""
    found = cues.withColumn("__terms", F.array(*[F.when(T.any_word(F.col("text"), [t]), F.lit(t)) for t in terms])).withColumn("term", F.explode(F.filter("__terms", lambda t: t.isNotNull())))
    return found.groupBy(*keys, "term").agg(F.min_by(F.struct("seq", "cue_id", "start_ms"), "seq").alias("x")).select(*keys, "term", "x.seq", "x.cue_id", "x.start_ms")


def unmatched(cues: DataFrame, terms: list[str], found: DataFrame, keys=("film_id",)) -> DataFrame:
    """Per film the terms that no cue holds."""
    every = cues.select(*keys).distinct().withColumn("term", F.explode(F.array(*[F.lit(t) for t in terms])))
    return every.join(found.select(*keys, "term"), [*keys, "term"], "left_anti")


def adjudicated(cues: DataFrame, reference: DataFrame, terms: list[str], pad_ms: int = 1500, keys=("film_id",)) -> DataFrame:
    """The first cue of each term, with `window`: what the reference says there."""
    found = first_match(cues, terms, keys)
    rows = cues.join(found.select(*keys, "term", "seq"), [*keys, "seq"])
    texts = windows(cues.join(found.select(*keys, "seq").distinct(), [*keys, "seq"], "left_semi"), reference, pad_ms, keys=keys)
    ids = [*keys, *identity(cues)]
    return rows.join(texts.select(*ids, "window"), ids)


def swallowed(spans: DataFrame) -> DataFrame:
    """Spans where the best other source has over 40 characters and over twice our own."""
    return spans.withColumn("swallowed", (F.col("other_chars") > 2 * F.col("own_chars")) & (F.col("other_chars") > 40))


def span_sources(spans: DataFrame, sources: DataFrame, labels: list[str], pad_ms: int = 10_000, keys=("film_id",)) -> DataFrame:
    """Every source of `labels` for every span (span_id): n_cues and chars of its cues that touch the span, widened on both ends (inclusive); 0 for none."""
    slim = spans.select(*keys, "span_id", "start_ms", "end_ms")
    pairs = overlaps(slim, sources.where(F.col("source").isin(labels)).select(*keys, "source", "start_ms", "end_ms", "text"), pad_ms, inclusive=True, keys=keys)
    found = pairs.groupBy(*keys, F.col("l_span_id").alias("span_id"), F.col("r_source").alias("source")).agg(F.count("*").alias("n_cues"), F.sum(F.length("r_text")).alias("chars"))
    every = spans.select(*keys, "span_id").withColumn("source", F.explode(F.array(*[F.lit(x) for x in labels])))
    return every.join(found, [*keys, "span_id", "source"], "left").fillna(0, ["n_cues", "chars"])


def swallowed_spans(spans: DataFrame, own: DataFrame, sources: DataFrame, labels: list[str], pad_ms: int = 10_000, keys=("film_id",)) -> DataFrame:
    """Spans with our own cues and characters, the most characters of any one source, that source, and the verdict."""
    best = span_sources(spans, sources, labels, pad_ms, keys).groupBy(*keys, "span_id").agg(F.max(F.struct("chars", "source")).alias("b"))
    mine = span_sources(spans, own.withColumn("source", F.lit("own")), ["own"], pad_ms, keys).select(*keys, "span_id", F.col("n_cues").alias("own_cues"), F.col("chars").alias("own_chars"))
    return swallowed(mine.join(best.select(*keys, "span_id", F.col("b.chars").alias("other_chars"), F.when(F.col("b.chars") > 0, F.col("b.source")).alias("best_source")), [*keys, "span_id"]))


def consensus(agree: str = "n_agree", sources: str = "n_sources"):
    """What agreement alone decides for `n_agree` sources (the largest group of one reading) of `n_sources`: all: the line is right, dismiss;
    a majority: fix, after a look at the odd one out; no two agree: ask, the case that yields most."""
    return F.when((F.col(sources) > 1) & (F.col(agree) == F.col(sources)), "dismiss").when((F.col(agree) > 1) & (2 * F.col(agree) > F.col(sources)), "fix").otherwise("ask")


def recall(flags: DataFrame, truth: DataFrame, keys=("film_id", "cue_id")) -> DataFrame:
    """Detector validation: known errors, those flagged, their share, and the best rank among flags (rank column)."""
    x = truth.select(*keys).join(flags.select(*keys, "rank"), list(keys), "left")
    return x.agg(F.count("*").alias("n_known"), F.count("rank").alias("n_caught"), F.min("rank").alias("best_rank")).withColumn("recall", F.expr("try_divide(n_caught, n_known)"))


def drift(deltas: DataFrame, buckets: int = 10, keys=("film_id",)) -> DataFrame:
    """Median start delta per tenth of the film."""
    span = Window.partitionBy(*keys)
    x = deltas.withColumn("__lo", F.min("start_ms").over(span)).withColumn("__hi", F.max("start_ms").over(span))
    x = x.withColumn("bucket", F.least(F.lit(buckets - 1), F.expr(f"coalesce(try_divide((start_ms - __lo) * {buckets}, __hi - __lo), 0)").cast("int")))
    return x.groupBy(*keys, "bucket").agg(F.median("delta_ms").cast("double").alias("median_ms"), F.count("*").alias("n"))
