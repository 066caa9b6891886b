"""Line dedup by a suffix array over line-ID sequences, built by distributed prefix doubling.

Every line gets an ID of 128 bits (two XXH64 hashes, the second chained after a number).  Round by round each position's rank by its first h lines is joined with the
rank h lines further on, and the distinct pairs are sorted over the cluster to give ranks by 2h lines;
positions whose rank is unique drop out.  The positions of equal rank by h lines form an interval of the
suffix array whose longest common prefix is at least h.

A line is deleted if it lies in a run of lines that holds at least `min_words` words and also starts earlier
(lesser doc_id, then line number); runs never cross documents.  Such a run is the union of its least windows:
those that reach `min_words` from a line forward, and those that reach it from a line backward.  Which windows
are least depends on their own lines only, so every copy of one is compared.  A window of h to 2h - 1 lines is
named exactly by its length and two ranks by h lines: that of its start and that of the place h lines before
its end.  Windows of one name form an interval; its first member stays, the others are marked.  The rounds end
with the longest window, and the marked windows of a document join into its maximal repeated runs.

Edge cases: a null text is one empty line; a null doc_id sorts first; a row that repeats a doc_id is told
apart by its text's hash, and a row equal in both is treated as the same document (every copy gets the same
result); blank lines are lines; a very long text is split into lines inside its row, so its lines must fit a
task; extra columns are untouched whatever their names, but for names starting with `__`, which are reserved;
a line that many documents share is ranked once and its rank goes out to them; an empty table gives an empty
result.  A document whose lines are all marked keeps none: `text` is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import joined, written

_PLACE = ["d", "h", "pos"]


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(d, h, pos, line, more, words): the lines of each distinct (doc_id, text), with both halves of their ID."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"), F.xxhash64(t).alias("h"), F.posexplode(F.split(t, "\n", -1)).alias("pos", "l"))
    base = base.select(*_PLACE, F.xxhash64("l").alias("line"), F.xxhash64(F.lit(1), "l").alias("more"), F.size(F.array_remove(F.split("l", r"[ \x09-\x0D]+"), "")).alias("words"))
    return base.groupBy(*_PLACE).agg(F.first("line").alias("line"), F.first("more").alias("more"), F.first("words").alias("words"))


def least_windows(base: DataFrame, min_words: int) -> DataFrame:
    """(d, h, pos, run): the least windows of `lines`, each once.

    A window grows from one frame to the next, so a document of n lines takes n steps.
    """
    doc = Window.partitionBy("d", "h")
    x = base.withColumn("upto", F.sum("words").over(doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.col("upto") - F.col("words"))
    # the line that holds the min_words-th word from here, and the last line that ends min_words words before this one's end
    ahead = F.max(F.struct("pos", "upto")).over(doc.orderBy("before").rangeBetween(Window.unboundedPreceding, min_words - 1))
    back = F.max("pos").over(doc.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words))
    x = x.withColumn("ahead", ahead).withColumn("back", F.coalesce(back, F.lit(-1)))
    forward = F.when(F.col("ahead.upto") - F.col("before") >= min_words, F.struct("pos", (F.col("ahead.pos") - F.col("pos") + 1).alias("run")))
    backward = F.when(F.col("upto") >= min_words, F.struct((F.col("back") + 1).alias("pos"), (F.col("pos") - F.col("back")).alias("run")))
    return x.select("d", "h", F.explode(F.array(forward, backward)).alias("w")).where("w is not null").select("d", "h", "w.pos", "w.run").distinct()


def _ranked(pairs: DataFrame, total: int) -> DataFrame:
    """Positions (d, h, pos) whose pair (a, b) occurs more than once, with `rank` by (a, b) and the `first` of that rank.

    Distinct pairs are counted first, so a frequent pair is one row; a range sort numbers them in order.
    """
    distinct = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(F.struct(*_PLACE)).alias("first"))
    order = written(distinct.where("n > 1").orderBy("a", "b").select("a", "b", "first", "n", F.monotonically_increasing_id().alias("rank")))
    return joined(pairs, order, ["a", "b"], "n", total).select(*_PLACE, "rank", "first")


def repeated(docs: DataFrame, min_words: int = 20, text: str = "text") -> DataFrame:
    """(d, h, pos, run): least windows of `run` lines from line `pos` whose lines start earlier too."""
    base = written(lines(docs, text))
    windows = written(least_windows(base, min_words))
    longest, total = windows.agg(F.max("run")).first()[0] or 0, base.count()
    live, out, run, place = base.select(*_PLACE, F.col("line").alias("a"), F.col("more").alias("b")), None, 1, F.struct(*_PLACE)
    while run <= longest:
        # a position whose rank is unique can start no repeated window, now or later
        ranked = written(_ranked(live, total))
        if ranked.isEmpty():
            break
        mine = windows.where(F.col("run").between(run, 2 * run - 1)).join(ranked, _PLACE)
        found = mine.where((F.col("run") == run) & (place != F.col("first"))).select(*_PLACE, "run")
        out = found if out is None else out.unionByName(found)
        if run > 1 and longest > run:
            ends = ranked.select("d", "h", F.col("pos").alias("at"), F.col("rank").alias("last"))
            named = mine.where(F.col("run") > run).select(*_PLACE, "run", "rank", (F.col("pos") + F.col("run") - run).alias("at"))
            named = written(named.join(ends, ["d", "h", "at"]).select(*_PLACE, "run", "rank", "last"))
            first = named.groupBy("run", "rank", "last").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
            out = out.unionByName(joined(named, first, ["run", "rank", "last"], "n", named.count()).where(place != F.col("first")).select(*_PLACE, "run"))
        # both halves must be repeated runs of their own for the doubled one to be repeated
        other = ranked.select("d", "h", (F.col("pos") - run).alias("pos"), F.col("rank").alias("b"))
        live = written(ranked.select(*_PLACE, F.col("rank").alias("a")).join(other, _PLACE))
        run *= 2
    return out if out is not None else windows.limit(0)


def marks(docs: DataFrame, min_words: int = 20, text: str = "text") -> DataFrame:
    """(d, h, gone array<struct<pos, run>>): the marked windows of each document that has any."""
    return repeated(docs, min_words, text).groupBy("d", "h").agg(F.collect_set(F.struct("pos", "run")).alias("gone"))


def dedup(docs: DataFrame, min_words: int = 20, text: str = "text") -> DataFrame:
    """`docs` with `text` less its marked lines, and __lines, __removed, __longest (int): lines, deleted ones, those of the longest deleted run."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = marks(docs, min_words, text).select(F.col("d").alias("__md"), F.col("h").alias("__mh"), F.col("gone").alias("__gone"))
    keyed = docs.withColumn("__d", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn("__h", F.xxhash64(t))
    out = keyed.join(found, (F.col("__d") == F.col("__md")) & (F.col("__h") == F.col("__mh")), "left")
    out = out.withColumn("__all", F.split(t, "\n", -1)).withColumn("__lines", F.size("__all"))
    # distinct places of the marked windows, then the lines in between
    out = out.withColumn("__places", F.expr("coalesce(array_sort(array_distinct(flatten(transform(__gone, g -> sequence(g.pos, g.pos + g.run - 1))))), cast(array() as array<int>))"))
    out = out.withColumn("__removed", F.size("__places"))
    out = out.withColumn("__ends", F.expr("concat(array(-1), __places, array(__lines))"))
    # a place less its rank is the same along a run: a run's length is counted up while that holds
    longest = F.expr("aggregate(__places, named_struct('last', -2, 'n', 0, 'best', 0), (a, p) -> named_struct('last', p, 'n', if(p = a.last + 1, a.n + 1, 1), 'best', greatest(a.best, if(p = a.last + 1, a.n + 1, 1))), a -> a.best)")
    kept = F.expr("array_join(flatten(transform(slice(__ends, 1, size(__ends) - 1), (e, i) -> slice(__all, e + 2, __ends[i + 1] - e - 1))), '\n')")
    out = out.withColumn(text, F.when(F.col("__removed") == 0, F.col(text)).otherwise(kept))
    return out.select(*docs.columns, "__lines", "__removed", longest.alias("__longest"))


def keep(docs: DataFrame, min_words: int = 20, text: str = "text") -> DataFrame:
    """`docs` with later copies of repeated runs deleted; documents of which nothing is left are dropped."""
    return dedup(docs, min_words, text).where((F.col("__removed") == 0) | (F.length(F.regexp_replace(F.col(text), r"[ \x09-\x0D]+", "")) > 0)).select(*docs.columns)
