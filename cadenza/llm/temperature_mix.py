"""Mixing sources to target weights by temperature (DataFrame functions only).

Source token shares p are raised to an exponent a and normalised: q ~ p^a.  The exponent is bisected (in
sections, one aggregate per round) until the weights' entropy reaches a target share of the maximum, or
until no source must be repeated more than a limit.  A token budget then turns q into whole passes over
each source plus a part of one more pass, taken as whole blocks in the order of a seeded permutation; the
block at the edge is filled document by document.

A document's block follows from its id and its source's number of blocks, so texts need not move to be
realised: the settings of the sources and the documents of the edge blocks go out to them.

Edge cases: a null source is a source of its own; null and empty texts have no tokens and follow their
block; a very long text is counted whole and never cut; repeated rows are placed one by one (equal doc_ids
share a block, and are taken or left together); documents of one permutation place are in order of a hash, then
of doc_id; columns of any other name than those starting with `__` are untouched; an empty table gives an empty
plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import joined, written

#: Sources and documents of edge blocks up to which their tables are broadcast; beyond, they are joined by shuffles with hot sources apart.
SMALL_SOURCES, SMALL_EDGE = 10_000, 500_000
#: A prime above any number of blocks; its multiples modulo the number of blocks visit every block once.
STRIDE = 2_147_483_647


def tokens(text: str = "text"):
    """Words of a text: runs without ASCII white space."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.size(F.array_remove(F.split(t, r"[ \x09-\x0D]+"), "")).cast("long")


def source_shares(docs: DataFrame) -> DataFrame:
    return docs.groupBy("__source").agg(F.sum("__tokens").alias("__total"), F.count("*").alias("__docs"))


def exponent(sources: DataFrame, entropy: float | None = None, repeats: float | None = None, budget: float | None = None, rounds: int = 8, sections: int = 15) -> float:
    """The largest exponent in [0, 1] whose weights have at least `entropy` x log(number of sources), or the
    smallest one at which no source is repeated over `repeats` times when the budget (None: the least that
    uses every source once) is spent.  1 if the raw shares already satisfy the target or nothing does so
    better; 0 if every exponent satisfies it.
    """
    live = sources.where("__total > 0")
    whole = live.agg(F.sum("__total").alias("t"), F.count("*").alias("k"), F.min("__total").alias("least"), F.max("__total").alias("most")).first()
    if not whole["k"] or whole["k"] == 1:
        return 1.0
    p = F.col("__total") / F.lit(float(whole["t"]))
    low, high = 0.0, 1.0
    for _ in range(rounds):
        grid = [low + (high - low) * i / sections for i in range(sections + 1)]
        row = live.agg(*[f for i, a in enumerate(grid) for f in (F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"l{i}"))]).first()
        good = []
        for i, a in enumerate(grid):
            z = row[f"z{i}"]
            if entropy is not None:  # falls as a grows
                good.append(math.log(z) - a * row[f"l{i}"] / z >= entropy * math.log(whole["k"]))
            elif budget is None:  # holds from some a on
                good.append((whole["most"] / whole["least"]) ** (1 - a) <= repeats)
            else:
                good.append(budget * (whole["least"] / whole["t"]) ** a / z / whole["least"] <= repeats)
        if entropy is not None:
            if good[-1] or not good[0]:
                return high if good[-1] else low
            i = max(j for j, g in enumerate(good) if g)
            low, high = grid[i], grid[i + 1]
        else:
            if good[0] or not good[-1]:
                return low if good[0] else high
            i = min(j for j, g in enumerate(good) if g)
            low, high = grid[i - 1], grid[i]
    return low if entropy is not None else high


def _source() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))


def _draw(seed: int, *what: Column) -> Column:
    """A number below 2^60 from the MD5 of a seed and some values."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(x.cast("string"), F.lit("null")) for x in what])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _place(rows: DataFrame, seed: int) -> DataFrame:
    """`rows` (doc_id, __source, __blocks) with __block and __place: the block's place in its source's permutation."""
    rows = rows.withColumn("__block", _draw(seed, F.col("doc_id")) % F.col("__blocks"))
    return rows.withColumn("__place", (F.col("__block") * STRIDE + _draw(seed + 1, F.col("__source"))) % F.col("__blocks"))


def _settings(base: DataFrame, entropy, repeats, budget, block_tokens: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Per source: __docs, __weight, __passes, __blocks, __edge (place of the block that the part pass fills in part; all before it are whole), and the documents (__source, __id) of the edge blocks that are in."""
    sources = written(source_shares(base))
    a = exponent(sources, entropy, repeats, None if budget is None else float(budget))
    size = F.col("__total").cast("double")
    total = sources.where("__total > 0").agg(F.sum(F.pow(size, F.lit(a))).alias("z"), F.max(size / F.pow(size, F.lit(a))).alias("r")).first()
    z = total["z"] or 1.0
    spend = float(budget) if budget is not None else (total["r"] or 0.0) * z
    live = F.col("__total") > 0
    w = sources.withColumn("__weight", F.when(live, F.pow(size, F.lit(a)) / F.lit(z)).otherwise(F.lit(0.0)))
    w = w.withColumn("__target", F.round(F.col("__weight") * F.lit(spend)).cast("long"))
    w = w.withColumn("__passes", F.when(live, F.expr("__target div greatest(__total, 1)")).otherwise(F.lit(1)).cast("long"))
    w = w.withColumn("__rest", F.when(live, F.col("__target") - F.col("__passes") * F.col("__total")).otherwise(F.lit(0)).cast("long"))
    w = written(w.withColumn("__blocks", F.greatest(F.lit(1), F.ceil(F.col("__total") / F.lit(block_tokens))).cast("long")))
    rows = written(_place(_with(base, w.select("__source", "__docs", "__rest", "__blocks"), base.count()).where("__rest > 0"), seed))
    # running sums over the places in two steps, of at most 1024 stretches and of the places of one stretch
    sizes = rows.groupBy("__source", "__place").agg(F.sum("__tokens").alias("__size"), F.first("__rest").alias("__rest"), F.first("__blocks").alias("__blocks"))
    sizes = written(sizes.withColumn("__stretch", F.expr("__place div ((__blocks + 1023) div 1024)")))
    upto = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, 0)
    coarse = sizes.groupBy("__source", "__stretch").agg(F.sum("__size").alias("__s")).withColumn("__before", F.sum("__s").over(upto("__source", "__stretch")) - F.col("__s")).drop("__s")
    fine = sizes.join(coarse, ["__source", "__stretch"]).withColumn("__upto", F.col("__before") + F.sum("__size").over(upto("__source", "__stretch", "__place")))
    edge = fine.where("__upto > __rest and __upto - __size <= __rest and __size > 0").select("__source", F.col("__place").alias("__edge"), (F.col("__rest") - F.col("__upto") + F.col("__size")).alias("__left"))
    edge = written(edge)
    mine = rows.join(edge, "__source").where("__place = __edge").withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    mine = mine.groupBy("__source", "__id", "__left").agg(F.sum("__tokens").alias("__size"))
    inside = Window.partitionBy("__source").orderBy(_draw(seed + 2, F.col("__id")), "__id").rowsBetween(Window.unboundedPreceding, 0)
    taken = written(mine.withColumn("__upto", F.sum("__size").over(inside)).where("__upto <= __left").select("__source", "__id"))
    return written(w.join(edge.drop("__left"), "__source", "left").select("__source", "__docs", "__weight", "__passes", "__blocks", "__edge")), taken


def _with(rows: DataFrame, sources: DataFrame, total: int) -> DataFrame:
    """`rows` with their source's columns: by a broadcast of few sources, otherwise with hot sources apart."""
    if sources.count() <= SMALL_SOURCES:
        return rows.join(F.broadcast(sources.drop("__docs")), "__source")
    return joined(rows, sources, ["__source"], "__docs", total)


def _copies(rows: DataFrame, sources: DataFrame, taken: DataFrame, total: int, seed: int) -> DataFrame:
    """`rows` (doc_id, __source) with __weight, __block and copies."""
    x = _place(_with(rows, sources, total), seed).withColumn("__id", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    few = taken.count() <= SMALL_EDGE
    hit = (F.broadcast(taken) if few else taken).withColumn("__taken", F.lit(1))
    if few:
        x = x.join(hit, ["__source", "__id"], "left")
    else:
        at_edge = F.coalesce(F.col("__place") == F.col("__edge"), F.lit(False))
        x = x.where(~at_edge).withColumn("__taken", F.lit(None).cast("int")).unionByName(x.where(at_edge).join(hit, ["__source", "__id"], "left"))
    extra = F.when(F.col("__place") < F.col("__edge"), F.lit(1)).when((F.col("__place") == F.col("__edge")) & (F.col("__taken") == 1), F.lit(1)).otherwise(F.lit(0))
    return x.withColumn("copies", (F.col("__passes") + extra).cast("long"))


def _counted(docs: DataFrame, text: str) -> DataFrame:
    # the texts are read once: the settings need their token counts only
    return written(docs.select("doc_id", "source", _source().alias("__source"), tokens(text).alias("__tokens")))


def plan(docs: DataFrame, entropy: float | None = None, repeats: float | None = 2.0, budget: int | None = None, block_tokens: int = 200_000, seed: int = 17, text: str = "text") -> DataFrame:
    """(doc_id, source) of each row with __source, __tokens, __weight (its source's), __block, `copies` (long): how often it is used.

    budget: tokens to spend; None: the least budget that uses every source at least once.
    """
    base = _counted(docs, text)
    sources, taken = _settings(base, entropy, repeats, budget, block_tokens, seed)
    return _copies(base, sources, taken, base.count(), seed).select("doc_id", "source", "__source", "__tokens", "__weight", "__block", "copies")


def realise(docs: DataFrame, entropy: float | None = None, repeats: float | None = 2.0, budget: int | None = None, block_tokens: int = 200_000, seed: int = 17, text: str = "text") -> DataFrame:
    """`docs` with each row as often as the plan uses it; columns as given."""
    base = _counted(docs, text)
    sources, taken = _settings(base, entropy, repeats, budget, block_tokens, seed)
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", _source().alias("__source"))
    out = _copies(rows, sources, taken, base.count(), seed).where("copies > 0")
    return out.select("__row", F.explode(F.expr("sequence(1L, copies)")).alias("__pass")).select("__row.*")
