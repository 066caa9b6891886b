"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document.  The ledger keeps the measurements and one failure bit per
rule; a policy is a mask of rules, so applying or comparing policies never touches the texts again.

Edge cases: a very long text is measured whole, inside its row; a null text counts as the empty text (no words: fails `few_words`); a null doc_id is kept as
null; repeated rows are judged row by row; columns of `docs` named like a measurement are replaced in the ledger
and kept by `keep`; names starting with `__` are reserved; an empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule -> bit.  Bits are never reused; a changed threshold is a new rule.
RULES = {"few_words": 0, "repeated_windows": 1, "symbols": 2, "upper_case": 3, "exclamations": 4, "repeated_lines": 5, "word_length": 6}
#: Policy version -> rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "upper_case"),
    "v2": tuple(RULES),
}
SYMBOLS = "#*$%&|<>"


MEASURES = ("n_words", "word_chars", "n_lines", "n_dup_lines", "n_symbols", "n_bang", "n_upper", "n_repeat_words")


def mask(policy: str) -> int:
    return sum(1 << RULES[r] for r in POLICIES[policy])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_bang.

    Words are runs without ASCII white space.  Repeated 3-word windows are found inside the row, by equal
    hashes of 64 bits: each carries its place in the low bits, a primitive sort brings equal ones together, and
    the places are sorted again to count the words that such windows cover.  The bits given up to the place are
    compared afterwards; a text in which they differ between neighbours sorts its whole hashes.
    """
    none, place = "cast(array() as array<bigint>)", "(shiftleft(1L, __b) - 1)"
    out = (
        docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
        .withColumn("__w", F.array_remove(F.split("__t", r"[ \x09-\x0D]+"), ""))
        .withColumn("__x", F.expr("transform(__w, x -> xxhash64(x))"))
        .withColumn("__m", F.regexp_replace("__t", rf"[^{SYMBOLS}!\p{{Lu}}]+", ""))
        .withColumn("__l", F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(r"[^ \x09-\x0D]")))
        .withColumn("n_words", F.size("__x").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("__w", "")).cast("long"))
        .withColumn("n_lines", F.size("__l").cast("long"))
        .withColumn("n_dup_lines", (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace("__m", r"[!\p{Lu}]+", "")).cast("long"))
        .withColumn("n_bang", (F.length("__m") - F.length(F.replace("__m", F.lit("!")))).cast("long"))
        .withColumn("n_upper", F.length("__m").cast("long") - F.col("n_symbols") - F.col("n_bang"))
        # a window's hash: its words' hashes, shifted against each other
        .withColumn("__h", F.expr(f"if(n_words < 4, {none}, transform(slice(__x, 1, cast(n_words as int) - 2), (v, i) -> v ^ shiftleft(__x[i + 1], 1) ^ shiftleft(__x[i + 2], 2)))"))
        .withColumn("__b", F.expr("length(bin(n_words))"))
        .withColumn("__s", F.expr(f"if(size(array_distinct(__h)) = size(__h), {none}, sort_array(transform(__h, (v, i) -> shiftleft(shiftright(v, __b), __b) | i)))"))
        # the places of neighbours whose upper bits agree; where their whole hashes differ, whole hashes are sorted instead
        .withColumn("__mixed", F.expr(f"exists(transform(__s, (v, i) -> shiftright(v ^ get(__s, i + 1), __b) = 0 and get(__h, cast(v & {place} as int)) <> get(__h, cast(get(__s, i + 1) & {place} as int))), x -> coalesce(x, false))"))
        .withColumn("__e", F.expr("if(__mixed, sort_array(transform(__h, (v, i) -> struct(v as v, cast(i as bigint) as i))), cast(array() as array<struct<v: bigint, i: bigint>>))"))
        .withColumn("__p", F.expr(f"""if(__mixed,
            sort_array(transform(filter(__e, (x, i) -> coalesce(x.v = get(__e, i + 1).v, false) or coalesce(x.v = get(__e, i - 1).v, false)), x -> x.i)),
            sort_array(transform(filter(__s, (v, i) -> coalesce(shiftright(v ^ get(__s, i + 1), __b) = 0, false) or coalesce(shiftright(v ^ get(__s, i - 1), __b) = 0, false)), v -> v & {place})))"""))
        .withColumn("n_repeat_words", F.expr("aggregate(transform(__p, (v, i) -> least(3L, get(__p, i + 1) - v)), 0L, (a, v) -> a + v)"))
    )
    return out.drop("__t", "__w", "__x", "__m", "__b", "__mixed", "__e", "__h", "__s", "__p", "__l")


def rules() -> dict[str, Column]:
    c = F.col
    return {
        "few_words": c("n_words") < 50,
        "repeated_windows": 100 * c("n_repeat_words") > 50 * c("n_words"),
        "symbols": 10 * c("n_symbols") > c("n_words"),
        "upper_case": 10 * c("n_upper") > 3 * c("word_chars"),
        "exclamations": 10 * c("n_bang") > 3 * c("n_words"),
        "repeated_lines": (3 * c("n_dup_lines") > c("n_lines")) & (c("n_dup_lines") > 1),
        "word_length": (c("word_chars") > 15 * c("n_words")) | (c("word_chars") < 2 * c("n_words")),
    }


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with all measurements and `fail_bits` (long): bit RULES[r] is set where rule r rejects."""
    bits = F.lit(0).cast("long")
    for name, fails in rules().items():
        bits = bits + F.when(fails, F.lit(1 << RULES[name]).cast("long")).otherwise(F.lit(0).cast("long"))
    led = measure(docs, text).withColumn("fail_bits", bits)
    # the generator keeps a later filter from being pushed down and evaluated as one huge expression
    made = [c for c in led.columns if c in MEASURES or c == "fail_bits"]
    rest = [c for c in docs.columns if c not in made]
    return led.select(*rest, F.explode(F.array(F.struct(*made))).alias("__made")).select(*rest, "__made.*")


def passes(policy: str) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def keep(docs: DataFrame, policy: str = "v2", text: str = "text") -> DataFrame:
    """The rows of `docs` that `policy` accepts, with their columns."""
    own = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text"))
    return ledger(own, "__text").where(passes(policy)).select("__row.*")


def ablation(led: DataFrame) -> DataFrame:
    """Per policy and rule: documents, kept, rejected by the rule, rejected by it alone.

    One pass groups by the bit pattern (at most 2^rules patterns); everything else is bitwise on those.
    """
    patterns = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    plan = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(mask(p)).cast("long").alias("mask"), F.lit(r).alias("rule"), F.lit(1 << RULES[r]).cast("long").alias("bit")) for p in POLICIES for r in POLICIES[p]])
    x = patterns.withColumn("x", F.explode(plan)).select("n", "x.*", "fail_bits").withColumn("hit", F.col("fail_bits").bitwiseAND(F.col("mask")))
    n_if = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return x.groupBy("policy", "rule").agg(F.sum("n").alias("n_docs"), n_if(F.col("hit") == 0).alias("n_kept"), n_if(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("n_rule"), n_if(F.col("hit") == F.col("bit")).alias("n_rule_alone"))
