"""Registered queries of this subpackage: op1 .. op10 over whole tables, and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_words, context_tree, cross_polytope, line_suffixes, phrase_parsing, quality_ledger, simhash_tiles, slot_sharding, temperature_mix, toxic_sentences

SHARDS = [f"shard-{i:03d}" for i in range(64)]
RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents")).drop("n_bytes")


def op2_line_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_suffixes.dedup(docs).select("doc_id", F.col("__lines").cast("long").alias("n_lines"), F.col("__removed").cast("long").alias("n_removed"), F.col("__longest").cast("long").alias("longest_run"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH t AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
l AS (SELECT doc_id, pos, words, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto
      FROM (SELECT doc_id, pos, len(list_filter(regexp_split_to_array(l[pos], '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS pos FROM t))),
b AS (SELECT *, upto - words AS before FROM l),
x AS (SELECT b.doc_id, b.pos AS lo, e.pos AS hi FROM b ASOF JOIN (SELECT * FROM b WHERE words > 0) e ON b.doc_id = e.doc_id AND b.before + 20 <= e.upto
      UNION SELECT b.doc_id, s.pos, b.pos FROM b ASOF JOIN (SELECT * FROM b WHERE words > 0) s ON b.doc_id = s.doc_id AND b.upto - 20 >= s.before),
r AS (SELECT x.doc_id, lo, hi, row_number() OVER (PARTITION BY array_to_string(l[lo:hi], chr(10)) ORDER BY x.doc_id, lo) AS nth FROM x JOIN t ON t.doc_id = x.doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS pos FROM r WHERE nth > 1),
i AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM g) GROUP BY doc_id, k),
m AS (SELECT doc_id, sum(n)::BIGINT AS n_removed, max(n)::BIGINT AS longest_run FROM i GROUP BY doc_id),
p AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id)
SELECT t.doc_id, len(l)::BIGINT AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(longest_run, 0) AS longest_run,
       sha256(CASE WHEN gone IS NULL THEN coalesce(text, '') ELSE coalesce(array_to_string(list_filter(l, lambda y, k: NOT list_contains(gone, k)), chr(10)), '') END) AS kept_sha256
FROM t LEFT JOIN m ON m.doc_id = t.doc_id LEFT JOIN p ON p.doc_id = t.doc_id
"""


def op3_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_ledger.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("fail_bits").bitwiseAND(F.lit(quality_ledger.mask("base")).cast("long")) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), quality_ledger.passes("v2").alias("kept"), "fail_bits")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT doc_id, i, w[i] AS a, w[i+1] AS b, w[i+2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g),
p AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_bang
      FROM w LEFT JOIN p ON w.doc_id = p.doc_id),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_upper > 3 * word_chars THEN 8 ELSE 0 END
             + CASE WHEN 10 * n_bang > 3 * n_words THEN 16 ELSE 0 END + CASE WHEN 3 * n_dup_lines > n_lines AND n_dup_lines > 1 THEN 32 ELSE 0 END
             + CASE WHEN word_chars > 15 * n_words OR word_chars < 2 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM f
"""


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = temperature_mix.plan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", F.col("__tokens").alias("n_tokens"), F.round("__weight", 6).alias("weight"), F.col("__block").alias("block"), "copies")


_DRAW = "('0x' || substr(md5({} || ':' || {}), 1, 15))::BIGINT"
OP5_SQL = rf"""
WITH RECURSIVE b AS (SELECT doc_id, source, coalesce('=' || source, 'null') AS s, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS n FROM documents),
t AS (SELECT s, sum(n)::BIGINT AS total FROM b GROUP BY s),
k AS (SELECT count(*) AS k, max(total) / min(total) AS ratio FROM t WHERE total > 0),
ex AS (SELECT 0 AS r, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high UNION ALL
       SELECT r + 1, low + (high - low) * (i - 1) / 15, low + (high - low) * i / 15
       FROM (SELECT r, low, high, list_min(list_filter(range(0, 16), lambda j: pow(ratio, 1 - (low + (high - low) * j / 15)) <= 2.0)) AS i FROM ex, k) WHERE r < 8 AND i > 0),
a AS (SELECT CASE WHEN k <= 1 THEN 1.0 WHEN ratio <= 2.0 THEN 0.0 ELSE (SELECT arg_max(high, r) FROM ex) END AS a FROM k),
z AS (SELECT sum(pow(total::DOUBLE, a)) AS z, max(total / pow(total::DOUBLE, a)) AS r FROM t, a WHERE total > 0),
w AS (SELECT s, total, CASE WHEN total > 0 THEN pow(total::DOUBLE, a) / z ELSE 0 END AS weight, CASE WHEN total > 0 THEN round(pow(total::DOUBLE, a) / z * (r * z))::BIGINT END AS target FROM t, a, z),
w2 AS (SELECT s, weight, coalesce(target // greatest(total, 1), 1) AS passes, coalesce(target % greatest(total, 1), 0) AS rest, greatest(1, ceil(total / 200000))::BIGINT AS blocks FROM w),
p AS (SELECT *, (block * 2147483647 + {_DRAW.format("'18'", "s")}) % blocks AS place FROM (SELECT b.*, weight, passes, rest, blocks, {_DRAW.format("'17'", "coalesce(doc_id::VARCHAR, 'null')")} % blocks AS block FROM b JOIN w2 USING (s))),
c AS (SELECT s, place, rest, sum(n) AS size, sum(sum(n)) OVER (PARTITION BY s ORDER BY place) AS upto FROM p WHERE rest > 0 GROUP BY s, place, rest),
e AS (SELECT s, place AS edge, rest - upto + size AS l FROM c WHERE upto > rest AND upto - size <= rest AND size > 0),
d AS (SELECT s, id, sum(size) OVER (PARTITION BY s ORDER BY {_DRAW.format("'19'", "id")}, id) <= l AS taken FROM (SELECT p.s, coalesce(doc_id::VARCHAR, 'null') AS id, l, sum(n) AS size FROM p JOIN e ON e.s = p.s AND e.edge = p.place GROUP BY ALL))
SELECT doc_id, source, n AS n_tokens, round(weight, 6) AS weight, block, passes + CASE WHEN place < edge OR (place = edge AND taken) THEN 1 ELSE 0 END AS copies
FROM p LEFT JOIN e ON e.s = p.s LEFT JOIN d ON d.s = p.s AND d.id = coalesce(doc_id::VARCHAR, 'null')
"""


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_duplicates(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH RECURSIVE s AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
k AS (SELECT a.vec_id AS u, b.vec_id AS v FROM s a JOIN s b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
c AS (SELECT u, v FROM k UNION SELECT c.u, k.v FROM c JOIN k ON k.u = c.v),
n AS (SELECT u, count(*) AS n FROM k GROUP BY u),
m AS (SELECT u, min(v) AS v FROM c GROUP BY u)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m.v, vec_id)) AS component_id, least(vec_id, coalesce(m.v, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN m ON m.u = vec_id
"""


def op7_phrase_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_parsing.dedup(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p1 AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2198) AS h FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 1000)) AS base FROM t)),
w AS (SELECT doc_id, base + i AS i, substr(h, 2 * i + 1, 200) AS w FROM (SELECT doc_id, base, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM p1)),
f AS (SELECT w, min((doc_id, i)) AS first FROM w GROUP BY w HAVING count(*) > 1),
r AS (SELECT doc_id, i FROM w JOIN f USING (w) WHERE (doc_id, i) <> first),
j AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM r)),
s AS (SELECT doc_id, n, min(i) AS lo, max(i) + 100 AS hi FROM j GROUP BY doc_id, n),
p AS (SELECT doc_id, lo, hi, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY lo) AS upto FROM s),
m AS (SELECT p.doc_id, count(*) AS n_spans, sum(hi - lo)::BIGINT AS n_removed, max(hi) AS hi, string_agg(substr(h, 2 * upto + 1, 2 * (lo - upto)), '' ORDER BY lo) AS kept FROM p JOIN t ON t.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT t.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept || substr(h, 2 * hi + 1), h))) AS kept_sha256
FROM t LEFT JOIN m ON m.doc_id = t.doc_id
"""


def op8_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    return slot_sharding.place(docs, "doc_id", SHARDS).select("doc_id", "n_bytes", "slot", "shard")


def op9_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe_words.read_ranks(public_tokenizers.path(RANKS))
    return bpe_words.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_toxic_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxic_sentences.train(docs, table(spark, sf_dir, "labels"))
    return toxic_sentences.score(docs, model, locate=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_context_tree, op2_line_suffixes, op3_simhash_tiles, op4_quality_ledger, op5_temperature_mix, op6_cross_polytope, op7_phrase_parsing, op8_slot_sharding, op9_bpe_words, op10_toxic_sentences, pipeline)}
ORACLES = {"op2_line_suffixes": OP2_SQL, "op4_quality_ledger": OP4_SQL, "op5_temperature_mix": OP5_SQL, "op6_cross_polytope": OP6_SQL, "op7_phrase_parsing": OP7_SQL}
