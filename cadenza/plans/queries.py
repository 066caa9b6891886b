"""Registered queries of the engine, each over whole tables, with the same query in SQL.

The driver tables hold no subtitles, so cues, words, turns and lines are derived from `events`, `documents`
and `conversations`, with the same arithmetic on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import sizing, stamps
from ..functions import text as T
from ..operators import corrections, cues, intervals, matching, repair, review
from ..sources import bitmap, cuefiles, timings

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
GAP_MS = 600_000


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_cues(spark, sf_dir) -> DataFrame:
    """Events as cues of films of 16 users; every 7th repeats the number before, every 11th ends before it starts."""
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    d = F.floor(F.col("value") * 1000 + 0.5).cast("long") * F.expr("if(event_id % 11 = 0, -1, 1)")
    x = _t(spark, sf_dir, "events").select(F.expr("user_id div 16").alias("film_id"), F.col("event_type").alias("source"), F.col("event_id").alias("seq"), F.expr("event_id - if(event_id % 7 = 0, 1, 0)").alias("cue_id"), start.alias("start_ms"), d.alias("d"))
    return x.withColumn("end_ms", F.col("start_ms") + F.col("d")).withColumn("text", F.concat(F.col("source"), F.lit(" "), F.col("cue_id").cast("string"))).drop("d")


def v_words(spark, sf_dir) -> DataFrame:
    """Words of documents on film time, in chunks of 50 (pos: place in the chunk)."""
    # texts are dealt by film before they are cut: a shuffle of words is several times the input
    x = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("film_id"), "text").repartition("film_id")
    x = x.select("film_id", F.posexplode(F.array_remove(F.split("text", r"[ \x09-\x0D]+"), "")).alias("wn", "word"))
    d = (F.length("word") * 60).cast("long")
    gap = F.when(F.substring("word", -1, 1).isin(".", "!", "?"), 900).otherwise(50).cast("long")
    w = Window.partitionBy("film_id").orderBy("wn")
    x = x.withColumn("d", d).withColumn("g", gap).withColumn("end_ms", F.sum(F.col("d") + F.col("g")).over(w) - F.col("g"))
    return x.select("film_id", F.expr("wn div 50").alias("chunk_no"), F.expr("wn % 50").alias("pos"), "word", (F.col("end_ms") - F.col("d")).alias("start_ms"), "end_ms")


def v_cuts(spark, sf_dir) -> DataFrame:
    return v_words(spark, sf_dir).groupBy("film_id", "chunk_no").agg(F.min("start_ms").alias("start_ms"))


def v_chunk_words(spark, sf_dir) -> DataFrame:
    """Words with times relative to their chunk."""
    first = F.min("start_ms").over(Window.partitionBy("film_id", "chunk_no"))
    return v_words(spark, sf_dir).withColumn("at", first).select("film_id", "chunk_no", "pos", "word", (F.col("start_ms") - F.col("at")).alias("start_ms"), (F.col("end_ms") - F.col("at")).alias("end_ms"))


def v_turns(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("film_id"), F.col("turn").alias("seq"), "role", "text")


def v_lines(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("film_id"), "lang", F.posexplode(F.split("text", "\n", -1)).alias("seq", "text"))


_CUES = "v_cues AS (SELECT film_id, source, seq, cue_id, start_ms, start_ms + d AS end_ms, source || ' ' || cue_id AS text FROM (SELECT user_id // 16 AS film_id, event_type AS source, event_id AS seq, event_id - (event_id % 7 = 0)::INT AS cue_id, epoch_us(ts) // 1000 AS start_ms, floor(value * 1000 + 0.5)::BIGINT * (CASE WHEN event_id % 11 = 0 THEN -1 ELSE 1 END) AS d FROM events))"
_WORDS = r"v_words AS MATERIALIZED (SELECT film_id, wn // 50 AS chunk_no, wn % 50 AS pos, word, e - d AS start_ms, e AS end_ms, wn FROM (SELECT *, (sum(d + g) OVER (PARTITION BY film_id ORDER BY wn) - g)::BIGINT AS e FROM (SELECT film_id, wn, word, 60 * length(word) AS d, CASE WHEN regexp_matches(word, '[.!?]$') THEN 900 ELSE 50 END AS g FROM (SELECT doc_id AS film_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS wn FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)))))"
_CUTS = "v_cuts AS (SELECT film_id, chunk_no, min(start_ms) AS start_ms FROM v_words GROUP BY film_id, chunk_no)"
_LINES = "v_lines AS (SELECT film_id, lang, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS seq FROM (SELECT doc_id AS film_id, lang, string_split(text, chr(10)) AS l FROM documents))"
_TURNS = "v_turns AS (SELECT conv_id AS film_id, turn AS seq, role, text FROM conversations)"
_MISSED = "missed AS (SELECT * FROM v_cues r WHERE source = 'view' AND NOT EXISTS (SELECT 1 FROM v_cues c WHERE c.source = 'click' AND c.film_id = r.film_id AND c.end_ms > r.start_ms - 500 AND c.start_ms < r.end_ms + 500))"
_RUNS = f"runs AS (SELECT film_id, run, min(start_ms) AS start_ms, arg_max(end_ms, (start_ms, seq)) AS end_ms, count(*) AS n_cues FROM (SELECT *, sum(new) OVER (PARTITION BY film_id ORDER BY start_ms, seq) AS run FROM (SELECT *, CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY film_id ORDER BY start_ms, seq) < {GAP_MS} THEN 0 ELSE 1 END AS new FROM missed)) GROUP BY film_id, run)"


def query(sql: str = "", *views: str):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = (f"WITH RECURSIVE {', '.join(views)} " if views else "") + sql
        return f

    return add


def _missed(spark, sf_dir) -> DataFrame:
    c = v_cues(spark, sf_dir)
    return intervals.uncovered(c.where("source = 'view'"), c.where("source = 'click'"))


def _runs(spark, sf_dir) -> DataFrame:
    return cues.runs(_missed(spark, sf_dir), GAP_MS, order=("start_ms", "seq"))


def flagship(spark, sf_dir) -> DataFrame:
    return _runs(spark, sf_dir).orderBy("film_id", "start_ms")


@query("SELECT film_id, count(*) AS n_cues, count(*) FILTER (end_ms > nxt) AS n_overlaps, count(*) FILTER (start_ms > nxt) AS n_backward, count(*) FILTER (cue_id <> n) AS n_misnumbered, count(*) FILTER (end_ms <= start_ms) AS n_empty, median(end_ms - start_ms)::DOUBLE AS median_ms, max(end_ms - start_ms) AS longest_ms, arg_max(end_ms, seq) - arg_min(start_ms, seq) AS span_ms, (count(*) FILTER (end_ms > nxt) + count(*) FILTER (start_ms > nxt) + count(*) FILTER (cue_id <> n) + count(*) FILTER (end_ms <= start_ms)) = 0 AS passed FROM (SELECT *, lead(start_ms) OVER w AS nxt, row_number() OVER w AS n FROM v_cues WINDOW w AS (PARTITION BY film_id ORDER BY seq)) GROUP BY film_id", _CUES)
def qa_structure(spark, sf_dir):
    return cues.structure(v_cues(spark, sf_dir))


@query("SELECT film_id, seq, round(CASE WHEN d > 0 THEN length(text) * 1000.0 / d END, 6)::DOUBLE AS cps, coalesce(d > 0 AND length(text) * 1000.0 / d > 25, false) AS too_fast, false AS too_many_lines, length(text) > 45 AS too_long FROM (SELECT *, end_ms - start_ms AS d FROM v_cues)", _CUES)
def cue_cps_flags(spark, sf_dir):
    x = cues.reading_speed(v_cues(spark, sf_dir).withColumn("lines", F.array("text")))
    return x.select("film_id", "seq", F.round("cps", 6).alias("cps"), "too_fast", "too_many_lines", "too_long")


@query("SELECT l.film_id, l.cue_id, coalesce((SELECT string_agg(r.text, ' / ' ORDER BY r.seq) FROM v_cues r WHERE r.source = 'click' AND r.film_id = l.film_id AND r.end_ms > l.start_ms - 1200 AND r.start_ms < l.end_ms + 1200), '') AS window_text FROM v_cues l WHERE l.source = 'view'", _CUES)
def overlap_window(spark, sf_dir):
    c = v_cues(spark, sf_dir)
    return intervals.windows(c.where("source = 'view'"), c.where("source = 'click'"), 1200).select("film_id", "cue_id", F.col("window").alias("window_text"))


@query("SELECT l.film_id, l.cue_id, r.cue_id AS other_id FROM v_cues l JOIN v_cues r ON r.film_id = l.film_id AND r.end_ms >= l.start_ms - 10000 AND r.start_ms <= l.end_ms + 10000 WHERE l.source = 'purchase' AND r.source = 'click'", _CUES)
def overlap_inclusive(spark, sf_dir):
    c = v_cues(spark, sf_dir)
    pairs = intervals.overlaps(c.where("source = 'purchase'"), c.where("source = 'click'"), 10_000, inclusive=True)
    return pairs.select("film_id", F.col("l_cue_id").alias("cue_id"), F.col("r_cue_id").alias("other_id"))


@query("SELECT film_id, cue_id, start_ms, end_ms FROM missed", _CUES, _MISSED)
def coverage_anti(spark, sf_dir):
    return _missed(spark, sf_dir).select("film_id", "cue_id", "start_ms", "end_ms")


@query("SELECT film_id, start_ms, end_ms, n_cues FROM runs", _CUES, _MISSED, _RUNS)
def missed_runs(spark, sf_dir):
    return _runs(spark, sf_dir).drop("run")


@query("SELECT film_id, start_ms, end_ms, n_cues FROM runs WHERE n_cues >= 3 ORDER BY end_ms - start_ms DESC, start_ms, film_id LIMIT 6", _CUES, _MISSED, _RUNS)
def top_gaps(spark, sf_dir):
    return cues.top_gaps(_runs(spark, sf_dir).drop("run"))


_SPANS = "spans AS (SELECT film_id, seq AS span_id, start_ms, end_ms FROM v_cues WHERE source = 'purchase')"
_SPAN_SOURCES = "span_sources AS (SELECT s.film_id, s.span_id, l.source, coalesce((SELECT count(*) FROM v_cues r WHERE r.source = l.source AND r.film_id = s.film_id AND r.end_ms >= s.start_ms - 600000 AND r.start_ms <= s.end_ms + 600000), 0)::BIGINT AS n_cues, coalesce((SELECT sum(length(r.text)) FROM v_cues r WHERE r.source = l.source AND r.film_id = s.film_id AND r.end_ms >= s.start_ms - 600000 AND r.start_ms <= s.end_ms + 600000), 0)::BIGINT AS chars FROM spans s, (SELECT unnest(['click', 'error', 'none']) AS source) l)"


def _spans(spark, sf_dir) -> DataFrame:
    return v_cues(spark, sf_dir).where("source = 'purchase'").withColumn("span_id", F.col("seq"))


@query("SELECT film_id, span_id, source, n_cues, chars FROM span_sources", _CUES, _SPANS, _SPAN_SOURCES)
def span_sources(spark, sf_dir):
    return review.span_sources(_spans(spark, sf_dir), v_cues(spark, sf_dir), ["click", "error", "none"], 600_000)


@query("SELECT b.film_id, b.span_id, own_cues, own_chars, other_chars, best_source, other_chars > 2 * own_chars AND other_chars > 40 AS swallowed FROM (SELECT film_id, span_id, max(chars) AS other_chars, CASE WHEN max(chars) > 0 THEN arg_max(source, (chars, source)) END AS best_source FROM span_sources GROUP BY film_id, span_id) b JOIN (SELECT s.film_id, s.span_id, count(r.text) AS own_cues, coalesce(sum(length(r.text)), 0)::BIGINT AS own_chars FROM spans s LEFT JOIN v_cues r ON r.source = 'view' AND r.film_id = s.film_id AND r.end_ms >= s.start_ms - 600000 AND r.start_ms <= s.end_ms + 600000 GROUP BY s.film_id, s.span_id) o ON b.film_id = o.film_id AND b.span_id = o.span_id", _CUES, _SPANS, _SPAN_SOURCES)
def swallowed_flag(spark, sf_dir):
    c = v_cues(spark, sf_dir)
    return review.swallowed_spans(_spans(spark, sf_dir), c.where("source = 'view'"), c, ["click", "error", "none"], 600_000)


@query("SELECT film_id, chunk_no, pos, start_ms - lag(end_ms) OVER (PARTITION BY film_id ORDER BY start_ms, chunk_no, pos) AS gap_ms FROM v_words", _WORDS)
def word_gaps(spark, sf_dir):
    return cues.word_gaps(v_words(spark, sf_dir)).select("film_id", "chunk_no", "pos", "gap_ms")


_NUMBERED = "w AS MATERIALIZED (SELECT film_id, i, word, s, e, n, c, lag(e) OVER f AS pe, lag(word) OVER f AS pw FROM (SELECT film_id, word, start_ms AS s, end_ms AS e, length(word) AS n, row_number() OVER f AS i, sum(length(word) + 1) OVER f AS c FROM v_words WINDOW f AS (PARTITION BY film_id ORDER BY start_ms, chunk_no, pos)) WINDOW f AS (PARTITION BY film_id ORDER BY i))"
# from each word, were it the first of a cue, the word that opens the next one: 84 characters hold 42 words at most
_NEXT = "nxt AS MATERIALIZED (SELECT a.film_id, a.i, min(b.i) AS j FROM (SELECT *, unnest(range(1, 44)) AS o FROM w) a JOIN w b ON b.film_id = a.film_id AND b.i = a.i + a.o WHERE b.s - b.pe > 800 OR b.e - a.s > 6000 OR b.c - a.c + a.n > 84 OR (regexp_matches(b.pw, '[.!?]$') AND b.c - a.c + a.n > 40) GROUP BY a.film_id, a.i)"
_FIRSTS = "firsts AS (SELECT DISTINCT film_id, 1::BIGINT AS i FROM w UNION ALL SELECT nxt.film_id, nxt.j FROM firsts JOIN nxt ON nxt.film_id = firsts.film_id AND nxt.i = firsts.i)"
_GREEDY = "greedy AS (SELECT film_id, cue_id, min(s) AS start_ms, arg_max(e, i) AS end_ms, string_agg(word, ' ' ORDER BY i) AS text FROM (SELECT w.*, (count(f.i) OVER (PARTITION BY w.film_id ORDER BY w.i))::INTEGER AS cue_id FROM w LEFT JOIN firsts f ON f.film_id = w.film_id AND f.i = w.i) GROUP BY film_id, cue_id)"


@query("SELECT * FROM greedy", _WORDS, _NUMBERED, _NEXT, _FIRSTS, _GREEDY)
def greedy_cues(spark, sf_dir):
    return cues.group_words(v_words(spark, sf_dir))


@query("SELECT film_id, cue_id, start_ms, CASE WHEN e2 <= start_ms THEN start_ms + 900 ELSE e2 END AS end_ms FROM (SELECT *, coalesce(least(e1, nxt - 40), e1) AS e2 FROM (SELECT *, CASE WHEN f - start_ms < need THEN least(start_ms + need, greatest(f, coalesce(nxt - 80, end_ms + 2500))) ELSE f END AS e1 FROM (SELECT *, greatest(end_ms, start_ms + 900) AS f, length(text) * 50 AS need, lead(start_ms) OVER (PARTITION BY film_id ORDER BY start_ms, seq) AS nxt FROM v_cues)))", _CUES)
def cue_extend(spark, sf_dir):
    return cues.extend(v_cues(spark, sf_dir)).select("film_id", "cue_id", "start_ms", "end_ms")


@query("SELECT film_id, chunk_no, pos, raw_ms, raw_ms > 1500 AS suspect, start_ms + least(raw_ms, least(4500, greatest(1200, 120 * length(trim(word))))) AS end_ms FROM (SELECT *, 3 * (end_ms - start_ms) AS raw_ms FROM v_words)", _WORDS)
def clamp_words(spark, sf_dir):
    slow = v_words(spark, sf_dir).withColumn("end_ms", F.col("start_ms") + 3 * (F.col("end_ms") - F.col("start_ms")))
    return cues.clamp(slow, 1500).select("film_id", "chunk_no", "pos", "raw_ms", "suspect", "end_ms")


@query("SELECT film_id, cue_id, gap_ms, m AS middle_ms FROM (SELECT film_id, cue_id, gap_ms, end_ms + gap_ms / 2 AS m, row_number() OVER (PARTITION BY film_id, cue_id ORDER BY gap_ms DESC, wn) AS n FROM (SELECT w.film_id, w.start_ms // 30000 AS cue_id, w.wn, w.end_ms, lead(w.start_ms) OVER (PARTITION BY w.film_id, w.start_ms // 30000 ORDER BY w.wn) - w.end_ms AS gap_ms FROM v_words w) WHERE gap_ms > 0) WHERE n = 1", _WORDS)
def max_inner_gap(spark, sf_dir):
    w = v_words(spark, sf_dir)
    last = w.groupBy("film_id").agg(F.max("start_ms").alias("t"))
    spans = last.select("film_id", F.explode(F.expr("sequence(0L, t div 30000)")).alias("cue_id")).select("film_id", "cue_id", (F.col("cue_id") * 30_000).alias("start_ms"), (F.col("cue_id") * 30_000 + 29_999).alias("end_ms"))
    return cues.inner_silence(spans, w)


_NB = "[\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


def _spaced_sql(mid: str) -> str:
    first = f"regexp_replace(text, '{_NB}+([,.])', '\\1', 'g')"
    return f"SELECT film_id, seq, md5(regexp_replace(regexp_replace(regexp_replace({first}, {mid}, 'g'), '{_NB}{{2,}}', ' ', 'g'), '^{_NB}+|{_NB}+$', '', 'g')) AS text_md5 FROM v_lines"


@query(_spaced_sql(f"'{_NB}*([!?;:])', ' \\1'"), _LINES)
def punct_spacing_fr(spark, sf_dir):
    return v_lines(spark, sf_dir).select("film_id", "seq", F.md5(T.spacing(F.col("text"), "fr")).alias("text_md5"))


@query(_spaced_sql(f"'{_NB}+([!?;:])', '\\1'"), _LINES)
def punct_spacing_en(spark, sf_dir):
    return v_lines(spark, sf_dir).select("film_id", "seq", F.md5(T.spacing(F.col("text"), "en")).alias("text_md5"))


_OCR1 = "regexp_replace(regexp_replace(replace(text, 'I!', '!'), '!I([^A-Za-zÀ-ÿ]|$)', '!\\1', 'g'), '!I([^A-Za-zÀ-ÿ]|$)', '!\\1', 'g')"
_OCR2 = f"regexp_replace(regexp_replace({_OCR1}, '({T.BEFORE_MARK}){_NB}+I$', '\\1 !'), '\\{{u([^\\p{{L}}\\p{{N}}\\p{{M}}_]|$)', 'tu\\1', 'g')"
_OCR3 = f"translate(regexp_replace(replace(replace({_OCR2}, '{{', ''), '|', 'l'), 'ï[ií]', 'î', 'g'), '’‘“”', '''''\"\"')"
_OCR4 = f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({_OCR3}, '{_NB}+([,.])', '\\1', 'g'), '{_NB}*([!?;:])', ' \\1', 'g'), '{_NB}{{2,}}', ' ', 'g'), '^{_NB}+|{_NB}+$', '', 'g')"
_FIXED = f"fixed AS (SELECT film_id, seq, text, {_OCR4} AS fixed FROM v_lines)"


@query("SELECT film_id, seq, md5(fixed) AS text_md5, fixed <> text AS changed FROM fixed WHERE fixed <> ''", _LINES, _FIXED)
def ocr_repair(spark, sf_dir):
    x = v_lines(spark, sf_dir).withColumn("fixed", T.ocr_line(F.col("text"), "fr"))
    return x.where("fixed <> ''").select("film_id", "seq", F.md5("fixed").alias("text_md5"), (F.col("fixed") != F.col("text")).alias("changed"))


@query("SELECT film_id, count(*) FILTER (fixed <> text) AS n_changed, md5(string_agg(fixed, chr(10) ORDER BY seq) FILTER (fixed <> '')) AS text_md5 FROM fixed GROUP BY film_id HAVING count(*) FILTER (fixed <> '') > 0", _LINES, _FIXED)
def ocr_clean(spark, sf_dir):
    """Every document a cue of many lines: changed lines counted, emptied ones dropped, and cues of which nothing is left."""
    x = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("film_id"), F.split("text", "\n", -1).alias("lines"))
    return corrections.clean_lines(x, "fr").select("film_id", F.col("n_changed").cast("long").alias("n_changed"), F.md5(F.array_join("lines", "\n")).alias("text_md5"))


@query("SELECT film_id, chunk_no, pos, regexp_replace(lower(word), '[^a-zà-ÿ0-9'']', '', 'g') AS token FROM v_words", _WORDS)
def token_norm(spark, sf_dir):
    return v_words(spark, sf_dir).select("film_id", "chunk_no", "pos", T.normal(F.col("word")).alias("token"))


_TOK = "tok AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+(?:''[A-Za-zÀ-ÿ]+)?')) AS word FROM documents)"


def _tokens(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("word"))


@query("SELECT word, count(*) AS n FROM tok GROUP BY word", _TOK)
def word_freq(spark, sf_dir):
    return _tokens(spark, sf_dir).groupBy("word").agg(F.count("*").alias("n"))


@query("SELECT word, array_to_string(list_sort(list(doc_id))[1:2], ',') AS first_docs FROM (SELECT DISTINCT word, doc_id FROM tok) GROUP BY word", _TOK)
def word_index_top2(spark, sf_dir):
    two = _tokens(spark, sf_dir).distinct().withColumn("n", F.row_number().over(Window.partitionBy("word").orderBy("doc_id"))).where("n <= 2")
    return two.groupBy("word").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("first_docs"))


@query("SELECT DISTINCT word, regexp_matches(word, '^[A-ZÀ-ÖØ-Þ]') AS capitalised FROM tok WHERE lower(word) NOT IN (SELECT lower(w) FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+(?:''[A-Za-zÀ-ÿ]+)?')) AS w FROM benchmark))", _TOK)
def dict_anti(spark, sf_dir):
    known = _t(spark, sf_dir, "benchmark").select(F.explode(T.tokens(F.col("text"))).alias("w")).select(F.lower("w").alias("low")).distinct()
    return _tokens(spark, sf_dir).select("word").distinct().withColumn("low", F.lower("word")).join(known, "low", "left_anti").select("word", F.col("word").rlike("^[A-ZÀ-ÖØ-Þ]").alias("capitalised"))


_FOREIGN = ", ".join("'" + w.replace("'", "''") + "'" for w in T.FOREIGN)


@query(f"SELECT film_id, seq, round(CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: x IN ({_FOREIGN})))::DOUBLE / len(w) ELSE 0 END, 6) AS share FROM (SELECT film_id, seq, regexp_extract_all(lower(text), '[A-Za-zÀ-ÿ'']+') AS w FROM v_lines)", _LINES)
def foreign_share(spark, sf_dir):
    return v_lines(spark, sf_dir).select("film_id", "seq", F.round(T.foreign_share(F.col("text")), 6).alias("share"))


@query("SELECT film_id, seq FROM v_lines WHERE length(regexp_replace(text, '[^\\p{L}]', '', 'g')) > 0 AND 100 * length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) > 85 * length(regexp_replace(text, '[^\\p{L}]', '', 'g'))", _LINES)
def sign_lines(spark, sf_dir):
    return v_lines(spark, sf_dir).where(T.is_sign(F.col("text"))).select("film_id", "seq")


@query("SELECT text AS line, count(*) AS n FROM v_lines GROUP BY text HAVING count(*) > 1", _LINES)
def repeat_lines(spark, sf_dir):
    return v_lines(spark, sf_dir).groupBy(F.col("text").alias("line")).agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT film_id, seq FROM v_lines WHERE regexp_matches(lower(text), 'sous-titrage|subtitle|amara|merci d''avoir regardé|thanks for watching|abonnez-vous')", _LINES)
def boilerplate_lines(spark, sf_dir):
    return v_lines(spark, sf_dir).where(T.is_boilerplate(F.col("text"))).select("film_id", "seq")


@query("SELECT film_id, min(seq) AS first_seq, max(seq) AS last_seq, sum(n)::BIGINT AS n_words FROM (SELECT *, sum(CASE WHEN bare THEN 0 ELSE 1 END) OVER (PARTITION BY film_id ORDER BY seq) AS run FROM (SELECT *, n > 0 AND NOT regexp_matches(text, '[.!?,:;]') AS bare FROM (SELECT *, len(list_filter(regexp_split_to_array(text, '[ \\x09-\\x0D]+'), lambda x: x <> '')) AS n FROM v_lines))) WHERE bare GROUP BY film_id, run HAVING sum(n) >= 2", _LINES)
def bare_runs(spark, sf_dir):
    return cues.bare_runs(v_lines(spark, sf_dir), 2).select("film_id", "first_seq", "last_seq", F.col("n_words").cast("long").alias("n_words"))


@query("SELECT film_id, seq, row_number() OVER (PARTITION BY film_id ORDER BY seq)::INTEGER AS cue_id FROM v_turns WHERE role <> 'system'", _TURNS)
def renumber(spark, sf_dir):
    return cues.renumber(v_turns(spark, sf_dir).where("role <> 'system'"), order=("seq",)).select("film_id", "seq", "cue_id")


@query("SELECT film_id, lo, hi, CASE WHEN hi < n THEN hi + 1 END AS next_lo, CASE WHEN hi < n THEN least(hi + 1 + hi - lo, n) END AS next_hi FROM (SELECT film_id, n, lo, least(lo + 149, n) AS hi FROM (SELECT film_id, n, unnest(range(1, n + 1, 150)) AS lo FROM (SELECT film_id, max(cue_id) AS n FROM v_cues GROUP BY film_id)))", _CUES)
def batch_tiles(spark, sf_dir):
    return cues.tiles(v_cues(spark, sf_dir)).select("film_id", "lo", "hi", "next_lo", "next_hi")


_RULES = [(r"the\s+the", "the"), (r"([a-z]+)ing ", r"\1in' "), (r"on the", "upon the")]


@query("SELECT film_id, seq, md5(t) AS text_md5, t <> text AS changed FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(text, 'the[ \\x09-\\x0D]+the', 'the', 'g'), '([a-z]+)ing ', '\\1in'' ', 'g'), 'on the', 'upon the', 'g') AS t FROM v_lines)", _LINES)
def rule_rewrite(spark, sf_dir):
    return corrections.apply_rules(v_lines(spark, sf_dir), _RULES).select("film_id", "seq", F.md5("text").alias("text_md5"), "changed")


@query("SELECT pattern, count(*) AS n_cues FROM (SELECT CASE WHEN regexp_matches(trim(regexp_replace(text, '[ \\x09-\\x0D]+', ' ', 'g')), 'the[ \\x09-\\x0D]+the') THEN 'the the' END AS pattern FROM v_lines UNION ALL SELECT CASE WHEN regexp_matches(trim(regexp_replace(text, '[ \\x09-\\x0D]+', ' ', 'g')), 'on[ \\x09-\\x0D]+the') THEN 'on the' END FROM v_lines) WHERE pattern IS NOT NULL GROUP BY pattern", _LINES)
def rule_residual(spark, sf_dir):
    return corrections.residual(v_lines(spark, sf_dir), ["the the", "on the"])


@query("SELECT film_id, seq FROM v_lines WHERE NOT regexp_matches(lower(text), '(copyright|all rights)')", _LINES)
def drop_matching(spark, sf_dir):
    return corrections.apply_rules(v_lines(spark, sf_dir), [], drop=["copyright", "all rights"]).select("film_id", "seq")


_TERMS = ["the", "of", "is"]


_TERM_SQL = " UNION ALL ".join(f"SELECT film_id, '{t}' AS term, min(seq) AS cue_id FROM v_lines WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_]){t}($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])') GROUP BY film_id" for t in _TERMS)


@query(_TERM_SQL, _LINES)
def first_match_per_term(spark, sf_dir):
    x = v_lines(spark, sf_dir).withColumn("cue_id", F.col("seq")).withColumn("start_ms", F.col("seq"))
    return review.first_match(x, _TERMS).select("film_id", "term", "cue_id")


_TIERED = "tiered AS (SELECT *, CASE WHEN seq % 3 = 0 THEN 'both' WHEN seq % 3 = 1 THEN 'one' ELSE 'none' END AS tier, (seq % 5)::INTEGER AS n FROM v_cues)"
_RANKED = "ranked AS (SELECT *, row_number() OVER (PARTITION BY film_id ORDER BY CASE tier WHEN 'both' THEN 0 WHEN 'one' THEN 1 ELSE 2 END, n DESC, start_ms, seq)::INTEGER AS rank FROM tiered)"


def _tiered(spark, sf_dir) -> DataFrame:
    tier = F.when(F.col("seq") % 3 == 0, "both").when(F.col("seq") % 3 == 1, "one").otherwise("none")
    return v_cues(spark, sf_dir).withColumn("tier", tier).withColumn("agreed", F.expr("slice(array(1, 2, 3, 4), 1, cast(seq % 5 as int))"))


@query("SELECT film_id, cue_id, tier, n, rank FROM ranked", _CUES, _TIERED, _RANKED)
def rank_review(spark, sf_dir):
    return review.ranked(_tiered(spark, sf_dir)).select("film_id", "cue_id", "tier", F.size("agreed").alias("n"), "rank")


@query("SELECT film_id, cue_id, rank FROM ranked WHERE cue_id BETWEEN 150 AND 5000 AND tier = 'both'", _CUES, _TIERED, _RANKED)
def review_list(spark, sf_dir):
    return review.selected(review.ranked(_tiered(spark, sf_dir)), 150, 5000, "both").select("film_id", "cue_id", "rank")


@query("SELECT film_id, count(*) AS n_cues, count(*) FILTER (tier = 'both') AS n_both, count(*) FILTER (tier = 'one') AS n_one, count(*) FILTER (tier = 'none') AS n_none, round(count(*) FILTER (tier = 'both') / count(*), 6) AS share_both FROM tiered GROUP BY film_id", _CUES, _TIERED)
def tier_shares(spark, sf_dir):
    return review.tier_shares(_tiered(spark, sf_dir)).select("film_id", "n_cues", "n_both", "n_one", "n_none", F.round("share_both", 6).alias("share_both"))


@query("SELECT count(*) AS n_known, count(rank) AS n_caught, min(rank) AS best_rank, round(count(rank) / count(*), 6) AS recall FROM v_cues v LEFT JOIN (SELECT film_id AS f, seq AS q, rank FROM ranked WHERE tier = 'both') r ON r.f = v.film_id AND r.q = v.seq WHERE v.seq % 5 = 2", _CUES, _TIERED, _RANKED)
def detector_recall(spark, sf_dir):
    flags = review.selected(review.ranked(_tiered(spark, sf_dir)), tier="both")
    return review.recall(flags, v_cues(spark, sf_dir).where("seq % 5 = 2"), ("film_id", "seq")).withColumn("recall", F.round("recall", 6))


@query("SELECT film_id, bucket, median(delta)::DOUBLE AS median_ms, count(*) AS n FROM (SELECT film_id, delta, least(9, coalesce(floor((start_ms - lo) * 10 / nullif(hi - lo, 0)), 0))::INTEGER AS bucket FROM (SELECT film_id, start_ms, end_ms - start_ms AS delta, min(start_ms) OVER (PARTITION BY film_id) AS lo, max(start_ms) OVER (PARTITION BY film_id) AS hi FROM v_cues)) GROUP BY film_id, bucket", _CUES)
def drift_buckets(spark, sf_dir):
    return review.drift(v_cues(spark, sf_dir).withColumn("delta_ms", F.col("end_ms") - F.col("start_ms")))


@query("SELECT c.film_id, c.seq FROM v_cues c WHERE EXISTS (SELECT 1 FROM v_cues s WHERE s.source = 'purchase' AND s.film_id = c.film_id AND c.start_ms BETWEEN s.start_ms AND s.end_ms)", _CUES)
def song_ranges(spark, sf_dir):
    c = v_cues(spark, sf_dir)
    return intervals.starts_within(c, c.where("source = 'purchase'").select("film_id", "start_ms", "end_ms")).select("film_id", F.col("l_seq").alias("seq")).distinct()


@query("SELECT film_id, at_ms FROM (SELECT film_id, start_ms AS at_ms FROM v_cues UNION SELECT film_id, end_ms FROM v_cues) EXCEPT SELECT film_id, at_ms FROM (SELECT film_id, start_ms AS at_ms FROM v_cues WHERE source <> 'view' UNION SELECT film_id, end_ms FROM v_cues WHERE source <> 'view')", _CUES)
def set_lost_stamps(spark, sf_dir):
    c = v_cues(spark, sf_dir)
    return corrections.stamps_survive(c, c.where("source <> 'view'"))


_QUIET = "quiet AS MATERIALIZED (SELECT film_id, start_ms - gap_ms AS at_ms FROM (SELECT *, start_ms - lag(end_ms) OVER (PARTITION BY film_id ORDER BY wn) AS gap_ms FROM v_words) WHERE gap_ms >= 400), films AS (SELECT film_id, max(end_ms) AS duration_ms FROM v_words GROUP BY film_id)"
_PLAN = "plan AS (SELECT film_id, duration_ms, 0 AS chunk_no, 0::BIGINT AS cut_ms FROM films UNION ALL SELECT p.film_id, p.duration_ms, p.chunk_no + 1, coalesce(n.at_ms, p.cut_ms + 8000) FROM plan p LEFT JOIN (SELECT q.film_id, q.cut_ms, arg_min(s.at_ms, (abs(s.at_ms - q.cut_ms - 8000), s.at_ms)) AS at_ms FROM plan q JOIN quiet s ON s.film_id = q.film_id AND 6 * abs(s.at_ms - q.cut_ms - 8000) < 8000 GROUP BY q.film_id, q.cut_ms) n ON n.film_id = p.film_id AND n.cut_ms = p.cut_ms WHERE 5 * (p.cut_ms + 8000) < 5 * p.duration_ms - 8000)"


@query("SELECT film_id, chunk_no, cut_ms FROM plan UNION ALL SELECT film_id, max(chunk_no) + 1, max(duration_ms) FROM plan GROUP BY film_id", _WORDS, _QUIET, _PLAN)
def cut_plan(spark, sf_dir):
    w = v_words(spark, sf_dir)
    films = w.groupBy("film_id").agg(F.max("end_ms").alias("duration_ms"))
    silences = cues.word_gaps(w).where("gap_ms >= 400").select("film_id", (F.col("start_ms") - F.col("gap_ms")).alias("at_ms"))
    return cues.cut_points(films, silences, 8000)


@query("SELECT film_id, cue_id, printf('%02d:%02d:%02d,%03d', d // 3600000, d // 60000 % 60, d // 1000 % 60, d % 1000) AS stamp, printf('%02d:%02d', d // 60000, d // 1000 % 60) AS short, d AS ms FROM (SELECT film_id, cue_id, start_ms % 86400000 AS d FROM v_cues)", _CUES)
def stamp_round_trip(spark, sf_dir):
    x = v_cues(spark, sf_dir).withColumn("d", F.col("start_ms") % 86_400_000).withColumn("stamp", stamps.from_ms(F.col("d")))
    return x.select("film_id", "cue_id", "stamp", stamps.minutes(F.col("d")).alias("short"), stamps.to_ms(F.col("stamp")).alias("ms"))


def _pairs(spark, sf_dir) -> DataFrame:
    """Each turn with the turns before and after it as two other readings."""
    w = Window.partitionBy("film_id").orderBy("seq")
    return v_turns(spark, sf_dir).withColumn("can", F.lag("text").over(w)).withColumn("qwn", F.lead("text").over(w))


@query()
def review_tiers(spark, sf_dir):
    return review.tiers(_pairs(spark, sf_dir), ["can", "qwn"]).select("film_id", "seq", "tier", "n_dissent", "marked")


# word i of a line opens a sentence that no mark closes before: RE2 has no look-behind, so the word before is looked at instead
_OPENS = "'^[A-ZÀ-ÂÄ-ÏÑ-ÖÙ-Ý][a-zà-ÿ''’]+'"
_BOUNDS = (
    f"bw AS (SELECT film_id, seq, text, regexp_split_to_array(text, '[ \\x09]+') AS w, list_transform(regexp_split_to_array(text, '[ \\x09]+'), lambda x: regexp_replace(x, '{_NB}+$', '')) AS p FROM v_lines), "
    f"bounds AS (SELECT film_id, seq, text, list_transform(list_filter(range(2, len(w) + 1), lambda i: regexp_matches(w[i], {_OPENS}) AND NOT regexp_full_match(regexp_extract(w[i], {_OPENS}), '[IVXLC]+(er|re|e|ème)?')"
    f" AND regexp_matches(p[i - 1], '[a-zà-ÿ0-9]$') AND NOT list_contains([{', '.join(chr(39) + x.replace(chr(39), chr(39) * 2) + chr(39) for x in sorted(repair.NON_FINAL))}], lower(regexp_extract(p[i - 1], '[A-ZÀ-ÂÄ-ÏÑ-ÖÙ-Ýa-zà-ÿ''’-]+$')))), lambda i: regexp_extract(w[i], {_OPENS})) AS missing,"
    f" (len(regexp_extract_all(text, '[.!?]{_NB}+[a-zà-ÿ]')) - len(regexp_extract_all(text, '[.][.]{_NB}+[a-zà-ÿ]')))::INTEGER AS n_spurious FROM bw)"
)


@query("SELECT film_id, seq, array_to_string(missing, ' ') AS missing, len(missing)::INTEGER AS n_missing, n_spurious FROM bounds", _LINES, _BOUNDS)
def sentence_boundaries(spark, sf_dir):
    return repair.boundary_report(v_lines(spark, sf_dir)).select("film_id", "seq", F.array_join("missing", " ").alias("missing"), "n_missing", "n_spurious")


@query(f"SELECT film_id, seq, n FROM (SELECT film_id, seq, (len(regexp_extract_all(text, '[.!?]{_NB}+[a-zà-ÿ]')) - len(regexp_extract_all(text, '[.][.]{_NB}+[a-zà-ÿ]')))::INTEGER AS n FROM v_lines) WHERE n > 0", _LINES)
def spurious_marks(spark, sf_dir):
    return repair.boundary_report(v_lines(spark, sf_dir)).where("n_spurious > 0").select("film_id", "seq", F.col("n_spurious").alias("n"))


def _line_cues(spark, sf_dir) -> DataFrame:
    x = v_lines(spark, sf_dir).where("trim(text) <> ''")
    return x.select("film_id", "seq", F.col("seq").alias("cue_id"), (F.col("seq") * 10_000).cast("long").alias("start_ms"), (F.col("seq") * 10_000 + 9000).cast("long").alias("end_ms"), "text")


@query()
def cue_repair(spark, sf_dir):
    return repair.repaired(_line_cues(spark, sf_dir))


@query()
def repair_summary(spark, sf_dir):
    x = _line_cues(spark, sf_dir)
    return repair.summary(x, repair.repaired(x))


@query("SELECT doc_id AS film_id, 0::BIGINT AS at_ms FROM documents WHERE false")
def repair_lost_stamps(spark, sf_dir):
    """Starts and ends that the repair lost: none."""
    x = _line_cues(spark, sf_dir)
    return corrections.stamps_survive(x, repair.repaired(x))


_CALLED = "called AS (SELECT film_id, seq AS cue_id, seq * 10000 AS start_ms, seq * 10000 + 9000 AS end_ms, missing[1] AS word FROM bounds WHERE trim(text) <> '' AND len(missing) > 0)"
_QUIET = "quiet AS (SELECT film_id, cue_id, gap_ms, end_ms + gap_ms / 2 AS middle_ms FROM (SELECT *, row_number() OVER (PARTITION BY film_id, cue_id ORDER BY gap_ms DESC, start_ms) AS n FROM (SELECT w.film_id, c.cue_id, w.start_ms, w.end_ms, lead(w.start_ms) OVER (PARTITION BY w.film_id, c.cue_id ORDER BY w.start_ms) - w.end_ms AS gap_ms FROM v_words w JOIN called c ON c.film_id = w.film_id AND w.start_ms BETWEEN c.start_ms AND c.end_ms) WHERE gap_ms > 0) WHERE n = 1)"


@query("SELECT c.*, gap_ms, middle_ms, CASE WHEN gap_ms >= 350 THEN 'SPLIT' ELSE 'break/punct' END AS plan FROM called c LEFT JOIN quiet q ON q.film_id = c.film_id AND q.cue_id = c.cue_id", _LINES, _WORDS, _BOUNDS, _CALLED, _QUIET)
def repair_plan(spark, sf_dir):
    return repair.planned(_line_cues(spark, sf_dir), v_words(spark, sf_dir))


def _wrap_sql(of: str = "v_lines", key: str = "seq") -> str:
    return f"wr AS (SELECT film_id, {key}, text, list_filter(regexp_split_to_array(text, '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {of}), opt AS (SELECT film_id, {key}, w, i, length(array_to_string(w[1:i], ' ')) AS a, length(array_to_string(w[i+1:], ' ')) AS b FROM (SELECT *, unnest(range(1, len(w))) AS i FROM wr WHERE length(text) > 42)), costed AS (SELECT *, a <= 42 AND b <= 42 AS fits, abs(a - b) AS d, CASE WHEN regexp_matches(w[i], '[,.!?;:]$') THEN 12 ELSE 0 END AS m, CASE WHEN regexp_matches(w[i+1], '^[A-ZÀ-Ý][a-zà-ÿ]') AND regexp_matches(w[i], '[a-zà-ÿ]$') THEN 20 ELSE 0 END AS t, a <= 45 AND b <= 45 AS fits2 FROM opt)"


_WRAP = _wrap_sql()


def _short_lines(spark, sf_dir) -> DataFrame:
    """Lines of conversations, which are as long as cues."""
    x = _t(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("k", "text"))
    return x.select((F.col("conv_id") * 1000 + F.col("turn")).alias("film_id"), F.col("k").alias("seq"), "text")


_SHORT = "v_lines AS (SELECT film_id, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS seq FROM (SELECT conv_id * 1000 + turn AS film_id, string_split(text, chr(10)) AS l FROM conversations))"


@query("SELECT l.film_id, l.seq, md5(CASE WHEN length(l.text) <= 42 OR len(l.w) < 2 THEN l.text ELSE array_to_string(l.w[1:i], ' ') || chr(10) || array_to_string(l.w[i+1:], ' ') END) AS text_md5 FROM wr l LEFT JOIN (SELECT film_id, seq, arg_min(i, (NOT fits, CASE WHEN fits THEN d - m - t ELSE d END, i)) AS i FROM costed GROUP BY film_id, seq) o ON o.film_id = l.film_id AND o.seq = l.seq", _SHORT, _WRAP)
def wrap_lines(spark, sf_dir):
    return _short_lines(spark, sf_dir).select("film_id", "seq", F.md5(cues.wrapped(F.col("text"))).alias("text_md5"))


@query("SELECT l.film_id, l.seq, md5(CASE WHEN length(array_to_string(l.w, ' ')) <= 42 OR i IS NULL THEN array_to_string(l.w, ' ') ELSE array_to_string(l.w[1:i], ' ') || chr(10) || array_to_string(l.w[i+1:], ' ') END) AS text_md5 FROM wr l LEFT JOIN (SELECT film_id, seq, arg_min(i, (d - m, i)) AS i FROM costed WHERE fits2 GROUP BY film_id, seq) o ON o.film_id = l.film_id AND o.seq = l.seq", _SHORT, _WRAP)
def wrap_repaired(spark, sf_dir):
    return _short_lines(spark, sf_dir).select("film_id", "seq", F.md5(repair.cues_wrapped(F.col("text"))).alias("text_md5"))


@query("SELECT l.film_id, l.cue_id, CASE WHEN length(l.text) <= 42 OR len(l.w) < 2 THEN l.text ELSE array_to_string(l.w[1:i], ' ') || chr(10) || array_to_string(l.w[i+1:], ' ') END AS text FROM wr l LEFT JOIN (SELECT film_id, cue_id, arg_min(i, (NOT fits, CASE WHEN fits THEN d - m - t ELSE d END, i)) AS i FROM costed GROUP BY film_id, cue_id) o ON o.film_id = l.film_id AND o.cue_id = l.cue_id", _WORDS, _NUMBERED, _NEXT, _FIRSTS, _GREEDY, _wrap_sql("greedy", "cue_id"))
def wrap_two_lines(spark, sf_dir):
    return cues.group_words(v_words(spark, sf_dir)).select("film_id", "cue_id", cues.wrapped(F.col("text")).alias("text"))


def _worded(spark, sf_dir) -> DataFrame:
    """Cues of two words each, so that transcripts share words."""
    return v_cues(spark, sf_dir).withColumn("text", F.expr("concat('A', cue_id % 3, ' b', cue_id % 5)"))


_SHARED = "shared AS (SELECT l.film_id, l.source, l.seq, l.cue_id, l.start_ms, r.source AS other, r.cue_id AS other_id, r.start_ms AS other_ms, ((l.cue_id % 3 = r.cue_id % 3)::INTEGER + (l.cue_id % 5 = r.cue_id % 5)::INTEGER) AS shared FROM v_cues l JOIN v_cues r ON r.film_id = l.film_id AND r.end_ms > l.start_ms - 60000 AND r.start_ms < l.end_ms + 60000 WHERE l.source = 'view' AND r.source IN ('click', 'purchase') AND (l.cue_id % 3 = r.cue_id % 3 OR l.cue_id % 5 = r.cue_id % 5))"


@query("SELECT film_id, cue_id, other_id, shared, other_ms - start_ms AS delta_ms FROM (SELECT *, row_number() OVER (PARTITION BY film_id, seq ORDER BY shared DESC, other_ms, other_id) AS n FROM shared WHERE other = 'click') WHERE n = 1", _CUES, _SHARED)
def start_deltas(spark, sf_dir):
    c = _worded(spark, sf_dir)
    return matching.start_deltas(c.where("source = 'view'"), c.where("source = 'click'"), 60_000).select("film_id", "cue_id", "other_id", "shared", "delta_ms")


@query("SELECT film_id, cue_id, CASE WHEN (film_id, seq) IN (SELECT (film_id, seq) FROM shared WHERE other = 'purchase') THEN 'corroborated' ELSE 'unconfirmed' END AS tag FROM v_cues WHERE source = 'view'", _CUES, _SHARED)
def recovery_tag(spark, sf_dir):
    c = _worded(spark, sf_dir)
    return matching.corroborated(c.where("source = 'view'"), c.where("source = 'purchase'"), 60_000).select("film_id", "cue_id", "tag")


@query("SELECT film_id, start_ms, end_ms, n_cues, EXISTS (SELECT 1 FROM v_cues s WHERE s.source = 'purchase' AND s.film_id = r.film_id AND s.end_ms > r.start_ms AND s.start_ms < r.end_ms) AS priority FROM runs r", _CUES, _MISSED, _RUNS)
def gap_priority(spark, sf_dir):
    suspects = v_cues(spark, sf_dir).where("source = 'purchase'")
    return matching.prioritised(_runs(spark, sf_dir).drop("run"), suspects).select("film_id", "start_ms", "end_ms", "n_cues", "priority")


@query("SELECT film_id, seq, md5(lag(text) OVER w) AS before_md5, md5(lead(text) OVER w) AS after_md5, lead(text) OVER w IS NOT NULL AND NOT regexp_matches(rtrim(text), '[.!?…]$') AS runs_on FROM v_turns WINDOW w AS (PARTITION BY film_id ORDER BY seq)", _TURNS)
def turn_context(spark, sf_dir):
    return matching.in_context(v_turns(spark, sf_dir)).select("film_id", "seq", F.md5("before").alias("before_md5"), F.md5("after").alias("after_md5"), "runs_on")


@query("SELECT film_id, seq, CASE WHEN seq % 4 = 0 THEN 'ref' WHEN seq % 3 = 0 THEN 'can' ELSE 'even' END AS timing, CASE WHEN seq % 4 = 0 THEN start_ms WHEN seq % 3 = 0 THEN end_ms ELSE seq * 1000 END AS start_ms FROM v_cues", _CUES)
def line_timing(spark, sf_dir):
    x = v_cues(spark, sf_dir).select("film_id", "seq", F.expr("if(seq % 4 = 0, start_ms, null)").alias("ref"), F.expr("if(seq % 3 = 0, end_ms, null)").alias("can"), (F.col("seq") * 1000).alias("even_ms"))
    return matching.timed(x, ["ref", "can"]).select("film_id", "seq", "timing", "start_ms")


_CHUNKS = "chunks AS (SELECT e.film_id, e.chunk_no, coalesce(n, 0) AS n_cues, CASE WHEN n > 0 THEN 'ok' ELSE 'empty' END AS status FROM (SELECT DISTINCT film_id, start_ms // 3600000 AS chunk_no FROM v_cues) e LEFT JOIN (SELECT film_id, start_ms // 3600000 AS chunk_no, count(*) AS n FROM v_cues WHERE source = 'click' GROUP BY ALL) m ON e.film_id = m.film_id AND e.chunk_no = m.chunk_no)"


def _chunks(spark, sf_dir) -> DataFrame:
    c = v_cues(spark, sf_dir).withColumn("chunk_no", F.floor(F.col("start_ms") / 3_600_000).cast("long"))
    return matching.chunk_status(c, c.where("source = 'click'"))


@query("SELECT film_id, chunk_no, n_cues, status FROM chunks", _CUES, _CHUNKS)
def chunk_status(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query("SELECT film_id, count(*) AS n_chunks, count(*) FILTER (status <> 'ok') AS n_failed, bool_or(status <> 'ok') AS failed FROM chunks GROUP BY film_id", _CUES, _CHUNKS)
def failed_films(spark, sf_dir):
    return matching.failed(_chunks(spark, sf_dir))


@query("SELECT CASE length(text) % 3 WHEN 0 THEN 'fix' WHEN 1 THEN 'ask' ELSE 'dismiss' END AS verdict, count(*) AS n, count(*) FILTER (length(text) % 3 = 0 AND length(trim(text)) > 0) AS n_with_text FROM v_turns GROUP BY 1", _TURNS)
def verdict_roll_up(spark, sf_dir):
    n = F.length("text") % 3
    x = v_turns(spark, sf_dir).select(F.when(n == 0, "fix").when(n == 1, "ask").otherwise("dismiss").alias("verdict"), F.when(n == 0, F.col("text")).alias("fix_text"))
    return matching.roll_up(x)


@query("SELECT text AS line, count(*) AS n FROM v_lines GROUP BY text ORDER BY n DESC, line LIMIT 3", _LINES)
def most_frequent_lines(spark, sf_dir):
    return matching.most_frequent(v_lines(spark, sf_dir).withColumnRenamed("text", "line"), "line")


_MEDIA = "media AS (SELECT w.film_id, whole_ms, duration_ms FROM (SELECT film_id, max(end_ms) AS whole_ms FROM v_cues GROUP BY film_id) w LEFT JOIN (SELECT film_id, max(end_ms) AS duration_ms FROM v_cues WHERE source = 'click' GROUP BY film_id) m ON w.film_id = m.film_id)"


@query("SELECT film_id, whole_ms, duration_ms FROM media WHERE duration_ms IS NULL OR abs(duration_ms - whole_ms) > 500", _CUES, _MEDIA)
def duration_check(spark, sf_dir):
    c, whole = v_cues(spark, sf_dir), F.max("end_ms").alias("duration_ms")
    return matching.incomplete(c.where("source = 'click'").groupBy("film_id").agg(whole), c.groupBy("film_id").agg(whole))


@query("SELECT film_id, round(audio / nullif(took, 0), 6) AS factor FROM (SELECT film_id, sum(end_ms - start_ms)::DOUBLE AS audio, count(*)::DOUBLE * 7000 AS took FROM v_cues GROUP BY film_id)", _CUES)
def realtime_factor(spark, sf_dir):
    x = v_cues(spark, sf_dir).groupBy("film_id").agg(F.sum(F.col("end_ms") - F.col("start_ms")).cast("double").alias("audio_ms"), (F.count("*") * 7000).cast("double").alias("elapsed_ms"))
    return matching.realtime(x).select("film_id", F.round("factor", 6).alias("factor"))


_SIZES = "(SELECT cue_id, (cue_id % 60 + 10) * 1080 / 288.0::DOUBLE AS font_px FROM v_cues)"


@query(f"SELECT cue_id, font_px, font_px * 1.6 AS ink_px, 1080 - 40 - font_px * 1.8 AS top_edge, 1080 - (800 + cue_id % 100) AS bar_px, greatest(800 + cue_id % 100 - (1080 - 40 - font_px * 1.8), 0) AS shortfall_px FROM {_SIZES}", _CUES)
def caption_layout(spark, sf_dir):
    px, height, crop = sizing.effective_px(F.col("cue_id") % 60 + 10, F.lit(1080)), F.lit(1080), 800 + F.col("cue_id") % 100
    top = sizing.top_edge(height, F.lit(40), px)
    return v_cues(spark, sf_dir).select("cue_id", px.alias("font_px"), sizing.ink_px(px).alias("ink_px"), top.alias("top_edge"), sizing.bar_height(height, crop, F.lit(0)).alias("bar_px"), F.greatest(crop - top, F.lit(0.0)).alias("shortfall_px"))


@query("SELECT seq, CASE WHEN seq % 7 > 0 THEN round(seq * 100.0::DOUBLE / (seq % 7), 6) END AS bytes, CASE WHEN seq % 5 > 0 THEN round(seq / (seq % 5)::DOUBLE, 6) END AS wall_s, seq * 32000 AS audio_bytes FROM v_cues", _CUES)
def job_projections(spark, sf_dir):
    n = F.col("seq")
    return v_cues(spark, sf_dir).select("seq", F.round(sizing.projected_bytes(n, F.lit(100), n % 7), 6).alias("bytes"), F.round(sizing.wall_seconds(n, n % 5), 6).alias("wall_s"), sizing.audio_bytes(n).alias("audio_bytes"))


@query("SELECT doc_id AS film_id, lang, CASE lang WHEN 'en' THEN 'eng' WHEN 'fr' THEN 'fra' WHEN 'de' THEN 'deu' WHEN 'es' THEN 'spa' END AS three, CASE lang WHEN 'en' THEN 'en_US' WHEN 'fr' THEN 'fr_FR' WHEN 'de' THEN 'de_DE' WHEN 'es' THEN 'es_ES' END AS dictionary FROM documents")
def language_codes(spark, sf_dir):
    x = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("film_id"), "lang", T.language_codes(F.col("lang")).alias("c"))
    return x.select("film_id", "lang", "c.three", "c.dictionary")


# ---------------------------------------------------------------- files: conversations as cue files

_WS = "[ \\x09-\\x0D\\x{A0}\\x{202F}]"
_STAMP = "printf('%02d:%02d:%02d', x // 3600000, x // 60000 % 60, x // 1000 % 60)"
_BLOCKS = (
    "v_blocks AS (SELECT *, lpad((start_ms // 3600000)::VARCHAR, 2, '0') AS hh, CASE WHEN turn % 5 = 4 THEN 'no time' ELSE "
    + " || ' --> ' || ".join(f"printf('%02d:%02d:%02d', {c} // 3600000, {c} // 60000 % 60, {c} // 1000 % 60) || CASE WHEN turn % 2 = 1 THEN '.' ELSE ',' END || printf('%03d', {c} % 1000)" for c in ("start_ms", "end_ms"))
    + f" END AS time_raw, array_to_string(list_transform(string_split(body, chr(10)), lambda y: trim(regexp_replace(y, '{_WS}+', ' ', 'g'))), chr(10)) AS flat FROM (SELECT conv_id AS film_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seq, CASE WHEN role = 'system' THEN 'x' || turn ELSE (turn + 1)::VARCHAR END AS cue_no, CASE WHEN role = 'system' THEN NULL ELSE (turn + 1)::INTEGER END AS cue_id, (turn * 7 % 10) * 3000 + 250 AS start_ms, (turn * 7 % 10) * 3000 + 2000 AS end_ms, regexp_replace(regexp_replace(text, '\\n{_WS}*\\n', chr(10), 'g'), '^{_WS}+|{_WS}+$', '', 'g') AS body FROM conversations))"
)
_PARSED = "parsed AS (SELECT * FROM v_blocks WHERE turn % 5 <> 4 AND body <> '')"


def v_files(spark, sf_dir) -> DataFrame:
    """A cue file for each conversation: numbers that are none, both stamp marks, times out of order, and blocks without a time."""
    ws = r"[ \x09-\x0D\xA0\x{202F}]"
    body = F.regexp_replace(F.regexp_replace("text", rf"\n{ws}*\n", "\n"), rf"^{ws}+|{ws}+\z", "")
    start = F.col("turn") * 7 % 10 * 3000
    stamp = lambda c: F.when(F.col("turn") % 2 == 1, F.translate(stamps.from_ms(c), ",", ".")).otherwise(stamps.from_ms(c))
    time = F.when(F.col("turn") % 5 == 4, "no time").otherwise(F.concat(stamp(start + 250), F.lit(" --> "), stamp(start + 2000)))
    number = F.when(F.col("role") == "system", F.concat(F.lit("x"), F.col("turn").cast("string"))).otherwise((F.col("turn") + 1).cast("string"))
    x = _t(spark, sf_dir, "conversations").select(F.col("conv_id").alias("film_id"), "turn", F.concat(number, F.lit("\n"), time, F.lit("\n"), body).alias("block"))
    return x.groupBy("film_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "block"))), lambda y: y["block"]), "\n\n").alias("content")).withColumn("source", F.lit("ASR"))


@query("SELECT film_id, seq, cue_no, cue_id, start_ms, end_ms, time_raw, md5(body) AS raw_md5, md5(replace(flat, chr(10), ' ')) AS text_md5 FROM parsed", _BLOCKS, _PARSED)
def cue_file_parse(spark, sf_dir):
    x = cuefiles.parse(v_files(spark, sf_dir))
    return x.select("film_id", "seq", "cue_no", "cue_id", "start_ms", "end_ms", "time_raw", F.md5("raw").alias("raw_md5"), F.md5("text").alias("text_md5"))


@query("SELECT film_id, row_number() OVER (PARTITION BY film_id ORDER BY start_ms, end_ms, replace(flat, chr(10), ' '), seq) - 1 AS seq, start_ms, end_ms, md5(replace(flat, chr(10), ' ')) AS text_md5 FROM parsed", _BLOCKS, _PARSED)
def cue_file_sorted(spark, sf_dir):
    return cuefiles.parse(v_files(spark, sf_dir), loose=True).select("film_id", "seq", "start_ms", "end_ms", F.md5("text").alias("text_md5"))


@query("SELECT film_id, seq, cue_no, time_raw, md5(body) AS raw_md5 FROM v_blocks WHERE body <> ''", _BLOCKS)
def cue_file_untimed(spark, sf_dir):
    return cuefiles.blocks(v_files(spark, sf_dir)).select("film_id", "seq", "cue_no", "time_raw", F.md5("raw").alias("raw_md5"))


@query("SELECT film_id, seq, start_ms FROM parsed WHERE regexp_matches(body, '[A-Za-zÀ-ÿ0-9]')", _BLOCKS, _PARSED)
def cue_file_speech(spark, sf_dir):
    return cuefiles.with_speech(cuefiles.parse(v_files(spark, sf_dir))).select("film_id", "seq", "start_ms")


@query("SELECT film_id, md5(string_agg(n || chr(10) || replace(time_raw, '.', ',') || chr(10) || flat || chr(10) || chr(10), '' ORDER BY n)) AS content_md5 FROM (SELECT *, row_number() OVER (PARTITION BY film_id ORDER BY start_ms, seq) AS n FROM parsed) GROUP BY film_id", _BLOCKS, _PARSED)
def cue_file_render(spark, sf_dir):
    return cuefiles.rendered(cuefiles.parse(v_files(spark, sf_dir))).select("film_id", F.md5("content").alias("content_md5"))


@query("SELECT film_id, md5(string_agg(n || chr(10) || time_raw || chr(10) || flat || chr(10) || chr(10), '' ORDER BY n)) AS content_md5 FROM (SELECT *, row_number() OVER (PARTITION BY film_id ORDER BY seq) AS n FROM parsed) GROUP BY film_id", _BLOCKS, _PARSED)
def cue_file_verbatim(spark, sf_dir):
    return cuefiles.rendered(cuefiles.parse(v_files(spark, sf_dir)), keep_time=True).select("film_id", F.md5("content").alias("content_md5"))


@query("SELECT film_id, seq, row_number() OVER (PARTITION BY film_id ORDER BY seq)::INTEGER AS cue_id, seq * 8000 AS start_ms, seq * 8000 + 8000 AS end_ms, md5(trim(text)) AS text_md5 FROM v_turns WHERE seq % 3 <> 1 AND trim(text) <> ''", _TURNS)
def window_cues(spark, sf_dir):
    t = v_turns(spark, sf_dir).withColumnRenamed("seq", "chunk_no")
    texts = t.select("film_id", "chunk_no", F.when(F.col("chunk_no") % 3 == 1, " ").otherwise(F.col("text")).alias("text"))
    cuts = t.select("film_id", "chunk_no", (F.col("chunk_no") * 8000).alias("start_ms"), (F.col("chunk_no") * 8000 + 8000).alias("end_ms"))
    return cuefiles.window_cues(texts, cuts).select("film_id", "seq", "cue_id", "start_ms", "end_ms", F.md5("text").alias("text_md5"))


# ---------------------------------------------------------------- words, cuts, suspects and settings as files


@query("SELECT w.film_id, w.chunk_no, w.pos, w.word, w.start_ms - c.start_ms AS start_ms, w.end_ms - c.start_ms AS end_ms FROM v_words w JOIN v_cuts c ON c.film_id = w.film_id AND c.chunk_no = w.chunk_no", _WORDS, _CUTS)
def word_file_round_trip(spark, sf_dir):
    w = v_chunk_words(spark, sf_dir).withColumn("chunk", F.format_string("c%02d", "chunk_no"))
    return timings.words(timings.word_files(w)).select("film_id", "chunk_no", "pos", "word", "start_ms", "end_ms")


@query("SELECT film_id, chunk_no, pos, start_ms, end_ms, row_number() OVER (PARTITION BY film_id ORDER BY start_ms, chunk_no, pos)::INTEGER - 1 AS n FROM v_words", _WORDS)
def word_order(spark, sf_dir):
    w = timings.on_film_time(v_chunk_words(spark, sf_dir), v_cuts(spark, sf_dir))
    return timings.film_order(w).select("film_id", "chunk_no", "pos", "start_ms", "end_ms", "n")


@query("SELECT film_id, chunk_no, start_ms, lead(start_ms) OVER (PARTITION BY film_id ORDER BY chunk_no) AS end_ms FROM v_cuts QUALIFY end_ms IS NOT NULL", _WORDS, _CUTS)
def cut_file_round_trip(spark, sf_dir):
    return timings.cuts(timings.cut_text(v_cuts(spark, sf_dir).withColumnRenamed("start_ms", "cut_ms"))).select("film_id", "chunk_no", "start_ms", "end_ms")


@query("SELECT film_id, chunk_no, word, start_ms, raw_ms FROM (SELECT film_id, chunk_no, word, start_ms, 9 * (end_ms - start_ms) AS raw_ms FROM v_words) WHERE raw_ms > 6000", _WORDS)
def suspect_file_round_trip(spark, sf_dir):
    slow = v_words(spark, sf_dir).withColumn("end_ms", F.col("start_ms") + 9 * (F.col("end_ms") - F.col("start_ms")))
    found = cues.clamp(slow).where("suspect").withColumn("chunk", F.format_string("c%02d", "chunk_no"))
    x = timings.suspects(timings.suspect_files(found)).withColumn("chunk_no", timings.chunk_number("chunk"))
    return x.select("film_id", "chunk_no", "word", stamps.seconds_to_ms(F.col("abs_start")).alias("start_ms"), (stamps.seconds_to_ms(F.col("abs_end")) - stamps.seconds_to_ms(F.col("abs_start"))).alias("raw_ms"))


@query("SELECT film_id, count(*) AS n_words, count(*) FILTER (raw > cap) AS n_clamped, count(*) FILTER (raw > 6000) AS n_suspects, round(count(*) FILTER (raw > cap) / count(*), 6) AS share FROM (SELECT film_id, 9 * (end_ms - start_ms) AS raw, least(4500, greatest(1200, 120 * length(word))) AS cap FROM v_words) GROUP BY film_id", _WORDS)
def clamped_share(spark, sf_dir):
    slow = v_words(spark, sf_dir).withColumn("end_ms", F.col("start_ms") + 9 * (F.col("end_ms") - F.col("start_ms")))
    return cues.clamped_share(cues.clamp(slow)).withColumn("share", F.round("share", 6))


_SETTINGS = {0: '{"replacements": [["the ", "THE "], ["([a-z]+)ing ", "\\\\1in\' "], ["zz", "$1"]]}', 1: '{"drop_matching": ["copyright", "LE la"]}', 2: '{"drop_cues_between": [0, 5], "drop_if_foreign": "en", "drop_threshold": 0.1}'}


@query(f"SELECT film_id, seq, md5(t) AS text_md5, t <> text AS changed FROM (SELECT *, CASE WHEN film_id % 4 = 0 THEN replace(regexp_replace(replace(text, 'the ', 'THE '), '([a-z]+)ing ', '\\1in'' ', 'g'), 'zz', '$1') ELSE text END AS t, regexp_extract_all(lower(text), '[A-Za-zÀ-ÿ'']+') AS w FROM v_lines) WHERE NOT (film_id % 4 = 1 AND regexp_matches(lower(text), 'copyright|le la')) AND NOT (film_id % 4 = 2 AND seq <= 5 AND len(w) > 0 AND len(list_filter(w, lambda x: x IN ({_FOREIGN}, 'it', 'is')))::DOUBLE / len(w) > 0.1)", _LINES)
def rule_files(spark, sf_dir):
    """Settings files of every film, applied to its lines; every fourth film has none."""
    x = v_lines(spark, sf_dir).withColumn("start_ms", F.col("seq") * 1000)
    k = F.col("film_id") % 4
    content = F.when(k == 0, _SETTINGS[0]).when(k == 1, _SETTINGS[1]).otherwise(_SETTINGS[2])
    files = x.select("film_id").distinct().where("film_id % 4 < 3").withColumn("content", content)
    return corrections.apply_files(x, timings.rules(files)).select("film_id", "seq", F.md5("text").alias("text_md5"), "changed")


@query(f"SELECT film_id, seq FROM (SELECT film_id, seq, regexp_extract_all(lower(text), '[A-Za-zÀ-ÿ'']+') AS w FROM v_lines) WHERE NOT (seq BETWEEN 2 AND 9 AND len(w) > 0 AND len(list_filter(w, lambda x: x IN ({_FOREIGN}, 'it', 'is')))::DOUBLE / len(w) > 0.34)", _LINES)
def drop_foreign(spark, sf_dir):
    x = v_lines(spark, sf_dir).withColumn("start_ms", F.col("seq") * 1000)
    return corrections.apply_rules(x, [], foreign_between=(2000, 9000)).select("film_id", "seq")


@query("SELECT film_id, seq FROM v_lines WHERE regexp_matches(text, '[a-zà-ÿ] [A-ZÀ-Ý][a-zà-ÿ]')", _LINES)
def naive_boundaries(spark, sf_dir):
    return v_lines(spark, sf_dir).where(T.naive_boundary(F.col("text"))).select("film_id", "seq")


@query("SELECT film_id, seq FROM (SELECT film_id, seq, regexp_extract_all(lower(text), '[A-Za-zÀ-ÿ]+(?:''[A-Za-zÀ-ÿ]+)?') AS w FROM v_lines) WHERE len(w) > 3 AND len(list_distinct(w)) < len(w) * 0.8", _LINES)
def repeating_windows(spark, sf_dir):
    return v_lines(spark, sf_dir).where(T.repeats_itself(F.col("text"), 0.8)).select("film_id", "seq")


@query("SELECT film_id, seq AS chunk_no FROM v_turns WHERE NOT (seq % 3 = 0) OR text LIKE '%a%'", _TURNS)
def pending_chunks(spark, sf_dir):
    t = v_turns(spark, sf_dir).withColumnRenamed("seq", "chunk_no")
    done = t.where("chunk_no % 3 = 0").select("film_id", "chunk_no", F.when(F.col("text").contains("a"), "failed").otherwise("ok").alias("status"))
    return timings.pending(t.select("film_id", "chunk_no"), done)


# ---------------------------------------------------------------- probes, chunks, images


def _probes(spark, sf_dir) -> DataFrame:
    report = F.format_string('{"format": {"duration": "%d.25"}, "streams": [{"index": 0, "codec_type": "audio", "codec_name": "aac", "channels": %d, "tags": {"language": "fra"}}, {"index": 1, "codec_type": "subtitle", "codec_name": "%s"}]}', "s_suppkey", F.col("s_nationkey") % 6 + 1, F.when(F.col("s_suppkey") % 2 == 0, "subrip").otherwise("hdmv_pgs_subtitle"))
    return _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("film_id"), report.alias("content"))


@query("SELECT s_suppkey AS film_id, s_suppkey * 1000 + 250 AS duration_ms FROM supplier")
def media_probe(spark, sf_dir):
    return timings.media(_probes(spark, sf_dir))


@query("SELECT s_suppkey AS film_id, 0 AS index, 'audio' AS kind, 'aac' AS codec, s_nationkey % 6 + 1 AS channels, 'fra' AS language, false AS bitmap FROM supplier UNION ALL SELECT s_suppkey, 1, 'subtitle', CASE WHEN s_suppkey % 2 = 0 THEN 'subrip' ELSE 'hdmv_pgs_subtitle' END, NULL, NULL, s_suppkey % 2 <> 0 FROM supplier")
def stream_probe(spark, sf_dir):
    return timings.streams(_probes(spark, sf_dir)).drop("title")


@query("SELECT film_id, start_ms // 1000 AS at_s FROM v_cues WHERE source = 'click'", _CUES)
def silence_log(spark, sf_dir):
    """Silences out of a log of each film."""
    line = F.concat(F.lit("[silencedetect] silence_start: "), F.expr("start_ms div 1000").cast("string"), F.lit(".5 | -40dB"))
    logs = v_cues(spark, sf_dir).where("source = 'click'").groupBy("film_id").agg(F.array_join(F.collect_list(line), "\n").alias("content"))
    return timings.silences(logs).select("film_id", F.expr("at_ms div 1000").alias("at_s"))


def _chunk_paths(spark, sf_dir) -> DataFrame:
    t = v_turns(spark, sf_dir)
    return t.select("film_id", F.format_string("/x/%d/c%02d.%s", "film_id", "seq", F.when(F.col("seq") % 5 == 4, "txt").otherwise("wav")).alias("path"))


def _chunk_cues(spark, sf_dir) -> DataFrame:
    t = v_turns(spark, sf_dir).where("seq % 3 <> 1")
    return t.select("film_id", F.format_string("c%02d", "seq").alias("chunk"), F.when(F.col("seq") % 2 == 0, F.col("text")).otherwise(F.lit("...")).alias("text"))


@query("SELECT film_id, 'c' || lpad(seq::VARCHAR, 2, '0') AS chunk, seq::INTEGER AS chunk_no FROM v_turns WHERE seq % 5 <> 4", _TURNS)
def chunk_listing(spark, sf_dir):
    return timings.chunk_list(_chunk_paths(spark, sf_dir))


@query("SELECT film_id, 'c' || lpad(seq::VARCHAR, 2, '0') AS chunk, 1::BIGINT AS n_segments FROM v_turns WHERE seq % 5 <> 4 AND seq % 3 <> 1 AND seq % 2 = 0 AND regexp_matches(text, '[A-Za-zÀ-ÿ0-9]')", _TURNS)
def aligned_chunks(spark, sf_dir):
    used, _ = timings.with_transcripts(timings.chunk_list(_chunk_paths(spark, sf_dir)), _chunk_cues(spark, sf_dir))
    return used.select("film_id", "chunk", "n_segments")


@query("SELECT film_id, 'c' || lpad(seq::VARCHAR, 2, '0') AS chunk, CASE WHEN seq % 3 = 1 THEN 'no srt' ELSE 'no usable segments' END AS reason FROM v_turns WHERE seq % 5 <> 4 AND NOT (seq % 3 <> 1 AND seq % 2 = 0 AND regexp_matches(text, '[A-Za-zÀ-ÿ0-9]'))", _TURNS)
def skipped_chunks(spark, sf_dir):
    return timings.with_transcripts(timings.chunk_list(_chunk_paths(spark, sf_dir)), _chunk_cues(spark, sf_dir))[1]


def _images(spark, sf_dir) -> DataFrame:
    n = F.col("seq").cast("int") + 1
    end = F.when(F.col("seq") % 4 == 0, F.col("seq") * 4000).otherwise(F.col("seq") * 4000 + 1500)
    return v_turns(spark, sf_dir).select("film_id", n.alias("n"), (F.col("seq") * 4000).alias("start_ms"), end.alias("end_ms"))


@query("SELECT film_id, (seq + 1)::INTEGER AS n, seq * 4000 AS start_ms, CASE WHEN seq % 4 = 0 THEN seq * 4000 ELSE seq * 4000 + 1500 END AS end_ms, 'sub_' || lpad((seq + 1)::VARCHAR, 5, '0') || '.png' AS file FROM v_turns", _TURNS)
def image_index(spark, sf_dir):
    return bitmap.read_index(bitmap.index_files(_images(spark, sf_dir)))


@query(f"SELECT film_id, n, row_number() OVER (PARTITION BY film_id ORDER BY n)::INTEGER AS cue_id, start_ms, end_ms, md5(t) AS text_md5 FROM (SELECT film_id, (seq + 1)::INTEGER AS n, seq * 4000 AS start_ms, seq * 4000 + CASE WHEN seq % 4 = 0 THEN 2000 ELSE 1500 END AS end_ms, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda y: trim(regexp_replace(y, '{_WS}+', ' ', 'g'))), lambda y: y <> ''), chr(10)) AS t FROM v_turns WHERE seq % 6 <> 5) WHERE t <> ''", _TURNS)
def image_cues(spark, sf_dir):
    texts = v_turns(spark, sf_dir).select("film_id", (F.col("seq") + 1).cast("int").alias("n"), F.when(F.col("seq") % 6 == 5, "\n ").otherwise(F.col("text")).alias("text"))
    x = bitmap.read_cues(_images(spark, sf_dir), texts)
    return x.select("film_id", "n", "cue_id", "start_ms", "end_ms", F.md5(F.array_join("lines", "\n")).alias("text_md5"))


_FLAT = "lower(trim(regexp_replace(regexp_replace({}, '[^0-9A-Za-zÀ-ÿ'' ]', ' ', 'g'), ' +', ' ', 'g')))"
_DISAGREE = f"disagree AS (SELECT film_id, (seq + 1)::INTEGER AS n FROM v_turns WHERE {_FLAT.format('text')} <> {_FLAT.format('second')})".replace("FROM v_turns", "FROM (SELECT *, CASE WHEN seq % 7 = 6 THEN '' WHEN seq % 3 = 0 THEN replace(text, 'e', 'c') ELSE replace(text, ',', '.') END AS second FROM v_turns)")


def _disagree(spark, sf_dir) -> DataFrame:
    t = v_turns(spark, sf_dir).select("film_id", (F.col("seq") + 1).cast("int").alias("n"), "seq", "text")
    second = t.where("seq % 7 <> 6").withColumn("text", F.when(F.col("seq") % 3 == 0, F.replace("text", F.lit("e"), F.lit("c"))).otherwise(F.replace("text", F.lit(","), F.lit("."))))
    return bitmap.disagreement(t, second)


@query("SELECT film_id, n FROM disagree", _TURNS, _DISAGREE)
def ocr_disagreement(spark, sf_dir):
    return _disagree(spark, sf_dir).select("film_id", "n")


@query("SELECT film_id, n, CASE WHEN n % 2 = 0 THEN 'sub_' || lpad(n::VARCHAR, 5, '0') || '.png' ELSE '(image not indexed)' END AS file FROM disagree ORDER BY film_id, n LIMIT 20", _TURNS, _DISAGREE)
def first_disagreements(spark, sf_dir):
    """A report of 20 rows: the images that two readings see differently, with their files where they are indexed."""
    index = bitmap.read_index(bitmap.index_files(_images(spark, sf_dir).where("n % 2 = 0")))
    return bitmap.with_images(_disagree(spark, sf_dir), index).select("film_id", "n", "file").orderBy("film_id", "n").limit(20)


@query("SELECT s_suppkey AS film_id, 1 AS n, CASE WHEN s_suppkey % 5 > 0 THEN 20 - s_suppkey % 5 END::INTEGER AS top, CASE WHEN s_suppkey % 5 > 0 THEN 19 END::INTEGER AS bottom FROM supplier")
def text_rows(spark, sf_dir):
    """Frames of 40 x 20 pixels whose lowest 0 to 4 rows are bright; all rows of the upper part are too, which must not count."""
    k = (F.col("s_suppkey") % 5).cast("int")
    pixels = F.unhex(F.concat(F.repeat(F.lit("FF"), F.lit(400)), F.repeat(F.lit("00"), 400 - 40 * k), F.repeat(F.lit("FF"), 40 * k)))
    return bitmap.text_rows(_t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("film_id"), F.lit(1).alias("n"), F.lit(40).alias("width"), F.lit(20).alias("height"), pixels.alias("pixels")))


# ---------------------------------------------------------------- summaries, votes, terms


@query("SELECT film_id, count(*) AS n_cues, round(median(CASE WHEN d > 0 THEN length(text) * 1000.0::DOUBLE / d END), 6) AS median_cps, median(length(text))::DOUBLE AS median_chars, max(length(text)) AS longest_chars, quantile_cont(d::DOUBLE, 0.5) AS p50_ms, round(quantile_cont(d::DOUBLE, 0.99), 3) AS p99_ms, count(*) FILTER (d > 0 AND length(text) * 1000.0 / d > 25) AS n_fast, 0::BIGINT AS n_many_lines, count(*) FILTER (length(text) > 45) AS n_long_lines FROM (SELECT *, end_ms - start_ms AS d FROM v_cues) GROUP BY film_id", _CUES)
def reading_summary(spark, sf_dir):
    x = cues.reading_summary(v_cues(spark, sf_dir).withColumn("lines", F.array("text")))
    return x.withColumn("median_cps", F.round("median_cps", 6)).withColumn("p99_ms", F.round("p99_ms", 3))


@query("SELECT r.film_id, n_reference, coalesce(n_uncovered, 0) AS n_uncovered, round(coalesce(n_uncovered, 0) / n_reference, 6) AS share, round(coalesce(ms, 0) / 60000.0::DOUBLE, 6) AS minutes FROM (SELECT film_id, count(*) AS n_reference FROM v_cues WHERE source = 'view' GROUP BY film_id) r LEFT JOIN (SELECT film_id, count(*) AS n_uncovered, sum(end_ms - start_ms) AS ms FROM missed GROUP BY film_id) m ON r.film_id = m.film_id", _CUES, _MISSED)
def coverage_summary(spark, sf_dir):
    x = cues.coverage_summary(v_cues(spark, sf_dir).where("source = 'view'"), _missed(spark, sf_dir))
    return x.withColumn("share", F.round("share", 6)).withColumn("minutes", F.round("minutes", 6))


@query("SELECT film_id, seq, CASE WHEN nv >= 2 AND len(agreed) > 0 THEN 'both' WHEN nd > 0 THEN 'one' ELSE 'none' END AS tier, nd AS n_dissent, array_to_string([CASE WHEN list_contains(agreed, i) THEN '[[' || chr((97 + i)::INTEGER) || ']]' ELSE chr((97 + i)::INTEGER) END for i in range(4)], ' ') AS marked FROM (SELECT film_id, seq, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT AS nv, (coalesce(len(a), 0) > 0)::INTEGER + (coalesce(len(b), 0) > 0)::INTEGER AS nd, CASE WHEN a IS NULL THEN coalesce(b, []) WHEN b IS NULL THEN a ELSE list_intersect(a, b) END AS agreed FROM (SELECT film_id, seq, CASE WHEN seq % 4 = 0 THEN NULL ELSE range(seq % 3) END AS a, CASE WHEN seq % 5 = 0 THEN NULL ELSE range(seq % 2, 3) END AS b FROM v_cues))", _CUES)
def dissent_tiers(spark, sf_dir):
    """Tier, agreed positions and marked words from given dissent sets."""
    a = F.expr("if(seq % 4 = 0, null, slice(array(0, 1, 2), 1, cast(seq % 3 as int)))")
    b = F.expr("if(seq % 5 = 0, null, slice(array(0, 1, 2), cast(seq % 2 as int) + 1, 3))")
    x = v_cues(spark, sf_dir).withColumn("__words", F.array(*[F.lit(w) for w in "abcd"])).withColumn("__votes", F.filter(F.array(a, b), lambda v: v.isNotNull()))
    return review.verdict(x).select("film_id", "seq", "tier", "n_dissent", "marked")


@query("SELECT film_id, seq, CASE WHEN seq % 4 = 3 THEN 'dismiss' WHEN seq % 4 = 2 THEN 'fix' ELSE 'ask' END AS decision FROM v_cues", _CUES)
def consensus_decision(spark, sf_dir):
    x = v_cues(spark, sf_dir).withColumn("n_agree", F.col("seq") % 4).withColumn("n_sources", F.lit(3))
    return x.select("film_id", "seq", review.consensus().alias("decision"))


_ASKED = ["la", "les", "the", "qqq"]
_TALK = "talk AS (SELECT conv_id AS film_id, turn AS seq, role AS source, turn + 1 AS cue_id, turn * 2000 AS start_ms, turn * 2000 + 1500 AS end_ms, text FROM conversations)"
_ASKED_SQL = "asked AS (" + " UNION ALL ".join(f"SELECT film_id, '{t}' AS term, min(seq) AS seq FROM talk WHERE regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_]){t}($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])') GROUP BY film_id" for t in _ASKED) + ")"


def _talk(spark, sf_dir) -> DataFrame:
    x = _t(spark, sf_dir, "conversations")
    return x.select(F.col("conv_id").alias("film_id"), F.col("turn").alias("seq"), F.col("role").alias("source"), (F.col("turn") + 1).alias("cue_id"), (F.col("turn") * 2000).alias("start_ms"), (F.col("turn") * 2000 + 1500).alias("end_ms"), "text")


@query("SELECT a.film_id, a.term, a.seq, md5(coalesce((SELECT string_agg(r.text, ' / ' ORDER BY r.seq) FROM talk r WHERE r.source = 'assistant' AND r.film_id = a.film_id AND r.end_ms > a.seq * 2000 - 1500 AND r.start_ms < a.seq * 2000 + 3000), '')) AS window_md5 FROM asked a", _TALK, _ASKED_SQL)
def adjudicate(spark, sf_dir):
    x = _talk(spark, sf_dir)
    return review.adjudicated(x, x.where("source = 'assistant'"), _ASKED).select("film_id", "term", "seq", F.md5("window").alias("window_md5"))


@query("SELECT f.film_id, t.term FROM (SELECT DISTINCT film_id FROM talk) f, (SELECT unnest(['la', 'les', 'the', 'qqq']) AS term) t WHERE NOT EXISTS (SELECT 1 FROM asked a WHERE a.film_id = f.film_id AND a.term = t.term)", _TALK, _ASKED_SQL)
def unmatched_terms(spark, sf_dir):
    x = _talk(spark, sf_dir)
    return review.unmatched(x, _ASKED, review.first_match(x, _ASKED))


@query("SELECT film_id, at_ms, coalesce((SELECT arg_min(s.start_ms, (abs(s.start_ms - p.at_ms), s.start_ms)) FROM v_cues s WHERE s.source = 'click' AND s.film_id = p.film_id AND abs(s.start_ms - p.at_ms) < 100000), at_ms) AS nearest_ms FROM (SELECT film_id, start_ms AS at_ms FROM v_cues WHERE source = 'view') p", _CUES)
def nearest_silence(spark, sf_dir):
    c = v_cues(spark, sf_dir)
    at = lambda source: c.where(F.col("source") == source).select("film_id", F.col("start_ms").alias("at_ms"))
    return cues.nearest_silence(at("view"), at("click"), 100_000).select("film_id", "at_ms", "nearest_ms")


@query("SELECT film_id, count(*) = (max(n) + 149) // 150 AS complete FROM (SELECT film_id, n, unnest(range(1, n + 1, 150)) AS lo FROM (SELECT film_id, max(cue_id) AS n FROM v_cues GROUP BY film_id)) WHERE NOT (film_id % 3 = 1 AND lo = 301) GROUP BY film_id", _CUES)
def tiles_complete(spark, sf_dir):
    return cues.tiles_complete(cues.tiles(v_cues(spark, sf_dir)).where("not (film_id % 3 = 1 and lo = 301)"))


@query("SELECT film_id AS batch, (seq + 1)::INTEGER AS cue, CASE WHEN seq % 2 = 0 THEN 'fix' ELSE 'ask' END AS verdict FROM v_turns WHERE seq % 4 <> 3", _TURNS)
def batch_findings(spark, sf_dir):
    """Results of review batches as JSON, flattened; every fourth row has a verdict that is none."""
    verdict = F.when(F.col("seq") % 4 == 3, "perhaps").when(F.col("seq") % 2 == 0, "fix").otherwise("ask")
    rows = F.collect_list(F.struct((F.col("seq") + 1).alias("cue"), F.lit("00:01").alias("timestamp"), verdict.alias("verdict")))
    results = v_turns(spark, sf_dir).groupBy(F.col("film_id").alias("batch")).agg(F.to_json(F.struct(rows.alias("findings"))).alias("content"))
    return timings.batch_findings(results).select("batch", "cue", "verdict")


@query("SELECT film_id, start_ms + (seq % 50 = 0)::INT AS start_ms, end_ms FROM v_cues WHERE seq % 50 = 0", _CUES)
def invented_times(spark, sf_dir):
    """Time lines that the input does not have: every 50th start was moved."""
    c = v_cues(spark, sf_dir)
    return corrections.lost_stamps(c, c.withColumn("start_ms", F.col("start_ms") + F.expr("if(seq % 50 = 0, 1, 0)")))


@query("SELECT film_id, lo_ms, hi_ms FROM (SELECT s_suppkey AS film_id, unnest([s_suppkey * 1000, 3600000 + s_suppkey * 1000]) AS lo_ms, unnest([s_suppkey * 1000 + 60000, 3660000 + s_suppkey * 1000]) AS hi_ms FROM (SELECT s_suppkey % 60 AS s_suppkey FROM supplier))")
def song_range_list(spark, sf_dir):
    n = (F.col("s_suppkey") % 60).cast("int")
    text = F.format_string("00:%02d-01:%02d, 01:00:%02d-01:01:%02d", n, n, n, n)
    return _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 60).alias("film_id"), F.explode(stamps.ranges(text)).alias("r")).select("film_id", "r.lo_ms", "r.hi_ms")
