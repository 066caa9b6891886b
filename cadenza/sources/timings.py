"""Word timings, cut lists, silences, suspects, rules, media facts and window texts; and what is written back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import stamps

WORDS = "map<string,array<struct<word:string,start:double,end:double>>>"
WINDOWS = "array<struct<words:array<struct<word:string,start:double,end:double>>>>"
RULES = "struct<replacements:array<array<string>>,drop_cues_between:array<double>,drop_if_foreign:string,drop_threshold:double,drop_matching:array<string>>"
STREAMS = "struct<format:struct<duration:string>,streams:array<struct<index:int,codec_type:string,codec_name:string,channels:int,tags:struct<language:string,title:string>>>>"


def chunk_number(name) -> F.Column:
    return F.expr(f"try_cast(regexp_extract({name}, '([0-9]+)', 1) as int)")


def words(files: DataFrame) -> DataFrame:
    """(film_id, content) JSON in either layout to film_id, chunk, chunk_no, pos (place in its chunk), word, start_ms, end_ms; entries without a start are left out."""
    by_chunk = files.select("film_id", F.explode(F.from_json("content", WORDS)).alias("chunk", "w")).select("film_id", "chunk", F.posexplode("w").alias("pos", "w"))
    by_window = files.where(F.col("content").rlike(r"^\s*\[")).select("film_id", F.posexplode(F.from_json("content", WINDOWS)).alias("k", "x")).select("film_id", F.format_string("c%02d", "k").alias("chunk"), F.posexplode("x.words").alias("pos", "w"))
    x = by_chunk.unionByName(by_window).where("w.start is not null")
    return x.select("film_id", "chunk", chunk_number("chunk").alias("chunk_no"), "pos", F.trim("w.word").alias("word"), stamps.seconds_to_ms(F.col("w.start")).alias("start_ms"), stamps.seconds_to_ms(F.coalesce("w.end", "w.start")).alias("end_ms"))


def word_files(words_df: DataFrame) -> DataFrame:
    """(film_id, content): word timings as JSON, a list of words for each chunk, in seconds.  Written beside the input, never over it."""
    seconds = lambda c: (F.col(c) / 1000).alias(c.removesuffix("_ms"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.struct("word", seconds("start_ms"), seconds("end_ms")).alias("w")))), lambda x: x["w"])
    chunks = words_df.groupBy("film_id", "chunk").agg(listed.alias("w"))
    return chunks.groupBy("film_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("chunk", "w"))))).alias("content"))


def cuts(files: DataFrame) -> DataFrame:
    """(film_id, content) with a second a line to film_id, chunk_no, start_ms, end_ms."""
    x = files.select("film_id", F.posexplode(F.filter(F.split("content", r"\s+"), lambda v: v != "")).alias("chunk_no", "v")).withColumn("start_ms", stamps.seconds_to_ms(F.col("v").cast("double")))
    return x.withColumn("end_ms", F.lead("start_ms").over(Window.partitionBy("film_id").orderBy("chunk_no"))).where("end_ms is not null").drop("v")


def cut_text(plan: DataFrame) -> DataFrame:
    """(film_id, content): cut points (chunk_no, cut_ms) with three decimals, a line each."""
    points = F.array_sort(F.collect_list(F.struct("chunk_no", "cut_ms")))
    return plan.groupBy("film_id").agg(F.array_join(F.transform(points, lambda p: F.format_string("%.3f", p["cut_ms"] / 1000)), "\n").alias("content"))


def on_film_time(words_df: DataFrame, cuts_df: DataFrame) -> DataFrame:
    """Words moved by their chunk's offset, joined by chunk number; a chunk without a cut starts at 0."""
    x = words_df.join(cuts_df.select("film_id", "chunk_no", F.col("start_ms").alias("offset")), ["film_id", "chunk_no"], "left").withColumn("offset", F.coalesce("offset", F.lit(0)))
    return x.withColumn("start_ms", F.col("start_ms") + F.col("offset")).withColumn("end_ms", F.col("end_ms") + F.col("offset")).drop("offset")


def word_order(words_df: DataFrame) -> list[str]:
    """Columns that put words in film order: start first, then chunk and place in it."""
    return [c for c in ("start_ms", "chunk_no", "pos") if c in words_df.columns]


def film_order(words_df: DataFrame, keys=("film_id",)) -> DataFrame:
    """`words_df` with `n`: the word's number in its film, by start, chunk and place, from 0."""
    return words_df.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*word_order(words_df))) - 1)


def silences(logs: DataFrame) -> DataFrame:
    """(film_id, content) logs with `silence_start: <seconds>` to film_id, at_ms."""
    found = F.regexp_extract_all("content", F.lit(r"silence_start:\s*([0-9.]+)"), F.lit(1))
    return logs.select("film_id", F.explode(found).alias("v")).select("film_id", stamps.seconds_to_ms(F.col("v").cast("double")).alias("at_ms"))


_SUSPECTS = "array<struct<chunk:string,word:string,abs_start:double,abs_end:double,raw_duration_s:double>>"


def suspects(files: DataFrame) -> DataFrame:
    return files.select("film_id", F.explode(F.from_json("content", _SUSPECTS)).alias("x")).select("film_id", "x.*")


def suspect_files(found: DataFrame) -> DataFrame:
    """(film_id, content): suspects (chunk, word, start_ms, end_ms, raw_ms on film time) as JSON, in film order."""
    row = F.struct("chunk", "word", F.round(F.col("start_ms") / 1000, 3).alias("abs_start"), F.round((F.col("start_ms") + F.col("raw_ms")) / 1000, 3).alias("abs_end"), F.bround(F.col("raw_ms") / 1000, 2).alias("raw_duration_s"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("start_ms", "chunk", "pos", row.alias("x")))), lambda x: x["x"])
    return found.groupBy("film_id").agg(F.to_json(listed).alias("content"))


def rules(files: DataFrame) -> DataFrame:
    """Correction settings of each film; everything optional, threshold 0.34."""
    x = files.select("film_id", F.from_json("content", RULES).alias("x")).select("film_id", "x.*")
    return x.withColumn("drop_threshold", F.coalesce("drop_threshold", F.lit(0.34)))


def findings(spark: SparkSession, path: str) -> DataFrame:
    """Review findings; rows without cue, timestamp or verdict are left out."""
    x = spark.read.schema("cue int, timestamp string, verdict string, fix_text string, justification string").json(path)
    return sound_findings(x)


def sound_findings(x: DataFrame) -> DataFrame:
    return x.where("cue is not null and timestamp is not null and verdict in ('fix', 'ask', 'dismiss')")


def batch_findings(results: DataFrame) -> DataFrame:
    """Rows of all batches' results (content: JSON with a list `findings`), flattened; batches without a result are left out."""
    kind = "struct<findings:array<struct<cue:int,timestamp:string,verdict:string,fix_text:string,justification:string>>>"
    return sound_findings(results.select("batch", F.explode(F.from_json("content", kind)["findings"]).alias("x")).select("batch", "x.*"))


def media(files: DataFrame) -> DataFrame:
    """(film_id, content) probe reports in JSON to film_id, duration_ms."""
    return files.select("film_id", stamps.seconds_to_ms(F.from_json("content", STREAMS)["format"]["duration"].cast("double")).alias("duration_ms"))


def streams(files: DataFrame) -> DataFrame:
    """(film_id, content) probe reports to film_id, index, kind, codec, channels, language, title, and `bitmap`: subtitles that hold images."""
    x = files.select("film_id", F.explode(F.from_json("content", STREAMS)["streams"]).alias("s"))
    return x.select("film_id", "s.index", F.col("s.codec_type").alias("kind"), F.col("s.codec_name").alias("codec"), "s.channels", F.col("s.tags.language").alias("language"), F.col("s.tags.title").alias("title"), F.coalesce(F.col("s.codec_name").isin("hdmv_pgs_subtitle", "dvd_subtitle"), F.lit(False)).alias("bitmap"))


def chunk_list(paths: DataFrame, pattern: str = r"\.wav$") -> DataFrame:
    """(film_id, path) to the chunks among them: film_id, chunk, chunk_no; other files are left out."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    x = paths.where(name.rlike(pattern)).select("film_id", F.regexp_replace(name, pattern, "").alias("chunk"))
    return x.withColumn("chunk_no", chunk_number("chunk"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Names of the `*.wav` under `path`; the files are listed, not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(path)
    return chunk_list(found.select(F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("film_id"), "path"))


def with_transcripts(chunks: DataFrame, cues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks with their number of cues that hold speech, and the skipped ones with the reason (no transcript, or none usable)."""
    n = cues.groupBy("film_id", "chunk").agg(F.count("*").alias("n_blocks"), F.count_if(F.col("text").rlike("[A-Za-zÀ-ÿ0-9]")).alias("n_segments"))
    x = chunks.join(n, ["film_id", "chunk"], "left")
    skipped = x.where("coalesce(n_segments, 0) = 0").select("film_id", "chunk", F.when(F.col("n_blocks").isNull(), "no srt").otherwise("no usable segments").alias("reason"))
    return x.where("n_segments > 0").drop("n_blocks"), skipped


def window_texts(spark: SparkSession, path: str) -> DataFrame:
    """One text file a window, its number in the name: window_no, text."""
    x = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"(\d+)", 1).cast("int").alias("window_no"), F.trim("value").alias("text"))
    return x


def pending(plan: DataFrame, done: DataFrame, keys=("film_id", "chunk_no")) -> DataFrame:
    """Rows of the plan without a finished result; failed ones (status) are tried again."""
    return plan.join(done.where("status = 'ok'").select(*keys), list(keys), "left_anti")
