"""Cue files (numbered blocks with a time line) as DataFrames, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import stamps

ARROW = r"^(\d+:\d+:\d+[,.]\d+)\s*-->\s*(\d+:\d+:\d+[,.]\d+)"
LOOSE_ARROW = r"^([\d:,.]+)\s*-->\s*([\d:,.]+)"


def blocks(files: DataFrame) -> DataFrame:
    """(film_id, source, content) to film_id, source, seq, cue_no (the number line as it stands), time_raw, raw (text lines as they stand), lines (white space collapsed), text.

    Blocks are parted by blank lines; one with under three lines is skipped.  Times are not looked at.
    """
    content = F.regexp_replace(F.regexp_replace("content", "\r\n?", "\n"), r"(?U)^\s+|\s+$", "")
    x = files.select("film_id", "source", F.posexplode(F.split(content, r"(?U)\n\s*\n")).alias("seq", "block"))
    x = x.withColumn("l", F.split("block", "\n")).where("size(l) >= 3").withColumn("body", F.slice("l", 3, F.size("l")))
    lines = F.transform("body", lambda y: F.regexp_replace(F.regexp_replace(y, r"(?U)\s+", " "), "^ | $", ""))
    x = x.select("film_id", "source", "seq", F.get("l", F.lit(0)).alias("cue_no"), F.get("l", F.lit(1)).alias("time_raw"), F.array_join("body", "\n").alias("raw"), lines.alias("lines"))
    return x.withColumn("text", F.array_join("lines", " "))


def parse(files: DataFrame, loose: bool = False) -> DataFrame:
    """Blocks with a valid time line as cues: film_id, source, seq, cue_id (null if the number line is no integer), cue_no, start_ms, end_ms, time_raw, raw, lines, text.

    loose: any digits, colons, commas and points around the arrow, and rows numbered (seq) by start, end and text.
    """
    arrow = LOOSE_ARROW if loose else ARROW
    x = blocks(files)
    for k, name in enumerate(("start_ms", "end_ms"), 1):
        x = x.withColumn(name, stamps.to_ms(F.regexp_extract("time_raw", arrow, k)))
    x = x.where("start_ms is not null and end_ms is not null").withColumn("cue_id", F.expr("try_cast(trim(cue_no) as int)"))
    if loose:
        x = x.withColumn("seq", F.row_number().over(Window.partitionBy("film_id", "source").orderBy("start_ms", "end_ms", "text", "seq")) - 1)
    return x.select("film_id", "source", "seq", "cue_id", "cue_no", "start_ms", "end_ms", "time_raw", "raw", "lines", "text")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Files <film>.<SOURCE>.srt under `path`; the label is upper-cased and cut to three letters."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value").alias("content"), F.col("_metadata.file_name").alias("name"))
    return parse(raw.select(F.regexp_extract("name", r"^(.*?)\.[^.]*\.srt$", 1).alias("film_id"), F.upper(F.substring(F.regexp_extract("name", r"\.([^.]*)\.srt$", 1), 1, 3)).alias("source"), "content"))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def bind(spark: SparkSession, specs: list[str], film_id: str = "film") -> DataFrame:
    """Cues of `LABEL=path` specs; an error if a spec has no `=`, a file is missing, or labels (upper-cased, three letters) repeat."""
    found = {}
    for spec in specs:
        label, mark, path = spec.partition("=")
        if not mark:
            raise ValueError(f"a source is LABEL=path, not {spec}")
        if not exists(spark, path):
            raise FileNotFoundError(path)
        found[_label(label)] = spark.read.text(path, wholetext=True).select(F.lit(film_id).alias("film_id"), F.lit("").alias("source"), F.col("value").alias("content"))
    if len(found) < len(specs):
        raise ValueError("labels must be distinct")
    return register({k: parse(v) for k, v in found.items()})


def _label(label: str) -> str:
    return label.strip().upper()[:3]


def with_speech(cues: DataFrame) -> DataFrame:
    """Cues that hold a letter or digit."""
    return cues.where(F.col("text").rlike("[A-Za-zÀ-ÿ0-9]"))


def rendered(cues: DataFrame, keep_time: bool = False) -> DataFrame:
    """(film_id, content): cues in time order, numbered from 1; empty ones are left out.

    keep_time: the time lines as they were read, in the order of the file, and emptied cues too.
    """
    w = Window.partitionBy("film_id").orderBy("seq") if keep_time else Window.partitionBy("film_id").orderBy("start_ms", "seq")
    body = F.array_join("lines", "\n") if "lines" in cues.columns else F.col("text")
    time = F.col("time_raw") if keep_time else F.concat(stamps.from_ms(F.col("start_ms")), F.lit(" --> "), stamps.from_ms(F.col("end_ms")))
    x = cues.withColumn("__body", body)
    x = (x if keep_time else x.where(F.length(F.trim("__body")) > 0)).withColumn("n", F.row_number().over(w))
    x = x.withColumn("block", F.concat(F.col("n").cast("string"), F.lit("\n"), time, F.lit("\n"), F.col("__body"), F.lit("\n\n")))
    return x.groupBy("film_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "block"))), lambda y: y["block"]), "").alias("content"))


def write(cues: DataFrame, path: str, keep_time: bool = False) -> None:
    """One text per film under `path`/film_id=..."""
    # the writer ends every row with a line feed of its own
    rows = rendered(cues, keep_time).withColumn("content", F.regexp_replace("content", r"\n\z", ""))
    rows.write.mode("overwrite").partitionBy("film_id").text(path)


def window_cues(texts: DataFrame, cuts: DataFrame, keys=("film_id", "chunk_no")) -> DataFrame:
    """One cue a window from its text and its cut: film_id, seq, cue_id, start_ms, end_ms, text; windows without text are skipped, numbers run over the rest."""
    x = texts.select(*keys, F.trim("text").alias("text")).where("text <> ''").join(cuts.select(*keys, "start_ms", "end_ms"), list(keys))
    n = F.row_number().over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]))
    return x.select(*keys[:-1], F.col(keys[-1]).alias("seq"), n.alias("cue_id"), "start_ms", "end_ms", "text")


def register(sources: dict[str, DataFrame]) -> DataFrame:
    """Label -> cues, bound into one table; labels are upper-cased, cut to three letters, and must stay distinct."""
    labels = [_label(k) for k in sources]
    if not labels or not all(labels) or len(set(labels)) != len(labels):
        raise ValueError("labels must be distinct and not empty")
    out = None
    for label, df in zip(labels, sources.values()):
        x = df.withColumn("source", F.lit(label))
        out = x if out is None else out.unionByName(x)
    return out
