"""Bitmap subtitle streams (segments marked PG): demultiplexing, run-length decoding and rendering."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed values of the format: segment kinds, fragment flags, the flag of a cropped reference, ticks a second.
PALETTE, OBJECT, COMPOSITION, FIRST, LAST, CROPPED, CLOCK = 0x14, 0x15, 0x16, 0x80, 0x40, 0x40, 90_000
# Rows between stacked images, white rim in pixels, seconds of an event that nothing ends.
GAP, RIM, OPEN_END = 10, 20, 3.0
SCHEMA = "film_id string, n int, start_ms bigint, end_ms bigint, width int, height int, pixels binary"


def run_lengths(data: bytes, width: int, height: int) -> np.ndarray:
    """Palette indices (height, width) of run-length coded rows; short or broken data leaves zeros."""
    out, x, y, at = np.zeros((height, width), np.uint8), 0, 0, 0
    while at < len(data) and y < height:
        value, n, at = data[at], 1, at + 1
        if value == 0:
            if at >= len(data):
                break
            flags, at = data[at], at + 1
            if flags == 0:
                x, y = 0, y + 1
                continue
            n = flags & 0x3F
            if flags & 0x40 and at < len(data):
                n, at = (n << 8) | data[at], at + 1
            if flags & 0x80 and at < len(data):
                value, at = data[at], at + 1
        out[y, x : x + n] = value
        x += n
    return out


def segments(data: bytes):
    """(pts seconds, kind, body) of each segment; bytes that are no header are stepped over to the next one."""
    at = data.find(b"PG")
    while 0 <= at <= len(data) - 13:
        pts, _, kind, size = struct.unpack(">IIBH", data[at + 2 : at + 13])
        yield pts / CLOCK, kind, data[at + 13 : at + 13 + size]
        at = data.find(b"PG", at + 13 + size)


def shown(body: bytes) -> list[int]:
    """Object numbers of a composition; a reference has 8 bytes, or 16 if it is cropped."""
    found, at = [], 11
    for _ in range(body[10]):
        if at + 4 > len(body):
            break
        found.append(struct.unpack(">H", body[at : at + 2])[0])
        at += 16 if body[at + 3] & CROPPED else 8
    return found


def events(data: bytes) -> list[dict]:
    """Display events with grey images: white text on transparent becomes dark on white.

    An object is drawn when its last fragment comes, with the palette of the composition on show, so a number
    used again later changes nothing shown before.  The next composition ends an event; one left open lasts
    OPEN_END seconds.
    """
    palettes: dict[int, dict[int, tuple]] = {}
    objects: dict[int, list] = {}
    found: list[dict] = []
    live = None
    for pts, kind, body in segments(data):
        if kind == COMPOSITION and len(body) >= 11:
            if live:
                live["end"] = pts
            live = {"start": pts, "end": None, "palette": body[9], "drawn": []} if shown(body) else None
            found += [live] if live else []
        elif kind == PALETTE and len(body) >= 2:
            palettes.setdefault(body[0], {}).update({body[k]: tuple(body[k + 1 : k + 5]) for k in range(2, len(body) - 4, 5)})
        elif kind == OBJECT and len(body) >= 4:
            number, flag = struct.unpack(">H", body[:2])[0], body[3]
            if flag & FIRST and len(body) >= 11:
                objects[number] = [*struct.unpack(">HH", body[7:11]), body[11:]]
            elif number in objects:
                objects[number][2] += body[4:]
            if flag & LAST and live and number in objects:
                wide, high, coded = objects[number]
                live["drawn"].append(grey(run_lengths(coded, wide, high), palettes.get(live["palette"], {})))
    if live:
        live["end"] = live["start"] + OPEN_END
    return [{"start": e["start"], "end": e["end"], "image": framed(e["drawn"])} for e in found if e["drawn"]]


def grey(indices: np.ndarray, palette: dict[int, tuple]) -> np.ndarray:
    table = np.full(256, 255, np.uint8)
    for k, (luma, _, _, alpha) in palette.items():
        table[k] = 255 if alpha < 40 else 255 - luma
    return table[indices]


def framed(images: list[np.ndarray]) -> np.ndarray:
    """Images below each other, centred, GAP rows apart, with a white rim of RIM pixels, at twice the size."""
    wide = max(i.shape[1] for i in images)
    parts: list[np.ndarray] = []
    for i in images:
        left = (wide - i.shape[1]) // 2
        parts += [np.full((GAP, wide), 255, np.uint8)] if parts else []
        parts.append(np.pad(i, ((0, 0), (left, wide - i.shape[1] - left)), constant_values=255))
    return doubled(np.pad(np.concatenate(parts), RIM, constant_values=255))


def doubled(image: np.ndarray) -> np.ndarray:
    """Twice the size by a Lanczos kernel of three lobes, columns first, then rows, each rounded to bytes."""
    for _ in range(2):
        n = image.shape[1]
        centre = (np.arange(2 * n) + 0.5) / 2
        reach = centre[:, None] - (np.arange(n)[None, :] + 0.5)
        weight = np.where(np.abs(reach) < 3, np.sinc(reach) * np.sinc(reach / 3), 0.0)
        weight /= weight.sum(axis=1, keepdims=True)
        image = np.clip(np.rint(image @ weight.T), 0, 255).astype(np.uint8).T
    return image


def decode(files: DataFrame) -> DataFrame:
    """(film_id, content binary) to events, numbered over those with an image."""

    def run(batches):
        for pdf in batches:
            rows = []
            for film, data in zip(pdf["film_id"], pdf["content"]):
                for n, e in enumerate(events(bytes(data)), 1):
                    high, wide = e["image"].shape
                    rows.append((film, n, round(e["start"] * 1000), round(e["end"] * 1000), wide, high, e["image"].tobytes()))
            yield pd.DataFrame(rows, columns=["film_id", "n", "start_ms", "end_ms", "width", "height", "pixels"])

    return files.select("film_id", "content").mapInPandas(run, SCHEMA)


def index_files(images: DataFrame) -> DataFrame:
    """(film_id, content): the images' numbers, times in seconds and file names as JSON."""
    row = F.struct("n", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"), F.format_string("sub_%05d.png", "n").alias("file"))
    return images.groupBy("film_id").agg(F.to_json(F.array_sort(F.collect_list(row))).alias("content"))


def read_index(files: DataFrame) -> DataFrame:
    """Image index files to film_id, n, start_ms, end_ms, file."""
    x = files.select("film_id", F.explode(F.from_json("content", "array<struct<n:int,start:double,end:double,file:string>>")).alias("x")).select("film_id", "x.*")
    return x.select("film_id", "n", F.bround(F.col("start") * 1000).cast("long").alias("start_ms"), F.bround(F.col("end") * 1000).cast("long").alias("end_ms"), "file")


def read_images(images: DataFrame, reader, schema: str = "film_id string, n int, text string") -> DataFrame:
    """Texts of images by an outside reader: reader(pixels, width, height) -> text, called batch by batch on the executors."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"film_id": pdf["film_id"], "n": pdf["n"], "text": [reader(bytes(p), w, h) for p, w, h in zip(pdf["pixels"], pdf["width"], pdf["height"])]})

    return images.select("film_id", "n", "width", "height", "pixels").mapInPandas(run, schema)


def read_cues(images: DataFrame, texts: DataFrame) -> DataFrame:
    """Cues of the images with text, numbered anew; the image's number stays in `n`.  An end that is missing or not after the start is the start plus 2 s."""
    lines = F.filter(F.transform(F.split("text", "\r\n?|\n"), lambda y: F.regexp_replace(F.regexp_replace(y, r"(?U)\s+", " "), "^ | $", "")), lambda y: y != "")
    x = images.select("film_id", "n", "start_ms", "end_ms").join(texts.select("film_id", "n", lines.alias("lines")), ["film_id", "n"]).where("size(lines) > 0")
    x = x.withColumn("end_ms", F.expr("if(end_ms > start_ms, end_ms, start_ms + 2000)")).withColumn("seq", F.col("n"))
    return x.withColumn("cue_id", F.row_number().over(Window.partitionBy("film_id").orderBy("n")))


def with_images(words: DataFrame, index: DataFrame, missing: str = "(image not indexed)") -> DataFrame:
    """Rows with an image number `n` and the file it was read from, or the text for none."""
    return words.join(index.select("film_id", "n", "file"), ["film_id", "n"], "left").withColumn("file", F.coalesce("file", F.lit(missing)))


def disagreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """Images whose two readings differ once normalised; a missing second reading is empty."""
    flat = lambda c: F.lower(F.trim(F.regexp_replace(F.regexp_replace(c, "[^0-9A-Za-zÀ-ÿ' ]", " "), " +", " ")))
    x = first.select("film_id", "n", F.col("text").alias("a")).join(second.select("film_id", "n", F.col("text").alias("b")), ["film_id", "n"], "left")
    return x.withColumn("b", F.coalesce("b", F.lit(""))).where(flat(F.col("a")) != flat(F.col("b")))


def text_rows(frames: DataFrame, bright: int = 200, least: int = 8) -> DataFrame:
    """(film_id, n, top, bottom): rows of the lowest fifth of a grey frame with at least `least` bright pixels among every other one; null if none."""

    @F.pandas_udf("struct<top:int,bottom:int>")
    def found(width: pd.Series, height: pd.Series, pixels: pd.Series) -> pd.DataFrame:
        rows = []
        for w, h, p in zip(width, height, pixels):
            image = np.frombuffer(bytes(p), np.uint8).reshape(h, w)
            first = int(h * 0.8)
            hit = np.flatnonzero((image[first:, ::2] > bright).sum(axis=1) >= least) + first
            rows.append((int(hit[0]), int(hit[-1])) if len(hit) else (None, None))
        return pd.DataFrame(rows, columns=["top", "bottom"])

    return frames.withColumn("__x", found("width", "height", "pixels")).select("film_id", "n", "__x.top", "__x.bottom")
